"""Profiles and reports: frequencies, cross tables, quantiles, fill rates, funnels.

Reports over several columns turn the columns into (column, value) rows, count
each value once and then summarise the counts. The counts are combined inside
the map tasks, so a value that fills a third of a column costs nothing extra,
and no aggregate holds the values of a column in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrec.functions.text import is_blank, list_size

TOTAL = "TOTAL"


# -- frequencies ---------------------------------------------------------------


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, nulls left out (AGG-09)."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """Frequency table, largest first, ties by value (AGG-09, SRT-01)."""
    return frequency(df, column).orderBy(F.desc("n"), column)


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values (SRT-02)."""
    return most_frequent(df, column).limit(k)


def frequency_share(df: DataFrame, column: str) -> DataFrame:
    """Percentage of the non-null rows per value (AGG-10)."""
    counts = frequency(df, column)
    total = df.agg(F.count(column)).scalar()
    return counts.withColumn("pct", F.col("n") * 100.0 / total)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values (AGG-11)."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def _cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) rows of several columns, values as text."""
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*parts)).alias("cell")).select("cell.*")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per (column, value), null included; the base of the column reports."""
    return _cells(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


# -- column summaries ------------------------------------------------------------


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values per column, one pass (AGG-12)."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "missing")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact number of distinct non-null values per column (AGG-11)."""
    return value_counts(df, columns).groupBy("column").agg(F.count("value").alias("nunique"))


def column_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct values, missing values and their share, fewest distinct first (AGG-13)."""
    per_column = value_counts(df, columns or df.columns).groupBy("column").agg(
        F.count("value").alias("nunique"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"),
        F.sum("n").alias("_rows"),
    )
    share = F.bround(F.col("missing") * 100.0 / F.col("_rows"), 2)
    return per_column.select("column", "nunique", "missing", share.alias("missing_pct")).orderBy(
        "nunique", "column"
    )


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its count (AGG-14).

    Ties go to the smallest value.
    """
    counts = value_counts(df, columns)
    best = F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("value").alias("v")))
    summary = counts.groupBy("column").agg(
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("count"),
        F.count("value").alias("unique"),
        F.min(best).alias("_best"),
    )
    return summary.select(
        "column", "count", "unique", F.col("_best.v").alias("top"), (-F.col("_best.n")).alias("freq")
    )


def _number(column: str) -> Column:
    """A column as doubles; NaN is a missing value."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def describe_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles; NaN counts as missing (AGG-14).

    Two scans: one aggregate takes the moments and the quantile sketches, the other makes the quartiles exact.
    """
    survey, moments = _survey(df, columns, QUARTILES, with_moments=True)
    quartiles = _settle_quantiles(df, columns, QUARTILES, survey)
    wide = quartiles.groupBy("column").agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
            for p, name in zip(QUARTILES, ("q1", "median", "q3"), strict=True)
        ]
    )
    return moments.join(wide, "column", "left").select(
        "column", "m.count", "m.mean", "m.std", "m.min", "q1", "median", "q3", "m.max"
    )


# -- exact quantiles ----------------------------------------------------------------

QUARTILES = [0.25, 0.5, 0.75]
#: A sketch of n values errs by n / SKETCH_ACCURACY places at most; sketches of tasks merge into one of the same error.
SKETCH_ACCURACY = 100_000
#: Distances from a probability at which a sketch is asked: which of them encloses the answer depends on the row count.
_MARGINS = [m for k in range(10) if (m := 2.0 / SKETCH_ACCURACY * 4**k) < 1] + [1.0]


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation, in two scans and without sorting the table in one task.

    The first scan builds a mergeable quantile sketch per column, whose rank error is bounded, and so two values
    that are certain to enclose each answer. The second counts the rows below the enclosures and keeps only the
    distinct values inside them, with their counts; the answer is read from the running count over these. An
    enclosure holds about a 25 000th of the rows, and repeated values count as one. NaN counts as missing. A target
    that the enclosure misses fails the query instead of giving null.
    """
    survey, _ = _survey(df, columns, probs)
    return _settle_quantiles(df, columns, probs, survey)


def _survey(
    df: DataFrame, columns: list[str], probs: list[float], with_moments: bool = False
) -> tuple[dict[str, tuple[int, list[float] | None]], DataFrame | None]:
    """Values and sketch answers of every column, and its moments, from one aggregate."""
    asked = [q for p in probs for m in _MARGINS for q in (max(p - m, 0.0), min(p + m, 1.0))]
    known = df.select(*[F.when(_number(c).isNotNull(), F.col(c)).alias(c) for c in columns])
    facts = []
    for c in columns:
        number = F.col(c).cast("double")
        moments = [
            F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(number).alias("min"), F.max(number).alias("max"),
        ]
        parts = [F.count(c).alias("count"), *moments * with_moments, F.percentile_approx(number, asked, SKETCH_ACCURACY).alias("asked")]
        facts.append(F.struct(*parts).alias(c))
    summary = known.agg(*facts)
    row = summary.first()
    survey = {c: (row[c]["count"], row[c]["asked"]) for c in columns}
    if not with_moments:
        return survey, None
    kind = T.StructType([f for f in summary.schema[columns[0]].dataType.fields if f.name != "asked"])
    schema = T.StructType([T.StructField("column", T.StringType()), T.StructField("m", kind)])
    return survey, df.sparkSession.createDataFrame([(c, tuple(row[c][f.name] for f in kind)) for c in columns], schema)


def _settle_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], survey: dict[str, tuple[int, list[float] | None]]
) -> DataFrame:
    """Exact quantiles from one scan, given what the sketches say."""
    spark = df.sparkSession
    targets: dict[str, list[tuple]] = {}
    for c in columns:
        n, answers = survey[c]
        if not n:
            continue
        own = []
        for i, p in enumerate(probs):
            # the sketch may be off by n / SKETCH_ACCURACY places; the answer lies between two neighbours
            needed = 1.0 / SKETCH_ACCURACY + 2.0 / n
            at = next((k for k, m in enumerate(_MARGINS) if m >= needed), len(_MARGINS) - 1)
            low, high = answers[2 * (i * len(_MARGINS) + at) :][:2]
            position = (n - 1) * p
            own.append((low, high, p, int(position), position - int(position)))
        targets[c] = sorted(own)
    if not targets:
        return spark.createDataFrame([], "`column` string, prob double, value double")

    def seen(c: str) -> Column:
        """How many enclosures begin above a value, and the value itself if it lies in one."""
        v = _number(c)
        above = reduce(Column.__add__, [(v < low).cast("int") for low, *_ in targets[c]])
        inside = reduce(Column.__or__, [v.between(low, high) for low, high, *_ in targets[c]])
        return F.when(v.isNotNull(), F.struct(F.lit(c).alias("column"), above.alias("above"), F.when(inside, v).alias("v")))

    counts = (
        df.select(F.explode(F.array_compact(F.array(*map(seen, targets)))).alias("hit"))
        .groupBy("hit.column", "hit.above", "hit.v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # enclosures are sorted, so the values below the i-th of t are those with at least t - i enclosures above them
    facts = spark.createDataFrame(
        [
            (c, len(own) - i, low, high, p, rank, fraction)
            for c, own in targets.items()
            for i, (low, high, p, rank, fraction) in enumerate(own)
        ],
        "`column` string, least_above int, low double, high double, prob double, rank long, fraction double",
    )
    per_target = counts.join(F.broadcast(facts), "column")
    is_below = F.col("above") >= F.col("least_above")
    wanted = per_target.where(is_below | F.col("v").between(F.col("low"), F.col("high")))
    key = ["column", "prob", "rank", "fraction"]
    # one row for all values below, before those inside
    merged = wanted.groupBy(*key, F.when(~is_below, F.col("v")).alias("v")).agg(F.sum("n").alias("n"))
    running = W.partitionBy("column", "prob").orderBy(F.col("v").asc_nulls_first()).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = merged.withColumn("last", F.sum("n").over(running) - 1).withColumn("first", F.col("last") - F.col("n") + 1)
    at = F.when(F.col("rank").between(F.col("first"), F.col("last")), F.col("v"))
    after = F.when((F.col("rank") + 1).between(F.col("first"), F.col("last")), F.col("v"))
    found = ranked.groupBy(*key).agg(F.max(at).alias("a"), F.max(after).alias("b"))
    step = F.when(F.col("fraction") > 0, (F.col("b") - F.col("a")) * F.col("fraction")).otherwise(0.0)
    missed = F.raise_error(F.lit("a quantile lies outside its enclosure")).cast("double")
    return found.select("column", "prob", F.coalesce(F.col("a") + step, missed).alias("value"))


# -- cross tables --------------------------------------------------------------------


def cross_table(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Counts per pair with TOTAL margins, long form; pairs with a null are left out (AGG-15).

    The pairs are counted first; only the counts go through the cube. A value
    that reads like the name of the margins fails the query.
    """
    pairs = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    counts = pairs.groupBy(rows, columns).agg(F.count(F.lit(1)).alias("n"))
    cube = counts.cube(rows, columns).agg(F.sum("n").alias("n"), F.grouping_id().alias("_g"))
    total = F.lit(TOTAL)

    def value(name: str) -> Column:
        clash = F.raise_error(F.lit(f"{name} holds the value {TOTAL}")).cast(df.schema[name].dataType)
        return F.when(F.col(name).cast("string") == TOTAL, clash).otherwise(F.col(name))

    return cube.where((F.col("_g") != 3) | F.col("n").isNotNull()).select(
        F.when(F.col("_g").bitwiseAND(2) != 0, total).otherwise(value(rows)).alias(rows),
        F.when(F.col("_g").bitwiseAND(1) != 0, total).otherwise(value(columns)).alias(columns),
        "n",
    )


def cross_table_wide(df: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """The cross table with one column per listed value, 0 where a pair never occurs (AGG-15)."""
    long = cross_table(df, rows, columns)
    wide = long.groupBy(rows).pivot(columns, [*values, TOTAL]).agg(F.sum("n"))
    return wide.na.fill(0)


def fill_class(df: DataFrame, column: str, label: str = "(non classé)") -> DataFrame:
    """Null classes get a name of their own (NUL-01)."""
    return df.withColumn(column, F.coalesce(column, F.lit(label)))


# -- stage reports --------------------------------------------------------------------


def stage_sizes(stages: list[tuple[str, str, DataFrame]], key: str) -> DataFrame:
    """Rows, distinct keys and columns of every stage output (AGG-16)."""
    reports = []
    for step, name, df in stages:
        keys = F.count_distinct(key) if key in df.columns else F.lit(None).cast("long")
        reports.append(
            df.agg(F.count(F.lit(1)).alias("n_rows"), keys.alias("n_keys")).select(
                F.lit(step).alias("step"),
                F.lit(name).alias("dataset"),
                "n_rows",
                "n_keys",
                F.lit(len(df.columns)).alias("n_columns"),
            )
        )
    return reduce(DataFrame.unionAll, reports)


def funnel(
    candidates: list[DataFrame], consolidated: DataFrame, enriched: DataFrame, exported: DataFrame, key: str
) -> DataFrame:
    """Rows left after every step of the chain (AGG-17)."""
    keys = reduce(DataFrame.unionAll, [c.select(key) for c in candidates])

    def size(name: str, df: DataFrame, n: Column) -> DataFrame:
        return df.agg(n.alias("n")).select(F.lit(name).alias("step"), "n")

    rows = F.count(F.lit(1))
    return reduce(
        DataFrame.unionAll,
        [
            size("1 candidates, raw", keys, rows),
            size("2 candidates, distinct keys", keys, F.count_distinct(key)),
            size("3 consolidated", consolidated, rows),
            size("4 enriched", enriched, rows),
            size("5 exported", exported, rows),
        ],
    )


def origin_count_distribution(df: DataFrame, column: str = "origines") -> DataFrame:
    """How many keys come from 1, 2, … origins (AGG-18)."""
    return df.groupBy(list_size(F.col(column)).alias("n_origins")).agg(F.count(F.lit(1)).alias("n_keys"))


def origin_combinations(df: DataFrame, column: str = "origines") -> DataFrame:
    """Combinations of several origins, most frequent first (AGG-18)."""
    return most_frequent(df.where(list_size(F.col(column)) > 1), column)


def keys_per_origin(df: DataFrame, origins: list[str], column: str = "origines") -> DataFrame:
    """Keys each origin contributes to, and keys with several origins (AGG-18)."""
    listed = F.split(column, "[|]")
    counts = df.agg(
        *[F.count_if(F.array_contains(listed, o)).alias(o) for o in origins],
        F.count_if(F.size(listed) > 1).alias("(several)"),
    )
    return counts.unpivot([], [*origins, "(several)"], "origin", "n_keys")


def _fill_rates(df: DataFrame, fields: list[str], name: str) -> DataFrame:
    rates = []
    for f in fields:
        filled = (~is_blank(F.col(f))).cast("int") if f in df.columns else F.lit(0)
        rates.append(F.coalesce(F.avg(filled) * 100.0, F.lit(0.0)).alias(f))
    return df.agg(*rates).unpivot([], fields, "field", name)


def fill_rate_gain(before: DataFrame, after: DataFrame, fields: list[str]) -> DataFrame:
    """Percentage of filled values before and after, and the gain in points (AGG-19)."""
    joined = _fill_rates(before, fields, "pct_before").join(_fill_rates(after, fields, "pct_after"), "field")
    return joined.withColumn("gain", F.col("pct_after") - F.col("pct_before"))


def score_report(df: DataFrame, column: str = "score_enrichissement") -> DataFrame:
    """Mean, median and the counts of nearly empty and well filled rows (AGG-20)."""
    median = exact_quantiles(df, [column], [0.5]).select("value").scalar()
    return df.agg(
        F.avg(column).alias("mean_score"),
        F.count_if(F.col(column) < 0.5).alias("n_low"),
        F.count_if(F.col(column) >= 0.8).alias("n_high"),
    ).withColumn("median_score", median)


def histogram(df: DataFrame, column: str, bins: int = 20, extremes: tuple | None = None) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed (AGG-21).

    Bins without rows are listed with 0. When all values are equal the range is
    one unit wide around the value. ``extremes`` saves the scan for minimum and
    maximum where they are known, as from ``footer_facts``.
    """
    v = F.col(column).cast("double")
    low, high = extremes or df.agg(F.min(v), F.max(v)).first()
    flat = low is not None and low == high
    start = F.lit(None if low is None else low - 0.5 if flat else low).cast("double")
    width = F.lit(None if low is None else 1.0 / bins if flat else (high - low) / bins).cast("double")
    index = F.least(F.floor((v - start) / width), F.lit(bins - 1)).cast("int")
    counts = df.where(v.isNotNull()).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every_bin = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        every_bin.join(counts, "bin", "left")
        .withColumns(
            {
                "lower": start + F.col("bin") * width,
                "upper": start + (F.col("bin") + 1) * width,
                "n": F.coalesce("n", F.lit(0)),
            }
        )
        .select("bin", "lower", "upper", "n")
    )


def rule_overlap(df: DataFrame, first: Column, second: Column) -> DataFrame:
    """Rows that meet one rule, the other, and both (AGG-23)."""
    return df.agg(
        F.count_if(first).alias("n_first"),
        F.count_if(second).alias("n_second"),
        F.count_if(first & second).alias("n_both"),
    )

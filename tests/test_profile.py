import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldrec.operators import profile as P


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def people(spark):
    rows = [("a", 1.0, "x"), ("a", 2.0, None), ("b", None, "x"), (None, 4.0, "y"), ("a", 2.0, "y")]
    return spark.createDataFrame(rows, "k string, v double, w string")


def test_frequency_is_ordered_and_without_nulls(people):
    assert [tuple(r) for r in P.most_frequent(people, "k").collect()] == [("a", 3), ("b", 1)]
    assert [tuple(r) for r in P.top_values(people, "w", 1).collect()] == [("x", 2)]
    assert table(P.frequency_share(people, "k"), "k", "pct") == [("a", 75.0), ("b", 25.0)]


def test_counts(people):
    assert table(P.null_counts(people), "column", "missing") == [("k", 1), ("v", 1), ("w", 1)]
    assert table(P.distinct_counts(people, ["k", "v"]), "column", "nunique") == [("k", 2), ("v", 3)]
    assert [tuple(r) for r in P.column_summary(people).collect()] == [("k", 2, 1, 20.0), ("w", 2, 1, 20.0), ("v", 3, 1, 20.0)]


def test_describe(spark, people):
    assert table(P.describe_text(people, ["k", "w"]), "column", "count", "unique", "top", "freq") == [
        ("k", 4, 2, "a", 3),
        ("w", 4, 2, "x", 2),
    ]
    r = P.describe_numbers(people, ["v"]).first()
    assert (r["count"], r["mean"], r["min"], r["q1"], r["median"], r["q3"], r["max"]) == (4, 2.25, 1.0, 1.75, 2.0, 2.5, 4.0)
    assert r["std"] == pytest.approx(statistics.stdev([1, 2, 4, 2]))


def test_describe_column_without_values(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    r = P.describe_numbers(df, ["v"]).first()
    assert r["count"] == 0 and r["median"] is None


@pytest.mark.parametrize("seed", range(3))
def test_exact_quantiles(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([7.5, rng.uniform(-5, 5), float(rng.randrange(4))]) for _ in range(rng.choice([1, 2, 997, 5000]))]
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(v, -v) for v in values] + [(None, None)], "a double, b double").repartition(5)
    got = {(r["column"], r.prob): r.value for r in P.exact_quantiles(df, ["a", "b"], probs).collect()}
    for p in probs:
        assert got["a", p] == pytest.approx(np.quantile(values, p))
        assert got["b", p] == pytest.approx(np.quantile([-v for v in values], p))


def test_cross_table(spark, people):
    got = {(r.k, r.w): r.n for r in P.cross_table(people, "k", "w").collect()}
    assert got == {
        ("a", "x"): 1, ("a", "y"): 1, ("b", "x"): 1, ("a", "TOTAL"): 2, ("b", "TOTAL"): 1,
        ("TOTAL", "x"): 2, ("TOTAL", "y"): 1, ("TOTAL", "TOTAL"): 3,
    }
    assert table(P.cross_table_wide(people, "k", "w", ["x", "y"]), "k", "x", "y", "TOTAL") == [
        ("TOTAL", 2, 1, 3),
        ("a", 1, 1, 2),
        ("b", 1, 0, 1),
    ]
    assert P.cross_table(people.limit(0), "k", "w").count() == 0


def test_fill_class(people):
    assert table(P.frequency(P.fill_class(people, "k"), "k"), "k", "n") == [("(non classé)", 1), ("a", 3), ("b", 1)]


def test_stage_reports(spark):
    c1 = spark.createDataFrame([("1",), ("2",)], "siren string")
    c2 = spark.createDataFrame([("2",), ("3",)], "siren string")
    records = spark.createDataFrame([("1", "a"), ("2", "a|b"), ("3", "b")], "siren string, origines string")
    sizes = P.stage_sizes([("1", "c1", c1), ("2", "all", records)], "siren")
    assert table(sizes, "dataset", "n_rows", "n_keys", "n_columns") == [("all", 3, 3, 2), ("c1", 2, 2, 1)]
    assert [r.n for r in P.funnel([c1, c2], records, records, records, "siren").orderBy("step").collect()] == [4, 3, 3, 3, 3]
    assert table(P.origin_count_distribution(records), "n_origins", "n_keys") == [(1, 2), (2, 1)]
    assert table(P.origin_combinations(records), "origines", "n") == [("a|b", 1)]
    assert table(P.keys_per_origin(records, ["a", "b"]), "origin", "n_keys") == [("(several)", 1), ("a", 2), ("b", 2)]


def test_origin_names_are_compared_whole(spark):
    df = spark.createDataFrame([("ab",), ("a|c",)], "origines string")
    assert table(P.keys_per_origin(df, ["a"]), "origin", "n_keys") == [("(several)", 1), ("a", 1)]


def test_fill_rate_gain(spark):
    before = spark.createDataFrame([("x",), (" ",)], "a string")
    after = spark.createDataFrame([("x", "1"), ("y", None)], "a string, b string")
    assert table(P.fill_rate_gain(before, after, ["a", "b"]), "field", "pct_before", "pct_after", "gain") == [
        ("a", 50.0, 100.0, 50.0),
        ("b", 0.0, 50.0, 50.0),
    ]


def test_score_report(spark):
    df = spark.createDataFrame([(0.2,), (0.4,), (0.8,), (0.9,)], "score_enrichissement double")
    r = P.score_report(df).first()
    assert (r.mean_score, r.n_low, r.n_high, r.median_score) == (pytest.approx(0.575), 2, 2, pytest.approx(0.6))


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 0, 5, 10]] + [(None,)], "v double")
    counts = [r.n for r in P.histogram(df, "v", 4).orderBy("bin").collect()]
    assert counts == list(np.histogram([0, 0, 5, 10], 4)[0])
    same = [r.n for r in P.histogram(df.where("v = 0"), "v", 4).orderBy("bin").collect()]
    assert same == list(np.histogram([0, 0], 4)[0])


def test_rule_overlap(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, False), (None, True)], "a boolean, b boolean")
    assert tuple(P.rule_overlap(df, F.col("a"), F.col("b")).first()) == (2, 2, 1)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,), (None,)], "v double")
    r = P.describe_numbers(df, ["v"]).first()
    assert (r["count"], r["mean"], r["min"], r["median"], r["max"]) == (2, 1.5, 1.0, 1.5, 2.0)


def test_a_value_named_like_the_margin_is_refused(spark):
    df = spark.createDataFrame([("TOTAL", "x"), ("a", "x")], "k string, w string")
    with pytest.raises(Exception, match="holds the value TOTAL"):
        P.cross_table(df, "k", "w").collect()


def test_description_scans_twice(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.uniform(-1, 1), rng.randrange(5), None if i % 3 else float("nan")) for i in range(3000)]
    spark.createDataFrame(rows, "a double, b int, c double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    jobs = []
    original = type(df).first

    def first(self):
        jobs.append(self._jdf.queryExecution().executedPlan().toString().count("FileScan"))
        return original(self)

    type(df).first = first
    try:
        described = P.describe_numbers(df, ["a"])
    finally:
        type(df).first = original
    plan = described._jdf.queryExecution().executedPlan().toString()
    assert jobs == [1] and plan.count("FileScan") == 1
    got = described.collect()[0]
    values = [r[0] for r in rows]
    assert [got.q1, got.median, got.q3] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))


def test_quantiles_of_large_and_repeated_values(spark):
    """More rows than the sketch keeps apart, half of them equal."""
    df = spark.range(400_000).select((F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.hash("id") % 100_003)).cast("double").alias("v"))
    values = np.array([r.v for r in df.collect()])
    probs = [0.0, 0.001, 0.2499, 0.5, 0.7501, 0.99999, 1.0]
    got = {r.prob: r.value for r in P.exact_quantiles(df.repartition(7), ["v"], probs).collect()}
    assert [got[p] for p in probs] == pytest.approx(list(np.quantile(values, probs)))

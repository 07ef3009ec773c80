"""Profiles and stage reports (AGG-09…23, SRT)."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.catalog import roles
from goldrec.catalog.golden import SCORE_SQL, enriched_records
from goldrec.catalog.registry import query
from goldrec.catalog.roles import FORM, NAF, WITH_ROLES, enriched_ctes, golden_ctes, sql_in, table
from goldrec.functions.text import canonical_key, is_blank
from goldrec.operators import joins, profile, quality
from goldrec.operators.filters import legal_form_in
from goldrec.plans import golden
from goldrec.session import stage
from goldrec.sources.footers import footer_facts


def _rounded(df, digits: int, *columns: str):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "agg09_frequency",
    "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1",
)
def _(spark, sf):
    return profile.most_frequent(table(spark, sf, "orders"), "o_orderpriority")


@query(
    "agg10_share",
    """SELECT event_type, count(*) AS n, round(count(*) * 100.0 / (SELECT count(event_type) FROM events), 6)::DOUBLE AS pct
    FROM events WHERE event_type IS NOT NULL GROUP BY 1""",
)
def _(spark, sf):
    return _rounded(profile.frequency_share(table(spark, sf, "events"), "event_type"), 6, "pct")


@query(
    "agg11_distinct_counts",
    "SELECT 'l_suppkey' AS column, count(DISTINCT l_suppkey) AS nunique FROM lineitem "
    "UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey) FROM lineitem "
    "UNION ALL SELECT 'l_orderkey', count(DISTINCT l_orderkey) FROM lineitem",
)
def _(spark, sf):
    return profile.distinct_counts(table(spark, sf, "lineitem"), ["l_suppkey", "l_partkey", "l_orderkey"])


@query("agg11_distinct_list", "SELECT DISTINCT source FROM documents WHERE source IS NOT NULL")
def _(spark, sf):
    return profile.distinct_values(table(spark, sf, "documents"), "source")


_PROFILED = [
    "denominationUniteLegale", "prenom1UniteLegale", "sigleUniteLegale", NAF, FORM, "trancheEffectifsUniteLegale",
]


@query(
    "agg12_null_counts",
    f"WITH {WITH_ROLES} "
    + " UNION ALL ".join(f"SELECT '{c}' AS column, count(*) - count({c}) AS missing FROM registry" for c in _PROFILED),
)
def _(spark, sf):
    return profile.null_counts(roles.registry(spark, sf), _PROFILED)


@query(
    "agg13_column_summary",
    f"WITH {WITH_ROLES} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(DISTINCT {c}) AS nunique, count(*) - count({c}) AS missing, "
        f"round_even((count(*) - count({c})) * 100.0 / count(*), 2)::DOUBLE AS missing_pct FROM registry"
        for c in _PROFILED
    ),
)
def _(spark, sf):
    return profile.column_summary(roles.registry(spark, sf), _PROFILED)


_TEXTS = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@query(
    "agg14_describe_text",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column, count({c}) AS count, count(DISTINCT {c}) AS unique, "
        f"(SELECT CAST({c} AS VARCHAR) FROM orders GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1) AS top, "
        f"(SELECT count(*) FROM orders GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq FROM orders"
        for c in _TEXTS
    ),
)
def _(spark, sf):
    return profile.describe_text(table(spark, sf, "orders"), _TEXTS)


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "agg14_describe_numbers",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        f"min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median, "
        f"round(quantile_cont({c}, 0.75), 6) AS q3, max({c}) AS max FROM lineitem"
        for c in _NUMBERS
    ),
)
def _(spark, sf):
    described = profile.describe_numbers(table(spark, sf, "lineitem"), _NUMBERS)
    return _rounded(_rounded(described, 4, "mean", "std"), 6, "q1", "median", "q3")


@query(
    "agg15_crosstab",
    """SELECT CASE WHEN GROUPING(o_orderstatus) = 1 THEN 'TOTAL' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN GROUPING(o_orderpriority) = 1 THEN 'TOTAL' ELSE o_orderpriority END AS o_orderpriority, count(*) AS n
    FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL
    GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
)
def _(spark, sf):
    return profile.cross_table(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


_STATUSES = ["F", "O", "P"]


@query(
    "agg15_crosstab_wide",
    "SELECT CASE WHEN GROUPING(o_orderpriority) = 1 THEN 'TOTAL' ELSE o_orderpriority END AS o_orderpriority, "
    + ", ".join(f"""count(*) FILTER (WHERE o_orderstatus = '{s}') AS "{s}" """ for s in _STATUSES)
    + """, count(*) AS "TOTAL" FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL
    GROUP BY ROLLUP (o_orderpriority)""",
)
def _(spark, sf):
    return profile.cross_table_wide(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", _STATUSES)


@query(
    "agg15_code_by_family",
    f"""WITH {enriched_ctes()} SELECT CASE WHEN GROUPING(naf) = 1 THEN 'TOTAL' ELSE naf END AS naf,
    CASE WHEN GROUPING(fam) = 1 THEN 'TOTAL' ELSE fam END AS famille_ess, count(*) AS n
    FROM (SELECT naf, coalesce(famille_ess, '(non classé)') AS fam FROM enriched) WHERE naf IS NOT NULL GROUP BY CUBE (naf, fam)""",
)
def _(spark, sf):
    return profile.cross_table(profile.fill_class(enriched_records(spark, sf), "famille_ess"), "naf", "famille_ess")


_CAND3 = "(SELECT siren FROM places)"


@query(
    "agg16_stage_sizes",
    f"""WITH {golden_ctes("cand4")}
    SELECT '1. Candidats' AS step, 'ess_x_naf' AS dataset, count(*) AS n_rows, count(DISTINCT siren) AS n_keys, 5 AS n_columns FROM cand1
    UNION ALL SELECT '1. Candidats', 'cate_x_naf', count(*), count(DISTINCT siren), 10 FROM cand2
    UNION ALL SELECT '1. Candidats', 'tiers_lieux', count(*), count(DISTINCT siren), 9 FROM places
    UNION ALL SELECT '1. Candidats', 'ess_flag_insee', count(*), count(DISTINCT siren), 9 FROM cand4
    UNION ALL SELECT '2. Consolidation', 'x_consolidated', count(*), count(DISTINCT siren), 19 FROM derived""",
)
def _(spark, sf):
    tables = roles.candidate_tables(spark, sf)
    records = golden.consolidate_candidates(tables).drop("conflicts")
    stages = [("1. Candidats", name, df) for name, df in tables.items()]
    return profile.stage_sizes([*stages, ("2. Consolidation", "x_consolidated", records)], "siren")


@query(
    "agg17_funnel",
    f"""WITH {enriched_ctes()}, keys AS (SELECT siren FROM cand1 UNION ALL SELECT siren FROM cand2
      UNION ALL SELECT siren FROM cand4 UNION ALL SELECT {roles.sql_key("siren")} FROM places)
    SELECT '1 candidates, raw' AS step, count(*) AS n FROM keys
    UNION ALL SELECT '2 candidates, distinct keys', count(DISTINCT siren) FROM keys
    UNION ALL SELECT '3 consolidated', count(*) FROM derived
    UNION ALL SELECT '4 enriched', count(*) FROM enriched
    UNION ALL SELECT '5 exported', count(*) FROM enriched""",
)
def _(spark, sf):
    tables = roles.candidate_tables(spark, sf)
    records = stage(golden.consolidate_candidates(tables).drop("conflicts"), "consolidated")
    enriched = stage(golden.enrich_records(records, roles.periods(spark, sf)), "enriched")
    keyed = [df.select(canonical_key(F.col("siren")).alias("siren")) for df in tables.values()]
    return profile.funnel(keyed, records, enriched, golden.export_records(enriched), "siren")


def _consolidated(spark, sf):
    return golden.consolidate_candidates(roles.candidate_tables(spark, sf))


@query(
    "agg18_origin_counts",
    f"""WITH {golden_ctes("cand4")} SELECT len(string_split(origines, '|'))::INT AS n_origins, count(*) AS n_keys
    FROM records GROUP BY 1""",
)
def _(spark, sf):
    return profile.origin_count_distribution(_consolidated(spark, sf))


@query(
    "agg18_origin_combinations",
    f"""WITH {golden_ctes("cand4")} SELECT origines, count(*) AS n FROM records WHERE contains(origines, '|') GROUP BY 1""",
)
def _(spark, sf):
    return profile.origin_combinations(_consolidated(spark, sf))


@query(
    "agg18_keys_per_origin",
    f"WITH {golden_ctes('cand4')} "
    + " UNION ALL ".join(
        f"SELECT '{o}' AS origin, count(*) FILTER (WHERE list_contains(string_split(origines, '|'), '{o}')) AS n_keys FROM records"
        for o in vocab.ORIGINS
    )
    + " UNION ALL SELECT '(several)', count(*) FILTER (WHERE contains(origines, '|')) FROM records",
)
def _(spark, sf):
    return profile.keys_per_origin(_consolidated(spark, sf), vocab.ORIGINS)


def _rate(column: str | None, source: str) -> str:
    if column is None:
        return "0.0"
    return rf"(SELECT avg(CASE WHEN regexp_matches(CAST({column} AS VARCHAR), '\S') THEN 1 ELSE 0 END) * 100.0 FROM {source})"


_BEFORE = {"denomination", "naf", "categorie_juridique", "famille_ess", "tranche_effectifs", "code_postal", "commune", "site_web"}


@query(
    "agg19_fill_rate_gain",
    f"WITH {enriched_ctes()} "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS field, round({_rate(f if f in _BEFORE else None, 'derived')}, 6)::DOUBLE AS pct_before, "
        f"round({_rate(f, 'enriched')}, 6)::DOUBLE AS pct_after, "
        f"round({_rate(f, 'enriched')} - {_rate(f if f in _BEFORE else None, 'derived')}, 6)::DOUBLE AS gain"
        for f in vocab.FILL_RATE_FIELDS
    ),
)
def _(spark, sf):
    records = stage(_consolidated(spark, sf).drop("conflicts"), "consolidated")
    enriched = golden.enrich_records(records, roles.periods(spark, sf), ties=("nicSiegeUniteLegale",))
    gains = profile.fill_rate_gain(records, enriched, vocab.FILL_RATE_FIELDS)
    return _rounded(gains, 6, "pct_before", "pct_after", "gain")


def _scores(spark, sf):
    return stage(quality.completeness(enriched_records(spark, sf)).select("siren", "score_enrichissement"), "scores")


_WITH_SCORES = f"WITH {enriched_ctes()}, scores AS (SELECT siren, {SCORE_SQL} AS s FROM enriched)"


@query(
    "agg20_score_report",
    f"""{_WITH_SCORES} SELECT round(avg(s), 6) AS mean_score, count(*) FILTER (WHERE s < 0.5) AS n_low,
    count(*) FILTER (WHERE s >= 0.8) AS n_high, round(quantile_cont(s, 0.5), 6) AS median_score FROM scores""",
)
def _(spark, sf):
    return _rounded(profile.score_report(_scores(spark, sf)), 6, "mean_score", "median_score")


_HISTOGRAM = """WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
    h AS (SELECT least(floor((l_extendedprice - lo) / ((hi - lo) / 20)), 19)::INT AS bin, count(*) AS n FROM lineitem, b GROUP BY 1)
    SELECT r.bin::INT AS bin, round(lo + r.bin * (hi - lo) / 20, 4) AS lower, round(lo + (r.bin + 1) * (hi - lo) / 20, 4) AS upper,
      coalesce(h.n, 0) AS n FROM range(20) r(bin) CROSS JOIN b LEFT JOIN h ON h.bin = r.bin"""


@query("agg21_histogram", _HISTOGRAM)
def _(spark, sf):
    return _rounded(profile.histogram(table(spark, sf, "lineitem"), "l_extendedprice"), 4, "lower", "upper")


@query("agg21_histogram_from_footers", _HISTOGRAM)
def _(spark, sf):
    """Minimum and maximum come from the footers, so the column is scanned once."""
    _, facts, _ = footer_facts(spark, f"{sf}/lineitem.parquet", ["l_extendedprice"])
    return _rounded(profile.histogram(table(spark, sf, "lineitem"), "l_extendedprice", extremes=facts["l_extendedprice"][1:]), 4, "lower", "upper")


@query("src11_footers", "SELECT count(*) AS n_rows, count(o_custkey) AS n_values, min(o_custkey) AS low, max(o_custkey) AS high FROM orders")
def _(spark, sf):
    """Size and key range of a table from its footers alone."""
    rows, facts, _ = footer_facts(spark, f"{sf}/orders.parquet", ["o_custkey"])
    return spark.createDataFrame([(rows, *facts["o_custkey"])], "n_rows long, n_values long, low long, high long")


_TARGETS = [t for _, t, _ in vocab.ENRICH_FIELDS] + ["siret_siege"]


@query(
    "agg22_fill_counts",
    f"WITH {enriched_ctes()}, c AS ("
    + " UNION ALL ".join(f"SELECT '{t}' AS field, count({t}_enrich_source) AS n_filled FROM enriched" for t in _TARGETS)
    + ") SELECT * FROM c UNION ALL SELECT 'TOTAL', sum(n_filled)::BIGINT FROM c",
)
def _(spark, sf):
    from goldrec.operators.enrich import fill_counts

    return fill_counts(enriched_records(spark, sf), _TARGETS)


@query(
    "agg23_rule_overlap",
    f"""WITH {WITH_ROLES}, f AS (SELECT {sql_in(FORM, vocab.SOCIAL_LEGAL_FORMS)} AS a, siren IN (SELECT k FROM list_b) AS b FROM registry)
    SELECT count(*) FILTER (WHERE a) AS n_first, count(*) FILTER (WHERE b) AS n_second, count(*) FILTER (WHERE a AND b) AS n_both FROM f""",
)
def _(spark, sf):
    rows = joins.flag_listed(
        roles.registry(spark, sf).select("siren", FORM), roles.list_b(spark, sf), "siren", "listed", "key"
    )
    return profile.rule_overlap(rows, legal_form_in(FORM, vocab.SOCIAL_LEGAL_FORMS), F.col("listed"))


@query(
    "srt01_by_missing",
    f"WITH {WITH_ROLES} SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column, count(*) - count({c}) AS missing FROM registry" for c in _PROFILED)
    + ") ORDER BY 2 DESC, 1",
)
def _(spark, sf):
    return profile.null_counts(roles.registry(spark, sf), _PROFILED).orderBy(F.desc("missing"), "column")


@query(
    "srt02_top_codes",
    "SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 15",
)
def _(spark, sf):
    return profile.top_values(table(spark, sf, "lineitem"), "l_partkey", 15)


@query(
    "agg19_blank_share",
    f"""WITH {WITH_ROLES} SELECT {NAF} AS naf, round(avg(CASE WHEN {roles.sql_blank("trancheEffectifsUniteLegale")}
    THEN 0 ELSE 1 END) * 100.0, 6)::DOUBLE AS pct FROM periods GROUP BY 1""",
)
def _(spark, sf):
    filled = F.avg((~is_blank(F.col("trancheEffectifsUniteLegale"))).cast("int")) * 100.0
    return roles.periods(spark, sf).groupBy(F.col(NAF).alias("naf")).agg(F.round(filled, 6).alias("pct"))

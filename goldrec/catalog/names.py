"""Name matching and the survey candidates (MATCH, SRT-03, PIPE-03)."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.catalog import roles
from goldrec.catalog.golden import SCORE_SQL
from goldrec.catalog.registry import query
from goldrec.catalog.roles import WITH_ROLES, sql_norm
from goldrec.catalog.rows import truthy_sql
from goldrec.functions.text import normalize_name
from goldrec.operators import matching, nameindex
from goldrec.plans import candidates, golden

_INDEX = f"""{WITH_ROLES},
index_rows AS (
  SELECT {sql_norm('"denominationUniteLegale"')} AS norm, siren, 0 AS i FROM names WHERE "etatAdministratifUniteLegale" = 'A'
  UNION ALL
  SELECT {sql_norm('"sigleUniteLegale"')}, siren, 1 FROM names WHERE "etatAdministratifUniteLegale" = 'A'),
idx AS (SELECT norm, arg_min(siren, siren || i) AS siren, min(siren || i) AS ord FROM index_rows WHERE norm <> '' GROUP BY norm)
"""

# similarity of token-sorted names: one row of bits per pair, one step per letter
_FUZZY = f"""{_INDEX},
asked AS (SELECT "ID_UNIQUE", {sql_norm('"NOM"')} AS m, {sql_norm('"NOM_STRC_PORT"')} AS a, * EXCLUDE ("ID_UNIQUE") FROM identity),
exact AS (
  SELECT q.*, x1.siren AS k1, CASE WHEN x1.siren IS NULL THEN x2.siren END AS k2
  FROM asked q LEFT JOIN idx x1 ON q.m = x1.norm LEFT JOIN idx x2 ON q.a = x2.norm),
texts AS (SELECT DISTINCT unnest([m, a]) AS t FROM exact WHERE k1 IS NULL AND k2 IS NULL),
pairs AS (
  SELECT t, norm, siren, ord, list_aggregate(list_sort(string_split(t, ' ')), 'string_agg', ' ') AS p,
         list_aggregate(list_sort(string_split(norm, ' ')), 'string_agg', ' ') AS q
  FROM texts, idx WHERE t <> ''),
distinct_pairs AS (SELECT DISTINCT p, q FROM pairs),
bits(p, q, pos, v) AS (
  SELECT p, q, 0, (1::BIGINT << length(p)) - 1 FROM distinct_pairs
  UNION ALL
  SELECT p, q, pos + 1, ((v + (v & m)) | (v - (v & m))) & ((1::BIGINT << length(p)) - 1)
  FROM (SELECT p, q, pos, v,
          coalesce(list_sum([CASE WHEN p[k] = q[pos + 1] THEN 1::BIGINT << (k - 1) ELSE 0 END
                             FOR k IN range(1, length(p) + 1)]), 0)::BIGINT AS m
        FROM bits WHERE pos < length(q))),
scored AS (
  SELECT p, q, (1.0 - (length(p) + length(q) - 2 * (length(p) - bit_count(v)))::DOUBLE / (length(p) + length(q))) * 100 AS score
  FROM bits WHERE pos = length(q)),
best AS (
  SELECT t, max(score) AS score, arg_min(siren, (-score, ord)) AS siren
  FROM pairs JOIN scored USING (p, q) WHERE score >= 80 GROUP BY t),
resolved AS (
  SELECT e.*, b1.score AS s1, b2.score AS s2,
         CASE WHEN b1.score IS NULL OR b2.score > b1.score THEN b2.siren ELSE b1.siren END AS k3,
         CASE WHEN b1.score IS NULL OR b2.score > b1.score THEN b2.score ELSE b1.score END AS s3
  FROM exact e LEFT JOIN best b1 ON e.m = b1.t AND k1 IS NULL AND k2 IS NULL
               LEFT JOIN best b2 ON e.a = b2.t AND k1 IS NULL AND k2 IS NULL),
matched AS (
  SELECT *, coalesce(k1, k2, k3) AS siren,
         CASE WHEN k1 IS NOT NULL THEN 1.0 WHEN k2 IS NOT NULL THEN 0.9 ELSE round(s3 / 100, 2) END::DOUBLE AS confiance_jointure,
         CASE WHEN k1 IS NOT NULL THEN 1 WHEN k2 IS NOT NULL THEN 2 WHEN k3 IS NOT NULL THEN 3 END AS match_pass
  FROM resolved)
"""


def _identity(spark, sf):
    return roles.role(spark, sf, "part", roles.IDENTITY)


def _index(spark, sf):
    names = roles.role(spark, sf, "part", roles.NAMES)
    active = F.col("etatAdministratifUniteLegale") == "A"
    return matching.build_name_index(names, "siren", ["denominationUniteLegale", "sigleUniteLegale"], active)


@query("match01_name_index", f"WITH {_INDEX} SELECT norm, siren AS key FROM idx")
def _(spark, sf):
    return _index(spark, sf).select("norm", "key")


@query(
    "match02_exact_main",
    f"""WITH RECURSIVE {_INDEX} SELECT q."ID_UNIQUE", q."NOM", x.siren, 1.0::DOUBLE AS confiance_jointure
    FROM identity q JOIN idx x ON {sql_norm('q."NOM"')} = x.norm""",
)
def _(spark, sf):
    rows = _identity(spark, sf).select("ID_UNIQUE", "NOM")
    resolved = matching.resolve_by_name(rows, _index(spark, sf), alt_name=None, fuzzy=False)
    found = resolved.where("match_pass = 1")
    return found.select("ID_UNIQUE", "NOM", "siren", "confiance_jointure")


@query(
    "match03_exact_alternative",
    f"""WITH RECURSIVE {_FUZZY} SELECT "ID_UNIQUE", "NOM", "NOM_STRC_PORT", coalesce(k1, k2) AS siren,
    CASE WHEN k1 IS NOT NULL THEN 1.0 WHEN k2 IS NOT NULL THEN 0.9 END::DOUBLE AS confiance_jointure FROM exact""",
)
def _(spark, sf):
    rows = _identity(spark, sf).select("ID_UNIQUE", "NOM", "NOM_STRC_PORT")
    resolved = matching.resolve_by_name(rows, _index(spark, sf), fuzzy=False)
    return resolved.select("ID_UNIQUE", "NOM", "NOM_STRC_PORT", "siren", "confiance_jointure")


@query(
    "match04_fuzzy",
    f"""WITH RECURSIVE {_FUZZY} SELECT "ID_UNIQUE", "NOM", "NOM_STRC_PORT", siren, confiance_jointure, match_pass FROM matched""",
)
def _(spark, sf):
    rows = _identity(spark, sf).select("ID_UNIQUE", "NOM", "NOM_STRC_PORT")
    resolved = matching.resolve_by_name(rows, _index(spark, sf))
    return resolved.select("ID_UNIQUE", "NOM", "NOM_STRC_PORT", "siren", "confiance_jointure", "match_pass")


@query(
    "match04_stored_index",
    f"""WITH RECURSIVE {_FUZZY} SELECT "ID_UNIQUE", "NOM", "NOM_STRC_PORT", siren, confiance_jointure, match_pass FROM matched""",
)
def _(spark, sf):
    """The index is stored once, bucketed by gram pair, and looked up where it lies."""
    index = _index(spark, sf)
    rows = _identity(spark, sf).select("ID_UNIQUE", "NOM", "NOM_STRC_PORT")
    resolved = matching.resolve_by_name(rows, index, lookup=nameindex.store_index(index).lookup)
    return resolved.select("ID_UNIQUE", "NOM", "NOM_STRC_PORT", "siren", "confiance_jointure", "match_pass")


@query(
    "match05_cascade",
    f"""WITH RECURSIVE {_FUZZY} SELECT "ID_UNIQUE", siren, confiance_jointure,
    CASE WHEN match_pass IS NOT NULL THEN 'scoring' END AS methode_jointure FROM matched""",
)
def _(spark, sf):
    resolved = matching.resolve_by_name(_identity(spark, sf), _index(spark, sf))
    return resolved.select("ID_UNIQUE", "siren", "confiance_jointure", "methode_jointure")


@query(
    "match06_summary",
    f"WITH RECURSIVE {_FUZZY} SELECT coalesce(match_pass, 0) AS match_pass, count(*) AS n FROM matched GROUP BY 1",
)
def _(spark, sf):
    rows = _identity(spark, sf).select("ID_UNIQUE", "NOM", "NOM_STRC_PORT")
    return matching.match_summary(matching.resolve_by_name(rows, _index(spark, sf)))


@query(
    "srt03_best_per_name",
    f"WITH RECURSIVE {_FUZZY} SELECT t AS text, round(score, 6) AS score, siren AS key FROM best",
)
def _(spark, sf):
    """Best entry of every distinct name that no exact pass resolves."""
    index = _index(spark, sf)
    rows = _identity(spark, sf).select("ID_UNIQUE", "NOM", "NOM_STRC_PORT")
    missed = matching.resolve_by_name(rows, index, fuzzy=False).where("match_pass IS NULL")
    names = F.explode(F.array(normalize_name(F.col("NOM")), normalize_name(F.col("NOM_STRC_PORT"))))
    texts = missed.select(names.alias("text")).where("text != ''").distinct()
    return matching.fuzzy_lookup(texts, index).withColumn("score", F.round("score", 6))


def surveyed(spark, sf):
    return candidates.surveyed_places(
        roles.role(spark, sf, "part", roles.ACTIVITIES), _identity(spark, sf), roles.role(spark, sf, "part", roles.NAMES)
    )


_DIGITAL = " AND ".join(truthy_sql(f'"{c}"') for c in vocab.DIGITAL_SURVEY_FLAGS)


@query(
    "pipe03_surveyed_candidates",
    f"""WITH RECURSIVE {_FUZZY} SELECT "ID_UNIQUE", "NOM", "NOM_STRC_PORT", "CODPOST", "VILLE", "INTERNET", siren,
    confiance_jointure, 'scoring' AS methode_jointure, 'tiers_lieux' AS sources
    FROM matched WHERE "ID_UNIQUE" IN (SELECT "ID_UNIQUE" FROM activities WHERE {_DIGITAL})""",
)
def _(spark, sf):
    return surveyed(spark, sf)


def _full_chain_sql() -> str:
    survey = f""" {_FUZZY}, survey AS (
      SELECT siren, "NOM", "NOM_STRC_PORT", "CODPOST", "VILLE", "INTERNET", confiance_jointure, 'tiers_lieux' AS sources,
             'scoring' AS methode_jointure, CAST("ID_UNIQUE" AS BIGINT) AS place
      FROM matched WHERE "ID_UNIQUE" IN (SELECT "ID_UNIQUE" FROM activities WHERE {_DIGITAL}))
    """
    ctes = roles.enriched_ctes().replace(WITH_ROLES, survey).replace("FROM places", "FROM survey")
    ctes = ctes.replace("'tiers_lieux' AS origin, 3 AS rk, 0 AS rw", "'tiers_lieux' AS origin, 3 AS rk, place AS rw")
    columns = [c for c in vocab.EXPORT_COLUMNS if c != "score_enrichissement"]
    return f"WITH RECURSIVE {ctes} SELECT {', '.join(columns)}, {SCORE_SQL} AS score_enrichissement FROM enriched"


@query("chain_export", _full_chain_sql())
def full_chain(spark, sf):
    """Candidates with names resolved, consolidation, enrichment and export in one go."""
    tables = roles.candidate_tables(spark, sf)
    tables["tiers_lieux"] = surveyed(spark, sf).withColumn("_row", F.col("ID_UNIQUE").cast("long"))
    records = golden.consolidate_candidates(tables, row_order="_row").drop("conflicts")
    enriched = golden.enrich_records(records, roles.periods(spark, sf), ties=("nicSiegeUniteLegale",))
    return golden.export_records(enriched)

"""The tables at hand in the roles the operators expect.

Each role is a projection of a whole table. Its expressions are valid in Spark
SQL and in the SQL of the checks alike, so both sides start from equal rows.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.operators.filters import normalize_candidate
from goldrec.operators.consolidate import union_all
from goldrec.plans import candidates as plans


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _case(column: str, values: dict, otherwise: str = "NULL") -> str:
    branches = " ".join(f"WHEN {k!r} THEN '{v}'" for k, v in values.items())
    return f"CASE {column} {branches} ELSE {otherwise} END"


def _padded(column: str, width: int = 9) -> str:
    return f"lpad(CAST({column} AS STRING), {width}, '0')"


FORMS = [*vocab.SOCIAL_LEGAL_FORMS, "5710", "5499", "1000", "7210", "9999"]
SEGMENT_NAF = {"AUTOMOBILE": "62.01Z", "BUILDING": "62.02A", "FURNITURE": "58.29C", "HOUSEHOLD": "94.99Z"}
PRIORITY_NAF = {"1-URGENT": "62.01Z", "2-HIGH": "62.03Z", "3-MEDIUM": "63.12Z", "4-NOT SPECIFIED": "01.11Z"}
PRIORITY_FORM = {"1-URGENT": "9220", "2-HIGH": "5458.0", "3-MEDIUM": "8210", "4-NOT SPECIFIED": "text"}

REGISTRY = {
    "siren": _padded("c_custkey"),
    "denominationUniteLegale": "CASE WHEN c_acctbal >= 1000 THEN c_name END",
    "nomUniteLegale": "upper(c_name)",
    "prenom1UniteLegale": "CASE WHEN c_acctbal < 3000 THEN c_mktsegment END",
    "sigleUniteLegale": "CASE WHEN c_acctbal >= 7000 THEN 'C' || CAST(c_custkey AS STRING) END",
    "activitePrincipaleUniteLegale": _case("c_mktsegment", SEGMENT_NAF, "'01.11Z'"),
    "categorieJuridiqueUniteLegale": _case("c_nationkey", dict(enumerate(FORMS))),
    "trancheEffectifsUniteLegale": "CASE WHEN c_acctbal >= 0 THEN "
    "lpad(CAST(CAST(floor(c_acctbal / 1000) AS BIGINT) AS STRING), 2, '0') END",
    "economieSocialeSolidaireUniteLegale": "CASE WHEN c_acctbal > 4000 THEN 'O' ELSE 'N' END",
    "etatAdministratifUniteLegale": "CASE WHEN c_acctbal >= 0 THEN 'A' ELSE 'C' END",
}

# a later snapshot of the registry, in which richer companies changed name and staff
REGISTRY_LATER = {
    **REGISTRY,
    "denominationUniteLegale": "CASE WHEN c_acctbal > 6000 THEN 'SCOP ' || c_name ELSE c_name END",
    "trancheEffectifsUniteLegale": "CASE WHEN c_acctbal > 8000 THEN '31' ELSE ' ' END",
}

PERIODS = {
    "siren": _padded("o_custkey"),
    "dateDebut": "CASE WHEN o_orderstatus = 'P' THEN 'inconnue' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "nicSiegeUniteLegale": "CASE WHEN o_orderkey < 10000 THEN lpad(CAST(o_orderkey AS STRING), 5, '0') "
    "ELSE CAST(o_orderkey AS STRING) END",
    "activitePrincipaleUniteLegale": _case("o_orderpriority", PRIORITY_NAF),
    "categorieJuridiqueUniteLegale": _case("o_orderpriority", PRIORITY_FORM),
    "trancheEffectifsUniteLegale": "CASE WHEN o_totalprice > 100000 THEN '12' ELSE '  ' END",
    "denominationUniteLegale": "'Company ' || CAST(o_custkey AS STRING)",
    "nomUniteLegale": "CASE WHEN o_totalprice > 300000 THEN 'DURAND' END",
    "sigleUniteLegale": "CASE WHEN o_totalprice > 400000 THEN 'CO' || CAST(o_custkey AS STRING) END",
    "dateCreationUniteLegale": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "etatAdministratifUniteLegale": "CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN ' C ' ELSE '' END",
    "identifiantAssociationUniteLegale": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'W' || "
    + _padded("o_orderkey")
    + " END",
    "economieSocialeSolidaireUniteLegale": "CASE WHEN o_totalprice > 250000 THEN 'O' ELSE 'N' END",
    "caractereEmployeurUniteLegale": "CASE WHEN o_totalprice > 200000 THEN 'O' ELSE 'N' END",
    "categorieEntreprise": "CASE WHEN o_totalprice > 450000 THEN 'GE' WHEN o_totalprice > 350000 THEN 'ETI' ELSE 'PME' END",
    "societeMissionUniteLegale": "CASE WHEN o_totalprice < 50000 THEN 'O' END",
    "anneeEffectifsUniteLegale": "CAST(year(o_orderdate) AS STRING)",
}

# many rows per key: a candidate table with repeats
HISTORY = {
    "siren": _padded("o_custkey"),
    "denominationUniteLegale": "CASE WHEN o_totalprice > 480000 THEN ' Renamed ' || CAST(o_custkey AS STRING) "
    "WHEN o_totalprice > 100000 THEN 'Company ' || CAST(o_custkey AS STRING) ELSE '' END",
    "nomUniteLegale": "CASE WHEN o_totalprice > 300000 THEN 'DURAND' END",
    "activitePrincipaleUniteLegale": _case("o_orderpriority", PRIORITY_NAF),
    "categorieJuridiqueUniteLegale": _case("o_orderpriority", PRIORITY_FORM),
    "trancheEffectifsUniteLegale": "CASE WHEN o_totalprice > 100000 THEN '12' ELSE '  ' END",
    "sources": "CASE WHEN o_orderstatus = 'O' THEN 'sirene|esus' WHEN o_orderstatus = 'F' THEN 'sirene' END",
    "methode_jointure": "CASE WHEN o_orderpriority = '5-LOW' THEN 'scraping' WHEN o_orderpriority = '2-HIGH' THEN 'api_sirene' "
    "WHEN o_orderpriority = '3-MEDIUM' THEN 'guess' END",
    "_row": "o_orderkey",
}

LIST_A = {"SIREN": "CAST(o_custkey AS STRING)"}
LIST_A_ROWS = "o_orderpriority = '1-URGENT'"
LIST_B = {"key": "CAST(o_custkey AS STRING) || '.0'"}
LIST_B_ROWS = "o_totalprice > 450000"

# places that already carry a resolved key, as the survey candidates do
PLACES = {
    "siren": "CAST(s_suppkey AS STRING) || '.0'",
    "NOM": "s_name",
    "NOM_STRC_PORT": "CASE WHEN s_acctbal > 3000 THEN 'Port ' || s_name END",
    "CODPOST": "'75' || lpad(CAST(s_nationkey AS STRING), 3, '0')",
    "VILLE": "CASE WHEN s_nationkey > 12 THEN 'Lille' ELSE ' Paris ' END",
    "INTERNET": "'https://www.' || lower(replace(s_name, '#', '')) || '.fr/accueil'",
    "confiance_jointure": "CASE WHEN s_acctbal > 5000 THEN 0.9 WHEN s_acctbal > 0 THEN 0.82 END",
    "sources": "'tiers_lieux'",
    "methode_jointure": "'scoring'",
}

_FLAG = "CASE WHEN {0} THEN '{1}' WHEN {2} THEN NULL ELSE '{3}' END"
ACTIVITIES = {
    "ID_UNIQUE": "CAST(p_partkey AS STRING)",
    "TYPE_ACT_NUMER": _FLAG.format("p_size > 4", "1", "p_size > 2", "0"),
    "PROD_NUMER": _FLAG.format("p_size < 49", "True", "p_size = 49", "False"),
    "THEME_FORM_NUMER": _FLAG.format("p_retailprice < 990", "1.0", "p_retailprice < 995", "0.0"),
    "THEME_FORM_INFOR": "'oui'",
    "THEME_FORM_PROGRAM": _FLAG.format("p_size <> 17", "1", "p_retailprice < 950", "0"),
    "OFFRE_NUM_FABR": "CAST(p_size AS STRING)",
    "OFFRE_NUM_INCLU": "CAST(NULL AS STRING)",
    "OFFRE_NUM_MENUM": _FLAG.format("p_size <> 23", "true", "p_retailprice < 950", " false "),
    "EQPT_NUM": "'1'",
}
IDENTITY = {
    "ID_UNIQUE": "CAST(p_partkey AS STRING)",
    "NOM": "CASE p_type WHEN 'ECONOMY' THEN p_name WHEN 'LARGE' THEN upper(p_name) || ' !' "
    "WHEN 'MEDIUM' THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) "
    "WHEN 'PROMO' THEN substr(p_name, 2) WHEN 'STANDARD' THEN p_brand ELSE p_name || 's' END",
    "NOM_STRC_PORT": "CASE WHEN p_type = 'STANDARD' AND p_size <= 30 THEN p_name "
    "WHEN p_type = 'PROMO' AND p_size > 40 THEN p_name || ' x' END",
    "CODPOST": "'75' || lpad(CAST(p_size AS STRING), 3, '0')",
    "VILLE": "p_brand",
    "INTERNET": "'https://www.' || lower(p_type) || '.fr'",
}
NAMES = {
    "siren": _padded("p_partkey"),
    "denominationUniteLegale": "p_name",
    "sigleUniteLegale": "CASE WHEN p_size = 50 THEN p_brand END",
    "etatAdministratifUniteLegale": "CASE WHEN p_size >= 3 THEN 'A' ELSE 'C' END",
}

PROJECTS = {
    "title": "'Project ' || CAST(page_id AS STRING)",
    "website": "url",
    "Category": "CASE WHEN url LIKE 'https%' THEN 'secure, web' ELSE 'web' END",
    "Project": "'P' || CAST(page_id AS STRING)",
    "Country": "CASE WHEN url LIKE '%/fr/%' THEN 'FRANCE, Italy' WHEN url LIKE '%/de/%' THEN 'Germany' "
    "WHEN url LIKE '%/es/%' THEN 'Spain; france' END",
}


def role(spark: SparkSession, sf: str, name: str, columns: dict[str, str], rows: str | None = None) -> DataFrame:
    source = table(spark, sf, name)
    return (source.where(rows) if rows else source).selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def role_sql(name: str, columns: dict[str, str], rows: str | None = None) -> str:
    exprs = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
    return f"SELECT {exprs} FROM {name}" + (f" WHERE {rows}" if rows else "")


def registry(spark, sf):
    return role(spark, sf, "customer", REGISTRY)


def registry_later(spark, sf):
    return role(spark, sf, "customer", REGISTRY_LATER)


def periods(spark, sf):
    return role(spark, sf, "orders", PERIODS)


def list_a(spark, sf):
    return role(spark, sf, "orders", LIST_A, LIST_A_ROWS)


def list_b(spark, sf):
    return role(spark, sf, "orders", LIST_B, LIST_B_ROWS)


def places(spark, sf):
    return role(spark, sf, "supplier", PLACES)


def candidate_tables(spark, sf) -> dict[str, DataFrame]:
    """The four candidate tables, one row per key in each."""
    first = registry(spark, sf)
    return {
        "ess_x_naf": plans.listed_with_digital_code(first, list_a(spark, sf)),
        "cate_x_naf": plans.social_form_or_approved(first, list_b(spark, sf)),
        "tiers_lieux": places(spark, sf),
        "ess_flag_insee": plans.flagged_with_digital_code(registry_later(spark, sf)),
    }


def golden_input(spark, sf) -> DataFrame:
    """Candidate rows before consolidation, the last origin with many rows per key."""
    tables = candidate_tables(spark, sf)
    tables["ess_flag_insee"] = role(spark, sf, "orders", HISTORY)
    shaped = [
        normalize_candidate(df, origin, vocab.ORIGIN_RENAMES[origin], {"_row": 0})
        for origin, df in tables.items()
    ]
    return union_all([df.withColumn("_row", F.col("_row").cast("long")) for df in shaped])


# -- the same in SQL ---------------------------------------------------------------


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_key(x: str, width: int = 9) -> str:
    k = f"split_part({sql_strip(x)}, '.', 1)"
    return f"CASE WHEN length({k}) < {width} THEN lpad({k}, {width}, '0') ELSE {k} END"


def sql_blank(x: str) -> str:
    return rf"({x} IS NULL OR NOT regexp_matches({x}, '\S'))"


def sql_value(x: str) -> str:
    return f"CASE WHEN NOT {sql_blank(x)} THEN {sql_strip(x)} END"


def sql_code(x: str) -> str:
    return f"CAST(CAST(trunc(try_cast({x} AS DOUBLE)) AS BIGINT) AS VARCHAR)"


def sql_lookup(mapping: dict[str, str], x: str) -> str:
    return _case(f"({x})", mapping)


def sql_in(x: str, codes: list[str]) -> str:
    return f"coalesce({x} IN ({', '.join(repr(c) for c in codes)}), false)"


def sql_norm(x: str) -> str:
    spelled = reduce(lambda s, p: f"replace({s}, '{p[0]}', '{p[1]}')", {"ß": "ss", "œ": "oe", "æ": "ae"}.items(), x)
    return f"coalesce(trim(regexp_replace(lower(strip_accents({spelled})), '[^a-z0-9]+', ' ', 'g')), '')"


NAF, FORM = "activitePrincipaleUniteLegale", "categorieJuridiqueUniteLegale"

WITH_ROLES = f"""
registry AS ({role_sql("customer", REGISTRY)}),
registry_later AS ({role_sql("customer", REGISTRY_LATER)}),
periods AS ({role_sql("orders", PERIODS)}),
history AS ({role_sql("orders", HISTORY)}),
list_a AS (SELECT DISTINCT {sql_key('"SIREN"')} AS k FROM ({role_sql("orders", LIST_A, LIST_A_ROWS)})),
list_b AS (SELECT DISTINCT {sql_key('"key"')} AS k FROM ({role_sql("orders", LIST_B, LIST_B_ROWS)})),
places AS ({role_sql("supplier", PLACES)}),
activities AS ({role_sql("part", ACTIVITIES)}),
identity AS ({role_sql("part", IDENTITY)}),
names AS ({role_sql("part", NAMES)}),
projects AS ({role_sql("pages", PROJECTS)})
"""

WITH_CANDIDATES = f"""{WITH_ROLES},
cand1 AS (
  SELECT siren, denominationUniteLegale, {NAF},
         'ess_france|sirene' AS sources, 'siren_direct' AS methode_jointure
  FROM registry WHERE {sql_in(NAF, vocab.DIGITAL_NAF)} AND siren IN (SELECT k FROM list_a)),
cand2 AS (
  SELECT siren, denominationUniteLegale, nomUniteLegale, {NAF}, trancheEffectifsUniteLegale, {FORM},
         {sql_lookup(vocab.NAF_TIER, NAF)} AS group_naf, {sql_lookup(vocab.LEGAL_FORM_TIER, FORM)} AS group_cate,
         CASE WHEN siren IN (SELECT k FROM list_b) THEN 'esus|sirene' ELSE 'sirene' END AS sources,
         'siren_direct' AS methode_jointure
  FROM registry
  WHERE {sql_in(NAF, vocab.DIGITAL_NAF)}
    AND ({sql_in(FORM, vocab.SOCIAL_LEGAL_FORMS)} OR siren IN (SELECT k FROM list_b))),
cand4 AS (
  SELECT siren, denominationUniteLegale, nomUniteLegale, {NAF}, {FORM}, trancheEffectifsUniteLegale,
         economieSocialeSolidaireUniteLegale, 'sirene' AS sources, 'siren_direct' AS methode_jointure
  FROM registry_later
  WHERE economieSocialeSolidaireUniteLegale = 'O' AND {sql_in(NAF, vocab.DIGITAL_NAF)})
"""

_SHAPE = """
  SELECT {key} AS siren, '{origin}' AS origin, {rank} AS rk, {row} AS rw, {sources} AS sources,
         {method} AS methode_jointure, {confidence} AS confiance_jointure,
         {denomination} AS denomination, {nom} AS nom_usage, {naf} AS naf, {cp} AS code_postal,
         {ville} AS commune, {site} AS site_web, {staff} AS tranche_effectifs, {form} AS categorie_juridique,
         {port} AS nom_structure_porteuse, {gn} AS group_naf, {gc} AS group_cate
  FROM {source}"""
_NULLS = dict.fromkeys(
    ["denomination", "nom", "naf", "cp", "ville", "site", "staff", "form", "port", "gn", "gc", "confidence"],
    "NULL",
)
_REGISTRY_SHAPE = {
    **_NULLS,
    "key": "siren",
    "row": "0",
    "sources": "sources",
    "method": "methode_jointure",
    "confidence": "CAST(NULL AS DOUBLE)",
    "denomination": "denominationUniteLegale",
    "naf": NAF,
}
_WIDE_SHAPE = {
    **_REGISTRY_SHAPE,
    "nom": "nomUniteLegale",
    "staff": "trancheEffectifsUniteLegale",
    "form": FORM,
}
_PLACE_SHAPE = {
    **_NULLS,
    "key": sql_key("siren"),
    "row": "0",
    "sources": "sources",
    "method": "methode_jointure",
    "confidence": "CAST(confiance_jointure AS DOUBLE)",
    "denomination": '"NOM"',
    "cp": '"CODPOST"',
    "ville": '"VILLE"',
    "site": '"INTERNET"',
    "port": '"NOM_STRC_PORT"',
}


def _golden(last: str) -> str:
    shapes = [
        _SHAPE.format(**_REGISTRY_SHAPE, origin="ess_x_naf", rank=1, source="cand1"),
        _SHAPE.format(
            **{**_WIDE_SHAPE, "gn": "group_naf", "gc": "group_cate"}, origin="cate_x_naf", rank=2, source="cand2"
        ),
        _SHAPE.format(**_PLACE_SHAPE, origin="tiers_lieux", rank=3, source="places"),
        _SHAPE.format(
            **{**_WIDE_SHAPE, "row": "_row" if last == "history" else "0"},
            origin="ess_flag_insee",
            rank=4,
            source=last,
        ),
    ]
    return " UNION ALL ".join(shapes)


def _records(source: str) -> str:
    order = "rk * 1000000000000 + rw"
    methods = {m: i for i, m in enumerate(vocab.JOIN_METHODS)}
    rank = "CASE methode_jointure " + " ".join(f"WHEN '{m}' THEN {i}" for m, i in methods.items()) + " ELSE 99 END"
    best = f"arg_min(methode_jointure, ({rank}) * 100000000000000 + {order}) FILTER (WHERE methode_jointure IS NOT NULL)"
    columns = [
        "siren",
        "string_agg(DISTINCT origin, '|' ORDER BY origin) AS origines",
        f"{best} AS methode_jointure",
        f"coalesce(max(confiance_jointure), CASE WHEN {best} = 'siren_direct' THEN 1.0 END) AS confiance_jointure",
    ]
    for a in vocab.MERGEABLE_ATTRIBUTES:
        columns.append(f"arg_min(v_{a}, {order}) FILTER (WHERE v_{a} IS NOT NULL) AS {a}")
        for o in vocab.ORIGINS:
            columns.append(
                f"CASE WHEN count(DISTINCT v_{a}) > 1 THEN arg_max(v_{a}, {order}) "
                f"FILTER (WHERE v_{a} IS NOT NULL AND origin = '{o}') END AS {a}__{o}"
            )
    for c in vocab.PASSTHROUGH_COLUMNS:
        columns.append(f"arg_min({c}, {order}) FILTER (WHERE {c} IS NOT NULL) AS {c}")
    values = ", ".join(f"{sql_value(a)} AS v_{a}" for a in vocab.MERGEABLE_ATTRIBUTES)
    return (
        f"SELECT {', '.join(columns)} "
        f"FROM (SELECT *, {values} FROM {source}) GROUP BY siren"
    )


_SOURCE_SETS = """
SELECT siren, string_agg(DISTINCT e, '|' ORDER BY e) AS sources
FROM (SELECT siren, unnest(string_split(sources, '|')) AS e FROM {0} WHERE sources IS NOT NULL) GROUP BY siren"""


def golden_ctes(last: str) -> str:
    """CTEs ``golden`` (candidate rows), ``records`` (golden records) and ``derived``."""
    valid = r"regexp_full_match(siren, '[0-9]{9}')"
    return f"""{WITH_CANDIDATES},
golden AS (SELECT * FROM ({_golden(last)}) WHERE {valid}),
source_sets AS ({_SOURCE_SETS.format("golden")}),
records AS (
  SELECT r.*, coalesce(s.sources, '') AS sources
  FROM ({_records("golden")}) r LEFT JOIN source_sets s USING (siren)),
derived AS (
  SELECT *, {sql_lookup(vocab.LEGAL_FORM_FAMILY, sql_code("categorie_juridique"))} AS famille_ess,
         {sql_in("naf", vocab.DIGITAL_NAF)} AS naf_numerique,
         {sql_lookup(vocab.NAF_TAG, "naf")} AS tags_numerique
  FROM records)
"""


def enriched_ctes() -> str:
    """CTEs up to ``enriched``: derived records filled from the latest period of each key."""
    base = golden_ctes("cand4")
    booleans = {
        "est_active": f"CASE {sql_strip('p.etatAdministratifUniteLegale')} WHEN 'A' THEN true WHEN 'C' THEN false END",
        "flag_ess_sirene": f"CASE {sql_strip('p.economieSocialeSolidaireUniteLegale')} WHEN 'O' THEN true END",
    }
    existing = {
        "denomination", "nom_usage", "naf", "tranche_effectifs", "categorie_juridique",
    }
    columns = []
    for source, target, _ in vocab.ENRICH_FIELDS:
        if target in booleans:
            offered, ok, empty, current = booleans[target], None, "true", "NULL"
            ok = f"({offered}) IS NOT NULL"
        else:
            offered = f"p.{source}"
            ok = f"NOT {sql_blank(offered)}"
            current = f"d.{target}" if target in existing else "CAST(NULL AS VARCHAR)"
            empty = sql_blank(current)
        columns.append(f"CASE WHEN {empty} AND {ok} THEN {offered} ELSE {current} END AS {target}")
        columns.append(f"CASE WHEN {empty} AND {ok} THEN 'sirene' END AS {target}_enrich_source")
        columns.append(f"CASE WHEN {empty} AND {ok} THEN 'siren_direct' END AS {target}_enrich_method")
    nic = "regexp_full_match(p.nicSiegeUniteLegale, '[0-9]{5}')"
    columns += [
        f"CASE WHEN {nic} THEN d.siren || p.nicSiegeUniteLegale END AS siret_siege",
        f"CASE WHEN {nic} THEN 'sirene' END AS siret_siege_enrich_source",
        f"CASE WHEN {nic} THEN 'siren_direct' END AS siret_siege_enrich_method",
    ]
    kept = [
        "siren", "sources", "origines", "methode_jointure", "confiance_jointure", "code_postal", "commune",
        "site_web", *vocab.PASSTHROUGH_COLUMNS,
    ]
    return f"""{base},
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY siren ORDER BY try_cast("dateDebut" AS TIMESTAMP) DESC NULLS LAST,
                                 nicSiegeUniteLegale) AS rn
    FROM periods WHERE siren IN (SELECT siren FROM derived)) WHERE rn = 1),
filled AS (
  SELECT {", ".join("d." + k for k in kept)}, d.famille_ess AS old_famille, d.naf_numerique AS old_num,
         d.tags_numerique AS old_tags, {", ".join(columns)}
  FROM derived d LEFT JOIN latest p ON d.siren = p.siren),
enriched AS (
  SELECT * EXCLUDE (old_famille, old_num, old_tags),
    CASE WHEN categorie_juridique_enrich_source = 'sirene'
         THEN {sql_lookup(vocab.LEGAL_FORM_FAMILY, sql_code("categorie_juridique"))} ELSE old_famille END AS famille_ess,
    CASE WHEN naf_enrich_source = 'sirene' THEN {sql_in("naf", vocab.DIGITAL_NAF)} ELSE old_num END AS naf_numerique,
    CASE WHEN naf_enrich_source = 'sirene' THEN {sql_lookup(vocab.NAF_TAG, "naf")} ELSE old_tags END AS tags_numerique
  FROM filled)
"""

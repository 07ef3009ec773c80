"""Scalar functions and derived columns (STR, URL, NUM, DAT, ARR, NUL, DRV)."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.catalog import roles
from goldrec.catalog.registry import query
from goldrec.catalog.roles import FORM, NAF, WITH_ROLES, sql_code, sql_in, sql_key, sql_lookup, sql_norm, sql_strip, table
from goldrec.functions import codes, text
from goldrec.operators import consolidate, enrich, filters
from goldrec.operators.quality import add_element


@query("str01_normalize_name", f"SELECT doc_id, {sql_norm('text')} AS norm FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.normalize_name(F.col("text")).alias("norm"))


_KEY = "CASE WHEN l_returnflag = 'R' THEN ' ' || CAST(l_partkey AS STRING) || '.0' " \
    "WHEN l_returnflag = 'A' THEN '12345678' || CAST(l_partkey AS STRING) ELSE CAST(l_partkey AS STRING) END"


@query("str02_canonical_key", f"SELECT l_orderkey, l_linenumber, {sql_key(f'({_KEY})')} AS k FROM lineitem")
def _(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", text.canonical_key(F.expr(_KEY)).alias("k"))


@query("str03_post_code", f"""SELECT c_custkey, {sql_key("(CAST(c_nationkey * 1000 AS STRING) || '.0')", 5)} AS cp FROM customer""")
def _(spark, sf):
    raw = F.concat((F.col("c_nationkey") * 1000).cast("string"), F.lit(".0"))
    return table(spark, sf, "customer").select("c_custkey", text.canonical_key(raw, 5).alias("cp"))


@query("str04_strip", rf"""SELECT conv_id, turn, {sql_strip("(chr(9) || text || ' ' || chr(10))")} AS t FROM conversations""")
def _(spark, sf):
    padded = F.concat(F.lit("\t"), "text", F.lit(" \n"))
    return table(spark, sf, "conversations").select("conv_id", "turn", text.strip(padded).alias("t"))


@query(
    "str05_full_match",
    f"""WITH {WITH_ROLES} SELECT siren, nicSiegeUniteLegale, regexp_full_match(siren, '[0-9]{{9}}') AS key_ok,
    regexp_full_match(nicSiegeUniteLegale, '[0-9]{{5}}') AS nic_ok,
    coalesce(regexp_full_match(identifiantAssociationUniteLegale, 'W[0-9]{{9}}'), false) AS rna_ok FROM periods""",
)
def _(spark, sf):
    return roles.periods(spark, sf).select(
        "siren",
        "nicSiegeUniteLegale",
        text.is_digits(F.col("siren"), 9).alias("key_ok"),
        text.is_digits(F.col("nicSiegeUniteLegale"), 5).alias("nic_ok"),
        F.coalesce(F.col("identifiantAssociationUniteLegale").rlike("^W[0-9]{9}$"), F.lit(False)).alias("rna_ok"),
    )


@query(
    "str06_joined_sets",
    f"""WITH {WITH_ROLES}, s AS (SELECT _row, coalesce(sources, 'ngi') || '|' || methode AS joined FROM
      (SELECT _row, sources, coalesce(methode_jointure, 'manuel') AS methode FROM history))
    SELECT _row, joined, len(string_split(joined, '|')) AS n, contains(joined, '|scoring') AS has_scoring,
      list_aggregate(list_sort(list_distinct(string_split(joined, '|'))), 'string_agg', '|') AS ordered FROM s""",
)
def _(spark, sf):
    method = F.coalesce("methode_jointure", F.lit("manuel"))
    joined = F.concat_ws("|", F.coalesce("sources", F.lit("ngi")), method)
    rows = roles.role(spark, sf, "orders", roles.HISTORY).select("_row", joined.alias("joined"))
    return rows.select(
        "_row",
        "joined",
        text.list_size(F.col("joined")).cast("long").alias("n"),
        F.col("joined").contains("|scoring").alias("has_scoring"),
        text.union_sets(F.split("joined", "[|]")).alias("ordered"),
    )


@query("str07_one_line", """SELECT doc_id, replace(replace(text, '.' || chr(10), ';' || chr(10)), ';' || chr(10), ' / ') AS t FROM documents""")
def _(spark, sf):
    listed = F.replace("text", F.lit(".\n"), F.lit(";\n"))
    return table(spark, sf, "documents").select("doc_id", text.list_to_line(listed).alias("t"))


@query(
    "str08_site_key",
    f"WITH {WITH_ROLES} SELECT siren, nicSiegeUniteLegale, siren || nicSiegeUniteLegale AS siret FROM periods",
)
def _(spark, sf):
    rows = roles.periods(spark, sf).select("siren", "nicSiegeUniteLegale")
    return rows.withColumn("siret", F.concat("siren", "nicSiegeUniteLegale"))


@query("str09_case", "SELECT doc_id, upper(replace(text, 'ß', 'ss')) AS up, lower(text) AS low FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.upper("text").alias("up"), F.lower("text").alias("low"))


@query(
    "str10_full_name",
    f"""WITH {WITH_ROLES} SELECT siren, coalesce(denominationUniteLegale,
      nullif(trim(concat_ws(' ', nomUniteLegale, prenom1UniteLegale)), '')) AS nom_complet FROM registry""",
)
def _(spark, sf):
    name = text.full_name(F.col("denominationUniteLegale"), F.col("nomUniteLegale"), F.col("prenom1UniteLegale"))
    return roles.registry(spark, sf).select("siren", name.alias("nom_complet"))


@query(
    "str11_token_sort",
    f"""SELECT conv_id, turn, list_aggregate(list_sort(string_split({sql_norm("text")}, ' ')), 'string_agg', ' ') AS t
    FROM conversations""",
)
def _(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", text.sort_tokens(text.normalize_name(F.col("text"))).alias("t")
    )


@query(
    "str12_column_prefix",
    f"WITH {roles.golden_ctes('cand4')} SELECT siren, {', '.join(f'denomination__{o}' for o in vocab.ORIGINS)} FROM records",
)
def _(spark, sf):
    from goldrec.plans.golden import consolidate_candidates

    wide = consolidate.widen_conflicts(consolidate_candidates(roles.candidate_tables(spark, sf)))
    return wide.select("siren", *filters.columns_with_prefix(wide, "denomination__"))


@query("url01_domain", """SELECT page_id, replace(regexp_extract(url, '://([^/?#]*)', 1), 'www.', '') AS domaine FROM pages""")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.domain(F.col("url")).alias("domaine"))


@query("num01_code_cast", f"WITH {WITH_ROLES} SELECT siren, dateDebut, {FORM} AS raw, {sql_code(FORM)} AS code FROM periods")
def _(spark, sf):
    return roles.periods(spark, sf).select(
        "siren", "dateDebut", F.col(FORM).alias("raw"), codes.code_text(F.col(FORM)).alias("code")
    )


@query("num02_half_even", "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 8, 2) AS q FROM lineitem")
def _(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", codes.round_half_even(F.col("l_quantity") / 8).alias("q"))


@query(
    "num03_filled_fields",
    f"""WITH {WITH_ROLES} SELECT siren, ((denominationUniteLegale IS NOT NULL)::INT + (prenom1UniteLegale IS NOT NULL)::INT
    + (sigleUniteLegale IS NOT NULL)::INT + (trancheEffectifsUniteLegale IS NOT NULL)::INT)::INT AS n FROM registry""",
)
def _(spark, sf):
    fields = ["denominationUniteLegale", "prenom1UniteLegale", "sigleUniteLegale", "trancheEffectifsUniteLegale"]
    return roles.registry(spark, sf).select("siren", codes.filled_count([F.col(c) for c in fields]).alias("n"))


@query(
    "dat01_lenient_timestamp",
    f"""WITH {WITH_ROLES} SELECT siren, nicSiegeUniteLegale, try_cast("dateDebut" AS TIMESTAMP) AS ts FROM periods""",
)
def _(spark, sf):
    ts = codes.lenient_timestamp(F.col("dateDebut"))
    return roles.periods(spark, sf).select("siren", "nicSiegeUniteLegale", ts.alias("ts"))


@query("dat02_iso_date", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS jour FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", codes.iso_date(F.col("ts")).alias("jour"))


@query(
    "arr01_add_to_set",
    f"""WITH {WITH_ROLES} SELECT _row, CASE WHEN coalesce(sources, '') LIKE '%esus%' OR _row IS NULL
      THEN 'esus|sirene' WHEN sources IS NULL THEN 'esus' ELSE 'esus|' || sources END AS sources FROM history""",
)
def _(spark, sf):
    given = F.coalesce(F.split("sources", "[|]"), F.array().cast("array<string>"))
    more = add_element(given, F.lit("esus"))
    rows = roles.role(spark, sf, "orders", roles.HISTORY)
    return rows.select("_row", F.array_join(F.array_sort(more), "|").alias("sources"))


@query("nul01_fill_constant", f"WITH {WITH_ROLES} SELECT siren, coalesce(sigleUniteLegale, '(none)') AS sigle FROM registry")
def _(spark, sf):
    return roles.registry(spark, sf).select("siren", F.coalesce("sigleUniteLegale", F.lit("(none)")).alias("sigle"))


def _derive_sql(columns: str) -> str:
    return f"""WITH {WITH_ROLES}, d AS (SELECT siren, nicSiegeUniteLegale AS nic, {NAF} AS naf, {FORM} AS categorie_juridique
    FROM periods) SELECT siren, nic, {columns} FROM d"""


def _derived(spark, sf):
    rows = roles.periods(spark, sf).select(
        "siren",
        F.col("nicSiegeUniteLegale").alias("nic"),
        F.col(NAF).alias("naf"),
        F.col(FORM).alias("categorie_juridique"),
    )
    return consolidate.derive(rows)


@query("drv01_digital_flag", _derive_sql(f"{sql_in('naf', vocab.DIGITAL_NAF)} AS naf_numerique"))
def _(spark, sf):
    return _derived(spark, sf).select("siren", "nic", "naf_numerique")


@query("drv02_digital_tag", _derive_sql(f"{sql_lookup(vocab.NAF_TAG, 'naf')} AS tags_numerique"))
def _(spark, sf):
    return _derived(spark, sf).select("siren", "nic", "tags_numerique")


@query(
    "drv03_family",
    _derive_sql(f"{sql_lookup(vocab.LEGAL_FORM_FAMILY, sql_code('categorie_juridique'))} AS famille_ess"),
)
def _(spark, sf):
    return _derived(spark, sf).select("siren", "nic", "famille_ess")


@query(
    "drv04_tiers",
    f"""WITH {WITH_ROLES} SELECT siren, {sql_lookup(vocab.NAF_TIER, NAF)} AS group_naf,
    {sql_lookup(vocab.LEGAL_FORM_TIER, FORM)} AS group_cate FROM registry""",
)
def _(spark, sf):
    rows = roles.registry(spark, sf).select("siren", NAF, FORM)
    return consolidate.add_tiers(rows, FORM, NAF).select("siren", "group_naf", "group_cate")


@query(
    "drv05_active",
    f"""WITH {WITH_ROLES} SELECT siren, nicSiegeUniteLegale AS nic, CASE trim(etatAdministratifUniteLegale)
    WHEN 'A' THEN true WHEN 'C' THEN false END AS est_active FROM periods""",
)
def _(spark, sf):
    active = codes.active_status(F.col("etatAdministratifUniteLegale"))
    return roles.periods(spark, sf).select("siren", F.col("nicSiegeUniteLegale").alias("nic"), active.alias("est_active"))


@query(
    "drv06_social_flag",
    f"""WITH {WITH_ROLES} SELECT siren, nicSiegeUniteLegale AS nic, CASE trim(economieSocialeSolidaireUniteLegale)
    WHEN 'O' THEN true END AS flag_ess_sirene FROM periods""",
)
def _(spark, sf):
    flag = codes.positive_flag(F.col("economieSocialeSolidaireUniteLegale"))
    return roles.periods(spark, sf).select("siren", F.col("nicSiegeUniteLegale").alias("nic"), flag.alias("flag_ess_sirene"))


@query(
    "drv07_site_id",
    f"""WITH {WITH_ROLES} SELECT siren, nicSiegeUniteLegale AS nic,
    CASE WHEN regexp_full_match(nicSiegeUniteLegale, '[0-9]{{5}}') THEN siren || nicSiegeUniteLegale END AS siret_siege
    FROM periods""",
)
def _(spark, sf):
    nic = F.col("nicSiegeUniteLegale")
    return roles.periods(spark, sf).select("siren", nic.alias("nic"), enrich.site_id(F.col("siren"), nic).alias("siret_siege"))

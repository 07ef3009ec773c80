"""Filters, projections, joins and set operations (FLT, PRJ, JOIN, SET)."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.catalog import roles
from goldrec.catalog.registry import query
from goldrec.catalog.roles import FORM, NAF, WITH_CANDIDATES, WITH_ROLES, sql_code, sql_in, sql_key, sql_lookup, table
from goldrec.functions.codes import lookup, member
from goldrec.functions.text import contains_any, contains_ignore_case
from goldrec.operators import consolidate, filters, joins


@query("flt01_code_list", f"WITH {WITH_ROLES} SELECT siren, {NAF} FROM registry WHERE {sql_in(NAF, vocab.DIGITAL_NAF)}")
def _(spark, sf):
    return filters.in_codes(roles.registry(spark, sf).select("siren", NAF), NAF, vocab.DIGITAL_NAF)


@query(
    "flt01_legal_forms",
    f"WITH {WITH_ROLES} SELECT siren, dateDebut, {FORM} FROM periods WHERE {sql_in(sql_code(FORM), vocab.SOCIAL_LEGAL_FORMS)}",
)
def _(spark, sf):
    rows = roles.periods(spark, sf).select("siren", "dateDebut", FORM)
    return rows.where(filters.legal_form_in(FORM, vocab.SOCIAL_LEGAL_FORMS))


@query(
    "flt02_flag",
    f"WITH {WITH_ROLES} SELECT siren, nomUniteLegale FROM registry WHERE economieSocialeSolidaireUniteLegale = 'O'",
)
def _(spark, sf):
    rows = roles.registry(spark, sf).where(F.col("economieSocialeSolidaireUniteLegale") == "O")
    return rows.select("siren", "nomUniteLegale")


@query(
    "flt03_compound",
    f"""WITH {WITH_ROLES} SELECT siren, {NAF}, {FORM} FROM registry
    WHERE {sql_in(NAF, vocab.NARROW_NAF)} AND ({sql_in(FORM, vocab.NARROW_LEGAL_FORMS)}
          OR siren IN (SELECT k FROM list_b))""",
)
def _(spark, sf):
    rows = roles.registry(spark, sf).select("siren", NAF, FORM)
    flagged = joins.flag_listed(rows, roles.list_b(spark, sf), "siren", "listed", "key")
    wanted = filters.legal_form_in(FORM, vocab.NARROW_LEGAL_FORMS) | F.col("listed")
    return flagged.where(member(F.col(NAF), vocab.NARROW_NAF) & wanted).drop("listed")


def truthy_sql(c: str) -> str:
    text = f"lower(trim({c}))"
    return f"coalesce({text} <> 'false' AND coalesce(try_cast({text} AS DOUBLE) <> 0, true), true)"


@query(
    "flt04_all_flags",
    f"""WITH {WITH_ROLES} SELECT * FROM activities WHERE """
    + " AND ".join(truthy_sql(f'"{c}"') for c in vocab.DIGITAL_SURVEY_FLAGS),
)
def _(spark, sf):
    return filters.all_truthy(roles.role(spark, sf, "part", roles.ACTIVITIES), vocab.DIGITAL_SURVEY_FLAGS)


@query(
    "flt05_drop_nulls",
    f"""WITH {WITH_ROLES} SELECT siren, denominationUniteLegale, trancheEffectifsUniteLegale FROM registry
    WHERE denominationUniteLegale IS NOT NULL AND trancheEffectifsUniteLegale IS NOT NULL""",
)
def _(spark, sf):
    rows = roles.registry(spark, sf).select("siren", "denominationUniteLegale", "trancheEffectifsUniteLegale")
    return rows.na.drop(subset=["denominationUniteLegale", "trancheEffectifsUniteLegale"])


_DIRTY_KEY = "CASE WHEN l_returnflag = 'R' THEN CAST(l_orderkey AS STRING) || '.0' " \
    "WHEN l_returnflag = 'A' THEN ' ' || CAST(l_orderkey AS STRING) " \
    "WHEN l_linestatus = 'F' THEN '1234567' || CAST(l_orderkey + 100 AS STRING) ELSE 'ABC' END"


@query(
    "flt06_valid_keys",
    f"""SELECT l_orderkey, l_linenumber, k FROM (SELECT *, {sql_key("raw")} AS k
    FROM (SELECT l_orderkey, l_linenumber, {_DIRTY_KEY} AS raw FROM lineitem)) WHERE regexp_full_match(k, '[0-9]{{9}}')""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_DIRTY_KEY).alias("raw"))
    return filters.valid_keys(rows.withColumn("k", filters.canonical_key(F.col("raw"))), "k").drop("raw")


@query(
    "flt06_key_quality",
    f"""SELECT sum(CASE WHEN ok THEN 1 ELSE 0 END)::BIGINT AS n_valid,
    sum(CASE WHEN ok THEN 0 ELSE 1 END)::BIGINT AS n_dropped
    FROM (SELECT coalesce(regexp_full_match({sql_key("raw")}, '[0-9]{{9}}'), false) AS ok
          FROM (SELECT {_DIRTY_KEY} AS raw FROM lineitem))""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(filters.canonical_key(F.expr(_DIRTY_KEY)).alias("k"))
    return filters.key_quality(rows, "k")


@query(
    "flt07_contains",
    f"""WITH {WITH_ROLES} SELECT title, "Country" FROM projects WHERE coalesce(contains(lower("Country"), 'france'), false)""",
)
def _(spark, sf):
    rows = roles.role(spark, sf, "pages", roles.PROJECTS).select("title", "Country")
    return rows.where(contains_ignore_case(F.col("Country"), "france"))


@query(
    "flt08_keywords",
    f"SELECT doc_id, lang FROM documents WHERE regexp_matches(upper(text), '{'|'.join(vocab.DIGITAL_KEYWORDS)}')",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").where(contains_any(F.col("text"), vocab.DIGITAL_KEYWORDS))
    return docs.select("doc_id", "lang")


@query(
    "flt09_non_empty",
    f"""WITH {WITH_ROLES} SELECT siren, etatAdministratifUniteLegale FROM periods WHERE etatAdministratifUniteLegale <> ''""",
)
def _(spark, sf):
    c = F.col("etatAdministratifUniteLegale")
    rows = roles.periods(spark, sf).select("siren", c)
    return rows.where(c.isNotNull() & (c != ""))


@query(
    "prj01_rename",
    f"""WITH {WITH_ROLES} SELECT siren, denominationUniteLegale AS denomination, nomUniteLegale AS nom_usage,
    {NAF} AS naf FROM registry""",
)
def _(spark, sf):
    rows = roles.registry(spark, sf).select("siren", "denominationUniteLegale", "nomUniteLegale", NAF)
    return filters.rename_present(rows, vocab.REGISTRY_RENAMES)


@query("prj02_defaults", f"WITH {WITH_ROLES} SELECT siren, nomUniteLegale, 'FR' AS pays FROM registry")
def _(spark, sf):
    rows = roles.registry(spark, sf).select("siren", "nomUniteLegale")
    return filters.add_defaults(rows, {"nomUniteLegale": "unused", "pays": "FR"})


@query(
    "prj03_provenance_constants",
    f"""WITH {WITH_ROLES} SELECT siren, coalesce(methode_jointure, 'scoring') AS methode_jointure,
    'ess_france|sirene' AS sources FROM history""",
)
def _(spark, sf):
    rows = roles.role(spark, sf, "orders", roles.HISTORY).select("siren", "methode_jointure")
    return filters.with_provenance(rows, ["ess_france", "sirene"], "scoring")


@query(
    "prj04_row_provenance",
    f"""WITH {WITH_ROLES} SELECT siren,
    CASE WHEN siren IN (SELECT k FROM list_b) THEN 'esus|sirene' ELSE 'sirene' END AS sources FROM registry""",
)
def _(spark, sf):
    rows = roles.registry(spark, sf).select("siren")
    flagged = joins.flag_listed(rows, roles.list_b(spark, sf), "siren", "listed", "key")
    return flagged.select("siren", filters.provenance(["sirene"], {"esus": F.col("listed")}).alias("sources"))


@query(
    "prj05_origin_tag",
    f"""WITH {WITH_ROLES}
    SELECT {sql_key("siren")} AS siren, "NOM" AS denomination, 'tiers_lieux' AS _origin FROM places""",
)
def _(spark, sf):
    rows = roles.places(spark, sf).select("siren", "NOM")
    return filters.normalize_candidate(rows, "tiers_lieux", vocab.SURVEY_RENAMES)


@query(
    "prj06_allow_list",
    f"WITH {WITH_CANDIDATES} SELECT siren, {NAF} AS naf, sources, methode_jointure FROM cand2",
)
def _(spark, sf):
    rows = roles.candidate_tables(spark, sf)["cate_x_naf"].withColumnRenamed(NAF, "naf")
    return filters.select_present(rows, vocab.EXPORT_COLUMNS)


@query("prj07_review_table", f"""WITH {WITH_ROLES} SELECT title, website, "Project", '' AS siren FROM projects""")
def _(spark, sf):
    return filters.review_table(roles.role(spark, sf, "pages", roles.PROJECTS), ["title", "website", "Project"])


@query(
    "prj08_clean_columns",
    'SELECT o_orderkey AS cle_de_la_commande, o_orderstatus AS etat_n, o_custkey AS client, o_totalprice AS client_1, '
    "o_orderpriority AS client_2 FROM orders",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    return filters.clean_columns(orders.toDF(" Clé -> de la  commande", "État n°", "Client", "client ", "CLIENT->"))


@query(
    "prj09_short_headers",
    "SELECT c_custkey AS siren, c_name AS nom, c_mktsegment AS nom_1 FROM customer",
)
def _(spark, sf):
    raw = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment").toDF('"SIREN"', " Nom", "nom ")
    return raw.toDF(*filters.number_repeats([filters.plain_header(c) for c in raw.columns]))


@query(
    "join01_semi",
    f"""WITH {WITH_ROLES} SELECT siren, dateDebut, nicSiegeUniteLegale FROM periods WHERE siren IN (SELECT k FROM list_b)""",
)
def _(spark, sf):
    rows = roles.periods(spark, sf).select("siren", "dateDebut", "nicSiegeUniteLegale")
    return joins.keep_listed(rows, roles.list_b(spark, sf), "siren", "key")


@query(
    "join02_existence",
    f"""WITH {WITH_ROLES} SELECT siren, nomUniteLegale, siren IN (SELECT k FROM list_b) AS is_esus FROM registry""",
)
def _(spark, sf):
    rows = roles.registry(spark, sf).select("siren", "nomUniteLegale")
    return joins.flag_listed(rows, roles.list_b(spark, sf), "siren", "is_esus", "key")


@query(
    "join03_left",
    f"""WITH {WITH_ROLES} SELECT p.siren, p.nicSiegeUniteLegale, r.nomUniteLegale, r.{NAF}
    FROM (SELECT siren, nicSiegeUniteLegale FROM periods) p
    LEFT JOIN registry r ON p.siren = r.siren""",
)
def _(spark, sf):
    rows = roles.periods(spark, sf).select("siren", "nicSiegeUniteLegale")
    return joins.attach(rows, roles.registry(spark, sf), "siren", ["nomUniteLegale", NAF])


@query(
    "join04_lookup",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name, p.p_brand, p.p_type, p.p_size
    FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey")
    return joins.attach(rows, parts, "l_partkey", ["p_name", "p_brand", "p_type", "p_size"])


@query(
    "join05_dictionary",
    f"""WITH {WITH_ROLES} SELECT siren, nicSiegeUniteLegale, {sql_lookup(vocab.NAF_TAG, NAF)} AS tag FROM periods""",
)
def _(spark, sf):
    rows = roles.periods(spark, sf)
    return rows.select("siren", "nicSiegeUniteLegale", lookup(vocab.NAF_TAG, F.col(NAF)).alias("tag"))


@query(
    "join05_dictionary_table",
    "SELECT c.c_custkey, c.c_nationkey, n.n_name AS nation FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey",
)
def _(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return joins.attach_dictionary(rows, table(spark, sf, "nation"), "c_nationkey", "n_nationkey", "n_name", "nation")


@query(
    "set01_union",
    f"""WITH {WITH_CANDIDATES}
    SELECT siren, {NAF}, NULL AS group_cate, sources FROM cand1
    UNION ALL SELECT siren, {NAF}, group_cate, sources FROM cand2
    UNION ALL SELECT siren, {NAF}, NULL, sources FROM cand4
    UNION ALL SELECT siren, NULL, NULL, sources FROM places""",
)
def _(spark, sf):
    tables = roles.candidate_tables(spark, sf)
    wanted = ["siren", NAF, "group_cate", "sources"]
    return consolidate.union_all(
        [filters.select_present(df, wanted) for df in tables.values()]
    ).select(*wanted)


@query(
    "set02_candidate_rule",
    f"""WITH {WITH_ROLES} SELECT siren FROM registry WHERE {sql_in(NAF, vocab.DIGITAL_NAF)}
    AND ({sql_in(FORM, vocab.SOCIAL_LEGAL_FORMS)} OR siren IN (SELECT k FROM list_a))""",
)
def _(spark, sf):
    rows = filters.in_codes(roles.registry(spark, sf).select("siren", NAF, FORM), NAF, vocab.DIGITAL_NAF)
    flagged = joins.flag_listed(rows, roles.list_a(spark, sf), "siren", "listed", "SIREN")
    return flagged.where(filters.legal_form_in(FORM, vocab.SOCIAL_LEGAL_FORMS) | F.col("listed")).select("siren")


@query(
    "set03_double_filter",
    f"""WITH {WITH_ROLES} SELECT siren, {NAF} FROM registry WHERE economieSocialeSolidaireUniteLegale = 'O'
    AND {sql_in(NAF, vocab.DIGITAL_NAF)} AND siren IN (SELECT k FROM list_a)""",
)
def _(spark, sf):
    flagged = roles.registry(spark, sf).where("economieSocialeSolidaireUniteLegale = 'O'")
    digital = filters.in_codes(flagged.select("siren", NAF), NAF, vocab.DIGITAL_NAF)
    return joins.keep_listed(digital, roles.list_a(spark, sf), "siren", "SIREN")

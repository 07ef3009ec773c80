"""Consolidation, enrichment, quality and the whole chain (AGG-01…08, WIN, ENR, QLT, PIPE)."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.catalog import roles
from goldrec.catalog.registry import query
from goldrec.catalog.roles import (
    NAF,
    WITH_CANDIDATES,
    WITH_ROLES,
    enriched_ctes,
    golden_ctes,
    sql_blank,
    sql_value,
    table,
)
from goldrec.functions.codes import lenient_timestamp
from goldrec.functions.text import blank_to_null
from goldrec.operators import consolidate, enrich, joins, quality
from goldrec.plans import golden, review
from goldrec.session import scratch_path
from goldrec.sources import readers, writers

_WIDE = [f"{a}__{o}" for a in vocab.MERGEABLE_ATTRIBUTES for o in vocab.ORIGINS]
_RECORD = [
    "siren", "sources", "origines", "methode_jointure", "confiance_jointure",
    *vocab.MERGEABLE_ATTRIBUTES, *vocab.PASSTHROUGH_COLUMNS,
]
_DERIVED = ["famille_ess", "naf_numerique", "tags_numerique"]
_TARGETS = [t for _, t, _ in vocab.ENRICH_FIELDS] + ["siret_siege"]
_SOCIAL = "economieSocialeSolidaireUniteLegale"
#: Columns of the registry subset, and what breaks ties between rows of one date.
_SUBSET = ["nicSiegeUniteLegale", NAF], "nicSiegeUniteLegale"
_TRACES = [c for t in _TARGETS for c in enrich.trace_columns(t)]


def _order():
    return consolidate.input_order(vocab.ORIGINS, F.col("_row"))


def _records(spark, sf):
    return consolidate.consolidate(roles.golden_input(spark, sf), row_order="_row", known_sources=vocab.SOURCES)


@query("agg01_golden_record", f"WITH {golden_ctes('history')} SELECT {', '.join(_RECORD + _WIDE)} FROM records")
def _(spark, sf):
    return consolidate.widen_conflicts(_records(spark, sf)).select(*_RECORD, *_WIDE)


@query("agg02_set_union", f"WITH {golden_ctes('history')} SELECT siren, sources FROM records")
def _(spark, sf):
    rows = roles.golden_input(spark, sf)
    return rows.groupBy("siren").agg(consolidate.agg_set_union(F.col("sources")).alias("sources"))


@query("agg03_origins", f"WITH {golden_ctes('history')} SELECT siren, origines FROM records")
def _(spark, sf):
    rows = roles.golden_input(spark, sf)
    return rows.groupBy("siren").agg(consolidate.agg_set(F.col("_origin")).alias("origines"))


@query("agg04_best_method", f"WITH {golden_ctes('history')} SELECT siren, methode_jointure FROM records")
def _(spark, sf):
    best = consolidate.agg_best(F.col("methode_jointure"), vocab.JOIN_METHODS, _order())
    return roles.golden_input(spark, sf).groupBy("siren").agg(best.alias("methode_jointure"))


@query("agg05_confidence", f"WITH {golden_ctes('history')} SELECT siren, confiance_jointure FROM records")
def _(spark, sf):
    best = consolidate.agg_best(F.col("methode_jointure"), vocab.JOIN_METHODS, _order())
    confidence = consolidate.agg_confidence(F.col("confiance_jointure").cast("double"), best)
    return roles.golden_input(spark, sf).groupBy("siren").agg(confidence.alias("confiance_jointure"))


@query(
    "agg06_conflicts",
    f"WITH {golden_ctes('history')} SELECT siren, denomination, {', '.join(f'denomination__{o}' for o in vocab.ORIGINS)} FROM records",
)
def _(spark, sf):
    rows = roles.golden_input(spark, sf).select(
        "siren", "_origin", _order().alias("_order"), blank_to_null(F.col("denomination")).alias("denomination")
    )
    rows = rows.groupBy("siren").agg(consolidate.agg_resolve("denomination", vocab.ORIGINS).alias("r"))
    versions = [
        F.try_element_at("r.versions", F.lit(o)).alias(f"denomination__{o}") for o in vocab.ORIGINS
    ]
    return rows.select("siren", F.col("r.main").alias("denomination"), *versions)


@query(
    "agg07_first_non_null",
    f"WITH {golden_ctes('history')} SELECT siren, {', '.join(vocab.PASSTHROUGH_COLUMNS)} FROM records",
)
def _(spark, sf):
    first = [consolidate.agg_first(F.col(c), _order()).alias(c) for c in vocab.PASSTHROUGH_COLUMNS]
    return roles.golden_input(spark, sf).groupBy("siren").agg(*first)


_CONFLICTED = " UNION ALL ".join(
    f"SELECT '{a}' AS attribute, count(*) FILTER (WHERE n > 1) AS n_conflicts, "
    f"round_even(count(*) FILTER (WHERE n > 1) * 100.0 / count(*), 1)::DOUBLE AS pct_of_keys "
    f"FROM (SELECT siren, count(DISTINCT {sql_value(a)}) AS n FROM golden GROUP BY siren)"
    for a in vocab.MERGEABLE_ATTRIBUTES
)


@query("agg08_conflict_counts", f"WITH {golden_ctes('history')} {_CONFLICTED}")
def _(spark, sf):
    return consolidate.conflict_counts(_records(spark, sf))


@query(
    "win01_latest",
    f"""WITH {WITH_ROLES} SELECT siren, "dateDebut", nicSiegeUniteLegale, {NAF} FROM (
      SELECT *, row_number() OVER (PARTITION BY siren ORDER BY try_cast("dateDebut" AS TIMESTAMP) DESC NULLS LAST,
      nicSiegeUniteLegale) AS rn FROM periods) WHERE rn = 1""",
)
def _(spark, sf):
    rows = roles.periods(spark, sf).select("siren", "dateDebut", "nicSiegeUniteLegale", NAF)
    return enrich.latest_per_key(rows, "siren", lenient_timestamp(F.col("dateDebut")), "nicSiegeUniteLegale")


@query(
    "win01_latest_event",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) AS rn FROM events) WHERE rn = 1""",
)
def _(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return enrich.latest_per_key(rows, "user_id", F.col("ts"), "event_id").drop("ts")


@query(
    "win02_input_order",
    f"""WITH {golden_ctes('history')} SELECT siren, arg_min(origin, rk * 1000000000000 + rw) AS first_origin,
    min(CASE WHEN origin = 'ess_flag_insee' THEN rw END) AS first_row,
    max(CASE WHEN origin = 'ess_flag_insee' THEN rw END) AS last_row FROM golden GROUP BY siren""",
)
def _(spark, sf):
    last_origin = F.when(F.col("_origin") == "ess_flag_insee", _order())
    return roles.golden_input(spark, sf).groupBy("siren").agg(
        F.min_by("_origin", _order()).alias("first_origin"),
        F.min(last_origin)["row"].alias("first_row"),
        F.max(last_origin)["row"].alias("last_row"),
    )


# -- enrichment --------------------------------------------------------------------


def enriched_records(spark, sf):
    records = golden.consolidate_candidates(roles.candidate_tables(spark, sf)).drop("conflicts")
    return golden.enrich_records(records, roles.periods(spark, sf), ties=("nicSiegeUniteLegale",))


_BLANK_NAME = "CASE WHEN c_acctbal > 8000 THEN c_name WHEN c_acctbal > 4000 THEN '  ' END"


@query(
    "enr01_fill",
    f"""WITH {WITH_ROLES}, base AS (SELECT {roles._padded("c_custkey")} AS siren, {_BLANK_NAME} AS denomination FROM customer),
    p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY siren ORDER BY try_cast("dateDebut" AS TIMESTAMP) DESC NULLS LAST,
      nicSiegeUniteLegale) AS rn FROM periods) WHERE rn = 1)
    SELECT b.siren,
      CASE WHEN {sql_blank("b.denomination")} AND NOT {sql_blank("p.denominationUniteLegale")}
           THEN p.denominationUniteLegale ELSE b.denomination END AS denomination,
      CASE WHEN {sql_blank("b.denomination")} AND NOT {sql_blank("p.denominationUniteLegale")} THEN 'sirene' END AS denomination_enrich_source,
      CASE WHEN {sql_blank("b.denomination")} AND NOT {sql_blank("p.denominationUniteLegale")} THEN 'siren_direct' END AS denomination_enrich_method,
      CASE WHEN NOT {sql_blank("p.trancheEffectifsUniteLegale")} THEN p.trancheEffectifsUniteLegale END AS tranche_effectifs,
      CASE WHEN NOT {sql_blank("p.trancheEffectifsUniteLegale")} THEN 'sirene' END AS tranche_effectifs_enrich_source,
      CASE WHEN NOT {sql_blank("p.trancheEffectifsUniteLegale")} THEN 'siren_direct' END AS tranche_effectifs_enrich_method
    FROM base b LEFT JOIN p ON b.siren = p.siren""",
)
def _(spark, sf):
    base = table(spark, sf, "customer").selectExpr(
        f"{roles._padded('c_custkey')} AS siren", f"{_BLANK_NAME} AS denomination"
    )
    offered = ["denominationUniteLegale", "trancheEffectifsUniteLegale"]
    latest = enrich.registry_for_keys(
        roles.periods(spark, sf), base, "siren", "dateDebut", offered, "nicSiegeUniteLegale"
    )
    joined = joins.attach(base, latest, "siren", offered)
    fills = {"denomination": F.col(offered[0]), "tranche_effectifs": F.col(offered[1])}
    return enrich.fill_blank(joined, fills).drop(*offered)


@query(
    "enr02_rederive",
    f"""WITH {enriched_ctes()} SELECT siren, naf, categorie_juridique, naf_enrich_source, categorie_juridique_enrich_source,
    {', '.join(_DERIVED)} FROM enriched""",
)
def _(spark, sf):
    return enriched_records(spark, sf).select(
        "siren", "naf", "categorie_juridique", "naf_enrich_source", "categorie_juridique_enrich_source", *_DERIVED
    )


@query(
    "enr03_registry_subset",
    f"""WITH {WITH_CANDIDATES} SELECT siren, "dateDebut", nicSiegeUniteLegale, {NAF} FROM (
      SELECT *, row_number() OVER (PARTITION BY siren ORDER BY try_cast("dateDebut" AS TIMESTAMP) DESC NULLS LAST,
      nicSiegeUniteLegale) AS rn FROM periods WHERE siren IN (SELECT siren FROM cand1)) WHERE rn = 1""",
)
def _(spark, sf):
    wanted = roles.candidate_tables(spark, sf)["ess_x_naf"]
    return enrich.registry_for_keys(roles.periods(spark, sf), wanted, "siren", "dateDebut", *_SUBSET)


@query(
    "enr03_key_filter",
    f"""WITH {WITH_ROLES} SELECT siren, "dateDebut", nicSiegeUniteLegale, {NAF} FROM (
      SELECT *, row_number() OVER (PARTITION BY siren ORDER BY try_cast("dateDebut" AS TIMESTAMP) DESC NULLS LAST,
      nicSiegeUniteLegale) AS rn FROM periods
      WHERE siren IN (SELECT siren FROM registry WHERE {_SOCIAL} = 'O')) WHERE rn = 1""",
)
def _(spark, sf):
    """The keys of all flagged organisations, taken as too many to broadcast: a filter of a few bits per key drops other rows."""
    flagged = roles.registry(spark, sf).where(F.col(_SOCIAL) == "O").select("siren")
    return enrich.registry_for_keys(roles.periods(spark, sf), flagged, "siren", "dateDebut", *_SUBSET, broadcast=False)


# -- quality -------------------------------------------------------------------------

SCORE_SQL = (
    "round_even(("
    + " + ".join(f"({f} IS NOT NULL)::INT" for f in vocab.SCORE_FIELDS)
    + f") / {len(vocab.SCORE_FIELDS)}.0::DOUBLE, 2)"
)


@query("qlt01_completeness", f"WITH {enriched_ctes()} SELECT siren, {SCORE_SQL} AS score_enrichissement FROM enriched")
def _(spark, sf):
    return quality.completeness(enriched_records(spark, sf)).select("siren", "score_enrichissement")


_CHECKED = {
    "siren": "CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey AS STRING) ELSE lpad(CAST(o_custkey AS STRING), 9, '0') END",
    "siret_siege": "CASE WHEN o_totalprice > 250000 THEN lpad(CAST(o_orderkey AS STRING), 14, '0') "
    "WHEN o_totalprice > 50000 THEN '' ELSE CAST(o_orderkey AS STRING) END",
    "rna": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'W' || lpad(CAST(o_orderkey AS STRING), 9, '0') "
    "WHEN o_orderpriority = '5-LOW' THEN 'X' || lpad(CAST(o_orderkey AS STRING), 9, '0') END",
    "confiance_jointure": "CASE WHEN o_totalprice < 400000 THEN o_totalprice / 350000 END",
    "o_orderkey": "o_orderkey",
}


@query(
    "qlt02_validate",
    f"""WITH r AS ({roles.role_sql("orders", _CHECKED)}) SELECT o_orderkey, concat_ws('|',
      CASE WHEN NOT regexp_full_match(siren, '[0-9]{{9}}') THEN 'siren' END,
      CASE WHEN siret_siege <> '' AND NOT regexp_full_match(siret_siege, '[0-9]{{14}}') THEN 'siret_siege' END,
      CASE WHEN rna <> '' AND NOT regexp_full_match(rna, 'W[0-9]{{9}}') THEN 'rna' END,
      CASE WHEN NOT confiance_jointure BETWEEN 0 AND 1 THEN 'confiance_jointure' END) AS violations FROM r""",
)
def _(spark, sf):
    checked = quality.validate(roles.role(spark, sf, "orders", _CHECKED))
    return checked.select("o_orderkey", F.array_join("violations", "|").alias("violations"))


@query(
    "qlt03_flat_record",
    f"""WITH {WITH_ROLES}, r AS (SELECT nicSiegeUniteLegale AS nic, siren, {NAF} AS naf,
      {roles.FORM} AS categorie_juridique, "dateCreationUniteLegale" AS date_creation, {roles.sql_lookup(vocab.NAF_TAG, NAF)} AS tag
      FROM periods)
    SELECT nic, siren, naf, categorie_juridique, date_creation,
      {roles.sql_lookup(vocab.LEGAL_FORM_FAMILY, roles.sql_code("categorie_juridique"))} AS famille_ess,
      (tag IS NOT NULL) AS naf_numerique,
      CASE WHEN tag IS NOT NULL AND tag < 'fablab' THEN tag || '|fablab' WHEN tag IS NOT NULL THEN 'fablab|' || tag
           ELSE 'fablab' END AS tags_numerique,
      'esus|sirene' AS sources, '2024-01-31' AS date_integration FROM r""",
)
def _(spark, sf):
    typed = roles.periods(spark, sf).select(
        F.col("nicSiegeUniteLegale").alias("nic"),
        "siren",
        F.col(NAF).alias("naf"),
        F.col(roles.FORM).alias("categorie_juridique"),
        F.to_date("dateCreationUniteLegale").alias("date_creation"),
        F.lit(None).cast("string").alias("famille_ess"),
        F.lit(False).alias("naf_numerique"),
        F.array(F.lit("fablab")).alias("tags_numerique"),
        F.array(F.lit("sirene"), F.lit("esus"), F.lit("sirene")).alias("sources"),
        F.to_date(F.lit("2024-01-31")).alias("date_integration"),
    )
    return quality.flatten_record(quality.complete_record(typed))


@query(
    "qlt04_tag_listed",
    f"""WITH {WITH_CANDIDATES} SELECT siren, siren IN (SELECT siren FROM places_k) AS tag_ngi FROM cand2""".replace(
        f"WITH {WITH_CANDIDATES}",
        f"WITH {WITH_CANDIDATES}, places_k AS (SELECT {roles.sql_key('siren')} AS siren FROM places)",
    ),
)
def _(spark, sf):
    rows = roles.candidate_tables(spark, sf)["cate_x_naf"].select("siren")
    return quality.tag_listed(rows, roles.places(spark, sf), "siren")


# -- whole stages ----------------------------------------------------------------------


@query(
    "pipe01_listed_candidates",
    f"WITH {WITH_CANDIDATES} SELECT * FROM cand1",
)
def _(spark, sf):
    return roles.candidate_tables(spark, sf)["ess_x_naf"]


@query("pipe02_form_or_approved_candidates", f"WITH {WITH_CANDIDATES} SELECT * FROM cand2")
def _(spark, sf):
    return roles.candidate_tables(spark, sf)["cate_x_naf"]


@query("pipe04_flagged_candidates", f"WITH {WITH_CANDIDATES} SELECT * FROM cand4")
def _(spark, sf):
    return roles.candidate_tables(spark, sf)["ess_flag_insee"]


@query(
    "pipe05_consolidation",
    f"WITH {golden_ctes('cand4')} SELECT {', '.join(_RECORD + _WIDE + _DERIVED)} FROM derived",
)
def _(spark, sf):
    records = golden.consolidate_candidates(roles.candidate_tables(spark, sf))
    return consolidate.widen_conflicts(records).select(*_RECORD, *_WIDE, *_DERIVED)


@query(
    "pipe06_enrichment",
    f"""WITH {enriched_ctes()} SELECT siren, sources, origines, methode_jointure, confiance_jointure, code_postal, commune, site_web,
    {', '.join(vocab.PASSTHROUGH_COLUMNS + _TARGETS + _TRACES + _DERIVED)} FROM enriched""",
)
def _(spark, sf):
    return enriched_records(spark, sf)


_EXPORT = [c for c in vocab.EXPORT_COLUMNS if c != "score_enrichissement"]


@query(
    "pipe07_export",
    f"WITH {enriched_ctes()} SELECT {', '.join(_EXPORT)}, {SCORE_SQL} AS score_enrichissement FROM enriched",
)
def _(spark, sf):
    return golden.export_records(enriched_records(spark, sf))


@query(
    "pipe08_review_round_trip",
    f"""WITH {WITH_ROLES}, reviewed AS (
      SELECT title, replace(regexp_extract(website, '://([^/?#]*)', 1), 'www.', '') AS domaine, website, "Category", "Project",
             CASE WHEN website LIKE 'https%' THEN lpad(replace(title, 'Project ', ''), 9, '0') ELSE '' END AS siren
      FROM projects WHERE coalesce(contains(lower("Country"), 'france'), false))
    SELECT r.siren, r.nomUniteLegale, r.siren IN (SELECT siren FROM reviewed WHERE siren <> '') AS tag_ngi FROM registry r""",
)
def _(spark, sf):
    """Through the files: the list with its preamble, the ';' table for review, the same table with keys entered, the tag.

    The manual entry is played by the number in the title of every https project.
    """
    raw, table_for_review, entered = (scratch_path(spark, name) for name in ("projects", "review", "reviewed"))
    writers.write_with_preamble(roles.role(spark, sf, "pages", roles.PROJECTS).select(*review.LIST_COLUMNS), raw)
    review.export_review(spark, raw, table_for_review)
    number = F.lpad(F.replace("title", F.lit("Project "), F.lit("")), 9, "0")
    key = F.when(F.col("website").startswith("https"), number).otherwise(F.col("siren"))
    writers.write_delimited(readers.read_delimited(spark, table_for_review, sep=";").withColumn("siren", key), entered, ";")
    return review.import_review(spark, entered, roles.registry(spark, sf).select("siren", "nomUniteLegale"))


@query(
    "pipe08_review_table",
    f"""WITH {WITH_ROLES} SELECT title, replace(regexp_extract(website, '://([^/?#]*)', 1), 'www.', '') AS domaine, website,
    "Category", "Project", '' AS siren FROM projects WHERE coalesce(contains(lower("Country"), 'france'), false)""",
)
def _(spark, sf):
    return review.to_review(roles.role(spark, sf, "pages", roles.PROJECTS))

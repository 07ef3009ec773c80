"""Sources and sinks (SRC, SNK)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.catalog import roles
from goldrec.catalog.registry import query
from goldrec.catalog.roles import WITH_ROLES, table
from goldrec.functions.text import full_name
from goldrec.operators.joins import keep_listed
from goldrec.session import scratch_path
from goldrec.sources import readers, writers

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _as_text_file(df: DataFrame, sep: str = ",") -> str:
    path = scratch_path(df.sparkSession, "delimited")
    writers.write_delimited(df, path, sep)
    return path


@query("src01_projected_scan", f"WITH {WITH_ROLES} SELECT siren, {roles.NAF}, {roles.FORM} FROM registry")
def _(spark, sf):
    return roles.registry(spark, sf).select("siren", roles.NAF, roles.FORM)


@query("src02_key_column", f"WITH {WITH_ROLES} SELECT lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS siren FROM orders")
def _(spark, sf):
    rows = roles.periods(spark, sf).select("siren", "dateDebut", "denominationUniteLegale")
    return readers.read_delimited(spark, _as_text_file(rows), ["siren"])


@query(
    "src03_semicolon",
    f'WITH {WITH_ROLES} SELECT "ID_UNIQUE", "NOM", "NOM_STRC_PORT", "CODPOST" FROM identity',
)
def _(spark, sf):
    path = _as_text_file(roles.role(spark, sf, "part", roles.IDENTITY), ";")
    return readers.read_delimited(spark, path, ["ID_UNIQUE", "NOM", "NOM_STRC_PORT", "CODPOST"], ";")


@query(
    "src03_line_breaks",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(replace(text, ' the ', chr(10) || '\"the\"' || chr(13))) AS digest FROM documents",
)
def _(spark, sf):
    """Files whose values hold line breaks and quotes, each written by a task of the scan and read block by block."""
    broken = F.replace("text", F.lit(" the "), F.lit('\n"the"\r'))
    path = _as_text_file(table(spark, sf, "documents").select("doc_id", broken.alias("text")), ";")
    return readers.read_delimited(spark, path, ["doc_id", "text"], ";").select("doc_id", F.md5("text").alias("digest"))


_LOOKALIKES = [["sep=abc", "x", None, None, "France"], ["title", "website", "Category", "Project", "Country"]]


@query(
    "src04_preamble",
    f"""WITH {WITH_ROLES} SELECT title, website, "Category", "Project", "Country" FROM projects
    UNION ALL VALUES ('sep=abc', 'x', NULL, NULL, 'France'), ('title', 'website', 'Category', 'Project', 'Country')""",
)
def _(spark, sf):
    """Every file has the preamble; rows that look like it are data."""
    names = ["title", "website", "Category", "Project", "Country"]
    projects = roles.role(spark, sf, "pages", roles.PROJECTS).select(*names)
    rows = projects.unionAll(spark.createDataFrame(_LOOKALIKES, ", ".join(f"{n} string" for n in names)))
    path = scratch_path(spark, "preamble")
    writers.write_with_preamble(rows, path)
    return readers.read_with_preamble(spark, path, names)


@query("src05_optional_input", f'WITH {WITH_ROLES} SELECT k AS "SIREN" FROM list_a')
def _(spark, sf):
    listed = roles.list_a(spark, sf).select(readers.canonical_key(F.col("SIREN")).alias("SIREN")).distinct()
    present = readers.read_optional(spark, _as_text_file(listed), ["SIREN"])
    absent = readers.read_optional(spark, scratch_path(spark, "nothing-here"), ["SIREN"])
    return present.unionByName(absent)


@query("src06_key_detection", f"WITH {WITH_ROLES} SELECT DISTINCT siren AS key FROM registry")
def _(spark, sf):
    listed = roles.registry(spark, sf).select(
        F.col("nomUniteLegale").alias("Nom"),
        F.col("trancheEffectifsUniteLegale").alias("Effectif"),
        F.concat(F.lit(" "), "siren").alias("Numero"),
    )
    return readers.load_key_list(readers.read_delimited(spark, _as_text_file(listed)))


@query(
    "src07_pushed_filter",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'",
)
def _(spark, sf):
    orders = readers.read_table(spark, f"{sf}/orders.parquet")
    kept = orders.where((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"))
    return kept.select("o_orderkey", "o_custkey")


@query(
    "src07_catch_all_code",
    f"""WITH {WITH_ROLES} SELECT siren, coalesce(denominationUniteLegale,
      nullif(trim(concat_ws(' ', nomUniteLegale, prenom1UniteLegale)), '')) AS nom_complet
    FROM registry WHERE {roles.NAF} = '{vocab.CATCH_ALL_NAF}' AND siren IN (SELECT k FROM list_a)""",
)
def _(spark, sf):
    """Listed organisations behind the catch-all activity code, with their full name."""
    rows = roles.registry(spark, sf).where(F.col(roles.NAF) == vocab.CATCH_ALL_NAF)
    listed = keep_listed(rows, roles.list_a(spark, sf), "siren", "SIREN")
    name = full_name(F.col("denominationUniteLegale"), F.col("nomUniteLegale"), F.col("prenom1UniteLegale"))
    return listed.select("siren", name.alias("nom_complet"))


@query("src08_point_lookup", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey = 42")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return readers.lookup_key(orders, "o_custkey", 42)


@query(
    "src09_sample",
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 1000",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return readers.sample_rows(orders, 1000, F.col("o_orderkey"), 42)


@query("src10_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return readers.head(orders, 20, F.desc("o_totalprice"), "o_orderkey")


_PROFILE = " UNION ALL ".join(
    f"SELECT '{t}' AS source, (SELECT count(*) FROM {t}) AS n_rows, "
    f"CAST(count(*) AS INTEGER) AS n_columns, string_agg(column_name, ',' ORDER BY column_index) AS column_names "
    f"FROM duckdb_columns() WHERE table_name = '{t}'"
    for t in TABLES
)


@query("src11_source_profile", _PROFILE)
def _(spark, sf):
    return reduce(DataFrame.unionAll, [readers.source_profile(table(spark, sf, t), t) for t in TABLES])


@query("snk01_csv_round_trip", f"WITH {WITH_ROLES} SELECT * FROM registry")
def _(spark, sf):
    return readers.read_delimited(spark, _as_text_file(roles.registry(spark, sf)))


@query(
    "snk02_text_round_trip",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS digest FROM documents",
)
def _(spark, sf):
    """Accents, quotes, separators and line breaks survive the UTF-8 text sink."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    back = readers.read_delimited(spark, _as_text_file(docs))
    return back.select("doc_id", F.md5("text").alias("digest"))


@query(
    "snk03_semicolon_sink",
    f"""WITH {WITH_ROLES} SELECT title, website, "Category", '' AS siren FROM projects""",
)
def _(spark, sf):
    review = roles.role(spark, sf, "pages", roles.PROJECTS).select(
        "title", "website", "Category", F.lit("").alias("siren")
    )
    back = readers.read_delimited(spark, _as_text_file(review, ";"), sep=";")
    return back.withColumn("siren", F.coalesce("siren", F.lit("")))


@query("snk04_overwrite", f"WITH {WITH_ROLES} SELECT siren, {roles.NAF} FROM registry")
def _(spark, sf):
    """A second run replaces what the first one left."""
    path = scratch_path(spark, "stage")
    writers.write_table(roles.periods(spark, sf).select("siren", roles.NAF), path)
    writers.write_table(roles.registry(spark, sf).select("siren", roles.NAF), path)
    return spark.read.parquet(path)


@query("snk04_replace", f"WITH {WITH_ROLES} SELECT siren, {roles.NAF} FROM registry")
def _(spark, sf):
    """Each run replaces the table of the one before in one step."""
    path = scratch_path(spark, "table")
    for rows in (roles.periods(spark, sf), roles.registry(spark, sf)):
        writers.replace_table(rows.select("siren", roles.NAF), path)
    return readers.read_replaced(spark, path)

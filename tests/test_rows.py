import pytest
from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.operators import filters, joins
from goldrec.operators.consolidate import union_all


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_all_truthy_lets_null_pass(spark):
    flags = vocab.DIGITAL_SURVEY_FLAGS
    base = ["1"] * len(flags)
    cases = {"all": base, "zero": ["0", *base[1:]], "null": [None, *base[1:]], "nulls": [None] * len(flags), "false": ["False", *base[1:]]}
    df = spark.createDataFrame([(k, *v) for k, v in cases.items()], ", ".join(f"{c} string" for c in ["id", *flags]))
    assert rows(filters.all_truthy(df, flags), "id") == [("all",), ("null",), ("nulls",)]


def test_legal_form_as_int_text_or_float(spark):
    df = spark.createDataFrame([("9220",), ("9220.0",), ("x",), (None,), ("1000",)], "f string")
    kept = df.where(filters.legal_form_in("f", vocab.SOCIAL_LEGAL_FORMS))
    assert rows(kept, "f") == [("9220",), ("9220.0",)]
    ints = spark.createDataFrame([(9220,), (1,)], "f int")
    assert ints.where(filters.legal_form_in("f", vocab.SOCIAL_LEGAL_FORMS)).count() == 1


def test_normalize_candidate(spark):
    df = spark.createDataFrame([("12345", "a"), ("ABC", "b"), ("333333333.0", "c"), ("1234567890", "d"), (None, "e")], "siren string, NOM string")
    shaped = filters.normalize_candidate(df, "tiers_lieux", vocab.SURVEY_RENAMES, {"extra": "val"})
    assert rows(shaped, "siren", "denomination", "_origin", "extra") == [
        ("000012345", "a", "tiers_lieux", "val"),
        ("333333333", "c", "tiers_lieux", "val"),
    ]


def test_provenance(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "e boolean")
    got = [r[0] for r in df.select(filters.provenance(["sirene"], {"esus": F.col("e")})).collect()]
    assert got == ["esus|sirene", "sirene", "sirene"]


def test_with_provenance_keeps_a_method(spark):
    df = spark.createDataFrame([("via_rna",), (None,)], "methode_jointure string")
    assert rows(filters.with_provenance(df, ["a", "b"], "scoring"), "methode_jointure", "sources") == [("scoring", "a|b"), ("via_rna", "a|b")]


def test_select_present_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "naf int, siren int, other int")
    assert filters.select_present(df, vocab.EXPORT_COLUMNS).columns == ["siren", "naf"]


def test_column_names(spark):
    assert filters.clean_column_name(" Code -> postal (Établissement) ") == "code_postal_etablissement"
    assert filters.number_repeats(["a", "b", "a", "a"]) == ["a", "b", "a_1", "a_2"]
    df = spark.createDataFrame([(1, 2, 3)], "`Nom ` int, `nom` int, `N°` int")
    assert filters.clean_columns(df).columns == ["nom", "nom_1", "n"]


def test_key_quality(spark):
    df = spark.createDataFrame([("111111111",), ("x",), (None,)], "k string")
    assert tuple(filters.key_quality(df, "k").first()) == (1, 2)


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i int, a string")
    b = spark.createDataFrame([(2, "y")], "i int, b string")
    assert rows(union_all([a, b]), "i", "a", "b") == [(1, "x", None), (2, None, "y")]


def skewed(spark):
    """A third of the rows share one key."""
    return spark.range(900).selectExpr("CASE WHEN id < 300 THEN '000000007' ELSE lpad(CAST(id AS STRING), 9, '0') END AS siren", "id")


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_joins_keep_the_rows_of_a_frequent_key(spark, threshold):
    df = skewed(spark)
    listed = spark.createDataFrame([("7",), ("7.0",), ("500",), (None,)], "k string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        kept = joins.keep_listed(df, listed, "siren", "k")
        assert kept.count() == 301 and kept.columns == df.columns
        flagged = joins.flag_listed(df, listed, "siren", "f", "k")
        assert flagged.count() == 900 and flagged.where("f").count() == 301
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_left_join_ignores_null_keys(spark):
    a = spark.createDataFrame([("1", 1), (None, 2)], "k string, i int")
    b = spark.createDataFrame([("1", "x"), (None, "y")], "k string, v string")
    assert rows(joins.attach(a, b, "k", ["v"]), "i", "v") == [(1, "x"), (2, None)]

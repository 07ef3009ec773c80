import os

import pytest

from goldrec import vocab
from goldrec.catalog import CATALOG
from goldrec.plans import candidates, review

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

REGISTRY = "siren string, denominationUniteLegale string, nomUniteLegale string, sigleUniteLegale string, " \
    "activitePrincipaleUniteLegale string, economieSocialeSolidaireUniteLegale string, " \
    "categorieJuridiqueUniteLegale int, trancheEffectifsUniteLegale string, etatAdministratifUniteLegale string"


@pytest.fixture(scope="module")
def registry(spark):
    rows = [
        ("111111111", "Alpha", None, None, "62.01Z", "O", 9220, "12", "A"),
        ("222222222", "Beta", None, None, "62.01Z", "N", 1000, "03", "A"),
        ("333333333", "Gamma", None, "GM", "01.11Z", "O", 9210, "00", "A"),
        ("444444444", "Delta", None, None, "58.29A", None, 5458, None, "C"),
        ("555555555", "Eps", None, None, None, "O", 9220, None, "A"),
    ]
    return spark.createDataFrame(rows, REGISTRY)


def keys(df):
    return sorted(r.siren for r in df.collect())


def test_flagged(registry):
    got = candidates.flagged_with_digital_code(registry)
    assert keys(got) == ["111111111"] and got.first().trancheEffectifsUniteLegale == "12"
    assert got.first().sources == "sirene" and got.first().methode_jointure == "siren_direct"


def test_flagged_accepts_all_ten_codes(spark):
    rows = [(f"{i:09d}", None, None, None, code, "O", 9220, None, "A") for i, code in enumerate(vocab.DIGITAL_NAF)]
    assert candidates.flagged_with_digital_code(spark.createDataFrame(rows, REGISTRY)).count() == 10


def test_listed(spark, registry):
    listed = spark.createDataFrame([("111111111",), ("333333333",), ("444444444",), (None,)], "SIREN string")
    got = candidates.listed_with_digital_code(registry, listed)
    assert keys(got) == ["111111111", "444444444"] and got.first().sources == "ess_france|sirene"


def test_form_or_approved(spark, registry):
    got = {r.siren: r for r in candidates.social_form_or_approved(registry, spark.createDataFrame([("222222222.0",)], "key string")).collect()}
    assert set(got) == {"111111111", "222222222", "444444444"}
    assert got["222222222"].sources == "esus|sirene" and got["222222222"].group_cate is None
    assert (got["444444444"].group_naf, got["444444444"].group_cate) == ("group_naf_1", "group_cate_2")


def test_empty_result_is_an_empty_table(registry):
    assert candidates.flagged_with_digital_code(registry.limit(0)).count() == 0


def test_surveyed(spark, registry):
    flags = vocab.DIGITAL_SURVEY_FLAGS
    activities = spark.createDataFrame(
        [("1", *["1"] * 9), ("2", *["1"] * 8, "0"), ("3", *[None] * 9)], ", ".join(f"{c} string" for c in ["ID_UNIQUE", *flags])
    )
    identity = spark.createDataFrame(
        [("1", "alpha !", None, "75001"), ("2", "gamma", None, None), ("3", "??", "GM", None)],
        "ID_UNIQUE string, NOM string, NOM_STRC_PORT string, CODPOST string",
    )
    got = {r.ID_UNIQUE: r for r in candidates.surveyed_places(activities, identity, registry).collect()}
    assert set(got) == {"1", "3"}
    assert (got["1"].siren, got["1"].confiance_jointure, got["1"].CODPOST) == ("111111111", 1.0, "75001")
    assert (got["3"].siren, got["3"].confiance_jointure, got["3"].methode_jointure) == ("333333333", 0.9, "scoring")


def test_review(spark):
    projects = spark.createDataFrame(
        [("a", "https://www.a.fr/x", "c", "p", "FRANCE, Italy"), ("b", None, "c", "p", "France"), ("c", "x", "c", "p", None)],
        "title string, website string, Category string, Project string, Country string",
    )
    table = review.to_review(projects)
    assert table.columns == ["title", "domaine", "website", "Category", "Project", "siren"]
    assert sorted((r.title, r.domaine, r.siren) for r in table.collect()) == [("a", "a.fr", ""), ("b", "", "")]
    organisations = spark.createDataFrame([("000000001",), ("000000002",)], "siren string")
    tagged = review.from_review(organisations, table.selectExpr("'1' AS siren"))
    assert {r.siren: r.tag_ngi for r in tagged.collect()} == {"000000001": True, "000000002": False}


def test_every_query_has_a_check():
    assert set(CATALOG.queries) == set(CATALOG.sql)
    assert not any("pipeline" in name for name in CATALOG.queries)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(CATALOG.queries))
def test_query_equals_its_sql(spark, duck, name):
    df = CATALOG.queries[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    relation = duck.sql(CATALOG.sql[name])
    assert sorted(relation.columns) == columns
    places = [relation.columns.index(c) for c in columns]
    wanted = sorted((tuple(plain(r[i]) for i in places) for r in relation.fetchall()), key=str)
    assert got == wanted

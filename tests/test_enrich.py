import pytest
from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.functions.codes import lenient_timestamp
from goldrec.operators import enrich as E
from goldrec.operators import joins, keyfilter, quality
from goldrec.plans import golden

REGISTRY = ["siren", "dateDebut", "nicSiegeUniteLegale", *[c for c, _, _ in vocab.ENRICH_FIELDS]]


@pytest.fixture(scope="module")
def registry(spark):
    def row(siren, start, nic, **fields):
        return tuple({"siren": siren, "dateDebut": start, "nicSiegeUniteLegale": nic, **fields}.get(c) for c in REGISTRY)

    rows = [
        row("111111111", "2023-01-01", "00012", activitePrincipaleUniteLegale="62.01Z", categorieJuridiqueUniteLegale="9220",
            denominationUniteLegale="ALPHA NUM SAS", etatAdministratifUniteLegale="A", economieSocialeSolidaireUniteLegale="O",
            trancheEffectifsUniteLegale="12", identifiantAssociationUniteLegale="W123456789", categorieEntreprise="PME"),
        row("222222222", "2020-01-01", "00099", activitePrincipaleUniteLegale="01.11Z", denominationUniteLegale="OLD",
            etatAdministratifUniteLegale="A"),
        row("222222222", "2024-06-01", "00025", activitePrincipaleUniteLegale="62.02A", denominationUniteLegale="BETA COOP",
            etatAdministratifUniteLegale="C", economieSocialeSolidaireUniteLegale="N", trancheEffectifsUniteLegale="  "),
        row("222222222", "not a date", "00001", denominationUniteLegale="UNDATED"),
        row("333333333", "2022-01-01", "ABC", denominationUniteLegale="GAMMA"),
        row("777777777", "2022-01-01", "00001", denominationUniteLegale="UNWANTED"),
    ]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in REGISTRY))


def test_latest_period_wins(registry):
    latest = E.latest_per_key(registry, "siren", lenient_timestamp(F.col("dateDebut")), "nicSiegeUniteLegale")
    got = {r.siren: r.nicSiegeUniteLegale for r in latest.collect()}
    assert got == {"111111111": "00012", "222222222": "00025", "333333333": "ABC", "777777777": "00001"}


def test_rank_limit_runs_before_the_shuffle(registry):
    latest = E.latest_per_key(registry, "siren", lenient_timestamp(F.col("dateDebut")), "nicSiegeUniteLegale")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_only_wanted_keys(spark, registry):
    wanted = spark.createDataFrame([("222222222",), ("999999999",), (None,)], "siren string")
    got = E.registry_for_keys(registry, wanted, "siren", "dateDebut", ["denominationUniteLegale"], "nicSiegeUniteLegale")
    assert [r.denominationUniteLegale for r in got.collect()] == ["BETA COOP"]


def consolidated(spark, rows):
    names = ["siren", "denomination", "naf", "categorie_juridique", "famille_ess", "naf_numerique", "tags_numerique"]
    schema = ", ".join(f"{n} {'boolean' if n == 'naf_numerique' else 'string'}" for n in names)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


@pytest.fixture(scope="module")
def enriched(spark, registry):
    rows = [
        {"siren": "111111111", "denomination": "Kept", "naf": None, "naf_numerique": False},
        {"siren": "222222222", "denomination": "", "naf": "58.29A", "naf_numerique": True, "tags_numerique": "edition_logiciel"},
        {"siren": "333333333", "denomination": "  "},
        {"siren": "999999999"},
    ]
    return {r.siren: r for r in E.enrich(consolidated(spark, rows), registry).collect()}


def test_filled_and_traced(enriched):
    r = enriched["111111111"]
    assert (r.naf, r.naf_enrich_source, r.naf_enrich_method) == ("62.01Z", "sirene", "siren_direct")
    assert (r.est_active, r.flag_ess_sirene, r.rna, r.categorie_entreprise) == (True, True, "W123456789", "PME")
    assert r.siret_siege == "11111111100012" and r.siret_siege_enrich_source == "sirene"


def test_never_overwrites(enriched):
    assert enriched["111111111"].denomination == "Kept" and enriched["111111111"].denomination_enrich_source is None
    assert enriched["222222222"].naf == "58.29A" and enriched["222222222"].naf_enrich_source is None


def test_empty_text_is_filled_and_blank_offers_are_not(enriched):
    r = enriched["222222222"]
    assert (r.denomination, r.denomination_enrich_source) == ("BETA COOP", "sirene")
    assert r.tranche_effectifs is None and r.tranche_effectifs_enrich_source is None
    assert r.est_active is False and r.flag_ess_sirene is None and r.flag_ess_sirene_enrich_source is None


def test_bad_site_number(enriched):
    assert enriched["333333333"].siret_siege is None and enriched["333333333"].denomination == "GAMMA"


def test_unknown_key(enriched):
    r = enriched["999999999"].asDict()
    assert all(v is None for k, v in r.items() if k.endswith(("_enrich_source", "_enrich_method")))


def test_rederived_only_where_filled(enriched):
    assert (enriched["111111111"].famille_ess, enriched["111111111"].naf_numerique, enriched["111111111"].tags_numerique) == (
        "association", True, "dev_logiciel",
    )
    assert (enriched["222222222"].naf_numerique, enriched["222222222"].tags_numerique) == (True, "edition_logiciel")
    assert enriched["222222222"].famille_ess is None


def test_all_thirty_trace_columns(spark, registry):
    df = spark.createDataFrame([("111111111", "x", None)], "siren string, denomination string, naf string")
    columns = E.enrich(df, registry.select("siren", "dateDebut", "activitePrincipaleUniteLegale")).columns
    assert sum(c.endswith(("_enrich_source", "_enrich_method")) for c in columns) == 30


def test_rederive_clears_a_wrong_tag(spark):
    df = spark.createDataFrame(
        [("01.11Z", "sirene", True, "dev_logiciel", None, None), ("62.01Z", None, False, None, "9220", None)],
        "naf string, naf_enrich_source string, naf_numerique boolean, tags_numerique string, categorie_juridique string, famille_ess string",
    )
    got = [(r.naf_numerique, r.tags_numerique, r.famille_ess) for r in E.rederive(df).collect()]
    assert got == [(False, None, None), (False, None, None)]


def test_site_id_is_kept(spark):
    df = spark.createDataFrame([("111111111", "11111111199999")], "siren string, siret_siege string")
    filled = E.fill_blank(df, {"siret_siege": E.site_id(F.col("siren"), F.lit("00012"))})
    assert filled.first().siret_siege == "11111111199999"


def test_fill_counts(spark, registry):
    df = E.enrich(consolidated(spark, [{"siren": "111111111"}, {"siren": "222222222"}]), registry)
    counts = {r.field: r.n_filled for r in E.fill_counts(df, ["naf", "rna", "siret_siege"]).collect()}
    assert counts == {"naf": 2, "rna": 1, "siret_siege": 2, "TOTAL": 5}


# -- quality and export ------------------------------------------------------------


def test_completeness(spark):
    df = spark.createDataFrame([("a", None, "x"), (None, None, None)], "denomination string, naf string, rna string")
    assert [r.score_enrichissement for r in quality.completeness(df).collect()] == [0.67, 0.0]
    assert quality.completeness(spark.range(1)).first().score_enrichissement is None


def test_export_columns(spark, registry):
    df = E.enrich(consolidated(spark, [{"siren": "111111111"}]), registry)
    exported = golden.export_records(df)
    assert exported.columns == [c for c in vocab.EXPORT_COLUMNS if c in exported.columns]
    assert not any("__" in c or "_enrich_" in c for c in exported.columns) and exported.columns[-1] == "score_enrichissement"
    assert golden.export_records(df.limit(0)).count() == 0


def test_violations(spark):
    rows = [
        ("111111111", None, None, 0.5),
        ("12345", "11111111100012", "W123456789", 1.0),
        ("111111111", "123", "X123456789", 1.2),
        (None, "", "", None),
    ]
    df = spark.createDataFrame(rows, "siren string, siret_siege string, rna string, confiance_jointure double")
    got = [r.violations for r in quality.validate(df).collect()]
    assert got == [[], ["siren"], ["siret_siege", "rna", "confiance_jointure"], ["siren"]]
    with pytest.raises(Exception, match="invalid record"):
        quality.validate(df, strict=True).collect()


def test_flat_record(spark):
    df = spark.createDataFrame(
        [("62.01Z", "9220", None, False, ["fablab"], ["sirene", "esus"]), ("x", "", "mutuelle", False, None, None)],
        "naf string, categorie_juridique string, famille_ess string, naf_numerique boolean, tags_numerique array<string>, sources array<string>",
    ).withColumns({"date_creation": F.lit(None).cast("date"), "date_integration": F.to_date(F.lit("2024-02-01"))})
    one, two = quality.flatten_record(quality.complete_record(df)).collect()
    assert (one.famille_ess, one.naf_numerique, one.tags_numerique, one.sources) == ("association", True, "dev_logiciel|fablab", "esus|sirene")
    assert (two.famille_ess, two.naf_numerique, two.tags_numerique, two.sources) == ("mutuelle", False, None, "")
    assert one.date_creation is None and one.date_integration == "2024-02-01"


def test_tag_listed(spark):
    df = spark.createDataFrame([("1",), ("2",)], "siren string")
    reviewed = spark.createDataFrame([("1",), ("",), (None,)], "siren string")
    assert {r.siren: r.tag_ngi for r in quality.tag_listed(df, reviewed, "siren").collect()} == {"1": True, "2": False}


def periods(spark, n):
    """n keys with three periods each, of which every fortieth is wanted."""
    key = F.lpad(F.col("id").cast("string"), 9, "0")
    start = F.concat(F.lit("20"), F.lpad((F.col("k") * 7 % 24).cast("string"), 2, "0"), F.lit("-01-01"))
    rows = spark.range(n).select(key.alias("siren"), F.explode(F.array(*[F.lit(k) for k in range(3)])).alias("k"), "id")
    table = rows.select("siren", start.alias("dateDebut"), F.concat("siren", F.lit("-"), "k").alias("name"))
    return table, spark.range(0, n, 40).select(key.alias("siren")).union(spark.createDataFrame([("no such",), (None,)], "siren string"))


def test_filter_of_wanted_keys_passes_little_else(spark):
    table, wanted = periods(spark, 40_000)
    passed = keyfilter.may_be_wanted(table, "siren", wanted, "siren", 1_002).select("siren", "name").collect()
    expected = {r.name for r in table.join(wanted, "siren").collect()}
    assert expected <= {r.name for r in passed} and len(passed) <= 1.05 * len(expected)


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_wanted_rows_are_the_same_in_both_plans(spark, threshold):
    table, wanted = periods(spark, 4_000)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = E.registry_for_keys(table, wanted, "siren", "dateDebut", ["name"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.siren, r.dateDebut, r.name) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == [(f"{i:09d}", "2014-01-01", f"{i:09d}-2") for i in range(0, 4_000, 40)]
    assert ("Subquery" in plan) == (threshold == "-1") and plan.count("WindowGroupLimit") == 2
    assert "SortAggregate" not in plan


def test_filter_size_follows_the_keys():
    assert keyfilter.filter_words(0) == 1 and keyfilter.filter_words(1000) == 512
    assert keyfilter.filter_words(50_000_000) == keyfilter.MAX_WORDS and keyfilter.filter_words(60_000_000) == 0


def test_broadcast_size_of_the_session(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, size in (("-1", 0), ("10485760b", 10 << 20), ("256k", 256 << 10), ("2GB", 2 << 30), ("7", 7)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert joins.broadcast_bytes(spark) == size
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sources_outside_the_vocabulary_are_violations(spark):
    df = spark.createDataFrame([("esus|sirene",), ("sirene|nowhere",), ("",), (None,)], "sources string")
    assert [r.violations for r in quality.validate(df).collect()] == [[], ["sources"], [], []]

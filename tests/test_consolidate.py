import random

import pytest

from pyspark.sql import functions as F

from goldrec import vocab
from goldrec.operators import consolidate as C
from goldrec.plans import golden

SCHEMA = (
    "siren string, _origin string, _row long, sources string, methode_jointure string, confiance_jointure double, "
    "denomination string, naf string, group_naf string"
)
ORIGINS = ["a", "b", "c"]


def build(spark, rows):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SCHEMA)


def one(spark, *rows, origins=ORIGINS):
    rows = [{"siren": "1", "_origin": "a", "_row": i, **r} for i, r in enumerate(rows)]
    return C.consolidate(build(spark, rows), origins=origins, row_order="_row").first()


@pytest.mark.parametrize(
    "given, expected",
    [
        (["sirene"], "sirene"),
        (["sirene", "ess_france|esus"], "ess_france|esus|sirene"),
        (["sirene|ess_france", "ess_france"], "ess_france|sirene"),
        ([None, None], ""),
    ],
)
def test_sources(spark, given, expected):
    assert one(spark, *[{"sources": s} for s in given]).sources == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        (["scoring"], "scoring"),
        (["scoring", "siren_direct"], "siren_direct"),
        (["guess", "manuel"], "manuel"),
        (["guess", "other"], "guess"),
        ([None], None),
    ],
)
def test_best_method(spark, given, expected):
    assert one(spark, *[{"methode_jointure": m} for m in given]).methode_jointure == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ([("scoring", 0.6), ("scoring", 0.9)], 0.9),
        ([("siren_direct", None)], 1.0),
        ([("siren_direct", None), ("scoring", 0.85)], 0.85),
        ([("scoring", None)], None),
    ],
)
def test_confidence(spark, given, expected):
    rows = [{"methode_jointure": m, "confiance_jointure": c} for m, c in given]
    assert one(spark, *rows).confiance_jointure == expected


def test_equal_values_are_no_conflict(spark):
    r = one(spark, {"denomination": "Same"}, {"_origin": "b", "denomination": " Same "})
    assert r.denomination == "Same" and r.conflicts is None


def test_differing_values(spark):
    r = one(spark, {"_origin": "b", "denomination": "B"}, {"denomination": "A"}, {"_origin": "c", "denomination": None})
    assert r.denomination == "A" and r.conflicts == {"denomination": {"a": "A", "b": "B"}}
    assert r.origines == "a|b|c"


def test_blank_is_no_value(spark):
    r = one(spark, {"denomination": "  "}, {"_origin": "b", "denomination": "OnlyOne"})
    assert r.denomination == "OnlyOne" and r.conflicts is None
    assert one(spark, {"denomination": None}).denomination is None


def test_last_value_of_a_repeated_origin(spark):
    r = one(spark, {"denomination": "x"}, {"denomination": "y"}, {"denomination": "x"})
    assert r.denomination == "x" and r.conflicts == {"denomination": {"a": "x"}}


def test_first_pass_through_value(spark):
    assert one(spark, {"group_naf": None}, {"_origin": "b", "group_naf": "g2"}, {"_origin": "c", "group_naf": "g3"}).group_naf == "g2"


def test_wide_conflicts_and_counts(spark):
    rows = [
        {"siren": "1", "_origin": "a", "_row": 0, "denomination": "x", "naf": "n"},
        {"siren": "1", "_origin": "b", "_row": 1, "denomination": "y", "naf": "n"},
        {"siren": "2", "_origin": "a", "_row": 2, "denomination": "z"},
    ]
    records = C.consolidate(build(spark, rows), origins=ORIGINS, row_order="_row")
    wide = {r.siren: r for r in C.widen_conflicts(records, origins=ORIGINS).collect()}
    assert (wide["1"].denomination__a, wide["1"].denomination__b, wide["1"].denomination__c) == ("x", "y", None)
    assert wide["2"].denomination__a is None and wide["1"].naf__a is None
    counts = {r.attribute: (r.n_conflicts, r.pct_of_keys) for r in C.conflict_counts(records).collect()}
    assert counts["denomination"] == (1, 50.0) and counts["naf"] == (0, 0.0) and len(counts) == 8


def reference_resolve(group, attr):
    """What a group must give, one row after the other."""
    pairs = [(r["_origin"], r[attr].strip()) for r in group if r.get(attr) and r[attr].strip()]
    if not pairs:
        return None, None
    main = pairs[0][1]
    return main, (dict(pairs) if len({v for _, v in pairs}) > 1 else None)


def test_random_groups_match_a_row_by_row_merge(spark):
    rng = random.Random(5)
    rows = [
        {
            "siren": str(rng.choice([1, 1, 1, rng.randrange(40)])),
            "_origin": rng.choice(ORIGINS),
            "_row": i,
            "denomination": rng.choice([None, "", " ", "x", "y ", "z"]),
            "naf": rng.choice([None, "n", "m"]),
        }
        for i in range(600)
    ]
    df = build(spark, rows)
    got = {}
    for parts in (1, 5):
        for r in C.consolidate(df.repartition(parts), origins=ORIGINS, row_order="_row").collect():
            got.setdefault(r.siren, []).append((r.denomination, r.naf, r.conflicts))
    rows.sort(key=lambda r: (ORIGINS.index(r["_origin"]), r["_row"]))
    for siren, results in got.items():
        group = [r for r in rows if r["siren"] == siren]
        (d, dv), (n, nv) = reference_resolve(group, "denomination"), reference_resolve(group, "naf")
        conflicts = {k: v for k, v in (("denomination", dv), ("naf", nv)) if v}
        assert results == [(d, n, conflicts or None)] * 2


def test_default_order_does_not_depend_on_partitions(spark):
    rows = [{"siren": "1", "_origin": "a", "_row": 0, "denomination": f"v{i}"} for i in range(50)]
    df = build(spark, rows).drop("_row")
    seen = {C.consolidate(df.repartition(n), origins=ORIGINS).first().denomination for n in (1, 3, 6)}
    assert len(seen) == 1


@pytest.fixture(scope="module")
def four_tables(spark):
    registry = "siren string, denominationUniteLegale string, nomUniteLegale string, activitePrincipaleUniteLegale string, " \
        "categorieJuridiqueUniteLegale string, trancheEffectifsUniteLegale string, sources string, methode_jointure string, " \
        "confiance_jointure double, group_naf string, group_cate string"
    first = spark.createDataFrame(
        [
            ("111111111", "AlphaNum", None, "62.01Z", None, None, "ess_france|sirene", "siren_direct", None, None, None),
            ("222222222", "BetaCoop", None, "62.02A", None, None, "ess_france|sirene", "siren_direct", None, None, None),
            ("333333333.0", "GammaLab", None, "62.03Z", None, None, "sirene", "siren_direct", 1.0, None, None),
        ],
        registry,
    )
    second = spark.createDataFrame(
        [
            ("222222222", "BetaCoop", None, "62.02A", "5458.0", "12", "sirene", "siren_direct", None, "group_naf_2", "group_cate_2"),
            ("333333333", "GammaLab-Alt", None, "62.03Z", "9220", None, "esus|sirene", "scoring", 0.85, None, None),
            ("444444444", "DeltaSoft", None, "58.29C", "6317", None, "sirene", "siren_direct", None, "group_naf_1", "group_cate_1"),
        ],
        registry,
    )
    third = spark.createDataFrame(
        [
            ("333333333", "GammaFab", "PortGamma", "69001", "https://gamma.org", "tiers_lieux", "scoring", 0.72),
            ("555555555", "EpsilonLieu", None, "75013", "https://epsilon.org", "tiers_lieux", "scoring", 0.80),
            (None, "Unknown", None, None, None, "tiers_lieux", "scoring", None),
        ],
        "siren string, NOM string, NOM_STRC_PORT string, CODPOST string, INTERNET string, sources string, methode_jointure string, confiance_jointure double",
    )
    fourth = spark.createDataFrame(
        [
            ("111111111", "AlphaNum", None, "62.01Z", "9220", "03", "sirene", "siren_direct", None, None, None),
            ("666666666", "ZetaESS", "Zeta", "63.11Z", "5710", None, "sirene", "siren_direct", None, None, None),
        ],
        registry,
    )
    return dict(zip(vocab.ORIGINS, (first, second, third, fourth)))


def test_four_tables(four_tables):
    wide = C.widen_conflicts(golden.consolidate_candidates(four_tables))
    got = {r.siren: r for r in wide.collect()}
    assert set(got) == {c * 9 for c in "123456"}
    r1, r2, r3, r4, r5, r6 = (got[c * 9] for c in "123456")
    assert (r1.origines, r1.confiance_jointure, r1.tags_numerique) == ("ess_flag_insee|ess_x_naf", 1.0, "dev_logiciel")
    assert r1.famille_ess == "association" and r1.tranche_effectifs == "03"
    assert (r2.denomination, r2.denomination__ess_x_naf, r2.famille_ess) == ("BetaCoop", None, "cooperative")
    assert (r2.group_naf, r2.group_cate) == ("group_naf_2", "group_cate_2")
    assert (r3.denomination__ess_x_naf, r3.denomination__cate_x_naf, r3.denomination__tiers_lieux) == ("GammaLab", "GammaLab-Alt", "GammaFab")
    assert (r3.methode_jointure, r3.confiance_jointure, r3.famille_ess) == ("siren_direct", 1.0, "association")
    assert r3.naf_numerique and r3.nom_structure_porteuse == "PortGamma" and r3.sources == "esus|sirene|tiers_lieux"
    assert (r4.origines, r4.tags_numerique) == ("cate_x_naf", "edition_logiciel")
    assert (r5.code_postal, r5.site_web, r5.confiance_jointure, r5.naf_numerique) == ("75013", "https://epsilon.org", 0.8, False)
    assert r6.denomination == "ZetaESS" and r6.naf_numerique and r6.famille_ess is None


def test_consolidation_shuffles_once(four_tables):
    plan = golden.consolidate_candidates(four_tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_known_sets_are_bits(spark):
    rows = [("a", "esus|sirene", "o1"), ("a", "sirene", "o2"), ("a", None, "o1"), ("b", None, None), ("c", "ngi|avise|sirene", "o3")]
    df = spark.createDataFrame(rows, "k string, s string, o string")
    grouped = df.groupBy("k").agg(
        C.agg_known_set(F.col("s"), vocab.SOURCES).alias("s"), C.agg_known_set(F.col("o"), ["o3", "o2", "o1"]).alias("o")
    )
    assert {r.k: (r.s, r.o) for r in grouped.collect()} == {"a": ("esus|sirene", "o1|o2"), "b": ("", ""), "c": ("avise|ngi|sirene", "o3")}
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    with pytest.raises(Exception, match="unlisted value nowhere"):
        df.groupBy("k").agg(C.agg_known_set(F.lit("sirene|nowhere"), vocab.SOURCES)).collect()


def test_sources_of_the_vocabulary_and_any_others(spark):
    rows = [("111111111", "sirene", "ess_x_naf"), ("111111111", "own", "tiers_lieux")]
    df = spark.createDataFrame(rows, "siren string, sources string, _origin string")
    assert C.consolidate(df).first().sources == "own|sirene"
    with pytest.raises(Exception, match="unlisted source own"):
        C.consolidate(df, known_sources=vocab.SOURCES).collect()

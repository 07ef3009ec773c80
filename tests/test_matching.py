import random
import re

import pytest
from pyspark.sql import functions as F

from goldrec.functions.text import normalize_name, sort_tokens
from goldrec.operators import matching as M
from goldrec.operators import nameindex


def common_letters(a, b):
    """Textbook longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def plain_norm(name):
    return re.sub(r"[^a-z0-9]+", " ", (name or "").lower()).strip()


def plain_sort(name):
    return " ".join(sorted(name.split(" ")))


def plain_score(a, b):
    a, b = plain_sort(a), plain_sort(b)
    return 200 * common_letters(a, b) / (len(a) + len(b))


WORDS = "association amis numerique atelier lab fab cafe centre social maison ville aaa aaaa la le 42 x".split()


def some_name(rng):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 4)))


def damaged(rng, name):
    letters = list(name)
    for _ in range(rng.randint(0, 6)):
        at = rng.randrange(len(letters)) if letters else 0
        if letters and rng.random() < 0.5:
            del letters[at]
        else:
            letters.insert(at, rng.choice("abcdeilmn 0"))
    return "".join(letters)


@pytest.mark.parametrize("seed", range(3))
def test_score_is_the_textbook_one(seed):
    rng = random.Random(seed)
    for _ in range(200):
        a, b = damaged(rng, some_name(rng)), damaged(rng, some_name(rng))
        if a or b:
            assert M.similarity(a, b) == pytest.approx(200 * common_letters(a, b) / (len(a) + len(b)))
    assert M.similarity("", "") == 0.0 and M.similarity("cycle2", "cycle") == pytest.approx(1000 / 11)


REGISTRY = [
    ("000000001", "Cycle", None, "A"),
    ("000000002", "Été à la Plage", "EALP", "A"),
    ("000000003", "Été à la plage !", None, "A"),
    ("000000004", "Closed Company", None, "C"),
    ("000000005", None, "ZZTOP", "A"),
    ("000000006", "abcdefgh", None, "A"),
    ("000000007", "aaaaaaaab", None, "A"),
    ("000000008", "aaaaaaaac", None, "A"),
    ("000000009", "", " !", "A"),
]


@pytest.fixture(scope="module")
def index(spark):
    registry = spark.createDataFrame(REGISTRY, "siren string, name string, acr string, status string")
    return M.build_name_index(registry, "siren", ["name", "acr"], F.col("status") == "A")


def test_index(index):
    got = {r.norm: r.key for r in index.collect()}
    assert got == {
        "cycle": "000000001",
        "ete a la plage": "000000002",
        "ealp": "000000002",
        "zztop": "000000005",
        "abcdefgh": "000000006",
        "aaaaaaaab": "000000007",
        "aaaaaaaac": "000000008",
    }


QUERIES = {
    "exact": ("ETE A LA PLAGE", None, "000000002", 1.0, 1),
    "acronym": ("e.a.l.p", None, None, None, None),
    "acronym whole": ("EALP", None, "000000002", 1.0, 1),
    "alternative": ("nothing at all", "zztop", "000000005", 0.9, 2),
    "swapped words": ("plage ete la a", None, "000000002", 1.0, 3),
    "fuzzy": ("Cycle²", "Cycle²", "000000001", 0.91, 3),
    "equal scores": ("aaaaaaaad", None, "000000007", 0.89, 3),
    "exactly 80": ("abcdefghijkl", None, "000000006", 0.8, 3),
    "below 80": ("abcdefghijklm", None, None, None, None),
    "closed": ("Closed Company", None, None, None, None),
    "no names": (None, None, None, None, None),
    "alternative scores higher": ("abcdefghxy", "abcdefghx", "000000006", 0.94, 3),
}


def test_cascade(spark, index):
    rows = [(k, v[0], v[1]) for k, v in QUERIES.items()]
    df = spark.createDataFrame(rows, "id string, NOM string, NOM_STRC_PORT string")
    resolved = M.resolve_by_name(df, index)
    got = {r.id: (r.siren, r.confiance_jointure, r.match_pass) for r in resolved.collect()}
    assert got == {k: v[2:] for k, v in QUERIES.items()}
    methods = {(r.siren is None, r.methode_jointure) for r in resolved.collect()}
    assert methods == {(True, None), (False, "scoring")}
    assert {r.match_pass: r.n for r in M.match_summary(resolved).collect()} == {0: 4, 1: 2, 2: 1, 3: 5}


def test_without_fuzzy_and_without_alternative(spark, index):
    df = spark.createDataFrame([("x", "zztop"), ("cycle", None)], "NOM string, other string")
    got = M.resolve_by_name(df, index, alt_name="NOM_STRC_PORT", fuzzy=False)
    assert [(r.NOM, r.siren) for r in got.orderBy("NOM").collect()] == [("cycle", "000000001"), ("x", None)]


def test_threshold_below_the_bound_is_refused(spark, index):
    with pytest.raises(ValueError):
        M.fuzzy_lookup(spark.createDataFrame([("a",)], "text string"), index, 60)


def test_nothing_is_lost_against_brute_force(spark, monkeypatch):
    """Every query finds the best entry, with the queries broadcast and shuffled."""
    rng = random.Random(11)
    names = [some_name(rng) for _ in range(150)] + [damaged(rng, some_name(rng)) for _ in range(100)]
    asked = [damaged(rng, rng.choice(names)) for _ in range(120)] + ["a", "aa", "aaaaaaa", "x x x"]
    first = {}
    for i, n in enumerate(names):
        if plain_norm(n):
            first.setdefault(plain_norm(n), i)
    registry = spark.createDataFrame(list(enumerate(names)), "k int, name string")
    texts = spark.createDataFrame([(plain_norm(a),) for a in asked if plain_norm(a)], "text string").distinct()
    index = M.build_name_index(registry, "k", ["name"])

    expected = {}
    for text in {plain_norm(a) for a in asked} - {""}:
        best = max(((plain_score(text, n), -i) for n, i in first.items()), default=(0, 0))
        if best[0] >= 80 - 1e-9:
            expected[text] = (round(best[0], 6), -best[1])
    for limit in (M.BROADCAST_BYTES, 0):
        monkeypatch.setattr(M, "BROADCAST_BYTES", limit)
        got = {r.text: (round(r.score, 6), r.key) for r in M.fuzzy_lookup(texts, index).collect()}
        assert got == expected


def test_similar_pairs_are_an_equi_join(spark, index):
    def prepared(df, *columns):
        return df.select(
            *columns, F.col(columns[0]).alias("sorted"), F.length(columns[0]).alias("n"),
            M._codes(F.col(columns[0])).alias("codes"), F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high"),
            F.monotonically_increasing_id().alias("id"),
        )

    texts = spark.createDataFrame([("cycles",)], "text string")
    pairs = M.similar_pairs(prepared(texts, "text"), prepared(index, "norm", "key", "ord"), list(range(M.N_GRAMS)), 0, 80, False)
    physical = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in physical and "Cartesian" not in physical


def test_one_name_in_a_third_of_the_rows(spark, index):
    df = spark.range(600).selectExpr(
        "CASE WHEN id < 200 THEN 'Cycle²' WHEN id < 300 THEN 'cycle' ELSE 'unknown ' || id END AS NOM"
    )
    resolved = M.resolve_by_name(df, index, alt_name=None)
    assert {r.match_pass: r.n for r in M.match_summary(resolved).collect()} == {1: 100, 3: 200, 0: 300}


def test_sorted_words(spark):
    df = spark.createDataFrame([("Plage, Été",)], "x string")
    assert df.select(sort_tokens(normalize_name(df.x))).first()[0] == "ete plage"


# stored index


def stored_example(spark, seed=21):
    rng = random.Random(seed)
    names = sorted({plain_norm(some_name(rng)) for _ in range(150)} - {""})
    rows = [(n, f"k{i:04d}", (f"k{i:04d}", 0)) for i, n in enumerate(names)]
    index = spark.createDataFrame(rows, "norm string, key string, ord struct<position: string, i: int>")
    asked = sorted({plain_norm(damaged(rng, rng.choice(names))) for _ in range(80)} - {""})
    return index, spark.createDataFrame([(t,) for t in asked], "text string"), {n: k for n, k, _ in rows}


def found(df):
    return sorted((r.text, round(r.score, 6), r.key) for r in df.collect())


def test_stored_index_finds_what_a_search_finds(spark, tmp_path):
    index, texts, names = stored_example(spark)
    stored = nameindex.store_index(index, str(tmp_path / "index"))
    expected = found(M.fuzzy_lookup(texts, index))
    assert found(stored.lookup(texts)) == expected and len(expected) > 20
    for text, score, key in expected:
        best = max(plain_score(text, n) for n in names)
        assert score == pytest.approx(best, abs=1e-5) and key == min(k for n, k in names.items() if plain_score(text, n) >= best - 1e-9)
    assert found(stored.lookup(texts.limit(0))) == []


def test_stored_index_is_opened_again(spark, tmp_path):
    index, texts, _ = stored_example(spark, 22)
    expected = found(nameindex.store_index(index, str(tmp_path / "index")).lookup(texts))
    again = nameindex.open_index(spark, str(tmp_path / "index"))
    assert again.levels == [90, 80] and found(again.lookup(texts)) == expected


def test_lookup_does_not_move_the_index(spark, tmp_path, monkeypatch):
    index, texts, _ = stored_example(spark, 23)
    monkeypatch.setattr(nameindex, "BUCKET_BYTES", 4096)
    stored = nameindex.store_index(index, str(tmp_path / "index"))
    assert stored.buckets["pairs_80"] > 4
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        queries = M.spelled_names(texts, "text")
        plan = stored.similar(queries, 80)._jdf.queryExecution().executedPlan().toString().splitlines()
        assert found(stored.lookup(texts)) == found(M.fuzzy_lookup(texts, index))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for at, line in enumerate(plan):
        if "FileScan" in line and "Bucketed: true" in line:
            depth = line.index("FileScan")
            above = []
            for earlier in reversed(plan[:at]):
                here = len(earlier) - len(earlier.lstrip(" :+-"))
                if here < depth:
                    above.append(earlier.strip(" :+-"))
                    depth = here
                if "SortMergeJoin" in earlier:
                    break
            assert not any(a.startswith("Exchange") for a in above), above
    assert sum("Bucketed: true" in line for line in plan) == 2


def test_empty_index(spark, tmp_path):
    index, texts, _ = stored_example(spark)
    stored = nameindex.store_index(index.limit(0), str(tmp_path / "index"))
    assert found(stored.lookup(texts)) == []
    with pytest.raises(ValueError):
        nameindex.store_index(index, levels=(50,))


def test_entities_in_other_scripts_resolve(spark):
    rows = [("1", "Ευρωπαϊκή Ένωση Λάμπα", None), ("2", "ООО «Москва Щёкино»", None), ("3", "Lampa Latin", "ΕΛ ΤΑ")]
    index = M.build_name_index(spark.createDataFrame(rows, "siren string, name string, acr string"), "siren", ["name", "acr"])
    asked = [("a", "EVROPAIKI ENOSI LAMPA"), ("b", "ООО Москва-Щекино"), ("c", "Ευρωπαϊκη Ενωσις Λαμπα"), ("d", "ooo moskva shchekin"), ("e", "el ta")]
    got = M.resolve_by_name(spark.createDataFrame(asked, "id string, NOM string"), index, alt_name=None)
    found = {r.id: (r.siren, r.match_pass) for r in got.collect()}
    assert found["a"] == ("1", 1) and found["c"] == ("1", 3) and found["d"] == ("2", 3) and found["e"] == ("3", 1)
    assert found["b"][0] == "2"

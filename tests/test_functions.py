import unicodedata

import pytest

from goldrec import vocab
from goldrec.functions import codes, text


def test_normalize_name(values):
    names = ["L'Étoile  d’Or", "Cycle²", "CŒUR & Æther", "Straße", None, "", "   ", "A&amp;B", "Łódź-Ørsted", "日本 lab", "ﬁn"]
    assert values(text.normalize_name, names) == [
        "l etoile d or", "cycle2", "coeur aether", "strasse", "", "", "", "a amp b", "lodz orsted", "lab", "n",
    ]


def test_canonical_key_pads_but_never_cuts(values):
    raw = ["12345", "333333333.0", "ABC", "1234567890", " 42\t", None]
    assert values(text.canonical_key, raw) == ["000012345", "333333333", "000000ABC", "1234567890", "000000042", None]


def test_post_code(values):
    assert values(lambda c: text.canonical_key(c, 5), ["6130.0", "75013", None]) == ["06130", "75013", None]


def test_blank(values):
    assert values(text.is_blank, [None, "", " \t\n", "x", " x "]) == [True, True, True, False, False]
    assert values(text.blank_to_null, [None, " \t", " x\t"]) == [None, None, "x"]


def test_domain(values):
    urls = ["https://www.a.fr/x", "http://a.fr:80?q", "a.fr", None, "//www.b.fr/y", "http://www.x y.fr/z"]
    assert values(text.domain, urls) == ["a.fr", "a.fr:80", "", "", "b.fr", "x y.fr"]


def test_keywords(values):
    found = values(lambda c: text.contains_any(c, vocab.DIGITAL_KEYWORDS), ["Ma Data", "jardin", None])
    assert found == [True, False, False]


def test_contains_ignore_case(values):
    countries = ["France", "FRANCE, Italy", "Spain", None]
    assert values(lambda c: text.contains_ignore_case(c, "france"), countries) == [True, True, False, False]


def test_sort_tokens_and_one_line(values):
    assert values(text.sort_tokens, ["b a c", ""]) == ["a b c", ""]
    assert values(text.list_to_line, ["a;\nb;\nc"]) == ["a / b / c"]


def test_full_name(spark):
    df = spark.createDataFrame(
        [("ACME", "D", "J"), (None, "Durand", None), (None, None, None), (None, "Durand", "Jo")],
        "n string, l string, f string",
    )
    assert [r[0] for r in df.select(text.full_name(df.n, df.l, df.f)).collect()] == ["ACME", "Durand", None, "Durand Jo"]


def test_code_text(values):
    raw = ["5458", "5458.0", "5458.9", "abc", None, "", "1e12", "NaN"]
    assert values(codes.code_text, raw) == ["5458", "5458", "5458", None, None, None, None, None]


@pytest.mark.parametrize(
    "code, tag", [("62.01Z", "dev_logiciel"), ("58.21Z", "edition_jeux"), ("01.11Z", None), (None, None)]
)
def test_lookup(values, code, tag):
    assert values(lambda c: codes.lookup(vocab.NAF_TAG, c), [code]) == [tag]


def test_status_and_flag(values):
    assert values(codes.active_status, ["A", " C ", "x", "", None]) == [True, False, None, None, None]
    assert values(codes.positive_flag, [" O", "N", None]) == [True, None, None]


def test_truthy(values):
    raw = ["1", "0", "0.0", "False", " false ", "True", "oui", None, ""]
    assert values(codes.truthy, raw) == [True, False, False, False, False, True, True, True, True]


def test_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (0.5,)], "x double")
    assert [r[0] for r in df.select(codes.round_half_even(df.x)).collect()] == [0.12, 0.38, 0.5]


def test_lenient_timestamp(values):
    assert [v is None for v in values(codes.lenient_timestamp, ["2024-06-01", "bad", None])] == [False, True, True]


def test_union_sets(spark):
    df = spark.createDataFrame([(["b", "a"], ["c", "a"])], "x array<string>, y array<string>")
    assert df.select(text.union_sets(df.x, df.y)).first()[0] == "a|b|c"


def test_vocabularies_are_complete():
    assert len(vocab.NAF_TAG) == len(vocab.NAF_TIER) == 10
    assert len(vocab.LEGAL_FORM_FAMILY) == len(vocab.LEGAL_FORM_TIER) == 20
    assert list(vocab.LEGAL_FORM_TIER.values()).count("group_cate_1") == 5
    assert len(vocab.EXPORT_COLUMNS) == 28 and len(vocab.SCORE_FIELDS) == 12 and len(vocab.ENRICH_FIELDS) == 14
    assert set(vocab.NAF_TAG.values()) <= set(vocab.DIGITAL_TAGS)
    assert set(vocab.LEGAL_FORM_FAMILY.values()) <= set(vocab.FAMILIES)


def test_greek_and_cyrillic_names(values):
    spelled = {
        "Ευρωπαϊκή Ένωση": "evropaiki enosi",
        "ΑΥΤΟΚΊΝΗΤΟ": "aftokinito",
        "Μπουζούκι, Λάμπα": "bouzouki lampa",
        "Άγγελος Ευάγγελος": "angelos evangelos",
        "Ηχώ & Ψυχή": "icho psychi",
        "Μαΐου ευχή ναυς πραΰς": "maiou efchi nafs prays",
        "σφίγξ έλεγχος": "sfinx elenchos",
        "Москва": "moskva",
        "Щёкино": "shchekino",
        "Объединение «Юлия»": "obedinenie iuliia",
        "Київ, Ґалаґан": "kiiv galagan",
        "Љубица Његош Ђорђе": "ljubitsa njegosh dorde",
        "Café Ωμέγα 3": "cafe omega 3",
        "漢字": "",
    }
    got = values(text.normalize_name, list(spelled))
    assert dict(zip(spelled, got, strict=True)) == spelled
    # letters with combining marks read like composed ones
    assert values(text.normalize_name, [unicodedata.normalize("NFD", k) for k in spelled]) == got

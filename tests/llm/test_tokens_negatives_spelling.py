"""Token counts against the library, hard negatives and spelling variants against brute force; odd rows, empty tables, clashing columns."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from goldrec.llm import hard_negatives, spelling, token_count

DOCS = "doc_id long, text string, lang string, source string, n long, word string, n_tokens long"


def docs_frame(spark, texts, ids=None):
    rows = [(i, t, "en", "s", 7, "w", 9) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


# token counts

PATH = public_tokenizers.path(token_count.WORDS)
TEXTS = [
    None, "", "   \n\t", "hello world", "hello world", "Hello, WORLD's don't we'll I'm they've 12 345", "émoji 🙂👍🏽 漢字 ßẞ ŒUVRE", "ΣΑΣ ΟΔΟΣ İstanbul",
    "été Å ﬁn", "a<|endoftext|>b <|startoftext|> x<|endoftext|>", "<|ENDOFTEXT|> <|endoftext", "x" * 300, "%" * 5000, "ab1c2d3 _-_ ''s 's'sam",
    "a\x00b\x1cc\x85d​e f", "\U0001f469‍\U0001f469‍\U0001f467", "supercalifragilisticexpialidocious antidisestablishmentarianism " * 30,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    rules = token_count.WordPieces(PATH)
    return token_count.Counter(rules, [p for p in map(rules.stands_alone, rules.vocabulary) if p is not None])


def test_token_counts_as_the_library(spark, library):
    rng = np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrstuvwxyzäöüßéñ '-.,019%&\n")
    texts = TEXTS + ["".join(rng.choice(letters, int(rng.integers(1, 400)))) for _ in range(120)]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_count.token_counts(docs_frame(spark, texts), limit=50).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == (len((t or "").encode()), n, n > 50), t


def test_long_text_and_long_pieces(library, counter):
    rng = np.random.default_rng(4)
    long_piece = "".join(rng.choice(list("aeioustrn"), 20_000))
    prose = " ".join("".join(rng.choice(list("abcdetrs"), int(rng.integers(1, 12)))) for _ in range(200_000))
    assert len(prose) > token_count.LAZY_LENGTH
    for text in (long_piece, prose):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_short_and_long_merges_agree(counter):
    rng = np.random.default_rng(5)
    rules = counter.rules
    for _ in range(300):
        piece = "".join(rng.choice(list("aabcdeeilnorst"), int(rng.integers(1, 60))))
        parts = [rules.shown[b] for b in piece.encode()]
        parts[-1] += rules.suffix
        assert rules._merge_short(list(parts)) == rules._merge_long(list(parts))


def test_whole_tokens_are_proved(spark, library, counter):
    whole = token_count.whole_pieces(spark, PATH)
    assert len(set(whole)) == len(whole) > 30_000
    assert all(len(e.ids) == 1 for e in library.encode_batch(whole, add_special_tokens=False))
    # entries that merging never forms, and parts of words, are not counted as whole
    spelled = {p for p in map(counter.rules.spelled, counter.rules.vocabulary) if p}
    refused = sorted(spelled - set(whole))
    assert refused and all(counter.rules.merged(p) != [p] for p in refused)
    assert all(counter.count(p) == len(library.encode(p, add_special_tokens=False).ids) for p in refused)


def test_remembered_pieces_are_bounded():
    rules = token_count.WordPieces(PATH)
    small = token_count.Counter(rules, ["the"], limit=5)
    words = [f"zq{c}x" for c in "abcdefghijklmnop"]
    expected = [len(rules.merged(w)) for w in words]
    assert [small.count(w) for w in words] == expected and len(small) <= 6 and small["the"] == 1


def test_token_counts_of_empty_and_odd_tables(spark):
    empty = token_count.token_counts(docs_frame(spark, []))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = token_count.token_counts(docs_frame(spark, ["one", "one", None], [None, 5, 5])).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 1), (5, 0), (5, 1)]


def test_other_tokenizer_files_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        token_count.WordPieces(public_tokenizers.path("byte_bpe_50k.json"))


# hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, query long, rank int, score double"


def brute_negatives(rows):
    whole = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(np.float32(x)) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        whole[(i, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v))] = None
    out = []
    for a in whole:
        if a[0] % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], b[2], strict=False)), b[0], b[1] == a[1]) for b in whole if b != a]
        for s, i, _ in sorted(x for x in scored if x[2])[:5]:
            fits = sorted(x for x in scored if not x[2] and 50 * -s <= 100 * -x[0] <= 95 * -s)
            out += [(a[0], i, r + 1, j, -s, -t) for r, (t, j, _) in enumerate(fits[:3])]
    return sorted(out)


def negatives(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, 0.5) for r in rows], VECTORS)
    found = hard_negatives.hard_negatives(df, **options).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in found)


def vectors(seed, n, width, spread=0.3, first=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (6, width))
    return [(first + i, [float(x) for x in centres[rng.integers(0, 6)] + rng.normal(0, spread, width)], int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("width,levels", [(8, 6), (70, 3), (64, 1)])
def test_hard_negatives_against_brute_force(spark, width, levels):
    rows = vectors(width, 420, width)
    assert negatives(spark, rows, levels=levels) == brute_negatives(rows)


def test_hard_negatives_of_odd_rows(spark):
    rows = vectors(1, 160, 12)
    hot = [0.5] * 12
    rows += [(1000 + i, hot, i % 2) for i in range(150)]  # a frequent vector, ties everywhere
    rows += [(2000, None, 1), (2050, hot, None), (2100, [0.1, None] * 6, 1), (2150, [float("nan")] * 12, 1), (2200, [float("inf")] * 12, 2)]
    rows += [(None, hot, 1), (2250, [], 1), (2300, [0.25] * 5, 1), (2350, [0.0] * 12, 1), (1000, hot, 0), (50, [0.4] * 12, 1), (50, hot, 3), (7, hot, -3)]
    rows += [(2400, [1e30] * 12, 1)]
    expected = brute_negatives([r for r in rows if r[0] != 2400])  # too long for 64-bit scores
    assert negatives(spark, rows) == expected
    con = duckdb.connect()
    kept = [r for r in rows if r[0] != 2400]
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [list(r) for r in kept])
    sql = "SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (" + hard_negatives.SQL + ")"
    assert sorted(con.execute(sql).fetchall()) == expected


def test_hard_negatives_in_blocks(spark, monkeypatch):
    rows = vectors(9, 900, 16)
    expected = brute_negatives(rows)
    for name, value in (("FILE_ROWS", 128), ("BLOCK_WORDS", 256), ("QUERY_BYTES", 3000)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert negatives(spark, rows) == expected


def test_hard_negatives_of_empty_tables(spark):
    assert negatives(spark, []) == []
    assert negatives(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []
    assert negatives(spark, [(50, [0.5], 1)]) == []


def test_intervals_hold_every_score():
    rng = np.random.default_rng(11)
    turned = hard_negatives.Rotations(100)
    x = np.floor(256 * rng.normal(0, 1, (500, 128))).astype(np.int64)
    x[:, 100:] = 0
    codes, align, rest = turned.encode(x)
    rows = hard_negatives.Rows(turned, np.arange(500), np.zeros(500, np.int64), x.astype(np.int32), codes, align, rest)
    queries = hard_negatives.Queries(turned, np.arange(20), np.zeros(20, np.int64), x[:20], None)

    class Seen:
        def __init__(self, scores):
            self.scores, self.widths = scores, []

        def holds(self, low, high):
            assert (low <= self.scores).all() and (self.scores <= high).all()
            self.widths.append(float((high - low).mean()))
            return np.ones(len(low), bool)

        def learn(self, rows, middle):
            pass

    for i in range(20):
        seen = Seen(x @ x[i])
        rows.survivors(queries, i, np.arange(500), seen)
        assert all(b < 0.75 * a for a, b in zip(seen.widths, seen.widths[1:], strict=False))


# spelling variants


def brute_words(texts, ids):
    import re

    counts = {}
    for i, t in zip(ids, texts, strict=True):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_variants(words):
    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, count = {}, {}
    for w, n in words.items():
        found = sorted((-m, o) for o, m in words.items() if near(w, o))
        count[w] = len(found)
        form[w] = found[0][1] if found and -found[0][0] >= 2 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, count[w], words[form[w]] if form[w] else None)
    return out


def variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(df).collect()}


def spelled_texts(seed):
    rng = np.random.default_rng(seed)
    stems = ["".join(rng.choice(list("abé"), 6)) for _ in range(25)] + ["aaaaaa", "aaaaa", "aabbaa", "Ästhetik", "STRASSE", "straße", "abcab$x"]
    texts = []
    for _ in range(60):
        words = []
        for s in rng.choice(stems, 40):
            w, at = str(s), int(rng.integers(0, 6))
            kind = rng.integers(0, 8)
            w = w[:at] + w[at + 1 :] if kind == 0 else w[:at] + str(rng.choice(list("abcé"))) + w[at + (kind == 1) :] if kind <= 2 else w
            words.append(w.upper() if rng.integers(0, 5) == 0 else w)
        texts.append(" ".join(words))
    return texts


def test_spelling_variants_against_brute_force(spark):
    texts = [*spelled_texts(1), None, "", "1234 -- ", "Æther æther ÆTHER " * 4]
    ids = [*range(len(texts) - 2), None, 3]
    expected = brute_variants(brute_words(texts, ids))
    assert any(v[0] for v in expected.values()) and any(v[0] and v[0] != v[1] for v in expected.values())
    assert variants(docs_frame(spark, texts, ids)) == expected


def test_spelling_variants_of_repeats_and_long_texts(spark):
    texts = spelled_texts(2)[:20] * 2 + [" ".join(spelled_texts(3)) * 20]
    ids = [*range(20), *range(20), 77]
    assert variants(docs_frame(spark, texts, ids)) == brute_variants(brute_words(texts, ids))
    assert variants(docs_frame(spark, [])) == {} and variants(docs_frame(spark, [None, "a b c"])) == {}


def test_chains_of_forms(spark):
    words = [(("abcdefgh"[:k] + "x" * (8 - k)), 3 * 2 ** k) for k in range(9)]
    frame = spark.createDataFrame(words, "word string, n long")
    near = {r.word: (r.n_near, tuple(r.best)) for r in spelling.near_words(frame).collect()}
    assert near == {w: ((k > 0) + (k < 8), words[min(k + 1, 8) if k < 8 else 7][::-1]) for k, (w, _) in enumerate(words)}
    forms = spark.createDataFrame([(a[0], b[0]) for a, b in zip(words, words[1:], strict=False)], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(forms).collect()} == {w: words[-1][0] for w, _ in words[:-1]}
    assert spelling.roots(forms.limit(0)).collect() == []

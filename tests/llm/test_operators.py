"""Each operator against a plain implementation, and on nulls, empty texts, repeats, empty tables and extra columns."""

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from goldrec.llm import bpe, decontaminate, fingerprint, jaccard_join, langid, quality, secret_scan, sharding, url_filter, warc

DOCS = "doc_id long, text string, lang string, source string, score double, n long"


def frame(spark, texts, ids=None):
    rows = [(i, t, "en", "s", 0.5, 1) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n=120, vocabulary=400):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, vocabulary, n))


@pytest.fixture(scope="module")
def odd():
    """Texts with every awkward case."""
    base = prose(1)
    return [
        base, base, base.upper(), base + " tail", base.replace("w1 ", "x1 ", 1), None, "", "   ", "one", "one", "one two three",
        "one two three four five", "émoji 🙂 漢字 ß", prose(2, 6000), prose(3), "token = abcdefghijklmnop", "a\x00b", base[:300],
    ]


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(texts):
    sets = [shingle_set(t) for t in texts]
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return {i: (len(s), label[i]) for i, s in enumerate(sets)}


def components(df, **options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, **options).collect()}


@pytest.mark.parametrize("limit", [400, 4_000_000])
def test_jaccard_join(spark, odd, limit):
    rng = np.random.default_rng(5)
    texts = list(odd)
    for k in range(6):  # chains of edits
        words = prose(50 + k, 80).split()
        for _ in range(8):
            words[int(rng.integers(0, 80))] = f"z{rng.integers(0, 10**6)}"
            texts.append(" ".join(words))
    assert components(frame(spark, texts), max_elements=limit) == brute_components(texts)


@pytest.mark.parametrize("limit", [400, 4_000_000])
def test_jaccard_links_are_counted(spark, odd, limit):
    rng = np.random.default_rng(6)
    texts = list(odd)
    for k in range(5):
        base = prose(80 + k, 90).split()
        for _ in range(24):  # a group of near copies, most pairs linked
            own = list(base)
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(0, 90))] = f"z{rng.integers(0, 10**6)}"
            texts.append(" ".join(own))
    texts += texts[-3:]
    sets = [shingle_set(t) for t in texts]
    links = [sum(i != j and 100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets) if a and b) for i, a in enumerate(sets)]
    wanted = {i: (*x, links[i]) for i, x in brute_components(texts).items()}
    got = jaccard_join.jaccard_links(frame(spark, texts), max_elements=limit).collect()
    assert len(got) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in got} == wanted


def test_jaccard_join_without_ids_or_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (3, None)], "doc_id long, text string")
    got = sorted(jaccard_join.jaccard_components(df).collect(), key=str)
    assert collections.Counter((r.doc_id, r.component_id) for r in got) == {(None, None): 1, (7, 7): 2, (3, 3): 1}
    assert jaccard_join.jaccard_components(df.limit(0)).count() == 0


def test_warc(spark):
    rows = [(1, "http://a/", "x"), (2, None, "x"), (3, "http://b/\n", None), (4, "u", ""), (5, "u", "ü" * 5000), (5, "u", "ü" * 5000), (None, "u", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", __import__("pyspark").sql.functions.lit(1))
    got = sorted((tuple(r) for r in warc.archive_round_trip(df.select("page_id", "url", "html", "digest")).collect()), key=str)
    largest = {}
    for i, _, h in rows:
        if i is not None:
            largest[h or ""] = max(largest.get(h or "", 0), i)
    wanted = []
    for i, _, h in rows:
        raw = (h or "").encode()
        to = largest[h or ""] if i is not None and i < largest[h or ""] else None
        wanted.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if to is None else "revisit", to))
    assert got == sorted(wanted, key=str)
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_warc_with_an_id_of_two_payloads(spark):
    rows = [(1, "u", "one"), (1, "u", "two"), (2, "u", "two"), (3, "u", "four"), (2, "u", "one and more"), (3, "u", "one")]
    got = warc.archive_round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    digest = {h: base64.b32encode(hashlib.sha1(h.encode()).digest()).decode() for _, _, h in rows}
    to = {(1, "one"): 3, (1, "two"): 2}
    wanted = [(i, len(h), digest[h], "revisit" if (i, h) in to else "response", to.get((i, h))) for i, _, h in rows]
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)


def test_byte_ranges_are_coalesced():
    assert warc.coalesce_ranges([(0, 5), (5, 5), (20, 5), (200, 5)], gap=10, most=30) == [(0, 25, 0, 3), (200, 205, 3, 4)]
    fields, payload = warc.parse_record(warc.write_record(9, "http://a/\r\nX: y", b"body\r\n\r\nmore", "D", None, False))
    assert payload == b"body\r\n\r\nmore" and fields["x-record-key"] == "9" and fields["warc-target-uri"] == "http://a/%0D%0AX: y"


def test_language(spark):
    rng = np.random.default_rng(0)

    def text(letters):
        return " ".join("".join(rng.choice(list(letters), 5)) for _ in range(40))

    rows = [(i, text("abcde") if i % 2 else text("vwxyz"), "l1" if i % 2 else "l2") for i in range(120)]
    rows += [(1000, None, "l1"), (1001, "", "l1"), (1002, "123 !?", "l2"), (1003, "abc", None), (1004, "漢字" * 30, "l1"), (None, "abcd", "l1"), (5, "abcde", "l1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.held_out_languages(df).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert {by[i].lang_pred for i in (1000, 1001, 1002)} == {"und"}
    assert all(by[i].lang_pred == ("l1" if i % 2 else "l2") for i in range(120))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert by[1004].rejected and not by[3].rejected
    assert langid.held_out_languages(df.limit(0)).count() == 0


def test_interpolated_probabilities_sum_to_one():
    """Kneser-Ney by hand on one text: the chances of all symbols after a context."""
    row, gram, letters = langid.symbols_of(np.frombuffer(b"abab ab", np.uint8), np.array([0, 7]))
    assert letters.all() and len(gram) == 8 and (gram & 4095).tolist() == [1, 2, 1, 2, 0, 1, 2, 0]


def brute_kneser_ney(rows):
    """ln p(symbol | up to three before it) per language, by the textbook: counts, then distinct continuations."""
    tables = {}
    for lang in sorted({x for _, x in rows}):
        top = collections.Counter()
        for text, own in rows:
            if own == lang:
                for word in text.split():
                    padded = "___" + word + "_"
                    top.update(padded[i : i + 4] for i in range(len(padded) - 3))
        orders = {4: top}
        for k in (3, 2, 1):
            orders[k] = collections.Counter(g[1:] for g in orders[k + 1])
        for counts in orders.values():
            counts.contexts = collections.defaultdict(list)
            for g, c in counts.items():
                counts.contexts[g[:-1]].append(c)
        tables[lang] = orders

    def p(lang, gram):
        below = p(lang, gram[1:]) if len(gram) > 1 else 1 / langid.SYMBOLS
        counts = tables[lang][len(gram)]
        seen = counts.contexts.get(gram[:-1])
        if not seen:
            return below
        return max(counts[gram] - 0.75, 0) / sum(seen) + 0.75 * len(seen) / sum(seen) * below

    return tables, p


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_cross_entropies_are_those_of_kneser_ney(spark, limit):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(1, 8))) for _ in range(900)]
    training = [(" ".join(rng.choice(words[:600] if i % 2 else words[300:], 60)), f"l{i % 2}") for i in range(60)]
    texts = [" ".join(rng.choice(words, 30)) for _ in range(10)] + ["qzxj jjqq", "a", "", None, "qzxj jjqq"]
    model = langid.train(spark.createDataFrame(training, "text string, lang string"))
    options = {} if "limit" not in langid.cross_entropies.__code__.co_varnames else {"limit": limit}
    ids = [*range(len(texts) - 1), 10]
    got = langid.cross_entropies(frame(spark, texts, ids), model, "doc_id", **options).collect()
    tables, p = brute_kneser_ney(training)
    assert len(got) == len(texts) and len({r.doc_id for r in got}) == len(texts) - 1
    for r in got:
        wanted = []
        grams = [g for w in (texts[r.doc_id] or "").split() for g in (("___" + w + "_")[i : i + 4] for i in range(len(w) + 1))]
        for lang in ("l0", "l1"):
            wanted.append(-sum(np.log(p(lang, g)) for g in grams) / max(1, len(grams)))
        assert r.n == len(grams) and r.entropy == pytest.approx(wanted, abs=1e-4), texts[r.doc_id]


def test_urls(spark):
    urls = [
        "http://a.org/x", "HTTP://A.ORG/x", "http://org/", "http://a.org", "http://aorg/x", "http://example.org/es/1", "http://x.example.org/en/12",
        "http://badexample.org/es/1", "https://b.com/fr/1?x", "https://b.com/fr", "https://b.com/de/", "https://evil.net/x.org/fr/", None, "", "a.org/x",
        "http://", "http:///fr/", "http://a.com:80/de/", "http://" + "a." * 3000 + "com/de/" + "y" * 5000, "http://a.com/DE/", "x://y://b.com/de/",
    ]
    rows = [(i, u, "z") for i, u in enumerate(urls)]
    got = {r.page_id: r for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, rule string").select("page_id", "url")).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        fits = [r for r in url_filter.RULES if ("." + host).endswith("." + r[1]) and path.startswith(r[2])]
        best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, best and best[1] + best[2], best[0] if best else "allow"), u


def test_shards(spark, odd):
    texts = [*odd, *(prose(k, 30) for k in range(200)), *["hot copy " * 30] * 150]
    got = sharding.shard_by_bytes(frame(spark, texts), ranges=16).collect()
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(got) == len(texts) and set(slots) <= set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, biggest = sum(sizes.values()), max(r.size for r in got)
    assert all(abs(b - total / 40) <= biggest for b in sizes.values())
    assert sharding.shard_by_bytes(frame(spark, texts).limit(0)).count() == 0


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(text, items):
    w = WORD.findall((text or "").encode().lower())
    hit, found = set(), set()
    for item, t in items:
        own = WORD.findall((t or "").encode().lower())
        for k in range(max(1, len(own) - 9) if own else 0):
            window = own[k : k + 10]
            for at in range(len(w) - len(window) + 1):
                if w[at : at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    found.add(item)
    return len(w), len(hit), sorted(map(str, found))


@pytest.mark.parametrize("block", [40, 2_000_000])
def test_decontamination(spark, odd, block):
    items = [(10, odd[0][20:200]), (2, "ONE two, three"), (3, None), (4, ""), (5, "…!"), (30, odd[0][20:200])]
    texts = [*odd, "One--TWO three one two three", f"a {odd[0][20:200]} b {odd[0][20:200]}"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(frame(spark, texts), bench, block).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, sum(s.end - s.start for s in r.spans), r["items"]) == brute_hits(texts[r.doc_id], [i for i in items if i[1]]), texts[r.doc_id]
    clean = {r.doc_id: r.text for r in decontaminate.remove_contamination(frame(spark, texts), bench, block_words=block).collect()}
    assert all(brute_hits(t, [i for i in items if i[1]])[1] == 0 for t in clean.values())
    assert all(clean[i] == t for i, t in enumerate(texts) if brute_hits(t, [i for i in items if i[1]])[1] == 0)
    report = {r.doc_id: r for r in decontaminate.contamination_report(frame(spark, texts), bench).collect()}
    assert report[6].items_sha256 == hashlib.sha256(b"").hexdigest() and not report[6].contaminated
    assert report[8].n_hit == 0 and report[10].items_sha256 == hashlib.sha256(b"2").hexdigest()
    assert decontaminate.contamination_report(frame(spark, texts), bench.limit(0)).where("contaminated").count() == 0


def test_blocks_of_the_benchmark_do_not_change_results(spark):
    rows, items = [], []
    for k in range(6):
        w = [f"q{k}x{i}" for i in range(40)]
        items += [(10 * k, " ".join(w[:14])), (10 * k + 1, " ".join(w[8:20])), (10 * k + 2, " ".join(w[24:29] + w[34:39]))]
        # the last item appears only once the passage between its halves is cut
        rows.append((k, " ".join(["a", *w[:30], "b", *w])))
        rows.append((k, " ".join([*w[24:29], *w[:20], *w[34:39]])))
    rows += [(None, rows[0][1]), (None, rows[1][1]), (None, "other"), (None, None), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    results = []
    for block in (2_000_000, 20):
        found = decontaminate.contamination(docs, bench, block).collect()
        clean = decontaminate.remove_contamination(docs, bench, block_words=block).collect()
        results.append((sorted(map(str, found)), sorted(map(str, clean))))
    assert len(results[0][0]) == len(rows) and results[0] == results[1]


def test_index_on_few_symbols():
    rng = np.random.default_rng(2)
    for _ in range(40):
        text = rng.integers(0, 4, 60)
        index = decontaminate.FMIndex(text.copy(), 3)
        for n in (1, 2, 5):
            phrase = rng.integers(1, 4, n)
            low, high = index.search(phrase[None], np.array([n]))
            wanted = [i for i in range(60 - n + 1) if (text[i : i + n] == phrase).all()]
            assert sorted(index.locate(np.arange(low[0], max(low[0], high[0]))).tolist()) == wanted


def test_quality(spark):
    good = [(i, prose(i, 60 + i % 40)) for i in range(300)]
    bad = [(300 + i, " ".join(f"{w}###" for w in prose(1000 + i, 60).split())) for i in range(100)]
    rows = [*good, *bad, (500, None), (501, ""), (None, "x y")]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(400)] + [(501, None, 1), (None, 1, 0), (9999, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.held_out_quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert np.mean([r.predicted == (r.doc_id < 300) for r in held]) >= 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    again = quality.held_out_quality(docs.repartition(5), labels.repartition(3)).collect()
    assert {(r.doc_id, r.score) for r in again} == {(r.doc_id, r.score) for r in got}
    assert quality.held_out_quality(docs, labels.limit(0)).count() == len(rows)
    model = quality.train(docs, labels)
    assert quality.keep_good(docs, model).columns == docs.columns


def test_secrets(spark, odd):
    assign = re.compile(r'''((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''')
    rng = np.random.default_rng(3)
    bits = ["password", "PassWD", "secret", "Token", "api_key", "apikey", "=", " ", ":", '"', "'", "abc123", "AKIA", "ABCDEFGHIJ", "0123456789abcdef", "é🙂", "x" * 15, "-", "token = ", "\n", "deadbeef"]
    texts = [*odd, *("".join(rng.choice(bits, rng.integers(0, 50))) for _ in range(300)), "a" * 5000 + "password" + " " * 3000 + "=" + "b" * 4000 + "!", "ghp_" + "a1" * 18]
    got = {r.doc_id: r for r in secret_scan.scan_secrets(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans))
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), t
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == x for _, k, _ in spans) for x in range(3))
    assert "hosting:" in got[len(texts) - 1].spans
    redacted = secret_scan.redact_secrets(frame(spark, texts))
    assert redacted.columns == frame(spark, texts).columns
    assert secret_scan.scan_secrets(redacted).where("n_assign + n_access + n_hex > 0 AND spans LIKE '%access%'").count() == 0
    assert secret_scan.redact("ab token=abcdefabcdefabcdef0123 c", [(3, 0, 31), (9, 2, 31)]) == "ab [REDACTED] c"


def test_fingerprints(spark, odd):
    texts = [*odd, *(prose(k, 50) for k in range(60))]
    got = {r.doc_id: r for r in fingerprint.edited_fingerprints(frame(spark, texts), buckets=7).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        t, after = t or "", texts[i - 1] or ""
        cut = len(t) // 3
        edited = t[: len(t) - cut] + after[:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest()), i
        for near, other in ((r.near_edited, edited), (r.near_next, after)):
            a, b = shingle_set(t), shingle_set(other)
            exact = len(a & b) / len(a | b) if a | b else 1.0
            assert near == pytest.approx(exact, abs=1e-12 if len(a | b) < fingerprint.K else 0.15)
    assert got[0].fingerprint == got[1].fingerprint == got[2].fingerprint
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "x"), (None, None)], "doc_id long, text string")
    assert fingerprint.edited_fingerprints(twice).count() == 4
    assert fingerprint.edited_fingerprints(twice.limit(0)).count() == 0


def test_sketches_merge():
    a, b = prose(1, 900, 10**6), prose(2, 900, 10**6)
    one, two, both = fingerprint.sketch_texts(pa.array([a, b, a + " " + b]))
    assert abs(fingerprint.distinct_count(both) / 1796 - 1) < 0.25
    assert fingerprint.resemblance(fingerprint.merge(one, two), both) > 0.9
    assert fingerprint.containment(one, both) > 0.8
    assert (fingerprint.decode(fingerprint.encode(one)) == one).all()


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path(bpe.RANKS))


def test_bpe(spark, odd, ranks):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(1)
    letters = list("abcdefgthe  ing ..\n\t éüß漢字🙂\x1c\x1d ​123'sl!?#%")
    texts = [*odd, *("".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(800)), "a" * 3000, "-" * 500 + " " * 700, "ab" * 2000, "<|endoftext|>"]
    encoder = bpe.Encoder(ranks, 300)  # tables overflow often
    assert all(encoder.encode(t or "").tolist() == own.encode_ordinary(t or "") for t in texts)
    got = {r.doc_id: r for r in bpe.token_digests(frame(spark, texts), portion=7).collect()}
    for i, t in enumerate(texts):
        ids = own.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = bpe.decode_documents(bpe.encode_documents(frame(spark, texts)))
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_utf8_machine_takes_any_portions():
    raw = "aé漢🙂".encode()
    for cut in range(len(raw)):
        machine = bpe.Utf8Machine()
        assert machine.feed(raw[:cut]) + machine.feed(raw[cut:]) + machine.close() == "aé漢🙂"
    machine = bpe.Utf8Machine()
    assert machine.feed(b"a\xe6\xbc") == "a" and machine.close() == "\ufffd"

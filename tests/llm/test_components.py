"""Connected components in blocks of any size, and cells dealt by their work."""

import os
from collections import Counter

import numpy as np
import pytest

from goldrec.llm import common, decontaminate, jaccard_join, quality, warc, words
from goldrec.session import scratch_path, stage


def brute(pairs):
    label = {}
    for a, b in pairs:
        if a != b:
            x, y = label.setdefault(a, a), label.setdefault(b, b)
            for k in label:
                if label[k] in (x, y):
                    label[k] = min(x, y)
    return label


def graph(seed):
    rng = np.random.default_rng(seed)
    pairs = [(int(a), int(b)) for a, b in rng.integers(-400, 400, (260, 2))]
    pairs += [(1000 + i, 1001 + i) for i in rng.permutation(200).tolist()]  # a long path
    pairs += [(5000, 5001 + i) for i in range(150)] + [(7, 7), (9, 9), (1000, 1001)]  # a hub, loops, a repeat
    return pairs


def test_forest_connects_what_the_edges_connect():
    for seed in range(4):
        pairs = [(a, b) for a, b in graph(seed) if a != b]
        node, label = common.forest(*(np.array(c, np.int64) for c in zip(*pairs, strict=True)))
        expected = brute(pairs)
        assert dict(zip(node.tolist(), label.tolist(), strict=True)) == {k: v for k, v in expected.items() if k != v}


@pytest.mark.parametrize("size", [1 << 18, 40])
def test_components(spark, monkeypatch, size):
    monkeypatch.setattr(common, "CONTRACTED_EDGES", size)
    pairs = graph(7)
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    got = common.connected_components(edges).collect()
    assert len(got) == len({r.node for r in got}) and {r.node: r.label for r in got} == brute(pairs)
    assert common.connected_components(edges.limit(0)).collect() == []


def test_cells_take_one_worker_a_task(spark, monkeypatch):
    """Two Python steps in a task leave an executor with twice the workers, which later operators fill with their tables."""
    plans = []

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, name)

    monkeypatch.setattr(common, "stage", noted)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3000, 40)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0] + " end", texts[1] + " end"])], "doc_id long, text string")
    levels = spark.sparkContext.broadcast(jaccard_join.shingle_levels(docs))
    cells = jaccard_join.candidate_cells(docs, levels).collect()
    assert len({r.node for r in cells}) == len(cells) >= 4 and plans
    for plan in plans:
        assert all(steps.count("MapInArrow") <= 1 for steps in plan.split("Exchange"))


def test_cells_are_dealt_by_their_work(spark):
    rng = np.random.default_rng(1)
    base = [f"w{x}" for x in rng.integers(0, 5000, 60)]
    texts = [" ".join(base)] * 3
    for _ in range(70):
        own = list(base)
        own[int(rng.integers(0, 60))] = f"z{rng.integers(0, 10**6)}"
        texts.append(" ".join(own))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    links = [sum(100 * len(a & b) >= 80 * len(a | b) for b in sets) - 1 for a in sets]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for work in (jaccard_join.MAX_WORK, 20_000):
        got = {r.doc_id: (r.component_id, r.n_links) for r in jaccard_join.jaccard_links(docs, max_work=work).collect()}
        assert got == {i: (0, n) for i, n in enumerate(links)}
    # dealt, no cell is left that one task would work on for long
    levels = spark.sparkContext.broadcast(jaccard_join.shingle_levels(docs))
    cells = jaccard_join.candidate_cells(docs, levels).selectExpr("node", "label", "1L AS copies")
    dealt, found = jaccard_join._split(jaccard_join.cell_sets(docs, cells), 4_000_000, 20_000)
    weights = dealt.groupBy("cell").agg({"n": "sum", "node": "count"}).collect()
    assert found is None and len(weights) > 30 and max(r["sum(n)"] * r["count(node)"] for r in weights) <= 2 * 20_000


def test_labels_of_repeated_ids_stay_bounded(spark):
    rows = [(1, f"text number {i} of one id") for i in range(500)] + [(2, "two"), (3, "three"), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 1)], "doc_id long, quality int")
    fitted = []
    original = quality.fit
    quality.fit = lambda x, y, *a, **b: fitted.append(len(y)) or original(x, y, *a, **b)
    try:
        quality.train(docs, labels, rows=2)
    finally:
        quality.fit = original
    assert fitted == [2]


def test_archives_are_read_by_as_many_tasks_as_their_bytes_need(spark, monkeypatch):
    monkeypatch.setattr(warc, "TASK", 4000)
    monkeypatch.setattr(warc, "READ", 1000)
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"page {i} " * 30) for i in range(200)], "page_id long, url string, html string")
    folder = scratch_path(spark, "archives")
    index = warc.write_archives(pages, folder)
    back = warc.read_records(index, folder)
    assert back.rdd.getNumPartitions() == -(-index.agg({"length": "sum"}).first()[0] // 4000) > 10
    assert {r.page_id: bytes(r.payload).decode() for r in back.collect()} == {i: f"page {i} " * 30 for i in range(200)}


def test_blocks_keep_columns_of_any_name(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"a {passage} b", "S", True, 4), (2, "clean", "T", None, 5)], "doc_id long, text string, spans string, live boolean, _spans int")
    benchmark = spark.createDataFrame([(i, " ".join(f"{i}x{k}" for k in range(40))) for i in range(5)] + [(9, passage)], "item_id long, text string")
    kept = [sorted(tuple(r) for r in decontaminate.remove_contamination(docs, benchmark, block_words=n).collect()) for n in (10_000_000, 20)]
    assert kept[0] == kept[1] and kept[0][0][2:] == ("S", True, 4) and "p7" not in kept[0][0][1]


def shingled(texts):
    return [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]


def test_texts_that_share_a_shingle_by_chance_are_in_no_cell(spark):
    """A chain of texts, each with one rare shingle of the next; in a large corpus such chains reach all texts."""
    rng = np.random.default_rng(5)
    phrases = [" ".join(f"p{k}x{i}" for i in range(5)) for k in range(41)]
    texts = [f"{phrases[k]} " + " ".join(f"w{x}" for x in rng.integers(0, 10**6, 30)) + f" {phrases[k + 1]}" for k in range(40)]
    texts += [texts[3] + " end", texts[8].replace(phrases[8], "x " + phrases[8])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = np.full(1 << jaccard_join.SLOT_BITS, 100, np.uint8)  # the shared shingles come first in the order
    data = "\n".join(phrases).encode()
    off = np.append(0, np.cumsum([len(p) + 1 for p in phrases]) - 1)
    off[1:-1] += 1
    _, hashes = words.shingle_sets(np.frombuffer(data, np.uint8), off)
    table[(hashes & np.uint64((1 << jaccard_join.SLOT_BITS) - 1)).astype(np.int64)] = 0
    cells = jaccard_join.candidate_cells(docs, spark.sparkContext.broadcast(table)).collect()
    assert len(hashes) == 41 and len(cells) == 4 and sorted(Counter(r.label for r in cells).values()) == [2, 2]


@pytest.mark.parametrize("edits", [1, 3])
def test_windows_of_pairs_lose_no_link(spark, edits):
    rng = np.random.default_rng(edits)
    texts = []
    for size in range(4, 60):
        base = [f"w{x}" for x in rng.integers(0, 10**6, size + 4)]
        longer, shorter = [*base, *(f"z{x}" for x in rng.integers(0, 10**6, edits * size // 12))], base[: len(base) - edits * size // 15]
        texts += [" ".join(x) for x in (base, longer, shorter)]
    sets = shingled(texts)
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[i] != sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    node = {r.doc_id: r.node for r in docs.mapInArrow(jaccard_join._sizes, "doc_id long, n long, node long").collect()}
    for level in (np.zeros(1 << jaccard_join.SLOT_BITS, np.uint8), jaccard_join.shingle_levels(docs)):
        label = {r.node: r.label for r in jaccard_join.candidate_cells(docs, spark.sparkContext.broadcast(level)).collect()}
        assert len(linked) > 30 and all(label[node[i]] == label[node[j]] for i, j in linked)


def near_copies(n, edits, size=60):
    rng = np.random.default_rng(2)
    base = [f"w{x}" for x in rng.integers(0, 5000, size)]
    texts = []
    for _ in range(n):
        own = list(base)
        for at in rng.integers(0, size, edits):
            own[at] = f"z{rng.integers(0, 10**6)}"
        texts.append(" ".join(own))
    return texts


def test_a_cell_that_does_not_shrink_is_written_once_a_block(spark):
    texts = near_copies(60, 1)
    sets = shingled(texts)
    links = [sum(100 * len(a & b) >= 80 * len(a | b) for b in sets) - 1 for a in sets]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    total = sum(map(len, sets))
    got = {r.doc_id: r.n_links for r in jaccard_join.jaccard_links(docs, max_elements=total // 2).collect()}
    assert got == dict(enumerate(links))
    cells = jaccard_join.candidate_cells(docs, spark.sparkContext.broadcast(jaccard_join.shingle_levels(docs))).selectExpr("node", "label", "1L AS copies")
    rows = jaccard_join.cell_sets(docs, cells).dropDuplicates(["node"])
    dealt, found = jaccard_join._split(rows, total // 2, jaccard_join.MAX_WORK)
    blocks = 2 * 2 + 2
    assert found is None and dealt.agg({"n": "sum"}).first()[0] <= blocks * total


def test_regions_that_hold_as_many_pairs_are_not_split_again(monkeypatch):
    sets = [np.sort(np.array([hash(x) & 0xFFFFFFFF for x in s], np.uint64)) for s in shingled(near_copies(300, 6, 150))]
    work = []
    shared = jaccard_join.Region.shared
    monkeypatch.setattr(jaccard_join.Region, "shared", lambda self, p, members: work.append(len(members)) or shared(self, p, members))
    found = []
    for name in ("pairs", "join"):
        region = jaccard_join.Region(sets, np.ones(len(sets), np.int64))
        region.join(np.arange(len(sets))) if name == "join" else region.pairs(np.arange(len(sets)), region.masks)
        found.append((region.links.tolist(), sum(work)))
        work.clear()
    assert found[0][0] == found[1][0] and found[1][1] < 1.5 * found[0][1]


def test_what_a_staged_table_shuffled_goes_with_its_query(spark):
    def files():
        places = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for top in places for _, _, names in os.walk(top) for f in names if f.startswith("shuffle")}

    before = files()
    staged = stage(spark.range(1000).selectExpr("id", "id % 7 AS k").repartition("k"), "shuffled")
    assert not files() - before and staged.count() == 1000

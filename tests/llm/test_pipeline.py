"""The stages on a small corpus with planted cases."""

import corpus_pipeline
import numpy as np
import pytest


def prose(seed, n=120):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 3000, n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("corpus")
    passage = prose(9999, 40)
    texts = [prose(i) for i in range(60)]
    texts += [texts[0], texts[1] + " end", f"{prose(70)} {passage} {prose(71)}", prose(72) + " token = 0123456789abcdef0123", None, ""]
    texts += [" ".join(f"{w}%%%" for w in prose(200 + i).split()) for i in range(40)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[5]], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(at / "documents.parquet"))
    labels = [(i, int(i < 66), 0) for i in range(len(texts))]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(at / "labels.parquet"))
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(str(at / "benchmark.parquet"))
    return str(at), texts, passage


def test_stages(spark, folder):
    at, texts, passage = folder
    docs = spark.read.parquet(f"{at}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, at)
        assert docs.columns == columns
        kept[name] = docs.collect()
    ids = {name: sorted(r.doc_id for r in rows) for name, rows in kept.items()}
    assert set(range(60)) <= set(ids["quality"]) and not set(ids["quality"]) & set(range(66, 106))
    near = ids["near_duplicates"]
    assert 60 not in near and 61 not in near and near.count(5) == 1 and {0, 1, 62, 63} <= set(near)
    text = {r.doc_id: r.text for r in kept["secrets"]}
    assert passage not in text[62] and text[62].split()[:120] == texts[62].split()[:120]
    assert "0123456789abcdef" not in text[63] and "[REDACTED]" in text[63]
    assert all(text[i] == texts[i] for i in range(60))


def test_run_returns_one_row_per_kept_document(spark, folder):
    rows = corpus_pipeline.run(spark, folder[0]).collect()
    assert len({r.doc_id for r in rows}) == len(rows) and all(len(r.ids_sha256) == 64 for r in rows)


def test_texts_that_share_an_id_are_told_apart(spark):
    a, b, c = prose(1), prose(2), prose(3)
    rows = [(1, a), (2, a + " end"), (2, b), (3, c), (3, c), (3, prose(4)), (4, b + " end"), (None, a), (5, c.upper()), (6, None), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    wanted = [(1, a), (2, b), (3, c), (3, prose(4)), (None, a), (6, None)]
    assert sorted(map(tuple, kept), key=str) == sorted(wanted, key=str)


def test_columns_of_any_name_and_empty_tables(spark, folder):
    a = prose(1)
    rows = [(1, a, "K", True, 5, "L"), (2, a + " end", "x", None, 6, None), (3, prose(2), "y", False, 7, "z"), (3, prose(2), "y", False, 7, "z")]
    names = "_key string, _repeated boolean, id long, label string"
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {names}")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
    more = spark.createDataFrame([(1, a, "en", "s", 1, "S", True, 2)], "doc_id long, text string, lang string, source string, n_chars long, _spans string, _live boolean, row long")
    for docs in (more, more.limit(0)):
        for name, function in corpus_pipeline.STAGES[:-1]:
            out = function(spark, docs, folder[0])
            assert out.columns == docs.columns
            if docs is more and name != "quality":
                assert [tuple(r) for r in out.collect()] == [tuple(r) for r in more.collect()]
            elif docs is not more:
                assert out.collect() == []
        digests = corpus_pipeline.STAGES[-1][1](spark, docs, folder[0]).collect()
        assert len(digests) == (docs is more)

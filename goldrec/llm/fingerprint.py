"""Bottom-k sketches of 5-word shingles.

A sketch keeps the K smallest of the document's mixed shingle hashes (40 bits each) in order. Sketches of parts merge
into the sketch of the whole. The K smallest hashes of a union are a uniform sample of it, which estimates resemblance
and containment; the K-th smallest hash tells how many distinct shingles there are. Sets of fewer than K are exact.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm import words
from goldrec.llm.common import slices

K = 256
BITS = 40
U = np.uint64
#: Least number of doc_id buckets that are sorted on their own (more on a session with many shuffle partitions);
#: the driver holds two numbers for each.
BUCKETS = 64
#: Bytes of text in a bucket.
BUCKET_BYTES = 32 << 20


def sketch_texts(texts: pa.Array, k: int = K) -> list[np.ndarray]:
    """The sketch of each text; null and empty texts have an empty one."""
    out = []
    for _, _, data, off in slices(texts):
        bounds, hashes = words.shingle_sets(data, off)
        small = words.mix(hashes ^ U(0xD1B54A32D192ED03)) >> U(64 - BITS)
        row = np.repeat(np.arange(len(bounds) - 1, dtype=U), np.diff(bounds))
        packed = np.sort((row << U(BITS)) | small) & U((1 << BITS) - 1)
        out += [np.unique(packed[a : min(b, a + k + 8)])[:k] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of two parts taken together."""
    return np.union1d(a, b)[:k]


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * float(1 << BITS) / (float(a[k - 1]) + 1)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity; two empty sketches are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate((a, b)))
    same = both[1:][both[1:] == both[:-1]]
    union = both[np.concatenate(([True], both[1:] != both[:-1]))][:k]
    return float(np.searchsorted(same, union[-1], "right")) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b holds too."""
    if not len(a):
        return 1.0
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return min(1.0, shared / distinct_count(a, k))


def encode(a: np.ndarray) -> str:
    """A sketch as text, five bytes a hash."""
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()).decode()


def decode(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 5)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 3:] = raw
    return wide.view(">u8").reshape(-1).astype(U)


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, fingerprint); n_shingles is the estimate. Null texts count as empty, repeats as rows of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = sketch_texts(batch.column(1), k)
            yield pa.record_batch([batch.column(0), pa.array([distinct_count(s, k) for s in sketches], pa.float64()), pa.array([encode(s) for s in sketches], pa.string())], ["doc_id", "n_shingles", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_shingles double, fingerprint string")


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
    """(doc_id, text, text of the row below) of rows sorted by (bucket, doc_id) descending; the last row of a bucket is a copy of the next bucket's first."""
    held = None
    for batch in batches:
        for bucket, doc, text in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
            if held is not None and held[0] == bucket:
                yield held[1], held[2], text or ""
            held = (bucket, doc, text or "")


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def emit(rows, last_next):
        ids, texts, edited = zip(*rows, strict=True)
        own = sketch_texts(pa.array([*texts, last_next], pa.large_string()))
        new = sketch_texts(pa.array(edited, pa.large_string()))
        return pa.record_batch([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            pa.array([encode(s) for s in own[:-1]]), pa.array([encode(s) for s in new]),
            pa.array([resemblance(a, b) for a, b in zip(own[:-1], new, strict=True)], pa.float64()),
            pa.array([resemblance(a, b) for a, b in zip(own[:-1], own[1:], strict=True)], pa.float64()),
        ], names)

    rows, size, below = [], 0, ""
    for doc, text, following in _with_next(batches):
        if rows and (size > 4 << 20 or below != text):
            # the sketch of the next text is taken from the next row, so a run must be unbroken
            yield emit(rows, below)
            rows, size = [], 0
        cut = len(text) // 3
        rows.append((doc, text, text[: len(text) - cut] + following[:cut]))
        size += len(text)
        below = following
    if rows:
        yield emit(rows, below)


def edited_fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Sketches of every text and of its edited text, and how alike they are.

    The edited text takes its last third from the head of the next document in descending order of id, the last from the
    first. Buckets of ids are sorted apart; each gets a copy of the first row of the bucket below, so that no order over the
    whole table is needed and each text is shuffled once. Rows without id come last; rows with equal ids follow one
    another in the order of their texts. Null texts are empty. A single row is its own next document.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    low, size = docs.agg(F.min("doc_id"), F.sum(F.octet_length("text"))).first()
    buckets = buckets or max(BUCKETS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), (size or 0) // BUCKET_BYTES)
    if low is None:
        low = 0
    cuts = sorted(set(docs.where(F.col("doc_id").isNotNull()).approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.2 / buckets)) - {float(low)})
    cuts = [int(c) for c in cuts]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bucket 0 holds the highest ids; rows without id come after all others
            at = [len(cuts) + 1 if i is None else len(cuts) - bisect_right(cuts, i) for i in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(at, pa.int64()), batch.column(0), batch.column(1)], ["bucket", "doc_id", "text"])

    placed = docs.mapInArrow(place, "bucket long, doc_id long, text string")
    ids = docs.select("doc_id").withColumn("text", F.lit(None).cast("string")).mapInArrow(place, "bucket long, doc_id long, text string")
    # the first row of a bucket: its highest id, and of equal ids the largest text
    firsts = {r.bucket: r["top"] for r in ids.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(firsts)
    if not order:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    above = {b: order[i - 1] for i, b in enumerate(order)}
    tops = [firsts[b] for b in order if firsts[b] is not None]
    wanted = docs.where(F.col("doc_id").isin(tops)) if tops else docs.limit(0)
    if len(cuts) + 1 in firsts:
        wanted = wanted.union(docs.where(F.col("doc_id").isNull()))
    heads = wanted.groupBy("doc_id").agg(F.max(F.coalesce("text", F.lit(""))).alias("text")).mapInArrow(place, "bucket long, doc_id long, text string")
    move = F.create_map(*[F.lit(x) for b in order for x in (b, above[b])])
    heads = heads.select(move[F.col("bucket")].alias("bucket"), "doc_id", "text", F.lit(1).alias("tail"))
    rows = placed.select("bucket", "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit(0).alias("tail")).union(heads)
    run = rows.repartition(len(order), "bucket").sortWithinPartitions("bucket", "tail", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    return run.mapInArrow(_edit, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")

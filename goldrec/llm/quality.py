"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins, and a table gives its share of the log odds. The tables grow by cyclic boosting:
a shallow tree on one feature is fitted to what is still unexplained, then on the next, in small steps. Then the pairs
of features with the largest joint effect get tables of their own. A score is a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm import words
from goldrec.llm.common import slices
from goldrec.session import stage

#: At most so many labelled texts are fitted, those with the smallest hashes of their ids.
MAX_TRAINING = 20_000
BINS, PAIR_BINS, PAIRS = 32, 12, 6
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 250, 120, 0.1, 5.0
THRESHOLD = 0.3
U = np.uint64


def _class(chars: str | list[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) if isinstance(c, str) else c for c in chars]] = True
    return out


CLASSES = {
    "upper": _class(list(range(65, 91))),
    "lower": _class(list(range(97, 123))),
    "digit": _class("0123456789"),
    "stop": _class(".,;:?"),
    "bang": _class("!"),
    "pipe": _class("|"),
    "symbol": _class("#$%&*@^~+=<>{}[]\\/_`"),
    "quote": _class("\"'()-"),
    "line": _class("\n"),
    "wide": _class(list(range(128, 256))),
}
NOT_LINE = np.ones(256, bool)
NOT_LINE[[10, 13]] = False
#: Bytes that end a junk word.
JUNK = _class("#$%&*@^~!|")
FEATURES = [
    "words", "word_bytes", *CLASSES, "distinct_words", "distinct_shingles", "short_words", "long_words", "junk_ends", "repeats",
    "distinct_lines", "line_words",
]


def _distinct(row: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    """Distinct hashes per row."""
    packed = np.sort((row.astype(U) << U(words.HASH_BITS)) | (hashes >> U(12)))
    fresh = np.concatenate(([True], packed[1:] != packed[:-1])) if len(packed) else np.zeros(0, bool)
    return np.bincount((packed[fresh] >> U(words.HASH_BITS)).astype(np.int64), minlength=rows)


def text_features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of features per text; an empty text has zeros."""
    rows = len(off) - 1
    size = np.maximum(np.diff(off), 1)
    row, start, end, h = words.find_words(data, off, words.NOT_SPACE)
    n = np.bincount(row, minlength=rows)
    some = np.maximum(n, 1)
    length = end - start

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(row[mask], minlength=rows) / some

    out = [np.log1p(n), np.diff(off) / some]
    for members in CLASSES.values():
        sums = np.concatenate(([0], np.cumsum(members[data])))
        out.append((sums[off[1:]] - sums[off[:-1]]) / size)
    packed = words.shingles(row, h, rows)
    shingle_count = np.bincount((packed >> U(words.HASH_BITS)).astype(np.int64), minlength=rows)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    lines, _, _, line_hash = words.find_words(data, off, NOT_LINE)
    line_count = np.maximum(np.bincount(lines, minlength=rows), 1)
    out += [
        _distinct(row, h, rows) / some, shingle_count / np.maximum(n - 4, 1), share(length <= 3), share(length >= 14),
        share(JUNK[data[end - 1]]) if len(end) else np.zeros(rows), share(same),
        _distinct(lines, line_hash, rows) / line_count, np.log1p(n / line_count),
    ]
    return np.column_stack(out)


@dataclass
class Model:
    """Bin edges per feature, tables per feature and per pair of features, and the base."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Sum of the table entries of each row."""
        out = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edges, x[:, j], "right")]
        for a, b, edges_a, edges_b, table in self.pairs:
            out += table[np.searchsorted(edges_a, x[:, a], "right"), np.searchsorted(edges_b, x[:, b], "right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(x)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _sums(at: np.ndarray, y: np.ndarray, p: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature per bin."""
    return np.bincount(at, y - p, size), np.bincount(at, p * (1 - p), size)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of ordered bins."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(gl):
        return 0.0, 0
    gain = gl**2 / (hl + RIDGE) + (g.sum() - gl) ** 2 / (h.sum() - hl + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    i = int(gain.argmax())
    return float(gain[i]), i + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values, per bin, of a tree on ordered bins."""
    gain, cut = _best_cut(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + RIDGE))
    return np.concatenate((_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)))


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best pair of cuts of a two-way table: gain and leaf values."""
    def corners(t: np.ndarray) -> np.ndarray:
        a = t.cumsum(0).cumsum(1)[:-1, :-1]
        top, left, all_of = t.sum(1).cumsum()[:-1, None], t.sum(0).cumsum()[None, :-1], t.sum()
        return np.stack((a, top - a, left - a, all_of - top - left + a))

    cg, ch = corners(g), corners(h)
    if not cg.size:
        return 0.0, np.zeros_like(g)
    gain = (cg**2 / (ch + RIDGE)).sum(0)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    leaf = cg[:, i, j] / (ch[:, i, j] + RIDGE)
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = leaf
    return float(gain[i, j] - g.sum() ** 2 / (h.sum() + RIDGE)), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost one feature after another, then the strongest pairs. One class, or no row, gives a constant score."""
    if not len(y):
        return Model()
    rate = np.clip(y.mean(), 0.5 / (len(y) + 1), 1 - 0.5 / (len(y) + 1))
    model = Model(float(np.log(rate / (1 - rate))))
    model.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    at = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    f = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            step = RATE * _tree(*_sums(at[j], y, 1 / (1 + np.exp(-f)), len(table)), 2)
            table += step
            f += step[at[j]]
    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    place = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]

    def two_way(a: int, b: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        g, h = _sums(place[a] * shape[1] + place[b], y, p, shape[0] * shape[1])
        return g.reshape(shape), h.reshape(shape)

    p = 1 / (1 + np.exp(-f))
    gains = sorted(((_quadrants(*two_way(a, b, p))[0], a, b) for a, b in combinations(range(x.shape[1]), 2)), reverse=True)
    model.pairs = [(a, b, coarse[a], coarse[b], np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for g, a, b in gains[:PAIRS] if g > 0]
    for _ in range(PAIR_ROUNDS):
        for a, b, _, _, table in model.pairs:
            step = RATE * _quadrants(*two_way(a, b, 1 / (1 + np.exp(-f))))[1]
            table += step
            f += step[place[a], place[b]]
    return model


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, off in slices(batch.column(1)):
            yield pa.record_batch([batch.column(0).slice(low, high - low), pa.array(list(text_features(data, off)), pa.list_(pa.float64()))], ["y", "x"])


def train(docs: DataFrame, labels: DataFrame, rows: int = MAX_TRAINING) -> Model:
    """Fit labels.quality on at most ``rows`` labelled documents.

    The sample has the smallest hashes of the ids, so it does not depend on partitions. Of texts that share an id the one of
    the smallest hash is taken. Labels that are null, repeated with another value, or of no document are left out.
    """
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("z")).where("y = z")
    chosen = stage(known.select("doc_id", F.col("y").cast("double").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "labels")
    # one text per id, so the sample is bounded by ``rows``
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = labelled.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    found = texts.select("y", "text").mapInArrow(_feature_rows, "y double, x array<double>").toArrow()
    if not len(found):
        return Model()
    x = np.array(found["x"].to_pylist())
    y = np.asarray(found["y"].combine_chunks())
    order = np.lexsort((*x.T[::-1], y))  # rows arrive in any order; sums of floats should not differ
    return fit(x[order], y[order])


def _scored(batch_texts: pa.Array, model: Model) -> np.ndarray:
    parts = [model.score(text_features(data, off)) for _, _, data, off in slices(batch_texts)]
    return np.concatenate(parts) if parts else np.zeros(0)


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of each row; null texts count as empty, repeats get equal scores."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _scored(batch.column(1), held.value)
            yield pa.record_batch([batch.column(0), score, (score >= threshold).astype(np.int32)], ["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The rows whose text scores at least the threshold, with all their columns."""
    at = docs.columns.index(text_column)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scored(batch.column(at), held.value) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def learnable(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from: crc32 of the id does not leave 0 modulo 5."""
    return labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)


def held_out_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; a row without id counts as held out."""
    model = train(docs, learnable(labels))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    return score_documents(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")

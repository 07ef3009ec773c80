"""Hard negatives by rotated one-bit codes whose intervals provably hold every score.

A vector is rotated and replaced by the signs of its components; the alignment (inner product of vector and unit code)
and the length of what the code leaves over are stored beside the bits. The rest is rotated and coded again, so each
level shortens it by about 0.6. For a query, the inner product with a code is a popcount over the bit planes of the
rotated, 8-bit query. Alignment times that is the estimate; by Cauchy-Schwarz the rest adds at most its length times the
length of the query outside the code. A row whose interval misses the wanted scores is left at once, the others go one
level deeper, and only survivors are scored by integer products. Nothing is approximate in the result.

The rows are stored once with their codes. Queries are taken in blocks of bounded size: a block is broadcast, the codes
are scanned where they lie, and only the best rows of a task are shuffled. Equal vectors of one label beyond the K
smallest ids can never be among the first, so a frequent vector is cut to K rows before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldrec.llm.common import as_int64
from goldrec.session import scratch_path, stage

#: Components are whole multiples of 1 / SCALE. An anchor has POSITIVES positives, and each of these NEGATIVES negatives.
SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: Anchors are the rows whose id this number divides; where the other number divides it, the label is moved.
ANCHOR_STEP, MOVED_STEP, LABELS = 50, 7, 10
#: Levels of codes; bits of a rotated query component; levels after which thresholds are raised by exact scores.
LEVELS, QUERY_BITS, RAISE_AFTER = 6, 8, (2, 4)
#: Query bytes broadcast at a time, rows in a file of codes, and 64-bit words of codes that a task holds at a time.
QUERY_BYTES, FILE_ROWS, BLOCK_WORDS = 16 << 20, 8192, 1 << 16
#: Relative room for the rounding of stored 32-bit lengths and of sums.
SLACK = 4e-6

SQL = f"""
WITH whole AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % {MOVED_STEP} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(CAST({SCALE} AS DOUBLE) * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
numbered AS (SELECT *, row_number() OVER () AS row FROM whole),
scores AS (
  SELECT a.vec_id AS anchor_id, a.row AS anchor_row, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM numbered a JOIN numbered b ON a.vec_id % {ANCHOR_STEP} = 0 AND a.row <> b.row
),
positives AS (
  SELECT anchor_id, anchor_row, other_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_row ORDER BY score DESC, other_id) AS place
  FROM scores WHERE same QUALIFY place <= {POSITIVES}
)
SELECT p.anchor_id, p.positive_id, n.other_id AS negative_id, p.positive_score, n.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor_row, p.place ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank
FROM positives p JOIN scores n ON n.anchor_row = p.anchor_row AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= {NEGATIVES}
"""


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vector array<int>) of the rows that take part.

    Left out: rows without id, label or vector, with a null or non-finite component, or so long that scores would not fit
    in 64 bits (squared length of the whole vector 2^62 or more).
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    component = lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double"))
    length = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.pow(F.lit(float(SCALE)) * F.abs(x.cast("double")) + 1, 2))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % MOVED_STEP == 0, (label + 1) % LABELS).otherwise(label)
    usable = F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull()
    fitting = embeddings.select("vec_id", "label", "embedding").where(F.when(usable, F.coalesce(finite, F.lit(False))).otherwise(False))
    fitting = fitting.where(length < float(1 << 62))
    return fitting.select(F.col("vec_id").cast("long"), moved.alias("label"), F.transform("embedding", component).cast("array<int>").alias("vector"))


def hadamard(z: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of each row; the width is a power of two."""
    rows, width = z.shape
    half = 1
    while half < width:
        pairs = z.reshape(rows, -1, 2, half)
        z = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, width)
        half *= 2
    return z / np.sqrt(width)


class Rotations:
    """A fixed chain of rotations: random signs, then a Walsh-Hadamard transform, one per level."""

    def __init__(self, dimensions: int, levels: int = LEVELS, seed: int = 20):
        self.width = max(64, 1 << max(0, dimensions - 1).bit_length())
        self.words, self.levels, self.root = self.width // 64, levels, float(np.sqrt(self.width))
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (levels, self.width))

    def padded(self, vectors: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(vectors), self.width), np.int64)
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v
        return out

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(codes, alignments, lengths left over) by row and level."""
        rows, z = len(x), x.astype(float)
        codes = np.zeros((rows, self.levels, self.words), np.uint64)
        align, rest = np.zeros((rows, self.levels)), np.zeros((rows, self.levels))
        for level in range(self.levels):
            z = hadamard(z * self.signs[level])
            up = z >= 0
            codes[:, level] = np.packbits(up, axis=1, bitorder="little").view(np.uint64)
            align[:, level] = np.abs(z).sum(1) / self.root
            z = z - np.where(up, 1.0, -1.0) * (align[:, level] / self.root)[:, None]
            rest[:, level] = np.sqrt((z * z).sum(1))
        return codes, align, rest

    def planes(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bit planes, steps, sums, errors) by query and level.

        A component is step * k with -127 <= k <= 127 but for an error; the planes hold the bits of k + 128, and
        an inner product with a unit code differs by at most the error given.
        """
        n, y = len(q), q.astype(float)
        planes = np.zeros((n, self.levels, QUERY_BITS, self.words), np.uint64)
        steps, sums, errors = (np.zeros((n, self.levels)) for _ in range(3))
        for level in range(self.levels):
            y = hadamard(y * self.signs[level])
            step = np.maximum(np.abs(y).max(1), 1e-30) / 127
            k = np.rint(y / step[:, None])
            raised = (k + 128).astype(np.uint8)
            for bit in range(QUERY_BITS):
                planes[:, level, bit] = np.packbits((raised >> bit) & 1, axis=1, bitorder="little").view(np.uint64)
            steps[:, level], sums[:, level] = step, k.sum(1)
            errors[:, level] = np.abs(y - k * step[:, None]).sum(1) / self.root
        return planes, steps, sums, errors


WEIGHTS = (1 << np.arange(QUERY_BITS)).astype(np.float32)


class Queries:
    """A block of queries ready for popcounts."""

    def __init__(self, rotations: Rotations, numbers: np.ndarray, labels: np.ndarray, vectors: np.ndarray, ranges: list | None):
        self.numbers, self.labels, self.vectors, self.ranges = numbers, labels, vectors, ranges
        self.lengths = np.sqrt((vectors.astype(float) ** 2).sum(1))
        self.planes, self.steps, self.sums, self.errors = rotations.planes(vectors)


class Rows:
    """Coded rows of a task, sorted by label."""

    def __init__(self, rotations: Rotations, ids, labels, vectors, codes, align, rest):
        order = np.lexsort((ids, labels))
        self.rotations, self.ids, self.labels, self.vectors = rotations, ids[order], labels[order], vectors[order]
        codes = codes.reshape(len(ids), rotations.levels, rotations.words)[order]
        self.codes = [np.ascontiguousarray(codes[:, i]) for i in range(rotations.levels)]
        self.ones = [np.bitwise_count(c).sum(1, dtype=np.int64) for c in self.codes]
        self.align = np.ascontiguousarray(align.reshape(len(ids), -1)[order].T)
        self.rest = np.ascontiguousarray(rest.reshape(len(ids), -1)[order].T)
        self.lengths = np.sqrt((self.vectors.astype(float) ** 2).sum(1))

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, "right"))

    def exact(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        return self.vectors[rows].astype(np.int64) @ query

    def survivors(self, queries: Queries, i: int, rows: np.ndarray, wanted) -> np.ndarray:
        """Rows whose interval at every level holds a wanted score.

        ``wanted.holds(low, high)`` tells which intervals do; ``wanted.learn(rows, estimates)`` may raise its thresholds.
        """
        length, middle, error = queries.lengths[i], np.zeros(len(rows)), np.zeros(len(rows))
        for level in range(self.rotations.levels):
            code, align = self.codes[level][rows], self.align[level][rows]
            counts = np.bitwise_count(code[None] & queries.planes[i, level][:, None])
            counts = counts[:, :, 0] if counts.shape[2] == 1 else counts.sum(2, dtype=np.int64)
            up = WEIGHTS @ counts.astype(np.float32) - 128 * self.ones[level][rows]
            along = (2 * up - queries.sums[i, level]) * (queries.steps[i, level] / self.rotations.root)
            off = queries.errors[i, level]
            middle = middle + align * along
            error = error + align * off
            outside = np.sqrt(np.maximum(0.0, length * length - np.maximum(0.0, np.abs(along) - off) ** 2))
            room = error + self.rest[level][rows] * outside + SLACK * (self.lengths[rows] * length + 1)
            keep = wanted.holds(middle - room, middle + room)
            if not keep.all():
                rows, middle, error = rows[keep], middle[keep], error[keep]
            if level in RAISE_AFTER:
                wanted.learn(rows, middle)
        return rows


class Nearest:
    """The wanted scores are those of the first k: not below the k-th best of any rows scored so far."""

    def __init__(self, score, k: int, floor: float):
        self.score, self.k, self.floor = score, k, floor

    def holds(self, low, high):
        return high >= self.floor

    def learn(self, rows, middle):
        if len(rows) > self.k:
            best = rows[np.argpartition(-middle, self.k - 1)[: self.k]]
            self.floor = max(self.floor, int(self.score(best).min()))


class Ranged:
    """The wanted scores are the k highest inside each range (low, high)."""

    def __init__(self, score, k: int, ranges: list[tuple[int, int]]):
        self.score, self.k, self.ranges, self.floors = score, k, ranges, [low for low, _ in ranges]

    def holds(self, low, high):
        return reduce(np.logical_or, ((low <= top) & (high >= floor) for floor, (_, top) in zip(self.floors, self.ranges, strict=True)))

    def scored(self, scores):
        for j, (_, top) in enumerate(self.ranges):
            inside = scores[scores <= top]
            if len(inside) >= self.k:
                self.floors[j] = max(self.floors[j], int(np.partition(inside, len(inside) - self.k)[len(inside) - self.k]))

    def learn(self, rows, middle):
        for _, top in self.ranges:
            below = np.flatnonzero(middle <= top)
            if len(below) > 4 * self.k:
                below = below[np.argpartition(-middle[below], 4 * self.k)[: 4 * self.k]]
            self.scored(self.score(rows[below]))


def first(have: tuple, scores: np.ndarray, ids: np.ndarray, same: np.ndarray, k: int) -> tuple:
    """(scores, ids, same) of what is at hand and of new rows: the k highest scores, of equal ones the smaller ids."""
    scores, ids, same = np.append(have[0], scores), np.append(have[1], ids), np.append(have[2], same)
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order], same[order]


def seeds(rows: np.ndarray, n: int) -> np.ndarray:
    return rows[:: max(1, len(rows) // n)]


def positives_in(rows: Rows, queries: Queries, k: int, best: list) -> None:
    """Merge the first k rows of each query's own label into ``best``, with a mark on vectors equal to the query's."""
    for i in range(len(queries.numbers)):
        q, (low, high) = queries.vectors[i], rows.of_label(queries.labels[i])
        if low == high:
            continue
        wanted = Nearest(lambda r, q=q: rows.exact(r, q), k, best[i][0][-1] if len(best[i][0]) == k else -np.inf)
        own = np.arange(low, high)
        start = wanted.score(seeds(own, 64))
        if len(start) >= k:
            wanted.floor = max(wanted.floor, int(np.partition(start, len(start) - k)[len(start) - k]))
        left = rows.survivors(queries, i, own, wanted)
        same = (rows.vectors[left] == q).all(1).astype(np.int64)
        best[i] = first(best[i], wanted.score(left), rows.ids[left], same, k)


def negatives_in(rows: Rows, queries: Queries, k: int, best: list) -> None:
    """Merge the first k rows of other labels in each range of each query into ``best``, one entry per query and range."""
    everything = np.arange(len(rows.ids))
    for i in range(len(queries.numbers)):
        q, (low, high) = queries.vectors[i], rows.of_label(queries.labels[i])
        others = np.concatenate([everything[:low], everything[high:]])
        if not len(others) or not queries.ranges[i]:
            continue
        wanted = Ranged(lambda r, q=q: rows.exact(r, q), k, queries.ranges[i])
        for j, have in enumerate(best[i]):
            if len(have[0]) == k:
                wanted.floors[j] = max(wanted.floors[j], int(have[0][-1]))
        wanted.scored(wanted.score(seeds(others, 256)))
        left = rows.survivors(queries, i, others, wanted)
        scores, ids = wanted.score(left), rows.ids[left]
        for j, (least, top) in enumerate(queries.ranges[i]):
            inside = (scores >= least) & (scores <= top)
            best[i][j] = first(best[i][j], scores[inside], ids[inside], np.full(int(inside.sum()), j), k)


def _vectors(column: pa.Array) -> list[np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values, off = np.asarray(column.flatten()), np.asarray(column.offsets)
    off = off - off[0]
    return [values[off[i] : off[i + 1]] for i in range(len(column))]


CODED = "vec_id long, label long, vector array<int>, code binary, align binary, rest binary"


def code_rows(rows: DataFrame, rotations: Rotations) -> DataFrame:
    """Rows with their codes, alignments and lengths left over, in files of at most FILE_ROWS rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                part = batch.slice(low, 2048)
                codes, align, rest = rotations.encode(rotations.padded(_vectors(part.column(2))))
                packed = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (codes, align.astype(np.float32), rest.astype(np.float32))]
                yield pa.record_batch([*part.columns, *packed], ["vec_id", "label", "vector", "code", "align", "rest"])

    spark = rows.sparkSession
    path = scratch_path(spark, "codes")
    coded = rows.select("vec_id", "label", "vector").mapInArrow(run, CODED)
    coded.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return spark.read.schema(coded.schema).parquet(path)


def _blocks(batches: Iterator[pa.RecordBatch], rotations: Rotations) -> Iterator[Rows]:
    """Rows of a task in blocks of bounded size."""
    most = max(256, BLOCK_WORDS // rotations.words)

    def block(parts: list[pa.RecordBatch]) -> Rows:
        table = pa.Table.from_batches(parts)
        flat = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
        vectors = rotations.padded([v for c in table["vector"].chunks for v in _vectors(c)]).astype(np.int32)
        codes, align, rest = flat("code", np.uint64), flat("align", np.float32).astype(float), flat("rest", np.float32).astype(float)
        return Rows(rotations, as_int64(table["vec_id"]), as_int64(table["label"]), vectors, codes, align, rest)

    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        for low in range(0, batch.num_rows, most):
            part = batch.slice(low, most)
            if n + part.num_rows > most:
                yield block(held)
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if n:
        yield block(held)


def _query_blocks(queries: DataFrame, rotations: Rotations) -> Iterator[Queries]:
    """The staged queries in blocks of at most about QUERY_BYTES, dealt by their number."""
    size = rotations.width * 8 + rotations.levels * (rotations.words * QUERY_BITS * 8 + 24) + 256
    count = -(-queries.count() * size // QUERY_BYTES)
    for block in range(count):
        table = queries.where(F.pmod(F.xxhash64("query"), F.lit(count)) == block).toArrow()
        if not table.num_rows:
            continue
        vectors = rotations.padded([v for c in table["vector"].chunks for v in _vectors(c)])
        ranges = [[score_range(p) for p in found] for found in table["found"].to_pylist()] if "found" in table.column_names else None
        yield Queries(rotations, as_int64(table["query"]), as_int64(table["label"]), vectors, ranges)


def score_range(positive: int) -> tuple[int, int]:
    """Smallest and largest negative score for a positive score: from a half to 95 of a hundred."""
    return -(-positive // 2), 95 * positive // 100


def _search(coded: DataFrame, queries: DataFrame, rotations: Rotations, k: int) -> DataFrame:
    """(query, mark, score, vec_id, rank): the first k rows per query of its own label; mark is 1 for a vector like the query's.

    A query table with ``found`` (positive scores) asks for the first k rows of other labels in the range of each; mark is
    the number of the range.
    """
    ranged = "found" in queries.columns
    spark, results = coded.sparkSession, []
    for block in _query_blocks(queries, rotations):
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            asked = held.value
            nothing = (np.zeros(0, np.int64),) * 3
            best = [[nothing] * len(r) for r in asked.ranges] if ranged else [nothing] * len(asked.numbers)
            for rows in _blocks(batches, rotations):
                (negatives_in if ranged else positives_in)(rows, asked, k, best)
            numbers = asked.numbers if not ranged else np.repeat(asked.numbers, [len(r) for r in asked.ranges])
            lists = best if not ranged else [x for xs in best for x in xs]
            if lists:
                columns = [np.repeat(numbers, [len(x[0]) for x in lists])] + [np.concatenate([x[c] for x in lists]) for c in (2, 0, 1)]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["query", "mark", "score", "vec_id"])

        local = coded.mapInArrow(run, "query long, mark long, score long, vec_id long")
        order = Window.partitionBy("query", *["mark"] * ranged).orderBy(F.desc("score"), "vec_id")
        results.append(stage(local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "scored"))
    empty = spark.createDataFrame([], "query long, mark long, score long, vec_id long, rank int")
    return reduce(DataFrame.union, results, empty)


def hard_negatives(embeddings: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exact.

    Takes (vec_id, label, embedding array of floats); other columns are ignored. Rows without id, label or vector, with a null
    or non-finite component, or with a squared whole length of 2^62 or more take no part. Rows that repeat in id, label and
    vector are one row; rows that only share an id are rows of their own. A shorter vector counts as continued by zeros.
    Equal scores are ordered by id. An empty table, and one without anchors, gives an empty table.
    """
    spark = embeddings.sparkSession
    rows = whole_vectors(embeddings)
    size = rows.agg(F.max(F.size("vector"))).first()[0]
    rotations = Rotations(size or 1, levels)
    k = POSITIVES + 1  # one of the first may be the anchor itself
    copies = Window.partitionBy("label", "vector").orderBy("vec_id")
    needed = rows.distinct().withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k).drop("copy")
    coded = code_rows(needed, rotations)

    anchors = stage(rows.where(F.col("vec_id") % ANCHOR_STEP == 0).distinct(), "anchors")
    queries = stage(anchors.select("label", "vector").distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    anchors = stage(anchors.join(queries, ["label", "vector"]).select(F.col("vec_id").alias("anchor_id"), "query"), "anchors")

    near = _search(coded, queries, rotations, k)
    near = stage(near.select("query", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("mark").alias("same")), "near")
    order = Window.partitionBy("anchor_id", "query").orderBy(F.desc("positive_score"), "positive_id")
    others = anchors.join(near, "query").where("anchor_id <> positive_id OR same = 0")
    positives = others.withColumn("place", F.row_number().over(order)).where(F.col("place") <= POSITIVES)

    # at most k scores per query; the number of a range is its place in this list
    found = stage(near.groupBy("query").agg(F.sort_array(F.collect_set("positive_score")).alias("found")), "found")
    negatives = _search(coded, queries.join(found, "query"), rotations, NEGATIVES).join(found, "query").select(
        "query", F.get("found", F.col("mark").cast("int")).alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return positives.join(negatives, ["query", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )

"""Helpers shared by the operators: Arrow buffers, checked broadcasts, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.session import stage

#: A table is broadcast only when its counted rows fit in this many bytes; else it is joined by a shuffle.
BROADCAST_LIMIT = 32 << 20


def read_table(spark, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def unused_name(columns: list[str], name: str) -> str:
    """The name, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def fits(df: DataFrame, row_bytes: int, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether the counted rows of a staged table may be broadcast."""
    return df.count() * row_bytes <= limit


def join_counted(left: DataFrame, right: DataFrame, on: str | list[str], how: str, row_bytes: int = 32) -> DataFrame:
    """Join with a staged right side; it is broadcast only if its counted size allows."""
    return left.join(F.broadcast(right) if fits(right, row_bytes) else right, on, how)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


#: What an operator keeps in a worker from task to task, by name.
_tools: dict[str, object] = {}
#: Batches of at least so many bytes leave memory worth returning.
GIVE_BACK_BYTES = 4 << 20
_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)


def worker_tools(name: str, make: Callable[[], object]):
    """What ``make`` returns, kept warm in the worker until a task of another operator comes."""
    if name not in _tools:
        _tools.clear()
        _tools[name] = make()
    return _tools[name]


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks, and what they hold counts for the executor."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def slices(column: pa.Array, max_bytes: int = 1 << 20, max_rows: int = 4096) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows (low, high, bytes, offsets) of bounded size; a longer text is a run of its own.

    Tools that another operator kept in this worker are dropped first.
    """
    if _tools:
        _tools.clear()
        give_back()
    data, off = utf8(column)
    low, n = 0, len(off) - 1
    while low < n:
        high = int(np.searchsorted(off, off[low] + max_bytes, "right")) - 1
        high = max(low + 1, min(high, low + max_rows, n))
        yield low, high, data[off[low] : off[high]], off[low : high + 1] - off[low]
        low = high
    if len(data) >= GIVE_BACK_BYTES:
        give_back()


def as_int64(column: pa.Array) -> np.ndarray:
    """Values of an id column; null is 0, so mask it where that matters."""
    return np.asarray(pc.fill_null(column.cast(pa.int64()), 0))


#: Edges that a task contracts at once.
CONTRACTED_EDGES = 1 << 18


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the edges (a, b) connect."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        if (low == high).all():
            break
        np.minimum.at(label, high, low)  # hook the larger root to the smaller one, then let all find their roots
        while (label[label] != label).any():
            label = label[label]
    tied = label != np.arange(len(nodes))
    return nodes[tied], nodes[label[tied]]


#: Columns of contracted edges.
FOREST = "u long, v long"


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows FOREST: forests of the edges (a, b) of a task, so many at once."""
    held, size = [], 0
    for batch in batches:
        held.append(tuple(np.asarray(c) for c in batch.columns[:2]))
        size += batch.num_rows
        if size >= 2 * CONTRACTED_EDGES:
            held = [forest(*(np.concatenate(c) for c in zip(*held, strict=True)))]
            size = len(held[0][0])
            if size >= CONTRACTED_EDGES:
                yield pa.record_batch(list(held[0]), ["u", "v"])
                held, size = [], 0
    if size:
        yield pa.record_batch(list(forest(*(np.concatenate(c) for c in zip(*held, strict=True)))), ["u", "v"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node on an edge (a, b) of longs; label is the smallest node that can be reached.

    Edges are contracted in the tasks that make them. If Python makes them, let it ``contract`` them too and call
    ``forest_components``: a task with two Python steps takes two workers, and an executor keeps using them all.
    """
    return forest_components(edges.where("a <> b").select("a", "b").mapInArrow(contract, FOREST))


def forest_components(forests: DataFrame) -> DataFrame:
    """As connected_components, of edges FOREST that ``contract`` has made.

    They are contracted once more in blocks of CONTRACTED_EDGES: each block becomes a forest of depth one. One block is the
    answer. More are joined by large-star and small-star steps, which alternate until nothing changes. Each step is a
    minimum per node, which is combined before the shuffle, and an equi-join. Every round is written to the shared folder.
    """
    e = stage(forests, "edges")
    blocks = -(-e.count() // CONTRACTED_EDGES)
    e = stage(e.coalesce(max(1, blocks)).mapInArrow(contract, FOREST), "edges")
    seen = None
    while blocks > 1:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)

"""Records of delimited text whose values may hold line breaks, found by many tasks in one file.

Spark reads the lines of a file in blocks, but where a block starts a value in quotes may be open, so a line alone does not tell
whether it begins a record. Each line maps the state before it (open or not) to the state after it; lines without
a quote change nothing. A first pass takes the map of every block, under both states, with the number of records that end
in it. Composing these maps in block order, one small row per block, gives the true state and the number of records before each
block. A second pass cuts every block into records. A record that runs across blocks leaves a piece in each; the
pieces meet by record number, so only they are shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# functions of this module travel to the workers by value: these need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE = '"'
#: Stands for a field with nothing between its separators; U+FFFF is no character, so no text holds it.
NOTHING = "\uffffnull\uffff"
#: The table of blocks that do not begin a file is broadcast: so many bytes each, so many at most.
BLOCK_ROW_BYTES, BLOCK_TABLE_BYTES = 40, 32 << 20
RECORD = "file long, number long, at long, text string"


def state_after(line: str, inside: bool, sep: str) -> bool:
    """Whether a value in quotes is open after a line.

    A value is quoted if a quote is its first character. A quote that is not doubled closes it, and what follows up to the separator
    belongs to it. Quotes inside other values are characters like any other.
    """
    at = 0
    while True:
        if inside:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if line.startswith(QUOTE, at + 1):
                at += 2
                continue
            inside, at = False, line.find(sep, at + 1) + 1
            if not at:
                return False
        if line.startswith(QUOTE, at):
            inside, at = True, at + 1
            continue
        at = line.find(sep + QUOTE, at) + len(sep)
        if at < len(sep):
            return False


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, at, text) of every line: a hash of the file's name and the place of the block that the line begins in."""
    block = F.col("_metadata.file_block_start")
    return spark.read.option("lineSep", "\n").text(path).select(F.xxhash64("_metadata.file_path").alias("file"), block.alias("at"), F.col("value").alias("text"))


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """(file, block, texts, numbers of the lines with a quote) of each run of lines of one block."""
    file, at = (np.asarray(batch.column(i)) for i in (0, 1))
    edges = np.flatnonzero((file[1:] != file[:-1]) | (at[1:] != at[:-1])) + 1
    for low, high in zip([0, *edges], [*edges, len(file)], strict=True):
        if low < high:
            texts = batch.column(2).slice(low, high - low)
            quoted = np.flatnonzero(np.asarray(pc.match_substring(texts, QUOTE)))
            yield int(file[low]), int(at[low]), texts, quoted


def _states(texts: pa.Array, quoted: np.ndarray, inside: bool, sep: str) -> np.ndarray:
    """Whether a value is open after each line."""
    after = np.empty(len(quoted) + 1, bool)
    after[0] = inside
    for i, k in enumerate(quoted):
        inside = after[i + 1] = state_after(texts[int(k)].as_py(), inside, sep)
    return np.repeat(after, np.diff([0, *quoted, len(texts)]))


def block_table(spark: SparkSession, found: DataFrame, sep: str) -> dict[tuple[int, int], tuple[bool, int, bool]]:
    """(file, block) -> (a value is open before it, records ended before it, lines end in CR LF), without first blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, None

        def row():
            return pa.record_batch([pa.array([x]) for x in (*current, *held)], names)

        names = ["file", "at", "open_after_closed", "open_after_open", "ends_closed", "ends_open", "cr"]
        for batch in batches:
            for file, at, texts, quoted in _segments(batch):
                if (file, at) != current:
                    if current:
                        yield row()
                    current, held = (file, at), [False, True, 0, 0, at == 0 and texts[0].as_py().endswith("\r")]
                for i in (0, 1):
                    states = _states(texts, quoted, held[i], sep)
                    held[i], held[2 + i] = bool(states[-1]), held[2 + i] + int((~states).sum())
        if current:
            yield row()

    schema = "file long, at long, open_after_closed boolean, open_after_open boolean, ends_closed long, ends_open long, cr boolean"
    order = W.partitionBy("file").orderBy("at")
    # a block that ends alike under both states settles what follows; one that keeps the state passes it on
    settled = F.when(F.col("open_after_closed") == F.col("open_after_open"), F.col("open_after_closed"))
    swaps = F.col("open_after_closed") & ~F.col("open_after_open")
    blocks = found.mapInArrow(run, schema).withColumns({"settled": settled, "swaps": F.sum(swaps.cast("int")).over(order)})
    # swaps since the last settled block decide; before any, the state at the start of the file is closed
    before = order.rowsBetween(W.unboundedPreceding, -1)
    last = F.last(F.when(F.col("settled").isNotNull(), F.struct("settled", "swaps")), True).over(before)
    turns = F.coalesce(F.last("swaps").over(before), F.lit(0)) - F.coalesce(last["swaps"], F.lit(0))
    blocks = blocks.withColumn("open", (F.coalesce(last["settled"], F.lit(False)).cast("int") + turns) % 2 == 1)
    ends = F.when(F.col("open"), F.col("ends_open")).otherwise(F.col("ends_closed"))
    blocks = blocks.withColumns({"number": F.coalesce(F.sum(ends).over(before), F.lit(0)), "crlf": F.first("cr").over(order)})
    later = blocks.where("at > 0").select("file", "at", "open", "number", "crlf")
    rows = later.limit(BLOCK_TABLE_BYTES // BLOCK_ROW_BYTES + 1).toArrow()
    if rows.num_rows > BLOCK_TABLE_BYTES // BLOCK_ROW_BYTES:
        raise ValueError("too many blocks in files of more than one: raise spark.sql.files.maxPartitionBytes or read the files in groups")
    return {(f, a): (o, n, c) for f, a, o, n, c in zip(*(c.to_pylist() for c in rows.columns), strict=True)}


def _cut(table, sep: str, pieces: bool):
    """Rows of RECORD: whole records, or pieces of records that run across blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value
        last = {}
        for file, at in known:
            last[file] = max(at, last.get(file, 0))
        current, inside, number, crlf, held, begun = None, False, 0, False, [], False

        def rows(numbers, texts):
            n = len(numbers)
            return pa.record_batch([pa.array([current[0]] * n, pa.int64()), pa.array(numbers, pa.int64()), pa.array([current[1]] * n, pa.int64()), texts], ["file", "number", "at", "text"])

        def chomp(text):
            return text[:-1] if crlf and text.endswith("\r") else text

        def rest():
            """What is open at the end of a block: a piece, unless it begins here and the file ends here."""
            goes_on = current[1] < last.get(current[0], 0)
            if held and (goes_on or not begun) == pieces:
                yield rows([number], pa.array(["\n".join(held)], pa.string()))

        for batch in batches:
            for file, at, texts, quoted in _segments(batch):
                if (file, at) != current:
                    if current:
                        yield from rest()
                    current, held = (file, at), []
                    if at:
                        inside, number, crlf = known[current]
                    else:
                        inside, number, crlf = False, 0, texts[0].as_py().endswith("\r")
                        if texts[0].as_py().startswith("﻿"):
                            texts = pa.concat_arrays([pa.array([texts[0].as_py()[1:]], texts.type), texts.slice(1)])
                            quoted = np.flatnonzero(np.asarray(pc.match_substring(texts, QUOTE)))
                    begun = not inside  # whether the open record began in this block
                after = _states(texts, quoted, inside, sep)
                before = np.concatenate(([inside], after[:-1]))
                ends = np.cumsum(~after)
                alone = ~after & ~before
                if not pieces and alone.any():
                    kept = texts.filter(pa.array(alone))
                    yield rows(number + ends[alone] - 1, pc.replace_substring_regex(kept, r"\r\z", "") if crlf else kept)
                some = [], []
                for k in np.flatnonzero(~alone):
                    held.append(texts[int(k)].as_py())
                    if not after[k]:
                        if begun != pieces:
                            some[0].append(number + int(ends[k]) - 1)
                            some[1].append(chomp("\n".join(held)))
                        held, begun = [], True
                if some[0]:
                    yield rows(some[0], pa.array(some[1], pa.string()))
                inside, number = bool(after[-1]), number + int(ends[-1])
        if current:
            yield from rest()

    return run


def records(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """(file, number, text) of every record, numbered from 0 in each file; a blank line is a record of empty text.

    The end of a line is LF, or CR LF if a file's first line ends so; other line breaks belong to values. A file is read by as many tasks as it
    has blocks (spark.sql.files.maxPartitionBytes), however its values are quoted, and parsed nowhere twice.
    """
    found = lines(spark, path)
    table = block_table(spark, found, sep)
    held = spark.sparkContext.broadcast(table)
    whole = found.mapInArrow(_cut(held, sep, False), RECORD).select("file", "number", "text")
    if not any(is_open for is_open, _, _ in table.values()):
        return whole
    pieces = found.mapInArrow(_cut(held, sep, True), RECORD)
    parts = F.array_sort(F.collect_list(F.struct("at", "text")))  # as many pieces as blocks that one record covers
    joined = pieces.groupBy("file", "number").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    return whole.unionByName(joined)

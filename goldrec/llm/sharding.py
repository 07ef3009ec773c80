"""Shards of nearly equal bytes by sampled splitters.

Records are ordered by (hash of the text, hash of the id), so equal texts are neighbours and yet a group of copies
can be cut. A size-weighted sample of keys gives quantile boundaries of many fine ranges. Exact bytes per range show
overfull ones, which are sampled again and subdivided. Range totals (a bounded number) then place every range on the
line of all bytes, and a running sum inside the range places every record: shard = floor(shards * bytes before / all
bytes). Shards thus differ by less than one record, however the sample fell.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from goldrec.session import stage

SHARDS = 40
OVERHEAD = 16
#: Least number of fine ranges (more on a session with many shuffle partitions), and sampled keys for each of
#: them; both bound what the driver holds.
RANGES = 512
SAMPLES = 32


def keyed_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size, CRC of the text, and the order (major, minor). A null text is an empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("major"),
        F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("minor")).alias("minor"),
    )


def _sample(rows: DataFrame, wanted: int, total: int, seed: int) -> list[tuple[int, int]]:
    """About ``wanted`` keys, each record drawn with a chance that grows with its size."""
    ticket = F.pmod(F.xxhash64("minor", "major", F.lit(seed)), F.lit(1 << 40))
    bound = F.least(F.lit(float(1 << 40)), F.col("size") * F.lit(wanted * float(1 << 40) / max(total, 1)))
    return [(r.major, r.minor) for r in rows.where(ticket < bound).select("major", "minor").toLocalIterator()]


def _assign(splitters: list[tuple[int, int]]):
    majors = np.array([s[0] for s in splitters], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            major, minor = np.asarray(batch.column(3)), np.asarray(batch.column(4))
            low, high = np.searchsorted(majors, major, "left"), np.searchsorted(majors, major, "right")
            for i in np.flatnonzero(low < high):  # the key's text is a splitter's
                low[i] = bisect_right(splitters, (major[i], minor[i]))
            yield pa.record_batch([*batch.columns, pa.array(low)], [*batch.schema.names, "range"])

    return run


def _ranges(keyed: DataFrame, total: int, ranges: int) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """Records with their fine range, and {range: (bytes, rows)}; overfull ranges are subdivided."""
    schema = f"doc_id {dict(keyed.dtypes)['doc_id']}, size long, text_crc32 long, major long, minor long, range long"
    splitters = sorted(set(_sample(keyed, ranges * SAMPLES, total, 0)))[SAMPLES - 1 :: SAMPLES]
    for attempt in range(1, 5):
        placed = keyed.mapInArrow(_assign(splitters), schema)
        weights = {r.range: (r.bytes, r.n) for r in placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()}
        overfull = [k for k, (b, n) in weights.items() if n > 1 and b > 4 * total / ranges]
        if not overfull or attempt == 4:
            break
        more = sum(weights[k][0] for k in overfull)
        parts = max(1, round(4 * ranges * more / total))
        drawn = sorted(set(_sample(placed.where(F.col("range").isin(overfull)), parts * SAMPLES, more, attempt)))
        splitters = sorted({*splitters, *drawn[SAMPLES - 1 :: SAMPLES]})
    return placed, weights


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, ranges: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of (doc_id, text).

    Slots count from 0 without gaps inside a shard. Null and empty texts weigh OVERHEAD bytes. Rows that repeat in id
    and text are placed side by side. An empty table gives an empty table. Some shards stay empty if there are fewer rows than shards.
    """
    ranges = ranges or max(RANGES, 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = stage(keyed_sizes(docs), "keyed")
    total = keyed.agg(F.sum("size")).first()[0] or 0
    placed, weights = _ranges(keyed, total, ranges)
    before, rank, rows = 0, 0, []
    for k in sorted(weights):
        rows.append((k, before, rank))
        before, rank = before + weights[k][0], rank + weights[k][1]
    offsets = keyed.sparkSession.createDataFrame(rows, "range long, bytes_before long, rows_before long")
    inside = W.partitionBy("range").orderBy("major", "minor", "doc_id", "size")
    sums = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    shard = F.least(F.lit(shards - 1), F.floor(F.col("at").cast("decimal(38,0)") * shards / F.lit(max(total, 1))).cast("int"))
    line = (
        placed.withColumns({"sum_bytes": F.sum("size").over(sums), "rank_in": F.row_number().over(inside)})
        .join(F.broadcast(offsets), "range")  # one row for each range
        .withColumn("at", F.col("bytes_before") + F.col("sum_bytes") - F.col("size"))
        .select("doc_id", "size", "text_crc32", shard.alias("shard"), (F.col("rows_before") + F.col("rank_in") - 1).alias("rank"))
    )
    line = stage(line, "shards")
    first = line.groupBy("shard").agg(F.min("rank").alias("first"))
    return line.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )

"""A Bloom filter of wanted keys, applied where a large table is scanned.

When the wanted keys are too many to broadcast, joining with them means shuffling one row per key of the whole table. A filter
of a few bits per key leaves nearly nothing but wanted rows before that shuffle. It is built and tested with column
expressions only: bits are OR-ed per 64-bit word in the map tasks, the words become one array, and the scan reads that array as a
scalar subquery. The filter lets every wanted key pass; the few others that pass are removed by the join behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key, tested bits per key, and the most words of the filter (32 MiB).
BITS_PER_KEY, PROBES, MAX_WORDS = 24, 4, 4 << 20
#: Below so many bits per key too much would pass.
LEAST_BITS = 5


def filter_words(n: int) -> int:
    """64-bit words for n keys: a power of two; 0 if even the largest filter is too small for them."""
    words = 1
    while words * 64 < n * BITS_PER_KEY and words < MAX_WORDS:
        words *= 2
    return words if words * 64 >= n * LEAST_BITS else 0


def _positions(key: Column, words: int) -> list[Column]:
    """Places of a key's bits: two fields of each of two hashes. At most 2^28 bits, so a field never leaves its half."""
    mask = F.lit(words * 64 - 1).cast("bigint")
    hashes = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(h, half).bitwiseAND(mask) for h in hashes for half in (0, 32)][:PROBES]


def key_bits(keys: DataFrame, key: str, words: int) -> DataFrame:
    """One row with the array of words that hold the bits of all keys."""
    at = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_positions(F.col(key), words))).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND(F.lit(63).cast("bigint")).cast("int"))
    filled = at.groupBy(F.shiftright("at", 6).alias("id")).agg(F.bit_or(bit).alias("bits"))
    # as many rows as words, whatever the number of keys
    dense = keys.sparkSession.range(words).join(filled, "id", "left").select("id", F.coalesce("bits", F.lit(0)).alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("id", "bits")))
    return dense.agg(F.transform(ordered, lambda x: x["bits"]).alias("words"))


def may_be_wanted(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str, n: int) -> DataFrame:
    """Rows whose key may be among n wanted ones: all that are, and about one in two thousand of the others; no null keys."""
    words = filter_words(n)
    df = df.where(F.col(key).isNotNull())
    if not words:
        return df
    bits = key_bits(wanted, wanted_key, words).scalar()
    for at in _positions(F.col(key), words):
        word = F.element_at(bits, F.shiftright(at, 6).cast("int") + 1)
        df = df.where(F.getbit(word, at.bitwiseAND(F.lit(63).cast("bigint")).cast("int")) == 1)
    return df

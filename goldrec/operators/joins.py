"""Joins of a large table with lists, dictionaries and de-duplicated registries.

The right side is always unique per key, so no join multiplies rows. Spark
broadcasts it when its measured size is below the broadcast threshold, and then
no key needs care. Otherwise both sides are shuffled, and a left partition that
a frequent key has swollen is split among tasks at run time by the adaptive
skew join, each part meeting the few rows of the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.functions.text import canonical_key


def broadcast_bytes(spark: SparkSession) -> int:
    """Size up to which the session broadcasts a table; 0 if it never does."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").lower().strip()
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    number = text.rstrip("bkmgti")
    unit = text[len(number) :][:1]
    return max(0, int(number)) << units.get(unit, 0)


def join_unique(df: DataFrame, right: DataFrame, left_key: Column, right_key: str, how: str) -> DataFrame:
    """Join with a side that is unique per key."""
    keyed = df.withColumn("_join_key", left_key)
    return keyed.join(right, keyed["_join_key"] == right[right_key], how).drop("_join_key")


def key_list(df: DataFrame, column: str, width: int = 9) -> DataFrame:
    """Distinct canonical keys of a list; repeats collapse before the shuffle."""
    key = canonical_key(F.col(column), width)
    return df.where(F.col(column).isNotNull()).select(key.alias("_list_key")).distinct()


def keep_listed(
    df: DataFrame, listed: DataFrame, key: str, list_key: str | None = None
) -> DataFrame:
    """Rows whose key is in the list (JOIN-01, SET-03)."""
    right = key_list(listed, list_key or key)
    return join_unique(df, right, canonical_key(F.col(key)), "_list_key", "left_semi")


def flag_listed(
    df: DataFrame,
    listed: DataFrame,
    key: str,
    flag: str,
    list_key: str | None = None,
) -> DataFrame:
    """Boolean column telling whether the key is in the list (JOIN-02)."""
    right = key_list(listed, list_key or key).withColumn("_hit", F.lit(True))
    joined = join_unique(df, right, canonical_key(F.col(key)), "_list_key", "left")
    return joined.withColumn(flag, F.coalesce(F.col("_hit"), F.lit(False))).drop("_list_key", "_hit")


def attach(
    df: DataFrame, other: DataFrame, key: str, columns: list[str]
) -> DataFrame:
    """Left join on a key with chosen columns of the other side (JOIN-03, JOIN-04).

    The other side must hold a key once; this is not checked, and a repeated key repeats rows. ``registry_for_keys`` and
    ``latest_per_key`` give such tables.
    """
    right = other.select(F.col(key).alias("_other_key"), *[c for c in columns if c != key])
    return join_unique(df, right, F.col(key), "_other_key", "left").drop("_other_key")


def attach_dictionary(
    df: DataFrame,
    dictionary: DataFrame,
    code: str,
    dict_code: str,
    dict_label: str,
    label: str,
) -> DataFrame:
    """Label of a code from a dictionary table, null when unknown (JOIN-05)."""
    right = dictionary.select(F.col(dict_code).alias("_code"), F.col(dict_label).alias(label))
    return join_unique(df, right, F.col(code), "_code", "left").drop("_code")

"""Facts that Parquet keeps in the footers of its files: counts and extremes without reading a column."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: The reader that can push aggregates into footers.
_READER = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def footer_query(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of a table, and per column the number of values, the smallest and the largest; to be run under ``_READER``."""
    facts = [f(F.col(f"`{c}`")).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, f in (("n", F.count), ("low", F.min), ("high", F.max))]
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), *facts)


def footer_facts(spark: SparkSession, path: str, columns: list[str]) -> tuple[int, dict[str, tuple], str]:
    """(rows, column -> (values, smallest, largest), plan) of a Parquet table, taken from its footers.

    Columns of numbers, dates and booleans have extremes there. Where the footers lack one, the column is scanned; the result is
    the same. Floating-point extremes leave NaN out, as footers do.
    """
    with _settings(spark, _READER):
        query = footer_query(spark, path, columns)
        plan = query._jdf.queryExecution().executedPlan().toString()
        row: Row = query.first()
    # without any footer a pushed count is null
    return row["n_rows"] or 0, {c: (row[f"n_{i}"] or 0, row[f"low_{i}"], row[f"high_{i}"]) for i, c in enumerate(columns)}, plan

"""Sinks. Every sink replaces what an earlier run left (SNK-04)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrec.sources.records import NOTHING
from goldrec.sources.versions import current_version, delete, point_to, versions


def flatten_for_text(df: DataFrame) -> DataFrame:
    """Arrays become '|'-joined text and dates ISO text, as text sinks need."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(field.name))
    return df.select(*out)


def write_delimited(df: DataFrame, path: str, sep: str = ",", max_rows_per_file: int = 0) -> None:
    """Delimited text with header (SNK-01, SNK-03), one file per task, UTF-8 without BOM (SNK-02).

    Values are written as they are. Empty text is written as "" and null as nothing, and
    ``read_delimited`` tells them apart. In a table of one column nothing would be no line, so null is written as a mark there.
    """
    (
        flatten_for_text(df)
        .write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("nullValue", NOTHING if len(df.columns) == 1 else "")
        .option("lineSep", "\n")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", max_rows_per_file)
        .csv(path)
    )


def write_with_preamble(df: DataFrame, path: str, sep: str = ",") -> None:
    """Delimited text that begins with a line 'sep=…' and a header in every file, as ``read_with_preamble`` expects (SRC-04)."""
    rows = flatten_for_text(df)
    options = {"sep": sep, "escape": '"', "emptyValue": '""', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    line = F.to_csv(F.struct("*"), options)
    names = sep.join('"' + n.replace('"', '""') + '"' if sep in n or '"' in n else n for n in rows.columns)
    # the lower bits of this id number the rows of a task, and a task writes one file
    opens_file = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    text = F.when(opens_file, F.concat(F.lit(f"sep={sep}\n{names}\n"), line)).otherwise(line)
    rows.select(text.alias("value")).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet between stages."""
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write a table in place of the one at ``path`` in one step; returns the new version (SNK-04).

    Until the new rows are complete, and if writing them fails, ``read_replaced`` finds the old ones. The version before
    stays for those who still read it; older ones, and what a failed write left, are removed.
    """
    spark = df.sparkSession
    version = f"version-{uuid.uuid4().hex}"
    before = current_version(spark, path)
    try:
        df.write.parquet(f"{path}/{version}", partitionBy=partition_by)
    except Exception:
        delete(spark, f"{path}/{version}")
        raise
    point_to(spark, path, version)
    for old in versions(spark, path):
        if old not in (version, before):
            delete(spark, f"{path}/{old}")
    return version

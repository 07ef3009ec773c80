"""Scans. Code columns are always text: nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldrec.functions.text import canonical_key, is_digits, strip
from goldrec.sources.records import NOTHING, records
from goldrec.sources.versions import current_version


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan of chosen columns (SRC-01); filters on it reach the reader (SRC-07)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


#: Every character of a value is data: outer blanks, line breaks, quotes. A field "" is an empty text, an absent one null.
LOSSLESS_READ = {
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": NOTHING,
    "emptyValue": "",
    "maxCharsPerColumn": "-1",
}


def _parse(found: DataFrame, columns: list[str], wanted: list[str], sep: str, skip: int) -> DataFrame:
    """Columns of the records behind the first ones of each file. A blank line is no record."""
    kinds = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    parsed = F.from_csv("text", kinds, {**LOSSLESS_READ, "sep": sep, "lineSep": "\n"})
    kept = found.where((F.col("number") >= skip) & (F.col("text") != ""))
    if len(columns) == 1:
        parsed = F.when(F.col("text") != NOTHING, parsed)
    return kept.select(parsed.alias("row")).select(*[F.col("row").getField(c).alias(c) for c in wanted])


def read_delimited(
    spark: SparkSession, path: str, columns: list[str] | None = None, sep: str = ","
) -> DataFrame:
    """Delimited text with a header line, every column as text (SRC-02, SRC-03).

    The header of one file names the columns; nothing is inferred. A value may hold line breaks, and yet a file is
    read by as many tasks as it has blocks (``records``). The first record of each file is its header.
    """
    names = spark.read.options(**LOSSLESS_READ).option("header", True).option("sep", sep).csv(path).columns
    return _parse(records(spark, path, sep), names, columns or names, sep, 1)


def read_with_preamble(
    spark: SparkSession, path: str, columns: list[str], sep: str = ","
) -> DataFrame:
    """Delimited text whose first line is 'sep=,' and second line the header (SRC-04).

    The first two records of each file are left out, whatever they hold, and no others.
    """
    return _parse(records(spark, path, sep), columns, columns, sep, 2)


def read_replaced(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Scan of the version that ``replace_table`` made current (SNK-04)."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return read_table(spark, f"{path}/{version}", columns)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path holds something, on any file system Spark can reach."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    found = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(location)
    return found is not None and len(found) > 0


def read_optional(
    spark: SparkSession, path: str, columns: list[str], sep: str = ",", fmt: str = "csv"
) -> DataFrame:
    """A missing input is an empty table with the expected text columns (SRC-05)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], text_schema(columns))
    if fmt == "csv":
        df = read_delimited(spark, path, sep=sep)
    else:
        df = spark.read.format(fmt).load(path)
    present = [c if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    return df.select(*present)


def find_key_column(df: DataFrame, hint: str = "siren", width: int = 9) -> str:
    """Name of the id column of a list (SRC-06).

    The first header containing the hint wins. Otherwise it is the first column
    with more than half of its non-null values made of ``width`` digits.
    """
    for name in df.columns:
        if hint.lower() in name.lower():
            return name
    shares = df.agg(
        *[
            F.avg(is_digits(strip(F.col(f"`{c}`").cast("string")), width).cast("int")).alias(str(i))
            for i, c in enumerate(df.columns)
        ]
    ).first()
    for i, name in enumerate(df.columns):
        if shares[i] is not None and shares[i] > 0.5:
            return name
    raise ValueError(f"no id column among {df.columns}")


def load_key_list(df: DataFrame, hint: str = "siren", width: int = 9) -> DataFrame:
    """Distinct canonical ids of a list whose id column has to be found (SRC-06)."""
    column = F.col(f"`{find_key_column(df, hint, width)}`")
    return df.where(column.isNotNull()).select(canonical_key(column, width).alias("key")).distinct()


def lookup_key(df: DataFrame, column: str, value) -> DataFrame:
    """Rows of one key; no row means not found (SRC-08)."""
    return df.where(F.col(column) == F.lit(value))


#: Hash prefixes that a sample counts; so many rows reach the driver at most.
SAMPLE_BUCKETS = 1 << 16


def sample_rows(df: DataFrame, n: int, key: Column, seed: int) -> DataFrame:
    """At most n rows, the same ones at every run (SRC-09): those with the n smallest keyed hashes, in no order.

    The choice does not depend on how the table is partitioned. One scan counts the rows per hash prefix, which tells the
    prefix of the n-th hash. Rows of smaller prefixes stay in their tasks; only those of this one prefix, a
    65 536th of the table, are ordered.
    """
    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    prefix = F.conv(F.substring(ticket, 1, 4), 16, 10).cast("int")
    counts = {r["prefix"]: r["count"] for r in df.groupBy(prefix.alias("prefix")).count().collect()}
    left = n
    for edge in sorted(counts):
        if counts[edge] > left:
            whole = df.where(prefix < edge)
            return whole.union(df.where(prefix == edge).orderBy(ticket, key).limit(left)) if left else whole
        left -= counts[edge]
    return df


def head(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First n rows; with an order the answer is repeatable (SRC-10)."""
    return (df.orderBy(*order) if order else df).limit(n)


def source_profile(df: DataFrame, name: str) -> DataFrame:
    """Row count, column count and column names of a source (SRC-11)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("source"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(",".join(df.columns)).alias("column_names"),
    )

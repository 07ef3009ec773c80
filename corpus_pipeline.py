"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the docs of the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.llm import bpe, decontaminate, jaccard_join, quality, secret_scan
from goldrec.llm.common import join_counted, read_table
from goldrec.session import stage


#: Rows of whole texts in an Arrow batch: a worker and its executor hold a few batches at a time.
BATCH_ROWS = 1_000
#: Near duplicates tie equal regions inside a batch, so larger batches send fewer rows on.
REGION_BATCH_ROWS = 10_000


def set_batches(spark: SparkSession, rows: int) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, fitted on the labels of these documents."""
    set_batches(spark, BATCH_ROWS)
    model = quality.train(docs, quality.learnable(read_table(spark, sf_dir, "labels", ["doc_id", "quality"])))
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; a row without id is kept.

    A document is an id with a text: repeats of one row are one document, of which one stays, and texts that share an id
    are told apart, so that only one with a kept partner goes. Columns of any name are carried along.
    """
    set_batches(spark, REGION_BATCH_ROWS)
    linked = jaccard_join.linked_rows(docs.select("doc_id", "text"))
    counted = linked.groupBy("label", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    first = counted.groupBy("label").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    stays = F.struct("doc_id", "text_hash") == F.col("first")
    decided = counted.join(first, "label").select(F.col("doc_id").alias("id"), "text_hash", stays.alias("stays"), "rows")
    decided = stage(decided.where("NOT stays OR rows > 1"), "decided")

    names = docs.columns
    rows = docs.select(F.struct(*[f"`{c}`" for c in names]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("text_hash"))
    marked = join_counted(rows, decided, ["id", "text_hash"], "left", 40)
    original = [F.col(f"row.`{c}`").alias(c) for c in names]
    kept = marked.where("stays IS NULL").select(*original)
    repeated = decided.where("stays")
    if repeated.isEmpty():
        return kept
    once = join_counted(rows, repeated, ["id", "text_hash"], "inner", 40)
    return kept.union(once.groupBy("id", "text_hash").agg(F.first("row").alias("row")).select(*original))


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark."""
    set_batches(spark, BATCH_ROWS)
    return decontaminate.remove_contamination(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced by a mark."""
    set_batches(spark, BATCH_ROWS)
    return secret_scan.redact_secrets(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of ids and of the decoded bytes."""
    set_batches(spark, BATCH_ROWS)
    return bpe.token_digests(docs)


STAGES = [
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_text),
    ("secrets", redact_secrets),
    ("tokens", encode_tokens),
]
#: No stage can be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A name index that is written once and looked up many times.

Each name is listed under the pairs of its first grams, as in ``matching``; the gram order comes from the index alone, so it
holds for any later query. The listings are bucketed and sorted by pair, the names by id. A lookup shuffles only the
queries to the buckets: no call moves or lists the index again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldrec.operators import matching as M
from goldrec.session import scratch_path, stage

#: Bytes of a listing and of a name in the index, and the share of a bucket.
LISTING_BYTES, NAME_BYTES, BUCKET_BYTES = 24, 200, 64 << 20
_LISTINGS = "pair bigint, id bigint, n int, low bigint, high bigint"


@dataclass(frozen=True)
class StoredIndex:
    """Where an index lies, how it is ordered and bucketed, and the tables it is registered as."""

    spark: SparkSession
    path: str
    ranks: list[int]
    buckets: dict[str, int]  # per table: "names" and "pairs_<score>"
    tables: dict[str, str]

    @property
    def levels(self) -> list[float]:
        return sorted((float(t.removeprefix("pairs_")) for t in self.buckets if t != "names"), reverse=True)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.tables[name])

    def lookup(self, texts: DataFrame) -> DataFrame:
        """Best index entry (text, score, key) of each distinct normalised text, if any reaches the lowest stored score."""
        names = self.table("names")
        open_texts = stage(M.spelled_names(texts, "text"), "query-names")
        same = names.groupBy("sorted").agg(F.min(F.struct("ord", "key")).alias("first"))
        equal = open_texts.join(same, "sorted").select("text", F.lit(100.0).alias("score"), F.col("first.key").alias("key"))
        result = stage(equal, "matches")
        found = result
        for level in self.levels:
            open_texts = stage(open_texts.join(found.select("text"), "text", "left_anti"), "query-names")
            found = stage(M.best_match(self.similar(open_texts, level), level), "matches")
            result = result.unionByName(found)
        return result

    def similar(self, queries: DataFrame, level: float) -> DataFrame:
        """(text, sorted names, key, ord) of the pairs of a query and an indexed name that may reach the score."""
        grams = M.ordered_grams(F.col("codes"), self.ranks)
        asked = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("id", "text", "sorted", "n", "low", "high")], grams.alias("q_grams"))
        first = F.slice("q_grams", F.lit(1), M.prefix_size(F.col("q_n"), level))
        pairs = asked.select("q_id", "q_n", "q_low", "q_high", F.explode(M.gram_pairs(first)).alias("pair"))
        listed = self.table(f"pairs_{level:g}").select("pair", *[F.col(c).alias(f"x_{c}") for c in ("id", "n", "low", "high")])
        met = listed.join(pairs, (listed["pair"] == pairs["pair"]) & M.likely_similar(level)).select("q_id", "x_id").distinct()
        names = self.table("names").select(*[F.col(c).alias(f"x_{c}") for c in ("id", "sorted", "n", "key", "ord", "grams")])
        both = names.join(met.join(asked, "q_id"), "x_id")
        return both.where(M.enough_common(level)).select("q_text", "q_sorted", "x_sorted", "x_key", "x_ord")


def _register(spark: SparkSession, path: str, name: str, schema: str, by: str, buckets: int) -> str:
    """A table of the session over bucketed files that are already there."""
    table = f"goldrec_{name}_{uuid.uuid4().hex}"
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}/{name}'")
    return table


def store_index(index: DataFrame, path: str | None = None, levels: tuple[float, ...] = (90, M.FUZZY_THRESHOLD)) -> StoredIndex:
    """Write an index (norm, key, ord) for lookups at the given scores, by default to a new place in the shared folder."""
    if not all(67 <= s <= 100 for s in levels):
        raise ValueError("the gram bound needs scores of 67 to 100")
    spark = index.sparkSession
    path = path or scratch_path(spark, "name-index")
    spelled = stage(M.spelled_names(index, "norm", "key", "ord"), "index-names")
    ranks = M.index_ranks(spelled)
    names = spelled.withColumn("grams", M.ordered_grams(F.col("codes"), ranks)).drop("codes")
    count = names.count()
    buckets, tables, schemas = {}, {}, {}

    def write(df: DataFrame, name: str, by: str, size: int) -> None:
        buckets[name] = max(1, -(-size // BUCKET_BYTES))
        tables[name], schemas[name] = f"goldrec_{name}_{uuid.uuid4().hex}", df.schema
        # each bucket is written by one task, so that a bucket is one file, sorted once
        dealt = df.repartition(buckets[name], by)
        dealt.write.option("path", f"{path}/{name}").bucketBy(buckets[name], by).sortBy(by).mode("overwrite").saveAsTable(tables[name])

    write(names, "names", "id", count * NAME_BYTES)
    for level in levels:
        first = F.slice("grams", F.lit(1), M.prefix_size(F.col("n"), level))
        size = names.agg(F.sum(M.prefix_size(F.col("n"), level) * (M.prefix_size(F.col("n"), level) - 1) / 2)).first()[0]
        listed = names.select(F.explode(M.gram_pairs(first)).alias("pair"), "id", "n", "low", "high")
        write(listed, f"pairs_{level:g}", "pair", int(size or 0) * LISTING_BYTES)
    facts = [(n, buckets[n], schemas[n].simpleString().removeprefix("struct<").removesuffix(">"), ranks) for n in buckets]
    spark.createDataFrame(facts, "name string, buckets int, fields string, ranks array<int>").coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")
    return StoredIndex(spark, path, ranks, buckets, tables)


def open_index(spark: SparkSession, path: str) -> StoredIndex:
    """An index that another session has stored."""
    facts = spark.read.parquet(f"{path}/facts").collect()
    buckets = {r["name"]: r["buckets"] for r in facts}
    tables = {}
    for r in facts:
        fields = ", ".join(f"{f.split(':', 1)[0]} {f.split(':', 1)[1]}" for f in _split_fields(r["fields"]))
        tables[r["name"]] = _register(spark, path, r["name"], fields, "id" if r["name"] == "names" else "pair", r["buckets"])
    return StoredIndex(spark, path, list(facts[0]["ranks"]), buckets, tables)


def _split_fields(text: str) -> list[str]:
    """Fields of a schema text, split at commas outside of brackets."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(text[start:i])
            start = i + 1
    return [*out, text[start:]]

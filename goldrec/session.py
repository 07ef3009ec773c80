"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Where the current run stages, inside the shared folder.
RUN_KEY = "spark.goldrec.run.folder"
#: Whether the shuffle files of a query go when it ends.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "goldrec", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a session that names
    none (a local test) gets a temporary folder of its own.
    """
    named = spark.conf.get(RUN_KEY, None) or spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="goldrec-")
        spark.conf.set(RUN_KEY, named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """A folder of its own for what one run stages, removed with everything in it when the run ends.

    Frames made inside read their staged tables, so write or collect results before the end.
    """
    before = spark.conf.get(RUN_KEY, None)
    path = scratch_path(spark, name)
    spark.conf.set(RUN_KEY, path)
    try:
        yield path
    finally:
        spark.conf.unset(RUN_KEY) if before is None else spark.conf.set(RUN_KEY, before)
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor. It stays until its folder goes, see ``run_folder``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")  # else what was shuffled for it stays on disk until the driver collects its garbage
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP_KEY) if before is None else spark.conf.set(CLEANUP_KEY, before)
    return spark.read.schema(df.schema).parquet(path)

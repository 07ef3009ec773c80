"""Tables that are replaced in one step: version folders, and a pointer file that names the current one.

A version is written in full before the pointer is swapped by a rename, which is atomic on the file systems that Spark writes
tables to. A write that fails leaves the pointer and the version it names untouched.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

POINTER = "_current"


def _hadoop(spark: SparkSession, path: str):
    """(JVM, file context, path) of a place on any file system."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    qualified = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place)
    return jvm, jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark.sparkContext._jsc.hadoopConfiguration()), qualified


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the version that the pointer of a table names; None without a table."""
    jvm, files, place = _hadoop(spark, f"{path}/{POINTER}")
    if not files.util().exists(place):
        return None
    stream = files.open(place)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def point_to(spark: SparkSession, path: str, version: str) -> None:
    """Swap the pointer of a table."""
    jvm, files, place = _hadoop(spark, f"{path}/{POINTER}")
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}.{version}")
    system = fresh.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = system.create(fresh, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    files.rename(system.makeQualified(fresh), place, how)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the version folders of a table."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory()) if system.exists(place) else []

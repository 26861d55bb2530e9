"""Tables that cut lineage: written once to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DIR = "spark.checkpoint.dir"
# Shuffle files of a finished write are of no more use; without this they stay until garbage collection.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local one only where none is set and Spark runs in one process, as in tests."""
    found = spark.conf.get(DIR, None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {DIR} to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="wayprint-")
        spark.conf.set(DIR, found)
    return found.rstrip("/")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written as parquet to the shared folder and read back.

    What follows does not depend on the executors that computed it. The folder goes
    with :func:`discard`, or else when the session's file system closes.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with _setting(spark, CLEANUP, "true"):
        df.write.option("compression", "zstd").parquet(path)
    files, place = _place(spark, path)
    files.deleteOnExit(place)
    found = spark.read.schema(df.schema).parquet(path)
    found.scratch_path = path
    return found


def bucketed(parts: Iterable[DataFrame], name: str, key: str) -> DataFrame:
    """The rows of all ``parts``, written one after the other to files by ``key``: to group them by it takes no exchange.

    Each part's rows of one key should be in one task. The table leaves the catalog at once; its
    files go with :func:`discard` or with the session, as those of :func:`stored` do.
    """
    name = f"{name}_{uuid.uuid4().hex}"
    for df in parts:
        spark = df.sparkSession
        path = f"{shared_folder(spark)}/{name}"
        writer = df.write.format("parquet").mode("append").option("compression", "zstd").option("path", path)
        with _setting(spark, CLEANUP, "true"):
            writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).saveAsTable(name)
    files, place = _place(spark, path)
    files.deleteOnExit(place)
    found = spark.table(name)
    spark.sql(f"DROP TABLE `{name}`")
    found.scratch_path = path
    return found


@contextmanager
def one_by_one(spark: SparkSession):
    """While it holds, rows are read and given to Python one at a time: for rows of megabytes."""
    with _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1"), _setting(spark, "spark.sql.parquet.columnarReaderBatchSize", "1"):
        yield


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by :func:`stored`, once all that was made from them is stored itself."""
    for df in tables:
        files, place = _place(df.sparkSession, df.scratch_path)
        files.delete(place, True)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place

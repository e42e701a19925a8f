"""Where intermediate tables live, and how lineage is cut.

Executors may be lost at any time, so nothing is kept on one machine: tables that are used
several times are written once under the folder the cluster names in
``spark.checkpoint.dir``. Only a local session without that setting gets a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Spark's own switch; without it shuffle files stay until the driver happens to collect its garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="reviewtide-")
    return _LOCAL_DIRS[app]


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark)}/reviewtide/{label}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes in this block go as each ends: what is written is read instead."""
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return it as a table scan.

    The scan carries exact size statistics, prunes columns and pushes filters, none of which
    a cached or checkpointed plan does after an executor is lost.
    """
    path = new_dir(df.sparkSession, label)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever file system the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that materialises frames for as long as the block lasts.

    For work that ends in a write of its own: what is kept here is deleted with the block.
    """
    base = new_dir(spark, label)

    def keep(df: DataFrame) -> DataFrame:
        path = f"{base}/{uuid.uuid4().hex}"
        with _shuffles_removed(spark):
            df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        remove_path(spark, base)


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that match a glob pattern."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [status.getPath().toString() for status in found or []]


def file_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files in a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


def read_file(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it is there whole or not at all; one that exists is an error."""
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(to.getParent(), f".{uuid.uuid4().hex}")
    files = to.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if files.exists(to) or not files.rename(draft, to):
        files.delete(draft, False)
        raise FileExistsError(path)

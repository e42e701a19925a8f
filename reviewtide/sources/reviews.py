"""Review files: read with a fixed schema, write as bounded JSON-lines files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewtide.schemas import CORRUPT, STORED_PAGE, TRAINING_REVIEW


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).filter(F.trim("value") != "")


def _is_object(line: Column) -> Column:
    return F.from_json(line, "map<string,string>", {"mode": "PERMISSIVE"}).isNotNull()


def unreadable_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The non-blank lines (``line``) of review files that are not JSON objects."""
    lines = _lines(spark, path)
    return lines.filter(~_is_object(F.col("value"))).select(F.col("value").alias("line"))


def read_reviews(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = TRAINING_REVIEW,
    fmt: str = "json",
    keep_corrupt: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Reviews with exactly the schema's fields; a missing key is null.

    Plain and gzip JSON lines work alike. A value of the wrong type is null. A line that is not
    a JSON object is no review: ``unreadable_lines`` gives those, and with ``keep_corrupt`` they
    stay as rows of nulls with their text in ``_corrupt_record``. A
    gzip file cannot be split, so pass ``partitions`` to spread few large ones over the cluster.
    """
    if fmt != "json":
        df = spark.read.schema(schema).format(fmt).load(path)
    else:
        marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        lines = _lines(spark, path)
        if not keep_corrupt:
            lines = lines.filter(_is_object(F.col("value")))
        df = lines.select(F.from_json("value", marked, options).alias("r")).select("r.*")
        df = df if keep_corrupt else df.drop(CORRUPT)
    return df if partitions is None else df.repartition(partitions)


def _file_numbers(lengths: np.ndarray, max_bytes: int, number: int, filled: int) -> tuple[np.ndarray, int, int]:
    """File of each line when a file takes lines while they fit; file ``number`` holds ``filled`` bytes so far."""
    ends = np.cumsum(lengths)
    files = np.empty(len(lengths), np.int64)
    at, before = 0, -filled
    while at < len(lengths):
        stop = int(np.searchsorted(ends, before + max_bytes, "right"))
        if stop == at and ends[at] - lengths[at] == before:
            stop = at + 1  # longer than the bound, so a file of its own
        files[at:stop] = number
        if stop < len(lengths):
            number, before = number + 1, int(ends[stop] - lengths[stop])
        at = stop
    return files, number, int(ends[-1]) - before if len(lengths) else filled


def write_reviews(
    df: DataFrame,
    path: str,
    max_records: int | None = None,
    max_bytes: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """JSON lines with null keys kept, at most ``max_records`` lines in one file.

    With ``max_bytes`` no file is longer either, however line lengths vary, unless it is one line
    that is. Each task then fills one file after the other as its lines stream by; the files of
    number n lie in the folder ``file=n``. ``read_reviews`` reads both forms.
    """
    if max_bytes is None:
        writer = df.write.mode(mode).option("ignoreNullFields", "false")
        if max_records is not None:
            writer = writer.option("maxRecordsPerFile", max_records)
        writer.json(path)
        return

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, filled = 0, 0
        for batch in batches:
            lengths = pc.binary_length(batch["value"]).to_numpy().astype(np.int64) + 1
            files, last, filled = _file_numbers(lengths, max_bytes, last, filled)
            yield pa.RecordBatch.from_arrays([batch["value"], pa.array(files)], names=["value", "file"])

    lines = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    writer = lines.mapInArrow(number, "value string, file long").write.mode(mode).partitionBy("file")
    if max_records is not None:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.text(path)


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored pages: a parquet table, or a folder of HTML files (``fmt='html'``)."""
    if fmt == "html":
        files = spark.read.text(path, wholetext=True)
        name = F.col("_metadata.file_path")
        return files.select(
            F.xxhash64(name).alias("page_id"), name.alias("url"), F.col("value").alias("html")
        )
    return spark.read.schema(STORED_PAGE).format(fmt).load(path)

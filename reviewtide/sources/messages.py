"""JSON messages: encode, read as a stream, decode, normalise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.functions.fixed_values import DEFAULT_CATEGORY, PRICE_TYPE
from reviewtide.functions.ratings import day_of, parse_rating
from reviewtide.functions.text import content_id
from reviewtide.schemas import CORRUPT, MESSAGE

MESSAGE_KEY = ("asin", "name", "category", "price", "timestamp", "rating", "review_text")


def encode_messages(df: DataFrame) -> DataFrame:
    """One JSON text per row in column ``value``, null keys kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def send_messages(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write the encoded rows as compressed message files."""
    encode_messages(df).write.mode(mode).option("compression", "gzip").text(path)


def read_messages(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "text",
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """Message stream with the raw JSON in ``value``.

    A folder of message files by default; any other streaming format that yields a ``value``
    column (a Kafka topic, for instance) works through ``fmt`` and its options.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(path) if path is not None else reader.load()
    return stream.withColumn("value", F.col("value").cast("string"))


def decode_messages(df: DataFrame, col: str = "value") -> DataFrame:
    """Messages as one row each with unified names, all values still text.

    Both producers' field names are accepted. A message that is not valid JSON keeps its text
    in ``_corrupt_record`` and null elsewhere. Other columns of ``df`` stay.
    """
    parsed = F.from_json(
        F.col(col), MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    rest = [c for c in df.columns if c != col]
    m = df.select(*rest, parsed.alias("m"))
    return m.select(
        *rest,
        F.col("m.asin").alias("asin"),
        F.col("m.name").alias("name"),
        F.col("m.category").alias("category"),
        F.col("m.price").alias("price"),
        F.coalesce("m.timestamp", "m.reviewDate").alias("timestamp"),
        F.coalesce("m.rating", "m.overall").alias("rating"),
        F.coalesce("m.review_content", "m.reviewText").alias("review_text"),
        F.col(f"m.{CORRUPT}").alias(CORRUPT),
    )


def with_msg_id(df: DataFrame, cols: tuple[str, ...] = MESSAGE_KEY) -> DataFrame:
    """Add ``msg_id``, the content hash of the given columns."""
    return df.withColumn("msg_id", content_id(*cols))


def normalise_types(df: DataFrame) -> DataFrame:
    """Typed columns from decoded text: ``review_date``, ``rating``, ``price``, ``category``.

    Unreadable values become null; the quality rules report them.
    """
    return (
        df.withColumn("review_date", day_of(F.col("timestamp")))
        .withColumn("rating", parse_rating(F.col("rating")))
        .withColumn("price", F.col("price").try_cast(PRICE_TYPE))
        .withColumn("category", F.coalesce("category", F.lit(DEFAULT_CATEGORY)))
    )

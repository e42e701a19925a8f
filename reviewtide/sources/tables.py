"""Review frames derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.functions.fixed_values import (
    MAX_CATEGORY_CHARS,
    PRICE_CLASS,
    PRODUCT_LINK_CLASS,
    RATING_LINK_CLASS,
    REVIEW_BLOCK_CLASS,
    REVIEW_DATE_CLASS,
    REVIEW_DATE_FORMAT,
    REVIEW_LINK_CLASS,
    REVIEW_TEXT_CLASS,
)
from reviewtide.functions.html import escape_text
from reviewtide.functions.ratings import parse_price
from reviewtide.schemas import CORRUPT

FIRST_DAY = "2022-11-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _as_reviews(rated: DataFrame, *more: Column) -> DataFrame:
    return rated.select(
        F.col("doc_id").alias("review_id"),
        F.col("source").alias("asin"),
        F.col("text").alias("reviewText"),
        F.substring_index("text", "\n", 1).alias("summary"),
        F.expr(
            "CASE WHEN quality = 1 AND toxic = 0 THEN 5 WHEN quality = 1 THEN 4 "
            "WHEN quality = 0 THEN 2 END"
        )
        .cast("float")
        .alias("overall"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("doc_id") % 60).cast("int")).alias(
            "review_date"
        ),
        *more,
    )


def documents(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The documents, dealt over ``partitions`` if given.

    A file of one row group is read by one task, and so is all work on its texts up to the next
    shuffle. Tables of many files need no number.
    """
    docs = table(spark, sf_dir, "documents")
    return docs.repartition(partitions) if partitions else docs


def reviews_unrated(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Every document as a review without a rating, for work that needs none: no join."""
    none = F.lit(None).cast("int")
    return _as_reviews(documents(spark, sf_dir, partitions).withColumns({"quality": none, "toxic": none}))


def reviews_all(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Every document as a review; documents without a label have no rating."""
    labels = table(spark, sf_dir, "labels")
    return _as_reviews(documents(spark, sf_dir, partitions).join(labels, "doc_id", "left"))


def reviews_labelled(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Documents with a label as rated reviews."""
    labels = table(spark, sf_dir, "labels")
    return _as_reviews(documents(spark, sf_dir, partitions).join(labels, "doc_id"))


def ratings_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as star ratings of products over time."""
    return as_ratings(table(spark, sf_dir, "events"))


def as_ratings(events: DataFrame) -> DataFrame:
    """Batch or streaming events as (rating_id, asin, timestamp, rating)."""
    return events.select(
        F.col("event_id").alias("rating_id"),
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("asin"),
        F.col("ts").alias("timestamp"),
        F.expr("least(5.0D, 1.0D + floor(value / 10.0D) / 2.0D)").alias("rating"),
    )


def messages(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Every document as a message record, in the scraper's field names."""
    labels = table(spark, sf_dir, "labels")
    rated = documents(spark, sf_dir, partitions).join(labels, "doc_id", "left")
    whole_price = F.concat(F.col("n_chars").cast("string"), F.lit("."))
    return _as_reviews(rated, parse_price(whole_price).alias("price")).select(
        "asin",
        F.concat(F.lit("Product "), F.col("asin")).alias("name"),
        "price",
        F.date_format("review_date", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("overall").cast("string").alias("rating"),
        F.col("reviewText").alias("review_content"),
    )


def loose_messages(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Decoded messages with the faults of real ones: ids that are too long, days that do not
    exist, missing ratings, prices as page text, no category."""
    labels = table(spark, sf_dir, "labels")
    rated = documents(spark, sf_dir, partitions).join(labels, "doc_id", "left")
    day = F.lpad((F.col("doc_id") % 60 + 1).cast("string"), 2, "0")
    return rated.select(
        F.col("doc_id").alias("review_id"),
        F.concat_ws("-", "source", "lang", "doc_id").alias("asin"),
        F.concat(F.lit("Product "), F.col("source")).alias("name"),
        F.lit(None).cast("string").alias("category"),
        F.concat(F.col("n_chars").cast("string"), F.lit(".")).alias("price"),
        F.concat(F.lit("2022-11-"), day, F.lit(" 00:00:00")).alias("timestamp"),
        F.when(F.col("quality") == 1, "5")
        .when(F.col("toxic") == 1, "one")
        .otherwise(F.col("quality").cast("string"))
        .alias("rating"),
        F.col("text").alias("review_text"),
    )


def mixed_messages(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Every document as a decoded message; most are valid, and each rule is broken by some."""

    def every(n: int, wrong: Column, right: Column) -> Column:
        return F.when(F.col("doc_id") % n == n // 2, wrong).otherwise(right)

    nothing, source = F.lit(None).cast("string"), F.col("source")
    long_id = F.concat_ws("-", "source", "lang", "doc_id", F.lit("long"))
    day = F.concat(F.lit("2022-11-"), F.lpad((F.col("doc_id") % 30 + 1).cast("string"), 2, "0"))
    stars = (F.col("doc_id") % 5 + 1).cast("string")
    price = F.concat(F.col("n_chars").cast("string"), F.lit("."))
    return documents(spark, sf_dir, partitions).select(
        F.col("doc_id").alias("review_id"),
        every(11, F.lit(" "), every(13, long_id, source)).alias("asin"),
        every(17, nothing, F.concat(F.lit("Product "), source)).alias("name"),
        every(19, F.lit("c" * (MAX_CATEGORY_CHARS + 1)), nothing).alias("category"),
        every(23, F.lit("-5"), every(29, F.lit("free"), price)).alias("price"),
        every(31, F.lit("2022-11-31"), day).alias("timestamp"),
        every(37, F.lit("11"), every(41, F.lit("one"), stars)).alias("rating"),
        every(43, nothing, F.col("text")).alias("review_text"),
        every(47, F.lit("{"), nothing).alias(CORRUPT),
    )


def faulty_messages(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """``mixed_messages`` as records on the wire, in the scraper's field names."""
    mixed = mixed_messages(spark, sf_dir, partitions)
    return mixed.drop("review_id", CORRUPT).withColumnRenamed("review_text", "review_content")


def shop_pages(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Per document the page of a search that finds its product, and the product's page."""

    def link(cls: str, path: str) -> list[Column]:
        return [F.lit(f'<a class="{cls}" href="{path}'), F.col("doc_id").cast("string"), F.lit('?a=1&amp;b=2">x</a>')]

    plain = link("nav", "/help/")
    return documents(spark, sf_dir, partitions).select(
        F.col("doc_id").alias("page_id"),
        F.col("source").alias("asin"),
        F.concat(*plain, *link(PRODUCT_LINK_CLASS, "/dp/"), *link(PRODUCT_LINK_CLASS, "/next/")).alias("search_html"),
        F.concat(*plain, *link(REVIEW_LINK_CLASS, "/reviews/")).alias("product_html"),
    )


def review_pages(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """One stored review page per document, in the layout of a shop's review list.

    A page shows a price, two highlighted dates and three reviews: the whole text, a day later
    its first line, and a day later one without text. Reviews of documents without a label have no
    rating, and some pages show no dates in their reviews.
    """
    reviews = reviews_all(spark, sf_dir, partitions)

    def dated(days: int) -> Column:
        day = F.date_format(F.date_add("review_date", days), REVIEW_DATE_FORMAT)
        return F.concat(
            F.lit(f'<span class="{REVIEW_DATE_CLASS}">Reviewed in Canada on '), day, F.lit("</span>")
        )

    def review(text: str, days: int) -> list[Column]:
        return [
            F.lit(f'<div class="a-section {REVIEW_BLOCK_CLASS}">'),
            F.coalesce(F.concat(F.lit(f'<a class="{RATING_LINK_CLASS}" href="/r" title="'), F.col("overall").cast("string"),
                                F.lit(' out of 5 stars"><i>stars</i></a>')), F.lit("")),
            F.when(F.col("review_id") % 11 == 5, "").otherwise(dated(days)),
            F.lit(f'<span class="{REVIEW_TEXT_CLASS}">\n<span>'),
            escape_text(F.col(text)),
            F.lit("</span>\n</span></div>"),
        ]

    html = F.concat(
        F.lit(f'<html><body><span class="{PRICE_CLASS}">'),
        F.format_number(F.char_length("reviewText"), 0),
        F.lit(".</span>"),
        dated(-700),
        dated(-800),
        *review("reviewText", 0),
        *review("summary", 1),
        *review("summary", 2)[:3],
        F.lit("</div>"),
        F.lit("</body></html>"),
    )
    return reviews.select(F.col("review_id").alias("page_id"), "asin", html.alias("html"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product names, one per distinct document source."""
    sources = table(spark, sf_dir, "documents").select(F.col("source").alias("asin")).distinct()
    return sources.withColumn("name", F.concat(F.lit("Product "), F.col("asin")))

"""Preparation of reviews: cleaning, class label, train/test split."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewtide.functions.fixed_values import (
    CLEAN_TEXT,
    LENGTH,
    SENTIMENT,
    SENTIMENTS,
    TRAIN_PERCENT,
)
from reviewtide.functions.ratings import sentiment_of
from reviewtide.functions.text import clean_text, key_bucket


def prepare_text(df: DataFrame, text_col: str = "reviewText") -> DataFrame:
    """Drop rows without text; add the cleaned text and its length in characters."""
    return (
        df.filter(F.col(text_col).isNotNull())
        .withColumn(CLEAN_TEXT, clean_text(F.col(text_col)))
        .withColumn(LENGTH, F.char_length(CLEAN_TEXT))
    )


def with_sentiment(df: DataFrame, rating_col: str = "overall") -> DataFrame:
    """Add the class label derived from the rating."""
    return df.withColumn(SENTIMENT, sentiment_of(F.col(rating_col)))


def split_by_key(df: DataFrame, key: str, train_pct: int = TRAIN_PERCENT) -> DataFrame:
    """Add ``is_train`` from a hash of the key.

    Unlike a random split it needs no seed, gives the same answer after a lost executor and
    agrees between runs. Whole tenths of per cent are not needed, so ten buckets do.
    """
    if train_pct % 10:
        return df.withColumn("is_train", key_bucket(F.col(key), 100) < train_pct)
    return df.withColumn("is_train", key_bucket(F.col(key), 10) < train_pct // 10)


def random_split(
    df: DataFrame, train_pct: int = TRAIN_PERCENT, seed: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Spark's random split, for callers who want it."""
    train, test = df.randomSplit([train_pct / 100, 1 - train_pct / 100], seed=seed)
    return train, test


def label_index(df: DataFrame, label: str = SENTIMENT) -> DataFrame:
    """Classes with their row counts, numbered by falling count, then by name."""
    counts = sentiment_counts(df, label)
    # One small array: there are as many rows as classes.
    ordered = counts.filter(F.col(label).isNotNull()).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("minus_n"), label))).alias("all")
    )
    return ordered.select(F.posexplode("all").alias("label_index", "entry")).select(
        F.col(f"entry.{label}").alias(label),
        F.col("label_index").cast("double").alias("label_index"),
        (-F.col("entry.minus_n")).alias("n"),
    )


def sentiment_counts(df: DataFrame, label: str = SENTIMENT) -> DataFrame:
    """Rows per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def has_class(label: str = SENTIMENT) -> Column:
    """True for rows that can be used for training."""
    return F.col(label).isin(*SENTIMENTS)


def recent(
    df: DataFrame, ts_col: str, as_of: datetime.datetime | datetime.date | str, days: int
) -> DataFrame:
    """Rows newer than ``days`` days before ``as_of``."""
    moment = F.lit(as_of).cast("timestamp")
    since = moment - F.make_dt_interval(days=F.lit(days))
    return df.filter(F.col(ts_col).cast("timestamp") > since)

"""Rating and sentiment trends per product and period.

Each trend groups by (product, period) with mergeable sums, so a product with a third of all
rows is reduced before the shuffle. Change and smoothing then run over the trend itself, which
has one row per product and period. Rows without a class are left out of the counts rather than
filtered, because a filter on a predicted class would evaluate the model twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewtide.functions.fixed_values import SENTIMENTS
from reviewtide.functions.ratings import sentiment_of


def _period(ts: str, period: str) -> Column:
    return F.window(F.col(ts), period)


def rating_trend(df: DataFrame, period: str = "7 days", ts: str = "timestamp") -> DataFrame:
    """(asin, period_start, n_reviews, avg_rating)."""
    return (
        df.groupBy("asin", _period(ts, period).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_reviews"), F.avg("rating").alias("avg_rating"))
        .select("asin", F.col("w.start").alias("period_start"), "n_reviews", "avg_rating")
    )


def sentiment_trend(
    df: DataFrame, period: str = "7 days", ts: str = "timestamp", sentiment: str = "sentiment"
) -> DataFrame:
    """(asin, period_start, n_reviews, n_<class>, share_<class>)."""
    counts = [F.count_if(F.col(sentiment) == s).alias(f"n_{s.lower()}") for s in SENTIMENTS]
    shares = [
        (F.col(f"n_{s.lower()}") / F.col("n_reviews")).alias(f"share_{s.lower()}")
        for s in SENTIMENTS
    ]
    return (
        df.groupBy("asin", _period(ts, period).alias("w"))
        .agg(F.count(sentiment).alias("n_reviews"), *counts)
        .filter(F.col("n_reviews") > 0)
        .select(
            "asin",
            F.col("w.start").alias("period_start"),
            "n_reviews",
            *[f"n_{s.lower()}" for s in SENTIMENTS],
            *shares,
        )
    )


def _period_number(trend: DataFrame, period: str) -> Column:
    """Number of a row's period, so that neighbouring periods differ by one whatever the time zone."""
    if isinstance(trend.schema["period_start"].dataType, T.TimestampNTZType):
        since = "period_start - TIMESTAMP_NTZ '1970-01-01 00:00:00'"
        seconds = F.expr(f"CAST(CAST({since} AS INTERVAL SECOND) AS DECIMAL(20, 6))")
    else:
        seconds = F.unix_micros("period_start").cast("decimal(20, 0)") / 1_000_000
    length = F.expr(f"CAST(CAST(INTERVAL {period} AS INTERVAL SECOND) AS DECIMAL(20, 6))")
    return F.floor(seconds / length).cast("bigint")


def rating_change(trend: DataFrame, period: str = "7 days") -> DataFrame:
    """Add the previous period's rating and the change against it.

    ``period`` is the trend's own. Where the product has no reviews in the period before, both are null.
    """
    order = Window.partitionBy("asin").orderBy("_period")
    numbered = trend.withColumn("_period", _period_number(trend, period))
    next_to = F.lag("_period").over(order) == F.col("_period") - 1
    before = F.when(next_to, F.lag("avg_rating").over(order))
    changed = numbered.withColumn("previous_rating", before).drop("_period")
    return changed.withColumn("rating_change", F.col("avg_rating") - F.col("previous_rating"))


def rating_smoothed(trend: DataFrame, k: int = 3, period: str = "7 days") -> DataFrame:
    """Add the mean rating of the last ``k`` periods, which are those of the calendar.

    ``period`` is the trend's own. Periods without reviews have no rating and do not count.
    """
    last = Window.partitionBy("asin").orderBy("_period").rangeBetween(-(k - 1), 0)
    numbered = trend.withColumn("_period", _period_number(trend, period))
    return numbered.withColumn("smoothed_rating", F.avg("avg_rating").over(last)).drop("_period")


def every_period(trend: DataFrame, period: str = "7 days") -> DataFrame:
    """``trend`` with a row for every period from a product's first to its last; those without
    reviews count 0 and have no rating, as a plotted line needs them."""
    numbered = trend.withColumn("_period", _period_number(trend, period))
    ends = numbered.groupBy("asin").agg(
        F.min("_period").alias("from"), F.max("_period").alias("to"), F.min("period_start").alias("_first")
    )
    spine = ends.select("asin", "_first", "from", F.explode(F.sequence("from", "to")).alias("_period"))
    steps = F.col("_period") - F.col("from")
    if isinstance(trend.schema["period_start"].dataType, T.TimestampNTZType):
        start = F.col("_first") + F.expr(f"INTERVAL {period}") * steps
    else:
        # Periods have one length in seconds, which days of a time zone do not.
        length = F.expr(f"CAST(CAST(INTERVAL {period} AS INTERVAL SECOND) AS DECIMAL(20, 6))") * 1_000_000
        start = F.timestamp_micros(F.unix_micros("_first") + (length * steps).cast("bigint"))
    spine = spine.select("asin", "_period", start.alias("period_start"))
    filled = spine.join(numbered.drop("period_start"), ["asin", "_period"], "left").drop("_period")
    return filled.fillna(0, ["n_reviews"]).select(*trend.columns)


def sentiment_agreement(
    df: DataFrame, rating: str = "rating", sentiment: str = "sentiment"
) -> DataFrame:
    """(asin, n_reviews, n_agree, agreement): predicted class against the star rating."""
    derived = sentiment_of(F.col(rating))
    agrees = derived == F.col(sentiment)
    return (
        df.groupBy("asin")
        .agg(F.count(agrees).alias("n_reviews"), F.count_if(agrees).alias("n_agree"))
        .filter(F.col("n_reviews") > 0)
        .withColumn("agreement", F.col("n_agree") / F.col("n_reviews"))
    )

"""Incremental trend table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewtide.operators.trends import rating_trend
from reviewtide.sources.batches import batch_folder, fold, read_batches, settled
from reviewtide.streaming.runs import start_run

#: Batches between two folds of a trend's changes.
FOLD_EVERY = 20
_KEYS = "asin string, period_start timestamp, n_reviews bigint, "
RATING_TREND = _KEYS + "avg_rating double"
SENTIMENT_TREND = (
    _KEYS + "n_positive bigint, n_neutral bigint, n_negative bigint, "
    "share_positive double, share_neutral double, share_negative double"
)


def stream_trend(
    df: DataFrame,
    period: str = "7 days",
    delay: str = "7 days",
    ts: str = "timestamp",
    trend: Callable[[DataFrame, str, str], DataFrame] = rating_trend,
) -> DataFrame:
    """Rating (or sentiment) trend of a stream; rows more than ``delay`` late are ignored.

    Run it in ``append`` mode to get each period once when it is complete, or in ``update``
    mode to get every change of a period.
    """
    return trend(df.withWatermark(ts, delay), period, ts)


def write_trend(trend: DataFrame, path: str, checkpoint: str, fold_every: int | None = FOLD_EVERY) -> StreamingQuery:
    """Write every change of the trend to ``path``, one folder per run and batch, then stop.

    After ``fold_every`` batches their changes are folded into a table of the newest state of each
    period (None: never), so a period that no longer changes is read about once, and the number of files
    does not grow with that of the batches. Streams into one folder must then follow each other.
    """
    spark = trend.sparkSession
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in trend.schema.fields)

    def write(batch: DataFrame, run: str, batch_id: int) -> None:
        if settled(spark, path, run, batch_id):
            return
        dated = batch.withColumn("written_at", F.current_timestamp())
        dated.write.mode("overwrite").parquet(batch_folder(path, run, batch_id))
        if fold_every and (batch_id + 1) % fold_every == 0:
            fold_trend(spark, path, schema)

    writer = trend.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return start_run(writer.trigger(availableNow=True), write)


def _newest(changes: DataFrame) -> DataFrame:
    """The change of each (asin, period) that was written last."""
    keys = ("asin", "period_start")
    order = (F.col("written_at"), F.col("batch_id").cast("bigint").alias("at"))
    values = [c for c in changes.columns if c not in (*keys, "written_at")]
    newest = changes.groupBy(*keys).agg(F.max(F.struct(*order, *values)).alias("newest"))
    return newest.select(*keys, "newest.written_at", *[F.col(f"newest.{c}") for c in values])


def fold_trend(spark: SparkSession, path: str, schema: str = RATING_TREND) -> None:
    """Fold the batches since the last call into a table with one row per changed period."""
    fold(spark, path, f"{schema}, written_at timestamp", lambda rows, to: rows.write.parquet(to), _newest)


def read_trend(spark: SparkSession, path: str, schema: str = RATING_TREND) -> DataFrame:
    """The newest state of every (asin, period): that written last, by whichever run."""
    changes = read_batches(spark, path, f"{schema}, written_at timestamp")
    return _newest(changes).drop("written_at", "run", "batch_id")

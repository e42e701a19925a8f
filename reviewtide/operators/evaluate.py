"""Quality of predictions, from confusion counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(
    df: DataFrame,
    label: str = "sentiment",
    prediction: str = "predicted_sentiment",
    by: tuple[str, ...] = (),
) -> DataFrame:
    """(*by, label, prediction, n): one row per combination that occurs, labelled rows only.

    The prediction is not filtered here: the filter would move below the aggregation and
    evaluate the model a second time for every row.
    """
    return (
        df.filter(F.col(label).isNotNull())
        .groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def class_metrics(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, class, support, hits, precision, recall, f1) from confusion counts.

    Rows without a prediction do not count.
    """
    made = F.when(F.col("prediction").isNotNull(), F.col("n")).otherwise(0)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            made.alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            hit.alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("bigint").alias("support"),
            made.alias("predicted"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    sums = (
        counts.select(*by, F.inline(sides))
        .filter(F.col("class").isNotNull())
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    scored = sums.withColumn("precision", _ratio(F.col("hits"), F.col("predicted"))).withColumn(
        "recall", _ratio(F.col("hits"), F.col("support"))
    )
    both = F.col("precision") + F.col("recall")
    return scored.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), both)).select(
        *by, "class", "support", "hits", "precision", "recall", "f1"
    )


def metrics(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, n, accuracy, weighted_precision, weighted_recall, weighted_f1)."""
    rows = F.sum("support")

    def weighted(column: str) -> Column:
        return (F.sum(F.col("support") * F.col(column)) / rows).alias(f"weighted_{column}")

    return (
        class_metrics(counts, by)
        .groupBy(*by)
        .agg(
            rows.alias("n"),
            (F.sum("hits") / rows).alias("accuracy"),
            weighted("precision"),
            weighted("recall"),
            weighted("f1"),
        )
    )


def rmse(counts: DataFrame, labels: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, n, rmse) of the class index (position in ``labels``), from confusion counts."""
    names = F.array(*[F.lit(s) for s in labels])
    gap = F.array_position(names, F.col("prediction")) - F.array_position(names, F.col("label"))
    made = F.when(F.col("prediction").isNotNull(), F.col("n"))
    return counts.groupBy(*by).agg(
        F.sum(made).alias("n"),
        F.sqrt(F.sum((gap * gap * made).cast("double")) / F.sum(made)).alias("rmse"),
    )

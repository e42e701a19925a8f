"""Joins that complete a record: its prediction and its product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.plans.joins import lookup_join


def attach_predictions(
    msgs: DataFrame, preds: DataFrame, prediction: str = "sentiment"
) -> DataFrame:
    """Left join of predictions to messages by ``msg_id``.

    Equal ids mean equal content and so equal predictions: one prediction per id is enough and
    keeps redelivered copies from multiplying. A message whose text was missing has no
    prediction and keeps a null. Copies of one message may be a large part of the input; the
    lookup join keeps such a message out of the shuffle. ``score_messages`` gives the same
    result without a join where the text is at hand.
    """
    single = preds.groupBy("msg_id").agg(F.max(prediction).alias(prediction))
    return lookup_join(msgs, single, "msg_id", "left", size_of=preds)


def attach_products(df: DataFrame, products: DataFrame) -> DataFrame:
    """Add the product's name, null for a product that is not in the table.

    The product table is broadcast only while it is small.
    """
    named = products.groupBy("asin").agg(F.max("name").alias("name"))
    return lookup_join(df, named, "asin", "left", size_of=products)

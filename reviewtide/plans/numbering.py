"""Dense numbers for rows, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewtide.plans.storage import materialise

_ROW_BITS = 33  # of monotonically_increasing_id; the partition's number is above them


def number_rows(rows: DataFrame, *order: str | Column, name: str = "row_id", first: int = 0) -> DataFrame:
    """``rows`` with their place in the given order, ``first``, ``first`` + 1, ... without gaps.

    Ranges of the order are sorted apart and written once; a range's numbers start after the
    sizes of those before it, one row per range. Rows equal in the order are numbered in any
    order, but keep their number as long as the result is used. Give an order that tells
    rows apart where one value may be frequent, since equal rows are in one range.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialise(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", _ROW_BITS)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    skips = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_skip"))
    within = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = ranged.withColumn("_part", part).join(F.broadcast(skips), "_part")
    return numbered.withColumn(name, F.col("_skip") + within + first).drop("_part", "_skip", "_at")

"""Size-checked lookup join that also stands hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 256 * 1024 * 1024
HOT_KEYS = 1000
TRACKED_KEYS = 10_000
SKETCH_GROUPS = 64
_ROW_OVERHEAD = 64


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of ``df``, from its row count and the real length of its strings."""
    width = F.lit(_ROW_OVERHEAD + 16 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif not isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            width = width + F.octet_length(F.to_json(F.struct(field.name)))
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """The most frequent values of ``key``, at most ``HOT_KEYS`` rows.

    Mergeable sketches find them in one pass without a shuffle of the rows, merged in groups of
    tasks first. A key with a noticeable share of the rows is not missed, and callers get right
    results with any set of keys.
    """
    sketch = F.expr(f"approx_top_k_accumulate({key}, {TRACKED_KEYS})").alias("sketch")
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("part")
    keyed = rows.filter(F.col(key).isNotNull())
    parts = keyed.select(key, group).groupBy("part").agg(sketch)
    whole = parts.agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED_KEYS})").alias("sketch"))
    estimate = F.expr(f"approx_top_k_estimate(sketch, {HOT_KEYS})")
    items = [] if keyed.isEmpty() else whole.select(estimate).first()[0]
    schema = T.StructType([T.StructField(key, rows.schema[key].dataType)])
    return rows.sparkSession.createDataFrame([(i["item"],) for i in items], schema)


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "left",
    limit: int = BROADCAST_LIMIT,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """Join many ``rows`` to a ``lookup`` table that has one row per key.

    The lookup is broadcast when its measured size is below ``limit``; the rows are then not
    shuffled at all, and a hot key costs nothing. Above the limit only the rows of hot keys and
    those without a key meet their few lookup rows by broadcast; all others are shuffled, and
    no shuffled key is frequent enough to overload a task. ``rows`` are read twice more in that
    case, so pass a table rather than a long computation.

    ``size_of`` is a frame that is never smaller than the lookup and cheaper to measure.
    """
    if measured_bytes(lookup if size_of is None else size_of) <= limit:
        return rows.join(F.broadcast(lookup), on, how)
    hot = hot_keys(rows, on)
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), on, "left")
    apart = F.col("_hot").isNotNull() | F.col(on).isNull()
    hot_lookup = lookup.join(F.broadcast(hot), on, "left_semi")
    few = marked.filter(apart).drop("_hot").join(F.broadcast(hot_lookup), on, how)
    rest = marked.filter(~apart).drop("_hot").join(lookup.hint("merge"), on, how)
    return few.unionByName(rest)

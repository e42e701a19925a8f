"""The results table: idempotent append, read back, preview."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.plans.joins import BROADCAST_LIMIT, measured_bytes
from reviewtide.plans.storage import materialise, path_exists, scratch
from reviewtide.schemas import STORED_REVIEW
from reviewtide.sources.batches import BATCH, batch_folder, fold, read_batches, settled

#: A batch with more review dates than these is compared with the ids of all dates.
PRUNED_DATES = 1000
_FIELDS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STORED_REVIEW.fields)


def unseen(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows of ``batch`` whose ``msg_id`` is not in ``stored``, one of each id; rows without an id stay.

    ``batch`` should be a materialised table, ``stored`` a scan of (msg_id). What is new is decided
    on ids alone. The ids of a batch of bounded size go to the stored ids, which are then not
    shuffled whatever their number; then the ids that are stored, or those that are not if they
    are fewer, go back to the batch. Larger sets of ids meet in a shuffle. Only rows whose id the batch
    has more than once are shuffled to keep one of each.
    """
    ids = batch.filter("msg_id IS NOT NULL").groupBy("msg_id").agg(F.count(F.lit(1)).alias("_copies"))
    ids = materialise(ids, "ids")
    found = materialise(stored.join(_small(ids.select("msg_id")), "msg_id", "left_semi").distinct(), "found")
    fresh = materialise(ids.join(_small(found), "msg_id", "left_anti"), "fresh")
    if measured_bytes(found) <= measured_bytes(fresh.select("msg_id")):
        named = batch.filter("msg_id IS NOT NULL").join(_small(found), "msg_id", "left_anti")
    else:
        named = batch.join(_small(fresh.select("msg_id")), "msg_id", "left_semi")
    nameless = batch.filter("msg_id IS NULL")
    several = fresh.filter("_copies > 1").select("msg_id")
    if several.isEmpty():
        return named.select(*batch.columns).unionByName(nameless)
    copies = named.join(_small(several), "msg_id", "left_semi").dropDuplicates(["msg_id"])
    single = named.join(_small(several), "msg_id", "left_anti")
    return single.select(*batch.columns).unionByName(copies.select(*batch.columns)).unionByName(nameless)


def _small(ids: DataFrame) -> DataFrame:
    """``ids``, to be broadcast in joins if their size allows it."""
    return F.broadcast(ids) if measured_bytes(ids) <= BROADCAST_LIMIT else ids


def other_batches(stored: DataFrame, run: int | str, batch_id: int | str) -> DataFrame:
    """The rows of a table of batches without those of one, which is what a replay compares with."""
    own = (F.col("run") == str(run)) & (F.col("batch_id") == str(batch_id))
    return stored.filter(~own)


def not_yet_stored(batch: DataFrame, path: str, run: int | str, batch_id: int | str) -> DataFrame:
    """The rows of a materialised batch that no other batch has stored in the results table.

    Only the ids of the batch's own review dates are read, since a message's date is part of
    what its id is made of. A replayed batch does not see its own rows, so it writes them again.
    """
    spark = batch.sparkSession
    if not path_exists(spark, path):
        return unseen(batch, spark.createDataFrame([], "msg_id string"))
    stored = read_batches(spark, path, "msg_id string, review_date date")
    dates = [r[0] for r in batch.select("review_date").distinct().limit(PRUNED_DATES + 1).collect()]
    if len(dates) <= PRUNED_DATES:
        wanted = F.col("review_date").isin([d for d in dates if d is not None])
        stored = stored.filter(wanted | F.col("review_date").isNull() if None in dates else wanted)
    return unseen(batch, other_batches(stored, run, batch_id).select("msg_id"))


def append_once(df: DataFrame, path: str, run: int | str, batch_id: int | str = 0) -> None:
    """``append_scored`` for the messages of a batch that are not stored yet, one row of each ``msg_id``.

    So a message that two checkpoints or loads deliver is in the table once. Loads into one table
    must follow each other: two at the same time do not see each other's rows.
    """
    with scratch(df.sparkSession, "batch") as keep:
        append_scored(not_yet_stored(keep(df), path, run, batch_id), path, run, batch_id)


def append_scored(df: DataFrame, path: str, run: int | str, batch_id: int | str = 0) -> None:
    """Append one batch of scored reviews, partitioned by review date.

    ``run`` names who appends: a stream's query id, or any name that a batch job gives one load.
    Each batch of a run owns a folder and overwrites it, so replaying a batch after a failure
    adds no rows, and no other run is touched. The rebalance step gathers a date's rows into few files, and
    adaptive execution splits a hot date over several writers by its size. A batch that
    ``compact_scored`` has folded is stored for good: repeating it changes nothing.
    """
    if settled(df.sparkSession, path, run, batch_id):
        return
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in STORED_REVIEW.fields]
    _write_dated(df.select(*columns), batch_folder(path, run, batch_id))


def _write_dated(rows: DataFrame, folder: str) -> None:
    rows.hint("rebalance", "review_date").write.mode("overwrite").option("compression", "zstd").partitionBy("review_date").parquet(folder)


def compact_scored(spark: SparkSession, path: str) -> None:
    """Rewrite the batches since the last call into a table with few files per date.

    Readers see the same rows before, meanwhile and after; see ``batches.fold`` for what is deleted when.
    Call it between loads or batches, as often as the folders become many.
    """
    fold(spark, path, _FIELDS, _write_dated)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """The whole results table; filters on ``review_date`` prune its folders."""
    return read_batches(spark, path, _FIELDS).select(*[f.name for f in STORED_REVIEW.fields])


def not_yet_rejected(rejected: DataFrame, path: str, run: int | str, batch_id: int | str) -> DataFrame:
    """The rows, read from a materialised table, that no other batch has written to the rejects."""
    spark = rejected.sparkSession
    if not path_exists(spark, path):
        return rejected
    seen = spark.read.schema(f"msg_id string, {BATCH}").json(path)
    return unseen(rejected, other_batches(seen, run, batch_id).select("msg_id"))


def append_rejects(rejected: DataFrame, path: str, run: int | str, batch_id: int | str = 0, once: bool = True) -> None:
    """Append one batch of rejected rows as compressed JSON lines, in a folder of its own like ``append_scored``.

    With ``once`` a message that another batch has rejected is left out; ``rejected`` should then
    be a materialised table.
    """
    if once:
        rejected = not_yet_rejected(rejected, path, run, batch_id)
    rejected.write.mode("overwrite").option("compression", "gzip").json(batch_folder(path, run, batch_id))


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows, for a look at the data."""
    return df.limit(n)

"""Mixing sources to target weights by entropy balancing. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewtide.llm.common import table
from reviewtide.plans.storage import materialise

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
TOLERANCE = 1e-9
MAX_ROUNDS = 60
#: Rounds after those, which only halve the bracket; a double has no more to halve.
MAX_HALVINGS = 120
OFFSETS = 32  # starting points of the rounding that are tried per source
DIGIT = 6  # bits of a size handled by one level of running sums

_WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORDS)), F.lit(0)).cast("long")


def _source_key(source: str) -> Column:
    """Sources by code point, null last, as a key that is never null."""
    return F.when(F.col(source).isNull(), F.lit("1")).otherwise(
        F.concat(F.lit("0"), F.col(source).cast("string"))
    )


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with their place in key order, from 0, without one task for all.

    Ranges of keys are ordered apart; only one row per range meets in the running sum.
    """
    ranged = materialise(
        sources.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "ranges"
    )
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1
    return ranged.withColumn("place", within).join(offsets, "part").withColumn(
        "place", F.col("place") + F.col("skip")
    ).drop("part", "skip")


def source_targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``sources`` (key, words) with their ``target``.

    Weights repeat in key order. A target is weight x level, or ``most`` x words if that is
    less; the level rises until the targets hold ``share`` of all words. Each round is one
    aggregation that brings three numbers to the driver.
    """
    factor = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = materialise(_ranked(sources).withColumn("weight", factor), "weights")
    total = weighed.agg(F.sum("words")).first()[0] or 0
    full, level = F.lit(most) * F.col("words"), 0.0
    while total:
        capped = full <= F.col("weight") * F.lit(level)
        held, free = weighed.agg(
            F.sum(F.when(capped, full).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))
        ).first()
        raised = (share * total - held) / free if free else level
        if not free or raised <= level:
            break
        level = raised
    return weighed.withColumn("target", F.least(full, F.col("weight") * F.lit(level)))


def _balanced(cells: DataFrame, targets: DataFrame, most: float) -> DataFrame:
    """(key, dual) such that the tilted rates of each source give its target.

    Entropy balancing with the rates held below ``most``: among all rates with
    sum(rate x size) = target the one nearest to 1 in Kullback-Leibler distance is
    rate = min(most, exp(dual x size / mean size)), where dual solves a convex problem in one variable per
    source. Newton steps on the dual, kept inside a bracket that each round narrows; a round is
    one aggregation over (source, size) cells, and only the largest gap comes to the driver. Should Newton
    not meet the targets in ``MAX_ROUNDS``, the bracket is halved until they are met; else it is an error.
    """
    mean = F.greatest(F.col("words") / F.greatest(F.col("docs"), F.lit(1)), F.lit(1.0))
    state = targets.select(
        "key", "target", "words", mean.alias("mean"),
        F.lit(0.0).alias("dual"),
        F.when(F.col("target") < F.col("words"), -1e9).otherwise(0.0).cast("double").alias("low"),
        F.when(F.col("target") < F.col("words"), 0.0).otherwise(1e9).cast("double").alias("high"),
        (F.col("target") >= most * F.col("words")).alias("full"),
        F.lit(1.0).alias("gap"),
    )
    state = materialise(state, "dual")
    open_cells = cells.filter("size > 0")
    for step_no in range(MAX_ROUNDS + MAX_HALVINGS):
        x = F.col("size") / F.col("mean")
        rate = F.least(F.lit(most), F.exp(F.col("dual") * x))
        mass = F.col("n") * F.col("size") * rate
        joined = open_cells.join(state.filter("NOT full"), "key").groupBy("key")
        slope = F.when(rate < most, mass * x).otherwise(0.0)
        sums = joined.agg(F.sum(mass).alias("got"), F.sum(slope).alias("slope"))
        error = F.col("got") - F.col("target")
        low = F.when(error < 0, F.col("dual")).otherwise(F.col("low"))
        high = F.when(error >= 0, F.col("dual")).otherwise(F.col("high"))
        step = F.col("dual") - error / F.col("slope")
        middle = F.when(F.col("high") >= 1e9, 2 * F.col("low") + 1).when(
            F.col("low") <= -1e9, 2 * F.col("high") - 1
        ).otherwise((F.col("low") + F.col("high")) / 2)
        inside = F.lit(step_no < MAX_ROUNDS) & (F.col("slope") > 0) & (step > F.col("low")) & (step < F.col("high"))
        gap = F.abs(error) / F.greatest(F.col("target"), F.lit(1.0))
        moved = state.join(sums, "key", "left").withColumns({"low": low, "high": high})
        moved = moved.withColumn("gap", F.when(F.col("got").isNull(), 0.0).otherwise(gap))
        dual = F.when(F.col("gap") <= TOLERANCE, F.col("dual")).when(inside, step).otherwise(middle)
        state = materialise(moved.withColumn("dual", dual).drop("got", "slope"), "dual")
        if (state.agg(F.max("gap")).first()[0] or 0.0) <= TOLERANCE:
            break
    else:
        raise RuntimeError("the duals of the mix do not meet their targets")
    return state.select("key", "mean", "dual", "full")


def _running(cells: DataFrame) -> DataFrame:
    """Per cell the summed rates of its source's cells of smaller size, ``before``.

    Sizes are summed digit by digit, so that no task orders all sizes of a source: a window
    holds at most 2^DIGIT rows, up to the last level, which has one row per 2^(3 DIGIT) sizes.
    """
    levels = [F.shiftright("size", DIGIT * i) for i in range(4)]
    cells = cells.withColumns({f"l{i}": levels[i] for i in range(1, 4)})
    mass = F.col("n") * F.col("rate")
    below = [cells.withColumn("m", mass).withColumn("l0", F.col("size"))]
    for i in range(1, 4):
        below.append(below[-1].groupBy("key", *[f"l{j}" for j in range(i, 4)]).agg(F.sum("m").alias("m")))
    out = cells.withColumn("l0", F.col("size")).withColumn("before", F.lit(0.0))
    for i, frame in enumerate(below):
        group = ["key"] + ([f"l{i + 1}"] if i < 3 else [])
        window = Window.partitionBy(*group).orderBy(f"l{i}").rowsBetween(Window.unboundedPreceding, -1)
        part = frame.select("key", f"l{i}", F.coalesce(F.sum("m").over(window), F.lit(0.0)).alias("part"))
        out = out.join(part, ["key", f"l{i}"]).withColumn("before", F.col("before") + F.col("part")).drop("part")
    return out.drop("l0", "l1", "l2", "l3")


def _reached(position: Column, offset: Column) -> Column:
    """Copies up to a position in the summed rates; a billionth keeps exact sums on one side."""
    return F.floor(position + offset + 1e-9)


def _offsets(placed: DataFrame) -> DataFrame:
    """(key, offset): of ``OFFSETS`` starting points that whose taken words come nearest the target.

    The words that a starting point takes follow from the cells alone.
    """
    tries = F.explode(F.array(*[F.lit((i + 0.5) / OFFSETS) for i in range(OFFSETS)])).alias("offset")
    cells = placed.select("key", "size", "n", "rate", "before", "target", tries)
    end = F.col("before") + F.col("n") * F.col("rate")
    copies = _reached(end, F.col("offset")) - _reached(F.col("before"), F.col("offset"))
    sums = cells.groupBy("key", "offset").agg(F.sum(copies * F.col("size")).alias("taken"), F.first("target").alias("target"))
    miss = F.struct(F.abs(F.col("taken") - F.col("target")), "offset")
    return sums.groupBy("key").agg(F.min(miss)["offset"].alias("offset"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    every_row: bool = False,
) -> DataFrame:
    """How often each document is taken: doc_id, source, size, source_size, target, copies, taken.

    Rows with the same doc_id, source and text (repeats) are one document and give one row, but
    with ``every_row`` each row is a document of its own, as rows without a doc_id always are. Null
    or empty texts have size 0; null is a source of its own, the last. A source without words
    has target 0. A source whose target is ``most`` times its size takes every document so often.

    The rates of one source, in order of size and then of a hash, are added up, and a document's
    copies are the whole numbers its step passes. The sums of sizes so differ from the target by
    less than the source's largest document, and each document is taken floor(rate) or
    ceil(rate) times. The sum's starting point is the best of ``OFFSETS``. Places among documents of equal size come from counts per hash bucket, the
    square root of the cell's size in number, so no task orders a whole source or cell.
    """
    mixed = _mixed(_counted(docs, F.xxhash64("text"), every_row), weights, share, most)
    return mixed.drop("digest")


def _counted(docs: DataFrame, digest: Column, every_row: bool) -> DataFrame:
    """(doc_id, source, key, size, digest, repeat), one row per document; ``repeat`` numbers equal ones."""
    sized = docs.select(
        "doc_id", "source", _source_key("source").alias("key"), word_count().alias("size"), digest.alias("digest")
    )
    times = sized.groupBy(*sized.columns).agg(F.count(F.lit(1)).cast("int").alias("times"))
    if not every_row:
        times = times.withColumn("times", F.when(F.col("doc_id").isNull(), F.col("times")).otherwise(1))
    return times.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times")


def _mixed(sized: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """The rows of ``mix_sources`` and ``digest`` for every row of ``sized``."""
    sized = materialise(sized, "sizes")
    cells = materialise(sized.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    sources = cells.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("docs"))
    targets = materialise(source_targets(sources, weights, share, most), "targets")
    duals = _balanced(cells, targets, most)
    tilt = F.least(F.lit(most), F.exp(F.col("dual") * F.col("size") / F.col("mean")))
    rate = F.when(F.col("full"), F.lit(most)).otherwise(tilt)
    rated = materialise(cells.join(duals, "key").withColumn("rate", rate).drop("dual", "mean", "full"), "rates")
    shares = F.ceil(F.sqrt("n")).cast("long").alias("shares")
    placed = _running(rated).join(targets.select("key", "words", "target"), "key")
    placed = materialise(placed.select("key", "size", "n", "rate", "before", "words", "target", shares), "places")
    placed = placed.join(materialise(_offsets(placed), "offsets"), "key").drop("n")

    order = F.xxhash64(F.lit("mix"), "doc_id", "digest", "repeat")
    marked = sized.join(placed, ["key", "size"]).withColumn("order", order)
    marked = materialise(marked.withColumn("share", F.pmod("order", F.col("shares"))), "marked")
    counts = marked.groupBy("key", "size", "share").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("key", "size").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    skips = counts.select("key", "size", "share", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"))
    within = Window.partitionBy("key", "size", "share").orderBy("order", "doc_id", "digest", "repeat")
    rows = marked.withColumn("rank", F.row_number().over(within)).join(skips, ["key", "size", "share"])
    rank = F.col("rank") + F.col("skip")
    start, end = (F.col("before") + i * F.col("rate") for i in (rank - 1, rank))
    copies = _reached(end, F.col("offset")) - _reached(start, F.col("offset"))
    copies = F.least(copies, F.lit(int(most))).cast("int")
    return rows.withColumn("copies", copies).select(
        "doc_id", "source", "size", F.col("words").alias("source_size"), "target", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"), "digest",
    )


def op8_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), every_row=True)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def take_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as many times as the mix takes it, numbered in ``copy_no``.

    Every row is a document. Rows equal in all columns are interchangeable: one of them stands
    for the copies of all. Nulls are equal in the joins.
    """
    digest = F.xxhash64(*docs.columns)
    keys = ["_id", "_source", "_size", "_digest"]
    mixed = _mixed(_counted(docs, digest, every_row=True), WEIGHTS, SHARE, MOST)
    mixed = mixed.select(*[F.col(c).alias(f"_{c}") for c in ("size", "digest", "source", "copies")], F.col("doc_id").alias("_id"))
    mixed = mixed.groupBy(*keys).agg(F.collect_list("_copies").alias("_copies"))
    mixed = materialise(mixed, "copies")

    def same(wanted: DataFrame) -> Column:
        return (
            docs["doc_id"].eqNullSafe(wanted["_id"])
            & docs["source"].eqNullSafe(wanted["_source"])
            & (word_count() == wanted["_size"])
            & (digest == wanted["_digest"])
        )

    alone = mixed.filter("size(_copies) = 1 AND _copies[0] > 0")
    equal = mixed.filter("size(_copies) > 1").select(*keys)
    one_of = docs.join(equal, same(equal)).groupBy(*keys).agg(F.first(F.struct(*[docs[c] for c in docs.columns])).alias("_row"))
    lists = mixed.filter("size(_copies) > 1").select(*[F.col(k).alias(f"{k}_") for k in keys], F.explode("_copies").alias("_n"))
    fits = [one_of[k].eqNullSafe(lists[f"{k}_"]) for k in keys]
    several = one_of.join(lists.filter("_n > 0"), fits).select("_row.*", "_n")
    single = docs.join(alone, same(alone)).select(*[docs[c] for c in docs.columns], F.col("_copies")[0].alias("_n"))
    numbers = F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy_no")
    return single.unionByName(several).select(*docs.columns, numbers)

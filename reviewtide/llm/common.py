"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import functools
import itertools
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.plans.storage import materialise

SPACE = 32
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
_CODE_POINTS = 0x110000


def share_library(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it.

    A cluster whose executors have no such folder gets the library by ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))


def bound_batches(spark: SparkSession) -> None:
    """Send texts to Python workers by size, not by count alone; the session's own limit stays.

    Ten thousand texts at a time can be of any size, and are held by the executor and the worker.
    A batch has at least one row, so longer texts still go whole.
    """
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)


def with_library(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``function`` of a session and more, after the session got to know the library."""

    @functools.wraps(function)
    def run(spark: SparkSession, *rest) -> DataFrame:
        share_library(spark)
        bound_batches(spark)
        return function(spark, *rest)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds


def hash_order(key: str) -> Column:
    """A fixed pseudo-random order of the rows."""
    return F.xxhash64(F.lit("sample"), F.col(key))


def bounded_sample(rows: DataFrame, label: str, per_class: int, key: str = "doc_id") -> DataFrame:
    """About ``per_class`` rows of each class, the first in hash order; at most twice as many.

    The share of each class is fixed by its exact size, so the choice is a filter that needs no
    shuffle and is the same in every run. Column ``class_size`` holds the size. Classes are few
    (labels, languages); their counts pass through the driver.
    """
    sizes = {r[0]: r[1] for r in rows.groupBy(label).count().collect() if r[0] is not None}
    if not sizes:
        return rows.withColumn("class_size", F.lit(0).cast("long")).limit(0)
    pairs = [x for k, n in sizes.items() for x in (F.lit(k), F.lit(n).cast("long"))]
    size = F.element_at(F.create_map(*pairs), F.col(label))
    point = F.pmod(hash_order(key), F.lit(1 << 40)).cast("double") / float(1 << 40)
    chosen = point * size <= F.lit(float(per_class))
    return rows.filter(F.col(label).isNotNull()).withColumn("class_size", size).filter(chosen)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, text, label, class_size) of about ``per_class`` documents of each class, 0 and 1.

    Of repeated label rows the largest counts. The sample of the labels is bounded, so it is
    broadcast and the texts of all other documents stay where they are.
    """
    own = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id")
    own = own.agg(F.max(F.col(label).cast("int")).alias("label"))
    sample = bounded_sample(own, "label", per_class)
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _table(folded: Callable[[str], str]) -> np.ndarray:
    """For each code point what it becomes, itself if that is not one character.

    Filled one by one, since a list of a million characters takes a worker some 200 MB.
    """
    codes = (ord(f) if len(f := folded(chr(i))) == 1 else i for i in range(_CODE_POINTS))
    return np.fromiter(codes, np.uint32, _CODE_POINTS)


@functools.cache
def _letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or a space where it is no letter."""
    return _table(lambda c: c.lower() if c.isalpha() else " ")


def letters(text: str) -> np.ndarray:
    """Lower-cased code points; runs of anything but letters are one space, also at both ends."""
    codes = _letter_table()[code_points(f" {text} ")]
    blank = codes == SPACE
    keep = ~blank
    keep[0] = True
    keep[1:] |= ~blank[:-1]
    return codes[keep]


@functools.cache
def _fold_table() -> np.ndarray:
    """For each code point its lower case, or a space for white space."""
    return _table(lambda c: " " if c.isspace() else c.lower())


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points with runs of white space as one space, and where each came from."""
    codes = _fold_table()[code_points(text)]
    blank = codes == SPACE
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return codes[keep], np.flatnonzero(keep)


def gram_hashes(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hash of every ``n`` consecutive code points, in ``bits`` bits."""
    count = len(codes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint32)
    h = np.full(count, (n * 0x9E3779B1) & 0xFFFFFFFF, np.uint32)
    for i in range(n):
        h = (h ^ codes[i : i + count]) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return (h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits)


BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def power(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next text."""
    known = _powers.get(name)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if n <= 1 << 20:
            _powers[name] = known
    return known[:n]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end) of bytes.

    Each is the difference of two running sums of byte * base^place, brought back to place 0, so
    the cost does not depend on the lengths of the spans.
    """
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power("up", BASE, len(data)), out=total[1:])
    return mix((total[end] - total[start]) * power("down", _INVERSE, len(data) + 1)[start])


def bit_set(rows: DataFrame, slot: Column, bits: int) -> np.ndarray:
    """The set of values of ``slot``, below 2^bits, as 2^bits / 64 words.

    Spark gathers the words; what comes to the driver, and goes out by broadcast, is bounded by
    ``bits`` whatever the number of rows. Used as a filter that may let other rows pass.
    """
    words = rows.select(slot.cast("long").alias("s")).groupBy(F.expr("s DIV 64").alias("at"))
    found = words.agg(F.expr("bit_or(shiftleft(1L, CAST(s % 64 AS INT)))").alias("word")).toArrow()
    out = np.zeros(max(1, (1 << bits) // 64), np.uint64)
    out[found["at"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return out


def in_bit_set(words: np.ndarray, slots: np.ndarray) -> np.ndarray:
    at = slots.astype(np.uint64)
    return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def scan_texts(docs: DataFrame, emit: Callable, fields: str) -> DataFrame:
    """Apply ``emit(doc, bytes) -> columns`` to every whole text of (doc, t); adds column doc.

    ``columns`` hold the rows that a text gives, any number, as arrays or lists in the order of
    ``fields``. Null texts are empty. Texts are read in place from the Arrow batch, one at a time.
    """
    schema = f"doc {docs.schema['doc'].dataType.simpleString()}, {fields}"
    names = [f.split()[0] for f in fields.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("doc").type
            ids, sizes, found = [], [], []
            texts = batch["t"].cast(pa.large_binary())
            for doc, text in zip(batch["doc"].to_pylist(), texts, strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.empty(0, np.uint8)
                columns = emit(doc, data)
                if len(columns[0]):
                    found.append(columns)
                    ids.append(doc)
                    sizes.append(len(columns[0]))
            if found:
                joined = [list(itertools.chain(*c)) if isinstance(c[0], list) else np.concatenate(c) for c in zip(*found, strict=True)]
                owner = pa.array(ids, kind).take(pa.array(np.repeat(np.arange(len(ids)), sizes)))
                arrays = [pa.array(c.view(np.int64) if getattr(c, "dtype", None) == np.uint64 else c) for c in joined]
                yield pa.RecordBatch.from_arrays([owner, *arrays], names=["doc", *names])

    return docs.mapInArrow(scan, schema)


#: Up to so many keys (and some 16 MB) are broadcast whole.
FEW_KEYS = 500_000
ROW_BITS = 24


def rows_of(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is among ``keys``, whose texts are long.

    Few keys are counted and broadcast, so no text is shuffled. Beyond that a filter of fixed size
    keeps most other texts out of the shuffle.
    """
    if keys.count() <= FEW_KEYS:
        return docs.join(F.broadcast(keys), key, "left_semi")
    return docs.filter(maybe_in(keys, key)(F.col(key))).join(keys, key, "left_semi")


def row_slot(key: Column) -> Column:
    """Place of a key in a set of 2^``ROW_BITS`` slots."""
    return F.pmod(F.xxhash64(key), F.lit(1 << ROW_BITS))


def maybe_in(rows: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test whether a key may be among ``rows``; never false for one that is.

    It keeps the texts of other documents out of a shuffle. The set it uses is of fixed size.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bit_set(rows, row_slot(F.col(key)), ROW_BITS))

    @F.pandas_udf("boolean")
    def known(slots: pd.Series) -> pd.Series:
        return pd.Series(in_bit_set(shared.value, slots.to_numpy(np.int64)))

    return lambda column: known(row_slot(column))


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b) as rows (node, component).

    ``component`` is the smallest node reachable. Each round alternates two steps: every node
    links its larger neighbours to its smallest neighbour, then its smaller ones. Both keep the
    components, so the edges become stars in about log(n) rounds; the rounds are aggregations
    by node over (node, neighbour) rows and cut their lineage in the shared folder. Only the
    number of changed rows comes to the driver.
    """
    edges = materialise(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    while True:
        large = _star(edges, larger=True)
        small = materialise(_star(large, larger=False), "edges")
        # Stars are reached when a further step changes nothing: compare as sets by hash sum.
        if _digest(small) == _digest(edges):
            break
        edges = small
    stars = edges.groupBy("a").agg(F.min("b").alias("b"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    leaves = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over edges (a, b) with a > b."""
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    lowest = both.groupBy("a").agg(F.min("b").alias("_low"))
    lowest = lowest.select(F.col("a").alias("_node"), F.least("_low", "a").alias("_low"))
    joined = both.join(lowest, F.col("a") == F.col("_node"))
    if larger:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("_low").alias("b"))
        return moved.filter("a <> b").distinct()
    moved = joined.select(F.col("b").alias("a"), F.col("_low").alias("b"))
    kept = lowest.select(F.col("_node").alias("a"), F.col("_low").alias("b"))
    return moved.unionByName(kept).filter("a <> b").distinct()


def _digest(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())

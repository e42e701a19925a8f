"""Exact removal of repeated substrings by column-wise construction of sorted suffixes.

Every string of ``LENGTH`` bytes (a window) has an anchor: the place of its smallest hashed
``ANCHOR``-byte gram. Neighbouring windows with one anchor form a run, and equal windows always
have equal grams at their anchors, so all equal windows meet under one key. Under a key, the
text of the runs is a collection of strings aligned at the anchor. Their suffixes are sorted column by column from
the right: each round inserts one symbol of each string in front of its suffix and keeps the
order (the collection's Burrows-Wheeler column is the symbols in that order) and the common
prefixes of neighbours, both from those of the round before. Windows whose common prefixes reach
``LENGTH`` are equal; of equal windows all but the earliest are removed.

Runs of equal text are one string with its earliest place, so copies cost no more than a row
each. The strings pass through tasks in bounded collections; the sorted files that Spark's shuffle
writes are read once, front to back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.llm.common import bit_set, in_bit_set, maybe_in, mix, scan_texts, span_hashes, table
from reviewtide.plans.storage import materialise

LENGTH = 100
ANCHOR = 24
KEY_BITS = 26
#: Strings of one collection in a task, and the most of one key that go to one task.
COLLECTION = 16_384
HOT_STRINGS = 4096
_PLACE = 24  # bits of a place within a piece of a text
_PIECE = (1 << _PLACE) - (1 << 10)


def runs(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of a whole text: key, start, end (of the last window) and anchor."""
    empty = np.empty(0, np.int64)
    if len(data) < length:
        return empty.astype(np.uint64), empty, empty, empty
    if len(data) > _PIECE:  # long texts in pieces that share no window
        parts = []
        for at in range(0, len(data) - length + 1, _PIECE - length + 1):
            key, *places = runs(data[at : at + _PIECE], length)
            parts.append((key, *(p + at for p in places)))
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))
    grams = np.arange(len(data) - ANCHOR + 1)
    hashed = span_hashes(data, grams, grams + ANCHOR)
    low = np.uint64((1 << _PLACE) - 1)
    ranked = (hashed & ~low) | grams.astype(np.uint64)  # the leftmost of equal grams
    width, count = length - ANCHOR + 1, len(data) - length + 1
    padded = np.concatenate([ranked, np.full(-len(ranked) % width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & low).astype(np.int64)
    start = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    end = np.append(start[1:], count) + length - 1
    return hashed[anchor[start]], start, end, anchor[start]


def _key_slot(keys: np.ndarray) -> np.ndarray:
    """The low bits: the high ones of the smallest of many hashes are mostly zero."""
    return keys & np.uint64((1 << KEY_BITS) - 1)


def _place_slot(doc: int, start: np.ndarray) -> np.ndarray:
    base = np.uint64(hash(doc) & 0xFFFFFFFFFFFFFFFF)
    return mix(mix(np.full(1, base) + np.uint64(0x9E3779B97F4A7C15)) ^ start.astype(np.uint64)) >> np.uint64(64 - KEY_BITS)


def _repeated_keys(docs: DataFrame) -> np.ndarray:
    """The slots of keys that occur at least twice."""
    keys = scan_texts(docs, lambda doc, data: (runs(data)[0],), "key long").select("key")
    often = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return bit_set(often, F.col("key").bitwiseAND(F.lit((1 << KEY_BITS) - 1)), KEY_BITS)


def _occurrences(docs: DataFrame, repeated: np.ndarray) -> DataFrame:
    """Every run whose key may be repeated: doc, key, digest of its text, start, length, slot."""
    shared = docs.sparkSession.sparkContext.broadcast(repeated)

    def emit(doc, data: np.ndarray) -> tuple:
        key, start, end, _ = runs(data)
        own = in_bit_set(shared.value, _key_slot(key))
        key, start, end = key[own], start[own], end[own]
        digest = span_hashes(data, start, end) if len(key) else key
        return key, digest, start, end - start, _place_slot(doc, start).astype(np.int64)

    return scan_texts(docs, emit, "key long, digest long, start long, length long, slot long")


def _strings(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """The text of the earliest runs (doc, start, key, ...) with the anchor's place in it."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_set(firsts, F.col("slot"), KEY_BITS))

    def emit(doc, data: np.ndarray) -> tuple:
        _, start, end, anchor = runs(data)
        own = in_bit_set(shared.value, _place_slot(doc, start))
        text = [data[s:e].tobytes() for s, e in zip(start[own].tolist(), end[own].tolist(), strict=True)]
        return start[own], anchor[own] - start[own], text

    found = scan_texts(docs, emit, "start long, lead long, text binary")
    return found.join(firsts.select("doc", "start", "key", "n_strings"), ["doc", "start"])


def later_windows(strings: list[bytes], lead: np.ndarray, age: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which windows of aligned strings occur in a string of smaller ``age``, by place in each.

    ``lead`` is the place of the anchor in each string. Row i, column j of the result is for the
    window of string i that begins j places before the anchor.
    """
    m, left = len(strings), int(lead.max())
    right = max(len(s) - int(k) for s, k in zip(strings, lead, strict=True))
    columns = np.zeros((left + right, m), np.uint16)  # 0: the string has ended or not begun
    for i, (text, k) in enumerate(zip(strings, lead.tolist(), strict=True)):
        columns[left - k : left - k + len(text), i] = np.frombuffer(text, np.uint8)
        columns[left - k : left - k + len(text), i] += 1
    order, common = np.arange(m), np.zeros(m + 1, np.int32)  # common[r]: prefix shared by r - 1 and r
    later = np.zeros((m, left + 1), bool)
    for column in range(left + right - 1, -1, -1):
        symbols = columns[column][order]
        moved = np.argsort(symbols, kind="stable")
        shared = np.minimum.reduceat(common, moved + 1)[:-1] + 1
        symbols, order = symbols[moved], order[moved]
        common[1:m] = np.where((symbols[1:] == symbols[:-1]) & (symbols[1:] > 0), shared, 0)
        if column <= left:
            first = np.flatnonzero(common[:m] < length)
            size = np.diff(np.append(first, m))
            if (size > 1).any():
                ages = age[order]
                earliest = np.repeat(np.minimum.reduceat(ages, first), size)
                later[order, left - column] = ages > earliest
    return later


def _intervals(doc: list, start: np.ndarray, lead: np.ndarray, later: np.ndarray, length: int) -> tuple[list, np.ndarray, np.ndarray]:
    """Spans of bytes that marked windows cover; neighbouring windows are one span."""
    marks = np.zeros((later.shape[0], later.shape[1] + 2), np.int8)
    marks[:, 1:-1] = later
    change = np.diff(marks, axis=1)
    row, high = np.nonzero(change == -1)  # columns count places before the anchor
    _, low = np.nonzero(change == 1)
    anchor = start + lead
    return [doc[r] for r in row], anchor[row] - (high - 1), anchor[row] - low + length


def _sorted_out(strings: DataFrame, collection: int, length: int) -> DataFrame:
    """Repeated spans (doc, start, end) among strings (doc, start, lead, key, text)."""
    schema = f"doc {strings.schema['doc'].dataType.simpleString()}, start long, end long"

    def work(frames: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(frames, ignore_index=True)
        rows = rows.drop_duplicates(["doc", "start"]).sort_values(["doc", "start"], ignore_index=True)
        lead, start = rows["lead"].to_numpy(np.int64), rows["start"].to_numpy(np.int64)
        # Within a document the anchors are in the order of the starts.
        later = later_windows(rows["text"].tolist(), lead, np.arange(len(rows)), length)
        doc, begin, end = _intervals(rows["doc"].tolist(), start, lead, later, length)
        return pd.DataFrame({"doc": doc, "start": begin, "end": end})

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= collection:  # all strings of the last key may not be here yet
                rows = pd.concat(held, ignore_index=True)
                last = rows["key"] == rows["key"].iloc[-1]
                if not last.all():
                    yield work([rows[~last]])
                held = [rows[last]] if not last.all() else [rows]
        if held and sum(map(len, held)):
            yield work(held)

    return strings.repartition("key").sortWithinPartitions("key").mapInPandas(apply, schema)


def _window_by_window(strings: DataFrame, length: int) -> DataFrame:
    """The same for keys with too many strings for a task: each window is a string of its own.

    Equal windows are then equal rows, whose earliest place is a partial aggregation.
    """
    kind = strings.schema["doc"].dataType.simpleString()

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                text = row.text
                n = len(text) - length + 1
                made = [hashlib.blake2b(text[i : i + length], digest_size=16).digest() for i in range(n)]
                yield pd.DataFrame({"doc": [row.doc] * n, "start": row.start + np.arange(n), "window": made})

    each = strings.select("doc", "start", "text").mapInPandas(windows, f"doc {kind}, start long, window binary")
    each = materialise(each, "windows")
    first = each.groupBy("window").agg(F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = materialise(first.filter("n > 1").drop("n"), "first-windows")
    later = each.join(first, "window").filter(F.struct("doc", "start") > F.col("first"))
    return later.select("doc", "start", (F.col("start") + length).alias("end"))


def repeated_spans(
    docs: DataFrame, collection: int = COLLECTION, hot_strings: int = HOT_STRINGS
) -> DataFrame:
    """Spans (doc, start, end) of bytes of (doc, t) rows that cover repeated windows; they may overlap."""
    docs = docs.filter("doc IS NOT NULL AND t IS NOT NULL")
    seen = materialise(_occurrences(docs, _repeated_keys(docs)), "runs")
    groups = seen.groupBy("key", "digest").agg(
        F.min(F.struct("doc", "start", "slot", "length")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    groups = materialise(groups, "run-groups")
    # A run is the earliest of its text or all of it is repeated. The test by slots settles most.
    several = groups.filter("n > 1")
    earliest = docs.sparkSession.sparkContext.broadcast(bit_set(groups, F.col("first.slot"), KEY_BITS))

    @F.pandas_udf("boolean")
    def maybe_earliest(slots: pd.Series) -> pd.Series:
        return pd.Series(in_bit_set(earliest.value, slots.to_numpy(np.int64)))

    span = ["doc", "start", (F.col("start") + F.col("length")).alias("end")]
    tested = seen.withColumn("maybe", maybe_earliest("slot"))
    copies = tested.filter("NOT maybe").select(*span)
    firsts = several.select("key", "digest", "first.doc", "first.start")
    unsure = tested.filter("maybe").join(several.select("key", "digest"), ["key", "digest"], "left_semi")
    copies = copies.unionByName(unsure.join(firsts, ["key", "digest", "doc", "start"], "left_anti").select(*span))

    counts = groups.groupBy("key").agg(F.count(F.lit(1)).alias("n_strings")).filter("n_strings > 1")
    unlike = groups.join(materialise(counts, "run-keys"), "key")
    unlike = materialise(unlike.select("key", "first.doc", "first.start", "first.slot", "n_strings"), "unlike")
    strings = materialise(_strings(docs, unlike), "strings")
    few = _sorted_out(strings.filter(F.col("n_strings") <= hot_strings).drop("n_strings"), collection, LENGTH)
    many = _window_by_window(strings.filter(F.col("n_strings") > hot_strings), LENGTH)
    return copies.unionByName(few).unionByName(many)


def _cut(text: str, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, str]:
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    steps = np.zeros(len(data) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    gone = np.cumsum(steps)[:-1] > 0
    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, kept_sha256.

    A byte is removed if a string of ``LENGTH`` bytes that covers it also starts earlier: in a
    document of smaller key, or in the same document before. Strings are judged on the input. Null
    texts count as empty, and texts shorter than ``LENGTH`` lose nothing. Rows with a null key
    lose nothing and make no other row lose anything. Rows that repeat a key are one document. Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    spans = repeated_spans(rows)
    places = spans.groupBy("doc").agg(F.collect_set(F.struct("start", "end")).alias("s"))
    places = places.select("doc", F.col("s.start").alias("starts"), F.col("s.end").alias("ends"))
    places = materialise(places, "places")
    maybe = maybe_in(places, "doc")

    @F.pandas_udf("n_removed long, n_spans long, kept_sha256 string")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        none = np.empty(0, np.int64)
        found = [
            _cut(t, none if s is None else s, none if e is None else e)
            for t, s, e in zip(texts, starts, ends, strict=True)
        ]
        return pd.DataFrame(found, columns=["n_removed", "n_spans", "kept_sha256"])

    size = F.octet_length("t").cast("long").alias("n_bytes")
    marked = rows.withColumn("maybe", F.coalesce(maybe(F.col("doc")), F.lit(False)))
    whole = marked.filter("NOT maybe").select(
        F.col("doc").alias(key), size, F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2(F.col("t").cast("binary"), 256).alias("kept_sha256"),
    )
    joined = marked.filter("maybe").join(places, "doc", "left")
    parts = joined.select(F.col("doc").alias(key), size, cut("t", "starts", "ends").alias("c"))
    return whole.unionByName(parts.select(key, "n_bytes", "c.*"))


def op1_column_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))

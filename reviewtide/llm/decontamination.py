"""Benchmark decontamination by the q-gram lemma and banded alignment.

A benchmark item is cut into overlapping fragments: ``WORDS`` words from every word on, at most
``FRAGMENT`` characters of them, and further ones where words are long. So any passage of ``WORDS``
whole words is found wherever it begins in the item, and so is one of ``FRAGMENT`` characters from a
word's start on. If a document holds a fragment of m
characters with at most e edits, the two share at least m - q + 1 - q e of the fragment's
q-grams, all within e + 1 neighbouring diagonals (place in the document less place in the
fragment). Shared q-grams are counted in overlapping bands of 2 (e + 1) diagonals, so one band
holds them all; regions that reach the bound are aligned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewtide.llm.common import SPACE, folded, table

Q = 8
#: The shortest passage in words that is found at any place of an item.
WORDS = 13
FRAGMENT = 80
STRIDE = 40
#: Inside words of more characters fragments start every ``Q`` characters.
LONG_WORD = 20
ERROR_RATE = 0.06
#: Benchmark characters per pass over the documents.
BLOCK_CHARS = 1_000_000
_FILTER_BITS = 22
_REGIONS = 4096


@dataclass
class FragmentIndex:
    """The q-grams of a block of items, each indexed once. ``grams`` are sorted and distinct; the
    occurrences of gram i are ``owner``/``place`` (item and offset in it) at ``first[i]`` up to
    ``first[i + 1]``. Fragments are stretches ``start`` to ``end`` of their ``item``, in that order;
    ``least`` is the smallest ``bound`` of an item's fragments."""

    items: list
    wholes: list[np.ndarray]
    item: np.ndarray
    start: np.ndarray
    end: np.ndarray
    edits: np.ndarray
    bound: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    maybe: np.ndarray
    least: np.ndarray

    def part(self, fragment: int) -> np.ndarray:
        return self.wholes[self.item[fragment]][self.start[fragment] : self.end[fragment]]

    @property
    def codes(self) -> list[np.ndarray]:
        """The code points of all fragments."""
        return [self.part(f) for f in range(len(self.item))]


def _grams(codes: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``Q`` (a power of two) consecutive code points."""
    h, width = codes.astype(np.uint64) + np.uint64(1), 1
    with np.errstate(over="ignore"):
        while width < Q:
            if len(h) <= width:
                return np.empty(0, np.uint64)
            h = (h[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width)) ^ (h[width:] >> np.uint64(7)) ^ (
                h[width:] * np.uint64(0xC2B2AE3D27D4EB4F)
            )
            width *= 2
    return h


def _bucket(grams: np.ndarray) -> np.ndarray:
    mixed = (grams ^ (grams >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return mixed >> np.uint64(64 - _FILTER_BITS)


def _fragments(whole: np.ndarray, fragment: int) -> list[tuple[int, int]]:
    """(start, end) of the fragments of a folded item, in order."""
    last = max(0, len(whole) - fragment)
    found = {(start, min(start + fragment, len(whole))) for start in {*range(0, last + 1, STRIDE), last}}
    inner = np.append(whole != SPACE, False)
    edge = np.flatnonzero(np.diff(np.append(False, inner).astype(np.int8)))
    first, after = edge[::2].tolist(), edge[1::2].tolist()
    for i, start in enumerate(first):
        end = start + fragment
        if i + WORDS <= len(first):
            end = min(end, after[i + WORDS - 1])
        starts = [(start, end)]
        if after[i] - start > LONG_WORD:
            starts += [(at, at + fragment) for at in range(start + Q, after[i], Q)]
        found.update((a, b) for a, b in starts if b <= len(whole))
    return sorted(found)


def index_items(items: list[tuple], fragment: int = FRAGMENT, rate: float = ERROR_RATE) -> FragmentIndex:
    """Index (key, text) pairs. Items of fewer than ``Q`` folded characters are not searched."""
    wholes = [folded((text or "").strip())[0] for _, text in items]
    parts = [(i, a, b) for i, whole in enumerate(wholes) for a, b in _fragments(whole, fragment) if b - a >= Q]
    item, start, end = np.array(parts, np.int64).reshape(-1, 3).T
    length = end - start
    edits = np.minimum((length * rate).astype(np.int64), np.maximum(0, (length - Q) // Q))
    hashed = [_grams(whole) for whole in wholes]
    values = np.concatenate([np.empty(0, np.uint64), *hashed])
    owner = np.repeat(np.arange(len(hashed)), [len(h) for h in hashed])
    place = np.concatenate([np.empty(0, np.int64), *(np.arange(len(h)) for h in hashed)])
    order = np.argsort(values, kind="stable")
    grams, first = np.unique(values[order], return_index=True)
    maybe = np.zeros(1 << _FILTER_BITS, bool)
    maybe[_bucket(grams)] = True
    bound = length - Q + 1 - Q * edits
    least = np.full(len(items), np.iinfo(np.int64).max)
    np.minimum.at(least, item, bound)
    return FragmentIndex(
        [k for k, _ in items], wholes, item, start, end, edits, bound, grams,
        np.append(first, len(values)), owner[order].astype(np.int32), place[order].astype(np.int32), maybe, least,
    )


def _crowded(index: FragmentIndex, item: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
    """Places of the matches with enough others of their item around their diagonal.

    The q-grams that bring a fragment to its bound lie on 2 (e + 1) neighbouring diagonals of its
    item, so each of them sees all others within that distance.
    """
    reach = 2 * (index.edits.max() + 1)
    line = item.astype(np.int64) << 40 | (diagonal + (1 << 38))
    order = np.argsort(line)
    line = line[order]
    around = np.searchsorted(line, line + reach, "right") - np.searchsorted(line, line - reach)
    return order[around >= index.least[item[order]]]


def _in_fragments(index: FragmentIndex, item: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every (match, fragment) such that the match's q-gram lies in the fragment."""
    key = index.item << 40 | index.start
    longest = (index.end - index.start).max()
    line = item.astype(np.int64) << 40
    low = np.searchsorted(key, line | np.maximum(place + Q - longest, 0))
    high = np.searchsorted(key, line | place, "right")
    match = np.repeat(np.arange(len(item)), high - low)
    fragment = np.repeat(low - np.append(0, np.cumsum(high - low)[:-1]), high - low) + np.arange(len(match))
    inside = index.end[fragment] >= place[match] + Q
    return match[inside], fragment[inside]


def _candidates(index: FragmentIndex, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fragment, first diagonal) of the bands that hold enough q-grams of the fragment."""
    none = np.empty(0, np.int64)
    found = _grams(codes)
    at = np.flatnonzero(index.maybe[_bucket(found)])
    if not len(at) or not len(index.item):
        return none, none
    slot = np.minimum(np.searchsorted(index.grams, found[at]), len(index.grams) - 1)
    same = index.grams[slot] == found[at]
    at, slot = at[same], slot[same]
    if not len(at):
        return none, none
    count = index.first[slot + 1] - index.first[slot]
    place = np.repeat(index.first[slot] - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
    item, place = index.owner[place], index.place[place].astype(np.int64)
    along = np.repeat(at, count) - place
    kept = _crowded(index, item, along)
    if not len(kept):
        return none, none
    item, place, along = item[kept], place[kept], along[kept]
    match, fragment = _in_fragments(index, item, place)
    offset = place[match] - index.start[fragment]
    diagonal = along[match] + index.start[fragment]
    # A fragment with fewer hits than its bound in all cannot reach it in a band.
    enough = np.bincount(fragment, minlength=len(index.bound)) >= index.bound
    keep = enough[fragment]
    fragment, offset, diagonal = fragment[keep], offset[keep], diagonal[keep]
    if not len(fragment):
        return none, none
    step = index.edits[fragment] + 1
    band = diagonal // step
    low, longest = band.min() - 1, int((index.end - index.start).max())
    bands = int(band.max() - low) + 1
    rows = np.concatenate([(fragment * bands + (b - low)) * longest + offset for b in (band, band - 1)])
    rows.sort()
    rows = rows[np.append(True, rows[1:] != rows[:-1])] // longest  # a q-gram of the fragment counts once per band
    starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    shared = np.diff(np.append(starts, len(rows)))
    fragment, band = rows[starts] // bands, rows[starts] % bands + low
    reached = shared >= index.bound[fragment]
    return fragment[reached], band[reached] * (index.edits[fragment[reached]] + 1)


def _align(pattern: np.ndarray, regions: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits of each pattern row against any substring of its region row, and its end.

    ``regions`` begin ``edits`` places before the band's first diagonal; only the cells of the
    band and of ``edits`` diagonals at each side are computed.
    """
    n, m = pattern.shape
    width = 2 * (edits + 1) + 2 * edits
    shift = np.arange(width)
    cost = np.zeros((n, width), np.int64)
    for i in range(m):
        step = cost + (regions[:, i : i + width] != pattern[:, i : i + 1])
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(step - shift, axis=1) + shift
    return cost.min(axis=1), cost.argmin(axis=1) - edits + m


def find_leaks(index: FragmentIndex, text: str | None) -> list[tuple]:
    """(item, fragments, edits, start, end) of each item with a fragment in the whole text.

    ``edits`` are the fewest of any fragment; start and end span all that were found, in code
    points of the text. Null and empty texts hold nothing.
    """
    if not text:
        return []
    codes, origin = folded(text)
    fragment, diagonal = _candidates(index, codes)
    if not len(fragment):
        return []
    length = index.end[fragment] - index.start[fragment]
    edits = index.edits[fragment]
    hits: dict[int, list[tuple[int, int, int, int]]] = {}
    for m, e in sorted(set(zip(length.tolist(), edits.tolist(), strict=True))):
        chosen = np.flatnonzero((length == m) & (edits == e))
        for part in np.split(chosen, range(_REGIONS, len(chosen), _REGIONS)):
            pattern = np.array([index.part(f) for f in fragment[part]])
            begin = diagonal[part] - e
            span = begin[:, None] + np.arange(m + 4 * e + 2)
            inside = (span >= 0) & (span < len(codes))
            regions = np.where(inside, codes[np.clip(span, 0, len(codes) - 1)], np.uint32(0xFFFFFFFF))
            cost, end = _align(pattern, regions, e)
            for f, d, c, stop in zip(fragment[part], diagonal[part], cost, end, strict=True):
                if c <= e:
                    stop = min(int(d + stop), len(codes))
                    start = max(0, stop - m)
                    item = int(index.item[f])
                    hits.setdefault(item, []).append((int(f), int(c), int(origin[start]), int(origin[stop - 1]) + 1))
    return [
        (i, len({h[0] for h in found}), min(h[1] for h in found), min(h[2] for h in found), max(h[3] for h in found))
        for i, found in sorted(hits.items())
    ]


def _blocks(benchmark: DataFrame, key: str, text: str, chars: int) -> list[DataFrame]:
    rows = benchmark.select(F.col(key).alias("k"), F.col(text).alias("t")).filter("t IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.char_length("t"))).first()[0] or 0
    count = max(1, -(-total // chars))
    block = F.pmod(F.xxhash64("t"), F.lit(count))
    return [rows.filter(block == i) for i in range(count)]


def leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS
) -> list[Column]:
    """Per block of the benchmark a column of ``docs`` with array<struct(item, n_fragments, edits, start, end)>.

    The benchmark is the stated query set: about ``block_chars`` of it at a time are indexed on
    the driver and broadcast, and each block passes over all documents, without a shuffle.
    """
    item_type = benchmark.schema[key].dataType
    names = ("n_fragments", "edits", "start", "end")
    kind = T.ArrayType(
        T.StructType([T.StructField("item", item_type), *(T.StructField(n, T.IntegerType()) for n in names)])
    )
    columns = []
    for rows in _blocks(benchmark, key, text, block_chars):
        items = sorted(((r["k"], r["t"]) for r in rows.collect()), key=lambda r: (str(r[0]), r[1]))
        shared = docs.sparkSession.sparkContext.broadcast(index_items(items))
        columns.append(_searcher(shared, kind)(F.col(text)))
    return columns


def _searcher(shared, kind: T.DataType):
    @F.pandas_udf(kind)
    def search(texts: pd.Series) -> pd.Series:
        index = shared.value
        names = ("item", "n_fragments", "edits", "start", "end")
        return pd.Series(
            [[dict(zip(names, (index.items[h[0]], *h[1:]), strict=True)) for h in find_leaks(index, t)] for t in texts],
            dtype=object,
        )

    return search


def op2_qgram_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item of which it holds a fragment."""
    docs = table(spark, sf_dir, "documents")
    found = leaks(docs, table(spark, sf_dir, "benchmark"))
    each = docs.select("doc_id", F.explode(F.concat(*found)).alias("h"))
    return each.select("doc_id", F.col("h.item").alias("item_id"), "h.n_fragments", "h.edits", "h.start", "h.end")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a fragment of a benchmark item go."""
    clean = docs
    for found in leaks(docs, table(spark, sf_dir, "benchmark")):
        clean = clean.filter(F.size(found) == 0)
    return clean

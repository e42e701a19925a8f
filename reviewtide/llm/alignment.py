"""Cross-tokenizer alignment by divide and conquer at shared cuts.

Two tokenizers cut one text at different bytes. Where both end a token the text falls apart, and
the pieces between such cuts are the groups of the alignment. A cut is sought near the middle of
an interval: from its middle token on the two lists of ends are bisected in turn until they agree
or the interval is over. Both halves are then searched alike, without the stretch that was just
found to hold no cut; an interval without a cut inside is a group. All intervals of one depth are
searched at once, over all texts of a chunk, so the depth of the recursion is the logarithm of the
longest text's number of tokens.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.llm.common import table
from reviewtide.plans.storage import materialise

TOKENIZERS = "/opt/tokenizers"
BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: Texts are tokenized and aligned in chunks of about so many characters; a longer one is alone.
CHUNK_CHARS = 1 << 20
#: At most so many of the most frequent pairs go to all tasks, at some 40 bytes each.
HOT_PAIRS = 1 << 20

# The word pattern of byte-level BPE, and the sign that pieces have for a space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE_SPACE = "▁"


class Encoder:
    """Ids of texts, and the bytes of every id: ``flat`` holds all, an id's ``length`` from ``start`` on."""

    def __init__(self, ids: Callable[[list[str]], list[np.ndarray]], spelled: list[bytes]):
        self.ids, self.size = ids, len(spelled)
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)
        self.length = np.array([len(s) for s in spelled], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def spells(self, ids: np.ndarray, data: bytes) -> bool:
        """Whether the bytes of the ids, joined, are ``data``."""
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        if not len(ids) or ends[-1] != len(data):
            return False
        places = np.repeat(self.start[ids] - (ends - lengths), lengths) + np.arange(len(data))
        return bool((self.flat[places] == np.frombuffer(data, np.uint8)).all())


def _printable_bytes() -> dict[str, int]:
    """Byte of each sign of byte-level vocabularies: printable Latin-1 signs stand for themselves,
    the other bytes, in order, for the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def byte_level(model: bytes) -> Encoder:
    """A byte-level BPE vocabulary. Where merges are numbered in order, which makes ids ranks, the
    faster library with ranks gives the same ids; else the file's own library encodes."""
    parsed = json.loads(model)
    vocabulary, merges = parsed["model"]["vocab"], parsed["model"]["merges"]
    special = {t["content"] for t in parsed["added_tokens"]}
    signs = _printable_bytes()
    entries = {t: bytes(signs[c] for c in t) for t in vocabulary if t not in special}
    spelled = [b""] * (max(vocabulary.values()) + 1)
    for name, data in entries.items():
        spelled[vocabulary[name]] = data
    pairs = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
    ranked = [vocabulary[p] for p in pairs] == list(range(256, 256 + len(pairs)))
    if ranked and parsed["normalizer"] is None and len(entries) == 256 + len(pairs):
        ranks = {data: vocabulary[name] for name, data in entries.items()}
        fast = tiktoken.Encoding("byte_level", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Encoder(lambda texts: [np.array(fast.encode_ordinary(t), np.int64) for t in texts], spelled)
    plain = tokenizers.Tokenizer.from_str(model.decode())
    plain.encode_special_tokens = True
    return Encoder(lambda texts: [np.array(plain.encode(t, add_special_tokens=False).ids, np.int64) for t in texts], spelled)


@functools.cache
def pieces(model: bytes) -> Encoder:
    """A sentence-piece model."""
    loaded = sentencepiece.SentencePieceProcessor(model_proto=model)

    def spell(i: int) -> bytes:
        piece = loaded.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if loaded.is_byte(i) else piece.replace(PIECE_SPACE, " ").encode()

    def ids(texts: list[str]) -> list[np.ndarray]:
        return [np.array(i, np.int64) for i in loaded.encode(texts, num_threads=1)]

    return Encoder(ids, [spell(i) for i in range(loaded.get_piece_size())])


def shared_cuts(a: np.ndarray, b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places in ``a``, ascending, whose ends ``b`` has too, within the intervals [first, last).

    ``a`` and ``b`` are ascending ends; the last of ``b`` is not below any of the intervals.
    """
    low, high, found = first, last, [np.empty(0, np.int64)]
    while True:
        inside = low < high
        low, high = low[inside], high[inside]
        if not len(low):
            return np.sort(np.concatenate(found))
        middle = (low + high) // 2
        at, cut = _next_shared(a, b, middle, high)
        found.append(at[cut])
        low, high = np.concatenate([low, at[cut] + 1]), np.concatenate([middle, high[cut]])


def _next_shared(a: np.ndarray, b: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval the first place in ``a`` from ``start`` on whose end is shared, if any is before ``stop``."""
    at, cut = start.copy(), np.zeros(len(start), bool)
    going = np.arange(len(start))
    while len(going):
        here = a[at[going]]
        there = b[np.searchsorted(b, here)]
        cut[going[here == there]] = True
        going, there = going[here != there], there[here != there]
        at[going] = np.searchsorted(a, there)
        going = going[at[going] < stop[going]]
    return at, cut


class _Notation(NamedTuple):
    """How ids are written in groups: followed by a comma, or ending the group's half."""

    signs: np.ndarray
    lengths: np.ndarray
    shift: tuple[int, int, int, int]


@functools.cache
def _notation(size_a: int, size_b: int) -> _Notation:
    signs = [b"%d%s" % (i, end) for size, end in ((size_a, b","), (size_a, b"|"), (size_b, b","), (size_b, b"")) for i in range(size)]
    table_of = np.empty(len(signs), object)
    table_of[:] = signs
    return _Notation(table_of, np.array([len(s) for s in signs], np.int64), (0, size_a, 2 * size_a, 2 * size_a + size_b))


def _marked(a: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the chunk, of which ``a`` holds the last, whether one of ``ends`` is there, and
    how many are before it."""
    there = np.zeros(a[-1] + 1 if len(a) else 0, bool)
    there[ends] = True
    return there, np.cumsum(there) - there


def align_chunk(texts: list[bytes | None], one: Encoder, two: Encoder) -> list[pa.Array]:
    """Columns n_a, n_b, groups, links of the texts."""
    filled = [(place, data, data.decode("utf-8", "replace")) for place, data in enumerate(texts) if data]
    encoded = zip(filled, one.ids([" " + t for *_, t in filled]), two.ids([t for *_, t in filled]), strict=True)
    spelled = [(p, x, y) for (p, data, _), x, y in encoded if all(e.spells(ids, b" " + data) for e, ids in ((one, x), (two, y)))]
    known = [p for p, *_ in spelled]
    counts = np.zeros((4, len(texts)), np.int64)
    counts[0, known], counts[1, known] = [len(x) for _, x, _ in spelled], [len(y) for *_, y in spelled]
    none = np.empty(0, np.int64)
    a_id, b_id = np.concatenate([none, *(x for _, x, _ in spelled)]), np.concatenate([none, *(y for *_, y in spelled)])
    a, b = np.cumsum(one.length[a_id]), np.cumsum(two.length[b_id])
    last = np.cumsum(counts[0, known])
    cuts = shared_cuts(a, b, last - counts[0, known], last)
    bounds = a[last - 1]

    cut, groups_before = _marked(a, a[cuts])
    group_a, group_b = groups_before[a], groups_before[b]
    ends_b = np.flatnonzero(cut[b])
    notation = _notation(one.size, two.size)
    written = np.empty(len(a) + len(b), np.int64)
    before = np.append(0, ends_b + 1)[group_a]
    written[np.arange(len(a)) + before] = a_id + notation.shift[0]
    written[cuts + before[cuts]] += notation.shift[1]
    place_b = np.arange(len(b)) + cuts[group_b] + 1
    written[place_b] = b_id + notation.shift[2]
    written[place_b[ends_b]] += notation.shift[3] - notation.shift[2]
    ends = np.append(0, np.cumsum(notation.lengths[written])[place_b[ends_b]]).astype(np.int32)
    joined = b"".join(notation.signs[written].tolist())
    groups = pa.StringArray.from_buffers(len(cuts), pa.py_buffer(ends), pa.py_buffer(joined))
    counts[2, known] = np.diff(np.searchsorted(a[cuts], bounds, "right"), prepend=0)

    # Within its group a link is a stretch between neighbouring ends of either side.
    (in_a, before_a), (in_b, before_b) = _marked(a, a), _marked(a, b)
    stretch = np.flatnonzero(in_a | in_b)
    counts[3, known] = np.diff(np.searchsorted(stretch, bounds, "right"), prepend=0)
    pair = a_id[before_a[stretch]] * two.size + b_id[before_b[stretch]]
    pairs = one.size * two.size
    linked, times = np.unique(np.repeat(np.arange(len(known)), counts[3, known]) * pairs + pair, return_counts=True)
    counts[3, known] = np.bincount(linked // pairs, minlength=len(known))
    linked %= pairs
    fields = [linked // two.size, linked % two.size, times]
    links = pa.StructArray.from_arrays([pa.array(f.astype(np.int32)) for f in fields], ["a", "b", "n"])

    offsets = [pa.array(np.append(0, np.cumsum(c)).astype(np.int32)) for c in counts[2:]]
    lists = [pa.ListArray.from_arrays(o, v) for o, v in zip(offsets, (groups, links), strict=True)]
    return [*(pa.array(c.astype(np.int32)) for c in counts[:2]), *lists]


def align_tokens(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    byte_level_path: str = f"{TOKENIZERS}/{BYTE_LEVEL}",
    pieces_path: str = f"{TOKENIZERS}/{PIECES}",
) -> DataFrame:
    """(key, row, n_a, n_b, groups, links) of every row: how the tokens of two vocabularies lie on its text.

    A is the byte-level vocabulary on the text after a space, B the piece model on the text, which
    adds that space. ``groups`` are the smallest stretches between common cuts, in order, written
    ``a1,a2|b1`` in ids; ``links`` are the pairs of ids (a, b) whose tokens overlap in bytes,
    with the number ``n`` of such pairs of tokens. ``row`` tells rows of one key apart.

    Null and empty texts, and those that either vocabulary does not spell byte by byte (also
    bytes that are no UTF-8), have no tokens, groups or links. Any key is taken, also null or
    repeated; other columns are not read. The two files (2 MB) are read by the driver and go to all tasks.
    """
    context = docs.sparkSession.sparkContext
    models = context.broadcast((Path(byte_level_path).read_bytes(), Path(pieces_path).read_bytes()))
    rows = docs.select(F.col(key).alias("k"), F.monotonically_increasing_id().alias("row"), F.col(text).cast("binary").alias("t"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = byte_level(models.value[0]), pieces(models.value[1])
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch["t"]), 0).to_numpy(zero_copy_only=False)
            chunk = (np.cumsum(sizes, dtype=np.int64) - sizes) // CHUNK_CHARS
            starts = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])) if len(chunk) else []
            for start, stop in zip(starts, [*starts[1:], len(chunk)], strict=True):
                part = batch.slice(start, stop - start)
                columns = align_chunk(part["t"].to_pylist(), one, two)
                yield pa.RecordBatch.from_arrays([part["k"], part["row"], *columns], names=["k", "row", "n_a", "n_b", "groups", "links"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"k {kind}, row long, n_a int, n_b int, groups array<string>, links array<struct<a: int, b: int, n: int>>"
    return rows.mapInArrow(align, schema).withColumnRenamed("k", key)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best) of every pair of ids linked in the corpus, counted over all texts.

    ``pair`` is (a << 32) + b; ``best`` tells whether no other pair of b has more links.
    """
    found = aligned.select(F.inline("links")).groupBy(_pair(), "b").agg(F.sum("n").alias("count"))
    found = materialise(found, "pairs")
    most = found.groupBy("b").agg(F.max("count").alias("most"))
    return found.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _pair():
    return (F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("pair")


def _hot_limit(counts: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` pairs have that count or more."""
    power = F.floor(F.log2("count")).cast("int").alias("power")
    sizes = {r["power"]: r["n"] for r in counts.groupBy(power).agg(F.count(F.lit(1)).alias("n")).collect()}
    limit, held = max(sizes, default=0) + 1, 0
    while limit and held + sizes.get(limit - 1, 0) <= most:
        limit -= 1
        held += sizes.get(limit, 0)
    return 1 << limit


def link_sums(aligned: DataFrame, counts: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(row, n_links, n_best, count_sum) of every row of ``aligned`` with links.

    The most frequent pairs, at most ``hot_pairs``, are broadcast, so no task gets all links of
    one pair. The links of the others are joined by pair through a shuffle; each of those pairs is rare.
    """
    limit = _hot_limit(counts, hot_pairs)
    links = aligned.select("row", F.inline("links")).select("row", _pair(), "n")
    looked_up = links.join(F.broadcast(counts.filter(F.col("count") >= limit)), "pair", "left")
    sums = _sums(looked_up.filter("count IS NOT NULL"))
    if limit > 1:
        rare = looked_up.filter("count IS NULL").select("row", "pair", "n")
        rest = rare.join(counts.filter(F.col("count") < limit).hint("merge"), "pair")
        sums = sums.unionByName(_sums(rest)).groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")])
    return sums


def _sums(looked_up: DataFrame) -> DataFrame:
    n = F.col("n").cast("long")
    return looked_up.groupBy("row").agg(
        F.sum(n).alias("n_links"),
        F.sum(F.when(F.col("best"), n).otherwise(0)).alias("n_best"),
        F.sum(n * F.col("count")).alias("count_sum"),
    )


def op13_shared_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, groups and links, and how frequent its links are in the corpus.

    Texts without tokens (null, empty or not spelled byte by byte) count zero everywhere and have an empty digest.
    """
    aligned = align_tokens(table(spark, sf_dir, "documents"))
    digest = F.when(F.size("groups") > 0, F.sha2(F.array_join("groups", ";"), 256)).otherwise("")
    sizes = [F.col(c).cast("long").alias(c) for c in ("n_a", "n_b")]
    groups = F.size("groups").cast("long").alias("n_groups")
    aligned = materialise(aligned.select("doc_id", "row", *sizes, groups, digest.alias("groups_sha256"), "links"), "aligned")
    sums = link_sums(aligned, materialise(pair_counts(aligned), "counts"))
    found = aligned.drop("links").join(sums, "row", "left").drop("row")
    return found.fillna(0, ["n_links", "n_best", "count_sum"])

"""N-gram Jaccard join with token-combination prefixes.

Tokens (hashed word shingles) fall into classes by frequency: rare ones are indexed alone, frequent
ones in pairs, very frequent ones in triples. All tokens have one global order: by class, then
by hash. A set's prefix is extended until it holds so many class-k tokens that any
``errors + 1`` of them missing elsewhere would still leave k together:

    singles + sum over groups of (tokens of the group - k + 1) > errors

where classes 2 and 3 are divided into groups of neighbouring hashes, so that combinations stay
within a group and their number in proportion to the set. If two sets are similar, the set
whose prefix ends first shares all but ``errors`` of its prefix tokens with the other's prefix, so
the two share a whole combination. The index loses no pair, whatever the classes; they only
decide how selective it is.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.llm.common import (
    BASE,
    ROW_BITS,
    bit_set,
    components,
    in_bit_set,
    maybe_in,
    mix,
    row_slot,
    rows_of,
    scan_texts,
    span_hashes,
    table,
)
from reviewtide.plans.storage import materialise, scratch

SHINGLE = 3
PERCENT = 90
#: What the pipeline stage takes for near copies.
STAGE_SHINGLE = 5
STAGE_PERCENT = 80
#: A token in the hash prefix of more sets than these is of class 2, of class 3.
CLASS_LIMITS = (4, 64)
#: Slots of the table of token classes, of fixed size, that goes to all tasks.
CLASS_BITS = 22
#: Bits of a set's parity sketch.
SKETCH_BITS = 1024
#: Keys of no more sets than these list the pairs whose sizes fit; their sketches follow per distinct pair.
FEW_SETS = 8
#: Sets of one key whose sketches are compared in one task; more are dealt over several.
KEY_SETS = 1024
#: Pairs of sketches in memory at once.
PAIR_CHUNK = 1 << 17
#: Sets of fewer tokens are indexed by single tokens only.
SMALL_LEVEL = 3

def shingles(text: bytes | np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles of a whole text in UTF-8.

    A-Z are lower-cased and words are runs of anything but ASCII white space. With fewer than
    ``size`` words the whole sequence is one shingle; without words there is none.
    """
    data = np.frombuffer(bytes(text).lower(), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    word = np.ones(len(data) + 2, bool)
    word[0] = word[-1] = False
    word[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    words = span_hashes(data, start, end)
    width = min(size, len(words))
    found = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        found = mix(found * BASE + words[i : len(words) - width + 1 + i])
    return np.unique(found)


def errors_allowed(n: int, percent: int = PERCENT, smaller: bool = False) -> int:
    """How many of n tokens a similar set may lack: at least ceil(percent n / 100) are shared.

    In a set that is no larger than the other it is fewer: ceil(2 percent n / (100 + percent)) are.
    """
    return n - (-(-2 * percent * n // (100 + percent)) if smaller else -(-percent * n // 100))


def _levels(n: int, percent: int) -> list[int]:
    """Powers of two of the larger set of any pair that a set of n tokens may be in."""
    return sorted({n.bit_length() - 1, (100 * n // percent).bit_length() - 1})


def _slots(tokens: np.ndarray) -> np.ndarray:
    return tokens & np.uint64((1 << CLASS_BITS) - 1)


def signatures(tokens: np.ndarray, classes: np.ndarray, percent: int = PERCENT, smaller: bool = False) -> np.ndarray:
    """Index keys of a set, its sorted distinct tokens given; ``classes`` by slot, 1 to 3.

    With ``smaller`` only those that it needs as the smaller set of a pair.
    """
    n = len(tokens)
    if not n:
        return tokens
    need = errors_allowed(n, percent, smaller) + 1
    kind = classes[_slots(tokens)]
    singles = tokens[kind == 1]
    if len(singles) >= need:
        return singles[:need]
    found = [singles]
    rest = need - len(singles)
    for level in _levels(n, percent):
        if level < SMALL_LEVEL:
            found.append(np.concatenate([tokens[kind == 2], tokens[kind == 3]])[:rest])
        else:
            found.append(_combinations(tokens, kind, level, rest))
    return np.unique(np.concatenate(found))


def _combinations(tokens: np.ndarray, kind: np.ndarray, level: int, need: int) -> np.ndarray:
    """Hashed pairs and triples of the prefix whose groups cover ``need`` missing tokens.

    There are 2^level / 4 groups of class 2 and 2^level / 8 of class 3, so the groups of a set at
    this level always cover enough: at least (its tokens - 2^level / 2).
    """
    made: list[int] = []
    for size, bits in ((2, level - 2), (3, level - 3)):
        own = tokens[kind == size]
        group = own >> np.uint64(64 - bits) if bits else np.zeros(len(own), np.uint64)
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(own) else []
        for part in np.split(own, starts[1:]) if len(own) else []:
            if need <= 0:
                break
            taken = part[: need + size - 1]
            need -= max(0, len(taken) - size + 1)
            made += [hash((level, *c)) & 0xFFFFFFFFFFFFFFFF for c in itertools.combinations(taken.tolist(), size)]
    return mix(np.array(made, np.uint64))


def _sketch(tokens: np.ndarray, size: int = SKETCH_BITS) -> np.ndarray:
    """Of each of ``size`` groups of tokens whether the set holds an odd number.

    Two sketches differ in no more bits than the sets do in tokens.
    """
    odd = np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _profiles(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """(doc, n, digest, prefix, sketch): set size, digest of the set, its first tokens by hash."""

    def emit(doc, data: np.ndarray) -> tuple:
        tokens = shingles(data, size)
        n = len(tokens)
        prefix = tokens[: errors_allowed(n, percent) + 1] if n else tokens
        digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
        return [n], [digest], [prefix.view(np.int64)], [_sketch(tokens)]

    fields = "n long, digest binary, prefix array<long>, sketch array<long>"
    return scan_texts(docs, emit, fields)


def _token_classes(sets: DataFrame, limits: tuple[int, int]) -> np.ndarray:
    """Class of each slot: how many sets have one of its tokens in their first tokens by hash."""
    counts = sets.select(F.explode("prefix").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("c"))
    often = materialise(counts.filter(F.col("c") > limits[0]), "often")
    slot = F.col("t").bitwiseAND(F.lit((1 << CLASS_BITS) - 1))
    every = np.arange(1 << CLASS_BITS)
    classes = np.ones(1 << CLASS_BITS, np.uint8)
    for limit in limits:
        classes += in_bit_set(bit_set(often.filter(F.col("c") > limit), slot, CLASS_BITS), every)
    return classes


def _verified(pairs: DataFrame, docs: DataFrame, percent: int, size: int) -> DataFrame:
    """The (a, b) of ``pairs`` that are similar, by their whole sets."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    texts = rows_of(docs, materialise(wanted, "wanted"), "doc")
    sets = scan_texts(texts, lambda doc, data: ([shingles(data, size).view(np.int64)],), "tokens array<long>")
    with scratch(docs.sparkSession, "sets") as keep:
        sets = keep(sets)
        left = sets.select(F.col("doc").alias("a"), F.col("tokens").alias("ta"))
        right = sets.select(F.col("doc").alias("b"), F.col("tokens").alias("tb"))
        both = pairs.join(left, "a").join(right, "b")
        shared = F.size(F.array_intersect("ta", "tb")).cast("long")
        sizes = F.size("ta") + F.size("tb")
        return materialise(both.filter(100 * shared >= percent * (sizes - shared)).select("a", "b").distinct(), "links")


def _shared_keys(rows: DataFrame, nodes: DataFrame, classes: np.ndarray, percent: int, size: int) -> DataFrame:
    """(sig, node, core, n, low) of the index keys that several of ``nodes`` (node, n) have; low is the key's smallest node.

    Most keys have one set and are counted only, so nothing but the key itself is shuffled for
    them. Rows that are no node are left out by a set of fixed size first, then by the join.
    """
    spark = rows.sparkSession
    known = spark.sparkContext.broadcast((classes, bit_set(nodes, row_slot(F.col("node")), ROW_BITS)))

    def index_keys(doc, data: np.ndarray) -> tuple:
        table_of, slots = known.value
        if not in_bit_set(slots, np.array([doc["slot"]]))[0]:
            return np.empty(0, np.uint64), np.empty(0, bool)
        tokens = shingles(data, size)
        found = signatures(tokens, table_of, percent)
        return found, np.isin(found, signatures(tokens, table_of, percent, smaller=True))

    slotted = rows.select(F.struct(F.col("doc").alias("node"), row_slot(F.col("doc")).alias("slot")).alias("doc"), "t")
    with scratch(spark, "index") as keep:
        index = keep(scan_texts(slotted, index_keys, "sig long, core boolean").select("sig", "doc.node", "core"))
        often = keep(index.groupBy("sig").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("sig"))
        several = keep(index.join(often, "sig")).join(nodes, "node")
        several = keep(several.select("sig", "node", "core", "n"))
        lowest = F.min(F.struct("node", "n", "core")).alias("low")
        centres = several.groupBy("sig").agg(lowest, F.max("node").alias("_last")).filter("_last > low.node")
        return materialise(several.join(centres.select("sig", "low"), "sig"), "shared")


def _of_small_keys(mixed: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b), a < b, of nodes of one small key in different components whose sizes allow a link.

    Most keys have two or three sets, and the same two meet in many keys. A key's few sets are
    one row here, and no sketch is sent before a pair is one row.
    """
    few = mixed.groupBy("sig").agg(F.collect_list(F.struct("node", "n", "core", "component")).alias("sets"))

    def partners(x: Column) -> Column:
        def allowed(y: Column) -> Column:
            return (x.node < y.node) & (x.component != y.component) & _fit(x.n, x.core, y.n, y.core, percent)

        return F.transform(F.filter("sets", allowed), lambda y: F.struct(x.node.alias("a"), y.node.alias("b")))

    return few.select(F.inline(F.flatten(F.transform("sets", partners)))).distinct()


def _within_keys(mixed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of nodes of one key in different components that may be similar.

    Similar sets differ in no more tokens, and so in no more sketch bits, than their sizes
    allow. The sketches of a key are compared in one task, those of a key with many sets in
    blocks of ``KEY_SETS``, one pair of blocks a task. Only pairs that pass become rows.
    """
    many = F.greatest(F.ceil(F.col("sets") / KEY_SETS), F.lit(1)).cast("int")
    dealt = mixed.withColumn("many", many).withColumn("block", F.pmod(F.xxhash64("node"), F.col("many")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    sets = dealt.select("sig", "low", "high", "block", "node", "component", "n", "core", "sketch")
    sets = sets.repartition("sig", "low", "high").sortWithinPartitions("sig", "low", "high")
    kind = mixed.schema["node"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            whole = pa.Table.from_batches(held).combine_chunks()
            starts = _group_starts(whole)
            # The last group may go on in the next batch.
            if starts[-1]:
                yield from _alike(whole.slice(0, starts[-1]), percent)
                held = whole.slice(starts[-1]).combine_chunks().to_batches()
        if held:
            yield from _alike(pa.Table.from_batches(held).combine_chunks(), percent)

    found = sets.mapInArrow(compare, f"a {kind}, b {kind}")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _group_starts(rows: pa.Table) -> np.ndarray:
    keys = np.stack([rows[c].to_numpy().astype(np.int64) for c in ("sig", "low", "high")])
    return np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))


def _alike(rows: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes of one group in different components whose sizes and sketches allow a link."""
    starts = _group_starts(rows)
    stop = np.repeat(np.append(starts[1:], rows.num_rows), np.diff(np.append(starts, rows.num_rows)))
    low, high, block, n, core, component = (
        rows[c].to_numpy() for c in ("low", "high", "block", "n", "core", "component")
    )
    sketch = rows["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(rows.num_rows, -1)
    partners = stop - np.arange(rows.num_rows) - 1
    ends = np.cumsum(partners)
    for start in range(0, int(ends[-1]), PAIR_CHUNK):
        pair = np.arange(start, min(start + PAIR_CHUNK, int(ends[-1])))
        a = np.searchsorted(ends, pair, "right")
        b = a + 1 + pair - (ends[a] - partners[a])
        keep = (component[a] != component[b]) & ((low[a] == high[a]) | (block[a] != block[b]))
        keep &= 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
        keep &= (core[a] | (n[a] > n[b])) & (core[b] | (n[b] > n[a]))
        a, b = a[keep], b[keep]
        differ = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64)
        near = (100 + percent) * differ <= (100 - percent) * (n[a] + n[b])
        nodes = rows["node"].combine_chunks()
        yield pa.RecordBatch.from_arrays([nodes.take(pa.array(side[near])) for side in (a, b)], names=["a", "b"])


def _plausible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """``pairs`` without those whose sketches differ in more bits than similar sets do in tokens."""
    left = sketches.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    bits = F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(bits, F.lit(0), lambda total, x: total + x)
    return both.filter((100 + percent) * differ <= (100 - percent) * (F.col("na") + F.col("nb"))).select("a", "b")


def _fits(n_a: str, core_a: str, n_b: str, core_b: str, percent: int) -> Column:
    """Sizes that similar sets may have, and an index key that the smaller set needs."""
    return _fit(F.col(n_a), F.col(core_a), F.col(n_b), F.col(core_b), percent)


def _fit(a: Column, core_a: Column, b: Column, core_b: Column, percent: int) -> Column:
    close = 100 * F.least(a, b) >= percent * F.greatest(a, b)
    return close & (core_a | (a > b)) & (core_b | (b > a))


def jaccard_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, size: int = SHINGLE
) -> DataFrame:
    """(key, n_shingles, component_id) of every row.

    Rows link when 100 x shared shingles of ``size`` words >= percent x shingles of either;
    component_id is the smallest key reachable. Texts that are null or without words have no shingles and link
    with nothing. Rows with a null key are in no group and get a null component. Rows that repeat a
    key are one node; equal rows stay equal. Other columns are not read.

    Equal sets are one node. Within each index key every set is compared with the smallest node
    first; what that joins needs no further comparison, and only sets that are still in
    different components are then compared by their parity sketches: keys of few sets list their pairs,
    the others compare block by block within the key. So a group of n near copies costs about n comparisons, no link between components is
    lost, and only pairs whose sketches allow a link become rows.
    """
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("t"))
    with scratch(docs.sparkSession, "prefixes") as keep:
        # The first tokens are most of a profile and only counted, so they go when the classes are known.
        profiles = keep(_profiles(rows, percent, size).withColumnRenamed("doc", "node"))
        rows = rows.filter("doc IS NOT NULL")
        base = materialise(profiles.select("node", "n", "digest", "sketch"), "profiles")
        filled = base.filter("n > 0 AND node IS NOT NULL")
        classes = filled.groupBy("digest").agg(F.min("node").alias("node"), F.min("n").alias("n"))
        classes = materialise(classes, "classes")
        nodes = classes.select("node", "n")
        # Which sets are counted decides speed only, so a copy that the filter lets pass does no harm.
        counted = profiles.filter("n > 0 AND node IS NOT NULL").filter(maybe_in(nodes, "node")(F.col("node")))
        token_classes = _token_classes(counted, CLASS_LIMITS)

    shared = _shared_keys(rows, nodes, token_classes, percent, size)
    first = shared.filter("node <> low.node").filter(_fits("n", "core", "low.n", "low.core", percent))
    first = first.select(F.col("low.node").alias("a"), F.col("node").alias("b")).distinct()
    reps = base.join(classes.select("node", "digest"), ["node", "digest"], "left_semi")
    sketches = materialise(reps.select("node", "n", "sketch"), "sketches")
    first = materialise(_plausible(first, sketches, percent), "pairs")
    links = _verified(first, rows, percent, size)

    known = materialise(components(links), "components")
    left = shared.select("sig", "node", "n", "core").join(known, "node", "left")
    left = left.withColumn("component", F.coalesce("component", "node"))
    spread = left.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("sets"))
    mixed = materialise(left.join(spread.filter("low < high").select("sig", "sets"), "sig"), "mixed")
    few = _plausible(_of_small_keys(mixed.filter(F.col("sets") <= FEW_SETS), percent), sketches, percent)
    many = mixed.filter(F.col("sets") > FEW_SETS).join(sketches.select("node", "sketch"), "node")
    # Two sets may share many keys, so their pair is made one row before anything is joined with it.
    pairs = materialise(_within_keys(many, percent).unionByName(few).distinct(), "pairs")
    pairs = materialise(pairs.join(first, ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(_verified(pairs, rows, percent, size))

    found = materialise(components(links), "components")
    grouped = classes.select("digest", "node").join(found, "node", "left")
    grouped = grouped.select("digest", F.coalesce("component", "node").alias("component_id"))
    grouped = materialise(grouped, "grouped")
    out = base.select(F.col("node").alias(key), F.col("n").alias("n_shingles"), "digest").join(grouped, "digest", "left")
    whole = F.when(F.col(key).isNull(), F.lit(None)).otherwise(F.coalesce("component_id", F.col(key)))
    return out.select(key, "n_shingles", whole.alias("component_id"))


def op10_ngram_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies one row stays, that with the smallest doc_id, null last.

    Near copies share four fifths of their shingles of five words. Rows are told apart by doc_id
    and text, so a repeated or missing doc_id neither saves copies nor costs a text that only
    one row has. Of rows equal in both one stays; rows without words all stay.
    """
    key = F.xxhash64(F.lit("row"), "doc_id", "text").alias("_near")
    keyed = docs.select(key, "doc_id", "text")
    groups = jaccard_groups(keyed, "_near", percent=STAGE_PERCENT, size=STAGE_SHINGLE).filter("n_shingles > 0")
    members = groups.groupBy("_near").agg(F.min("component_id").alias("component"), F.count(F.lit(1)).alias("times"))
    ids = keyed.groupBy("_near").agg(F.min("doc_id").alias("doc_id"))
    members = materialise(members.join(ids, "_near"), "members")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_near")
    first = members.groupBy("component").agg(F.min(order).alias("first")).select(F.col("first._near").alias("_near"))
    gone = members.join(first, "_near", "left_anti").select("_near")
    repeated = materialise(members.join(first, "_near").filter("times > 1").select("_near"), "repeated")
    other = materialise(gone.unionByName(repeated), "gone")
    marked = docs.withColumn("_near", key)
    alone = marked.join(other, "_near", "left_anti")
    one_of = marked.join(repeated, "_near", "left_semi").dropDuplicates(["_near"])
    return alone.select(*docs.columns).unionByName(one_of.select(*docs.columns))

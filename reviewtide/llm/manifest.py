"""Merkle manifest of a dataset, proved by octopus multiproofs.

Rows are leaves. The leaves of a source form a tree of runs of ``FANOUT`` nodes, and the roots of
the sources' trees form the tree of the dataset. A level is one aggregation of the level below,
so the work falls by the fan-out from level to level, and no group holds more nodes than a run.

Proofs are made by leaf partition, a stretch of ``PART_LEAVES`` neighbouring leaves. A partition
first lists the coordinates that its leaves' proofs need and that it cannot derive itself: at
every level the run mates of the nodes above its leaves, without those nodes. Of a stretch these
are few, whatever its length: the run mates at its two ends. They are fetched in one join with
the nodes. The partition then derives all interior nodes above its leaves once, and cuts every
leaf's own proof out of them.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.llm.common import crc_fold, table
from reviewtide.plans.numbering import number_rows
from reviewtide.plans.storage import materialise

FANOUT = 16
#: Leaves of a leaf partition, whose proofs are in memory together (some 7 kB each).
PART_LEAVES = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: ``tree`` of the nodes above the sources.
TOP = -1
PROOF = "array<struct<slot: int, siblings: array<string>>>"
_POS_BITS = 40
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Manifest(NamedTuple):
    """``leaves``: rows of the input with leaf, tree, pos, width (leaves of the tree) and part.
    ``nodes``: (tree, level, pos, digest). ``sources``: (source, tree, width). ``root``: None without rows."""

    leaves: DataFrame
    nodes: DataFrame
    sources: DataFrame
    n_sources: int
    root: str | None


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each as ``-`` if null, else its length in bytes, a colon, and its value."""
    written = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for f in fields for v in [f.cast("string")]]
    return F.sha2(F.concat(*written), 256)


def _parents(level: DataFrame) -> DataFrame:
    """The next level of (tree, pos, digest, width), from the trees that are not yet at their root."""
    run = F.array_sort(F.collect_list(F.struct("pos", "digest")))
    digests = F.array_join(F.transform(run, lambda node: node["digest"]), "")
    up = level.filter("width > 1").groupBy("tree", F.expr(f"pos DIV {FANOUT}").alias("above"))
    grown = up.agg(F.sha2(digests, 256).alias("digest"), F.first("width").alias("width"))
    width = F.expr(f"(width + {FANOUT - 1}) DIV {FANOUT}").alias("width")
    return grown.select("tree", F.col("above").alias("pos"), "digest", width)


def _levels(leaves: DataFrame, widest: int) -> list[DataFrame]:
    """All levels of some trees, the leaves first, for trees of up to ``widest`` leaves."""
    levels = [leaves]
    while widest > 1:
        levels.append(materialise(_parents(levels[-1]), "level"))
        widest = -(-widest // FANOUT)
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    tops = [level.filter("width = 1").select("tree", "digest") for level in levels]
    return _union(tops)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def manifest(rows: DataFrame, key: str = "doc_id", source: str = "source", part_leaves: int = PART_LEAVES) -> Manifest:
    """The manifest of ``rows``, which have a column ``leaf``, the digest of each, and no others but
    ``key``, ``source`` and what the caller wants to keep.

    Sources are ordered by their text in bytes, null first, and a source's leaves by key, null
    first; rows of one key by leaf. Equal rows are leaves each.
    """
    name = F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("")).alias("_name")
    marked = materialise(rows.select("*", name, F.monotonically_increasing_id().alias("_tie")), "digests")
    keys = ("_name", F.col(key).asc_nulls_first(), "leaf", "_tie")
    ranked = number_rows(marked, *keys, name="_rank").drop("_tie")
    ranked = materialise(ranked.withColumn("part", F.expr(f"_rank DIV {part_leaves}")), "ranked")

    # A source's leaves in one partition: many rows of a hot source become few before any join by source.
    stretches = ranked.groupBy("part", "_name", source).agg(F.min("_rank").alias("from"), F.count(F.lit(1)).alias("n"))
    stretches = materialise(stretches, "stretches")
    sources = stretches.groupBy("_name", source).agg(F.min("from").alias("start"), F.sum("n").alias("width"))
    sources = materialise(number_rows(materialise(sources, "sources"), "_name", name="tree"), "sources")
    n_sources, widest = sources.agg(F.count(F.lit(1)), F.max("width")).first()

    own = stretches.select("part", "_name").join(sources.select("_name", "tree", "start", "width"), "_name")
    leaves = ranked.join(own, ["part", "_name"]).withColumn("pos", F.col("_rank") - F.col("start"))
    leaves = materialise(leaves.drop("_name", "_rank", "start"), "leaves")
    levels = _levels(leaves.select("tree", "pos", F.col("leaf").alias("digest"), "width"), widest or 0)
    top = _roots(levels).select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest", F.lit(n_sources).cast("long").alias("width")
    )
    above = _levels(materialise(top, "level"), n_sources)
    nodes = [
        frame.select("tree", F.lit(i).alias("level"), "pos", "digest") for part in (levels, above) for i, frame in enumerate(part)
    ]
    root = _roots(above).first()
    return Manifest(leaves, _union(nodes), sources.select(source, "tree", "width"), n_sources, root and root["digest"])


class _Nodes(NamedTuple):
    """Distinct nodes of one level, ascending; ``tree`` counts the trees of the partition from 0."""

    tree: np.ndarray
    pos: np.ndarray

    @property
    def code(self) -> np.ndarray:
        return self.tree << _POS_BITS | self.pos


def _nodes(code: np.ndarray) -> _Nodes:
    return _Nodes(code >> _POS_BITS, code & ((1 << _POS_BITS) - 1))


def _needed(nodes: _Nodes, width: np.ndarray) -> list[_Nodes]:
    """Per level the run mates of the nodes' ancestors that are no such ancestors."""
    found = []
    while True:
        # The node of a tree that has only one is its root and has no mates.
        open_ = nodes.code[width[nodes.tree] > 1]
        if not len(open_):
            return found
        above = np.unique(_Nodes(open_ >> _POS_BITS, (open_ & ((1 << _POS_BITS) - 1)) // FANOUT).code)
        runs = _nodes(above)
        mates = runs.pos[:, None] * FANOUT + np.arange(FANOUT)
        inside = mates < width[runs.tree][:, None]
        mates = _Nodes(np.broadcast_to(runs.tree[:, None], mates.shape)[inside], mates[inside]).code
        found.append(_nodes(np.setdiff1d(mates, nodes.code)))
        finished = width[nodes.tree] == 1
        nodes = _nodes(np.union1d(above, nodes.code[finished]))
        width = -(-width // FANOUT)


def _trees(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and widths of the partition's trees, and each leaf's tree, counted from 0, and place."""
    tree, pos, width = (part[c].to_numpy() for c in ("tree", "pos", "width"))
    ids, first, own = np.unique(tree, return_index=True, return_inverse=True)
    return ids, width[first], own, pos


def missing_nodes(part: pa.Table, n_sources: int) -> pa.Table:
    """(part, tree, level, pos) of the nodes that the leaves of one partition need from others."""
    ids, width, tree, pos = _trees(part)
    columns = []
    below = _needed(_nodes(np.unique(_Nodes(tree, pos).code)), width)
    above = _needed(_Nodes(np.zeros(len(ids), np.int64), ids), np.array([n_sources]))
    for named, levels in ((ids, below), (np.array([TOP]), above)):
        columns += [(named[n.tree], np.full(len(n.tree), i), n.pos) for i, n in enumerate(levels)]
    none = np.empty(0, np.int64)
    tree, level, pos = (np.concatenate([none, *c]).astype(np.int64) for c in (zip(*columns, strict=True) if columns else ([], [], [])))
    owner = pa.array(np.full(len(tree), part["part"][0].as_py()), pa.int64())
    return pa.table({"part": owner, "tree": tree, "level": pa.array(level.astype(np.int32)), "pos": pos})


class _Steps(NamedTuple):
    """One level's entries of proofs: whose, and where in the level's digests."""

    who: np.ndarray
    own: np.ndarray
    start: np.ndarray
    size: np.ndarray


def _climb(nodes: _Nodes, digests: np.ndarray, width: np.ndarray, fetched: list[tuple[_Nodes, np.ndarray]]):
    """Derive all nodes above ``nodes``: the steps of every level with its digests, the digests of
    the trees' roots, and each given node's tree."""
    at, steps = np.arange(len(nodes.tree)), []
    for more, known in fetched:
        code = np.concatenate([nodes.code, more.code])
        order = np.argsort(code)
        place = np.argsort(order)[: len(nodes.code)]
        level, every = _nodes(code[order]), np.concatenate([digests, known])[order]
        above = _Nodes(level.tree, level.pos // FANOUT).code
        starts = np.flatnonzero(np.append(True, above[1:] != above[:-1]))
        sizes = np.diff(np.append(starts, len(above)))
        run = np.cumsum(np.append(False, above[1:] != above[:-1]))
        parents = _nodes(above[starts])
        full = np.minimum(FANOUT, width[parents.tree] - parents.pos * FANOUT)
        if not (sizes == full).all():
            raise ValueError("nodes that proofs need are missing")
        rooted = width[parents.tree] == 1
        own = place[at]
        who = np.flatnonzero(width[level.tree[own]] > 1)
        steps.append((_Steps(who, own[who], starts[run[own[who]]], sizes[run[own[who]]]), every))
        digests = np.array(
            [every[s] if r else _digest(every[s : s + n]) for s, n, r in zip(starts, sizes, rooted, strict=True)], object
        )
        nodes, at, width = parents, run[own], -(-width // FANOUT)
    return steps, digests, nodes.tree[at]


def _digest(digests: np.ndarray) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _by_level(fetched: pa.Table, ids: np.ndarray, depth: int, top: bool) -> list[tuple[_Nodes, np.ndarray]]:
    tree, level, pos = (fetched[c].to_numpy() for c in ("tree", "level", "pos"))
    digest = np.array(fetched["digest"].to_pylist(), object)
    out = []
    for i in range(depth):
        mine = (level == i) & ((tree == TOP) == top)
        local = np.zeros(mine.sum(), np.int64) if top else np.searchsorted(ids, tree[mine])
        out.append((_Nodes(local, pos[mine]), digest[mine]))
    return out


def _depth(width: int) -> int:
    depth = 0
    while width > 1:
        width, depth = -(-width // FANOUT), depth + 1
    return depth


def expand_proofs(part: pa.Table, fetched: pa.Table, n_sources: int) -> pa.Table:
    """The leaves of one partition with ``subroot`` and ``proof``, from the leaves and the fetched nodes."""
    ids, width, tree, pos = _trees(part)
    order = np.lexsort((pos, tree))
    nodes = _Nodes(tree[order], pos[order])
    leaves = np.array(part["leaf"].to_pylist(), object)[order]
    low, subroots, _ = _climb(nodes, leaves, width, _by_level(fetched, ids, _depth(int(width.max())), False))
    top = _Nodes(np.zeros(len(ids), np.int64), ids)
    high, *_ = _climb(top, subroots, np.array([n_sources]), _by_level(fetched, ids, _depth(n_sources), True))

    who, own, start, size, base, digests = [], [], [], [], 0, []
    for i, (step, every) in enumerate(low + high):
        # A step of a source's root is a step of all leaves of that source.
        mine = step.who if i < len(low) else np.arange(len(leaves))
        spread = slice(None) if i < len(low) else nodes.tree
        for column, values in ((own, step.own), (start, step.start)):
            column.append(values[spread] + base)
        who.append(mine)
        size.append(step.size[spread])
        digests.append(every)
        base += len(every)
    none = np.empty(0, np.int64)
    who, own, start, size = (np.concatenate([none, *c]) for c in (who, own, start, size))
    by_leaf = np.argsort(who, kind="stable")
    who, own, start, size = (c[by_leaf] for c in (who, own, start, size))
    ends = np.cumsum(size)
    mates = np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    mates = mates[mates != np.repeat(own, size)]
    every = pa.array(np.concatenate([np.empty(0, object), *digests]).tolist(), pa.string())
    siblings = pa.ListArray.from_arrays(np.append(0, np.cumsum(size - 1)).astype(np.int32), every.take(pa.array(mates)))
    proof = pa.StructArray.from_arrays([pa.array((own - start).astype(np.int32)), siblings], ["slot", "siblings"])
    bounds = np.append(0, np.cumsum(np.bincount(who, minlength=len(leaves)))).astype(np.int32)
    out = part.take(pa.array(order)).append_column("subroot", pa.array(subroots[nodes.tree].tolist(), pa.string()))
    return out.append_column("proof", pa.ListArray.from_arrays(bounds, proof))


def prove(made: Manifest) -> DataFrame:
    """The leaves of a manifest with ``subroot`` and ``proof``: per level, from the leaf up, the node's
    ``slot`` in its run and the run's other nodes. A node alone in its run has a step without
    siblings; the only leaf of the only source has no steps."""
    n_sources, leaves = made.n_sources, made.leaves
    places = leaves.select("part", "tree", "pos", "width").groupBy("part")
    wanted = places.applyInArrow(lambda part: missing_nodes(part, n_sources), "part long, tree long, level int, pos long")
    fetched = materialise(wanted.join(made.nodes, ["tree", "level", "pos"]), "fetched")
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in leaves.schema.fields]
    schema = ", ".join([*kept, "subroot string", f"proof {PROOF}"])
    both = leaves.groupBy("part").cogroup(fetched.groupBy("part"))
    return both.applyInArrow(lambda part, nodes: expand_proofs(part, nodes, n_sources), schema)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""

    def up(digest: Column, step: Column) -> Column:
        mates, slot = step["siblings"], step["slot"]
        before, after = F.slice(mates, 1, slot), F.slice(mates, slot + 1, F.size(mates))
        return F.sha2(F.concat(F.array_join(before, ""), digest, F.array_join(after, "")), 256)

    return F.aggregate(proof, leaf, up)


def op11_octopus_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and whether its text as tampered with still folds to the root.

    Nulls are leaves like others; a null doc_id is not tampered with. Rows of one doc_id are
    leaves each, in order of their digests. No documents, no rows.
    """
    docs = table(spark, sf_dir, "documents")
    leaf = leaf_digest(*[F.col(f) for f in FIELDS])
    lowered = F.translate("text", _CAPITALS, _CAPITALS.lower())
    changed = leaf_digest(*[lowered if f == "text" else F.col(f) for f in FIELDS])
    hit = F.col("doc_id").isNotNull() & (crc_fold("doc_id", 5) == 0)
    made = manifest(docs.select("doc_id", "source", leaf.alias("leaf"), F.when(hit, changed).alias("tampered")))
    digests = F.array_join(F.flatten(F.transform("proof", lambda step: step["siblings"])), "")
    root = F.lit(made.root)
    found = prove(made).select(
        "doc_id", "leaf", "subroot", root.alias("root"), F.sha2(digests, 256).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def _oracle(levels: int = 5, top_levels: int = 4) -> str:
    """DuckDB SQL: the trees level by level, for at most 16^levels leaves a source and 16^top_levels sources."""
    lowered = f"translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}')"

    def leaf(text: str) -> str:
        fields = [text if f == "text" else f"CAST({f} AS VARCHAR)" for f in FIELDS]
        return "sha256(concat(" + ", ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + "))"

    bit = "lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END"
    byte = f"lambda h, c: list_reduce(list_concat([xor(h, c)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), {bit})"
    signs = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))"
    crc = f"xor(list_reduce(list_concat([4294967295::UBIGINT], {signs}), {byte}), 4294967295::UBIGINT)"
    parts = [
        f"""leaves AS (SELECT doc_id, source, leaf, CASE WHEN hit THEN changed ELSE leaf END AS tampered,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT doc_id, source, {leaf("text")} AS leaf, {leaf(lowered)} AS changed,
    doc_id IS NOT NULL AND coalesce({crc}, 1) % 5 = 0 AS hit FROM documents))""",
        "a0 AS (SELECT source AS tree, pos, leaf AS h, n FROM leaves)",
    ]

    def climb(name: str, depth: int) -> None:
        for i in range(depth):
            # A tree's only node is carried on as it is.
            parts.append(
                f"""{name}{i + 1} AS (SELECT tree, pos // 16 AS pos, CASE WHEN n = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h,
  (n + 15) // 16 AS n FROM {name}{i} GROUP BY tree, pos // 16, n)"""
            )
            parts.append(
                f"""{name}s{i} AS (SELECT x.tree, x.pos, x.n, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS before,
  coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS after
  FROM {name}{i} x JOIN {name}{i} y ON x.tree IS NOT DISTINCT FROM y.tree AND x.pos // 16 = y.pos // 16 GROUP BY x.tree, x.pos, x.n)"""
            )

    climb("a", levels)
    parts.append(
        f"b0 AS (SELECT 0 AS tree, tree AS source, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, h, count(*) OVER () AS n FROM a{levels})"
    )
    climb("b", top_levels)
    joins, proof, fold = ["JOIN b0 ON b0.source IS NOT DISTINCT FROM leaves.source"], [], ["tampered AS f0"]
    steps = [(f"as{i}", f"{16 ** i}", "leaves") for i in range(levels)] + [(f"bs{i}", f"{16 ** i}", "b0") for i in range(top_levels)]
    for i, (name, size, owner) in enumerate(steps):
        same = f"{name}.tree IS NOT DISTINCT FROM leaves.source AND " if owner == "leaves" else ""
        joins.append(f"JOIN {name} ON {same}{name}.pos = {owner}.pos // {size}")
        proof.append(f"{name}.before || {name}.after")
        fold.append(f"CASE WHEN {name}.n = 1 THEN f{i} ELSE sha256({name}.before || f{i} || {name}.after) END AS f{i + 1}")
    columns = f"doc_id, leaf, b0.h AS subroot, (SELECT h FROM b{top_levels}) AS root, sha256({' || '.join(proof)}) AS proof_sha256"
    return f"""WITH {", ".join(parts)},
folds AS (SELECT {columns}, {", ".join(fold)} FROM leaves {" ".join(joins)})
SELECT doc_id, leaf, subroot, root, proof_sha256, f{len(steps)} AS folded_root, f{len(steps)} = root AS verified FROM folds"""


ORACLE_SQL = _oracle()

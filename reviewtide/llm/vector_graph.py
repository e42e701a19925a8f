"""Near duplicates among embeddings by a robust-pruned flat graph.

Vectors are assigned to their nearest cluster centres, several each, so that clusters overlap. In every
cluster's shard a graph is built whose edges are robust-pruned; the edge lists of a vector from
its shards are united. Then each vector is searched for in the shard of its nearest centre: greedily
from the shard's medoid, and from where that ends on through all neighbours in range. Found pairs
are verified by their exact cosine. An audit compares the links of a bounded set of vectors with
brute force over all rows; if too few were found, the overlap is doubled and the graph built again.
Where the largest overlap finds too few as well, all pairs in reach of each other are compared, which
loses none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.llm.common import components, hash_order, table
from reviewtide.plans.storage import materialise

THRESHOLD = 0.95
#: Neighbours down to this cosine below the threshold are followed.
RANGE = 0.07
DEGREE = 16
CANDIDATES = 48
ALPHA = 1.2
SHARD_ROWS = 2000
OVERLAP = 4
FIT_ROWS = 20_000
AUDIT_ROWS = 512
RECALL = 0.95
MAX_OVERLAP = 24
#: Rows and components (rows x dimensions) of a block of the exact comparison.
BLOCK_ROWS = 8192
BLOCK_CELLS = 1 << 21
_CELLS = 4_000_000
_HOPS = 64


def _prepare(rows: DataFrame) -> DataFrame:
    """(vec_id, digest, unit) of the vectors that can link: unit vectors as bytes of doubles.

    Vectors are null-free, finite and not zero, and of the most frequent length.
    """
    lengths = rows.groupBy(F.size("v").alias("n")).count().filter("n > 0")
    common = lengths.orderBy(F.desc("count"), "n").limit(1).collect()
    dims = common[0]["n"] if common else 0
    kind = rows.schema["vec_id"].dataType.simpleString()

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, digests, units = [], [], []
            for vec_id, raw in zip(batch["vec_id"], batch["v"], strict=True):
                vector = np.array([np.nan if x is None else x for x in raw], np.float64)
                if len(vector) == dims and np.isfinite(vector).all() and vector.any():
                    vector = vector / np.abs(vector).max()
                    ids.append(vec_id)
                    digests.append(hashlib.blake2b((vector + 0.0).tobytes(), digest_size=16).digest())
                    units.append((vector / np.linalg.norm(vector)).tobytes())
            yield pd.DataFrame({"vec_id": pd.Series(ids, dtype=batch["vec_id"].dtype), "digest": digests, "unit": units})

    usable = rows.filter("vec_id IS NOT NULL AND v IS NOT NULL")
    return usable.mapInPandas(prepare, f"vec_id {kind}, digest binary, unit binary")


def _matrix(units) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def _centres(nodes: DataFrame, shard_rows: int) -> np.ndarray:
    """Spherical k-means on a bounded sample, the first ``FIT_ROWS`` in hash order."""
    count = nodes.count()
    share = min(1.0, 1.2 * FIT_ROWS / max(1, count))
    near = nodes.filter(F.pmod(hash_order("node"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    got = near.select("unit").orderBy(hash_order("node")).limit(FIT_ROWS).collect()
    if not got:
        return np.zeros((0, 1))
    sample = _matrix([r["unit"] for r in got])
    k = int(np.clip(-(-count // shard_rows), 1, max(1, len(sample) // 8)))
    centres = sample[:k].copy()
    for _ in range(10):
        near = np.concatenate([(part @ centres.T).argmax(axis=1) for part in np.array_split(sample, 20)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        norms = np.linalg.norm(sums, axis=1)
        centres[norms > 0] = sums[norms > 0] / norms[norms > 0, None]
    return centres


def _assigned(nodes: DataFrame, centres: np.ndarray, overlap: int) -> DataFrame:
    """Adds ``shards``, the nearest centres of each vector, the home first."""
    shared = nodes.sparkSession.sparkContext.broadcast(centres)

    @F.pandas_udf("array<int>")
    def nearest(units: pd.Series) -> pd.Series:
        if not len(units):
            return pd.Series([], dtype=object)
        found = np.argsort(-(_matrix(units.tolist()) @ shared.value.T), axis=1, kind="stable")
        return pd.Series(list(found[:, :overlap].astype(np.int32)))

    return nodes.withColumn("shards", nearest("unit"))


def _robust_prune(vectors: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Of each row's candidates, nearest first, up to ``DEGREE`` that no kept one stands for.

    A candidate goes when ``ALPHA`` times its squared distance to a kept one is below that to the node.
    -1 fills rows and marks no candidate.
    """
    out = np.full((len(near), DEGREE), -1)
    each = max(1, _CELLS // (near.shape[1] * max(near.shape[1], vectors.shape[1])))
    for at in range(0, len(near), each):
        some = near[at : at + each]
        own = vectors[at : at + each]
        other = vectors[some]
        far = 1 - np.einsum("nd,ncd->nc", own, other)
        between = 1 - other @ other.transpose(0, 2, 1)
        alive = some >= 0
        row = np.arange(len(some))
        for place in range(DEGREE):
            first = alive.argmax(axis=1)
            any_left = alive[row, first]
            if not any_left.any():
                break
            out[at : at + each, place] = np.where(any_left, some[row, first], -1)
            alive &= ~((ALPHA * between[row, first] <= far) & any_left[:, None])
            alive[row, first] = False
    return out


def shard_graph(vectors: np.ndarray) -> np.ndarray:
    """Robust-pruned neighbours of every vector of a shard, with edges back up to as many."""
    n = len(vectors)
    width = min(CANDIDATES, n - 1)
    if width < 1:
        return np.full((n, 1), -1)
    near = np.empty((n, width), np.int64)
    each = max(1, _CELLS // n)
    for at in range(0, n, each):
        cosine = vectors[at : at + each] @ vectors.T
        cosine[np.arange(len(cosine)), np.arange(at, at + len(cosine))] = -2
        some = np.argpartition(-cosine, width - 1, axis=1)[:, :width]
        order = np.argsort(-np.take_along_axis(cosine, some, axis=1), axis=1, kind="stable")
        near[at : at + each] = np.take_along_axis(some, order, axis=1)
    kept = _robust_prune(vectors, near)
    return np.concatenate([kept, _backward(kept)], axis=1)


def _backward(kept: np.ndarray) -> np.ndarray:
    """Up to ``DEGREE`` edges towards each node, reversed."""
    source, place = np.nonzero(kept >= 0)
    target = kept[source, place]
    order = np.lexsort((place, target))
    source, target = source[order], target[order]
    first = np.flatnonzero(np.append(True, target[1:] != target[:-1])) if len(target) else np.empty(0, int)
    rank = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
    out = np.full_like(kept, -1)
    some = rank < DEGREE
    out[target[some], rank[some]] = source[some]
    return out


def range_search(vectors: np.ndarray, edges: np.ndarray, queries: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, other) of rows with cosine >= threshold, in blocks of queries.

    Each query walks greedily from the medoid to the nearest row it can reach; from there and from
    itself the search goes on through every row within ``RANGE`` of the threshold.
    """
    medoid = int((vectors @ vectors.mean(axis=0)).argmax())
    n, width = edges.shape
    each = int(np.clip(_CELLS // max(n, width * vectors.shape[1]), 1, 1024))
    for at in range(0, len(queries), each):
        query = queries[at : at + each]
        own, row = vectors[query], np.arange(len(query))
        here = np.full(len(query), medoid)
        best = own @ vectors[medoid]
        for _ in range(_HOPS):
            around = edges[here]
            cosine = np.einsum("qd,qwd->qw", own, vectors[around])
            cosine[around < 0] = -2
            step = cosine.argmax(axis=1)
            better = cosine[row, step] > best
            if not better.any():
                break
            here = np.where(better, around[row, step], here)
            best = np.where(better, cosine[row, step], best)
        seen = np.zeros((len(query), n), bool)
        seen[row, query] = True
        seen[row, here] = True
        found = [(row[here != query], here[here != query])]
        front = (np.concatenate([row, row]), np.concatenate([query, here]))
        while len(front[0]):
            around = edges[front[1]]
            who = np.repeat(front[0], width)[around.ravel() >= 0]
            node = around.ravel()[around.ravel() >= 0]
            key = np.unique(who * n + node)
            who, node = key // n, key % n
            new = ~seen[who, node]
            who, node = who[new], node[new]
            seen[who, node] = True
            cosine = np.concatenate(
                [np.einsum("pd,pd->p", own[who[i : i + 65536]], vectors[node[i : i + 65536]]) for i in range(0, max(1, len(who)), 65536)]
            )
            found.append((who, node))
            far = cosine >= threshold - RANGE
            front = (who[far], node[far])
        who, node = (np.concatenate(c) for c in zip(*found, strict=True))
        cosine = np.concatenate(
            [np.einsum("pd,pd->p", own[who[i : i + 65536]], vectors[node[i : i + 65536]]) for i in range(0, max(1, len(who)), 65536)]
        )
        linked = cosine >= threshold  # the exact cosine decides
        yield query[who[linked]], node[linked]


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Unite the sets of rows a and b; ``root`` names each row's set by its smallest row."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while (root[root] != root).any():
            root = root[root]


def _search_shard(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Per vector of a shard the links that this shard counts, and a row it is connected with."""
    rows = rows.sort_values("node", ignore_index=True)
    shard = int(rows["shard"].iloc[0])
    ids = rows["node"].to_numpy()
    vectors, copies = _matrix(rows["unit"].tolist()), rows["copies"].to_numpy(np.int64)
    lists = rows["edges"].tolist()
    flat = np.concatenate([np.asarray(x, ids.dtype) for x in lists]) if lists else ids[:0]
    owner = np.repeat(np.arange(len(ids)), [len(x) for x in lists])
    at = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
    here = ids[at] == flat
    owner, at = owner[here], at[here]
    counts = np.bincount(owner, minlength=len(ids))
    edges = np.full((len(ids), max(1, counts.max(initial=0))), -1)
    edges[owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)] = at
    member = rows["shards"].tolist()
    home = np.array([s[0] for s in member])
    width = max(map(len, member))
    listed = np.array([[*s, *([-1] * (width - len(s)))] for s in member])
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    own = np.flatnonzero(home == shard)
    place = np.full(len(ids), -1)
    place[own] = np.arange(len(own))
    found = np.zeros((len(own), len(own)), bool)
    for a, b in range_search(vectors, edges, own, threshold):
        inside = place[b] >= 0
        found[place[a[inside]], place[b[inside]]] = True
        # Both homes may find a pair. It counts in the smaller of the homes that hold both.
        there = (home[b] < shard) & (listed[a] == home[b][:, None]).any(axis=1)
        c, d = a[~inside & ~there], b[~inside & ~there]
        np.add.at(links, c, copies[d])
        np.add.at(links, d, copies[c])
        kept = inside | ~there
        root = _joined(root, a[kept], b[kept])
    found |= found.T.copy()
    for at in range(0, len(own), 1024):
        links[own[at : at + 1024]] += found[at : at + 1024] @ copies[own]
    return pd.DataFrame({"node": ids, "links": links, "root": ids[root]})


def _linked(nodes: DataFrame, threshold: float, overlap: int, shard_rows: int) -> DataFrame:
    """(node, links, root) rows of all shards: links to add up, and edges that connect."""
    kind = nodes.schema["node"].dataType.simpleString()
    assigned = materialise(_assigned(nodes, _centres(nodes, shard_rows), overlap), "assigned")
    member = assigned.select("node", "unit", F.explode("shards").alias("shard"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        ids = rows["node"].to_numpy()
        edges = shard_graph(_matrix(rows["unit"].tolist()))
        return pd.DataFrame({"node": ids, "edges": [ids[e[e >= 0]] for e in edges]})

    graph = member.groupBy("shard").applyInPandas(build, f"node {kind}, edges array<{kind}>")
    united = graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("edges"))).alias("edges"))
    whole = assigned.join(materialise(united, "graph"), "node")
    whole = whole.select("node", "unit", "copies", "shards", "edges", F.explode("shards").alias("shard"))
    found = whole.groupBy("shard").applyInPandas(
        lambda rows: _search_shard(rows, threshold), f"node {kind}, links long, root {kind}"
    )
    return materialise(found, "found")


def _compared(pair: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Per vector of two blocks the links between them (within, if they are one), and a row it is connected with."""
    pair = pair.sort_values("node", ignore_index=True)
    ids, copies = pair["node"].to_numpy(), pair["copies"].to_numpy(np.int64)
    vectors = _matrix(pair["unit"].tolist())
    one = bool((pair["p"] == pair["q"]).all())
    left = np.flatnonzero(pair["block"] == pair["p"])
    right = left if one else np.flatnonzero(pair["block"] == pair["q"])
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    other = vectors[right]
    each = max(1, _CELLS // max(1, len(right)))
    for at in range(0, len(left) if len(right) else 0, each):
        some = left[at : at + each]
        near = vectors[some] @ other.T >= threshold
        if one:
            near[np.arange(len(some)), np.arange(at, at + len(some))] = False
        links[some] += near @ copies[right]
        if not one:
            links[right] += near.T @ copies[some]
        a, b = np.nonzero(near & (root[some][:, None] != root[right]))
        root = _joined(root, some[a], right[b])
    linked = (links > 0) | one  # every vector has at least the row of its own block
    return pd.DataFrame({"node": ids[linked], "links": links[linked], "root": ids[root[linked]]})


def _compare_all(nodes: DataFrame, threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(node, links, root) rows as of ``_linked``, from every pair that can reach the threshold.

    Vectors lie in blocks of their nearest centre, each of about ``block_rows`` rows. Two linked
    vectors are at most sqrt(2 - 2 threshold) apart, and the bisector of two centres parts their
    rows, so a vector can link only into the centres whose bisector is no farther from it. It
    goes to the pairs of its block with all blocks of those centres; both ends of a link meet there.
    """
    kind = nodes.schema["node"].dataType.simpleString()
    first = nodes.select("unit").first()
    dims = len(first["unit"]) // 8 if first else 1
    block_rows = min(block_rows, max(256, BLOCK_CELLS // dims))
    centres = _centres(nodes, block_rows)
    apart = np.array([np.linalg.norm(centres - c, axis=1) for c in centres])
    context = nodes.sparkSession.sparkContext
    shared = context.broadcast((centres, apart))
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))

    @F.pandas_udf("array<int>")
    def in_reach(units: pd.Series) -> pd.Series:
        points, between = shared.value
        out = []
        for at in range(0, len(units), 1024):
            cosine = _matrix(units.iloc[at : at + 1024].tolist()) @ points.T
            home = cosine.argmax(axis=1)
            near = cosine.max(axis=1)[:, None] - cosine <= radius * between[home] + 1e-9
            out += [np.append(h, np.flatnonzero(r)).astype(np.int32) for h, r in zip(home, near, strict=True)]
        return pd.Series(out, dtype=object)

    reached = materialise(nodes.withColumn("reach", in_reach("unit")), "reach")
    blocks = np.zeros(len(centres), np.int64)
    for row in reached.groupBy(F.col("reach")[0].alias("home")).agg(F.count(F.lit(1)).alias("n")).collect():
        blocks[row["home"]] = -(-row["n"] // block_rows)
    shared_starts = context.broadcast(np.append(0, np.cumsum(blocks)))

    @F.pandas_udf("array<int>")
    def own_and_others(reach: pd.Series, point: pd.Series) -> pd.Series:
        start, out = shared_starts.value, []
        for (home, *near), at in zip(reach, point, strict=True):
            own = start[home] + at % (start[home + 1] - start[home])
            out.append(np.concatenate([[own], *[np.arange(start[c], start[c + 1]) for c in near]]).astype(np.int32))
        return pd.Series(out, dtype=object)

    placed = reached.withColumn("blocks", own_and_others("reach", F.xxhash64(F.lit("block"), "node")))
    placed = placed.select("node", "unit", "copies", F.col("blocks")[0].alias("block"), F.explode(F.expr("slice(blocks, 2, size(blocks))")).alias("other"))
    met = placed.withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")}).drop("other").groupBy("p", "q")
    found = met.applyInPandas(lambda pair: _compared(pair, threshold), f"node {kind}, links long, root {kind}")
    return materialise(found, "found")


def audit_recall(nodes: DataFrame, links: DataFrame, threshold: float, rows: int = AUDIT_ROWS) -> float:
    """Share of the true links, by brute force, of the first ``rows`` nodes in hash order that were found."""
    asked = nodes.select("node", "unit").orderBy(hash_order("node")).limit(rows).collect()
    if not asked:
        return 1.0
    shared = nodes.sparkSession.sparkContext.broadcast(_matrix([r["unit"] for r in asked]))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = _matrix(batch["unit"].tolist()) @ shared.value.T >= threshold if len(batch) else np.zeros((0, 1), bool)
            row, query = np.nonzero(near)
            sums = np.bincount(query, weights=batch["copies"].to_numpy()[row], minlength=len(asked))
            yield pd.DataFrame({"query": np.flatnonzero(sums), "n": sums[sums > 0].astype(np.int64)})

    true = nodes.select("unit", "copies").mapInPandas(count, "query long, n long").groupBy("query").agg(F.sum("n").alias("n"))
    true = {r["query"]: r["n"] for r in true.collect()}
    wanted = nodes.sparkSession.createDataFrame([(r["node"], i) for i, r in enumerate(asked)], "node long, query long")
    got = nodes.join(F.broadcast(wanted), "node").join(links, "node", "left")
    got = {r["query"]: (r["links"] or 0, r["copies"]) for r in got.select("query", "links", "copies").collect()}
    have = sum(min(n, true.get(q, 0) - own) for q, (n, own) in got.items())
    all_true = sum(true.get(q, 0) - own for q, (_, own) in got.items())
    return have / all_true if all_true > 0 else 1.0


def near_vectors(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = THRESHOLD,
    overlap: int = OVERLAP,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Per row: key, n_links, component_id, kept.

    Vectors with cosine >= ``threshold`` link; component_id is the smallest key reachable and
    kept marks that row. Vectors that are null, zero, hold a null or non-finite component or are not of
    the most frequent length link with nothing. Equal vectors are one node and link with each
    other. Rows with a null key link with nothing and are kept false. A repeated key counts as
    further copies. Other columns are not read.

    A shard counts its links and keeps a spanning forest, so pairs never leave a task. If no
    overlap up to ``MAX_OVERLAP`` passes the audit, every pair in reach is compared; should that fail the
    audit as well, an error is raised.
    """
    raw = rows.select(F.col(key).alias("vec_id"), F.col(vector).alias("v"))
    prepared = materialise(_prepare(raw), "vectors")
    classes = prepared.groupBy("digest").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    classes = materialise(classes, "vector-classes")
    first = prepared.join(classes.select(F.col("node").alias("vec_id"), "digest", "copies"), ["vec_id", "digest"])
    nodes = materialise(first.groupBy(F.col("vec_id").alias("node")).agg(F.first("unit").alias("unit"), F.first("copies").alias("copies")), "nodes")
    recall = 0.0
    while recall < RECALL:
        exact = overlap > MAX_OVERLAP
        found = _compare_all(nodes, threshold) if exact else _linked(nodes, threshold, overlap, shard_rows)
        links = materialise(found.groupBy("node").agg(F.sum("links").alias("links")), "link-counts")
        recall = audit_recall(nodes, links, threshold)
        if exact and recall < RECALL:
            raise RuntimeError(f"only {recall:.4f} of the audited links were found")
        overlap *= 2
    edges = found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    known = components(edges)
    of_class = classes.join(links, "node").join(known, "node", "left").select(
        "digest", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")
    )
    of_class = materialise(of_class, "class-links")
    members = prepared.select("vec_id", "digest").join(of_class, "digest")
    members = members.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = raw.select("vec_id").join(materialise(members, "members"), "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        F.col("vec_id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )


def op6_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))

import hashlib
import zlib

import pytest
from llm.cases import documents, odd_documents
from pyspark.sql import functions as F

from reviewtide.llm import manifest
from reviewtide.llm.common import share_library

SMALL = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.fixture(autouse=True)
def library(spark):
    share_library(spark)


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    doc_id, text, lang, source, n_chars = row
    fields = (doc_id, source, lang, n_chars, text)
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def _tree(digests):
    """The root, and for each digest its proof as (digests before, digests after) per level."""
    level, at, proofs = list(digests), list(range(len(digests))), [[] for _ in digests]
    while len(level) > 1:
        for i, a in enumerate(at):
            first = a // 16 * 16
            proofs[i].append((level[first:a], level[a + 1 : first + 16]))
        at = [a // 16 for a in at]
        level = [_h(*level[i : i + 16]) for i in range(0, len(level), 16)]
    return level[0], proofs


def brute_manifest(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append((row, _leaf(row)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        by_source[source].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[source] = _tree([leaf for _, leaf in by_source[source]])
    root, tops = _tree([trees[s][0] for s in order])
    out = []
    for source, top in zip(order, tops, strict=True):
        subroot, proofs = trees[source]
        for (row, leaf), proof in zip(by_source[source], proofs, strict=True):
            steps = proof + top
            fold = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1] is not None:
                fold = _leaf((row[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1]), *row[2:]))
            for before, after in steps:
                fold = _h(*before, fold, *after)
            siblings = [d for before, after in steps for d in before + after]
            out.append((row[0], leaf, subroot, root, _h(*siblings), fold, fold == root))
    return sorted(out, key=str)


def _query(spark, monkeypatch, rows, part_leaves=None, clashing=False):
    df = documents(spark, rows, clashing)
    monkeypatch.setattr(manifest, "table", lambda *_: df)
    if part_leaves:
        monkeypatch.setattr(manifest.manifest, "__defaults__", ("doc_id", "source", part_leaves))
    out = manifest.op11_octopus_manifest(spark, SMALL)
    return sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=str)


def _rows(sizes):
    rows = []
    for s, n in enumerate(sizes):
        name = None if s == 3 else "é" * s if s < 3 else f"s{s}"
        rows += [(len(rows) * 7 % 1009, f"Text {s} {i}", "en" if i % 3 else None, name, i) for i in range(n)]
    return rows


@pytest.mark.parametrize(
    ("sizes", "part_leaves"),
    [([1], 10), ([16], 10), ([17], 10), ([300], 7), ([300], 1000), ([1] * 40, 9), ([260, 1, 2, 17, *[3] * 20, 33], 50), ([1, 1], 1)],
)
def test_manifest_equals_brute_force(spark, monkeypatch, sizes, part_leaves):
    rows = _rows(sizes)
    got = _query(spark, monkeypatch, rows, part_leaves)
    assert got == brute_manifest(rows)
    assert {r[-1] for r in got} >= {True}


def test_odd_repeated_and_empty_tables(spark, monkeypatch):
    rows = [*odd_documents(), *[(None, None, None, "hot", None)] * 60, *[(5, "Same", "en", "hot", 4)] * 60]
    assert _query(spark, monkeypatch, rows, 16, clashing=True) == brute_manifest(rows)
    assert _query(spark, monkeypatch, []) == []


def test_partitions_fetch_few_nodes_and_each_once(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.sha2(F.col("id").cast("string"), 256).alias("leaf")
    )
    made = manifest.manifest(rows, part_leaves=250)
    assert [r["n"] for r in made.leaves.groupBy("part").agg(F.count("*").alias("n")).collect()] == [250] * 12
    for part in made.leaves.select("part", "tree", "pos", "width").toArrow().to_pandas().groupby("part"):
        import pyarrow as pa

        wanted = manifest.missing_nodes(pa.Table.from_pandas(part[1], preserve_index=False), 1).to_pandas()
        assert len(wanted) <= 2 * 15 * 3 and not wanted.duplicated().any()
    proved = manifest.prove(made)
    assert proved.filter(manifest.folded(F.col("leaf"), F.col("proof")) != made.root).count() == 0
    forged = F.sha2(F.lit("x"), 256)
    assert proved.filter(manifest.folded(forged, F.col("proof")) == made.root).count() == 0


def test_missing_nodes_are_an_error(spark):
    rows = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.sha2(F.lit("x"), 256).alias("leaf"))
    made = manifest.manifest(rows, part_leaves=10)
    broken = made._replace(nodes=made.nodes.filter("NOT (level = 0 AND pos = 15)"))
    with pytest.raises(Exception, match="missing"):
        manifest.prove(broken).collect()

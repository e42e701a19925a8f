import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.cases import brute_groups, brute_repeats, documents, odd_documents, varied_documents

from reviewtide.llm import ngram_join, substrings, vector_graph
from reviewtide.llm.common import components, share_library
from reviewtide.plans import storage


@pytest.fixture(autouse=True)
def library(spark):
    share_library(spark)


def _by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


REPEATS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("hot", [substrings.HOT_STRINGS, 1])
def test_repeats_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings.repeated_spans, "__defaults__", (8, hot))
    rows = varied_documents()
    got = _by_id(substrings.remove_repeats(documents(spark, rows, clashing=True)), *REPEATS)
    assert got == brute_repeats([r[:2] for r in rows])
    assert any(v[1] for v in got.values())


def test_repeats_of_odd_rows(spark):
    rows = odd_documents()
    out = substrings.remove_repeats(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    want = brute_repeats([r[:2] for r in rows if r[0] is not None and r[0] != 7])
    for row in out:
        if row["doc_id"] in want:
            assert tuple(row[c] for c in REPEATS) == want[row["doc_id"]]
    assert [r["n_removed"] for r in out if r["doc_id"] is None] == [0, 0]
    assert substrings.remove_repeats(documents(spark, [])).count() == 0


def test_runs_cover_every_window_once_in_any_piece(monkeypatch):
    data = np.frombuffer(bytes(np.random.default_rng(1).integers(97, 100, 5000)), np.uint8)
    whole = substrings.runs(data)
    monkeypatch.setattr(substrings, "_PIECE", 700)
    for key, start, end, anchor in (whole, substrings.runs(data)):
        windows = [s for a, b in zip(start, end) for s in range(a, b - substrings.LENGTH + 1)]
        assert windows == list(range(len(data) - substrings.LENGTH + 1))
        assert ((anchor >= start) & (anchor <= end)).all()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("ab", min_size=6, max_size=14), min_size=2, max_size=12), st.data())
def test_later_windows_equal_comparison(texts, data):
    length = 4
    strings = [t.encode() for t in texts]
    lead = np.array([data.draw(st.integers(0, len(t) - length)) for t in texts])
    later = substrings.later_windows(strings, lead, np.arange(len(strings)), length)
    for i, text in enumerate(strings):
        for back in range(lead[i] + 1):
            at = lead[i] - back
            window = text[at : at + length]
            earlier = any(
                lead[j] >= back and len(window) == length and strings[j][lead[j] - back :][:length] == window
                for j in range(i)
            )
            assert later[i, back] == earlier


@pytest.mark.parametrize(("percent", "size"), [(90, 3), (80, 5)])
def test_groups_equal_brute_force(spark, monkeypatch, percent, size):
    rows = varied_documents(n=120)
    want, links = brute_groups([r[:2] for r in rows], percent, size)
    assert links > 20
    for limits in (ngram_join.CLASS_LIMITS, (1, 2)):
        monkeypatch.setattr(ngram_join, "CLASS_LIMITS", limits)
        got = ngram_join.jaccard_groups(documents(spark, rows, clashing=True), percent=percent, size=size)
        assert _by_id(got, "n_shingles", "component_id") == want


def test_groups_of_odd_rows(spark):
    rows = odd_documents()
    out = ngram_join.jaccard_groups(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out if r["doc_id"] is not None}
    want, _ = brute_groups([r[:2] for r in rows if r[0] is not None])
    assert got == want
    assert got[8] == (2, 7) and got[2] == (0, 2)
    assert [r["component_id"] for r in out if r["doc_id"] is None] == [None, None]
    assert ngram_join.jaccard_groups(documents(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 2**32 - 1), st.sampled_from([80, 90]))
def test_similar_sets_share_an_index_key(n, gone, more, seed, percent):
    rng = np.random.default_rng(seed)
    pool = ngram_join.mix(rng.integers(0, 2**63, n + more).astype(np.uint64))
    classes = rng.choice([1, 2, 3], 1 << ngram_join.CLASS_BITS, p=rng.dirichlet([0.4] * 3)).astype(np.uint8)
    x, y = np.unique(pool[:n]), np.unique(pool[min(gone, n - 1) :])
    shared = len(np.intersect1d(x, y))
    if 100 * shared < percent * (len(x) + len(y) - shared):
        return
    if len(x) > len(y):
        x, y = y, x
    own = ngram_join.signatures(x, classes, percent, smaller=True)
    assert len(np.intersect1d(own, ngram_join.signatures(y, classes, percent)))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def _vectors(n=900, dims=16):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(n, dims))
    for i in range(0, n, 3):
        base[i] = base[(i // 30) * 30] + rng.normal(scale=0.08, size=dims)
    base[10:14] = base[9]
    return base


@pytest.mark.parametrize("shard_rows", [2000, 150])
def test_vectors_against_brute_force(spark, shard_rows):
    base = _vectors()
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    odd = [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] * 16), (9003, [None] * 16), (9004, [1.0]), (None, rows[9][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS copies")
    out = vector_graph.near_vectors(df, shard_rows=shard_rows).collect()
    assert len(out) == len(rows) + len(odd)
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    got = np.array([{r["vec_id"]: r["n_links"] for r in out}[i] for i in range(len(base))])
    assert (got <= true).all() and true.sum() > 1000
    assert got.sum() >= 0.9 * true.sum()
    for row in out:
        if row["vec_id"] is None or row["vec_id"] >= 9000:
            assert row["n_links"] == 0 and row["component_id"] == row["vec_id"]
        assert row["kept"] == (row["vec_id"] is not None and row["vec_id"] == row["component_id"])


def test_crowded_vectors_beyond_any_overlap(spark, monkeypatch):
    """A third of the rows lie close together but unequal, in far more clusters than the overlap."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=(2400, 32))
    base[:800] = base[0] + rng.normal(scale=0.15, size=(800, 32))
    base[900:1200:2] = base[901:1201:2] + rng.normal(scale=0.1, size=(150, 32))
    base[1300:1304] = base[1299]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(base)], "vec_id long, embedding array<double>")
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    true = near.sum(axis=1) - 1
    assert true[:800].sum() > 300_000 and true[900:1200].sum() >= 200
    root = np.arange(len(base))
    for a, b in zip(*np.nonzero(near), strict=True):
        root[root == max(root[a], root[b])] = min(root[a], root[b])
    monkeypatch.setattr(vector_graph, "MAX_OVERLAP", 1)
    out = {r["vec_id"]: r for r in vector_graph.near_vectors(df, shard_rows=20, overlap=1).collect()}
    assert [out[i]["n_links"] for i in range(len(base))] == true.tolist()
    assert [out[i]["component_id"] for i in range(len(base))] == root.tolist()


@pytest.mark.parametrize("block_rows", [8192, 70])
def test_exact_comparison_in_any_blocks(spark, block_rows):
    base = _vectors(700)
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    rows = [(i, bytearray(u.tobytes()), 1 + i % 3) for i, u in enumerate(unit)]
    nodes = spark.createDataFrame(rows, "node long, unit binary, copies long")
    found = vector_graph._compare_all(nodes, 0.95, block_rows).groupBy("node").sum("links").collect()
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    assert dict(map(tuple, found)) == dict(enumerate((near @ np.array([r[2] for r in rows])).tolist()))


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_graph.near_vectors(empty).count() == 0


@pytest.mark.parametrize(("few", "many"), [(1, 3), (4, 3), (1 << 20, 1024)])
def test_keys_listed_or_compared_in_blocks_give_the_same_groups(spark, monkeypatch, few, many):
    rows = varied_documents(n=120)
    want, links = brute_groups([r[:2] for r in rows], 80, 5)
    assert links > 20
    monkeypatch.setattr(ngram_join, "FEW_SETS", few)
    monkeypatch.setattr(ngram_join, "KEY_SETS", many)
    got = ngram_join.jaccard_groups(documents(spark, rows), percent=80, size=5)
    assert _by_id(got, "n_shingles", "component_id") == want


def test_groups_keep_no_table_of_all_keys_prefixes_or_sets(spark, tmp_path, monkeypatch):
    """What grows with the words of all texts, not with the sets or the keys that they share, is gone when it was used."""
    monkeypatch.setattr(storage, "shared_dir", lambda spark: str(tmp_path))
    rows = varied_documents(n=60) + [(1000 + i, " ".join(f"only{i}x{j}" for j in range(200)), "en", "s", 1) for i in range(30)]
    want, _ = brute_groups([r[:2] for r in rows], 80, 5)
    got = ngram_join.jaccard_groups(documents(spark, rows), percent=80, size=5)
    assert _by_id(got, "n_shingles", "component_id") == want
    tables = [spark.read.parquet(str(p)) for p in (tmp_path / "reviewtide").iterdir() if list(p.glob("*.parquet"))]
    assert tables and not any({"prefix", "tokens"} & set(t.columns) for t in tables)
    keyed = [t for t in tables if "sig" in t.columns and "node" in t.columns]
    assert keyed and all(t.filter("node >= 1000").isEmpty() for t in keyed)

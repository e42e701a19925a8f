import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
import tokenizers
from llm.cases import documents, odd_documents

from reviewtide.llm import alignment
from reviewtide.llm.common import share_library

SMALL = "/root/testdata/sf0.001"
FILES = [f"{alignment.TOKENIZERS}/{name}" for name in (alignment.BYTE_LEVEL, alignment.PIECES)]


@pytest.fixture(autouse=True)
def library(spark):
    share_library(spark)


def _plain():
    """Both vocabularies by their own libraries: text -> [(id, bytes)]."""
    one = tokenizers.Tokenizer.from_file(FILES[0])
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    signs = alignment._printable_bytes()

    def piece(i):
        sign = two.id_to_piece(i)
        return bytes([int(sign[3:5], 16)]) if two.is_byte(i) else sign.replace("▁", " ").encode()

    return (
        lambda text: [(i, bytes(signs[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids],
        lambda text: [(i, piece(i)) for i in two.encode(text)],
    )


def _spans(tokens):
    at, out = 0, []
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute_alignment(rows):
    """One result per (doc_id, text), by comparing all tokens of a text with all others."""
    one, two = _plain()
    linked, out = [], []
    for _, text in rows:
        a, b = (one(text), two(text)) if text else ([], [])
        whole = b" " + (text or "").encode()
        if not text or any(b"".join(d for _, d in side) != whole for side in (a, b)):
            linked.append(([], [], []))
            continue
        a, b = _spans(a), _spans(b)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for end in cuts:
            halves = [",".join(str(i) for i, s, e in side if start < e <= end) for side in (a, b)]
            groups.append("|".join(halves))
            start = end
        linked.append((links, groups, (len(a), len(b))))
    counts = Counter(pair for links, *_ in linked for pair in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    for (doc_id, _), (links, groups, sizes) in zip(rows, linked, strict=True):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(counts[p] == most[p[1]] for p in links)
        out.append((doc_id, *(sizes or (0, 0)), len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _texts():
    rng = random.Random(5)
    pool = ["the", " cat", "\n\n", "ünïcode", "漢字", "🙂🙂", "<|endoftext|>", "<s>", "0x41", "    ", "don't", "\t", "antidisestablishmentarianism", "▁"]
    texts = ["".join(rng.choice(pool[:-1]) + rng.choice(["", " "]) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    return [*texts, texts[0], "a▁b", "<0x41>", "\x00", "x" * 500, "the the the"]


def _query(spark, monkeypatch, df, hot_pairs=None):
    monkeypatch.setattr(alignment, "table", lambda *_: df)
    if hot_pairs is not None:
        monkeypatch.setattr(alignment.link_sums, "__defaults__", (hot_pairs,))
    out = alignment.op13_shared_cuts(spark, SMALL)
    assert out.columns == list(COLUMNS) or set(out.columns) == set(COLUMNS)
    assert {t for c, t in out.dtypes if c not in ("doc_id", "groups_sha256")} == {"bigint"}
    return sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=str)


@pytest.mark.parametrize("hot_pairs", [None, 0, 40])
def test_alignment_equals_comparison_of_all_tokens(spark, monkeypatch, hot_pairs):
    rows = list(enumerate(_texts()))
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert _query(spark, monkeypatch, df.repartition(3), hot_pairs) == brute_alignment(rows)


def test_given_documents_equal_comparison_of_all_tokens(spark, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if len(r["text"]) < 1500]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _query(spark, monkeypatch, df) == brute_alignment(rows)


def test_odd_and_empty_documents(spark, monkeypatch):
    rows = odd_documents()
    short = [r for r in rows if not r[1] or len(r[1]) < 5000]
    got = _query(spark, monkeypatch, documents(spark, short, clashing=True))
    assert got == brute_alignment([r[:2] for r in short])
    whole = _query(spark, monkeypatch, documents(spark, rows))
    assert len(whole) == len(rows) and max(r[1] for r in whole) > 40_000
    assert _query(spark, monkeypatch, documents(spark, [])) == []


def test_bytes_that_are_no_utf8_have_no_tokens(spark):
    df = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    row = alignment.align_tokens(df).first()
    assert (row["n_a"], row["n_b"], row["groups"], row["links"]) == (0, 0, [], [])


def test_cuts_of_random_ends():
    rng = np.random.default_rng(1)
    for n in (1, 2, 50, 3000):
        for share in (0.02, 0.3, 0.9):
            ends = np.arange(1, n + 1)
            a, b = (np.unique(np.append(ends[rng.random(n) < share], n)) for _ in range(2))
            cuts = alignment.shared_cuts(a, b, np.array([0]), np.array([len(a)]))
            assert a[cuts].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_both_encoders_of_the_byte_level_file_agree():
    model = Path(FILES[0]).read_bytes()
    plain = tokenizers.Tokenizer.from_file(FILES[0])
    plain.encode_special_tokens = True
    fast = alignment.byte_level(model)
    for text in [*_texts(), *(f" a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}\n{chr(c)}  " for c in range(0, 0x3000, 7))]:
        assert fast.ids([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids

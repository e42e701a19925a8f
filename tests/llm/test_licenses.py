import random
import re

import pytest
from llm.cases import documents, odd_documents

from reviewtide.llm import licenses

SMALL = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_base(text):
    """n_words, n_base, first_word, last_word, base_labels by trying every place."""
    words, found = _words(text), []
    for t in licenses.BASE:
        phrase = t.text.split()
        found += [(p, t.label) for p in range(len(words)) if words[p : p + len(phrase)] == phrase]
    places = [p for p, _ in found]
    return (len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({n for _, n in found})))


def brute_scores(texts):
    """labels and score of every text: all starts of all templates, with the rarest words counted over all texts."""
    listed = [_words(t) for t in texts]
    files = {}
    for words in listed:
        for w in set(words):
            files[w] = files.get(w, 0) + 1
    out = []
    for words in listed:
        found = []
        for t in licenses.TEMPLATES:
            own, key = _words(t.text), _words(t.key)
            at = next(p for p in range(len(own)) if own[p : p + len(key)] == key)
            looked = sorted({w for w in own if w in words}, key=lambda w: (files[w], w))[: licenses.RARE]
            for start in range(-len(own), len(words)):
                there = [0 <= start + p < len(words) and words[start + p] == w for p, w in enumerate(own)]
                agree = {w for p, w in enumerate(own) if there[p] and w in looked}
                if all(there[at : at + len(key)]) and 2 * len(agree) >= len(looked) and 2 * sum(there) >= len(own):
                    found.append((t.label, sum(there) / len(own)))
        out.append((",".join(sorted({n for n, _ in found})), max((s for _, s in found), default=0.0)))
    return out


def _query(spark, monkeypatch, df):
    monkeypatch.setattr(licenses, "table", lambda *_: df)
    out = licenses.op12_rare_token_licenses(spark, SMALL)
    types = dict(out.dtypes)
    assert [types[c] for c in COLUMNS[1:]] == ["bigint"] * 4 + ["string"] * 2 + ["double"]
    return sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=str)


def _expected(rows):
    scores = brute_scores([r[1] for r in rows])
    return sorted(((r[0], *brute_base(r[1]), *s) for r, s in zip(rows, scores, strict=True)), key=str)


def test_scan_equals_trying_every_place(spark, monkeypatch):
    rng = random.Random(2)
    texts = ["MIT License", "the MIT\nLicense; mit-license. MIT  LİCENSE", "mit licenses", "Apache License apache License 2", "K"]
    for t in licenses.TEMPLATES:
        words = t.text.split()
        texts.append("before " + t.text + " after the Software")
        for _ in range(6):
            changed = [w if rng.random() > 0.2 else rng.choice(["x", "license", "software", "the"]) for w in words]
            cut = changed[rng.randrange(3) : len(words) - rng.randrange(3)]
            texts.append(" ".join(cut) + rng.choice(["", " mit license " * 3, " general public license"]))
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = _query(spark, monkeypatch, documents(spark, rows))
    assert got == _expected(rows)
    assert {label for r in got for label in r[6].split(",")} >= {t.label for t in licenses.TEMPLATES}


def test_odd_repeated_and_empty_documents(spark, monkeypatch):
    rows = [*odd_documents(), *[(5, "Released under the MIT License.", "en", "s", 3)] * 2, (60, "mit license " * 3000, "en", "s", 3)]
    assert _query(spark, monkeypatch, documents(spark, rows, clashing=True)) == _expected(rows)
    assert _query(spark, monkeypatch, documents(spark, [])) == []


def test_matches_hold_places(spark):
    df = spark.createDataFrame([(1, "So: Licensed under CC BY-NC 4.0. Done")], "doc_id long, text string")
    files, matches = licenses.license_matches(df)
    assert [(r["label"], r["start"], r["size"], r["share"]) for r in matches.collect()] == [("cc-by-nc", 1, 7, 1.0)]
    assert files.columns == ["doc_id", "row", "n_words"]


def test_a_key_phrase_must_be_in_its_text():
    with pytest.raises(ValueError, match="key phrase"):
        licenses.postings((licenses.Template("x", "some words", "other"),))

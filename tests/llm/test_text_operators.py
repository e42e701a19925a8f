import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from llm.cases import documents, odd_documents, targets_of, varied_documents

from reviewtide.llm import decontamination, langid, mixing, quality, secrets, toxicity, urls
from reviewtide.llm.common import BATCH_BYTES, BATCH_LIMIT, bound_batches, labelled_sample, share_library

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def library(spark):
    share_library(spark)


# Decontamination.


def _edits(pattern, text):
    """Fewest edits of pattern against any substring of text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_leaks_equal_alignment_of_every_fragment():
    rng = random.Random(4)
    item = "".join(rng.choice("abcdefgh ") for _ in range(200))
    index = decontamination.index_items([("i", item)])
    parts = ["".join(map(chr, c)) for c in index.codes]
    for case in range(40):
        copied = list(item[rng.randrange(60) : 120 + rng.randrange(80)])
        for _ in range(case % 9):
            at = rng.randrange(len(copied))
            copied[at : at + rng.randrange(2)] = rng.choice(["", "x", "yz"])
        text = "".join(rng.choice("abcdefgh ") for _ in range(150)) + "".join(copied) + " end " * 9
        folded = "".join(map(chr, decontamination.folded(text)[0]))
        want = {f for f, p in enumerate(parts) if _edits(p, folded) <= index.edits[f]}
        found = decontamination.find_leaks(index, text)
        assert (found[0][1] if found else 0) == len(want)


def test_passages_of_the_stated_length_are_found_at_every_offset():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
    index = decontamination.index_items([("i", " ".join(words))])
    around = "unrelated prose before and after the passage, " * 3
    for size in (decontamination.WORDS, 17):
        for at in range(len(words) - size + 1):
            passage = " ".join(words[at : at + size])
            assert decontamination.find_leaks(index, around + passage + " " + around), (size, at, len(passage))
    assert not decontamination.find_leaks(index, around + " ".join(words[20:26]) + " " + around)
    solid = "".join(rng.choice("abcdefghijklmnop") for _ in range(300))
    index = decontamination.index_items([("i", solid)])
    for at in range(300 - 88 + 1):
        assert decontamination.find_leaks(index, around + solid[at : at + 88] + " " + around), at


def test_leaks_of_odd_rows(spark):
    docs = documents(spark, [*odd_documents(), (50, "x " + "the quick brown  FOX " * 6, "en", "s0", 1)], clashing=True)
    bench = spark.createDataFrame(
        [(1, "The quick brown fox " * 5), (2, None), (3, ""), (None, "short"), (4, "one")], "item_id long, text string"
    )
    found = decontamination.leaks(docs, bench, block_chars=40)
    assert len(found) > 1
    hits = [r for c in found for r in docs.select("doc_id", c.alias("h")).collect() if r["h"]]
    assert [(r["doc_id"], r["h"][0]["item"]) for r in hits] == [(50, 1)]
    none = decontamination.leaks(documents(spark, []), bench.limit(0))
    assert documents(spark, []).select(*none).count() == 0


# Classifiers.


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = langid.op9_language_centroids(spark, SMALL).join(docs, "doc_id").filter("held_out").toPandas()
    assert (out["lang"] == out["lang_pred"]).mean() > 0.98
    assert not out["rejected"].any()
    assert out["score"].between(0, 1).all()


def test_language_of_odd_rows(spark):
    docs = documents(spark, odd_documents(), clashing=True)
    for model in (None, langid.fit_languages(docs)):
        out = {r["doc_id"]: r["p"] for r in docs.select("doc_id", langid.identify(model).alias("p")).collect()}
        assert out[1]["lang"] == out[2]["lang"] == out[3]["lang"] == "und"
        assert out[1]["score"] == 0 and out[1]["rejected"]
        assert out[10]["lang"] == ("fr" if model else "und")
    assert langid.fit_languages(documents(spark, [])) is None


def test_foreign_script_is_rejected(spark):
    model = langid.fit_languages(spark.read.parquet(f"{SMALL}/documents.parquet"))
    got = langid.predict(model, pd.Series(["漢字仮名交じり文の例です" * 20, "the thing is that " * 20]))
    assert got["rejected"].tolist() == [True, False]


@pytest.mark.parametrize(
    ("query", "label", "least"),
    [(toxicity.op3_toxicity, "toxic", 0.93), (quality.op4_quality, "quality", 0.93)],
)
def test_classifiers_on_held_out_labels(spark, query, label, least):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    out = query(spark, SMALL).toPandas()
    assert out["score"].between(0, 1).all() and len(out) == 1000
    held = out[out["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert (held["predicted"] == held[label]).mean() >= least


def test_classifiers_on_odd_rows(spark):
    docs = documents(spark, odd_documents(), clashing=True)
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (4, 1), (5, 0), (5, 1), (7, None), (None, 1), (77, 0)], "doc_id long, toxic int"
    )
    for given in (labels, labels.limit(0), labels.filter("toxic = 1")):
        sample = labelled_sample(docs, given, "toxic", 100)
        for column in (
            toxicity.toxic_score(toxicity.fit_toxicity(sample)),
            quality.quality_score(quality.fit_quality(sample, steps=1)),
        ):
            scores = [r["s"] for r in docs.select(column.alias("s")).collect()]
            assert len(scores) == len(odd_documents()) and all(0 <= s <= 1 for s in scores)


def test_chunks_cover_every_byte():
    for n in (0, 1, 255, 256, 257, 496, 497, 1000):
        rows = quality.chunks("a" * n)
        assert rows.shape[1] == quality.CHUNK
        covered = {i * quality.STRIDE + j for i, row in enumerate(rows) for j, v in enumerate(row) if v}
        assert covered == set(range(n))


def test_network_gradients():
    rng = np.random.default_rng(0)
    f64 = np.float64
    model = quality.QualityModel(
        rng.normal(size=(257, quality.EMBED)).astype(f64),
        rng.normal(size=(quality.WIDTH * quality.EMBED, quality.FILTERS)).astype(f64),
        np.zeros(quality.FILTERS), rng.normal(size=3 * quality.FILTERS) * 0.1, np.zeros(1),
    )
    docs = [quality.chunks("abc !! " * 90), quality.chunks("xyz " * 20)]
    y, w = np.array([1.0, 0.0]), np.array([0.7, 0.3])

    def loss():
        p = [quality.document_scores(model, pd.Series([t]))[0] for t in ("abc !! " * 90, "xyz " * 20)]
        return -(w * (y * np.log(p) + (1 - y) * np.log(1 - np.array(p)))).sum()

    for part, gradient in zip(model.parameters(), quality._gradients(model, docs, y, w), strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        old, step = part[at], 1e-5
        part[at] = old + step
        high = loss()
        part[at] = old - step
        low = loss()
        part[at] = old
        assert gradient[at] == pytest.approx((high - low) / (2 * step), rel=2e-2)


# URL rules.


def test_urls_by_brute_force(spark):
    listed = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/a?x=/en/", "https://example.com/en", "ftp://a.example.com/en/x#y",
        "http://net/es/1", "http://x.net/fr/", "http://xnet/fr/", "http://a..com/", "http://com", "http://com?/", "http://ex\nample.com/\nen/",
        "http://www.example.com//en/", "x://y://z.com/a", "http://" + "a." * 3000 + "com/" + "en/" * 3000,
    ]
    rows = [(i, u) for i, u in enumerate(listed)] + [(0, None), (None, "http://www.example.com/en/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS verdict", "3 AS prefix")

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in urls.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        return (host, path, best[0] + best[1], best[2]) if best else (host, path, None, "allow")

    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    out = urls.judge_urls(pages, rules).collect()
    got = sorted(((str(r[0]), tuple(r[1:])) for r in out), key=str)
    assert got == sorted(((str(i), judge(u)) for i, u in rows), key=str)
    assert urls.judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urls.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


# Secrets.


def test_base_spans_follow_the_patterns():
    text = (
        'password:token:abcdefghijklmn API_KEY = "abcdefghijkl" apikey=short secret : \'0123456789abcdef\' '
        "AKIA1234567890ABCD AKIAAKIA1 deadbeefdeadbeef00 ſecret=abcdefghijklmnop"
    )
    assign = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    want = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 12]
    want += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    want += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    assert secrets.base_spans(text) == want and len(want) == 5
    found = secrets.scan(text)
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(want, key=lambda s: (s[1], secrets.KINDS.index(s[0]))))
    assert found[4] == hashlib.sha256(listed.encode()).hexdigest()


def test_guess_cost_orders_values():
    cost = secrets.guess_cost
    assert cost("") == 0
    weak = ["password123", "qwertyuiop", "19990101", "aaaaaaaaaaaa", "abcabcabcabc", "P@ssw0rd!", "letmein2020", "8a5e8all", "wh47ever"]
    assert max(map(cost, weak)) < secrets.MIN_COST < cost("xK9#mP2$vL")
    assert cost("a1" * 4000) > 0
    assert secrets.scan("pwd: xK9#mP2$vL9q.")[3] == 1
    assert secrets.scan("pwd: password123, token: changeme")[3] == 0


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("pwd=xqzkvjwpbfmd", "xqzkvjwpbfmd"),
        ("private_key: XQZKVJWPBFMD", "XQZKVJWPBFMD"),
        ("pin: xK9$q!Z", "xK9$q!Z"),
        ('userPassword = "xK9#mP2$vL"', "xK9#mP2$vL"),
        ("dbSecret: xK9#mP2$vL", "xK9#mP2$vL"),
        ("Authorization: Bearer eyJhbGciOi.J9x_Q2", "eyJhbGciOi.J9x_Q2"),
        ("authorization=eyJhbGciOi.J9x_Q2", "eyJhbGciOi.J9x_Q2"),
        ("'Authorization': 'Basic dXNlcjpwYXNz'", "dXNlcjpwYXNz"),
        ("send Bearer eyJhbGciOi.J9x_Q2", "eyJhbGciOi.J9x_Q2"),
        ("auth: Bearer eyJhbGciOi.J9x_Q2", "eyJhbGciOi.J9x_Q2"),
    ],
)
def test_guess_cost_alone_decides_in_a_context(text, value):
    at = text.index(value)
    assert secrets.guessed_spans(text, []) == [("guess", at, at + len(value))]


@pytest.mark.parametrize("text", ["pin: 1234", "pwd: qwertyuiop", "Authorization: Bearer <token>", "Authorization: Bearer", "the bearer of it"])
def test_cheap_values_and_schemes_are_no_secrets(text):
    assert secrets.guessed_spans(text, []) == []


def _cheapest(value: str, ranked: dict[str, float]) -> float:
    """All segmentations into spans one after the other, each span at its own least cost."""
    each = secrets._space(value)
    near = secrets._tables()[1]

    def spans(part: str) -> list[float]:
        costs, n, lower = [], len(part), part.lower()
        if n >= 2 and (word := secrets._word_cost(part, ranked)) is not None:
            costs.append(word)
        # The pattern's alternatives are tried in order at a place, so only the first counts.
        if (found := secrets._DATE.match(value, value_at)) and found.end() == value_at + n:
            costs.append(math.log10(365 * 100) if n > 4 else 2.0)
        walks = all(b in near.get(a, ()) or abs(ord(a) - ord(b)) == 1 for a, b in zip(lower, lower[1:]))
        if n >= 3 and walks:
            costs.append(math.log10(len(near) * 4 * n))
        for size in range(1, n // 2 + 1):
            if n % size == 0 and part == part[:size] * (n // size):
                unit = size * each
                if size > 1 and (word := secrets._word_cost(part[:size], ranked)):
                    unit = min(unit, word)
                costs.append(unit + math.log10(n // size))
        return costs

    best = len(value) * each
    for cuts in itertools.product((False, True), repeat=len(value) - 1):
        edges = [0, *[i + 1 for i, cut in enumerate(cuts) if cut], len(value)]
        total = 0.0
        for value_at, end in itertools.pairwise(edges):
            named = [c + math.log10(2) for c in spans(value[value_at:end])]
            total += min([*named, (end - value_at) * each])
        best = min(best, total)
    return best


def test_guess_cost_equals_all_segmentations():
    rng = random.Random(7)
    parts = ["pass", "love", "qwe", "123", "aaa", "1999", "0704", "abab", "x", "K", "9", "#", "Fox", "f0x", "zebra"]
    ranked = {"fox": 1.5, "zebra": 2.5, "ab": 1.0}
    values = ["".join(rng.choices(parts, k=3))[:10] for _ in range(60)]
    values += ["".join(rng.choices("ab1q#wK", k=rng.randrange(1, 9))) for _ in range(60)]
    for value in values:
        assert secrets.guess_cost(value, ranked) == pytest.approx(_cheapest(value, ranked)), value


def test_words_of_the_corpus_are_cheap_and_copied_secrets_are_not(spark):
    phrases = ["compass: northwesterly winds", "pin: photograph", "bypass: Philadelphia"]
    prose = ["a photograph of northwesterly Philadelphia", "", None, "une étoile filante", "word " * 50_000]
    planted = "secret: vqzxjkwpfh"
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([*phrases, *prose, *[planted] * 300])]
    docs = documents(spark, rows, clashing=True)
    ranks = secrets.word_ranks(docs)
    assert "vqzxjkwpfh" not in ranks.value and "étoile" in ranks.value and ranks.value["word"] == math.log10(2)
    out = {r["doc_id"]: r["s"] for r in docs.select("doc_id", secrets.secret_scan(ranks=ranks).alias("s")).collect()}
    assert [out[i]["n_guess"] for i in range(len(rows))] == [0] * 8 + [1] * 300
    assert out[1]["max_cost"] < secrets.MIN_COST <= out[8]["max_cost"] and out[3]["max_cost"] is None
    assert len(secrets.word_ranks(docs, size=2).value) == 2
    assert secrets.word_ranks(docs.limit(0)).value == {}
    kept = secrets.drop_secrets(spark, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == set(range(8))


def test_secrets_of_odd_rows(spark):
    docs = documents(spark, odd_documents(), clashing=True)
    out = docs.select("doc_id", secrets.secret_scan().alias("s")).collect()
    assert all(r["s"]["spans"] == "" and r["s"]["n_assign"] == 0 for r in out)
    assert documents(spark, []).select(secrets.secret_scan()).count() == 0


# Mixing.


@pytest.mark.parametrize("rows", [varied_documents(n=90), odd_documents()])
def test_mix_meets_the_targets(spark, rows):
    docs = documents(spark, rows, clashing=True)
    out = [r.asDict() for r in mixing.mix_sources(docs).collect()]
    assert len(out) == len({(r[0], r[3], len((r[1] or "").split())) for r in rows})
    distinct = list({(r[0], r[1], r[2], r[3], r[4]) for r in rows})
    for source, (words, target) in targets_of(distinct).items():
        own = [r for r in out if r["source"] == source]
        assert {r["source_size"] for r in own} == {words}
        assert own[0]["target"] == pytest.approx(target)
        assert abs(sum(r["taken"] for r in own) - target) <= max(r["size"] for r in own)
        assert all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for r in own)
    again = [r.asDict() for r in mixing.mix_sources(docs).collect()]
    assert sorted(map(str, out)) == sorted(map(str, again))


def _repeating_documents():
    """Rows without ids, ids with several texts of one length, and rows that repeat as a whole."""
    rows = [(None, f"hot {i} a b", "en", "s0", 9) for i in range(40)] + [(None, "same same", "en", "s0", 9)] * 5
    rows += [(1, f"one {i} of few", "en", "s1", 9) for i in range(7)] + [(2, "equal rows here", "en", "s1", 9)] * 6
    return rows + [(10 + i, "word " * (1 + i % 9), "de", f"s{i % 3}", 9) for i in range(50)]


def test_mix_counts_every_row(spark, tmp_path):
    rows = _repeating_documents()
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = [r.asDict() for r in mixing.op8_entropy_mix(spark, str(tmp_path)).collect()]
    key = lambda d, s, n: (str(d), s, n)
    want = sorted(key(r[0], r[3], len(r[1].split())) for r in rows)
    assert sorted(key(r["doc_id"], r["source"], r["size"]) for r in out) == want
    for source, (words, target) in targets_of(rows).items():
        own = [r for r in out if r["source"] == source]
        assert {r["source_size"] for r in own} == {words}
        assert abs(sum(r["taken"] for r in own) - target) <= max(r["size"] for r in own)
    # Without every_row only rows of one id and text are one document.
    few = mixing.mix_sources(documents(spark, rows)).groupBy("doc_id").count().filter("doc_id IS NULL OR doc_id < 3").collect()
    assert {r["doc_id"]: r["count"] for r in few} == {None: 45, 1: 7, 2: 1}


def test_stage_takes_every_row_as_counted(spark):
    rows = _repeating_documents()
    out = mixing.take_mix(spark, documents(spark, rows, clashing=True), SMALL).collect()
    for source, (_, target) in targets_of(rows).items():
        sizes = [len(r["text"].split()) for r in out if r["source"] == source]
        assert abs(sum(sizes) - target) <= 9
    times = Counter((r[0], r[1], r[3]) for r in rows)
    taken = Counter((r["doc_id"], r["text"], r["source"]) for r in out)
    assert all(n <= 2 * times[k] for k, n in taken.items()) and {r["copy_no"] for r in out} == {1, 2}


def test_rates_solve_the_dual(spark):
    """The tilted rates of every source: min(2, exp(dual x size / mean size)) with its target as sum."""
    cells = spark.createDataFrame([("0a", s, 3) for s in (1, 5, 40, 300)] + [("0b", s, 2) for s in (2, 9, 80)], "key string, size long, n long")
    for share in (0.4, 1.2, 1.9):
        words = {"0a": 3 * 346, "0b": 2 * 91}
        docs = {"0a": 12, "0b": 6}
        targets = spark.createDataFrame([(k, share * words[k], words[k], docs[k]) for k in words], "key string, target double, words long, docs long")
        for row in mixing._balanced(cells, targets, 2.0).collect():
            sizes = np.array([r["size"] for r in cells.filter(cells.key == row["key"]).collect()], float)
            n = 3 if row["key"] == "0a" else 2
            rates = np.minimum(2, np.exp(row["dual"] * sizes / row["mean"]))
            assert (n * sizes * rates).sum() == pytest.approx(share * words[row["key"]], rel=1e-6)


def test_mix_of_nothing(spark):
    assert mixing.mix_sources(documents(spark, [])).count() == 0


def test_batches_are_bounded_unless_the_session_says_so(spark):
    before = spark.conf.get(BATCH_LIMIT, None)
    long = [(i, "x" * (3 * BATCH_BYTES) if i == 1 else "password: Zq8#vT2!xLw9") for i in range(4)]
    try:
        spark.conf.unset(BATCH_LIMIT)
        bound_batches(spark)
        assert spark.conf.get(BATCH_LIMIT) == str(BATCH_BYTES)
        docs = spark.createDataFrame(long, "doc_id long, text string").coalesce(1)
        found = docs.select("doc_id", secrets.secret_scan()["n_guess"].alias("n"), "text").collect()
        assert {r["doc_id"]: (r["n"], len(r["text"])) for r in found} == {i: (int(i != 1), len(t)) for i, t in long}
        spark.conf.set(BATCH_LIMIT, "1m")
        bound_batches(spark)
        assert spark.conf.get(BATCH_LIMIT) == "1m"
    finally:
        spark.conf.unset(BATCH_LIMIT)
        if before is not None:
            spark.conf.set(BATCH_LIMIT, before)


def test_counts_of_very_long_texts_are_kept_whole():
    for n in (1, 65_535, 70_001, 400_000):
        counts = langid.term_frequencies("ab " * n)[0]
        assert counts.max() >= n
        assert langid.unpacked(langid.packed(counts)).tolist() == counts.tolist()

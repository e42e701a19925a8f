"""Small tables and brute-force versions that the tests of the llm subpackage share."""

import hashlib
import random
import re
from collections import Counter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use within, as further columns of the input.
CLASHES = ("n", "size", "key", "doc", "t", "node", "component", "label", "copies", "sig", "maybe", "score")

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def varied_documents(seed=3, n=60):
    """Documents with exact copies, near copies, shared passages and a hot group."""
    rng = random.Random(seed)
    passage = " ".join(words_of(rng, 40))
    texts = [" ".join(words_of(rng, rng.randrange(1, 200))) for _ in range(n)]
    hot = words_of(rng, 300)
    for i in range(n):
        kind = i % 6
        if kind == 0:
            texts[i] = texts[(i + 7) % n]
        elif kind == 1:
            cut = texts[i].split()
            at = rng.randrange(len(cut) + 1)
            texts[i] = " ".join(cut[:at] + [passage] + cut[at:])
        elif kind == 2:
            near = list(hot)
            for _ in range(rng.randrange(0, 8) // 2):
                near[rng.randrange(len(near))] = f"x{rng.randrange(9)}"
            texts[i] = " ".join(near)
    return [(100 + i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]


def odd_documents():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977} next{i % 31}" for i in range(20_000))
    return [
        (None, None, None, None, None),
        (None, "a text without an id", "en", "s0", 3),
        (1, None, "en", "s0", 0),
        (2, "", None, "s0", 0),
        (3, " \n\t ", "en", None, 4),
        (4, long, "en", "s1", len(long)),
        (5, "one", "de", "s1", 3),
        (6, "one two", "de", "s1", 7),
        (7, "one two three four", "de", "s2", 18),
        (7, "one two three four", "de", "s2", 18),
        (8, "one two three four", "de", "s2", 18),
        (9, "12345 67890 !!! 漢字 🙂", "en", "s3", 20),
        (10, "É" * 300, "fr", "s3", 300),
    ]


def documents(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, DOCS)
    if clashing:
        for i, name in enumerate(CLASHES):
            df = df.selectExpr("*", f"{i} AS {name}")
    return df


def brute_repeats(rows, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def shingle_set(text, size=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size))))


def brute_groups(rows, percent=90, size=3):
    """doc_id -> (n_shingles, component_id), and the number of links."""
    sets = {d: shingle_set(t, size) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links, ids = 0, sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                links += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}, links


def targets_of(rows, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0):
    """source -> (words, target)."""
    words = Counter()
    for _, text, _, source, *_ in rows:
        words[source] += len(WORD.findall(text or ""))
    order = sorted((s for s in words if s is not None), key=lambda s: s.encode()) + ([None] if None in words else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, target = share * sum(words.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= most * words[s]}
        if not over:
            return {s: (words[s], target.get(s, weight[s] * level)) for s in order}
        for s in over:
            target[s] = most * words[s]
            left -= target[s]
        free -= over
    return {s: (words[s], target[s]) for s in order}

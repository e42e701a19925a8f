"""Secret scan: fixed patterns, and a guess-cost search on values in credential contexts."""

from __future__ import annotations

import functools
import hashlib
import math
import re

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.llm.common import table
from reviewtide.operators.features import vocabulary
from reviewtide.plans.storage import materialise

#: Kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "guess")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16

#: Words of the corpus that are ranked for guessing, the most frequent ones; at most 32 letters each, so
#: the table that goes to all tasks has a bounded size.
RANKED_WORDS = 50_000
#: A value found by its context is a secret from this guess cost (log10) on.
MIN_COST = 9.0
#: Values are searched whole in windows of this length; costs of the windows add up.
WINDOW = 128
MAX_PART = 32

_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# Runs are taken whole, so a shortest length in the pattern drops the same runs as a later test.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (MIN_ACCESS - 4))
_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
#: A keyword, also at the end of a name but not of a plain word (dbSecret, not compass), with a value
#: assigned, or the Authorization or Bearer form. The scheme of a header is never its value.
_CONTEXT = re.compile(
    r"(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))"
    r"(?ai:(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api_?key|access_?key|private_?key|auth|authorization|"
    r"credentials?|bearer|pin)[\"']?\x20*[:=]\x20*[\"']?(?:(?:bearer|basic|digest|negotiate|token)\x20+)?+|"
    r"(?<![A-Za-z])bearer\x20+)[\"']?([^\s\"'<>,;]+)"
)
#: The same contexts for Spark, whose patterns know no ``a`` flag, and a word that stands alone.
_CONTEXT_SQL = _CONTEXT.pattern.replace("(?ai:", "(?i:")
_ASSIGN_SQL = _ASSIGN.pattern.replace("(?ai:", "(?i:")
_WORD_SQL = r"(?<![\p{L}\p{N}_])\p{L}{2,%d}(?![\p{L}\p{N}_])" % MAX_PART
_SCHEMES = ("bearer", "basic", "digest", "negotiate")

#: Frequent passwords and words in them, most frequent first.
COMMON_WORDS = (
    "password 123456 qwerty admin welcome letmein login master hello freedom whatever monkey dragon "
    "football baseball iloveyou princess sunshine shadow superman batman trustno1 secret changeme "
    "default guest root user test demo example sample dummy placeholder none null true false "
    "undefined redacted hidden required optional string value token key pass passwd passphrase "
    "summer winter spring autumn january february march april may june july august september "
    "october november december monday tuesday wednesday thursday friday saturday sunday love money "
    "apple orange banana cookie coffee computer internet server system service database public "
    "private access account office company home family friend mother father sister brother baby "
    "angel star moon sun fire water earth wind magic power king queen prince knight hunter killer "
    "the and you that have for not with this but his from they say her she will one all would there "
    "their what out about who get which when make can like time just him know take people into year "
    "your good some could them see other than then now look only come its over think also back after "
    "use two how our work first well way even new want because any these give day most us is to of in"
).split()

#: Rows of the keyboards that walks follow.
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
#: Digits and signs written for letters.
_LEET = str.maketrans("@48301!$57", "aabeoiisst")

_DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]|[1-9])"
    r"|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)?\d\d"
    r"|(?:19|20)\d\d"
)


@functools.cache
def _tables() -> tuple[dict[str, float], dict[str, set[str]]]:
    """Word costs by rank, and the neighbours of each key."""
    words = {w: math.log10(i + 1) for i, w in reversed(list(enumerate(COMMON_WORDS, 1)))}
    near: dict[str, set[str]] = {}
    for y, row in enumerate(KEY_ROWS):
        for x, key in enumerate(row):
            around = {row[x - 1]} if x else set()
            around |= set(row[x + 1 : x + 2])
            for other in (y - 1, y + 1):
                if 0 <= other < len(KEY_ROWS):
                    around |= set(KEY_ROWS[other][max(0, x - 1) : x + 2])
            near[key] = around
    return words, near


def _word_cost(part: str, ranked: dict[str, float]) -> float | None:
    """Cost of a span as one word: by its rank in the fixed list or, if it is less, in the corpus."""
    words, _ = _tables()

    def of(word: str) -> float | None:
        return min((t[word] for t in (words, ranked) if word in t), default=None)

    lower = part.lower()
    cost = of(lower)
    if cost is None:
        cost = of(lower.translate(_LEET))
        if cost is None:
            return None
        cost += math.log10(4)
    return cost + (0 if part == lower else math.log10(2 if part in (lower.title(), lower.upper()) else 8))


def _space(part: str) -> float:
    """log10 of the alphabet of a span of characters."""
    size = 0
    size += 26 * any("a" <= c <= "z" for c in part)
    size += 26 * any("A" <= c <= "Z" for c in part)
    size += 10 * any("0" <= c <= "9" for c in part)
    size += 33 * any(not c.isalnum() and c < "\x80" for c in part)
    size += 100 * any(c >= "\x80" for c in part)
    return math.log10(size)


def guess_cost(value: str, ranked: dict[str, float] = {}) -> float:
    """log10 of the guesses that an attacker needs: the cheapest segmentation of ``value``.

    Spans are common words and the ``ranked`` words of a corpus with their costs (also in capitals
    or with digits for letters), dates, a character or block repeated, keyboard walks, and brute force over the alphabet of the value. Each further
    span costs the choice of where it begins. Values beyond ``WINDOW`` characters are the sum
    of their windows; the empty value costs 0.
    """
    if len(value) > WINDOW:
        return sum(guess_cost(value[i : i + WINDOW], ranked) for i in range(0, len(value), WINDOW))
    n, each = len(value), _space(value) if value else 0.0
    lower, (_, near) = value.lower(), _tables()
    dates = {}
    for start in range(n):
        if found := _DATE.match(value, start):
            dates.setdefault(start, []).append(found.end())
    walk = [1] * n  # length of the keyboard walk that ends at each place
    for i in range(1, n):
        if lower[i] in near.get(lower[i - 1], ()) or abs(ord(lower[i]) - ord(lower[i - 1])) == 1:
            walk[i] = walk[i - 1] + 1
    best = [0.0] + [math.inf] * n
    split = math.log10(2)
    ends: dict[int, list[tuple[int, float]]] = {}
    for start, stops in dates.items():
        for stop in stops:
            ends.setdefault(stop, []).append((start, math.log10(365 * 100) if stop - start > 4 else 2.0))
    for end in range(1, n + 1):
        best[end] = best[end - 1] + each
        for start, cost in ends.get(end, ()):
            best[end] = min(best[end], best[start] + cost + split)
        length = walk[end - 1]
        for size in range(3, length + 1):
            best[end] = min(best[end], best[end - size] + math.log10(len(near) * 4 * size) + split)
        for size in range(2, min(end, MAX_PART) + 1):
            cost = _word_cost(value[end - size : end], ranked)
            if cost is not None:
                best[end] = min(best[end], best[end - size] + cost + split)
        for block in range(1, min(end // 2, MAX_PART) + 1):
            unit, count = value[end - block : end], 1
            while value[max(0, end - (count + 1) * block) : end - count * block] == unit:
                count += 1
                base = min(block * each, _word_cost(unit, ranked) or math.inf) if block > 1 else each
                best[end] = min(best[end], best[end - count * block] + base + math.log10(count) + split)
    return best[n]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns: leftmost, not overlapping within a kind."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def _context_values(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of values in credential contexts that no base span touches."""
    found = []
    for m in _CONTEXT.finditer(text):
        start = m.start(1)
        value = m[1].rstrip(".)]}")
        end = start + len(value)
        if value.lower() not in _SCHEMES and not any(s < end and start < e for _, s, e in base):
            found.append((start, end))
    return found


def guessed_spans(
    text: str, base: list[tuple[str, int, int]], ranked: dict[str, float] = {}
) -> list[tuple[str, int, int]]:
    """Values in credential contexts that no base span touches and that are dear to guess, by their cost alone."""
    values = _context_values(text, base)
    return [("guess", a, b) for a, b in values if guess_cost(text[a:b], ranked) >= MIN_COST]


def _listed(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def scan(text: str | None, ranked: dict[str, float] = {}) -> tuple[int, int, int, int, str, str, float | None]:
    """Counts by kind, digest of the base spans, all spans, and the dearest value's cost.

    The cost is that of any value in a context or of an assigned value of the fixed patterns.
    """
    text = text or ""
    base = base_spans(text)
    costs = {(a, b): guess_cost(text[a:b], ranked) for a, b in _context_values(text, base)}
    more = [("guess", *span) for span, cost in costs.items() if cost >= MIN_COST]
    assigned = [guess_cost(m[2], ranked) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    n = {k: sum(s[0] == k for s in base + more) for k in KINDS}
    digest = hashlib.sha256(_listed(base).encode()).hexdigest()
    dearest = max([*costs.values(), *assigned], default=None)
    return (*(n[k] for k in KINDS), digest, _listed(base + more), dearest)


def word_ranks(docs: DataFrame, text: str = "text", size: int = RANKED_WORDS) -> Broadcast:
    """log10 costs of the ``size`` most frequent words of all whole texts, for ``secret_scan``.

    Words are runs of 2 to 32 letters that stand alone, in lower case; equally frequent ones rank in
    word order. What stands in a credential context is not counted, so a secret that is copied
    often does not become a cheap word. Null and empty texts and empty tables have no words.
    """
    plain = F.col(text)
    for pattern in (_ASSIGN_SQL, _CONTEXT_SQL):
        plain = F.regexp_replace(plain, pattern, " ")
    words = F.explode(F.regexp_extract_all(F.lower(plain), F.lit(_WORD_SQL), 0))
    counts = docs.select(words.alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    counts = materialise(counts, "words")
    # At most ``size`` rows of at most 32 letters.
    chosen = vocabulary(counts, size).collect()
    chosen.sort(key=lambda r: (-r["total"], r["term"]))
    ranks = {r["term"]: math.log10(i + 1) for i, r in enumerate(chosen, 1)}
    return docs.sparkSession.sparkContext.broadcast(ranks)


def secret_scan(text: str = "text", ranks: Broadcast | None = None) -> Column:
    """Counts by kind, digest of the base spans, all spans and the dearest value's cost of a whole text.

    Without a shuffle. Null and empty texts have no spans and a null cost. Positions are code points,
    ends exclusive. ``ranks`` are the word ranks of a corpus; without them only the fixed words are cheap.
    """
    names = ("n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans", "max_cost")
    types = {"base_sha256": "string", "spans": "string", "max_cost": "double"}

    @F.pandas_udf(", ".join(f"{n} {types.get(n, 'long')}" for n in names))
    def apply(texts: pd.Series) -> pd.DataFrame:
        ranked = ranks.value if ranks else {}
        return pd.DataFrame([scan(t, ranked) for t in texts], columns=names).astype({"max_cost": "float64"})

    return apply(F.col(text))


def op7_secret_guess_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document, values judged by the word ranks of all documents; null texts have none."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secret_scan(ranks=word_ranks(docs)).alias("s"))
    return found.select("doc_id", "s.*")


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with an assigned secret, access key or guessed value go.

    Words are ranked over the documents of the stage. A bare run of hex digits is no proof (long
    numbers are such runs), so it alone keeps a document. Null and empty texts stay; all columns
    stay as they are.
    """
    found = secret_scan(ranks=word_ranks(docs))
    return docs.filter(found["n_assign"] + found["n_access"] + found["n_guess"] == 0)

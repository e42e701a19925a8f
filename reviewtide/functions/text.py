"""Text expressions, all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewtide.functions.fixed_values import NGRAM_SIZE, STOP_WORDS, WHITESPACE


def _let(value: Column, body: str) -> Column:
    """Bind ``value`` once and use it several times: ``body`` is a SQL lambda.

    The lambda variable keeps an expensive array from being evaluated again for every
    reference, whatever the optimizer does with neighbouring projections.
    """
    return F.call_function("transform", F.array(value), F.expr(body))[0]


def clean_text(text: Column) -> Column:
    """Lower-case the text and remove every non-ASCII character."""
    return F.regexp_replace(F.lower(text), "[^\\x00-\\x7F]+", "")


def tokens(text: Column, lowered: bool = False) -> Column:
    """Whitespace tokens with the ML tokenizer's rules.

    Leading and inner empty tokens stay, trailing ones go. Whitespace-only text has no
    token, the empty string has one empty token. Pass ``lowered`` for text in lower case.
    """
    body = F.rtrim(text if lowered else F.lower(text), F.lit(WHITESPACE))
    blank = (body == "") & (text != "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(body, "\\s"))


def without_stop_words(words: Column, lowered: bool = False) -> Column:
    """Drop English stop words in any case; repeated words stay repeated."""
    listed = ", ".join("'" + w.replace("'", "\\'") + "'" for w in STOP_WORDS)
    word = "w" if lowered else "lower(w)"
    return F.call_function("filter", words, F.expr(f"w -> {word} NOT IN ({listed})"))


def ngrams(words: Column, n: int = NGRAM_SIZE) -> Column:
    """Sequences of ``n`` neighbouring words joined by one blank."""
    if n < 1:
        raise ValueError("n must be at least 1")
    neighbours = ", ".join(f"get(ws, i + {k})" for k in range(n))
    return _let(
        words,
        f"""ws -> CASE WHEN size(ws) >= {n}
              THEN transform(sequence(0, size(ws) - {n}), i -> concat_ws(' ', {neighbours}))
              ELSE CAST(array() AS array<string>) END""",
    )


def term_runs(terms: Column) -> Column:
    """Distinct terms of one array with their counts, as ``array<struct<term,n>>``.

    Sorting inside the row replaces a shuffle on (row, term): equal terms become
    neighbours, and each run's length is the distance between two run starts.
    """
    starts = _let(
        F.sort_array(terms),
        """s -> CASE WHEN size(s) > 0
             THEN named_struct('sorted', s, 'at', filter(sequence(0, size(s) - 1),
                    i -> i = 0 OR get(s, i) <> get(s, i - 1)))
             ELSE named_struct('sorted', s, 'at', CAST(array() AS array<int>)) END""",
    )
    return _let(
        starts,
        """r -> transform(r.at, (at, k) -> named_struct(
             'term', get(r.sorted, at),
             'n', CAST(coalesce(get(r.at, k + 1), size(r.sorted)) - at AS bigint)))""",
    )


def content_id(*columns: Column | str) -> Column:
    """SHA-256 over the given columns: equal content, equal id.

    Every value is written with its length in front and null as '-', so neither a
    separator inside a value nor a null can make two different records collide.
    """
    parts = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        framed = F.concat(F.char_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(framed, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def key_bucket(key: Column, buckets: int = 10) -> Column:
    """Stable bucket number from the key's MD5, the same in every run and engine."""
    head = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % buckets

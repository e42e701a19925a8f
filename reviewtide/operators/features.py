"""Bigram features in relational form.

Everything up to the per-row term counts happens inside the row. The only shuffle is one
aggregation keyed by term, with map-side partial sums, which serves the vocabulary, the
document frequencies and the class totals at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewtide.functions.fixed_values import (
    CLEAN_TEXT,
    LENGTH,
    NGRAM_SIZE,
    NGRAMS,
    SENTIMENT,
    SENTIMENTS,
    TOKENS,
    VOCABULARY_SIZE,
    WORDS,
)
from reviewtide.functions.text import ngrams, term_runs, tokens, without_stop_words
from reviewtide.operators.prepare import has_class
from reviewtide.plans.joins import lookup_join
from reviewtide.plans.numbering import number_rows

#: Parts that the entries without a term are dealt over when terms are shuffled.
SALTS = 64


def with_tokens(df: DataFrame, text_col: str = CLEAN_TEXT) -> DataFrame:
    """Add ``tokenised_text``."""
    return df.withColumn(TOKENS, tokens(F.col(text_col)))


def remove_stop_words(df: DataFrame) -> DataFrame:
    """Add ``tokenised_text_without_stop_words``."""
    words = without_stop_words(F.col(TOKENS))
    return df.withColumn(WORDS, words)


def with_ngrams(df: DataFrame, n: int = NGRAM_SIZE) -> DataFrame:
    """Add ``nGrams``."""
    return df.withColumn(NGRAMS, ngrams(F.col(WORDS), n))


def terms_of(text_col: str = CLEAN_TEXT, n: int = NGRAM_SIZE) -> Column:
    """All n-grams of the cleaned (lower-case) text, repeats included."""
    return ngrams(without_stop_words(tokens(F.col(text_col), True), True), n)


def _entries(text_col: str, n: int, with_length: bool) -> Column:
    """Array of (term, n) for one row; with a last entry (null, text length) on request."""
    terms = term_runs(terms_of(text_col, n))
    if not with_length:
        return terms
    length = F.struct(
        F.lit(None).cast("string").alias("term"), F.col(LENGTH).cast("bigint").alias("n")
    )
    return F.concat(terms, F.array(length))


def term_counts(
    df: DataFrame,
    key: str = "review_id",
    text_col: str = CLEAN_TEXT,
    n: int = NGRAM_SIZE,
    with_length: bool = False,
) -> DataFrame:
    """(key, term, n): how often each row has each term. No shuffle.

    ``with_length`` adds one entry with a null term and the text length for every row, so the
    table also tells how many rows there are, even rows without a term.
    """
    return df.select(key, F.inline(_entries(text_col, n, with_length)))


def document_frequencies(counts: DataFrame) -> DataFrame:
    """(term, doc_freq, total) over a ``term_counts`` frame."""
    terms = counts.filter(F.col("term").isNotNull())
    return terms.groupBy("term").agg(
        F.count(F.lit(1)).alias("doc_freq"), F.sum("n").alias("total")
    )


def idf_of(doc_freq: Column, documents: int) -> Column:
    """Smoothed inverse document frequency."""
    return F.log(F.lit(float(documents + 1)) / (doc_freq + 1))


def idf_weights(counts: DataFrame, documents: int | None = None) -> DataFrame:
    """(term, doc_freq, total, idf) from a materialised ``term_counts`` frame.

    Without ``documents`` the frame must have the length entries; they are counted.
    """
    if documents is None:
        documents = counts.filter(F.col("term").isNull()).count()
    frequencies = document_frequencies(counts)
    return frequencies.withColumn("idf", idf_of(F.col("doc_freq"), documents))


def tfidf_terms(counts: DataFrame, idf: DataFrame, key: str = "review_id") -> DataFrame:
    """(key, term, value): TF-IDF weights; length entries keep the length as their value.

    ``counts`` and ``idf`` should be materialised tables. ``idf`` is joined by broadcast while it
    is small. A full vocabulary grows with the data and is then shuffled, frequent terms apart.
    """
    terms = counts.filter(F.col("term").isNotNull())
    weighted = lookup_join(terms, idf.select("term", "idf"), "term", "inner")
    lengths = counts.filter(F.col("term").isNull())
    return weighted.select(key, "term", (F.col("n") * F.col("idf")).alias("value")).unionByName(
        lengths.select(key, "term", F.col("n").cast("double").alias("value"))
    )


def tfidf(df: DataFrame, key: str = "review_id", text_col: str = CLEAN_TEXT, n: int = NGRAM_SIZE) -> DataFrame:
    """(key, term, value) as ``tfidf_terms`` gives it, from one pass over the text and one shuffle.

    A row's terms are counted inside the row and then dealt by term. There a window counts the
    documents of each term beside its rows, so no table of weights is written, shuffled and joined.
    A row has a term once, so a term's rows are at most as many as the documents; the window keeps
    them on disk where they do not fit. The length entries, which share a null term, are dealt over ``SALTS`` parts.
    """
    counts = term_counts(df, key, text_col, n, with_length=True)
    salt = F.when(F.col("term").isNull(), F.pmod(F.xxhash64(key), F.lit(SALTS))).otherwise(F.lit(0))
    doc_freq = F.count(F.lit(1)).over(Window.partitionBy("term", "_salt"))
    met = counts.withColumn("_salt", salt).withColumn("_doc_freq", doc_freq)
    weighted = F.col("n") * idf_of(F.col("_doc_freq"), df.count())
    value = F.when(F.col("term").isNotNull(), weighted).otherwise(F.col("n").cast("double"))
    return met.select(key, "term", value.alias("value"))


def class_term_stats(
    df: DataFrame, label: str = SENTIMENT, text_col: str = CLEAN_TEXT, n: int = NGRAM_SIZE
) -> DataFrame:
    """One row per term: total count and document count in every class.

    Each training row also emits one entry with a null term and its text length. That single
    output row holds the summed length and the number of rows per class, so one pass over the
    text yields all a classifier needs.
    """
    # The class test runs once per row, not once per term.
    member = [(F.col(label) == s).alias(f"is_{s}") for s in SENTIMENTS]
    rows = df.filter(has_class(label)).select(*member, F.inline(_entries(text_col, n, True)))
    sums = [F.sum(F.when(F.col(f"is_{s}"), F.col("n")).otherwise(0)) for s in SENTIMENTS]
    docs = [F.count_if(F.col(f"is_{s}")) for s in SENTIMENTS]
    return rows.groupBy("term").agg(
        *[c.alias(f"tf_{s}") for s, c in zip(SENTIMENTS, sums)],
        *[c.alias(f"df_{s}") for s, c in zip(SENTIMENTS, docs)],
    )


def total_of(prefix: str) -> Column:
    """Sum of a per-class column family."""
    first, *rest = [F.col(f"{prefix}_{s}") for s in SENTIMENTS]
    for column in rest:
        first = first + column
    return first


def vocabulary(frequencies: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """The ``size`` terms with the largest ``total``, equal totals in term order.

    ``frequencies`` should be a materialised table. A histogram of the totals finds the count
    at the cut: it has one row per distinct total, at most the square root of twice the number
    of terms in the corpus. Every term above the cut is kept as it streams by, and only the
    terms that tie at the cut are ordered, range by range, and numbered; the first are kept.
    """
    histogram = frequencies.groupBy("total").agg(F.count(F.lit(1)).alias("terms"))
    falling = Window.orderBy(F.desc("total")).rowsBetween(Window.unboundedPreceding, -1)
    above = F.coalesce(F.sum("terms").over(falling), F.lit(0))
    cut = (
        histogram.withColumn("above", above)
        .filter(F.col("above") < size)
        .orderBy("total")
        .first()
    )
    if cut is None:
        return frequencies.limit(0)
    if cut["above"] + cut["terms"] <= size:
        return frequencies.filter(F.col("total") >= cut["total"])
    ties = number_rows(frequencies.filter(F.col("total") == cut["total"]), "term", name="_place")
    return frequencies.filter(F.col("total") > cut["total"]).unionByName(
        ties.filter(F.col("_place") < size - cut["above"]).drop("_place")
    )

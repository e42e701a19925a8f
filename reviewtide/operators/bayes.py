"""Multinomial naive Bayes in relational form."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


from reviewtide.functions.fixed_values import (
    NGRAM_SIZE,
    SENTIMENTS,
    SMOOTHING,
    VOCABULARY_SIZE,
)
from reviewtide.operators.features import (
    class_term_stats,
    idf_of,
    terms_of,
    total_of,
    vocabulary,
)
from reviewtide.plans.joins import lookup_join
from reviewtide.plans.storage import materialise


@dataclass(frozen=True)
class TermTable:
    """What one pass over the training text yields.

    ``terms`` is the vocabulary (term, tf_<class>, df_<class>, total, doc_freq, idf), at most
    ``vocab_size`` rows. The rest are a handful of numbers per class.
    """

    terms: DataFrame
    labels: list[str]
    docs: dict[str, int]
    lengths: dict[str, int]


@dataclass(frozen=True)
class BayesModel:
    """Fitted classifier: a few numbers per class and one row of weights per term.

    ``labels`` are ordered by falling frequency, so the position is the class index.
    ``weights`` has, per term, its idf, the log-probability ``lp_<class>`` and the score
    contribution of one occurrence ``w_<class>``.
    """

    labels: list[str]
    docs: dict[str, int]
    prior: dict[str, float]
    length_lp: dict[str, float]
    weights: DataFrame
    ngram: int


def count_terms(
    df: DataFrame, vocab_size: int = VOCABULARY_SIZE, ngram: int = NGRAM_SIZE
) -> TermTable:
    """Count the prepared training rows once and pick the vocabulary."""
    stats = materialise(
        class_term_stats(df, n=ngram)
        .withColumn("total", total_of("tf"))
        .withColumn("doc_freq", total_of("df")),
        "terms",
    )
    whole = stats.filter(F.col("term").isNull()).first()
    if whole is None:
        raise ValueError("no training row has a sentiment class")
    docs = {s: whole[f"df_{s}"] for s in SENTIMENTS}
    labels = sorted((s for s in SENTIMENTS if docs[s]), key=lambda s: (-docs[s], s))
    terms = vocabulary(stats.filter(F.col("term").isNotNull()), vocab_size)
    idf = idf_of(F.col("doc_freq"), sum(docs.values()))
    return TermTable(
        terms=materialise(terms.withColumn("idf", idf), "vocabulary"),
        labels=labels,
        docs=docs,
        lengths={s: whole[f"tf_{s}"] for s in SENTIMENTS},
    )


def nb_fit(
    df: DataFrame,
    vocab_size: int = VOCABULARY_SIZE,
    ngram: int = NGRAM_SIZE,
    use_length: bool = True,
    smoothing: float = SMOOTHING,
) -> BayesModel:
    """Fit on prepared rows (``processedReviewText``, ``length``, ``sentiment``)."""
    table = count_terms(df, vocab_size, ngram)
    labels = table.labels
    weight = {s: F.col(f"tf_{s}") * F.col("idf") for s in labels}
    sums = table.terms.agg(
        F.count(F.lit(1)).alias("features"),
        *[F.coalesce(F.sum(weight[s]), F.lit(0.0)).alias(s) for s in labels],
    ).first()
    features = sums["features"] + int(use_length)
    lengths = {s: float(table.lengths[s]) if use_length else 0.0 for s in labels}
    bottom = {s: math.log(sums[s] + lengths[s] + smoothing * features) for s in labels}
    lp = {s: F.log(weight[s] + F.lit(smoothing)) - F.lit(bottom[s]) for s in labels}
    weights = table.terms.select(
        "term",
        "idf",
        *[lp[s].alias(f"lp_{s}") for s in labels],
        *[(F.col("idf") * lp[s]).alias(f"w_{s}") for s in labels],
    )
    rows = sum(table.docs.values())
    return BayesModel(
        labels=labels,
        docs={s: table.docs[s] for s in labels},
        prior={
            s: math.log(table.docs[s] + smoothing) - math.log(rows + smoothing * len(labels))
            for s in labels
        },
        length_lp={
            s: math.log(lengths[s] + smoothing) - bottom[s] if use_length else 0.0 for s in labels
        },
        weights=weights,
        ngram=ngram,
    )


def best_label(scores: dict[str, Column], labels: list[str]) -> Column:
    """Index of the label with the highest score; equal scores go to the more frequent one."""
    ranked = [F.struct(scores[s], F.lit(-i).alias("minus_index")) for i, s in enumerate(labels)]
    return -F.array_max(F.array(*ranked))["minus_index"]


def nb_predict(
    df: DataFrame, model: BayesModel, key: str = "review_id", keep: tuple[str, ...] = ()
) -> DataFrame:
    """(key, *keep, prediction, predicted_sentiment) for every row of ``df``.

    Terms are looked up by broadcast join (the vocabulary is bounded), and a row's terms sit in
    one partition, so partial aggregation leaves one record per row before the only shuffle.
    ``keep`` columns must depend on the key.
    """
    columns = [key, *keep, "length"]
    rows = df.select(*columns, F.explode_outer(terms_of(n=model.ngram)).alias("term"))
    weights = model.weights.select("term", *[f"w_{s}" for s in model.labels])
    sums = (
        lookup_join(rows, weights, "term", "left")
        .groupBy(*columns)
        .agg(*[F.coalesce(F.sum(f"w_{s}"), F.lit(0.0)).alias(f"w_{s}") for s in model.labels])
    )
    scores = {
        s: F.col(f"w_{s}")
        + F.lit(model.prior[s])
        + F.col("length") * F.lit(model.length_lp[s])
        for s in model.labels
    }
    index = best_label(scores, model.labels)
    names = F.array(*[F.lit(s) for s in model.labels])
    return sums.withColumn("prediction", index.cast("double")).select(
        key,
        *keep,
        "prediction",
        F.get(names, F.col("prediction").cast("int")).alias("predicted_sentiment"),
    )


def priors(model: BayesModel, df: DataFrame) -> DataFrame:
    """(sentiment, docs, log_prior), a few rows."""
    rows = [(s, model.docs[s], model.prior[s]) for s in model.labels]
    return df.sparkSession.createDataFrame(rows, "sentiment string, docs bigint, log_prior double")


def log_probabilities(model: BayesModel) -> DataFrame:
    """(sentiment, term, log_prob), one row per class and vocabulary term."""
    pairs = F.array(
        *[
            F.struct(F.lit(s).alias("sentiment"), F.col(f"lp_{s}").alias("log_prob"))
            for s in model.labels
        ]
    )
    return model.weights.select("term", F.inline(pairs)).select("sentiment", "term", "log_prob")


def top_terms(model: BayesModel, k: int = 20) -> DataFrame:
    """The ``k`` terms per class that speak most for it against the other classes."""
    others = max(len(model.labels) - 1, 1)
    total = F.lit(0.0)
    for s in model.labels:
        total = total + F.col(f"lp_{s}")
    pairs = F.array(
        *[
            F.struct(
                F.lit(s).alias("sentiment"),
                F.round(F.col(f"lp_{s}") - (total - F.col(f"lp_{s}")) / others, 6).alias(
                    "log_ratio"
                ),
            )
            for s in model.labels
        ]
    )
    best = Window.partitionBy("sentiment").orderBy(F.desc("log_ratio"), "term")
    return (
        model.weights.select("term", F.inline(pairs))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("sentiment", "rank", "term", "log_ratio")
    )

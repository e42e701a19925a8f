"""Toxicity: linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.llm.common import crc_fold, gram_hashes, labelled_sample, letters, table

ORDERS = (3, 4, 5)
BITS = 18
FEATURES = 1024
FIT_ROWS = 3000
FIT_PARTS = 12
SMOOTHING = 1.0
PENALTY = 1e-3
STEPS = 300
MIN_Z = 3.0


@dataclass
class ToxicityModel:
    """``weight`` holds a weight per hashed n-gram (ratio times learned coefficient)."""

    weight: np.ndarray
    bias: float


def present(text: str | None) -> np.ndarray:
    """The distinct hashed character n-grams of a whole text."""
    codes = letters(text or "")
    seen = np.zeros(1 << BITS, bool)
    for n in ORDERS:
        seen[gram_hashes(codes, n, BITS)] = True
    return np.flatnonzero(seen)


def _document_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """By class, in how many of the (bounded) rows each n-gram occurs, and the rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((2, 1 << BITS), np.float32), [0, 0]
        for batch in batches:
            for y, text in zip(batch["y"].to_pylist(), batch["t"].to_pylist(), strict=True):
                sums[y, present(text)] += 1
                n[y] += 1
        yield pa.RecordBatch.from_pydict({"n": [n], "sums": [sums.tobytes()]})

    sums, n = np.zeros((2, 1 << BITS)), np.zeros(2)
    for row in rows.mapInArrow(count, "n array<long>, sums binary").toLocalIterator():
        sums += np.frombuffer(row["sums"], np.float32).reshape(2, -1)
        n += row["n"]
    return sums, n


def fit_toxicity(sample: DataFrame, features: int = FEATURES) -> ToxicityModel:
    """Fit on the rows of ``labelled_sample``, whole texts.

    The ratio of an n-gram is log of its smoothed share among rows of class 1 over that of
    class 0. The ``features`` n-grams whose ratio is surest get a coefficient by regularised
    logistic regression; the rows count by the true sizes of the classes. With rows of one class or
    none the score is that class's constant.
    """
    rows = sample.select(
        F.col("doc_id").alias("k"), F.col("label").alias("y"), F.col("text").alias("t"), "class_size"
    ).repartition(FIT_PARTS, "k")
    sums, n = _document_counts(rows.select("y", "t"))
    empty = np.zeros(1 << BITS, np.float32)
    if not n.all():
        return ToxicityModel(empty, 5.0 if n[1] else -5.0)
    share = (sums + SMOOTHING) / (n + 2 * SMOOTHING)[:, None]
    ratio = np.log(share[1] / share[0])
    sure = np.abs(ratio) / np.sqrt((1 / (sums + SMOOTHING)).sum(axis=0))
    order = np.lexsort((np.arange(len(sure)), -sure))[:features]
    order = np.sort(order[sure[order] >= MIN_Z])
    slot = np.full(1 << BITS, -1, np.int32)
    slot[order] = np.arange(len(order))

    @F.pandas_udf("binary")
    def features_of(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> bytes:
            bits = np.zeros(len(order), np.uint8)
            found = slot[present(text)]
            bits[found[found >= 0]] = 1
            return np.packbits(bits).tobytes()

        return texts.map(one)

    got = rows.select("k", "y", "class_size", features_of("t").alias("x")).collect()
    got = sorted(got, key=lambda r: (str(r["k"]), r["y"], bytes(r["x"])))
    bits = np.array([np.frombuffer(r["x"], np.uint8) for r in got]).reshape(len(got), -1)
    x = np.unpackbits(bits, axis=1)[:, : len(order)].astype(np.float32) * ratio[order].astype(np.float32)
    y = np.array([r["y"] for r in got], np.float32)
    taken = np.array([n[int(v)] for v in y])
    w = np.array([r["class_size"] for r in got]) / taken
    coefficients, bias = _logistic(x, y, (w / w.sum()).astype(np.float32))
    weight = empty.copy()
    weight[order] = coefficients * ratio[order]
    return ToxicityModel(weight, float(bias))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
    """Adam on the weighted log loss with a quadratic penalty; deterministic."""
    theta, m, v = np.zeros(x.shape[1] + 1), 0.0, 0.0
    share = float((w * y).sum())
    theta[-1] = np.log(share / (1 - share))
    for step in range(1, STEPS + 1):
        error = w * (_sigmoid(x @ theta[:-1].astype(np.float32) + theta[-1]) - y)
        grad = np.append(x.T @ error.astype(np.float32) + PENALTY * theta[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return theta[:-1], theta[-1]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def toxic_score(model: ToxicityModel, text: str = "text") -> Column:
    """Probability of class 1 of a whole text; null and empty texts get the intercept's."""

    @F.pandas_udf("double")
    def apply(texts: pd.Series) -> pd.Series:
        def one(value: str | None) -> float:
            codes = letters(value or "")
            found = np.concatenate([gram_hashes(codes, n, BITS) for n in ORDERS])
            hit = np.unique(found[model.weight[found] != 0])
            return float(_sigmoid(np.float64(model.weight[hit].sum(dtype=np.float64) + model.bias)))

        return texts.map(one).astype("float64")

    return apply(F.col(text))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = crc_fold("doc_id", 5)
    labels = table(spark, sf_dir, "labels").filter(fold != 0)
    score = toxic_score(fit_toxicity(labelled_sample(docs, labels, "toxic", FIT_ROWS)))
    scored = docs.select("doc_id", (fold == 0).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

"""Quality: a convolutional network over bytes, trained and applied in numpy.

A text is cut into chunks of ``CHUNK`` bytes, each beginning ``STRIDE`` bytes after the one before
it, so that every byte is covered. Learned filters slide over the embedded bytes of a chunk and
are max-pooled over its positions. The largest, smallest and mean pooled value of each filter
over all chunks of the document enter one logistic unit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.llm.common import crc_fold, labelled_sample, table

CHUNK = 256
STRIDE = 240
WIDTH = 8
EMBED = 4
FILTERS = 16
FIT_ROWS = 600
FIT_CHARS = 16_000
STEPS = 700
BATCH = 32
RATE = 0.01
PENALTY = 1e-4
_POSITIONS = CHUNK - WIDTH + 1
_BLOCK = 512


@dataclass
class QualityModel:
    """Byte embeddings, filters (width * embedding, filters), their bias, and the last unit."""

    embed: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    unit: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.shift, self.unit, self.bias]


def chunks(text: str | None) -> np.ndarray:
    """All chunks of a whole text as rows of byte values plus one; 0 pads the last chunk."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    count = max(1, -(-max(0, len(data) - CHUNK) // STRIDE) + 1)
    padded = np.zeros((count - 1) * STRIDE + CHUNK, np.int16)
    padded[: len(data)] = data
    padded[: len(data)] += 1
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STRIDE]


def _pool(model: QualityModel, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Max-pooled filters of each chunk, where each maximum lies, and the unfolded windows."""
    vectors = model.embed[rows].reshape(len(rows), CHUNK * EMBED)
    view = np.lib.stride_tricks.sliding_window_view(vectors, WIDTH * EMBED, axis=1)[:, ::EMBED]
    windows = np.ascontiguousarray(view)
    values = windows.reshape(-1, WIDTH * EMBED) @ model.filters
    values = values.reshape(len(rows), _POSITIONS, FILTERS)
    at = values.argmax(axis=1)
    top = np.take_along_axis(values, at[:, None], axis=1)[:, 0] + model.shift
    return np.maximum(top, 0), at, windows


def _join(pooled: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Largest, smallest and mean pooled values of the chunks of each document."""
    counts = np.diff(np.append(starts, len(pooled)))[:, None]
    return np.concatenate(
        [
            np.maximum.reduceat(pooled, starts),
            np.minimum.reduceat(pooled, starts),
            np.add.reduceat(pooled, starts) / counts,
        ],
        axis=1,
    )


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gradients(model: QualityModel, docs: list[np.ndarray], y: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
    rows = np.concatenate(docs)
    sizes = np.array([len(d) for d in docs])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(docs)), sizes)
    pooled, at, windows = _pool(model, rows)
    joined = _join(pooled, starts)
    error = (w * (_sigmoid(joined @ model.unit + model.bias) - y)).astype(np.float32)
    back = error[:, None] * model.unit
    high, low, mean = np.split(back, 3, axis=1)
    d_pool = (mean / sizes[:, None])[owner]
    for share, best in ((high, joined[:, :FILTERS]), (low, joined[:, FILTERS : 2 * FILTERS])):
        same = pooled == best[owner]
        ties = np.add.reduceat(same.astype(np.float32), starts)
        d_pool += same * (share / ties)[owner]
    d_pool = np.where(pooled > 0, d_pool, 0).astype(np.float32)
    hit = np.take_along_axis(windows, at[:, :, None], axis=1)  # chunks, filters, width * embed
    d_filters = np.einsum("cf,cfk->kf", d_pool, hit)
    d_windows = d_pool[:, :, None] * model.filters.T[None]
    d_embed = np.zeros_like(model.embed)
    place = at[:, :, None] + np.arange(WIDTH)
    symbols = np.take_along_axis(rows[:, None, :].astype(np.int64), place, axis=2)
    np.add.at(d_embed, symbols.reshape(-1), d_windows.reshape(-1, EMBED))
    return [d_embed, d_filters, d_pool.sum(axis=0), joined.T @ error, error.sum(keepdims=True)]


def fit_quality(sample: DataFrame, steps: int = STEPS) -> QualityModel:
    """Train on the rows of ``labelled_sample``; those over ``FIT_CHARS`` characters are left out.

    The rows are bounded in number and length and come to the driver; the seed is fixed and the
    rows are ordered, so a fit gives the same network each time. Rows count by the true sizes of
    their classes. With rows of one class or none the score is that class's constant.
    """
    short = sample.filter(F.coalesce(F.char_length("text"), F.lit(0)) <= FIT_CHARS)
    got = sorted(short.collect(), key=lambda r: (str(r["doc_id"]), r["label"], r["text"] or ""))
    rng = np.random.default_rng(7)
    f32 = np.float32
    model = QualityModel(
        rng.normal(0, 0.5, (257, EMBED)).astype(f32),
        rng.normal(0, 0.25, (WIDTH * EMBED, FILTERS)).astype(f32),
        np.full(FILTERS, 0.1, f32),
        rng.normal(0, 0.1, 3 * FILTERS).astype(f32),
        np.zeros(1, f32),
    )
    model.embed[0] = 0
    y = np.array([r["label"] for r in got], f32)
    n = np.bincount(y.astype(int), minlength=2)
    if not n.all():
        model.unit[:] = 0
        model.bias[:] = 5.0 if n[1] else -5.0
        return model
    w = np.array([r["class_size"] for r in got], f32) / n[y.astype(int)]
    w *= len(w) / w.sum()
    share = (w * y).mean()
    model.bias[:] = np.log(share / (1 - share))
    docs = [chunks(r["text"]) for r in got]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in model.parameters()]
    step, per_epoch = 0, -(-len(docs) // BATCH)
    for _ in range(-(-steps // per_epoch)):
        order = rng.permutation(len(docs))
        for start in range(0, len(docs), BATCH):
            batch = order[start : start + BATCH]
            step += 1
            rate = RATE * (1 - step / (steps + per_epoch))
            found = _gradients(model, [docs[i] for i in batch], y[batch], w[batch] / len(batch))
            for p, g, (m, v) in zip(model.parameters(), found, moments, strict=True):
                g = g + PENALTY * p
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
            model.embed[0] = 0
    return model


def document_scores(model: QualityModel, texts: pd.Series) -> np.ndarray:
    """Probabilities of class 1; the chunks of a long document pass through in blocks."""
    out = np.empty(len(texts))
    for i, text in enumerate(texts):
        rows = chunks(text)
        parts = [_pool(model, rows[s : s + _BLOCK])[0] for s in range(0, len(rows), _BLOCK)]
        joined = _join(np.concatenate(parts), np.zeros(1, int))
        out[i] = _sigmoid(joined[0].astype(np.float64) @ model.unit + float(model.bias[0]))
    return out


def quality_score(model: QualityModel, text: str = "text") -> Column:
    """Probability that a whole text is good; null counts as empty text, a chunk of padding."""

    @F.pandas_udf("double")
    def apply(texts: pd.Series) -> pd.Series:
        return pd.Series(document_scores(model, texts))

    return apply(F.col(text))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = crc_fold("doc_id", 4)
    labels = table(spark, sf_dir, "labels").filter(fold != 2)
    score = quality_score(fit_quality(labelled_sample(docs, labels, "quality", FIT_ROWS)))
    scored = docs.select("doc_id", (fold == 2).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))

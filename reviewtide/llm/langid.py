"""Language identification by the nearest of several TF-IDF n-gram centroids per language."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.llm.common import bounded_sample, crc_fold, gram_hashes, letters, table

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BITS = 12
CENTROIDS = 4
ROUNDS = 8
FIT_ROWS = 800
SLACK = 0.4  # of the cosine that all but a hundredth of the texts of a length reach
MIN_ROWS = 20
_BLOCK = 256


@dataclass
class LanguageModel:
    """``centroids`` are unit rows; ``language`` names the language of each; ``floor`` holds the
    smallest accepted cosine by the power of two of a text's letters."""

    languages: list[str]
    language: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    floor: np.ndarray


def term_frequencies(text: str | None) -> tuple[np.ndarray, int]:
    """Hashed counts of character n-grams, and the number of letters."""
    codes = letters(text or "")
    n_letters = int((codes != 32).sum())
    if not n_letters:
        return np.zeros(1 << BITS, np.float32), 0
    found = np.concatenate([gram_hashes(codes, n, BITS) for n in ORDERS])
    return np.bincount(found, minlength=1 << BITS).astype(np.float32), n_letters


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1)


def _weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * idf)


def _cluster(rows: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; seeds are the rows farthest from those before."""
    seeds = [rows.mean(axis=0)]
    for _ in range(min(k, len(rows)) - 1):
        seeds.append(rows[np.argmin((rows @ _unit(np.array(seeds)).T).max(axis=1))])
    centres = _unit(np.array(seeds))
    for _ in range(ROUNDS):
        near = np.argmax(rows @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        empty = ~np.isin(np.arange(len(centres)), near)
        sums[empty] = centres[empty]
        centres = _unit(sums)
    return centres


def packed(counts: np.ndarray) -> bytes:
    """Counts in two bytes each, or in eight where a long text has a larger one."""
    return counts.astype(np.uint16 if counts.max(initial=0) < 1 << 16 else np.uint64).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint16 if len(data) == 2 << BITS else np.uint64)


def fit_languages(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    per_language: int = FIT_ROWS,
    centroids: int = CENTROIDS,
) -> LanguageModel | None:
    """Fit on about ``per_language`` rows of each language, whole texts.

    Rows without a language or a letter teach nothing. None when nothing is left. The n-grams
    are counted on the executors; bounded vectors of the sample come to the driver.
    """
    sample = bounded_sample(labelled.select(key, text, lang), lang, per_language, key)

    @F.pandas_udf("binary")
    def counts(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: packed(term_frequencies(t)[0]))

    rows = sample.select(F.col(key).alias("k"), F.col(lang).alias("l"), counts(text).alias("v"))
    got = sorted(rows.collect(), key=lambda r: (r["l"], str(r["k"]), bytes(r["v"])))
    matrix = np.array([unpacked(r["v"]) for r in got], np.float32)
    matrix = matrix.reshape(len(got), 1 << BITS)
    used = matrix.sum(axis=1) > 0
    names = np.array([r["l"] for r in got], object)[used]
    matrix = matrix[used]
    if not len(matrix):
        return None
    idf = np.log((1 + len(matrix)) / (1 + (matrix > 0).sum(axis=0))).astype(np.float32) + 1
    size = np.log2(matrix.sum(axis=1) / len(ORDERS) + 1).astype(int)
    weighed = _weigh(matrix, idf)
    languages = sorted(set(names))
    groups = [_cluster(weighed[names == name], centroids) for name in languages]
    language = np.repeat(np.arange(len(languages)), [len(g) for g in groups])
    centres = np.concatenate(groups).astype(np.float32)
    near = (weighed @ centres.T).max(axis=1)
    known = {
        power: SLACK * float(np.quantile(near[size == power], 0.01))
        for power in range(64)
        if (size == power).sum() >= MIN_ROWS
    }
    # Lengths of which few texts are known take the floor of the next shorter; the shortest half of the first.
    lowest = next(iter(known.values()), 0.0) / 2
    floor = np.array([lowest := known.get(power, lowest) for power in range(64)], np.float32)
    return LanguageModel(languages, language, centres, idf, floor)


def predict(model: LanguageModel | None, texts: pd.Series) -> pd.DataFrame:
    langs, scores, rejected = [], [], []
    for start in range(0, len(texts), _BLOCK):
        block = [term_frequencies(t) for t in texts.iloc[start : start + _BLOCK]]
        if model is None:
            langs += [UNKNOWN] * len(block)
            scores += [0.0] * len(block)
            rejected += [True] * len(block)
            continue
        cosines = _weigh(np.array([b[0] for b in block]), model.idf) @ model.centroids.T
        best, top = np.argmax(cosines, axis=1), cosines.max(axis=1)
        for (_, n), i, cosine in zip(block, best, top, strict=True):
            langs.append(model.languages[model.language[i]] if n else UNKNOWN)
            scores.append(float(np.clip(cosine, 0, 1)) if n else 0.0)
            power = int(np.log2(n + 1)) if n else 0
            rejected.append(bool(not n or cosine < model.floor[power]))
    return pd.DataFrame({"lang": langs, "score": scores, "rejected": rejected})


def identify(model: LanguageModel | None, text: str = "text") -> Column:
    """struct(lang, score, rejected) for a text column, without a shuffle.

    ``lang`` is that of the nearest centroid by cosine, the first by name on a tie, and
    ``score`` the cosine. ``rejected`` marks texts farther from every centroid than texts of
    their length are; null, empty and letterless texts are ``und``, 0 and rejected. Without a
    model (no labelled row) every text is.
    """

    @F.pandas_udf("struct<lang:string,score:double,rejected:boolean>")
    def apply(texts: pd.Series) -> pd.DataFrame:
        return predict(model, texts)

    return apply(F.col(text))


def _fitted(docs: DataFrame) -> LanguageModel | None:
    taught = docs.filter(F.col("lang").isNotNull() & (crc_fold("doc_id", 4) != 2))
    return fit_languages(taught)


def op9_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document. ``rejected`` is a further column."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", identify(_fitted(docs)).alias("p"))
    return found.select(
        "doc_id",
        (crc_fold("doc_id", 4) == 2).alias("held_out"),
        F.col("p.lang").alias("lang_pred"),
        "p.score",
        "p.rejected",
    )


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go; all columns stay as they are."""
    return docs.filter(~identify(_fitted(docs))["rejected"])

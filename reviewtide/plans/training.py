"""The classifier as a Spark ML pipeline."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    ElementwiseProduct,
    IndexToString,
    NGram,
    StopWordsRemover,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewtide.functions.fixed_values import (
    CLEAN_TEXT,
    COUNTS,
    FEATURES,
    LABEL,
    LENGTH,
    NGRAM_SIZE,
    NGRAMS,
    SENTIMENT,
    SMOOTHING,
    TFIDF,
    TOKENS,
    VOCABULARY_SIZE,
    WORDS,
)
from reviewtide.functions.text import clean_text
from reviewtide.operators.bayes import count_terms
from reviewtide.operators.prepare import has_class
from reviewtide.plans.storage import materialise

def _assembler(use_length: bool) -> VectorAssembler:
    parts = [TFIDF, LENGTH] if use_length else [TFIDF]
    return VectorAssembler(inputCols=parts, outputCol=FEATURES)


def _text_stages(ngram: int) -> list:
    return [
        Tokenizer(inputCol=CLEAN_TEXT, outputCol=TOKENS),
        StopWordsRemover(inputCol=TOKENS, outputCol=WORDS),
        NGram(n=ngram, inputCol=WORDS, outputCol=NGRAMS),
    ]


def _bayes(smoothing: float) -> NaiveBayes:
    return NaiveBayes(featuresCol=FEATURES, labelCol=LABEL, smoothing=smoothing)


def build_pipeline(
    ngram: int = NGRAM_SIZE,
    vocab_size: int = VOCABULARY_SIZE,
    use_length: bool = True,
    smoothing: float = SMOOTHING,
) -> Pipeline:
    """The eight stages, unfitted. ``Pipeline.fit`` reads the input once per estimator."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol=SENTIMENT, outputCol=LABEL),
            *_text_stages(ngram),
            CountVectorizer(vocabSize=vocab_size, inputCol=NGRAMS, outputCol=COUNTS),
            IDF(inputCol=COUNTS, outputCol=TFIDF),
            _assembler(use_length),
            _bayes(smoothing),
        ]
    )


def fit_pipeline(
    df: DataFrame,
    ngram: int = NGRAM_SIZE,
    vocab_size: int = VOCABULARY_SIZE,
    use_length: bool = True,
    smoothing: float = SMOOTHING,
) -> PipelineModel:
    """Fit all eight stages from one pass over the prepared training rows.

    ``Pipeline.fit`` sends one vocabulary-sized heap or dense vector per task to the driver or
    to one reducer per class, which stops working with many thousand tasks. Here the term
    counts are one ordinary aggregation, and the estimators see its result only: the bounded
    vocabulary table (at most ``vocab_size`` rows) and, for naive Bayes, one weighted row per
    class, its sufficient statistic. Terms that tie at the vocabulary's end are taken in term
    order, so a fit can be repeated.
    """
    table = count_terms(df, vocab_size, ngram)
    labels = table.labels
    terms = table.terms.select("term", "idf", *[f"tf_{s}" for s in labels]).toPandas()
    terms = terms.sort_values("term", ignore_index=True)
    counter = _counter(terms["term"].tolist())
    idf = terms["idf"].to_numpy(dtype=float)
    rows = []
    for index, s in enumerate(labels):
        totals = terms[f"tf_{s}"].to_numpy(dtype=float) * idf
        if use_length:
            totals = np.append(totals, float(table.lengths[s]))
        docs = float(table.docs[s])
        rows.append((float(index), docs, Vectors.dense(totals / docs)))
    schema = T.StructType(
        [
            T.StructField(LABEL, T.DoubleType()),
            T.StructField("docs", T.DoubleType()),
            T.StructField(FEATURES, VectorUDT()),
        ]
    )
    per_class = df.sparkSession.createDataFrame(rows, schema, verifySchema=False)
    return PipelineModel(
        stages=[
            StringIndexerModel.from_labels(labels, inputCol=SENTIMENT, outputCol=LABEL),
            *_text_stages(ngram),
            counter,
            ElementwiseProduct(
                scalingVec=Vectors.dense(idf), inputCol=COUNTS, outputCol=TFIDF
            ),
            _assembler(use_length),
            _bayes(smoothing).setWeightCol("docs").fit(per_class),
        ]
    )


def _counter(terms: list[str]) -> CountVectorizerModel:
    return CountVectorizerModel.from_vocabulary(terms, inputCol=NGRAMS, outputCol=COUNTS)


def fit_stages(df: DataFrame, vocab_size: int = VOCABULARY_SIZE, ngram: int = NGRAM_SIZE, **settings: object) -> PipelineModel:
    """``Pipeline.fit`` on the rows that have a class, for comparison and small data.

    The vocabulary is the exact one, ties at its end in term order; every other stage is fitted.
    The stages up to the counts need no fit then: their result is kept, and each estimator reads
    it instead of the text.
    """
    terms = count_terms(df, vocab_size, ngram).terms.select("term").toPandas()["term"]
    stages = build_pipeline(vocab_size=vocab_size, ngram=ngram, **settings).getStages()
    fixed = [_counter(sorted(terms)) if isinstance(s, CountVectorizer) else s for s in stages]
    indexer, *counting, idf, assembler, bayes = fixed
    counted = PipelineModel(stages=counting).transform(df.filter(has_class()))
    # The column's metadata would name all terms in every file.
    counted = counted.select(SENTIMENT, LENGTH, F.col(COUNTS).alias(COUNTS, metadata={}))
    fitted = Pipeline(stages=[indexer, idf, assembler, bayes]).fit(materialise(counted, "counts"))
    return PipelineModel(stages=[fitted.stages[0], *counting, *fitted.stages[1:]])


def class_names(model: PipelineModel) -> list[str]:
    """Class names by index, as the fitted indexer holds them."""
    return list(model.stages[0].labels)


def name_predictions(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``predicted_sentiment`` from the predicted index and the model's own labels."""
    return IndexToString(
        inputCol="prediction", outputCol="predicted_sentiment", labels=class_names(model)
    ).transform(df)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction`` and ``predicted_sentiment``; map-only, batch or streaming.

    Rows need no class. An existing ``sentiment`` is hidden from the indexer, which would fail
    on rows without one, and the intermediate vectors are dropped.
    """
    held = {SENTIMENT: f"_{SENTIMENT}"} if SENTIMENT in df.columns else {}
    scored = name_predictions(model.transform(df.withColumnsRenamed(held)), model)
    back = {new: old for old, new in held.items()}
    names = [held.get(c, c) for c in df.columns]
    return scored.select(*names, "prediction", "predicted_sentiment").withColumnsRenamed(back)


def score_messages(model: PipelineModel, df: DataFrame, text_col: str = "review_text") -> DataFrame:
    """Add ``sentiment`` to every record; a record without text keeps a null. No join."""
    text = F.col(text_col)
    prepared = df.drop(SENTIMENT).withColumn(
        CLEAN_TEXT, clean_text(F.coalesce(text, F.lit("")))
    )
    prepared = prepared.withColumn(LENGTH, F.char_length(CLEAN_TEXT))
    named = F.when(text.isNotNull(), F.col("predicted_sentiment"))
    return (
        score(model, prepared)
        .withColumn(SENTIMENT, named)
        .drop(CLEAN_TEXT, LENGTH, "prediction", "predicted_sentiment")
    )


def save_model(model: PipelineModel, path: str) -> None:
    """Save, replacing an older model at the same place."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a saved pipeline model."""
    return PipelineModel.load(path)

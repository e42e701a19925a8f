"""Training-corpus pipeline: five stages over the documents, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewtide.llm.common import with_library
from reviewtide.llm.decontamination import drop_leaks
from reviewtide.llm.langid import keep_known_languages
from reviewtide.llm.mixing import take_mix
from reviewtide.llm.ngram_join import keep_one_of_each
from reviewtide.llm.secrets import drop_secrets
from reviewtide.plans.storage import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Stages in order. All but the last return the columns of their documents; the last returns every
#: document as often as the mix takes it, numbered in ``copy_no``.
STAGES: list[tuple[str, Stage]] = [
    ("language", with_library(keep_known_languages)),
    ("near_duplicates", with_library(keep_one_of_each)),
    ("decontamination", with_library(drop_leaks)),
    ("secrets", with_library(drop_secrets)),
    ("mixing", with_library(take_mix)),
]

#: The classifier, the index and the guess costs are beyond SQL; a test compares each stage with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each stage's rows are written to the shared folder and
    reread, so a lost executor repeats one stage at most."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewtide.llm import (
    alignment,
    decontamination,
    langid,
    licenses,
    manifest,
    mixing,
    ngram_join,
    quality,
    secrets,
    substrings,
    toxicity,
    urls,
    vector_graph,
)
from reviewtide.llm.common import with_library

Query = Callable[[SparkSession, str], DataFrame]


_QUERIES: tuple[Query, ...] = (
    substrings.op1_column_suffixes,
    decontamination.op2_qgram_leaks,
    toxicity.op3_toxicity,
    quality.op4_quality,
    urls.op5_url_rules,
    vector_graph.op6_flat_graph,
    secrets.op7_secret_guess_cost,
    mixing.op8_entropy_mix,
    langid.op9_language_centroids,
    ngram_join.op10_ngram_groups,
    manifest.op11_octopus_manifest,
    licenses.op12_rare_token_licenses,
    alignment.op13_shared_cuts,
)


def queries() -> dict[str, Query]:
    return {query.__name__: with_library(query) for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        urls.op5_url_rules.__name__: urls.ORACLE_SQL,
        manifest.op11_octopus_manifest.__name__: manifest.ORACLE_SQL,
        licenses.op12_rare_token_licenses.__name__: licenses.ORACLE_SQL,
    }

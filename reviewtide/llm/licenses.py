"""License scans by a positional rare-token index. DataFrame functions only.

Templates are passages of license texts with the phrase that a match must hold. Their words are
postings (word, template, position). Of each file only the licence words and their places are
kept. Of the templates whose key phrase it may hold, a file looks up its ``RARE`` rarest words,
those of the highest inverse document frequency over all files. Each place of such a word, less its
position in the template, says where the template would start; the starts on which at least half
of the words agree are the candidates. A candidate is a match if the key phrase stands whole at
its place and at least half of the template's words at theirs. The template of a bare phrase
has no more words than it looks up, so all of its places are found.
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewtide.llm.common import table
from reviewtide.plans.storage import materialise

#: Distinct words of a template that a file looks up.
RARE = 4
#: Least share of a template's words that stand at their places, in percent.
MIN_PERCENT = 50

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Template(NamedTuple):
    """A passage, the phrase in it that a match must hold, and whether it is a bare phrase."""

    label: str
    text: str
    key: str
    base: bool = False


# Phrases that name a license, and passages of public license texts and notices.
BASE = (
    Template("mit", "mit license", "mit license", True),
    Template("apache", "apache license", "apache license", True),
    Template("gpl", "general public license", "general public license", True),
)
TEMPLATES = (
    *BASE,
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
        "hereby granted, free of charge",
    ),
    Template(
        "mit",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "permission notice shall be included",
    ),
    Template("mit", "SPDX-License-Identifier: MIT", "identifier mit"),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "except in compliance with the license",
    ),
    Template("apache", "SPDX-License-Identifier: Apache-2.0", "identifier apache 2 0"),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation",
        "terms of the gnu general public license",
    ),
    Template("gpl", "SPDX-License-Identifier: GPL-3.0-or-later", "identifier gpl"),
    Template(
        "lgpl",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "lesser general public license",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    Template("bsd", "Licensed under the BSD license", "bsd license"),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "for any purpose with or without fee",
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "mozilla public license",
    ),
    Template("unlicense", "This is free and unencumbered software released into the public domain", "unencumbered software"),
    Template("cc0", "To the extent possible under law, the author has waived all copyright; CC0 1.0 Universal", "cc0 1 0"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", "creative commons attribution"),
)


def _words(text: str) -> list[str]:
    return re.findall(_WORD, text.lower())


def postings(templates: tuple[Template, ...]) -> list[dict]:
    """A row per word of each template, with its position and whether it belongs to the key phrase."""
    rows = []
    for i, t in enumerate(templates):
        words, key = _words(t.text), _words(t.key)
        at = next((p for p in range(len(words)) if words[p : p + len(key)] == key), None) if key else None
        if at is None:
            raise ValueError(f"the text of a template must hold its key phrase: {t}")
        rows += [
            {"template": i, "label": t.label, "base": t.base, "word": w, "tpos": p, "in_key": at <= p < at + len(key), "size": len(words)}
            for p, w in enumerate(words)
        ]
    return rows


def _index(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """The postings as a table of a driver-held list, so their size is known to be small."""
    schema = "array<struct<template: int, label: string, base: boolean, word: string, tpos: int, in_key: boolean, size: int>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), schema)))


def _files(docs: DataFrame, key: str, text: str, rows: list[dict]) -> DataFrame:
    """(row, key, n_words, present, maybe, hits): licence words of every file, and the templates whose
    key phrase it may hold; places are kept for files with such templates only."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), _CAPITALS, _CAPITALS.lower())
    known = sorted({r["word"] for r in rows})
    found = docs.select(
        F.col(key).alias("k"), F.monotonically_increasing_id().alias("row"), F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0)).alias("words")
    )
    place = lambda w, i: F.struct(i.alias("pos"), w.alias("word"))
    hits = F.filter(F.transform("words", place), lambda hit: hit["word"].isin(known))
    found = found.select("k", "row", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))
    found = found.withColumn("present", F.array_distinct(F.col("hits.word")))

    def may_hold(template: int) -> Column:
        holds = F.lit(True)
        for word in sorted({r["word"] for r in rows if r["template"] == template and r["in_key"]}):
            holds = holds & F.array_contains("present", word)
        return F.when(holds, F.lit(template))

    maybe = F.array_compact(F.array(*[may_hold(t) for t in sorted({r["template"] for r in rows})]))
    found = found.withColumn("maybe", maybe)
    return found.withColumn("hits", F.when(F.size("maybe") > 0, F.col("hits")))


def license_matches(
    docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, key: str = "doc_id", text: str = "text", rare: int = RARE
) -> tuple[DataFrame, DataFrame]:
    """Files (row, key, n_words) and their matches (row, template, label, base, start, size, share).

    ``start`` is the word, from 0, at which the template begins, which is negative where the
    file begins within it; ``size`` is the template's length in words and ``share`` the share of
    its words that stand at their places. Null texts are empty. Every row is a file; ``row``
    tells rows of one key apart. Other columns are not read.
    """
    spark, listed = docs.sparkSession, postings(templates)
    files = materialise(_files(docs, key, text, listed), "license-files")
    index = F.broadcast(_index(spark, listed))

    # One row per licence word, however many files there are.
    often = files.select(F.explode("present").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("files"))
    often = F.broadcast(materialise(often, "license-words"))
    terms = index.groupBy("template", "word").agg(F.count(F.lit(1)).alias("times"))

    some = files.filter(F.size("maybe") > 0)
    wanted = some.select("row", "present", F.explode("maybe").alias("template"))
    wanted = wanted.select("row", "template", F.explode("present").alias("word"))
    wanted = wanted.join(F.broadcast(terms), ["template", "word"]).join(often, "word")
    # The highest inverse document frequency is the lowest number of files.
    rank = F.row_number().over(Window.partitionBy("row", "template").orderBy("files", "word"))
    looked_up = wanted.withColumn("rank", rank).filter(F.col("rank") <= rare)
    n_looked_up = F.count(F.lit(1)).over(Window.partitionBy("row", "template"))
    looked_up = looked_up.select("row", "template", "word", n_looked_up.alias("looked_up"))

    hits = materialise(some.select("row", F.inline("hits")), "license-hits")
    votes = hits.join(looked_up, ["row", "word"]).join(index.select("template", "word", "tpos"), ["template", "word"])
    starts = votes.groupBy("row", "template", (F.col("pos") - F.col("tpos")).alias("start"))
    starts = starts.agg(F.size(F.collect_set("word")).alias("agree"), F.first("looked_up").alias("looked_up"))
    starts = starts.filter(2 * F.col("agree") >= F.col("looked_up")).select("row", "template", "start")

    expected = starts.join(index, "template").withColumn("pos", F.col("start") + F.col("tpos"))
    standing = expected.join(hits, ["row", "pos", "word"])
    keys = F.count_if("in_key").alias("keys")
    checked = standing.groupBy("row", "template", "start").agg(F.count(F.lit(1)).alias("standing"), keys)
    whole = index.groupBy("template", "label", "base", "size").agg(F.count_if("in_key").alias("needed"))
    matches = checked.join(F.broadcast(whole), "template")
    matches = matches.filter((F.col("keys") == F.col("needed")) & (100 * F.col("standing") >= MIN_PERCENT * F.col("size")))
    share = (F.col("standing") / F.col("size")).alias("share")
    return files.select(F.col("k").alias(key), "row", "n_words"), matches.select("row", "template", "label", "base", "start", "size", share)


def op12_rare_token_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license phrases, labels and best share; null texts have no words.

    Without a match counts and score are 0, labels empty and the places null.
    """
    files, matches = license_matches(table(spark, sf_dir, "documents"))
    base = F.col("base")

    def labels(chosen: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(chosen, F.col("label")))), ",")

    start = F.when(base, F.col("start")).cast("long")
    found = matches.groupBy("row").agg(
        F.count_if(base).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.lit(True)).alias("labels"), F.max("share").alias("score"),
    )
    out = files.join(found, "row", "left").drop("row")
    return out.fillna(0, ["n_base"]).fillna("", ["base_labels", "labels"]).fillna(0.0, ["score"])


def _oracle(templates: tuple[Template, ...]) -> str:
    """DuckDB SQL for the same rows."""
    listed = ", ".join(
        f"({r['template']}, '{r['label']}', {r['base']}, '{r['word']}', {r['tpos']}, {r['in_key']}, {r['size']})" for r in postings(templates)
    )
    return f"""
WITH index(template, label, base, word, tpos, in_key, size) AS (VALUES {listed}),
files AS (SELECT row_number() OVER () AS file, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), '{_WORD}') AS words FROM documents),
every AS (SELECT file, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM files),
hits AS (SELECT * FROM every WHERE word IN (SELECT word FROM index)),
present AS (SELECT DISTINCT file, word FROM hits),
often AS (SELECT word, count(*) AS files FROM present GROUP BY word),
terms AS (SELECT template, word, bool_or(in_key) AS in_key FROM index GROUP BY template, word),
maybe AS (SELECT file, template FROM present JOIN terms USING (word) WHERE in_key GROUP BY file, template
  HAVING count(*) = (SELECT count(*) FROM terms t WHERE t.in_key AND t.template = terms.template)),
looked AS (SELECT * FROM (SELECT file, template, word, row_number() OVER (PARTITION BY file, template ORDER BY files, word) AS place
  FROM maybe JOIN terms USING (template) JOIN present USING (file, word) JOIN often USING (word)) WHERE place <= {RARE}),
starts AS (SELECT file, template, pos - tpos AS start FROM looked JOIN hits USING (file, word) JOIN index USING (template, word)
  GROUP BY file, template, pos - tpos
  HAVING 2 * count(DISTINCT word) >= (SELECT count(*) FROM looked l WHERE l.file = looked.file AND l.template = looked.template)),
checked AS (SELECT s.file, s.template, s.start, any_value(i.label) AS label, any_value(i.base) AS base, any_value(i.size) AS size,
  count(h.word) AS standing, count(*) FILTER (i.in_key AND h.word IS NULL) AS lacking
  FROM starts s JOIN index i ON s.template = i.template
  LEFT JOIN hits h ON h.file = s.file AND h.pos = s.start + i.tpos AND h.word = i.word GROUP BY s.file, s.template, s.start),
matches AS (SELECT * FROM checked WHERE lacking = 0 AND 100 * standing >= {MIN_PERCENT} * size),
found AS (SELECT file, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
  max(standing / size) AS score FROM matches GROUP BY file)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM files LEFT JOIN found USING (file)"""


ORACLE_SQL = _oracle(TEMPLATES)

"""Plans whose cost must not outgrow the input."""

import time

import __spark_entry__ as registered
import pytest
from pyspark.ml.feature import IDFModel
from pyspark.sql import functions as F

import reviewtide as rt
from reviewtide.plans import storage
from reviewtide.sources.store import unseen
from reviewtide.streaming.dedup import _one_per_task


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tfidf_deals_the_terms_once_and_joins_nothing(spark):
    texts = ["red fox runs", "red fox runs red fox", "", "lone", None]
    df = rt.prepare_text(spark.createDataFrame(list(enumerate(texts)), "review_id int, reviewText string"))
    weights = rt.tfidf(df)
    plan = executed(weights)
    assert "Join" not in plan and plan.count("Exchange") == 1
    counts = rt.term_counts(df, with_length=True).cache()
    expected = rt.tfidf_terms(counts, rt.idf_weights(counts))
    rows = [sorted((r.review_id, r.term or "", round(r.value, 9)) for r in x.collect()) for x in (weights, expected)]
    assert rows[0] == rows[1] and len(rows[0]) == 9


@pytest.mark.parametrize("files, dealt", [(1, True), (9, False)])
def test_documents_are_dealt_by_their_size(spark, tmp_path, monkeypatch, files, dealt):
    rows = [(i, f"text {i}", "en", "s", 6) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(files).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(registered, "DEALT_BYTES", 100)
    found = registered._all_prepared(spark, str(tmp_path))
    size = storage.file_bytes(spark, f"{tmp_path}/documents.parquet")
    assert ("Exchange" in executed(found)) == dealt
    assert not dealt or found.rdd.getNumPartitions() >= size // 100 > spark.sparkContext.defaultParallelism
    assert found.count() == 90


def test_fit_stages_reads_the_text_for_counts_only(prepared, monkeypatch):
    from reviewtide.plans import training

    kept = []
    monkeypatch.setattr(training, "materialise", lambda df, label: kept.append(label) or storage.materialise(df, label))
    model = rt.fit_stages(prepared.filter("is_train"), vocab_size=500)
    assert kept == ["counts"] and len(model.stages) == 8 and isinstance(model.stages[5], IDFModel)


def test_only_repeated_ids_are_shuffled_with_their_rows(spark, tmp_path):
    rows = [(f"m{i}", f"text {i}") for i in range(50)] + [(None, "none")] * 2
    again = [("m3", "text 3")] * 4
    stored = spark.createDataFrame([("m1",), ("m1",), ("x",)], "msg_id string")
    for given in (rows, rows + again):
        spark.createDataFrame(given, "msg_id string, review_text string").write.mode("overwrite").parquet(f"{tmp_path}/{len(given)}")
        new = unseen(spark.read.parquet(f"{tmp_path}/{len(given)}"), stored)
        got = sorted((r.msg_id or "", r.review_text) for r in new.collect())
        assert got == sorted((m or "", t) for m, t in rows if m != "m1")
        assert ("hashpartitioning" in executed(new)) == (given is not rows)
    # Most of the batch is stored: the few new ids are looked up instead.
    most = spark.createDataFrame([(f"m{i}",) for i in range(48)], "msg_id string")
    new = unseen(spark.read.parquet(f"{tmp_path}/52"), most)
    assert sorted(r.review_text for r in new.collect()) == ["none", "none", "text 48", "text 49"]


def test_copies_are_dropped_within_a_task_unless_they_are_later(spark):
    rows = [("a", 1), ("a", 1), ("b", 5), ("a", 3), ("b", 4), (None, 2), (None, 2), ("c", None), ("c", None)]
    df = spark.createDataFrame(rows, "k string, s long").select("k", F.timestamp_seconds("s").alias("at"), "s").coalesce(1)
    got = [(r.k, r.s) for r in df.mapInArrow(_one_per_task("k", "at"), df.schema).collect()]
    assert got == [("a", 1), ("b", 5), ("a", 3), (None, 2), ("c", None), ("c", None)]


def test_stream_dedup_shuffles_a_message_once(spark, tmp_path):
    spark.createDataFrame([("m",)], "msg_id string").write.json(f"{tmp_path}/in")
    stream = spark.readStream.schema("msg_id string, at timestamp").json(f"{tmp_path}/in")
    plan = rt.stream_dedup(stream, "1 day", ts="at")._jdf.queryExecution().analyzed().toString()
    assert plan.count("DeduplicateWithinWatermark") == 1


def test_each_message_is_scored_once_and_only_if_it_is_written(spark, model, tmp_path, monkeypatch):
    from reviewtide.streaming import score as module

    scored, given = module.score_messages, []
    monkeypatch.setattr(module, "score_messages", lambda m, df: given.append(df.count()) or scored(m, df))
    schema = "asin string, name string, price int, timestamp string, rating string, review_content string"
    rows = [(f"B{i}", "n", 10, "2022-11-23 00:00:00", "5" if i % 3 else "bad", f"good thing {i}") for i in range(6)]
    rt.send_messages(spark.createDataFrame(rows * 2, schema), f"{tmp_path}/queue")

    def read(name, out, rules):
        rt.stream_score(
            spark, f"{tmp_path}/queue", model, f"{tmp_path}/{out}", f"{tmp_path}/{name}", rules, f"{tmp_path}/{out}-rejects"
        ).awaitTermination()
        counts = rt.read_scored(spark, f"{tmp_path}/{out}").count(), spark.read.json(f"{tmp_path}/{out}-rejects").count()
        # The stream may end with batches without rows.
        return counts, [n for n in (given.pop(0) for _ in range(len(given))) if n]

    rules = rt.stored_review_rules(["asin", "rating"])
    assert read("one", "sink", rules) == ((4, 2), [4, 2])
    assert read("two", "sink", rules) == ((4, 2), [])
    # A rule on the class itself needs every row scored first.
    by_class = {"wrong": F.col("sentiment").isNull() | F.col("rating").isNull()}
    assert read("three", "other", by_class) == ((4, 2), [6])


@pytest.mark.parametrize("kind", ["materialise", "scratch"])
def test_a_stored_table_leaves_no_shuffle_files(spark, kind):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = manager.getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    before = files()
    frame = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "count")
    with storage.scratch(spark, "kept") as keep:
        stored = keep(frame) if kind == "scratch" else storage.materialise(frame, "stored")
        until = time.monotonic() + 10
        while files() - before and time.monotonic() < until:
            time.sleep(0.1)
        assert not files() - before
        assert stored.count() == frame.count() == 7
    assert spark.conf.get(storage.CLEAN_SHUFFLES) == "false"

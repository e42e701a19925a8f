import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

import reviewtide as rt
from reviewtide.operators import features
from reviewtide.plans.joins import hot_keys, lookup_join, measured_bytes


@pytest.fixture(scope="module")
def staged(prepared):
    return rt.fit_stages(prepared.filter("is_train"))


def predictions(model, df):
    return {r.review_id: r.predicted_sentiment for r in rt.score(model, df).collect()}


def test_one_pass_fit_equals_the_staged_fit(prepared, model, staged):
    assert list(model.stages[0].labels) == list(staged.stages[0].labels)
    ours, theirs = model.stages[4].vocabulary, staged.stages[4].vocabulary
    assert sorted(ours) == sorted(theirs)
    order = [ours.index(t) for t in theirs] + [len(ours)]
    np.testing.assert_allclose(
        model.stages[5].getScalingVec().toArray()[order[:-1]], staged.stages[5].idf.toArray(), rtol=1e-12
    )
    np.testing.assert_allclose(
        model.stages[7].theta.toArray()[:, order], staged.stages[7].theta.toArray(), rtol=1e-9
    )
    np.testing.assert_allclose(model.stages[7].pi.toArray(), staged.stages[7].pi.toArray(), rtol=1e-9)
    assert predictions(model, prepared) == predictions(staged, prepared)


def test_relational_form_equals_the_pipeline(prepared, model):
    fitted = rt.nb_fit(prepared.filter("is_train"))
    rows = rt.nb_predict(prepared, fitted, keep=("sentiment",)).collect()
    assert {r.review_id: r.predicted_sentiment for r in rows} == predictions(model, prepared)
    assert len(rows) == prepared.count()
    top = rt.top_terms(fitted, 5).collect()
    assert Counter(r.sentiment for r in top) == {s: 5 for s in fitted.labels}


@pytest.mark.parametrize("use_length,ngram,vocab_size", [(False, 2, 262144), (True, 1, 50), (False, 2, 300)])
def test_switches_agree_between_both_forms(prepared, use_length, ngram, vocab_size):
    train = prepared.filter("is_train")
    settings = {"use_length": use_length, "ngram": ngram, "vocab_size": vocab_size}
    model, fitted = rt.fit_pipeline(train, **settings), rt.nb_fit(train, **settings)
    assert fitted.weights.count() <= vocab_size
    rows = rt.nb_predict(prepared, fitted).collect()
    assert {r.review_id: r.predicted_sentiment for r in rows} == predictions(model, prepared)


def test_model_survives_saving(spark, prepared, model, tmp_path):
    path = str(tmp_path / "model")
    rt.save_model(model, path)
    rt.save_model(model, path)
    assert predictions(rt.load_model(path), prepared) == predictions(model, prepared)


def test_rows_without_class_can_be_scored(spark, model):
    text = "great thing\nwith two lines"
    df = rt.prepare_text(
        spark.createDataFrame(
            [(1, 6.0, text), (2, 6.0, text), (3, None, "short"), (4, 1.0, ""), (5, 1.0, None)],
            "review_id int, overall float, reviewText string",
        )
    )
    rows = rt.score(model, rt.with_sentiment(df)).collect()
    assert len(rows) == 4
    assert [r.sentiment for r in rows] == ["Positive", "Positive", None, "Negative"]
    assert all(r.predicted_sentiment in model.stages[0].labels for r in rows)
    names = rt.name_predictions(spark.createDataFrame([(0.0,), (1.0,)], "prediction double"), model)
    assert [r.predicted_sentiment for r in names.collect()] == list(model.stages[0].labels)[:2]


def test_fit_needs_a_class(spark, prepared):
    with pytest.raises(ValueError):
        rt.nb_fit(prepared.filter("review_id < 0"))


def test_two_classes_are_enough(prepared):
    two = prepared.filter("sentiment <> 'Neutral'")
    fitted, model = rt.nb_fit(two), rt.fit_pipeline(two)
    assert set(fitted.labels) == {"Positive", "Negative"}
    rows = rt.nb_predict(prepared, fitted).collect()
    assert {r.review_id: r.predicted_sentiment for r in rows} == predictions(model, prepared)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 6, 100])
def test_vocabulary_is_exact_with_ties(spark, size):
    totals = {"e": 9, "d": 3, "b": 3, "c": 3, "a": 1, "f": 1}
    df = spark.createDataFrame(list(totals.items()), "term string, total bigint")
    expected = sorted(totals, key=lambda t: (-totals[t], t))[:size]
    assert sorted(r.term for r in rt.vocabulary(df, size).collect()) == sorted(expected)


def test_vocabulary_of_nothing(spark):
    assert rt.vocabulary(spark.createDataFrame([], "term string, total bigint"), 5).count() == 0


def test_tfidf_by_hand(spark):
    df = rt.prepare_text(
        spark.createDataFrame(
            [(1, "red fox red fox"), (2, "red fox"), (3, "")], "review_id int, reviewText string"
        )
    )
    counts = rt.term_counts(df, with_length=True).cache()
    idf = rt.idf_weights(counts)
    weights = {(r.review_id, r.term): r.value for r in rt.tfidf_terms(counts, idf).collect()}
    both, rare = math.log(4 / 3), math.log(4 / 2)
    assert weights == pytest.approx(
        {(1, "red fox"): 2 * both, (1, "fox red"): rare, (2, "red fox"): both,
         (1, None): 15.0, (2, None): 7.0, (3, None): 0.0}
    )


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_tfidf_in_two_passes(spark, monkeypatch, limit):
    """Equal to the stored form, hot terms and rows without a term or an id included."""
    monkeypatch.setattr("reviewtide.operators.features.HOT_KEYS", 2)
    rows = [(i, "red fox " * (i % 5) + f"blue bird {i % 3} owl") for i in range(40)]
    rows += [(40, ""), (40, "red fox"), (None, "red fox")]
    df = rt.prepare_text(spark.createDataFrame(rows, "review_id int, reviewText string"))
    counts = rt.term_counts(df, with_length=True).cache()
    expected = rt.tfidf_terms(counts, rt.idf_weights(counts)).collect()
    got = rt.tfidf(df, limit=limit)
    order = lambda rows: sorted((str(r.review_id), str(r.term), round(r.value, 9)) for r in rows)
    assert order(got.collect()) == order(expected)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("inline(") == 1
    assert rt.tfidf(df.limit(0), limit=limit).count() == 0


def test_evaluation_equals_the_evaluators(prepared, model):
    index = {s: float(i) for i, s in enumerate(model.stages[0].labels)}
    scored = rt.score(model, prepared).withColumn(
        "label", F.element_at(F.create_map(*[F.lit(x) for kv in index.items() for x in kv]), F.col("sentiment"))
    ).cache()
    counts = rt.confusion(scored)
    row = rt.metrics(counts).first()
    for name, ours in (
        ("f1", row.weighted_f1), ("accuracy", row.accuracy),
        ("weightedPrecision", row.weighted_precision), ("weightedRecall", row.weighted_recall),
    ):
        assert MulticlassClassificationEvaluator(metricName=name).evaluate(scored) == pytest.approx(ours)
    assert row.n == prepared.count()
    evaluator = RegressionEvaluator(predictionCol="prediction", labelCol="label", metricName="rmse")
    assert evaluator.evaluate(scored) == pytest.approx(rt.rmse(counts, list(index)).first().rmse)


def test_metrics_of_a_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("b", None), (None, "a")], "sentiment string, predicted_sentiment string")
    rows = {r["class"]: r for r in rt.class_metrics(rt.confusion(df)).collect()}
    assert (rows["a"].precision, rows["a"].recall) == (0.5, 1.0)
    assert (rows["b"].precision, rows["b"].recall, rows["b"].f1) == (0.0, 0.0, 0.0)


def test_lookup_join_is_the_same_in_every_form(spark):
    rows = spark.range(2000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
    )
    lookup = spark.range(40).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).union(
        spark.createDataFrame([("hot", 99)], "k string, v bigint")
    )
    assert [r.k for r in hot_keys(rows, "k").collect()][0] == "hot"
    for how in ("left", "inner"):
        small = lookup_join(rows, lookup, "k", how)
        large = lookup_join(rows, lookup, "k", how, limit=0)
        assert "SortMergeJoin" not in small._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        expected = sorted(map(str, small.select("id", "k", "v").collect()))
        assert sorted(map(str, large.select("id", "k", "v").collect())) == expected
        found = rows.join(lookup, "k").count()
        assert len(expected) == (2000 if how == "left" else found)
    numbers = rows.select("id", (F.col("id") % 5).alias("n"))
    names = spark.range(4).select(F.col("id").alias("n"), F.lit("x").alias("name"))
    assert lookup_join(numbers, names, "n", limit=0).filter("name IS NULL").count() == 400
    assert measured_bytes(lookup) > 0 and measured_bytes(lookup.limit(0)) == 0


def test_predictions_do_not_multiply_copies(spark):
    msgs = spark.createDataFrame([("m1", 1), ("m1", 2), ("m2", 3), ("m3", 4)], "msg_id string, n int")
    preds = spark.createDataFrame([("m1", "Positive"), ("m1", "Positive"), ("m2", "Negative")], "msg_id string, sentiment string")
    rows = rt.attach_predictions(msgs, preds).orderBy("n").collect()
    assert [(r.n, r.sentiment) for r in rows] == [(1, "Positive"), (2, "Positive"), (3, "Negative"), (4, None)]
    products = spark.createDataFrame([("a", "A"), ("a", "A")], "asin string, name string")
    rows = rt.attach_products(spark.createDataFrame([("a", 1), ("b", 2)], "asin string, n int"), products)
    assert sorted((r.asin, r.n, r.name) for r in rows.collect()) == [("a", 1, "A"), ("b", 2, None)]


def test_training_aggregates_text_in_one_shuffle(prepared):
    stats = features.class_term_stats(prepared.filter("is_train"))
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1
    counts = rt.confusion(prepared.withColumn("predicted_sentiment", F.col("sentiment")))
    whole = stats.filter("term IS NULL").first()
    for r in rt.sentiment_counts(prepared.filter("is_train")).collect():
        assert whole[f"df_{r.sentiment}"] == r.n
    assert rt.metrics(counts).first().accuracy == 1.0

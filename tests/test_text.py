from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import NGram, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

import reviewtide as rt
from reviewtide.functions import text as X
from reviewtide.functions.fixed_values import STOP_WORDS

TEXTS = [
    "",
    "   ",
    " leading",
    "trailing  ",
    "two  blanks",
    "tab\tand\nline\x0bvertical\x0cfeed\rreturn",
    "Café Ünïcode 😀 UPPER",
    "the and of",
    "one",
    "The cat the CAT the cat sat",
    "isn't it isn't",
    "a b",
]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "id int, reviewText string")


def ml_stages(df):
    df = Tokenizer(inputCol="processedReviewText", outputCol="t").transform(df)
    df = StopWordsRemover(inputCol="t", outputCol="w").transform(df)
    return NGram(n=2, inputCol="w", outputCol="g").transform(df)


def test_stop_words_are_sparks_default(spark):
    assert list(STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    assert len(STOP_WORDS) == 181


def test_clean_text_drops_non_ascii_and_lowers(spark):
    rows = rt.prepare_text(frame(spark, ["Café 😀 OK", None, ""])).orderBy("id").collect()
    assert [(r.processedReviewText, r.length) for r in rows] == [("caf  ok", 7), ("", 0)]


def test_tokens_words_and_ngrams_equal_ml_stages(spark):
    prepared = rt.prepare_text(frame(spark))
    ours = rt.with_ngrams(rt.remove_stop_words(rt.with_tokens(prepared)))
    for row in ml_stages(ours).collect():
        assert row.tokenised_text == row.t
        assert row.tokenised_text_without_stop_words == row.w
        assert row.nGrams == row.g


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n'sSthe", max_size=12), min_size=20, max_size=40))
def test_tokens_equal_ml_stages_on_random_text(spark, texts):
    prepared = rt.prepare_text(frame(spark, texts))
    ours = rt.with_ngrams(rt.remove_stop_words(rt.with_tokens(prepared)))
    assert ml_stages(ours).filter("tokenised_text <> t OR nGrams <> g").count() == 0


def test_ngrams_of_other_sizes(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],), (["a"],), ([],)], "w array<string>")
    three = [r[0] for r in df.select(X.ngrams(F.col("w"), 3)).collect()]
    assert three == [["a b c", "b c d"], [], []]
    one = [r[0] for r in df.select(X.ngrams(F.col("w"), 1)).collect()]
    assert one == [["a", "b", "c", "d"], ["a"], []]


def test_term_counts_equal_a_plain_count(spark):
    prepared = rt.prepare_text(frame(spark)).withColumnRenamed("id", "review_id")
    grams = rt.with_ngrams(rt.remove_stop_words(rt.with_tokens(prepared)))
    expected = {
        (r.review_id, t): n for r in grams.collect() for t, n in Counter(r.nGrams).items()
    }
    rows = rt.term_counts(prepared).collect()
    assert {(r.review_id, r.term): r.n for r in rows} == expected
    assert len(rows) == len(expected)


def test_term_counts_need_no_shuffle(spark):
    prepared = rt.prepare_text(frame(spark)).withColumnRenamed("id", "review_id")
    plan = rt.term_counts(prepared)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_content_id_separates_values(spark):
    rows = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), ("a|b", ""), ("-", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(X.content_id("x", "y")).distinct().count() == len(rows)
    again = df.union(df).select(X.content_id("x", "y"))
    assert again.distinct().count() == len(rows)


def test_split_is_complete_disjoint_and_repeatable(spark):
    ids = spark.range(5000).withColumnRenamed("id", "review_id")
    first = rt.split_by_key(ids, "review_id")
    assert first.filter("is_train IS NULL").count() == 0
    train = first.filter("is_train").count()
    assert 0.77 < train / 5000 < 0.83
    moved = rt.split_by_key(ids.repartition(7), "review_id")
    assert first.exceptAll(moved).count() == 0
    assert 0.72 < rt.split_by_key(ids, "review_id", 75).filter("is_train").count() / 5000 < 0.78


def test_random_split_parts_add_up(spark):
    train, test = rt.random_split(spark.range(1000), seed=7)
    assert train.count() + test.count() == 1000
    assert train.intersect(test).count() == 0

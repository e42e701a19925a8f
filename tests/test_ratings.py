import datetime

from pyspark.sql import functions as F

import reviewtide as rt
from reviewtide.functions.ratings import parse_rating


def test_sentiment_of_every_case(spark):
    cases = [
        (5.0, "Positive"), (4.5, "Positive"), (6.0, "Positive"), (4.0, "Neutral"),
        (3.5, "Neutral"), (3.0, "Negative"), (1.0, "Negative"), (0.0, "Negative"),
        (None, None), (float("nan"), None),
    ]
    for kind in ("float", "double"):
        df = spark.createDataFrame(cases, f"overall {kind}, expected string")
        rows = rt.with_sentiment(df).collect()
        assert [r.sentiment for r in rows] == [r.expected for r in rows]


def test_parse_price_and_rating(spark):
    df = spark.createDataFrame([("1,299.",), ("49",), ("free",), ("",), (None,)], "p string")
    assert [r[0] for r in df.select(rt.parse_price(F.col("p"))).collect()] == [
        1299, 49, None, None, None,
    ]
    df = spark.createDataFrame([("4.5",), (" 5 ",), ("five",), (None,)], "r string")
    assert [r[0] for r in df.select(parse_rating(F.col("r"))).collect()] == [4.5, 5.0, None, None]


def test_days(spark):
    df = spark.createDataFrame(
        [("2022-11-23 00:00:00",), ("2022-11-23",), ("2022-11-31",), ("soon",), (None,)], "t string"
    )
    day = rt.day_of(F.col("t"))
    rows = df.select(day.alias("d"), rt.shift_days(day, 3).alias("before")).collect()
    assert rows[0] == rows[1] == (datetime.date(2022, 11, 23), datetime.date(2022, 11, 20))
    assert [r.d for r in rows[2:]] == [None, None, None]


def test_recent_is_strict(spark):
    df = spark.createDataFrame([("2022-11-01",), ("2022-11-02",), ("2022-12-01",)], "d string")
    df = df.withColumn("d", F.col("d").cast("date"))
    kept = rt.recent(df, "d", datetime.date(2022, 12, 1), 30).orderBy("d").collect()
    assert [str(r.d) for r in kept] == ["2022-11-02", "2022-12-01"]


def test_label_index_breaks_ties_by_name(spark):
    names = ["Neutral"] * 2 + ["Negative"] * 2 + ["Positive"] * 3 + [None]
    df = spark.createDataFrame([(n,) for n in names], "sentiment string")
    rows = rt.label_index(df).orderBy("label_index").collect()
    assert [(r.sentiment, r.label_index, r.n) for r in rows] == [
        ("Positive", 0.0, 3), ("Negative", 1.0, 2), ("Neutral", 2.0, 2),
    ]
    counts = {r.sentiment: r.n for r in rt.sentiment_counts(df).collect()}
    assert counts == {"Positive": 3, "Negative": 2, "Neutral": 2, None: 1}

import datetime

from pyspark.sql import functions as F

import reviewtide as rt

ROWS = [
    ("a", "2022-11-03 10:00:00", 5.0, "Positive"),
    ("a", "2022-11-04 10:00:00", 3.0, "Positive"),
    ("a", "2022-11-10 10:00:00", 1.0, "Negative"),
    ("a", "2022-11-24 10:00:00", 4.0, None),
    ("b", "2022-11-03 10:00:00", 2.0, "Neutral"),
]


def frame(spark):
    df = spark.createDataFrame(ROWS, "asin string, timestamp string, rating double, sentiment string")
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def test_rating_trend_change_and_smoothing(spark):
    trend = rt.rating_trend(frame(spark))
    rows = rt.rating_smoothed(rt.rating_change(trend), 2).orderBy("asin", "period_start").collect()
    got = [
        (r.asin, r.period_start.date(), r.n_reviews, r.avg_rating, r.rating_change, r.smoothed_rating)
        for r in rows
    ]
    day = datetime.date
    assert got == [
        ("a", day(2022, 11, 3), 2, 4.0, None, 4.0),
        ("a", day(2022, 11, 10), 1, 1.0, -3.0, 2.5),
        ("a", day(2022, 11, 24), 1, 4.0, None, 4.0),
        ("b", day(2022, 11, 3), 1, 2.0, None, 2.0),
    ]


def test_periods_are_those_of_the_calendar(spark):
    """Also without a time zone, before 1970, and where a zone's clock changes within a period."""
    days = ["1969-12-18", "1969-12-25", "1970-01-08", "2022-10-27", "2022-11-03", "2022-11-10", "2022-11-24"]
    df = spark.createDataFrame([("a", f"{d} 10:00:00", float(i)) for i, d in enumerate(days)], "asin string, timestamp string, rating double")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for kind, name in (("timestamp", "America/New_York"), ("timestamp", "UTC"), ("timestamp_ntz", "America/New_York")):
            spark.conf.set("spark.sql.session.timeZone", name)
            trend = rt.rating_trend(df.withColumn("timestamp", F.col("timestamp").cast(kind)))
            rows = rt.rating_smoothed(rt.rating_change(trend), 3).orderBy("period_start").collect()
            assert [r.rating_change for r in rows] == [None, 1.0, None, None, 1.0, 1.0, None]
            assert [r.smoothed_rating for r in rows] == [0.0, 0.5, 1.5, 3.0, 3.5, 4.0, 5.5]
            filled = rt.every_period(trend)
            assert filled.columns == trend.columns and filled.dtypes == trend.dtypes
            assert filled.filter("n_reviews > 0").count() == 7
            assert filled.select("period_start").distinct().count() == filled.count() == (19334 // 7) + 1
            assert filled.join(trend, ["asin", "period_start"]).count() == 7
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sentiment_trend_adds_up(spark):
    rows = rt.sentiment_trend(frame(spark)).collect()
    assert sum(r.n_reviews for r in rows) == 4
    for r in rows:
        assert r.n_positive + r.n_neutral + r.n_negative == r.n_reviews
        assert abs(r.share_positive + r.share_neutral + r.share_negative - 1) < 1e-12


def test_agreement(spark):
    rows = {r.asin: (r.n_reviews, r.n_agree, r.agreement) for r in rt.sentiment_agreement(frame(spark)).collect()}
    assert rows == {"a": (3, 2, 2 / 3), "b": (1, 0, 0.0)}

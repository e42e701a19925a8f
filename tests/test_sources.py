import gzip
import json

import pytest
from pyspark.sql import functions as F

from conftest import SMALL

import __spark_entry__ as registered
import reviewtide as rt
from reviewtide.plans import storage
from reviewtide.schemas import RAW_REVIEW
from reviewtide.sources import tables


def lines(path, rows, zipped=False):
    text = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n"
    with (gzip.open if zipped else open)(path, "wt") as out:
        out.write(text)


ROWS = [
    {"overall": 5, "reviewText": "good", "summary": "s", "asin": "1", "style": {"Format:": " X"}},
    {"overall": 4.5, "reviewText": "é\n2"},
    {"summary": None},
    "not json",
    "  ",
    {"overall": "x", "reviewText": "kept"},
]


@pytest.mark.parametrize("zipped", [False, True])
def test_read_reviews(spark, tmp_path, zipped):
    path = str(tmp_path / ("r.json.gz" if zipped else "r.json"))
    lines(path, ROWS, zipped)
    df = rt.read_reviews(spark, path, partitions=3 if zipped else None)
    assert df.columns == ["overall", "reviewText", "summary"]
    assert df.count() == 4
    got = sorted(map(tuple, df.collect()), key=str)
    assert got == sorted([(5.0, "good", "s"), (4.5, "é\n2", None), (None, None, None), (None, "kept", None)], key=str)
    kept = rt.read_reviews(spark, path, keep_corrupt=True)
    assert kept.filter("_corrupt_record = 'not json'").count() == 1 and kept.count() == 5
    assert [r.line for r in rt.unreadable_lines(spark, path).collect()] == ["not json"]


def test_objects_of_wrong_types_are_kept(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"overall":"five"}\n{"overall":[1]}\n[1]\n{"overall":1\n\n')
    path = str(tmp_path / "r.json")
    assert [r.overall for r in rt.read_reviews(spark, path).collect()] == [None, None]
    assert sorted(r.line for r in rt.unreadable_lines(spark, path).collect()) == ["[1]", '{"overall":1']


def test_raw_schema(spark, tmp_path):
    path = str(tmp_path / "raw.json")
    lines(path, [{**ROWS[0], "verified": True, "unixReviewTime": 937612800, "vote": "67"}])
    row = rt.read_reviews(spark, path, RAW_REVIEW).select(
        "*", F.timestamp_seconds("unixReviewTime").cast("string").alias("ts")
    ).first()
    assert row.style == {"Format:": " X"} and row.verified and row.ts == "1999-09-18 00:00:00"


def test_written_lines_keep_null_keys_and_limits(spark, tmp_path):
    df = spark.createDataFrame(
        [(5.0, f"text {i}", None) for i in range(100)], "overall float, reviewText string, summary string"
    ).coalesce(1)
    rt.write_reviews(df, str(tmp_path / "a"), max_records=30)
    files = sorted((tmp_path / "a").glob("part-*.json"))
    sizes = [len(f.read_text().splitlines()) for f in files]
    assert sorted(sizes) == [10, 30, 30, 30]
    first = json.loads(files[0].read_text().splitlines()[0])
    assert set(first) == {"overall", "reviewText", "summary"} and first["summary"] is None
    rt.write_reviews(df, str(tmp_path / "b"), max_bytes=1000)
    assert all(f.stat().st_size < 1100 for f in (tmp_path / "b").glob("part-*.json"))
    assert rt.read_reviews(spark, str(tmp_path / "b")).exceptAll(df).count() == 0
    with pytest.raises(Exception):
        rt.write_reviews(df, str(tmp_path / "a"))


def test_pages_from_files(spark, tmp_path):
    (tmp_path / "x.html").write_text("<p>a\nb</p>")
    row = rt.read_pages(spark, str(tmp_path), fmt="html").first()
    assert row.html == "<p>a\nb</p>" and row.url.endswith("x.html")


def test_text_frames_read_documents_only(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("clean_reviews", "tokens", "tokens_no_stop", "bigrams", "recent_reviews", "review_dates", "train_test_split"):
            plan = registered.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
            # Local sessions deal the raw rows of a one-file table over the cores; that is the only exchange.
            assert plan.count("Exchange") == plan.count("Exchange RoundRobinPartitioning") <= 1 and "labels" not in plan
        for frame in (tables.reviews_unrated(spark, SMALL), rt.with_tokens(rt.prepare_text(tables.reviews_unrated(spark, SMALL)))):
            assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_shared_dir_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert storage.shared_dir(spark) == named.rstrip("/")
    assert storage.new_dir(spark, "x") != storage.new_dir(spark, "x")


MESSAGES = [
    {"asin": "B01", "name": "n", "price": 49, "timestamp": "2022-11-23 00:00:00", "rating": 5, "review_content": "très bien"},
    {"asin": "B02", "name": "n", "category": "Toys", "price": 1.5, "timestamp": "2022-11-24 10:00:00", "rating": 4, "review_content": "ok"},
    {"asin": "B03", "name": "n", "category": "Electronics", "reviewDate": "2022-11-25", "overall": "4.5", "reviewText": "fine"},
    {"asin": "B0123456789", "name": None, "timestamp": "never", "rating": "x", "review_content": None},
    {"asin": " "},
    "{broken",
]


def decoded(spark, rows=MESSAGES):
    texts = [(r if isinstance(r, str) else json.dumps(r),) for r in rows]
    df = spark.createDataFrame(texts, "value string")
    return rt.normalise_types(rt.with_msg_id(rt.decode_messages(df)))


def test_decode_all_message_forms(spark):
    rows = {r.asin: r for r in decoded(spark).collect()}
    b1, b2, b3 = rows["B01"], rows["B02"], rows["B03"]
    assert (b1.rating, str(b1.review_date), b1.review_text, b1.category, str(b1.price)) == (
        5.0, "2022-11-23", "très bien", "Electronics", "49.00",
    )
    assert (b2.category, str(b2.price)) == ("Toys", "1.50")
    assert (b3.rating, str(b3.review_date), b3.review_text, b3.price) == (4.5, "2022-11-25", "fine", None)
    assert rows[None]._corrupt_record == "{broken"


def test_quality_split_is_complete(spark):
    df = decoded(spark)
    valid, rejected = rt.check_quality(df)
    assert valid.count() + rejected.count() == len(MESSAGES)
    assert {r.asin for r in valid.collect()} == {"B01", "B02"}
    reasons = {r.asin: set(r.reasons) for r in rejected.collect()}
    assert reasons["B03"] == {"price_missing"}
    assert reasons["B0123456789"] == {
        "asin_too_long", "name_missing", "price_missing", "date_missing", "rating_missing",
        "text_missing",
    }
    assert {"asin_empty", "unreadable"} & reasons[" "] == {"asin_empty"}
    assert "unreadable" in reasons[None]


def test_quality_limits(spark):
    df = spark.createDataFrame(
        [("a", "x" * 151, 1.0, 5.0), ("b", "x", -1.0, float("nan")), ("c", "x", 0.0, 10.5)],
        "asin string, category string, price double, rating float",
    )
    reasons = {r.asin: r.reasons for r in rt.tag_quality(df).collect()}
    assert reasons == {
        "a": ["category_too_long"],
        "b": ["rating_out_of_range", "price_negative"],
        "c": ["rating_out_of_range"],
    }
    own = {"cheap": F.col("price") < 1}
    assert rt.check_quality(df, own)[1].count() == 2


def test_message_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("B01", None, "a\n\"b\""), ("B02", 3, "")], "asin string, rating int, review_content string")
    rt.send_messages(df, str(tmp_path / "q"))
    back = rt.decode_messages(spark.read.text(str(tmp_path / "q"))).orderBy("asin").collect()
    assert [(r.asin, r.rating, r.review_text) for r in back] == [("B01", None, 'a\n"b"'), ("B02", "3", "")]


def test_store_is_idempotent_and_pruned(spark, tmp_path):
    path = str(tmp_path / "store")
    df = rt.with_sentiment(decoded(spark, MESSAGES[:2]), "rating")
    rt.append_scored(df, path, 0)
    rt.append_scored(df, path, 0)
    assert rt.read_scored(spark, path).count() == 2
    rt.append_scored(df, path, 1)
    stored = rt.read_scored(spark, path)
    assert stored.count() == 4
    one_day = stored.filter("review_date = date'2022-11-23'")
    assert "PartitionFilters: [isnotnull(review_date" in one_day._jdf.queryExecution().executedPlan().toString()
    assert {r.sentiment for r in one_day.collect()} == {"Positive"}
    assert rt.preview(stored, 3).count() == 3

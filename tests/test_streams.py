import json
import os

import pytest

import reviewtide as rt

SCHEMA = "asin string, name string, price int, timestamp string, rating string, review_content string"


def message(n, day="2022-11-23", rating="5", text="good thing works well"):
    return (f"B{n}", "n", 10, f"{day} 00:00:00", rating, None if text is None else f"{text} {n}")


def send(spark, path, rows):
    rt.send_messages(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)


def run(spark, model, base, **options):
    query = rt.stream_score(
        spark, f"{base}/queue", model, f"{base}/sink", f"{base}/checkpoint", **options
    )
    query.awaitTermination()
    return rt.read_scored(spark, f"{base}/sink")


def test_scoring_continues_and_equals_batch(spark, model, tmp_path):
    base = str(tmp_path)
    send(spark, f"{base}/queue", [message(1), message(2, text=None)])
    assert run(spark, model, base).count() == 2
    send(spark, f"{base}/queue", [message(3, day="2022-11-24")])
    stored = run(spark, model, base)
    assert stored.count() == 3
    assert run(spark, model, base).count() == 3
    batch = rt.scored_stream(spark.read.text(f"{base}/queue"), model)
    columns = ["msg_id", "asin", "review_date", "sentiment"]
    assert sorted(map(str, stored.select(columns).collect())) == sorted(map(str, batch.select(columns).collect()))
    assert {r.asin: r.sentiment is None for r in stored.collect()} == {"B1": False, "B2": True, "B3": False}


def test_replayed_batch_adds_no_rows(spark, model, tmp_path):
    base = str(tmp_path)
    send(spark, f"{base}/queue", [message(n) for n in range(5)])
    assert run(spark, model, base, dedup_delay=None).count() == 5
    # Forget that the batch was finished: the next run repeats it, as after a crash.
    commits = [f for f in os.listdir(f"{base}/checkpoint/commits") if not f.endswith(".crc")]
    for name in os.listdir(f"{base}/checkpoint/commits"):
        os.unlink(f"{base}/checkpoint/commits/{name}")
    assert commits == ["0"]
    assert run(spark, model, base, dedup_delay=None).count() == 5


def test_second_checkpoint_adds_to_the_same_table(spark, model, tmp_path):
    send(spark, f"{tmp_path}/one", [message(n) for n in range(4)])
    send(spark, f"{tmp_path}/two", [message(n) for n in range(10, 16)])
    for name in ("one", "two", "one"):
        rt.stream_score(
            spark, f"{tmp_path}/{name}", model, f"{tmp_path}/sink", f"{tmp_path}/check-{name}"
        ).awaitTermination()
    stored = rt.read_scored(spark, f"{tmp_path}/sink").collect()
    assert len(stored) == len({r.msg_id for r in stored}) == 10


def test_redelivered_messages_are_stored_once(spark, model, tmp_path):
    base = str(tmp_path)
    for _ in range(2):
        send(spark, f"{base}/queue", [message(n) for n in range(5)])
    assert run(spark, model, base).count() == 5


def test_two_checkpoints_store_one_queue_once(spark, model, tmp_path):
    base = str(tmp_path)
    send(spark, f"{base}/queue", [message(n) for n in range(5)] + [message(9, day="2022-13-01")])
    rules = rt.stored_review_rules(["asin", "review_date", "rating"])

    def read(name):
        rt.stream_score(
            spark, f"{base}/queue", model, f"{base}/sink", f"{base}/{name}", rules, f"{base}/rejects", dedup_delay=None
        ).awaitTermination()
        stored = [r.asin for r in rt.read_scored(spark, f"{base}/sink").collect()]
        return sorted(stored), [r.asin for r in spark.read.json(f"{base}/rejects").collect()]

    first = (["B0", "B1", "B2", "B3", "B4"], ["B9"])
    assert read("one") == first and read("two") == first
    # A replay writes its own rows again; it neither loses them nor adds to those of the other stream.
    for name in os.listdir(f"{base}/one/commits"):
        os.unlink(f"{base}/one/commits/{name}")
    assert read("one") == first
    send(spark, f"{base}/queue", [message(n, day="2022-11-25") for n in range(3, 7)] * 2)
    more = (sorted(first[0] + ["B3", "B4", "B5", "B6"]), ["B9"])
    assert read("two") == more and read("one") == more


def test_loads_append_a_message_once(spark, tmp_path):
    columns = ("price decimal(10,2), review_text string, category string, rating float, sentiment string, "
               "msg_id string, asin string, name string, review_date string")
    rows = [(None, None, None, None, None, f"m{i % 40}" if i % 9 else None, f"a{i}", "n", "2022-11-0%d" % (i % 40 % 5 + 1)) for i in range(90)]
    df = spark.createDataFrame(rows, columns).selectExpr("* EXCEPT (review_date)", "CAST(review_date AS date) AS review_date")
    path = f"{tmp_path}/table"
    for load in ("one", "two", "one"):
        rt.append_once(df, path, run=load)
    stored = rt.read_scored(spark, path).collect()
    ids = [r.msg_id for r in stored if r.msg_id is not None]
    assert len(ids) == len(set(ids)) == len({r[5] for r in rows if r[5]})
    assert sum(r.msg_id is None for r in stored) == 2 * sum(r[5] is None for r in rows)


def test_rules_need_a_place_for_rejects(spark, model, tmp_path):
    with pytest.raises(ValueError):
        run(spark, model, str(tmp_path), rules={})


def test_rejects_go_apart(spark, model, tmp_path):
    base = str(tmp_path)
    send(spark, f"{base}/queue", [message(1), message(2, rating="bad"), message(3, day="2022-13-01")])
    scored = rt.scored_stream(spark.createDataFrame([("{}",)], "value string"), model)
    rules = rt.stored_review_rules(scored.columns)
    stored = run(spark, model, base, rules=rules, rejects=f"{base}/rejects")
    assert [r.asin for r in stored.collect()] == ["B1"]
    rejected = {r.asin: r.reasons for r in spark.read.json(f"{base}/rejects").collect()}
    assert rejected == {"B2": ["rating_missing"], "B3": ["date_missing"]}


def test_redelivered_messages_are_dropped(spark, model, tmp_path):
    base = str(tmp_path)
    rows = [message(n) for n in range(12)] + [message(13, day="broken")]
    send(spark, f"{base}/queue", rows + rows[:1] * 50)
    stored = run(spark, model, base, dedup_delay="1 hour", max_files=1)
    assert stored.count() == 13
    send(spark, f"{base}/queue", rows[3:5] + [message(20)])
    assert run(spark, model, base, dedup_delay="1 hour", max_files=1).count() == 14


def test_dedup_with_and_without_spreading(spark, tmp_path):
    rows = [(f"m{n % 7}", "2022-11-23 00:00:00") for n in range(60)] + [("m1", "2022-11-23 00:05:00")]
    src = str(tmp_path / "src")
    df = spark.createDataFrame(rows, "msg_id string, timestamp string")
    df.repartition(6).write.json(src)
    for spread in (1, 4):
        stream = spark.readStream.schema("msg_id string, timestamp timestamp").json(src)
        out, check = str(tmp_path / f"o{spread}"), str(tmp_path / f"c{spread}")
        single = rt.stream_dedup(stream, "1 hour", spread=spread)
        query = single.writeStream.format("parquet").option("checkpointLocation", check)
        query.trigger(availableNow=True).start(out).awaitTermination()
        got = [r.msg_id for r in spark.read.parquet(out).collect()]
        assert sorted(got) == [f"m{n}" for n in range(7)]


def write_ratings(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as out:
        for asin, ts, rating in rows:
            out.write(json.dumps({"asin": asin, "timestamp": ts, "rating": rating}) + "\n")


def ratings_stream(spark, path):
    schema = "asin string, timestamp timestamp, rating double"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)


def test_trend_updates_across_batches(spark, tmp_path):
    src = str(tmp_path / "src")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run_once():
        trend = rt.stream_trend(ratings_stream(spark, src), delay="30 days")
        rt.write_trend(trend, out, check).awaitTermination()
        rows = rt.read_trend(spark, out).orderBy("asin", "period_start").collect()
        return [(r.asin, str(r.period_start.date()), r.n_reviews, r.avg_rating) for r in rows]

    write_ratings(src, "1", [("a", "2022-11-03 01:00:00", 5.0), ("a", "2022-11-11 01:00:00", 1.0)])
    assert run_once() == [("a", "2022-11-03", 1, 5.0), ("a", "2022-11-10", 1, 1.0)]
    write_ratings(src, "2", [("a", "2022-11-04 01:00:00", 3.0), ("b", "2022-11-04 01:00:00", 2.0)])
    expected = [("a", "2022-11-03", 2, 4.0), ("a", "2022-11-10", 1, 1.0), ("b", "2022-11-03", 1, 2.0)]
    assert run_once() == expected
    batch = rt.rating_trend(spark.read.schema("asin string, timestamp timestamp, rating double").json(src))
    rows = [(r.asin, str(r.period_start.date()), r.n_reviews, r.avg_rating) for r in batch.collect()]
    assert sorted(rows) == expected


def test_trend_append_emits_complete_periods_and_ignores_late_rows(spark, tmp_path):
    src = str(tmp_path / "src")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run_once():
        trend = rt.stream_trend(ratings_stream(spark, src), delay="1 day")
        query = trend.writeStream.format("parquet").option("checkpointLocation", check)
        query.trigger(availableNow=True).start(out).awaitTermination()
        schema = "asin string, period_start timestamp, n_reviews bigint, avg_rating double"
        rows = spark.read.schema(schema).parquet(out).orderBy("period_start").collect()
        return [(str(r.period_start.date()), r.n_reviews, r.avg_rating) for r in rows]

    write_ratings(src, "1", [("a", "2022-11-03 01:00:00", 5.0)])
    run_once()
    write_ratings(src, "2", [("a", "2022-11-12 01:00:00", 1.0)])
    assert run_once() == [("2022-11-03", 1, 5.0)]
    write_ratings(src, "3", [("a", "2022-11-04 01:00:00", 1.0), ("a", "2022-11-25 01:00:00", 3.0)])
    assert run_once() == [("2022-11-03", 1, 5.0), ("2022-11-10", 1, 1.0)]

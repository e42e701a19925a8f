import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import reviewtide as rt
from reviewtide.operators.features import vocabulary
from reviewtide.plans.numbering import number_rows
from reviewtide.sources import batches
from reviewtide.sources.reviews import _file_numbers

SCHEMA = "k bigint, v string, day date"


def put(spark, path, run, batch_id, keys):
    rows = spark.createDataFrame([(k, f"{run}-{batch_id}-{k}") for k in keys], "k bigint, v string")
    dated = rows.withColumn("day", F.date_add(F.lit("2022-11-01").cast("date"), (F.col("k") % 3).cast("int")))
    dated.write.mode("overwrite").partitionBy("day").parquet(batches.batch_folder(path, run, batch_id))


def write(rows, to):
    rows.coalesce(1).write.partitionBy("day").parquet(to)


def held(spark, path):
    return sorted((r.run, r.batch_id, r.k, r.v) for r in batches.read_batches(spark, path, SCHEMA).collect())


def test_fold_keeps_every_row_and_few_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "FANOUT", 3)
    path, expected = str(tmp_path / "t"), []
    for n in range(10):
        run = "load" if n % 2 else "other name"
        put(spark, path, run, n, [n, n + 1])
        expected += [(run, str(n), k, f"{run}-{n}-{k}") for k in (n, n + 1)]
        assert held(spark, path) == sorted(expected)
        found = batches.fold(spark, path, SCHEMA, write)
        assert held(spark, path) == sorted(expected)
        assert len(found.tables) <= 2 * 3
    assert [level for _, level in found.tables].count(0) < 3
    assert found.settled == {"load": [[n, n] for n in range(1, 10, 2)], "other name": [[n, n] for n in range(0, 10, 2)]}
    # Only the last fold's input is still there for readers that began before it.
    assert [p.parent.name + "/" + p.name for p in (tmp_path / "t").glob("run=*/*")] == ["run=load/batch_id=9"]
    assert batches.fold(spark, path, SCHEMA, write).version == 10
    assert list((tmp_path / "t").glob("run=*/*")) == []


def test_reader_that_began_before_a_fold_still_reads(spark, tmp_path):
    path = str(tmp_path)
    for n in range(3):
        put(spark, path, "a", n, [n])
    before = batches.read_batches(spark, path, SCHEMA)
    batches.fold(spark, path, SCHEMA, write)
    assert before.count() == 3


def test_unfinished_batches_and_failed_folds_change_nothing(spark, tmp_path):
    path = str(tmp_path)
    put(spark, path, "a", 0, [1])
    put(spark, path, "a", "late", [2])
    marker = tmp_path / "run=a" / "batch_id=late" / "_SUCCESS"
    marker.unlink()

    def fail(rows, to):
        write(rows, to)
        raise OSError("lost")

    with pytest.raises(OSError):
        batches.fold(spark, path, SCHEMA, fail)
    assert len(held(spark, path)) == 2 and not batches.settled(spark, path, "a", 0)
    batches.fold(spark, path, SCHEMA, write)
    assert batches.settled(spark, path, "a", 0) and not batches.settled(spark, path, "a", "late")
    assert len(held(spark, path)) == 2
    marker.touch()
    batches.fold(spark, path, SCHEMA, write)
    assert batches.settled(spark, path, "a", "late") and len(held(spark, path)) == 2


def test_two_folds_cannot_write_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    put(spark, path, "a", 0, [1])
    batches.fold(spark, path, SCHEMA, write)
    put(spark, path, "a", 1, [2])
    monkeypatch.setattr(batches, "manifest", lambda *_: batches.Manifest())
    with pytest.raises(FileExistsError):
        batches.fold(spark, path, SCHEMA, write)


def test_settled_batches_are_ranges(spark):
    known = batches._settle([], [str(n) for n in range(5)])
    assert known == [[0, 4]]
    known = batches._settle(known, ["7", "6", "x", "007"])
    assert known == [[0, 4], [6, 7], "007", "x"]
    found = batches.Manifest(settled={"a": batches._settle(known, ["5"])})
    assert found.settled["a"][0] == [0, 7] and found.has("a", 3) and found.has("a", "x") and not found.has("b", 3)
    assert not found.has("a", 8) and not found.has("a", "07")


RESULT = ("price decimal(10,2), review_text string, category string, rating float, sentiment string, "
          "msg_id string, asin string, name string, day string")


def results(spark, ids):
    rows = [(None, "t", None, 4.0, None, f"m{i}", "a", "n", f"2022-11-0{i % 4 + 1}") for i in ids]
    df = spark.createDataFrame(rows, RESULT)
    return df.withColumn("review_date", F.col("day").cast("date")).drop("day")


def test_compacted_results_and_replays(spark, tmp_path):
    path = str(tmp_path)
    for batch_id in range(4):
        rt.append_scored(results(spark, range(10 * batch_id, 10 * batch_id + 10)), path, "s", batch_id)
    rt.compact_scored(spark, path)
    # A replay of a folded batch and a second load of its messages add nothing.
    rt.append_scored(results(spark, range(10)), path, "s", 0)
    rt.append_once(results(spark, range(30, 45)), path, "other")
    ids = sorted(int(r.msg_id[1:]) for r in rt.read_scored(spark, path).collect())
    assert ids == list(range(45))
    rt.compact_scored(spark, path)
    assert rt.read_scored(spark, path).count() == 45
    assert rt.read_scored(spark, path).filter("review_date = DATE'2022-11-02'").count() == 11
    # Dates are folders of the folded tables as well.
    scan = rt.read_scored(spark, path).filter("review_date = DATE'2022-11-02'")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(review_date" in scan.toString()


def test_trend_of_many_batches_has_few_files(spark, tmp_path):
    rows = [(f"P{i % 3}", f"2022-11-{i % 28 + 1:02d} 00:00:00", float(i % 5 + 1)) for i in range(240)]
    ratings = spark.createDataFrame(rows, "asin string, timestamp string, rating double")
    ratings = ratings.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    ratings.repartition(24).write.parquet(f"{tmp_path}/in")
    arriving = spark.readStream.schema(ratings.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    trend = rt.stream_trend(arriving, delay="60 days")
    rt.write_trend(trend, f"{tmp_path}/out", f"{tmp_path}/check", fold_every=4).awaitTermination()
    batch = rt.rating_trend(ratings)
    got = rt.read_trend(spark, f"{tmp_path}/out").select(batch.columns)
    key = lambda r: (r.asin, r.period_start)
    assert [(key(r), r.n_reviews, round(r.avg_rating, 9)) for r in sorted(got.collect(), key=key)] == [
        (key(r), r.n_reviews, round(r.avg_rating, 9)) for r in sorted(batch.collect(), key=key)
    ]
    found = batches.manifest(spark, f"{tmp_path}/out")
    assert found.version >= 5 and len(list((tmp_path / "out").glob("run=*/*"))) <= 8
    table = spark.read.parquet(f"{tmp_path}/out/{found.tables[0][0]}")
    assert table.count() == table.select("asin", "period_start").distinct().count()


def test_files_are_bounded_whatever_the_line_lengths(spark, tmp_path):
    rng = random.Random(3)
    texts = ["é" * rng.choice([0, 1, 5, 40, 300, 3000]) + "\n" for _ in range(400)] + [None, ""]
    df = spark.createDataFrame([(5.0, t, None) for t in texts], "overall float, reviewText string, summary string")
    rt.write_reviews(df.repartition(3), str(tmp_path / "a"), max_bytes=4000)
    files = [f for f in (tmp_path / "a").rglob("part-*") if f.suffix != ".crc"]
    over = [f for f in files if f.stat().st_size > 4000]
    assert over and all(len(f.read_bytes().splitlines()) == 1 for f in over)
    # As full as the order of lines allows: two files that follow each other do not fit into one.
    assert len(files) < 2 * sum(f.stat().st_size for f in files) / 4000 + 6
    line = json.loads(files[0].read_text().splitlines()[0])
    assert set(line) == {"overall", "reviewText", "summary"}
    read = rt.read_reviews(spark, str(tmp_path / "a"))
    assert read.columns == df.columns and sorted(map(str, read.collect())) == sorted(map(str, df.collect()))


def test_file_numbers_go_on_over_batches():
    rng = np.random.default_rng(5)
    for _ in range(200):
        lengths = rng.integers(1, 30, 40)
        expected, number, filled = [], 0, 0
        for n in lengths:
            if filled and filled + n > 25:
                number, filled = number + 1, 0
            filled += n
            expected.append(number)
        got, last, held_bytes = [], 0, 0
        for part in np.split(lengths, sorted(rng.integers(0, 40, 3))):
            if len(part):
                files, last, held_bytes = _file_numbers(part, 25, last, held_bytes)
                got += files.tolist()
        assert got == expected


def test_numbers_are_dense_in_order(spark):
    rows = spark.range(5000).selectExpr("id", "id % 2 AS hot", "hash(id) AS h").repartition(7)
    found = number_rows(rows, "hot", "h", "id", name="n", first=1).collect()
    assert [(r.hot, r.h, r.id) for r in sorted(found, key=lambda r: r.n)] == sorted((r.hot, r.h, r.id) for r in found)
    assert sorted(r.n for r in found) == list(range(1, 5001))
    assert number_rows(rows.filter("id < 0"), "id").count() == 0


def test_vocabulary_ties_are_cut_in_term_order(spark):
    totals = spark.createDataFrame([(f"t{i:04d}", 9 if i < 5 else 1) for i in range(3000)], "term string, total bigint")
    kept = sorted(r.term for r in vocabulary(totals.repartition(6), 1200).collect())
    assert kept == [f"t{i:04d}" for i in range(1200)]
    plan = vocabulary(totals, 1200)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan

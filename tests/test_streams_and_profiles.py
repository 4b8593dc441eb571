"""Cursors as state, late rows, and profiles that add up."""

import datetime as dt
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gazette.functions.dates import iso_time
from gazette.operators import incremental, mergeable
from gazette.streaming import cursors
from gazette.streaming.late import late_rows

START = dt.datetime(2024, 1, 1)


def delivered(spark, path, rows):
    spark.createDataFrame(rows, "rss string, unixTime long").coalesce(1).write.mode("append").parquet(path)


def run_once(spark, root, registry=None):
    out = []
    entries = spark.readStream.schema("rss string, unixTime long").parquet(f"{root}/inbox")
    cursors.cursor_stream(entries, registry).writeStream.foreachBatch(lambda df, i: out.extend(df.collect())).outputMode(
        "update").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return sorted((r.url, r.dt, r.entries, r.stalled) for r in out)


def test_cursors_survive_a_restart_and_never_move_back(spark, tmp_path):
    root = str(tmp_path)
    registry = spark.createDataFrame([("a", 100), ("b", 50), (None, 1), ("c", None)], "url string, dt long")
    delivered(spark, f"{root}/inbox", [("a", 90), ("a", 100), ("b", 70), ("b", 60), ("new", 5), (None, 7), ("b", None)])
    assert run_once(spark, root, registry) == [("b", 70, 2, False), ("new", 5, 1, False)]
    # an entry at the cursor or behind it moves nothing; those of one batch count in any order
    delivered(spark, f"{root}/inbox", [("b", 70), ("b", 65), ("a", 101), ("a", 300), ("a", 200), ("new", 4)])
    assert run_once(spark, root, registry) == [("a", 300, 3, False)]
    assert run_once(spark, root, registry) == []


def test_a_silent_feed_is_reported_once(spark, tmp_path):
    root, out = str(tmp_path), []
    delivered(spark, f"{root}/inbox", [("a", 10), ("b", 20)])
    entries = spark.readStream.schema("rss string, unixTime long").parquet(f"{root}/inbox")
    query = cursors.cursor_stream(entries, stalled_ms=1500).writeStream.foreachBatch(
        lambda df, i: out.extend(df.collect())).outputMode("update").option(
        "checkpointLocation", f"{root}/checkpoint").trigger(processingTime="500 milliseconds").start()
    try:
        end = time.time() + 60
        while time.time() < end and sum(r.stalled for r in out) < 2:
            time.sleep(0.5)
    finally:
        query.stop()
    assert sorted((r.url, r.dt) for r in out if r.stalled) == [("a", 10), ("b", 20)]


def test_rows_behind_the_watermark_are_counted(spark, tmp_path):
    root = str(tmp_path)
    at = lambda hours: START + dt.timedelta(hours=hours)
    seen = []
    for rows in ([("x", at(0)), ("y", at(100)), ("x", at(0))], [("x", at(1)), ("z", at(2)), ("y", at(101)), ("w", at(99))]):
        spark.createDataFrame(rows, "article_id string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{root}/inbox")
        stream = spark.readStream.schema("article_id string, ts timestamp").parquet(f"{root}/inbox")
        query = incremental.deduplicated_stream(stream, "ts", "10 hours").writeStream.foreachBatch(
            lambda df, i: seen.extend(r.article_id for r in df.collect())).option(
            "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    assert sorted(seen) == ["w", "x", "y"] and late_rows(query) == 2


def test_iso_time(spark):
    assert spark.range(1).select(iso_time(F.lit(1730980800))).head()[0] == "2024-11-07T12:00:00"


def frame(spark, seed, n):
    r = random.Random(seed)
    rows = [(START + dt.timedelta(hours=r.randint(0, 700)), r.choice([None, r.gauss(0, 1), r.gauss(0, 1) ** 9]), r.randint(0, 3),
             float("nan") if r.random() < 0.1 else 7.0, None, r.choice([0] * 20 + [10 ** 12])) for _ in range(n)]
    return spark.createDataFrame(rows, "ts timestamp, wild double, few int, same double, never double, far long")


@pytest.mark.parametrize("n", [1, 2, 3, 50, 3000])
@pytest.mark.parametrize("margin", [mergeable.MARGIN, -0.2])
def test_a_merged_profile_is_describe(spark, tmp_path, monkeypatch, n, margin):
    # bounds that miss are looked at again, so the answer is the same
    monkeypatch.setattr(mergeable, "MARGIN", margin)
    df = frame(spark, n, n)
    path = str(tmp_path / "states")
    mergeable.write_states(mergeable.day_states(df, "ts"), path)
    got = {r.column_name: r for r in mergeable.profile_of(df, mergeable.read_states(spark, path)).collect()}
    data = df.toPandas()
    for name in ("wild", "few", "same", "never", "far"):
        want, row = data[name].astype(float).describe(), got[name]
        assert row.rows == n and row.n == want["count"]
        assert row.null_percent == pytest.approx(round(data[name].isna().mean(), 4) * 100)
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("25%", "25%"), ("50%", "50%"), ("75%", "75%"), ("max", "max")):
            if pd.isna(want[theirs]):
                assert row[mine] is None
            else:
                assert row[mine] == pytest.approx(want[theirs], rel=1e-9, abs=1e-9), (name, mine)


def test_a_month_reads_its_own_days_and_a_day_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "states")
    df = frame(spark, 1, 500)
    mergeable.write_states(mergeable.day_states(df, "ts"), path)
    mergeable.write_states(mergeable.day_states(df, "ts"), path)
    later = df.withColumn("ts", F.col("ts") + F.expr("INTERVAL 60 DAYS"))
    mergeable.write_states(mergeable.day_states(later, "ts"), path)
    month = mergeable.read_states(spark, path, 2024, 1)
    plan = month._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    first = {r.column_name: r.n for r in mergeable.merged(month).collect()}
    assert first["few"] == df.filter("month(ts) = 1").count()


def test_few_scans(spark, tmp_path):
    df = frame(spark, 2, 400)
    df.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    states = mergeable.day_states(df, "ts")
    mergeable.write_states(states, str(tmp_path / "s"))
    jobs = []
    real = mergeable._between
    try:
        mergeable._between = lambda *a: jobs.append(1) or real(*a)
        mergeable.profile_of(df, mergeable.read_states(spark, str(tmp_path / "s"))).collect()
    finally:
        mergeable._between = real
    # one pass made the states; one counts below the bounds and one between them
    assert len(jobs) == 1

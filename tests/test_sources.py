import json
import time

import pytest
from readings import variant
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from roadpulse.operators import lineage
from roadpulse.schema import LINEAGE
from roadpulse.sources import rest, sinks, tables
from roadpulse.streaming.processing import now


def pages(folder, sizes, page_size):
    number = 0
    for index, size in enumerate(sizes):
        rows = []
        for _ in range(size):
            rows.append(variant(id=str(number), borough="Queens" if number % 2 else "Bronx"))
            number += 1
        (folder / f"page-{index * page_size}.json").write_text(json.dumps(rows))


@pytest.fixture
def feed(spark):
    spark.dataSource.register(rest.RoadFeed)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield spark.read.format("road_feed")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_paged_read_stops_after_the_short_page(feed, tmp_path):
    pages(tmp_path, [10, 10, 4, 0], 10)
    df = feed.options(pages=str(tmp_path), pageSize=10, limit=50).load()
    assert df.rdd.getNumPartitions() == 5
    assert sorted(int(r["id"]) for r in df.collect()) == list(range(24))


def test_limit_caps_the_last_page(feed, tmp_path):
    pages(tmp_path, [10, 10, 10], 10)
    assert feed.options(pages=str(tmp_path), pageSize=10, limit=25).load().count() == 25


def test_borough_filter_is_sent_with_the_request(feed, tmp_path):
    pages(tmp_path, [10], 10)
    df = feed.options(pages=str(tmp_path), pageSize=10, limit=10).load().where("borough = 'Queens'")
    assert {r["borough"] for r in df.collect()} == {"Queens"}
    assert df.count() == 5


def test_source_needs_a_target(feed):
    with pytest.raises(PySparkException, match="url or pages"):
        feed.load().count()


def test_polling_stream(spark, tmp_path):
    from roadpulse.streaming.processing import TablePaths
    from roadpulse.streaming.routing import start_polling

    spark.dataSource.register(rest.RoadFeed)
    pages(tmp_path, [3], 10)
    stream = spark.readStream.format("road_feed").options(pages=str(tmp_path), limit=10).load()
    paths = TablePaths(str(tmp_path / "out"))
    query = start_polling(stream, paths, str(tmp_path / "cp"), interval="1 second")
    for _ in range(60):
        if sinks.table_exists(spark, f"{paths.root}/poll_statistics/_SUCCESS"):
            break
        time.sleep(0.5)
    query.stop()
    query.awaitTermination(30)
    raw = spark.read.parquet(paths.topic("raw")).where(F.col("batch_id").endswith("_0"))
    assert sorted(json.loads(r["value"])["id"] for r in raw.collect()) == ["0", "1", "2"]


@pytest.mark.parametrize("size, last", [(1000, 7), (10, 10), (10, 3)])
def test_without_a_limit_every_page_is_read(feed, tmp_path, size, last):
    sizes = [size] * (3 if size == 1000 else 19) + [last]
    pages(tmp_path, sizes, size)
    df = feed.options(pages=str(tmp_path), pageSize=size, readers=4).load()
    assert df.rdd.getNumPartitions() == 4
    assert sorted(int(r["id"]) for r in df.collect()) == list(range(sum(sizes)))
    assert df.where("borough = 'Queens'").count() == sum(sizes) // 2  # filtered pages are no short pages


def test_a_page_larger_than_the_page_size_is_refused(feed, tmp_path):
    pages(tmp_path, [12], 10)
    with pytest.raises(PySparkException, match="more than pageSize"):
        feed.options(pages=str(tmp_path), pageSize=10).load().collect()


def poll_once(spark, folder, root, **options):
    from roadpulse.streaming.processing import TablePaths
    from roadpulse.streaming.routing import start_polling

    spark.dataSource.register(rest.RoadFeed)
    stream = spark.readStream.format("road_feed").options(pages=str(folder), **options).load()
    paths = TablePaths(str(root / "out"))
    return start_polling(stream, paths, str(root / "cp"), once=True), paths


def test_a_poll_fetches_every_page(spark, tmp_path):
    pages(tmp_path, [1000, 1000, 500], 1000)
    for polls in (1, 2):  # the second one goes on from the checkpoint
        query, paths = poll_once(spark, tmp_path, tmp_path)
        assert query.awaitTermination(120)
        assert spark.read.parquet(paths.topic("raw")).count() == 2500 * polls
    for row in spark.read.parquet(f"{paths.root}/poll_statistics").collect():
        assert (row["fetched"], row["duplicates"], row["errors"]) == (2500, 0, 0)
        assert row["rate_per_min"] > 2500  # these polls took less than a minute


def test_a_failed_poll_is_counted(spark, tmp_path):
    (tmp_path / "page-0.json").write_text("no json")
    query, paths = poll_once(spark, tmp_path, tmp_path)
    with pytest.raises(PySparkException):
        query.awaitTermination(120)
    rows = spark.read.parquet(f"{paths.root}/poll_statistics").collect()
    assert [(r["fetched"], r["errors"], r["rate_per_min"]) for r in rows] == [(0, 1, 0.0)]


def test_retry_waits_longer_each_time():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError("down")
        return ["row"]

    assert rest.with_retry(flaky, sleep=waits.append) == ["row"]
    assert (len(calls), waits) == (3, [2.0, 4.0])


def test_retry_gives_up():
    def broken():
        raise ConnectionError("down")

    with pytest.raises(ConnectionError):
        rest.with_retry(broken, sleep=lambda _: None)


def hours(spark, rows):
    df = spark.createDataFrame(rows, "w string, borough string, n long")
    return df.select(F.col("w").cast("timestamp").alias("window_start"), "borough", "n")


def test_upsert_replaces_keys_and_keeps_the_rest(spark, tmp_path):
    path = str(tmp_path / "t")
    keys = ["window_start", "borough"]
    first = hours(spark, [("2024-01-01 00:00:00", "Bronx", 1), ("2024-01-01 01:00:00", "Bronx", 2), ("2024-01-02 00:00:00", None, 3)])
    second = hours(spark, [("2024-01-01 01:00:00", "Bronx", 20), ("2024-01-02 00:00:00", None, 30), ("2024-01-03 00:00:00", "Bronx", 4)])
    for rows in (first, second, second):
        sinks.upsert(rows, path, keys, "window_start")
    assert sorted(r["n"] for r in tables.read_parts(spark, path).collect()) == [1, 4, 20, 30]


def test_a_replayed_batch_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).withColumn("processed_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    sinks.write_processed(rows, path, 0)
    sinks.write_processed(rows, path, 1)
    sinks.write_processed(rows.limit(7), path, 1)
    assert tables.read_parts(spark, path).count() == 17


def test_lookback_prunes_day_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(5).withColumn("processed_at", F.expr("timestamp'2024-01-01 12:00:00' + make_interval(0,0,0,int(id))"))
    sinks.write_processed(days, path, 0)
    df = tables.read_processed(spark, path, "2024-01-05 18:00:00", 24, ["processed_at"])
    assert [r[0].day for r in df.collect()] == [5]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(processed_date" in plan
    assert "PushedFilters: [IsNotNull(processed_at), GreaterThanOrEqual(processed_at" in plan


def entry(spark, **changes):
    facts = dict(phase="batch_processing", processor="p", batch_id="b1", started_at=now(), completed_at=now(), record_count=3)
    return lineage.make_entry(spark, **{**facts, **changes})


def test_lineage_row(spark, tmp_path):
    row = entry(spark, offset_ranges={"partition_0": (1, 5, 4)}, errors=["x"])
    assert row.schema.simpleString() == LINEAGE.simpleString()
    first, again = row.first(), entry(spark, started_at=row.first()["started_at"]).first()
    assert first["lineage_id"] == again["lineage_id"] and first["lineage_id"].startswith("batch_processing_20")
    path = str(tmp_path / "l")
    assert sinks.append_lineage(row, path, "b1") and sinks.append_lineage(row, path, "b1")
    assert [r["offset_ranges"]["partition_0"]["max"] for r in tables.read_lineage(spark, path).collect()] == [5]


def test_lineage_failure_does_not_break_the_run(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    assert sinks.append_lineage(entry(spark), str(blocked / "l"), "b1") is False


def test_csv_exports(spark, tmp_path):
    scored = spark.range(50).select(
        F.col("id").cast("string").alias("record_id"), F.lit("L").alias("link_name"), F.lit("Bronx").alias("borough"),
        F.col("id").cast("double").alias("speed"), F.lit("SEVERE").alias("congestion_level"),
        F.lit(-0.1).alias("anomaly_score"), F.timestamp_seconds("id").alias("processed_at"), (F.col("id") % 2 == 0).alias("is_anomaly"),
    )
    sinks.export_anomalies(scored, str(tmp_path / "a"))
    rows = spark.read.option("header", True).csv(str(tmp_path / "a"))
    assert rows.columns == sinks.ANOMALY_COLUMNS and rows.count() == 20
    assert max(float(r["speed"]) for r in rows.collect()) == 48.0
    sinks.export_lineage(entry(spark), str(tmp_path / "l"))
    assert spark.read.option("header", True).csv(str(tmp_path / "l")).columns == sinks.LINEAGE_COLUMNS

"""The shape of the plans that decide whether a query scales."""

import re

import pytest
from pyspark.sql import functions as F

from roadpulse.functions.quantiles import exact_percentiles, value_counts
from roadpulse.operators import hourly, ingest, lineage, quality, reports, serving
from roadpulse.plans.catalog import REGISTRY, streams
from roadpulse.plans.fixtures import AS_OF, Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, FOLDER)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange (\w+)", plan(df))


def test_no_python_workers_outside_the_forest(t):
    frames = [
        t.traffic, hourly.speed_counts(t.traffic), ingest.validate(t.messages), t.quality,
        serving.congestion_snapshot(t.traffic), reports.executive_summary(t.traffic, AS_OF),
        ingest.valid_rows(ingest.validate(t.messages)),
    ]
    for df in frames:
        assert "Python" not in plan(df)


def test_hourly_shuffles_the_readings_once_after_combining(t):
    text = plan(hourly.speed_counts(t.traffic))
    assert exchanges(hourly.speed_counts(t.traffic)) == ["hashpartitioning"]
    assert "hashpartitioning(window_start" in text and "speed" in text.split("hashpartitioning")[1][:80]
    assert text.count("partial_count") >= 1 and "Window" not in text


def test_columns_are_pruned_at_the_scan(t):
    text = plan(t.traffic.select("record_id", "borough"))
    assert re.search(r"ReadSchema: struct<event_id:bigint,event_type:string>", text)


def test_cleaning_needs_no_shuffle(t):
    assert exchanges(t.traffic) == [] and exchanges(ingest.validate(t.messages)) == []


def test_newest_rows_use_a_bounded_heap(t):
    for df in (serving.traffic_live(t.traffic), serving.recent_records(t.traffic, AS_OF, 24, limit=2000), quality.newest_metrics(t.quality, 500)):
        assert "TakeOrderedAndProject" in plan(df)


def test_latest_per_link_combines_before_the_shuffle(t):
    df = reports.latest_per_link(t.traffic.select("link_id", "record_id", "processed_at"))
    assert "partial_max_by" in plan(df) and "Window" not in plan(df)
    assert exchanges(df) == ["hashpartitioning"]


def test_executive_summary_scans_once(t):
    assert plan(reports.executive_summary(t.traffic, AS_OF)).count("FileScan") == 1


def test_replay_is_an_equality_join_without_forced_broadcast(t, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(lineage.replay(t.messages, t.lineage))
        assert "SortMergeJoin [partition" in text and "_bucket" in text and "Broadcast" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_percentile_windows_run_over_counts(t, spark):
    """No window sees readings: both run above an aggregate of the counts."""
    counts = value_counts(t.traffic, ["borough"], "speed")
    text = plan(exact_percentiles(counts, ["borough"], "speed", {"m": 0.5}))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert re.search(r"Window \[sum\(n", text)


def test_no_query_has_a_cross_join(spark):
    for name in ("a12_executive_summary", "a13_health_status", "a14_pipeline_health", "a31_overview_kpis", "j2_current_vs_baseline", "f9_window_fallback"):
        text = plan(REGISTRY[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_skewed_borough_gives_the_same_statistics(t):
    """A third of all readings in one group and on one speed."""
    rows = t.traffic.withColumn("borough", F.when(F.col("kafka_offset") % 3 == 0, "Bronx").otherwise(F.col("borough")))
    rows = rows.withColumn("data_as_of_parsed", F.when(F.col("kafka_offset") % 3 == 0, F.lit(AS_OF).cast("timestamp")).otherwise(F.col("data_as_of_parsed")))
    rows = rows.withColumn("speed", F.when(F.col("kafka_offset") % 6 == 0, 12.0).otherwise(F.col("speed")))
    found = hourly.hourly_stats(rows).select("window_start", "borough", "record_count", "median_speed", "avg_speed")
    plain = hourly.with_window(rows).groupBy("window_start", "borough").agg(
        F.count("speed").alias("n"), F.median("speed").alias("m"), F.avg("speed").alias("a")
    )
    both = found.join(plain, ["window_start", "borough"])
    assert both.count() == plain.count() == found.count()
    wrong = both.where("n <> record_count OR abs(m - median_speed) > 1e-9 OR abs(a - avg_speed) > 1e-9")
    assert wrong.count() == 0


def test_messages_of_a_file_with_one_row_group_use_all_cores(t):
    """All streams over the table start here; parsing and keying came before the first shuffle."""
    assert "Repartition" in streams._messages(t)._jdf.queryExecution().analyzed().toString()


def test_the_forest_cleans_the_table_once_and_scores_on_all_cores(t, spark):
    df = REGISTRY["m6_isolation_forest"].build(t)
    assert "FileScan" not in plan(df) and df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism

"""Rows behind the watermark, roll-ups and the minimum gate."""

import pytest
from pyspark.sql import functions as F
from readings import envelope_rows, variant, write_envelope

from roadpulse.ml import train
from roadpulse.operators import reports
from roadpulse.sources import envelope, parts, tables
from roadpulse.streaming import late
from roadpulse.streaming.processing import TablePaths


def deliver(spark, folder, paths, cp, **options):
    query = late.start_late_split(envelope.stream_files(spark, folder), paths, cp, once=True, **options)
    assert query.awaitTermination(180)


def ids(df):
    return sorted(r["record_id"] for r in df.collect())


def test_late_rows_are_kept_apart_over_restarts(spark, tmp_path):
    folder, paths, cp = str(tmp_path / "topic"), TablePaths(str(tmp_path / "t")), str(tmp_path / "cp")
    first = [variant(id="a", data_as_of="2024-02-13T10:00:00"), variant(id="old", data_as_of="2024-02-01T10:00:00")]
    write_envelope(folder, "1", envelope_rows(first))
    deliver(spark, folder, paths, cp, delay_s=3600)
    assert ids(tables.read_processed(spark, paths.on_time)) == ["a", "old"]  # nothing was seen before
    second = [
        variant(id="late", data_as_of="2024-02-13T08:59:59"), variant(id="edge", data_as_of="2024-02-13T09:00:00"),
        variant(id="other", link_id="77", data_as_of="2024-02-01T00:00:00"), variant(id="timeless", data_as_of=...),
        variant(id="new", data_as_of="2024-02-14T00:00:00"),
    ]
    write_envelope(folder, "2", envelope_rows(second, start=10))
    deliver(spark, folder, paths, cp, delay_s=3600)
    write_envelope(folder, "3", envelope_rows([variant(id="later", data_as_of="2024-02-13T22:00:00")], start=20))
    deliver(spark, folder, paths, cp, delay_s=3600)
    assert ids(tables.read_processed(spark, paths.late)) == ["late", "later"]
    assert ids(tables.read_processed(spark, paths.on_time)) == ["a", "edge", "new", "old", "other", "timeless"]


def test_links_share_groups_but_not_their_marks(spark, tmp_path):
    """Many links are few groups of state, and each link still has a mark of its own."""
    folder, paths, cp = str(tmp_path / "topic"), TablePaths(str(tmp_path / "t")), str(tmp_path / "cp")
    times = [f"2024-02-{1 + k % 20:02d}T10:00:00" for k in range(600)]
    write_envelope(folder, "1", envelope_rows([variant(id=f"a{k}", link_id=f"L{k}", data_as_of=times[k]) for k in range(600)]))
    deliver(spark, folder, paths, cp, delay_s=3600)
    again = [variant(id=f"b{k}", link_id=f"L{k}", data_as_of="2024-02-10T09:30:00") for k in range(600)]
    write_envelope(folder, "2", envelope_rows(again, start=1000))
    query = late.start_late_split(envelope.stream_files(spark, folder), paths, cp, once=True, delay_s=3600)
    assert query.awaitTermination(180)
    assert ids(tables.read_processed(spark, paths.late)) == sorted(f"b{k}" for k in range(600) if times[k] >= "2024-02-11")
    assert tables.read_processed(spark, paths.on_time).count() + tables.read_processed(spark, paths.late).count() == 1200
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 256


def processed(spark, n=500):
    at = F.timestamp_seconds(F.col("id") * 1000 + 1_704_067_200)
    level = F.element_at(F.array(F.lit("SEVERE"), F.lit("FREE_FLOW"), F.lit("MODERATE")), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(n).select(at.alias("processed_at"), F.when(F.col("id") % 5 > 0, F.col("id") % 70).cast("double").alias("speed"), level.alias("congestion_level"))


@pytest.mark.parametrize("as_of", ["2024-01-06 00:00:00", "2024-01-06 10:20:30"])
def test_baseline_from_parts_equals_the_scan(spark, tmp_path, as_of):
    rows, path = processed(spark), str(tmp_path / "p")
    want = reports.baseline_stats(rows, as_of, days=2).collect()
    parts.upsert(reports.baseline_parts(rows).withColumn("window_date", F.to_date("window_start")), path, ["window_start"], "window_date")
    stored = tables.read_parts(spark, path)
    assert reports.baseline_from_parts(stored, as_of, days=2, edge=rows).collect() == want
    if as_of.endswith("00:00:00"):
        alone = reports.baseline_from_parts(stored, as_of, days=2)
        assert alone.collect() == want
        plan = alone._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FileScan") == 1 and "processed_at" not in plan
    assert reports.baseline_from_parts(stored, "2030-01-01 00:00:00").first()["total_records"] == 0


def test_minimum_is_checked_inside_the_plan(spark):
    rows = spark.range(1000)
    assert train.with_minimum(rows, 1000).count() == 1000
    short = train.with_minimum(rows.limit(999), 1000)
    with pytest.raises(Exception, match="999 training rows, at least 1000"):
        short.groupBy().agg(F.sum("id")).collect()

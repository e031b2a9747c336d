import datetime as dt

import pytest
from readings import envelope_rows, variant, write_envelope
from pyspark.sql import functions as F

from roadpulse.operators.clean import clean
from roadpulse.plans import hourly_job
from roadpulse.schema import RAW
from roadpulse.sources import envelope, sinks, tables
from roadpulse.streaming.processing import TablePaths

AS_OF = dt.datetime(2024, 2, 13, 12, 30)


@pytest.fixture
def paths(tmp_path):
    return TablePaths(str(tmp_path / "tables"))


def store(spark, paths, records, batch=0, at="2024-02-13 10:00:00"):
    rows = spark.createDataFrame([tuple(r.get(f) for f in RAW.fieldNames()) for r in records], RAW)
    sinks.write_processed(clean(rows, F.lit(at).cast("timestamp")), paths.processed, batch)


def last_lineage(spark, paths):
    return tables.read_lineage(spark, paths.lineage).orderBy(F.col("started_at").desc()).first()


def test_run_over_the_processed_table(spark, paths):
    store(spark, paths, [variant(id=str(i), speed=str(10 * i)) for i in range(1, 6)] + [variant(id="x", speed=None, borough=None)])
    assert hourly_job.run_batch(spark, paths, AS_OF) == "success"
    assert hourly_job.run_batch(spark, paths, AS_OF) == "success"
    row = tables.read_hourly(spark, paths.hourly).collect()
    assert len(row) == 1 and row[0]["record_count"] == 5
    assert row[0]["speed_stats"].asDict() == {"avg": 30.0, "min": 10.0, "max": 50.0, "median": 30.0}
    summary = tables.read_summaries(spark, paths.summaries).collect()
    assert [(s["total_records"], s["window_end"], s["borough_record_counts"]) for s in summary] == [
        (6, dt.datetime(2024, 2, 13, 12), {"Staten Island": 5})
    ]
    metrics = tables.read_quality(spark, paths.quality).collect()
    # A row with two nulls counts twice in the plain formula and once in the strict one.
    assert [(m["valid_records"], m["strict_valid_records"]) for m in metrics] == [(4, 5)]
    assert last_lineage(spark, paths)["status"] == "success"


def test_a_late_reading_leaves_its_hour_complete(spark, paths):
    store(spark, paths, [variant(id=str(i)) for i in range(50)], batch=0)
    assert hourly_job.run_batch(spark, paths, AS_OF) == "success"
    store(spark, paths, [variant(id="late")], batch=1, at="2024-02-15 10:00:00")
    assert hourly_job.run_batch(spark, paths, AS_OF + dt.timedelta(days=2)) == "success"
    assert [r["record_count"] for r in tables.read_hourly(spark, paths.hourly).collect()] == [51]


def test_rows_outside_the_window_are_ignored(spark, paths):
    store(spark, paths, [variant()], at="2024-02-12 12:29:59")
    assert hourly_job.run_batch(spark, paths, AS_OF) == "skipped_empty"
    assert last_lineage(spark, paths)["record_count"] == 0


def test_empty_table_is_backfilled_from_the_topic(spark, paths, tmp_path):
    folder = str(tmp_path / "topic")
    write_envelope(folder, "f", envelope_rows([variant(id=str(i)) for i in range(7)] + ["{broken", "[1]"]))
    topic = envelope.read_files(spark, folder)
    assert hourly_job.run_batch(spark, paths, AS_OF, envelope=topic) == "success"
    assert tables.read_hourly(spark, paths.hourly).first()["record_count"] == 7
    assert last_lineage(spark, paths)["source"]["type"] == "topic"


def test_failure_is_recorded_and_raised(spark, paths, monkeypatch):
    store(spark, paths, [variant()])

    def broken(*_):
        raise RuntimeError("no median today")

    monkeypatch.setattr(hourly_job.hourly, "hourly_borough", broken)
    with pytest.raises(RuntimeError, match="no median"):
        hourly_job.run_batch(spark, paths, AS_OF)
    entry = last_lineage(spark, paths)
    assert entry["status"] == "failed" and "no median today" in entry["errors"][0]

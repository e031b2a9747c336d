import pytest
from readings import envelope_rows, variant, write_envelope
from pyspark.sql import functions as F

from roadpulse.operators import hourly
from roadpulse.operators.clean import clean, parse_envelope
from roadpulse.schema import BOROUGHS
from roadpulse.sources import envelope, sinks, tables
from roadpulse.streaming import processing, routing, windows
from roadpulse.streaming.processing import TablePaths

STABLE = ["record_id", "borough", "speed", "data_as_of_parsed", "time_bucket", "congestion_level", "kafka_offset"]


def readings(n, start=0, days=3):
    return [
        variant(
            id=str(i),
            speed=f"{(i * 37) % 80}.{i % 100:02d}",
            borough=BOROUGHS[i % 5] if i % 3 else BOROUGHS[0],
            data_as_of=f"2024-02-{13 + i % days:02d}T{(i * 7) % 24:02d}:{i % 60:02d}:00",
        )
        for i in range(start, start + n)
    ]


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "topic"), TablePaths(str(tmp_path / "tables")), str(tmp_path / "cp")


def fill(folder, files=4, each=25, days=3):
    for i in range(files):
        write_envelope(folder, f"f{i}", envelope_rows(readings(each, i * each, days), start=i * each))


def drain(query):
    assert query.awaitTermination(180)


def test_stream_equals_batch(spark, place):
    folder, paths, cp = place
    fill(folder)
    drain(processing.start_processing(envelope.stream_files(spark, folder), paths, cp, once=True))
    stored = tables.read_processed(spark, paths.processed)
    batch = clean(parse_envelope(envelope.read_files(spark, folder)))
    assert sorted(stored.select(*STABLE).collect()) == sorted(batch.select(*STABLE).collect())
    assert stored.select("batch_id").distinct().count() == 4

    metrics = tables.read_quality(spark, paths.quality)
    rows = metrics.collect()
    assert sorted((r["batch_id"].rsplit("_", 1)[1], r["total_records"], r["quality_score"]) for r in rows) == [(str(i), 25, 100.0) for i in range(4)]
    assert all(r["batch_id"].startswith("stream_") for r in rows)
    entries = tables.read_lineage(spark, paths.lineage).collect()
    assert {e["status"] for e in entries} == {"success"} and len(entries) == 4
    ranges = {k: (v["min"], v["max"], v["count"]) for e in entries if e["batch_id"].endswith("_0") for k, v in e["offset_ranges"].items()}
    assert sum(count for _, _, count in ranges.values()) == 25


def test_restart_continues_without_loss_or_repeats(spark, place):
    folder, paths, cp = place
    fill(folder, files=2)
    drain(processing.start_processing(envelope.stream_files(spark, folder), paths, cp, once=True))
    write_envelope(folder, "later", envelope_rows(readings(25, 50), start=50))
    drain(processing.start_processing(envelope.stream_files(spark, folder), paths, cp, once=True))
    ids = [int(r["record_id"]) for r in tables.read_processed(spark, paths.processed).collect()]
    assert sorted(ids) == list(range(75))


def test_failure_is_recorded_then_replayed(spark, place, monkeypatch):
    folder, paths, cp = place
    fill(folder, files=2)

    def broken(*_):
        raise OSError("disk gone")

    monkeypatch.setattr(processing, "write_processed", broken)
    query = processing.start_processing(envelope.stream_files(spark, folder), paths, cp, once=True)
    with pytest.raises(Exception, match="disk gone"):
        query.awaitTermination(120)
    entries = tables.read_lineage(spark, paths.lineage).collect()
    assert [(e["status"], e["record_count"]) for e in entries] == [("failed", 0)]
    monkeypatch.undo()
    drain(processing.start_processing(envelope.stream_files(spark, folder), paths, cp, once=True))
    assert tables.read_processed(spark, paths.processed).count() == 50
    entries = tables.read_lineage(spark, paths.lineage).collect()
    assert sorted(e["status"] for e in entries) == ["success", "success"]


def test_partial_failure_keeps_the_rows(spark, place, monkeypatch):
    folder, paths, cp = place
    fill(folder, files=1)

    def broken(*_):
        raise OSError("metrics gone")

    monkeypatch.setattr(processing, "upsert", broken)
    drain(processing.start_processing(envelope.stream_files(spark, folder), paths, cp, once=True, keep_going=True))
    assert tables.read_processed(spark, paths.processed).count() == 25
    entries = tables.read_lineage(spark, paths.lineage).collect()
    assert [e["status"] for e in entries] == ["partial"] and "metrics gone" in entries[0]["errors"][0]


def test_routing(spark, place):
    folder, paths, cp = place
    values = readings(10) + ["{broken", variant(id="r1", speed="999"), variant(id="r2", travel_time="66.5")]
    write_envelope(folder, "f", envelope_rows(values))
    stream = envelope.stream_files(spark, folder)
    drain(routing.start_routing(stream, paths, cp, once=True))
    valid = spark.read.parquet(paths.topic("validated"))
    dead = spark.read.parquet(paths.topic("dead_letters"))
    assert valid.count() == 10 and set(valid.columns) >= {"key", "value", "topic", "partition", "offset"}
    assert sorted(r["error"] for r in dead.collect()) == [
        "INVALID_JSON", "Speed 999 mph is out of plausible range (0-200)", "TRAVEL_TIME_NOT_INTEGER",
    ]
    counters = spark.read.parquet(paths.counters).first()
    assert (counters["processed"], counters["valid"], counters["invalid"]) == (13, 10, 3)


def test_duplicates_are_dropped_within_the_delay(spark, place):
    folder, paths, cp = place
    write_envelope(folder, "a", envelope_rows(readings(5)))
    write_envelope(folder, "b", envelope_rows(readings(8), start=100))
    for enabled, expected in ((True, 8), (False, 13)):
        stream = routing.without_duplicates(envelope.stream_files(spark, folder), enabled=enabled)
        name = f"dedup_{enabled}".lower()
        query = stream.writeStream.format("memory").queryName(name).trigger(availableNow=True)
        drain(query.option("checkpointLocation", f"{cp}_{enabled}").start())
        assert spark.table(name).count() == expected


def test_messages_without_a_reading_all_reach_the_dead_letters(spark, place):
    folder, paths, cp = place
    bad = ["{broken", "[1]", "{}", '{"speed": "1"}']
    write_envelope(folder, "a", envelope_rows(bad))
    write_envelope(folder, "b", envelope_rows(readings(3), start=100))
    write_envelope(folder, "c", envelope_rows(readings(3), start=200))  # delivered again
    drain(routing.start_routing(envelope.stream_files(spark, folder), paths, cp, once=True))
    assert spark.read.parquet(paths.topic("dead_letters")).count() == len(bad)
    assert spark.read.parquet(paths.topic("validated")).count() == 3


def test_a_new_checkpoint_does_not_overwrite_batches(spark, place):
    folder, paths, cp = place
    write_envelope(folder, "a", envelope_rows(readings(5)))
    drain(processing.start_processing(envelope.stream_files(spark, folder), paths, cp, once=True))
    write_envelope(f"{folder}2", "b", envelope_rows(readings(3, 50), start=50))
    drain(processing.start_processing(envelope.stream_files(spark, f"{folder}2"), paths, f"{cp}2", once=True))
    assert tables.read_processed(spark, paths.processed).count() == 8


def comparable(df):
    return sorted(
        (r["window_start"], r["borough"], r["record_count"], tuple(r["speed_stats"]), r["avg_travel_time"],
         r["avg_congestion_score"], tuple(sorted(r["congestion_distribution"].items())))
        for r in df.collect()
    )


def test_streamed_hours_equal_the_batch_result_with_late_rows(spark, place):
    folder, paths, cp = place
    fill(folder, files=3, each=60, days=1)
    drain(windows.start_windows(envelope.stream_files(spark, folder), paths, cp, once=True))
    # Rows for hours that were already written, delivered later but within the allowed lateness.
    late = [variant(id=f"late{i}", speed=f"{i}.5", data_as_of="2024-02-13T03:10:00") for i in range(9)]
    late += [variant(id="none", speed=None, data_as_of="2024-02-13T03:10:00")]
    write_envelope(folder, "late", envelope_rows(late, start=1000))
    drain(windows.start_windows(envelope.stream_files(spark, folder), paths, cp, once=True))
    batch = hourly.hourly_borough(clean(parse_envelope(envelope.read_files(spark, folder))))
    assert comparable(tables.read_hourly(spark, paths.hourly)) == comparable(batch)


def test_windows_apply_twice_without_change(spark, place):
    _, paths, _ = place
    rows = spark.createDataFrame(
        [("2024-01-01 00:00:00", "Bronx", 10.0, 3), ("2024-01-01 00:00:00", "Bronx", None, 1)],
        "w string, borough string, speed double, n long",
    )
    zeros = {c: F.lit(0).cast("long") for c in ("sum_travel_time", "n_travel_time", "n_score", "FREE_FLOW", "MODERATE", "CONGESTED", "SEVERE")}
    batch = rows.withColumns({**zeros, "sum_score": F.lit(0.0)}).withColumn("window_start", F.col("w").cast("timestamp")).drop("w")
    write = windows.write_windows(paths)
    write(batch, 0)
    write(batch, 0)
    assert tables.read_parts(spark, paths.speed_counts).count() == 2
    row = tables.read_hourly(spark, paths.hourly).collect()
    assert [(r["record_count"], r["speed_stats"]["median"]) for r in row] == [(3, 10.0)]


def test_missing_table_reads_as_empty(spark, place):
    _, paths, _ = place
    assert tables.read_processed(spark, paths.processed, "2024-01-01", 24).count() == 0
    assert not sinks.table_exists(spark, paths.processed)

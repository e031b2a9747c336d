"""Tables behind a manifest: upserts, packing, replays, readers, data skipping."""

import pytest
from pyspark.sql import functions as F

from roadpulse.sources import parts, sinks, tables

KEYS = ["window_start", "borough"]


def hours(spark, days, boroughs=5, first=0):
    rows = spark.range(days * 24 * boroughs)
    at = F.timestamp_seconds((F.floor(F.col("id") / boroughs) + first * 24) * 3600 + 1_704_067_200)
    return rows.select(at.alias("window_start"), (F.col("id") % boroughs).cast("string").alias("borough"), F.col("id").alias("n"), F.md5(F.col("id").cast("string")).alias("pad"))


def content(spark, path):
    return sorted((r["window_start"], r["borough"], r["n"]) for r in tables.read_parts(spark, path).collect())


def test_one_changed_hour_writes_as_much_as_one_hour(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(hours(spark, 30), path, KEYS, "window_start")
    whole = parts.manifest(spark, path)
    changed = hours(spark, 1, first=3).limit(5).withColumn("n", F.lit(-1).cast("long"))
    sinks.upsert(changed, path, KEYS, "window_start")
    now = parts.manifest(spark, path)
    assert set(whole.folders) < set(now.folders)
    added = [f for f in now.folders if f.delta]
    assert [f.day for f in added] == ["2024-01-04"]
    assert sum(f.bytes for f in added) * 20 < sum(f.bytes for f in whole.folders)
    rows = content(spark, path)
    assert len(rows) == 3600 and sum(n == -1 for *_, n in rows) == 5


def test_many_deltas_are_merged_into_their_days(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    monkeypatch.setattr(parts, "MAX_DELTAS", 3)
    sinks.upsert(hours(spark, 3), path, KEYS, "window_start")
    before = parts.manifest(spark, path)
    old = tables.read_parts(spark, path)
    want = {(a, b): n for a, b, n in content(spark, path)}
    for k in range(4):
        changed = hours(spark, 1, first=1).where(F.col("n") % (k + 2) == 0).withColumn("n", F.col("n") + 1000 * (k + 1))
        want |= {(r["window_start"], r["borough"]): r["n"] for r in changed.collect()}
        sinks.upsert(changed, path, KEYS, "window_start")
    now = parts.manifest(spark, path)
    assert not any(f.delta for f in now.folders)
    assert {f for f in now.folders if f.day != "2024-01-02"} == {f for f in before.folders if f.day != "2024-01-02"}
    assert content(spark, path) == sorted((a, b, n) for (a, b), n in want.items())
    assert old.count() == 360  # a reader of an older manifest still finds its files
    assert parts.merge(spark, path) is None


def test_null_keys_and_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    first = hours(spark, 1, 1).withColumn("borough", F.lit(None).cast("string"))
    sinks.upsert(first, path, KEYS, "window_start")
    sinks.upsert(first.limit(2).withColumn("n", F.lit(9).cast("long")).withColumn("more", F.lit("x")), path, KEYS, "window_start")
    rows = tables.read_parts(spark, path)
    assert rows.count() == 24 and rows.where("n = 9 and more = 'x'").count() == 2
    sinks.upsert(first.where("false"), path, KEYS, "window_start")
    assert tables.read_parts(spark, path).count() == 24


def processed(spark, rows, start=0):
    at = F.timestamp_seconds(F.col("id") * 600 + 1_704_067_200)
    return spark.range(start, start + rows).select(
        F.col("id").cast("string").alias("record_id"), (F.col("id") % 200).cast("string").alias("link_id"),
        F.element_at(F.array(*map(F.lit, "ABCDE")), (F.pmod(F.hash("id"), F.lit(5)) + 1).cast("int")).alias("borough"),
        at.alias("data_as_of_parsed"), F.lit("2024-01-05 10:00:00").cast("timestamp").alias("processed_at"),
    )


def test_packing_keeps_rows_and_meets_its_plan(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(6):
        sinks.write_processed(processed(spark, 500, k * 500).repartition(3), path, f"stream_{k}")
    now = parts.manifest(spark, path)
    assert sum(f.files for f in now.folders) == 18
    running = parts.read(spark, path)
    target = sum(f.bytes for f in now.folders) // 3
    plan = parts.compaction_plan(now, target)
    gone = sinks.compact_processed(spark, path, target)
    after = parts.manifest(spark, path)
    assert sum(f.files for f in after.folders) == plan["2024-01-05"][1] == 18 - gone <= 4
    ids = lambda df: sorted(int(r["record_id"]) for r in df.select("record_id").collect())
    assert ids(parts.read(spark, path)) == ids(running) == list(range(3000))
    # a batch that is delivered again after packing leaves one copy; a new one is added
    sinks.write_processed(processed(spark, 500, 1000), path, "stream_2")
    sinks.write_processed(processed(spark, 10, 3000), path, "stream_6")
    sinks.write_processed(processed(spark, 10, 3000), path, "other_0")
    assert ids(parts.read(spark, path)) == sorted([*range(3010), *range(3000, 3010)])
    assert sinks.compact_processed(spark, path, target) > 0
    assert parts.vacuum(spark, path, keep=1) == 0  # all parts are young
    assert parts.vacuum(spark, path, keep=1, older_than_s=-60) > 6
    assert len(ids(parts.read(spark, path))) == 3020


def test_bins():
    folders = [parts.Folder(str(k), "d", 1, size) for k, size in enumerate([5, 9, 4, 4, 1, 30, 2])]
    packed = parts.bins(folders, 10)
    assert sorted(sum(f.bytes for f in b) for b in packed) == [7, 8, 10, 30] or all(sum(f.bytes for f in b) <= 10 for b in packed if b[0].bytes <= 10)
    assert sorted(f.part for b in packed for f in b) == [str(k) for k in range(7)]


def test_two_writers_both_count(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_processed(processed(spark, 5), path, "a_0")
    own = [parts.replace(f, batch="b_0") for f in parts.write_part(processed(spark, 7).withColumn("processed_date", F.to_date("processed_at")), path, "processed_date")]
    raced = []

    def change(now):
        if not raced:
            raced.append(1)
            sinks.write_processed(processed(spark, 11), path, "c_0")  # another writer is first
        return parts.replace(now, folders=now.folders + tuple(own))

    parts.commit(spark, path, change)
    assert parts.read(spark, path).count() == 23


def test_keyed_tables_are_not_packed(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(hours(spark, 1), path, KEYS, "window_start")
    with pytest.raises(ValueError):
        parts.compact(spark, path)


def scanned(df):
    """Rows that left the scan of a query, after row groups were skipped."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_scans_skip_row_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    small = {"parquet.block.size": 16 * 1024, "parquet.block.size.row.check.min": 100, "parquet.block.size.row.check.max": 100, "parquet.page.size.row.check.min": 50}
    # links of a borough and time come in bursts, as sensors report
    rows = processed(spark, 40_000).withColumn("link_id", F.floor(F.col("record_id").cast("long") / 250).cast("string"))
    for k in range(4):
        sinks.write_processed(rows.where(F.col("record_id") % 4 == k), path, f"stream_{k}")
    sinks.compact_processed(spark, path, **small)
    table = tables.read_processed(spark, path).select("record_id", "borough", "link_id", "data_as_of_parsed")
    area = table.where("borough = 'B' and data_as_of_parsed >= '2024-03-01' and data_as_of_parsed < '2024-03-05'")
    link = table.where("link_id = '77'")
    assert scanned(table) == 40_000
    assert 0 < area.count() <= scanned(area) < 8_000
    assert link.count() == 250 <= scanned(link) < 12_000

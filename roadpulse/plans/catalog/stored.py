"""Queries over stored tables: merge on read, compaction, data skipping."""

from pyspark.sql import functions as F

from roadpulse.plans.catalog.core import query
from roadpulse.plans.catalog.streams import place
from roadpulse.plans.fixtures import AS_OF
from roadpulse.plans.oracle import AS_OF as NOW
from roadpulse.session import materialize
from roadpulse.sources import parts, sinks, tables

_KEYS = ["aggregation_type", "window_start", "borough"]
BATCHES = 8


@query(
    "s11_merge_on_read",
    f"""SELECT window_start, borough,
        CASE WHEN borough IN ('Queens', 'Bronx') THEN 3 WHEN hour(window_start) % 2 = 0 THEN 2
          WHEN window_start >= {NOW} - INTERVAL 72 HOUR THEN 1 ELSE 0 END AS version,
        record_count + 1000 * (CASE WHEN borough IN ('Queens', 'Bronx') THEN 3 WHEN hour(window_start) % 2 = 0 THEN 2
          WHEN window_start >= {NOW} - INTERVAL 72 HOUR THEN 1 ELSE 0 END) AS record_count
        FROM hourly_fx""",
)
def s11_merge_on_read(t):
    rows = materialize(t.hourly.select(*_KEYS, "record_count"))
    path = f"{place(t)}/hourly"
    recent = F.col("window_start") >= F.lit(AS_OF).cast("timestamp") - F.expr("INTERVAL 72 HOURS")
    changes = [F.lit(True), recent, F.hour("window_start") % 2 == 0, F.col("borough").isin("Queens", "Bronx")]
    for version, changed in enumerate(changes):
        new = rows.where(changed).withColumns({"record_count": F.col("record_count") + 1000 * version, "version": F.lit(version)})
        sinks.upsert(new, path, _KEYS, "window_start")
    return tables.read_parts(t.spark, path).select("window_start", "borough", "version", "record_count")


def _micro_batches(t, path: str) -> None:
    rows = materialize(t.traffic.drop("batch_id"))
    for k in range(BATCHES):
        sinks.write_processed(rows.where(F.col("kafka_offset") % BATCHES == k), path, f"stream_{k}")


@query(
    "s10_compaction",
    "SELECT record_id, kafka_offset, speed, borough, CAST(processed_at AS DATE) AS processed_date, true AS as_planned FROM traffic_fx",
)
def s10_compaction(t):
    """All rows once after packing, also where a batch is written again; the files are those of the plan."""
    path = f"{place(t)}/processed"
    _micro_batches(t, path)
    plan = parts.compaction_plan(parts.manifest(t.spark, path), parts.TARGET_BYTES)
    sinks.compact_processed(t.spark, path)
    sinks.write_processed(t.traffic.where(F.col("kafka_offset") % BATCHES == 3).drop("batch_id"), path, "stream_3")
    files = {}
    for f in parts.manifest(t.spark, path).folders:
        files[f.day] = files.get(f.day, 0) + f.files
    as_planned = files == {day: n for day, (_, n) in plan.items()}
    return tables.read_processed(t.spark, path).select("record_id", "kafka_offset", "speed", "borough", "processed_date", F.lit(as_planned).alias("as_planned"))


@query(
    "s14_clustered_scan",
    f"""SELECT 'area' AS scan, record_id, borough, link_id, speed FROM traffic_fx WHERE borough = 'Queens'
          AND data_as_of_parsed >= {NOW} - INTERVAL 20 DAY AND data_as_of_parsed < {NOW} - INTERVAL 10 DAY
        UNION ALL SELECT 'link', record_id, borough, link_id, speed FROM traffic_fx WHERE link_id = '7'""",
)
def s14_clustered_scan(t):
    """A borough and time, and one link, from files ordered by borough and time with Bloom filters on the link."""
    path = f"{place(t)}/processed"
    _micro_batches(t, path)
    sinks.compact_processed(t.spark, path)
    rows = tables.read_processed(t.spark, path)
    now = F.lit(AS_OF).cast("timestamp")
    when = F.col("data_as_of_parsed")
    area = rows.where((F.col("borough") == "Queens") & (when >= now - F.expr("INTERVAL 20 DAYS")) & (when < now - F.expr("INTERVAL 10 DAYS")))
    link = rows.where(F.col("link_id") == "7")
    columns = ["record_id", "borough", "link_id", "speed"]
    return area.select(F.lit("area").alias("scan"), *columns).unionByName(link.select(F.lit("link").alias("scan"), *columns))

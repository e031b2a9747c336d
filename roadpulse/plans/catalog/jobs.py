"""Whole jobs over stored tables: paged source and polling, hourly run, late rows, exports."""

import json
import os
import urllib.parse

import pandas as pd
from pyspark.sql import functions as F

from roadpulse.ml import features, train
from roadpulse.operators import reports
from roadpulse.plans import hourly_job
from roadpulse.plans.catalog.core import query
from roadpulse.plans.catalog.models import ORDERED
from roadpulse.plans.catalog.streams import place
from roadpulse.plans.fixtures import AS_OF, json_messages
from roadpulse.plans.oracle import AS_OF as NOW
from roadpulse.plans.oracle import pct, rd
from roadpulse.schema import RAW_FIELDS
from roadpulse.session import spread
from roadpulse.sources import envelope, rest, sinks, tables
from roadpulse.streaming import late, routing
from roadpulse.streaming.processing import TablePaths

PAGE = 1000


def _pages(t) -> str:
    """The readings as page files of the remote table, in the order of their ids, written by the tasks."""
    folder = f"{urllib.parse.urlparse(place(t)).path}/pages"  # page files are read as plain files of a shared folder
    fields = [c for c in RAW_FIELDS if c in t.raw.columns]
    numbered = t.raw.withColumn("offset", (F.floor(F.col("kafka_offset") / PAGE) * PAGE).cast("long"))

    def write(offset, pdf: pd.DataFrame) -> pd.DataFrame:
        os.makedirs(folder, exist_ok=True)
        rows = pdf.sort_values("kafka_offset")[fields].astype(object)
        rows = rows.where(rows.notna(), None).to_dict("records")
        draft = os.path.join(folder, f".draft-{offset[0]}-{os.getpid()}")
        with open(draft, "w") as handle:
            json.dump(rows, handle)
        os.replace(draft, os.path.join(folder, f"page-{offset[0]}.json"))  # a repeated task writes the same page
        return pd.DataFrame({"n": [len(rows)]})

    numbered.groupBy("offset").applyInPandas(write, "n long").agg(F.sum("n")).collect()
    return folder


@query("s8_paged_fetch", "SELECT id, speed, link_id, borough, data_as_of FROM traffic_raw_fx")
def s8(t):
    rest.register(t.spark)
    rows = t.spark.read.format("road_feed").options(pages=_pages(t), pageSize=PAGE).load()
    return rows.select("id", "speed", "link_id", "borough", "data_as_of")


@query("s7_latest_fetch", "SELECT id, speed, link_id, borough FROM traffic_raw_fx WHERE kafka_offset < 50 AND borough = 'Queens'")
def s7(t):
    """The first page of a request, of one borough."""
    rest.register(t.spark)
    reader = t.spark.read.format("road_feed").options(pages=_pages(t), limit=PAGE, borough="Queens")
    return reader.load().select("id", "speed", "link_id", "borough").where(F.col("id").cast("long") < 50)


@query(
    "s9_polling_source",
    """SELECT count(*) AS fetched, count(*) AS published, count(*) - count(DISTINCT coalesce(nullif(id, ''), link_id, '') || '_' || coalesce(data_as_of, '')) AS duplicates,
       0::BIGINT AS errors, count(*) AS stored FROM traffic_raw_fx""",
)
def s9(t):
    """One poll of all pages, drained into the raw topic, with its counters."""
    rest.register(t.spark)
    root = place(t)
    paths = TablePaths(f"{root}/tables")
    stream = t.spark.readStream.format("road_feed").options(pages=_pages(t), pageSize=PAGE).load()
    routing.start_polling(stream, paths, f"{root}/checkpoint", once=True).awaitTermination()
    counters = t.spark.read.parquet(f"{paths.root}/poll_statistics")
    stored = t.spark.read.parquet(paths.topic("raw")).agg(F.count("*").alias("n")).scalar()
    return counters.agg(*[F.sum(c).alias(c) for c in ("fetched", "published", "duplicates", "errors")], F.max(stored).alias("stored"))


def _stored(t) -> TablePaths:
    paths = TablePaths(f"{place(t)}/tables")
    sinks.write_processed(t.traffic.drop("batch_id"), paths.processed, "stream_0")
    return paths


_RECENT = f"(SELECT * FROM traffic_fx WHERE processed_at >= {NOW} - INTERVAL 24 HOUR)"


@query(
    "b1_hourly_run",
    f"""SELECT window_start, borough, record_count, avg_speed, median_speed, avg_congestion_score FROM hourly_flat_fx
        WHERE window_start IN (SELECT date_trunc('hour', data_as_of_parsed) FROM {_RECENT})""",
)
def b1(t):
    """The hourly run over stored rows, its table read back; run twice, since it may be repeated."""
    paths = _stored(t)
    for _ in range(2):
        hourly_job.run_batch(t.spark, paths, pd.Timestamp(AS_OF).to_pydatetime())
    rows = reports.flatten_hourly(tables.read_hourly(t.spark, paths.hourly))
    return rows.select("window_start", "borough", "record_count", "avg_speed", "median_speed", "avg_congestion_score")


@query(
    "b1_hourly_run_summary",
    f"""SELECT count(*) AS total_records, 'success' AS status, count(*) AS lineage_records,
        count_if(congestion_level = 'SEVERE') AS severe, {rd('avg(speed)', 2)} AS avg_speed FROM {_RECENT}""",
)
def b1_summary(t):
    """Network summary, quality row and lineage of the hourly run, read back."""
    paths = _stored(t)
    hourly_job.run_batch(t.spark, paths, pd.Timestamp(AS_OF).to_pydatetime())
    metrics = tables.read_quality(t.spark, paths.quality)
    entries = tables.read_lineage(t.spark, paths.lineage)
    summary = tables.read_summaries(t.spark, paths.summaries)
    return metrics.select(
        "total_records",
        entries.select("status").scalar().alias("status"),
        entries.select("record_count").scalar().alias("lineage_records"),
        summary.select(F.element_at("congestion_distribution", F.lit("SEVERE"))).scalar().alias("severe"),
        summary.select("network_avg_speed").scalar().alias("avg_speed"),
    )


@query(
    "u2_backfill_run",
    f"""SELECT date_trunc('hour', try_cast(data_as_of AS TIMESTAMP)) AS window_start, borough,
        count(try_cast(speed AS DOUBLE)) AS record_count, {rd('avg(try_cast(speed AS DOUBLE))', 2)} AS avg_speed
        FROM checked_fx WHERE is_object AND borough IS NOT NULL AND try_cast(data_as_of AS TIMESTAMP) IS NOT NULL GROUP BY 1, 2""",
)
def u2(t):
    """An empty table: the run cleans the topic instead."""
    paths = TablePaths(f"{place(t)}/tables")
    hourly_job.run_batch(t.spark, paths, pd.Timestamp(AS_OF).to_pydatetime(), envelope=t.messages)
    return reports.flatten_hourly(tables.read_hourly(t.spark, paths.hourly)).select("window_start", "borough", "record_count", "avg_speed")


@query(
    "l3_batch_lineage",
    f"""SELECT 'success' AS status, count(*) AS record_count, 'table' AS source, 'batch_20240131T00' AS batch_id FROM {_RECENT}
        UNION ALL SELECT 'skipped_empty', 0, 'table', 'batch_20250131T00' FROM (SELECT count(*) FROM events)""",
)
def l3(t):
    """Lineage of a run over rows and of one over an empty window."""
    paths = _stored(t)
    for moment in (AS_OF, "2025-01-31 00:00:00"):
        hourly_job.run_batch(t.spark, paths, pd.Timestamp(moment).to_pydatetime())
    rows = tables.read_lineage(t.spark, paths.lineage)
    return rows.select("status", "record_count", F.col("source")["type"].alias("source"), "batch_id")


@query(
    "s15_anomaly_export",
    """SELECT link_name, borough, speed, congestion_level, anomaly_score FROM traffic_pred_fx WHERE is_anomaly
       ORDER BY processed_at DESC, record_id DESC LIMIT 20""",
)
def s15_anomalies(t):
    path = f"{place(t)}/anomalies"
    sinks.export_anomalies(t.predicted, path)
    rows = t.spark.read.option("header", True).csv(path)
    return rows.select("link_name", "borough", F.col("speed").cast("double"), "congestion_level", F.col("anomaly_score").cast("double"))


@query(
    "s15_lineage_export",
    """SELECT lineage_id, phase, processor, duration_ms, record_count, status FROM lineage_fx ORDER BY started_at DESC, lineage_id DESC LIMIT 200""",
)
def s15_lineage(t):
    path = f"{place(t)}/lineage"
    sinks.export_lineage(t.lineage, path)
    rows = t.spark.read.option("header", True).csv(path)
    return rows.select("lineage_id", "phase", "processor", F.col("duration_ms").cast("long"), F.col("record_count").cast("long"), "status")


LATE_GROUPS = 4
LATE_DELAY_S = 3 * 24 * 3600


@query(
    "x6_late_rows",
    f"""WITH own AS (SELECT kafka_offset, coalesce(link_id, '') AS k, try_cast(data_as_of AS TIMESTAMP) AS moment, batch_id % {LATE_GROUPS} AS g
          FROM (SELECT "offset" AS kafka_offset, CASE WHEN is_object THEN link_id END AS link_id, CASE WHEN is_object THEN data_as_of END AS data_as_of,
            CAST(floor("offset" / 1000) AS BIGINT) AS batch_id FROM checked_fx)),
        seen AS (SELECT *, max(moment) OVER (PARTITION BY k ORDER BY g RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM own)
        SELECT kafka_offset, coalesce(moment < newest - INTERVAL {LATE_DELAY_S} SECOND, false) AS is_late FROM seen""",
)
def x6(t):
    """Messages in several deliveries: rows older than their link's newest earlier one less three days."""
    root = place(t)
    delivery = F.floor(F.col("offset") / 1000) % LATE_GROUPS
    messages, paths = json_messages(spread(t.events)), TablePaths(f"{root}/tables")
    for k in range(LATE_GROUPS):
        # all files of a delivery are one micro-batch
        messages.where(delivery == k).write.mode("append").parquet(f"{root}/topic")
        stream = envelope.stream_files(t.spark, f"{root}/topic", "parquet", max_files=1_000_000)
        late.start_late_split(stream, paths, f"{root}/checkpoint", LATE_DELAY_S, once=True).awaitTermination()
    on_time = tables.read_processed(t.spark, paths.on_time).select("kafka_offset", F.lit(False).alias("is_late"))
    return on_time.unionByName(tables.read_processed(t.spark, paths.late).select("kafka_offset", F.lit(True).alias("is_late")))


@query(
    "a11_baseline_from_parts",
    f"""SELECT coalesce({rd('avg(speed)', 1)}, 0.0::DOUBLE) AS avg_speed,
        {pct("count_if(congestion_level = 'SEVERE')", 'count(*)', 2)} AS severe_pct,
        {pct("count_if(congestion_level = 'FREE_FLOW')", 'count(*)', 2)} AS free_flow_pct, count(*) AS total_records
        FROM traffic_fx WHERE processed_at >= {NOW} - INTERVAL 7 DAY""",
)
def a11_parts(t):
    """The seven-day baseline from a stored table of hourly sums; the readings are not scanned again."""
    path = f"{place(t)}/baseline_parts"
    sinks.upsert(reports.baseline_parts(t.traffic), path, ["window_start"], "window_start")
    return reports.baseline_from_parts(tables.read_parts(t.spark, path), AS_OF)


@query(
    "m7_fold_sizes",
    f"""SELECT fold, count(*) AS n FROM (SELECT cast(greatest(0, 5 - floor((n - 1 - rn) / (n // 6)::DOUBLE)) AS INTEGER) AS fold
        FROM {ORDERED}) GROUP BY fold""",
)
def m7(t):
    """Rows that each fold of the tuning is tested on (fold 0 is only trained on)."""
    return features.with_folds(features.training_rows(t.traffic)).groupBy("fold").agg(F.count("*").alias("n"))


@query("m20_minimum_gate", f"SELECT congestion_level, count(*) AS n FROM traffic_fx WHERE (SELECT count(*) FROM traffic_fx) >= {train.MINIMUM_ROWS} GROUP BY 1")
def m20(t):
    return train.with_minimum(t.traffic).groupBy("congestion_level").agg(F.count("*").alias("n"))

"""The hourly batch run: last 24 hours to statistics, summary, quality and lineage."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators import hourly, lineage, quality
from roadpulse.session import as_of_column, materialize, prepare
from roadpulse.sources.envelope import backfill
from roadpulse.sources.sinks import append_lineage, upsert
from roadpulse.sources.tables import read_processed
from roadpulse.streaming.processing import TablePaths, now

LOOKBACK_HOURS = 24
COLUMNS = [
    "borough",
    "speed",
    "travel_time",
    "congestion_level",
    "congestion_score",
    "is_peak_hour",
    "quality_flags",
    "data_as_of_parsed",
    "processed_at",
]
_AGGREGATE_KEYS = ["aggregation_type", "window_start"]


def scan_or_backfill(
    spark: SparkSession, paths: TablePaths, as_of, hours: float = LOOKBACK_HOURS, envelope: DataFrame | None = None
) -> tuple[DataFrame, str]:
    """Processed rows of the window; the cleaned topic when the table has none in it."""
    rows = read_processed(spark, paths.processed, as_of, hours, COLUMNS)
    if envelope is None or not rows.isEmpty():
        return rows, "table"
    return materialize(backfill(envelope).select(*COLUMNS)), "topic"


def whole_hours(spark: SparkSession, paths: TablePaths, rows: DataFrame) -> DataFrame:
    """All stored readings of the hours that ``rows`` touch, whenever they were processed.

    A late reading, or the cut of the lookback, would otherwise replace a complete hour by a
    part of it. The bounds of the touched hours reach the scan as a pushed-down filter.
    """
    hour = F.date_trunc("hour", "data_as_of_parsed")
    touched = materialize(rows.select(hour.alias("_hour")).where("_hour IS NOT NULL").distinct())
    first, last = touched.agg(F.min(F.unix_seconds("_hour")), F.max(F.unix_seconds("_hour"))).first()
    if first is None:
        return rows
    stored = read_processed(spark, paths.processed, columns=COLUMNS)
    between = (F.col("data_as_of_parsed") >= F.timestamp_seconds(F.lit(first))) & (F.col("data_as_of_parsed") < F.timestamp_seconds(F.lit(last + 3600)))
    return stored.where(between).withColumn("_hour", hour).join(touched, "_hour", "left_semi").drop("_hour")


def run_batch(
    spark: SparkSession,
    paths: TablePaths,
    as_of: dt.datetime | None = None,
    hours: float = LOOKBACK_HOURS,
    envelope: DataFrame | None = None,
) -> str:
    """Runs once and returns the status. Lineage is written whatever happens, failures are raised."""
    prepare(spark)
    as_of = as_of or now()
    started = now()
    batch_id = f"batch_{as_of:%Y%m%dT%H}"
    status, errors, total, origin = lineage.SUCCESS, [], 0, "table"
    try:
        rows, origin = scan_or_backfill(spark, paths, as_of, hours, envelope)
        metrics = materialize(quality.batch_quality(rows, batch_id, as_of))
        found = metrics.first()
        if found is None:
            status = lineage.SKIPPED
        else:
            total = found["total_records"]
            window_end = F.date_trunc("hour", as_of_column(as_of))
            window_start = window_end - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")
            complete = whole_hours(spark, paths, rows) if origin == "table" else rows
            upsert(
                hourly.hourly_borough(complete, as_of), paths.hourly, _AGGREGATE_KEYS + ["borough"], "window_start"
            )
            summary = hourly.network_summary(rows, window_start, window_end, as_of)
            upsert(summary, paths.summaries, _AGGREGATE_KEYS, "window_start")
            upsert(metrics, paths.quality, ["batch_id"], "recorded_at")
    except Exception as error:
        status = lineage.FAILED
        errors.append(f"{type(error).__name__}: {error}")
        raise
    finally:
        entry = lineage.make_entry(
            spark,
            phase="batch_processing",
            processor="batch_processor",
            batch_id=batch_id,
            started_at=started,
            completed_at=now(),
            record_count=total,
            source={"type": origin, "path": paths.processed},
            destination={"type": "table", "path": paths.hourly},
            transformations=["hourly_borough", "network_summary", "batch_quality"],
            status=status,
            errors=errors,
        )
        append_lineage(entry, paths.lineage, batch_id)
    return status


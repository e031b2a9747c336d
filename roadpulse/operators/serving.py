"""Queries a service answers from the stored tables. Each takes frames and an ``as_of``."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.casts import percent, round_dec
from roadpulse.functions.keys import minutes_between
from roadpulse.functions.traffic import is_congested
from roadpulse.schema import BOROUGHS, UNKNOWN
from roadpulse.session import as_of_column, hours_before

RESPONSE_COLUMNS = [
    "record_id",
    "link_name",
    "borough",
    "speed",
    "travel_time",
    "congestion_level",
    "hour_of_day",
    "is_peak_hour",
    "latitude",
    "longitude",
    "data_as_of",
    "processed_at",
]
RECENT_COLUMNS = RESPONSE_COLUMNS + ["link_id", "congestion_score", "day_of_week", "is_weekend", "time_bucket"]


def check_limit(limit: int, highest: int) -> int:
    if not 1 <= limit <= highest:
        raise ValueError(f"limit must be between 1 and {highest}, got {limit}")
    return limit


def in_boroughs(df: DataFrame, boroughs=None) -> DataFrame:
    """Keeps one or several known boroughs; every row when none is named."""
    if not boroughs:
        return df
    names = [boroughs] if isinstance(boroughs, str) else list(boroughs)
    unknown = [name for name in names if name not in BOROUGHS]
    if unknown:
        raise ValueError(f"unknown borough {unknown}, expected one of {BOROUGHS}")
    return df.where(F.col("borough").isin(names))


def since(df: DataFrame, as_of=None, hours: float = 24, column: str = "processed_at") -> DataFrame:
    return df.where(F.col(column) >= hours_before(as_of, hours))


def newest(df: DataFrame, limit: int | None, column: str = "processed_at", tie: str = "record_id") -> DataFrame:
    """Newest rows first; a page of them where ``limit`` is given."""
    ordered = df.orderBy(F.col(column).desc_nulls_last(), F.col(tie).desc_nulls_last())
    return ordered if limit is None else ordered.limit(limit)


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def reading_response(df: DataFrame) -> DataFrame:
    """The public columns of a reading, with its times as ISO text."""
    return df.select(
        *[iso(F.col(c)).alias(c) if c == "processed_at" else F.col(c) for c in RESPONSE_COLUMNS]
    )


def traffic_live(df: DataFrame, limit: int = 50, borough: str | None = None) -> DataFrame:
    return newest(in_boroughs(df, borough), check_limit(limit, 500)).select(*RESPONSE_COLUMNS)


def traffic_by_borough(df: DataFrame, borough: str, limit: int = 100) -> DataFrame:
    return newest(in_boroughs(df, borough), check_limit(limit, 500)).select(*RESPONSE_COLUMNS)


def traffic_aggregated(hourly: DataFrame, limit: int = 50, borough: str | None = None) -> DataFrame:
    return newest(in_boroughs(hourly, borough), check_limit(limit, 200), "window_start", "borough")


def traffic_anomalies(df: DataFrame, limit: int = 20) -> DataFrame:
    return newest(df.where("is_anomaly"), check_limit(limit, 200))


def recent_records(df: DataFrame, as_of=None, hours: float = 1, boroughs=None, limit: int | None = None) -> DataFrame:
    rows = in_boroughs(since(df, as_of, hours), boroughs)
    numeric = ("speed", "congestion_score", "latitude", "longitude")
    return newest(rows, limit).select(
        *[F.col(c).try_cast("double").alias(c) if c in numeric else F.col(c) for c in RECENT_COLUMNS]
    )


def congestion_trends(df: DataFrame, as_of=None, hours: float = 6, limit: int | None = None) -> DataFrame:
    return newest(since(df, as_of, hours), limit).select(
        "record_id", "borough", "congestion_level", "speed", "hour_of_day", "processed_at"
    )


def windows(aggregates: DataFrame, kind: str, as_of=None, hours: float = 24, borough: str | None = None) -> DataFrame:
    """Aggregate rows of one kind, newest window first."""
    rows = aggregates.where(F.col("aggregation_type") == kind)
    rows = in_boroughs(since(rows, as_of, hours, "window_start"), borough)
    return rows.orderBy(F.col("window_start").desc())


def hourly_aggregations(aggregates: DataFrame, as_of=None, hours: float = 24, borough: str | None = None) -> DataFrame:
    return windows(aggregates, "hourly_borough", as_of, hours, borough)


def network_summaries(aggregates: DataFrame, as_of=None, hours: float = 24) -> DataFrame:
    return windows(aggregates, "window_summary", as_of, hours)


def window_or_all(
    df: DataFrame, as_of=None, hours: float = 24, column: str = "window_start", tie: str = "borough", limit: int | None = None
) -> DataFrame:
    """Rows of the lookback window, or of all time when the window is empty; oldest first.

    With ``limit`` the newest rows of these are kept.
    """
    inside = F.col(column) >= hours_before(as_of, hours)
    found = df.where(inside).limit(1).agg(F.count("*").alias("n")).scalar()
    rows = df.where((found == 0) | inside)
    return (rows if limit is None else newest(rows, limit, column, tie)).orderBy(column, tie)


def dominant_level(df: DataFrame, keys: list[str]) -> DataFrame:
    """Most frequent level per key; a tie goes to the level of the newest row."""
    per_level = df.groupBy(*keys, "congestion_level").agg(
        F.count("*").alias("_n"), F.max(F.struct("processed_at", "record_id")).alias("_seen")
    )
    return per_level.groupBy(*keys).agg(
        F.max_by("congestion_level", F.struct("_n", "_seen")).alias("dominant_level")
    )


def congestion_snapshot(df: DataFrame, as_of=None, hours: float | None = None, sample: int | None = None) -> DataFrame:
    """State of every borough over all rows, those of the last ``hours``, or the newest ``sample`` rows."""
    rows = df if hours is None else since(df, as_of, hours)
    rows = rows.select("borough", "speed", "congestion_level", "processed_at", "record_id")
    rows = rows if sample is None else newest(rows, sample)
    per_level = (
        rows.where(F.col("borough").isNotNull() & (F.col("borough") != ""))
        .groupBy("borough", "congestion_level")
        .agg(
            F.count("*").alias("n"),
            F.sum("speed").alias("sum_speed"),
            F.count("speed").alias("n_speed"),
            F.max(F.struct("processed_at", "record_id")).alias("seen"),
        )
    )
    level = F.col("congestion_level")
    congested = F.sum(F.when(is_congested(level), F.col("n")).otherwise(0))
    labelled = F.sum(F.when(level.isNotNull(), F.col("n")).otherwise(0))
    mean = F.try_divide(F.sum("sum_speed"), F.sum("n_speed"))
    return (
        per_level.groupBy("borough")
        .agg(
            F.coalesce(round_dec(mean, 2), F.lit(0.0)).alias("avg_speed_mph"),
            F.coalesce(F.max_by(level, F.when(level.isNotNull(), F.struct("n", "seen"))), F.lit(UNKNOWN)).alias(
                "dominant_congestion"
            ),
            F.sum("n").alias("record_count"),
            percent(congested, labelled, 1).alias("pct_congested"),
            F.max("seen.processed_at").alias("last_updated"),
        )
        .orderBy("borough")
    )


def pipeline_health(df: DataFrame, aggregates: DataFrame, as_of=None) -> DataFrame:
    """Counts and freshness; healthy up to ten minutes after the newest record."""
    rows = df.agg(F.count("*").alias("total_processed_records"), F.max("processed_at").alias("last_record_at"))
    minutes = round_dec(minutes_between(as_of_column(as_of), F.col("last_record_at")), 1)
    stale = F.col("minutes_since_last_record").isNull() | (F.col("minutes_since_last_record") > 10)
    empty = F.col("total_processed_records") == 0
    return (
        rows.withColumn("total_aggregated_records", aggregates.agg(F.count("*").alias("n")).scalar())
        .withColumn("minutes_since_last_record", minutes)
        .withColumn("status", F.when(stale | empty, "DEGRADED").otherwise("HEALTHY"))
        .withColumn(
            "pipeline_status",
            F.when(stale, "No recent data").when(empty, "No records").otherwise("All systems operational"),
        )
    )

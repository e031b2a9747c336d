"""Raw reading to processed reading, shared by batch, backfill and streaming."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import traffic
from roadpulse.functions.casts import parse_timestamp, safe_double, safe_int
from roadpulse.schema import ENRICHED, PROCESSED, PROCESSOR_VERSION, RAW_FIELDS


def parse_envelope(df: DataFrame) -> DataFrame:
    """Topic rows to raw columns plus their position in the topic."""
    return df.select(
        F.from_json("value", ENRICHED).alias("d"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    ).select("d.*", "kafka_timestamp", "kafka_partition", "kafka_offset")


def _optional(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def clean(df: DataFrame, processed_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed, enriched and flagged readings in the PROCESSED schema.

    Typed values of an earlier enrichment win over the raw text. ``processed_at`` defaults
    to an existing column of that name, else to the clock of the query. Columns named in
    ``keep`` are carried along unchanged.
    """
    missing = [name for name in ("speed", "data_as_of", "link_id", "borough") if name not in df.columns]
    if missing:
        raise ValueError(f"raw columns missing: {missing}")
    enriched = "_pipeline" in df.columns

    def pipeline(name: str, kind: str) -> Column:
        return F.col(f"_pipeline.{name}") if enriched else F.lit(None).cast(kind)

    raw = {name: _optional(df, name, "string") for name in RAW_FIELDS}
    speed = F.coalesce(pipeline("speed_float", "double"), safe_double(raw["speed"]))
    ts = parse_timestamp(raw["data_as_of"])
    if processed_at is None:
        processed_at = F.col("processed_at") if "processed_at" in df.columns else F.current_timestamp()

    # Three projections: parsed text, hour and weekday, then what follows from them, so
    # that no expression repeats the parse.
    parsed = df.select(
        *[raw[name].alias(name) for name in RAW_FIELDS if name not in ("speed", "travel_time", "status")],
        speed.alias("speed"),
        F.coalesce(pipeline("travel_time_int", "int"), safe_int(raw["travel_time"])).alias("travel_time"),
        F.coalesce(pipeline("status_int", "int"), safe_int(raw["status"])).alias("status"),
        ts.alias("data_as_of_parsed"),
        pipeline("ingested_at", "string").alias("ingested_at"),
        pipeline("source", "string").alias("source"),
        pipeline("dataset_id", "string").alias("dataset_id"),
        processed_at.cast("timestamp").alias("processed_at"),
        _optional(df, "kafka_timestamp", "timestamp").alias("kafka_timestamp"),
        _optional(df, "kafka_partition", "int").cast("int").alias("kafka_partition"),
        _optional(df, "kafka_offset", "bigint").cast("bigint").alias("kafka_offset"),
        *keep,
    )
    speed, ts = F.col("speed"), F.col("data_as_of_parsed")
    dated = parsed.withColumns(
        {"hour_of_day": traffic.hour_of_day(ts), "day_of_week": traffic.day_of_week(ts)}
    )
    return dated.withColumns(
        {
            "record_id": F.col("id"),
            **traffic.first_location(F.col("link_points")),
            **traffic.calendar_features(F.col("hour_of_day"), F.col("day_of_week")),
            "congestion_level": traffic.congestion_level(speed),
            "congestion_score": traffic.congestion_score(speed),
            "quality_flags": traffic.quality_flags(speed, ts, F.col("borough"), F.col("link_id")),
            "phase": F.lit("stream_processing"),
            "processor_version": F.lit(PROCESSOR_VERSION),
        }
    ).select(*PROCESSED.fieldNames(), *keep)

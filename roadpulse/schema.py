"""Table schemas and the fixed values that define the meaning of a reading."""

from pyspark.sql import types as T

# Names, thresholds and enumerations that results depend on.
BOROUGHS = ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island"]
CONGESTION_LEVELS = ["FREE_FLOW", "MODERATE", "CONGESTED", "SEVERE"]
UNKNOWN = "UNKNOWN"
FREE_FLOW_MPH = 35.0
MODERATE_MPH = 15.0
CONGESTED_MPH = 5.0
SCORE_REFERENCE_MPH = 60.0
MIN_PLAUSIBLE_MPH = 0.0
MAX_PLAUSIBLE_MPH = 200.0
SPEED_PATTERN = r"^[0-9]+(\.[0-9]+)?$"
PEAK_HOURS = [(7, 9), (17, 19)]
TIME_BUCKETS = ["OVERNIGHT", "MORNING_PEAK", "OFF_PEAK", "EVENING_PEAK"]
QUALITY_FLAGS = [
    "MISSING_SPEED",
    "ZERO_SPEED",
    "MISSING_TIMESTAMP",
    "MISSING_BOROUGH",
    "MISSING_LINK_ID",
]
DAY_LABELS = {1: "Sun", 2: "Mon", 3: "Tue", 4: "Wed", 5: "Thu", 6: "Fri", 7: "Sat"}
MAP_LATITUDE = (40.4, 40.9)
MAP_LONGITUDE = (-74.3, -73.7)
# yyyy-MM-ddTHH:mm:ss with or without 1 to 6 fraction digits, or yyyy-MM-dd HH:mm:ss
TIMESTAMP_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"(T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?| [0-9]{2}:[0-9]{2}:[0-9]{2})$"
)
REQUIRED_FIELDS = ["speed", "data_as_of", "link_id", "borough", "link_name"]
RAW_FIELDS = [
    "id",
    "speed",
    "travel_time",
    "status",
    "data_as_of",
    "link_id",
    "link_points",
    "encoded_poly_line",
    "encoded_poly_line_lvls",
    "owner",
    "transcom_id",
    "borough",
    "link_name",
]
STREAM_SOURCE = "spark_stream_processor"
BATCH_SOURCE = "batch_processor"

PROCESSOR_VERSION = "1.0.0"

RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_FIELDS])

PIPELINE = T.StructType(
    [
        T.StructField("ingested_at", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("dataset_id", T.StringType()),
        T.StructField("phase", T.StringType()),
        T.StructField("speed_float", T.DoubleType()),
        T.StructField("travel_time_int", T.IntegerType()),
        T.StructField("status_int", T.IntegerType()),
    ]
)

ENRICHED = T.StructType(RAW.fields + [T.StructField("_pipeline", PIPELINE)])

ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

PROCESSED = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("link_id", T.StringType()),
        T.StructField("transcom_id", T.StringType()),
        T.StructField("link_name", T.StringType()),
        T.StructField("owner", T.StringType()),
        T.StructField("borough", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("link_points", T.StringType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("travel_time", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("data_as_of", T.StringType()),
        T.StructField("data_as_of_parsed", T.TimestampType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("is_weekend", T.BooleanType()),
        T.StructField("is_peak_hour", T.BooleanType()),
        T.StructField("time_bucket", T.StringType()),
        T.StructField("congestion_level", T.StringType()),
        T.StructField("congestion_score", T.DoubleType()),
        T.StructField("quality_flags", T.ArrayType(T.StringType())),
        T.StructField("ingested_at", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("dataset_id", T.StringType()),
        T.StructField("phase", T.StringType()),
        T.StructField("processor_version", T.StringType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
    ]
)

_COUNTS = T.MapType(T.StringType(), T.LongType())

HOURLY_BOROUGH = T.StructType(
    [
        T.StructField("aggregation_type", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("borough", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField(
            "speed_stats",
            T.StructType(
                [
                    T.StructField("avg", T.DoubleType()),
                    T.StructField("min", T.DoubleType()),
                    T.StructField("max", T.DoubleType()),
                    T.StructField("median", T.DoubleType()),
                ]
            ),
        ),
        T.StructField("avg_travel_time", T.DoubleType()),
        T.StructField("avg_congestion_score", T.DoubleType()),
        T.StructField("congestion_distribution", _COUNTS),
        T.StructField("congestion_pct", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("computed_at", T.TimestampType()),
    ]
)

WINDOW_SUMMARY = T.StructType(
    [
        T.StructField("aggregation_type", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("total_records", T.LongType()),
        T.StructField("network_avg_speed", T.DoubleType()),
        T.StructField("network_avg_congestion_score", T.DoubleType()),
        T.StructField("congestion_distribution", _COUNTS),
        T.StructField("borough_record_counts", _COUNTS),
        T.StructField("peak_hour_pct", T.DoubleType()),
        T.StructField("computed_at", T.TimestampType()),
    ]
)

QUALITY = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
        T.StructField("total_records", T.LongType()),
        T.StructField("valid_records", T.LongType()),
        T.StructField("strict_valid_records", T.LongType()),
        T.StructField("quality_score", T.DoubleType()),
        T.StructField("null_counts", _COUNTS),
        T.StructField("anomalies", _COUNTS),
        T.StructField("quality_flags_distribution", _COUNTS),
        T.StructField("congestion_distribution", _COUNTS),
        T.StructField("borough_distribution", _COUNTS),
    ]
)

OFFSET_RANGE = T.StructType(
    [
        T.StructField("min", T.LongType()),
        T.StructField("max", T.LongType()),
        T.StructField("count", T.LongType()),
    ]
)

_OPEN = T.MapType(T.StringType(), T.StringType())

LINEAGE = T.StructType(
    [
        T.StructField("lineage_id", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("phase", T.StringType()),
        T.StructField("processor", T.StringType()),
        T.StructField("processor_version", T.StringType()),
        T.StructField("source", _OPEN),
        T.StructField("destination", _OPEN),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("transformations", T.ArrayType(T.StringType())),
        T.StructField("status", T.StringType()),
        T.StructField("errors", T.ArrayType(T.StringType())),
        T.StructField("offset_ranges", T.MapType(T.StringType(), OFFSET_RANGE)),
        T.StructField("extra", _OPEN),
    ]
)

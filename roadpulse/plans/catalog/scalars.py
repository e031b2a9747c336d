"""Scalar functions, projections, filters and validation over whole tables."""

from pyspark.sql import functions as F

from roadpulse.functions import casts, keys, traffic
from roadpulse.operators import clean as cleaning
from roadpulse.operators import ingest, serving
from roadpulse.operators.quality import with_invalid
from roadpulse.operators.reports import flatten_hourly, map_points
from roadpulse.plans.catalog.core import query
from roadpulse.plans.fixtures import AS_OF
from roadpulse.plans.oracle import AS_OF as NOW
from roadpulse.plans.oracle import FLAGS, borough_code, level, level_code, level_name, rd
from roadpulse.schema import QUALITY_FLAGS
from roadpulse.sources.envelope import backfill


def _speed():
    return casts.safe_double(F.col("speed"))


def _flag_columns():
    return [F.array_contains("quality_flags", flag).alias(f"f_{flag.lower()}") for flag in QUALITY_FLAGS]


_FLAG_SQL = ", ".join(f"f_{n.lower()}" for n in FLAGS)


@query("c1_congestion_level", f"SELECT id, {level('try_cast(speed AS DOUBLE)')} AS congestion_level FROM traffic_raw_fx")
def c1(t):
    return t.raw.select("id", traffic.congestion_level(_speed()).alias("congestion_level"))


@query("c2_congestion_score", "SELECT record_id AS id, congestion_score FROM traffic_fx")
def c2(t):
    return t.raw.select("id", traffic.congestion_score(_speed()).alias("congestion_score"))


@query(
    "c3_time_features",
    "SELECT record_id AS id, hour_of_day, day_of_week, is_weekend, is_peak_hour FROM traffic_fx",
)
def c3(t):
    ts = casts.parse_timestamp(F.col("data_as_of"))
    hour, day = traffic.hour_of_day(ts), traffic.day_of_week(ts)
    return t.raw.select(
        "id",
        hour.alias("hour_of_day"),
        day.alias("day_of_week"),
        traffic.is_weekend(day).alias("is_weekend"),
        traffic.is_peak_hour(hour, day).alias("is_peak_hour"),
    )


@query("c4_time_bucket", "SELECT record_id AS id, time_bucket FROM traffic_fx")
def c4(t):
    ts = casts.parse_timestamp(F.col("data_as_of"))
    return t.raw.select("id", traffic.time_bucket(F.hour(ts), F.dayofweek(ts)).alias("time_bucket"))


@query("c5_first_location", "SELECT record_id AS id, latitude, longitude FROM traffic_fx")
def c5(t):
    return t.raw.select("id", *[c.alias(n) for n, c in traffic.first_location(F.col("link_points")).items()])


@query("c6_quality_flags", f"SELECT record_id AS id, {_FLAG_SQL} FROM traffic_fx")
def c6(t):
    flags = traffic.quality_flags(
        _speed(), casts.parse_timestamp(F.col("data_as_of")), F.col("borough"), F.col("link_id")
    )
    return t.raw.withColumn("quality_flags", flags).select("id", *_flag_columns())


@query(
    "c7_safe_float",
    """SELECT id, try_cast(speed AS DOUBLE) AS speed, CAST(NULL AS DOUBLE) AS from_text, CAST(NULL AS DOUBLE) AS from_suffix
       FROM traffic_raw_fx""",
)
def c7(t):
    return t.raw.select(
        "id",
        _speed().alias("speed"),
        casts.safe_double(F.col("link_name")).alias("from_text"),
        casts.safe_double(F.concat(F.col("status"), F.lit("d"))).alias("from_suffix"),
    )


@query(
    "c8_safe_int",
    """SELECT id, cast(trunc(try_cast(speed AS DOUBLE)) AS INTEGER) AS speed_int,
       cast(trunc(try_cast(travel_time AS DOUBLE)) AS INTEGER) AS travel_time_int FROM traffic_raw_fx""",
)
def c8(t):
    return t.raw.select(
        "id",
        casts.safe_int(F.col("speed")).alias("speed_int"),
        casts.safe_int(F.col("travel_time")).alias("travel_time_int"),
    )


@query(
    "c9_parse_timestamp",
    """SELECT id, date_trunc('second', try_cast(data_as_of AS TIMESTAMP)) AS without_fraction,
       date_trunc('second', try_cast(data_as_of AS TIMESTAMP)) AS with_space,
       try_cast(data_as_of AS TIMESTAMP) AS with_fraction, CAST(NULL AS TIMESTAMP) AS from_text FROM traffic_raw_fx""",
)
def c9(t):
    text = F.col("data_as_of")
    second = F.substring(text, 1, 19)
    return t.raw.select(
        "id",
        casts.parse_timestamp(text).alias("with_fraction"),
        casts.parse_timestamp(second).alias("without_fraction"),
        casts.parse_timestamp(F.replace(second, F.lit("T"), F.lit(" "))).alias("with_space"),
        casts.parse_timestamp(F.col("link_name")).alias("from_text"),
    )


@query(
    "c10_to_utc",
    """SELECT id, try_cast(data_as_of AS TIMESTAMP) AS zulu,
       try_cast(data_as_of AS TIMESTAMP) - INTERVAL 5 HOUR AS from_offset FROM traffic_raw_fx""",
)
def c10(t):
    return t.raw.select(
        "id",
        casts.to_utc(F.concat("data_as_of", F.lit("Z"))).alias("zulu"),
        casts.to_utc(F.concat("data_as_of", F.lit("+05:00"))).alias("from_offset"),
    )


@query("c11_round", f"SELECT event_id, {rd('value / 7', 2)} AS r2, {rd('value / 7', 4)} AS r4 FROM events")
def c11(t):
    value = F.col("value") / 7
    return t.events.select("event_id", casts.round_dec(value, 2).alias("r2"), casts.round_dec(value, 4).alias("r4"))


@query("c12_encode_borough", f"SELECT id, {borough_code('borough')} AS borough_encoded FROM traffic_raw_fx")
def c12(t):
    return t.raw.select("id", traffic.encode_borough(F.col("borough")).alias("borough_encoded"))


@query(
    "c13_encode_labels",
    f"""SELECT record_id, {level_code('congestion_level')} AS label,
        {level_name(level_code('congestion_level'))} AS decoded FROM traffic_fx""",
)
def c13(t):
    label = traffic.encode_level(F.col("congestion_level"))
    return t.traffic.select("record_id", label.alias("label"), traffic.decode_level(label).alias("decoded"))


@query(
    "c16_enrich_casts",
    """SELECT id, coalesce(try_cast(speed AS DOUBLE), 0.0::DOUBLE) AS speed_float,
       coalesce(cast(trunc(try_cast(travel_time AS DOUBLE)) AS INTEGER), 0) AS travel_time_int,
       coalesce(cast(trunc(try_cast(status AS DOUBLE)) AS INTEGER), 0) AS status_int FROM traffic_raw_fx""",
)
def c16(t):
    rows = ingest.enrich(t.raw, F.lit(AS_OF).cast("timestamp"))
    return rows.select("id", *[f"_pipeline.{n}" for n in ("speed_float", "travel_time_int", "status_int")])


@query(
    "c17_borough_partition",
    f"SELECT id, nullif({borough_code('borough')}, -1) AS partition_id FROM traffic_raw_fx",
)
def c17(t):
    return t.raw.select("id", traffic.borough_partition(F.col("borough")).alias("partition_id"))


@query(
    "c18_dedup_key",
    """SELECT kafka_offset, coalesce(nullif(id, ''), link_id, '') || '_' || coalesce(data_as_of, '') AS dedup_key,
       coalesce(link_id, '') || '_' || coalesce(data_as_of, '') AS without_id FROM traffic_raw_fx""",
)
def c18(t):
    none = F.lit(None).cast("string")
    return t.raw.select(
        "kafka_offset",
        keys.dedup_key(F.col("id"), F.col("link_id"), F.col("data_as_of")).alias("dedup_key"),
        keys.dedup_key(none, F.col("link_id"), F.col("data_as_of")).alias("without_id"),
    )


@query(
    "c19_message_key",
    "SELECT kafka_offset, id AS with_id, coalesce(link_id, '') AS without_id FROM traffic_raw_fx",
)
def c19(t):
    return t.raw.select(
        "kafka_offset",
        keys.message_key(F.col("id"), F.col("link_id")).alias("with_id"),
        keys.message_key(F.lit(""), F.col("link_id")).alias("without_id"),
    )


@query("c20_flatten_hourly", "SELECT * FROM hourly_flat_fx")
def c20(t):
    return flatten_hourly(t.hourly)


@query("c21_null_columns", "SELECT batch_id, null_speed, null_borough, null_data_as_of FROM quality_fx")
def c21(t):
    counts = F.col("null_counts")
    return t.quality.select("batch_id", *[counts[n].alias(f"null_{n}") for n in ("speed", "borough", "data_as_of")])


@query(
    "c22_record_label",
    f"""SELECT record_id, substr(link_name, 1, 35) || ' | ' || coalesce(borough, '?') || ' | ' ||
        coalesce(printf('%.1f', {rd('speed', 1)}), '?') || ' mph' AS label FROM traffic_fx""",
)
def c22(t):
    label = keys.record_label(F.col("link_name"), F.col("borough"), F.col("speed"))
    return t.traffic.select("record_id", label.alias("label"))


@query(
    "c23_freshness",
    f"""SELECT max(processed_at) AS newest,
        {rd(f'(epoch_us({NOW}) - epoch_us(max(processed_at))) / 60000000.0::DOUBLE', 4)} AS minutes FROM traffic_fx""",
)
def c23(t):
    newest = t.traffic.agg(F.max("processed_at").alias("newest"))
    minutes = keys.minutes_between(F.lit(AS_OF).cast("timestamp"), F.col("newest"))
    return newest.withColumn("minutes", casts.round_dec(minutes, 4))


@query(
    "c24_derived_counts",
    """SELECT q.batch_id, total_records - valid_records AS invalid_records, duration_ms / 1000.0::DOUBLE AS duration_sec
       FROM quality_fx q JOIN lineage_fx l ON q.batch_id = l.batch_id""",
)
def c24(t):
    seconds = t.lineage.select("batch_id", (F.col("duration_ms") / 1000.0).alias("duration_sec"))
    return with_invalid(t.quality).select("batch_id", "invalid_records").join(seconds, "batch_id")


@query(
    "c25_lineage_id",
    "SELECT batch_id, lineage_id FROM lineage_fx",
)
def c25(t):
    return t.lineage.select("batch_id", "lineage_id")


@query(
    "f1_parse_envelope",
    """SELECT "offset" AS kafka_offset, "partition" AS kafka_partition, "timestamp" AS kafka_timestamp,
       CASE WHEN is_object THEN id END AS id, CASE WHEN is_object THEN speed END AS speed,
       CASE WHEN is_object THEN link_id END AS link_id, CASE WHEN is_object THEN data_as_of END AS data_as_of
       FROM checked_fx""",
)
def f1(t):
    return cleaning.parse_envelope(t.messages).select(
        "kafka_offset", "kafka_partition", "kafka_timestamp", "id", "speed", "link_id", "data_as_of"
    )


@query(
    "f2_replace_and_drop",
    "SELECT record_id, speed, travel_time, status, data_as_of_parsed FROM traffic_fx",
)
def f2(t):
    return cleaning.clean(t.raw).select("record_id", "speed", "travel_time", "status", "data_as_of_parsed")


_REASONS = {
    "invalid_json": ["INVALID_JSON"],
    "not_an_object": ["NOT_AN_OBJECT"],
    "missing_required": ["MISSING_SPEED", "MISSING_DATA_AS_OF", "MISSING_LINK_ID", "MISSING_BOROUGH", "MISSING_LINK_NAME"],
    "wrong_type": ["NOT_A_STRING_SPEED", "NOT_A_STRING_TRANSCOM_ID"],
    "speed_format": ["SPEED_FORMAT"],
    "unknown_borough": ["UNKNOWN_BOROUGH"],
    "speed_range": ["SPEED_RANGE"],
    "travel_time_text": ["TRAVEL_TIME_NOT_INTEGER"],
}


@query(
    "f3_validate",
    f'SELECT "offset" AS kafka_offset, is_valid, {", ".join(_REASONS)} FROM verdict_fx',
)
def f3(t):
    return ingest.validate(t.messages).select(
        F.col("offset").alias("kafka_offset"),
        "is_valid",
        *[
            F.arrays_overlap("reasons", F.array(*[F.lit(r) for r in reasons])).alias(name)
            for name, reasons in _REASONS.items()
        ],
    )


@query(
    "f3b_json_types",
    """SELECT event_id, json_type(props, '$.k') = 'VARCHAR' AS is_string, json_type(props, '$.k') = 'NULL' AS is_explicit_null,
       json_type(props, '$.missing') IS NULL AS is_absent FROM events""",
)
def f3b(t):
    def kind(path):
        return F.schema_of_variant(F.try_variant_get(F.try_parse_json("props"), path, "variant"))

    return t.events.select(
        "event_id",
        (kind("$.k") == "STRING").alias("is_string"),
        (kind("$.k") == "VOID").alias("is_explicit_null"),
        kind("$.missing").isNull().alias("is_absent"),
    )


@query(
    "f4_route_counts",
    """SELECT count(*) AS processed, count_if(is_valid) AS valid, count_if(NOT is_valid) AS invalid FROM verdict_fx""",
)
def f4(t):
    return ingest.validate(t.messages).agg(*ingest.route_counts())


@query(
    "f4_rejected_rows",
    'SELECT value AS original, "offset" AS source_offset, "partition" AS source_partition FROM verdict_fx WHERE NOT is_valid',
)
def f4_rejected(t):
    rows = ingest.rejected_rows(ingest.validate(t.messages), F.lit(AS_OF).cast("timestamp"))
    return rows.select("original", "source_offset", "source_partition")


@query(
    "f5_enrich",
    """SELECT "offset" AS kafka_offset, id, speed, try_cast(speed AS DOUBLE) AS speed_float,
       coalesce(try_cast(travel_time AS INTEGER), 0) AS travel_time_int, try_cast(status AS INTEGER) AS status_int,
       '2024-01-31T00:00:00.000000Z' AS ingested_at, 'raw_ingestion' AS phase FROM verdict_fx WHERE is_valid""",
)
def f5(t):
    rows = ingest.valid_rows(ingest.validate(t.messages), ingested_at=F.lit(AS_OF).cast("timestamp"))
    names = ("speed_float", "travel_time_int", "status_int", "ingested_at", "phase")
    return cleaning.parse_envelope(rows.withColumn("key", F.lit(None).cast("string"))).select(
        "kafka_offset", "id", "speed", *[f"_pipeline.{n}" for n in names]
    )


@query(
    "f6_lookback",
    f"SELECT record_id, processed_at FROM traffic_fx WHERE processed_at >= {NOW} - INTERVAL 24 HOUR",
)
def f6(t):
    return serving.since(t.traffic, AS_OF, 24).select("record_id", "processed_at")


@query(
    "f7_borough_filters",
    "SELECT record_id, borough FROM traffic_fx WHERE borough IN ('Queens', 'Bronx')",
)
def f7(t):
    return serving.in_boroughs(t.traffic, ["Queens", "Bronx"]).select("record_id", "borough")


@query(
    "f8_mixed_time_range",
    f"""SELECT record_id, data_as_of_parsed AS moment FROM traffic_fx
        WHERE data_as_of_parsed >= {NOW} - INTERVAL 48 HOUR""",
)
def f8(t):
    typed = F.when(F.col("kafka_offset") % 2 == 0, F.col("data_as_of_parsed"))
    text = F.when(F.col("kafka_offset") % 2 == 1, F.concat("data_as_of", F.lit("Z")))
    rows = t.traffic.withColumn("moment", casts.typed_timestamp(typed, text))
    return serving.since(rows, AS_OF, 48, "moment").select("record_id", "moment")


@query(
    "f9_window_hit",
    f"""SELECT window_start, borough, record_count FROM hourly_fx WHERE window_start >= {NOW} - INTERVAL 24 HOUR""",
)
def f9_hit(t):
    return serving.window_or_all(t.hourly_stats, AS_OF, 24).select("window_start", "borough", "record_count")


@query(
    "f9_window_fallback",
    "SELECT window_start, borough, record_count FROM hourly_fx",
)
def f9_all(t):
    return serving.window_or_all(t.hourly_stats, "2025-01-01 00:00:00", 24).select(
        "window_start", "borough", "record_count"
    )


@query(
    "f10_null_drop",
    "SELECT record_id, speed, borough FROM traffic_fx WHERE speed IS NOT NULL AND borough IS NOT NULL",
)
def f10(t):
    return t.traffic.dropna(subset=["speed", "borough"]).select("record_id", "speed", "borough")


@query(
    "f11_bounding_box",
    """SELECT record_id, latitude, longitude FROM traffic_fx WHERE latitude BETWEEN 40.4 AND 40.9
       AND longitude BETWEEN -74.3 AND -73.7 AND speed IS NOT NULL""",
)
def f11(t):
    return map_points(t.traffic).select("record_id", "latitude", "longitude")


_RESPONSE = (
    "record_id, link_name, borough, speed, travel_time, congestion_level, hour_of_day, is_peak_hour, latitude, longitude, data_as_of"
)


@query(
    "f16_response_projection",
    f"SELECT {_RESPONSE}, strftime(processed_at, '%Y-%m-%dT%H:%M:%S.%f') AS processed_at FROM traffic_fx",
)
def f16(t):
    return serving.reading_response(t.traffic)


@query(
    "p1_clean",
    f"""SELECT record_id, link_id, link_name, borough, latitude, longitude, link_points, speed, travel_time, status,
        data_as_of, data_as_of_parsed, hour_of_day, day_of_week, is_weekend, is_peak_hour, time_bucket,
        congestion_level, congestion_score, processed_at, kafka_partition, kafka_offset, {_FLAG_SQL} FROM traffic_fx""",
)
def p1(t):
    return t.traffic.select(
        "record_id", "link_id", "link_name", "borough", "latitude", "longitude", "link_points", "speed",
        "travel_time", "status", "data_as_of", "data_as_of_parsed", "hour_of_day", "day_of_week", "is_weekend",
        "is_peak_hour", "time_bucket", "congestion_level", "congestion_score", "processed_at", "kafka_partition",
        "kafka_offset", *_flag_columns(),
    )


@query(
    "s2_backfill",
    """SELECT c."offset" AS kafka_offset, id AS record_id, try_cast(speed AS DOUBLE) AS speed,
       try_cast(data_as_of AS TIMESTAMP) AS data_as_of_parsed FROM checked_fx c WHERE is_object""",
)
def s2(t):
    return backfill(t.messages).select("kafka_offset", "record_id", "speed", "data_as_of_parsed")

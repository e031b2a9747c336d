"""Serving and monitoring queries: newest rows, reports, quality and lineage series."""

from pyspark.sql import functions as F

from roadpulse.functions.casts import round_dec
from roadpulse.operators import lineage, quality, reports, serving
from roadpulse.plans.catalog.core import query
from roadpulse.plans.fixtures import AS_OF
from roadpulse.plans.oracle import AS_OF as NOW
from roadpulse.plans.oracle import pct, rd
from roadpulse.schema import DAY_LABELS, TIME_BUCKETS

_NEWEST = "ORDER BY processed_at DESC, record_id DESC"
_RESPONSE = ", ".join(serving.RESPONSE_COLUMNS)


@query("t1_traffic_live", f"SELECT {_RESPONSE} FROM traffic_fx {_NEWEST} LIMIT 50")
def t1(t):
    return serving.traffic_live(t.traffic)


@query("t2_traffic_by_borough", f"SELECT {_RESPONSE} FROM traffic_fx WHERE borough = 'Queens' {_NEWEST} LIMIT 100")
def t2(t):
    return serving.traffic_by_borough(t.traffic, "Queens")


@query(
    "t3_traffic_aggregated",
    "SELECT window_start, borough, record_count FROM hourly_fx ORDER BY window_start DESC, borough DESC LIMIT 50",
)
def t3(t):
    return serving.traffic_aggregated(t.hourly).select("window_start", "borough", "record_count")


_ANOMALY = "record_id, link_name, borough, speed, congestion_level, anomaly_score, processed_at"


@query("t4_traffic_anomalies", f"SELECT {_ANOMALY} FROM traffic_pred_fx WHERE is_anomaly {_NEWEST} LIMIT 20")
def t4(t):
    return serving.traffic_anomalies(t.predicted).select(*_ANOMALY.split(", "))


@query("f13_anomaly_filter", f"SELECT {_ANOMALY} FROM traffic_pred_fx WHERE is_anomaly")
def f13(t):
    return t.predicted.where("is_anomaly").select(*_ANOMALY.split(", "))


@query(
    "t5_recent_records",
    f"""SELECT {", ".join(serving.RECENT_COLUMNS)} FROM traffic_fx WHERE processed_at >= {NOW} - INTERVAL 72 HOUR
        AND borough IN ('Bronx', 'Brooklyn')""",
)
def t5(t):
    return serving.recent_records(t.traffic, AS_OF, 72, ["Bronx", "Brooklyn"])


_METRIC = "batch_id, source, recorded_at, total_records, valid_records, quality_score"


@query(
    "t6_quality_metrics",
    f"""SELECT {_METRIC} FROM quality_fx
        WHERE recorded_at >= {NOW} - INTERVAL 240 HOUR""",
)
def t6(t):
    return quality.quality_metrics(t.quality, AS_OF, 240).select(*_METRIC.split(", "))


@query(
    "t7_lineage_entries",
    """SELECT lineage_id, batch_id, phase, status, started_at, duration_ms, record_count FROM lineage_fx
       ORDER BY started_at DESC, lineage_id DESC LIMIT 100""",
)
def t7(t):
    return lineage.newest_entries(t.lineage).select(
        "lineage_id", "batch_id", "phase", "status", "started_at", "duration_ms", "record_count"
    )


@query(
    "t8_quality_trend",
    f"""SELECT recorded_at, source, quality_score, total_records FROM quality_fx
        WHERE recorded_at >= {NOW} - INTERVAL 240 HOUR""",
)
def t8(t):
    return quality.quality_trend(t.quality, AS_OF, 240)


@query(
    "t8_latest_score",
    "SELECT source, max_by(quality_score, (recorded_at, batch_id)) AS quality_score FROM quality_fx GROUP BY source",
)
def t8_latest(t):
    return quality.latest_score(t.quality)


@query(
    "t9_hourly_aggregations",
    f"""SELECT window_start, borough, record_count FROM hourly_fx WHERE borough = 'Bronx'
        AND window_start >= {NOW} - INTERVAL 48 HOUR""",
)
def t9(t):
    rows = serving.hourly_aggregations(t.hourly, AS_OF, 48, "Bronx")
    return rows.select("window_start", "borough", "record_count")


@query(
    "t9_network_summaries",
    f"""SELECT date_trunc('day', processed_at) AS window_start, count(*) AS total_records FROM traffic_fx
        WHERE processed_at >= {NOW} - INTERVAL 10 DAY GROUP BY 1""",
)
def t9_network(t):
    daily = t.traffic.groupBy(F.date_trunc("day", "processed_at").alias("window_start")).agg(
        F.count("*").alias("total_records")
    )
    rows = daily.withColumn("aggregation_type", F.lit("window_summary"))
    return serving.network_summaries(rows, AS_OF, 240).select("window_start", "total_records")


@query(
    "t10_congestion_trends",
    f"""SELECT record_id, borough, congestion_level, speed, hour_of_day, processed_at FROM traffic_fx
        WHERE processed_at >= {NOW} - INTERVAL 72 HOUR""",
)
def t10(t):
    return serving.congestion_trends(t.traffic, AS_OF, 72)


_MAP = "FROM traffic_fx WHERE latitude BETWEEN 40.4 AND 40.9 AND longitude BETWEEN -74.3 AND -73.7 AND speed IS NOT NULL"


@query(
    "t11_seeded_sample",
    f"""WITH points AS (SELECT record_id, link_id, latitude, longitude, speed, processed_at {_MAP}),
        newest AS (SELECT * FROM points QUALIFY row_number() OVER (PARTITION BY link_id ORDER BY processed_at DESC, record_id DESC) = 1),
        sample AS (SELECT * FROM newest ORDER BY md5(concat_ws(':', link_id, '42')), link_id NULLS FIRST LIMIT 1500)
        SELECT record_id, link_id, latitude, longitude, speed FROM points WHERE (SELECT count(*) FROM points) <= 1500
        UNION ALL SELECT record_id, link_id, latitude, longitude, speed FROM sample WHERE (SELECT count(*) FROM points) > 1500""",
)
def t11(t):
    return reports.map_sample(t.traffic).select("record_id", "link_id", "latitude", "longitude", "speed")


@query("t12_first_rows", f"SELECT record_id, processed_at FROM traffic_fx {_NEWEST} LIMIT 200")
def t12(t):
    return serving.newest(t.traffic, 200).select("record_id", "processed_at")


@query(
    "w1_latest_per_link",
    """SELECT link_id, record_id, speed, processed_at FROM traffic_fx
       QUALIFY row_number() OVER (PARTITION BY link_id ORDER BY processed_at DESC, record_id DESC) = 1""",
)
def w1(t):
    columns = ["link_id", "record_id", "speed", "processed_at"]
    return reports.latest_per_link(t.traffic.select(*columns)).select(*columns)


@query(
    "w2_mean_of_latest",
    f"""SELECT {rd('avg(quality_score)', 6)} AS recent_quality FROM
        (SELECT quality_score FROM quality_fx ORDER BY recorded_at DESC, batch_id DESC LIMIT 5)""",
)
def w2(t):
    rows = quality.mean_of_latest(t.quality)
    return rows.select(round_dec(F.col("recent_quality"), 6).alias("recent_quality"))


@query(
    "w3_dominant_level",
    """SELECT borough, congestion_level AS dominant_level FROM (SELECT borough, congestion_level, count(*) AS n,
         max(processed_at) AS seen, max_by(record_id, (processed_at, record_id)) AS rid FROM traffic_fx GROUP BY 1, 2)
       QUALIFY row_number() OVER (PARTITION BY borough ORDER BY n DESC, seen DESC, rid DESC) = 1""",
)
def w3(t):
    return serving.dominant_level(t.traffic, ["borough"])


@query(
    "w6_null_counts_by_batch",
    """SELECT cast(row_number() OVER (ORDER BY recorded_at, batch_id) AS INTEGER) AS batch, batch_id, null_speed,
         null_borough, null_data_as_of
       FROM (SELECT * FROM quality_fx ORDER BY recorded_at DESC, batch_id DESC LIMIT 20)""",
)
def w6(t):
    return quality.null_counts_by_batch(t.quality)


@query("a15_level_counts", "SELECT congestion_level, count(*) AS n FROM traffic_fx GROUP BY 1")
def a15(t):
    return reports.level_counts(t.traffic).drop("position")


@query(
    "a16_borough_speeds",
    f"""SELECT borough, {rd('avg(speed)', 6)} AS avg_speed FROM traffic_fx
        WHERE borough IS NOT NULL AND speed IS NOT NULL GROUP BY 1""",
)
def a16(t):
    rows = reports.borough_speeds(t.traffic)
    return rows.select("borough", round_dec(F.col("avg_speed"), 6).alias("avg_speed"))


_BUCKETS = " UNION ALL ".join(f"SELECT {i + 1} AS position, '{b}' AS time_bucket" for i, b in enumerate(TIME_BUCKETS))


@query(
    "a17_bucket_speeds",
    f"""SELECT position, b.time_bucket, {rd('avg_speed', 6)} AS avg_speed FROM ({_BUCKETS}) b
        LEFT JOIN (SELECT time_bucket, avg(speed) AS avg_speed FROM traffic_fx WHERE speed IS NOT NULL GROUP BY 1) s
        ON b.time_bucket = s.time_bucket""",
)
def a17(t):
    rows = reports.bucket_speeds(t.traffic)
    return rows.withColumn("avg_speed", round_dec(F.col("avg_speed"), 6))


@query(
    "a18_speed_histogram",
    """SELECT congestion_level, cast(greatest(-1, least(30, floor(speed / (210.0::DOUBLE / 30)))) AS INTEGER) AS bin,
       count(*) AS n FROM traffic_fx WHERE speed IS NOT NULL GROUP BY 1, 2""",
)
def a18(t):
    return reports.speed_histogram(t.traffic)


@query(
    "a19_congestion_heatmap",
    "SELECT hour_of_day, "
    + ", ".join(
        rd(f"avg(CASE WHEN day_of_week = {day} THEN congestion_score END)", 6) + f" AS {label}"
        for day, label in DAY_LABELS.items()
    )
    + " FROM traffic_fx WHERE hour_of_day IS NOT NULL AND congestion_score IS NOT NULL GROUP BY 1",
)
def a19(t):
    rows = reports.congestion_heatmap(t.traffic)
    return rows.select("hour_of_day", *[round_dec(F.col(c), 6).alias(c) for c in DAY_LABELS.values()])


@query(
    "a20_borough_performance",
    f"""SELECT borough, {rd('avg(avg_speed)', 2)} AS avg_speed, {rd('min(min_speed)', 2)} AS min_speed,
        {rd('max(max_speed)', 2)} AS max_speed, {rd('avg(avg_congestion_score)', 2)} AS avg_congestion_score,
        {rd('avg(avg_travel_time)', 2)} AS avg_travel_time, cast(sum(record_count) AS BIGINT) AS total_records
        FROM hourly_flat_fx GROUP BY borough""",
)
def a20(t):
    return reports.borough_performance(reports.flatten_hourly(t.hourly))


@query(
    "a21_quality_kpis",
    f"""SELECT {rd('avg(quality_score)', 2)} AS avg_quality_score, {rd('min(quality_score)', 2)} AS min_quality_score,
        cast(sum(total_records) AS BIGINT) AS total_records, cast(sum(valid_records) AS BIGINT) AS valid_records,
        {pct('sum(valid_records)', 'sum(total_records)', 1)} AS valid_pct FROM quality_fx""",
)
def a21(t):
    return quality.quality_kpis(t.quality)


@query(
    "a22_lineage_kpis",
    f"""SELECT count(*) AS total_batches, {pct("count_if(status = 'success')", 'count(*)', 1)} AS success_rate,
        count(*) - count_if(status = 'success') AS unsuccessful, {rd('avg(duration_ms) / 1000', 1)} AS avg_duration_s,
        cast(sum(record_count) AS BIGINT) AS total_records, max(started_at) AS last_started_at,
        cast(greatest(0, floor((epoch_us({NOW}) - epoch_us(max(started_at))) / 60000000.0::DOUBLE)) AS BIGINT) AS last_age_minutes,
        count_if(status = 'success') / count(*)::DOUBLE < 0.95 AND count(*) >= 5 AS alert FROM lineage_fx""",
)
def a22(t):
    return lineage.lineage_kpis(t.lineage, AS_OF)


@query("a23_batches_by_phase", "SELECT phase, count(*) AS n FROM lineage_fx GROUP BY 1")
def a23_phase(t):
    return lineage.batches_by(t.lineage, "phase")


@query("a23_batches_by_status", "SELECT status, count(*) AS n FROM lineage_fx GROUP BY 1")
def a23_status(t):
    return lineage.batches_by(t.lineage, "status")


_TOTALS = {
    "anomalies": ("zero_speed", "unknown_congestion"),
    "null_counts": ("null_speed", "null_borough", "null_data_as_of"),
}


@query(
    "a24_anomaly_summary",
    " UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, '{name.replace("null_", "")}' AS key, cast(sum({name}) AS BIGINT) AS total
            FROM quality_fx WHERE recorded_at >= {NOW} - INTERVAL 240 HOUR"""
        for kind, names in _TOTALS.items()
        for name in names
    ),
)
def a24(t):
    return quality.anomaly_summary(t.quality, AS_OF, 240)


@query(
    "a25_storage_counts",
    """SELECT 'traffic_processed' AS collection, count(*) AS document_count FROM traffic_fx
       UNION ALL SELECT 'traffic_aggregated', count(*) FROM hourly_fx
       UNION ALL SELECT 'data_quality_metrics', count(*) FROM quality_fx""",
)
def a25(t):
    return quality.storage_counts(
        {"traffic_processed": t.traffic, "traffic_aggregated": t.hourly, "data_quality_metrics": t.quality}
    )


@query(
    "a26_pipeline_summary",
    """SELECT (SELECT count(*) FROM traffic_fx) AS total_processed_records, (SELECT count(*) FROM hourly_fx) AS total_aggregations,
       count_if(source = 'spark_stream_processor') AS stream_batches_recorded,
       count_if(source = 'batch_processor') AS batch_jobs_recorded,
       max_by(quality_score, (recorded_at, batch_id)) AS latest_quality_score, max(recorded_at) AS latest_recorded_at FROM quality_fx""",
)
def a26(t):
    return reports.pipeline_summary(t.traffic, t.hourly, t.quality)


@query(
    "a27_anomaly_rate",
    f"""SELECT *, CASE WHEN anomaly_pct >= 10 THEN 'alert' WHEN anomaly_pct >= 6 THEN 'warning' ELSE 'none' END AS alert
        FROM (SELECT count(*) AS records_scored, count_if(is_anomaly) AS anomalies,
          {pct('count_if(is_anomaly)', 'count(*)', 1)} AS anomaly_pct,
          {rd('avg(congestion_confidence) * 100', 1)} AS avg_confidence_pct,
          {rd('avg(predicted_speed)', 1)} AS avg_predicted_speed FROM traffic_pred_fx)""",
)
def a27(t):
    return reports.anomaly_rate(t.predicted)


@query(
    "a28_actual_vs_predicted",
    "SELECT congestion_level, predicted_congestion, count(*) AS n FROM traffic_pred_fx GROUP BY 1, 2",
)
def a28(t):
    return reports.actual_vs_predicted(t.predicted)


@query(
    "a29_data_signature",
    """SELECT *, substr(sha256(n || '|' || strftime(min_time, '%Y-%m-%dT%H:%M:%S.%f') || '|' ||
         strftime(max_time, '%Y-%m-%dT%H:%M:%S.%f')), 1, 16) AS signature
       FROM (SELECT count(*) AS n, min(processed_at) AS min_time, max(processed_at) AS max_time FROM traffic_fx)""",
)
def a29(t):
    return reports.data_signature(t.traffic)


@query(
    "a30_speed_trend",
    "SELECT window_start, borough, avg_speed, record_count FROM hourly_flat_fx WHERE avg_speed IS NOT NULL",
)
def a30(t):
    return reports.speed_trend(reports.flatten_hourly(t.hourly))


@query(
    "a31_overview_kpis",
    f"""SELECT count(*) AS total_records, coalesce({rd('avg(speed)', 1)}, 0.0::DOUBLE) AS avg_speed,
        (SELECT {rd('avg(quality_score)', 1)} FROM quality_fx) AS quality_score,
        (SELECT count_if(is_anomaly) FROM traffic_pred_fx) AS anomaly_count,
        count(*) > 0 AS stream_active FROM traffic_fx""",
)
def a31(t):
    return reports.overview_kpis(t.traffic, t.quality, t.predicted)


@query(
    "a32_quality_series",
    " UNION ALL ".join(
        f"SELECT batch_id, recorded_at, '{name}' AS series, cast({expr} AS DOUBLE) AS value FROM quality_fx"
        for name, expr in {
            "quality_score": "quality_score",
            "valid_records": "valid_records",
            "invalid_records": "total_records - valid_records",
        }.items()
    ),
)
def a32(t):
    return quality.quality_series(t.quality)


@query(
    "f14_failed_batches",
    """SELECT lineage_id, phase, processor, started_at, duration_ms, record_count, status, 'batch ' || status AS errors
       FROM lineage_fx WHERE status IN ('failed', 'partial') ORDER BY started_at DESC, lineage_id DESC LIMIT 20""",
)
def f14(t):
    return lineage.failed_entries(t.lineage).withColumn("errors", F.concat_ws("; ", "errors"))


@query(
    "l4_duration_trend",
    """SELECT started_at, phase, status, record_count, duration_ms / 1000.0::DOUBLE AS duration_sec FROM lineage_fx""",
)
def l4(t):
    return lineage.duration_trend(t.lineage)


@query("l4_throughput_trend", "SELECT started_at, phase, record_count FROM lineage_fx")
def l4_throughput(t):
    return lineage.throughput_trend(t.lineage)

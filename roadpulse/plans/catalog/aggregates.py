"""Aggregates, joins, upserts and the batch summaries."""

from pyspark.sql import functions as F

from roadpulse.operators import hourly, lineage, quality, reports, serving
from roadpulse.functions.casts import round_dec
from roadpulse.plans.catalog.core import query
from roadpulse.plans.fixtures import AS_OF
from roadpulse.plans.oracle import AS_OF as NOW
from roadpulse.plans.oracle import BOROUGHS, FLAGS, LEVELS, pct, rd
from roadpulse.schema import CONGESTION_LEVELS, QUALITY_FLAGS, UNKNOWN
from roadpulse.sources.sinks import merge_rows

_STATS = ["record_count", "avg_speed", "min_speed", "max_speed", "median_speed", "avg_travel_time"]


def _rounded(names, digits=6):
    return [round_dec(F.col(n), digits).alias(n) if n != "record_count" else F.col(n) for n in names]


def _rounded_sql(names, digits=6):
    return ", ".join(f"{rd(n, digits)} AS {n}" if n != "record_count" else n for n in names)


@query(
    "a1_hourly_borough_stats",
    f"SELECT window_start, borough, {_rounded_sql(_STATS)}, {rd('avg_congestion_score', 6)} AS avg_congestion_score FROM hourly_fx",
)
def a1(t):
    return t.hourly_stats.select("window_start", "borough", *_rounded(_STATS + ["avg_congestion_score"]))


@query("a2_level_distribution", f"SELECT window_start, borough, {', '.join(LEVELS[:4])} FROM hourly_fx")
def a2(t):
    return t.hourly_stats.select("window_start", "borough", *CONGESTION_LEVELS)


@query(
    "a3_level_percentages",
    "SELECT window_start, borough, "
    + ", ".join(f"{pct(n, 'record_count', 2)} AS pct_{n.lower()}" for n in LEVELS[:4])
    + " FROM hourly_fx",
)
def a3(t):
    shares = hourly.level_percentages()
    return t.hourly_stats.select("window_start", "borough", *[c.alias(f"pct_{n.lower()}") for n, c in shares.items()])


@query(
    "a4_hourly_table",
    f"""SELECT f.*, 'hourly_borough' AS aggregation_type, {', '.join(f'h.{n} AS n_{n.lower()}' for n in LEVELS[:4])},
        {NOW} AS computed_at FROM hourly_flat_fx f JOIN hourly_fx h USING (window_start, borough)""",
)
def a4(t):
    flat = reports.flatten_hourly(t.hourly).columns
    counts = F.col("congestion_distribution")
    stats = {f"{n}_speed": F.col(f"speed_stats.{n}") for n in ("avg", "min", "max", "median")}
    return t.hourly.select(
        *[stats.get(n, F.col(n)).alias(n) for n in flat],
        "aggregation_type",
        *[counts[n].alias(f"n_{n.lower()}") for n in CONGESTION_LEVELS],
        "computed_at",
    )


@query(
    "a5_network_summary",
    f"""SELECT {NOW} - INTERVAL 24 HOUR AS window_start, {NOW} AS window_end, count(*) AS total_records,
        {rd('avg(speed)', 2)} AS network_avg_speed, {rd('avg(congestion_score)', 4)} AS network_avg_congestion_score,
        {rd('avg(CASE WHEN is_peak_hour THEN 1 WHEN NOT is_peak_hour THEN 0 END) * 100', 2)} AS peak_hour_pct,
        {', '.join(f"count_if(congestion_level = '{n}') AS n_{n.lower()}" for n in LEVELS)},
        {', '.join(f"count_if(borough = '{n}') AS n_{n.lower().replace(' ', '_')}" for n in BOROUGHS + ('New Jersey',))}
        FROM traffic_fx WHERE processed_at >= {NOW} - INTERVAL 24 HOUR HAVING count(*) > 0""",
)
def a5(t):
    rows = serving.since(t.traffic, AS_OF, 24)
    start = F.lit(AS_OF).cast("timestamp") - F.expr("INTERVAL 24 HOURS")
    summary = hourly.network_summary(rows, start, AS_OF, AS_OF)

    def entry(column, name):
        return F.coalesce(F.try_element_at(column, F.lit(name)), F.lit(0)).alias(f"n_{name.lower().replace(' ', '_')}")

    return summary.select(
        "window_start", "window_end", "total_records", "network_avg_speed", "network_avg_congestion_score",
        "peak_hour_pct",
        *[entry("congestion_distribution", n) for n in LEVELS],
        *[entry("borough_record_counts", n) for n in BOROUGHS + ("New Jersey",)],
    )


@query(
    "a6_batch_quality",
    f"""SELECT count(*) AS total_records, count_if(speed IS NULL) AS null_speed, count_if(borough IS NULL) AS null_borough,
        count(*) - count_if(speed IS NULL) - count_if(borough IS NULL) AS valid_records,
        {pct('(count(*) - count_if(speed IS NULL) - count_if(borough IS NULL))', 'count(*)', 2)} AS quality_score,
        {', '.join(f'count_if(f_{n.lower()}) AS {n.lower()}' for n in FLAGS)} FROM traffic_fx""",
)
def a6(t):
    row = quality.batch_quality(t.traffic, "run", AS_OF)
    flags = F.col("quality_flags_distribution")
    return row.select(
        "total_records", "valid_records", "quality_score",
        F.col("null_counts")["speed"].alias("null_speed"), F.col("null_counts")["borough"].alias("null_borough"),
        *[F.coalesce(F.try_element_at(flags, F.lit(n)), F.lit(0)).alias(n.lower()) for n in QUALITY_FLAGS],
    )


@query("a7_stream_quality", "SELECT * FROM quality_fx")
def a7(t):
    def entry(column, name, prefix):
        value = F.coalesce(F.try_element_at(column, F.lit(name)), F.lit(0))
        return value.alias(prefix + name.lower().replace(" ", "_"))

    return t.quality.select(
        "batch_id", "source", "recorded_at", "total_records", "valid_records", "strict_valid_records", "quality_score",
        *[F.col("null_counts")[n].alias(f"null_{n}") for n in ("speed", "borough", "data_as_of")],
        *[F.col("anomalies")[n].alias(n) for n in ("zero_speed", "unknown_congestion")],
        *[entry("congestion_distribution", n, "n_") for n in CONGESTION_LEVELS + [UNKNOWN]],
        *[entry("quality_flags_distribution", n, "flag_") for n in QUALITY_FLAGS],
        *[entry("borough_distribution", n, "n_") for n in BOROUGHS + ("New Jersey",)],
    )


@query(
    "a8_flag_histogram",
    " UNION ALL ".join(f"SELECT '{n}' AS flag, count(*) AS n FROM traffic_fx WHERE f_{n.lower()} HAVING count(*) > 0" for n in FLAGS),
)
def a8(t):
    return quality.flag_histogram(t.traffic)


@query(
    "a9_offset_ranges",
    """SELECT 'partition_' || kafka_partition AS part, min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset,
       count(*) AS record_count FROM traffic_fx GROUP BY kafka_partition""",
)
def a9(t):
    row = lineage.offset_range_map(lineage.offset_ranges(t.traffic))
    return row.select(F.explode("offset_ranges").alias("part", "r")).select(
        "part", F.col("r.min").alias("min_offset"), F.col("r.max").alias("max_offset"), F.col("r.count").alias("record_count")
    )


@query(
    "a10_congestion_snapshot",
    f"""WITH newest AS (SELECT * FROM traffic_fx),
        lv AS (SELECT borough, congestion_level, count(*) AS n, max(processed_at) AS seen, max_by(record_id, (processed_at, record_id)) AS rid
          FROM newest WHERE borough IS NOT NULL GROUP BY 1, 2),
        dom AS (SELECT borough, congestion_level AS dominant_congestion FROM lv
          QUALIFY row_number() OVER (PARTITION BY borough ORDER BY n DESC, seen DESC, rid DESC) = 1)
        SELECT borough, coalesce({rd('avg(speed)', 2)}, 0.0::DOUBLE) AS avg_speed_mph, any_value(dominant_congestion) AS dominant_congestion,
          count(*) AS record_count, {pct("count_if(congestion_level IN ('CONGESTED','SEVERE'))", 'count(*)', 1)} AS pct_congested,
          max(processed_at) AS last_updated
        FROM newest JOIN dom USING (borough) GROUP BY borough""",
)
def a10(t):
    return serving.congestion_snapshot(t.traffic)


@query(
    "a11_baseline_stats",
    f"""SELECT coalesce({rd('avg(speed)', 1)}, 0.0::DOUBLE) AS avg_speed,
        {pct("count_if(congestion_level = 'SEVERE')", 'count(*)', 2)} AS severe_pct,
        {pct("count_if(congestion_level = 'FREE_FLOW')", 'count(*)', 2)} AS free_flow_pct, count(*) AS total_records
        FROM traffic_fx WHERE processed_at >= {NOW} - INTERVAL 7 DAY""",
)
def a11(t):
    return reports.baseline_stats(t.traffic, AS_OF)


_SUMMARY_SQL = f"""
WITH now AS (SELECT * FROM traffic_fx WHERE processed_at >= {NOW} - INTERVAL 6 HOUR),
base AS (SELECT {rd('avg(speed)', 1)} AS baseline_speed,
    {pct("count_if(congestion_level = 'SEVERE')", 'count(*)', 2)} AS baseline_severe_pct
  FROM traffic_fx WHERE processed_at >= {NOW} - INTERVAL 7 DAY),
cur AS (SELECT {rd('avg(speed)', 1)} AS avg_speed_now,
    {pct("count_if(congestion_level = 'SEVERE')", 'count(*)', 1)} AS severe_pct FROM now),
worst AS (SELECT borough AS worst_borough, {rd('avg(speed)', 1)} AS worst_speed FROM now
  WHERE borough IS NOT NULL AND speed IS NOT NULL GROUP BY borough ORDER BY avg(speed), borough LIMIT 1),
deltas AS (SELECT *, {rd('avg_speed_now - baseline_speed', 1)} AS delta_speed,
    {rd('(avg_speed_now - baseline_speed) / baseline_speed * 100', 1)} AS delta_pct,
    {rd('severe_pct - baseline_severe_pct', 1)} AS severe_delta FROM cur, base, worst)
SELECT *, CASE WHEN delta_pct < -5 THEN 'slower' WHEN delta_pct > 5 THEN 'faster' ELSE 'consistent' END AS verdict FROM deltas"""


@query("a12_executive_summary", _SUMMARY_SQL)
def a12(t):
    return reports.executive_summary(t.traffic, AS_OF, hours=6)


@query(
    "j2_current_vs_baseline",
    f"SELECT avg_speed_now, baseline_speed, delta_speed, delta_pct FROM ({_SUMMARY_SQL})",
)
def j2(t):
    return reports.current_vs_baseline(t.traffic, AS_OF, hours=6)


@query(
    "j1_stats_with_levels",
    f"SELECT window_start, borough, record_count, {rd('avg_speed', 6)} AS avg_speed, {', '.join(LEVELS[:4])} FROM hourly_fx",
)
def j1(t):
    rows = hourly.stats_with_levels(t.traffic)
    return rows.withColumn("avg_speed", round_dec(F.col("avg_speed"), 6))


def _health_sql(hours: float, as_of: str) -> str:
    return f"""
WITH win AS (SELECT count(*) AS records, max(processed_at) AS latest FROM traffic_fx
    WHERE processed_at >= {as_of} - INTERVAL {hours} HOUR),
dq AS (SELECT avg(quality_score) AS q FROM (SELECT quality_score FROM quality_fx ORDER BY recorded_at DESC, batch_id DESC LIMIT 5)),
x AS (SELECT records, q AS recent_quality,
    cast(greatest(0, floor((epoch_us({as_of}) - epoch_us(latest)) / 60000000.0::DOUBLE)) AS INTEGER) AS age, latest FROM win, dq)
SELECT records, {rd('recent_quality', 6)} AS recent_quality,
  CASE WHEN latest IS NOT NULL THEN age END AS data_age_minutes,
  CASE WHEN recent_quality < 80 OR (latest IS NOT NULL AND age >= 240) THEN 'CRITICAL'
    WHEN records = 0 OR (latest IS NOT NULL AND age > 60) OR recent_quality < 95 THEN 'DEGRADED' ELSE 'OPERATIONAL' END AS level,
  concat_ws('; ', CASE WHEN records = 0 THEN 'No records in current window' END,
    CASE WHEN latest IS NOT NULL AND age > 60 THEN 'No new data for ' || age || ' minutes' END,
    CASE WHEN recent_quality < 95 THEN 'Data quality at ' || printf('%.1f', {rd('recent_quality', 1)}) || '% (target >= 95%)' END) AS issues
FROM x"""


def _health(t, as_of, hours):
    rows = reports.health_status(serving.since(t.traffic, as_of, hours), t.quality, as_of)
    return rows.select(
        "records", round_dec(F.col("recent_quality"), 6).alias("recent_quality"), "data_age_minutes", "level",
        F.concat_ws("; ", "issues").alias("issues"),
    )


@query("a13_health_status", _health_sql(24, NOW))
def a13(t):
    return _health(t, AS_OF, 24)


@query("a13_health_status_stale", _health_sql(24, "TIMESTAMP '2024-01-31 02:30:00'"))
def a13_stale(t):
    return _health(t, "2024-01-31 02:30:00", 24)


@query("a13_health_status_empty", _health_sql(1, "TIMESTAMP '2024-02-05 00:00:00'"))
def a13_empty(t):
    return _health(t, "2024-02-05 00:00:00", 1)


@query(
    "a14_pipeline_health",
    f"""SELECT (SELECT count(*) FROM traffic_fx) AS total_processed_records, (SELECT count(*) FROM hourly_fx) AS total_aggregated_records,
        last_record_at, m AS minutes_since_last_record, CASE WHEN m IS NULL OR m > 10 THEN 'DEGRADED' ELSE 'HEALTHY' END AS status
        FROM (SELECT max(processed_at) AS last_record_at,
          {rd(f'(epoch_us({NOW}) - epoch_us(max(processed_at))) / 60000000.0::DOUBLE', 1)} AS m FROM traffic_fx)""",
)
def a14(t):
    return serving.pipeline_health(t.traffic, t.hourly, AS_OF).drop("pipeline_status")


@query(
    "s11_upsert_merge",
    f"""SELECT window_start, borough, record_count,
        CASE WHEN window_start >= {NOW} - INTERVAL 24 HOUR THEN 'new' ELSE 'old' END AS origin FROM hourly_fx
        WHERE window_start < {NOW} - INTERVAL 12 HOUR OR window_start >= {NOW} - INTERVAL 24 HOUR""",
)
def s11(t):
    rows = t.hourly.select("aggregation_type", "window_start", "borough", "record_count")
    half_day = F.lit(AS_OF).cast("timestamp") - F.expr("INTERVAL 12 HOURS")
    old = rows.where(F.col("window_start") < half_day).withColumn("origin", F.lit("old"))
    new = serving.since(rows, AS_OF, 24, "window_start").withColumn("origin", F.lit("new"))
    merged = merge_rows(old, new, ["aggregation_type", "window_start", "borough"])
    return merged.select("window_start", "borough", "record_count", "origin")


@query(
    "s12_quality_upsert",
    """SELECT batch_id, quality_score, 'new' AS origin FROM quality_fx""",
)
def s12(t):
    rows = t.quality.select("batch_id", "quality_score")
    old = rows.where(F.col("quality_score") < 98).withColumn("origin", F.lit("old"))
    return merge_rows(old, rows.withColumn("origin", F.lit("new")), ["batch_id"])


@query(
    "s14_lookback_scan",
    f"""SELECT record_id, borough, speed, congestion_level FROM traffic_fx WHERE processed_at >= {NOW} - INTERVAL 7 DAY""",
)
def s14(t):
    return serving.since(t.traffic, AS_OF, 24 * 7).select("record_id", "borough", "speed", "congestion_level")


@query(
    "u1_union_metrics",
    """SELECT batch_id, source, total_records, null_data_as_of FROM quality_fx WHERE source = 'spark_stream_processor'
       UNION ALL SELECT 'all', 'batch_processor', count(*), NULL FROM traffic_fx""",
)
def u1(t):
    stream = t.quality.where(F.col("source") == "spark_stream_processor").withColumn("kind", F.lit("stream"))
    rows = quality.union_metrics(stream, quality.batch_quality(t.traffic, "all", AS_OF))
    return rows.select(
        "batch_id", "source", "total_records",
        F.try_element_at("null_counts", F.lit("data_as_of")).alias("null_data_as_of"),
    )


@query(
    "l5_replay",
    """SELECT m."offset" AS kafka_offset, m."partition" AS kafka_partition, l.batch_id FROM messages_fx m
       JOIN (SELECT t.batch_id, kafka_partition, min(kafka_offset) AS lo, max(kafka_offset) AS hi FROM traffic_fx t
         JOIN lineage_fx e ON cast(t.batch_id AS VARCHAR) = e.batch_id WHERE e.status = 'failed' GROUP BY 1, 2) l ON m."partition" = l.kafka_partition AND m."offset" BETWEEN lo AND hi""",
)
def l5(t):
    failed = t.lineage.where(F.col("status") == "failed")
    rows = lineage.replay(t.messages, failed)
    return rows.select(
        F.col("offset").alias("kafka_offset"), F.col("partition").alias("kafka_partition"), F.col("batch_id").cast("bigint")
    )

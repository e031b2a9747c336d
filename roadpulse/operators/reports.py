"""Monitoring reports over readings, aggregates and scored rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.casts import percent, round_dec
from roadpulse.functions.keys import minutes_between
from roadpulse.functions.traffic import inside_map
from roadpulse.operators.quality import mean_of_latest
from roadpulse.schema import CONGESTION_LEVELS, DAY_LABELS, TIME_BUCKETS, UNKNOWN
from roadpulse.session import as_of_column, hours_before

OPERATIONAL, DEGRADED, CRITICAL = "OPERATIONAL", "DEGRADED", "CRITICAL"


def baseline_stats(df: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """Mean speed and shares of severe and free-flowing readings over the last days."""
    rows = df.where(F.col("processed_at") >= hours_before(as_of, 24 * days))
    total = F.count("*")
    return rows.agg(
        F.coalesce(round_dec(F.avg("speed"), 1), F.lit(0.0)).alias("avg_speed"),
        percent(F.count_if(F.col("congestion_level") == "SEVERE"), total, 2).alias("severe_pct"),
        percent(F.count_if(F.col("congestion_level") == "FREE_FLOW"), total, 2).alias("free_flow_pct"),
        total.alias("total_records"),
    )


def baseline_parts(df: DataFrame) -> DataFrame:
    """Sums per hour of processing that any longer baseline can be put together from."""
    return df.where(F.col("processed_at").isNotNull()).groupBy(F.date_trunc("hour", "processed_at").alias("window_start")).agg(
        F.count("*").alias("n"),
        F.count("speed").alias("n_speed"),
        F.sum("speed").alias("sum_speed"),
        F.count_if(F.col("congestion_level") == "SEVERE").alias("n_severe"),
        F.count_if(F.col("congestion_level") == "FREE_FLOW").alias("n_free_flow"),
    )


def baseline_from_parts(parts: DataFrame, as_of=None, days: int = 7, edge: DataFrame | None = None) -> DataFrame:
    """``baseline_stats`` out of stored sums, without its readings.

    The baseline begins inside an hour unless ``as_of`` is a whole one. ``edge`` (readings) is
    scanned for the rest of that first hour only; without it the baseline begins with the next
    whole hour.
    """
    start = hours_before(as_of, 24 * days)
    first = F.date_trunc("hour", start + F.expr("INTERVAL 1 HOUR") - F.expr("INTERVAL 1 MICROSECOND"))
    rows = parts.where(F.col("window_start") >= first).select("n", "n_speed", "sum_speed", "n_severe", "n_free_flow")
    if edge is not None:
        inside = edge.where((F.col("processed_at") >= start) & (F.col("processed_at") < first))
        rows = rows.unionByName(baseline_parts(inside).select(*rows.columns))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return rows.agg(
        F.coalesce(round_dec(F.try_divide(F.sum("sum_speed"), F.sum("n_speed")), 1), F.lit(0.0)).alias("avg_speed"),
        percent(F.coalesce(F.sum("n_severe"), F.lit(0)), total, 2).alias("severe_pct"),
        percent(F.coalesce(F.sum("n_free_flow"), F.lit(0)), total, 2).alias("free_flow_pct"),
        total.alias("total_records"),
    )


def executive_summary(df: DataFrame, as_of=None, hours: float = 1, days: int = 7) -> DataFrame:
    """Current window against the baseline, out of one pass over the longer of the two.

    Both windows are partial sums per borough of the same scan, so the comparison needs no
    join of two aggregates.
    """
    moment = F.col("processed_at")
    now = moment >= hours_before(as_of, hours)
    severe = F.col("congestion_level") == "SEVERE"
    per_borough = (
        df.where(moment >= hours_before(as_of, max(24 * days, hours)))
        .groupBy("borough")
        .agg(
            F.sum(F.when(now, F.col("speed"))).alias("now_sum"),
            F.count(F.when(now, F.col("speed"))).alias("now_n"),
            F.count_if(now).alias("now_rows"),
            F.count_if(now & severe).alias("now_severe"),
            F.sum("speed").alias("base_sum"),
            F.count("speed").alias("base_n"),
            F.count("*").alias("base_rows"),
            F.count_if(severe).alias("base_severe"),
        )
        .withColumn("borough_avg", F.try_divide("now_sum", "now_n"))
    )
    ranked = F.when(
        F.col("borough").isNotNull() & F.col("borough_avg").isNotNull(), F.struct("borough_avg", "borough")
    )
    totals = per_borough.agg(
        round_dec(F.try_divide(F.sum("now_sum"), F.sum("now_n")), 1).alias("avg_speed_now"),
        round_dec(F.try_divide(F.sum("base_sum"), F.sum("base_n")), 1).alias("baseline_speed"),
        F.min(ranked).alias("_slowest"),
        percent(F.sum("now_severe"), F.sum("now_rows"), 1).alias("severe_pct"),
        percent(F.sum("base_severe"), F.sum("base_rows"), 2).alias("baseline_severe_pct"),
        F.sum("now_rows").alias("_rows"),
    )
    current, base = F.col("avg_speed_now"), F.col("baseline_speed")
    comparable = (current != 0) & (base != 0)
    return (
        totals.where("_rows > 0")
        .withColumn("delta_speed", F.when(comparable, round_dec(current - base, 1)))
        .withColumn("delta_pct", F.when(comparable, round_dec((current - base) / base * 100, 1)))
        .withColumn("worst_borough", F.col("_slowest.borough"))
        .withColumn("worst_speed", round_dec(F.col("_slowest.borough_avg"), 1))
        .withColumn("severe_delta", round_dec(F.col("severe_pct") - F.col("baseline_severe_pct"), 1))
        .withColumn(
            "verdict",
            F.when(F.col("delta_pct") < -5, "slower").when(F.col("delta_pct") > 5, "faster").otherwise("consistent"),
        )
        .drop("_slowest", "_rows")
    )


def current_vs_baseline(df: DataFrame, as_of=None, hours: float = 1, days: int = 7) -> DataFrame:
    """The comparison of means alone."""
    return executive_summary(df, as_of, hours, days).select(
        "avg_speed_now", "baseline_speed", "delta_speed", "delta_pct"
    )


def health_status(df: DataFrame, metrics: DataFrame, as_of=None) -> DataFrame:
    """Level and issues from freshness, recent quality and emptiness of the window."""
    rows = df.agg(F.count("*").alias("records"), F.max("processed_at").alias("latest"))
    rows = rows.withColumn("recent_quality", mean_of_latest(metrics, 5).scalar())
    age = F.greatest(F.lit(0), F.floor(minutes_between(as_of_column(as_of), F.col("latest")))).cast("int")
    rows = rows.withColumn("data_age_minutes", F.when(F.col("latest").isNotNull(), age))
    minutes, quality = F.col("data_age_minutes"), F.col("recent_quality")
    empty, stale = F.col("records") == 0, minutes > 60
    low = quality < 95
    level = (
        F.when((quality < 80) | (minutes >= 240), CRITICAL)
        .when(empty | stale | low, DEGRADED)
        .otherwise(OPERATIONAL)
    )
    issues = F.array_compact(
        F.array(
            F.when(empty, "No records in current window"),
            F.when(stale, F.concat(F.lit("No new data for "), minutes.cast("string"), F.lit(" minutes"))),
            F.when(
                low,
                F.concat(
                    F.lit("Data quality at "), F.format_string("%.1f", round_dec(quality, 1)), F.lit("% (target >= 95%)")
                ),
            ),
        )
    )
    return rows.select(level.alias("level"), issues.alias("issues"), "data_age_minutes", "recent_quality", "records")


def level_counts(df: DataFrame) -> DataFrame:
    order = F.array(*[F.lit(name) for name in CONGESTION_LEVELS + [UNKNOWN]])
    return (
        df.where(F.col("congestion_level").isNotNull())
        .groupBy("congestion_level")
        .agg(F.count("*").alias("n"))
        .withColumn("position", F.array_position(order, F.col("congestion_level")))
        .orderBy("position")
    )


def borough_speeds(df: DataFrame) -> DataFrame:
    return (
        df.dropna(subset=["speed", "borough"])
        .groupBy("borough")
        .agg(F.avg("speed").alias("avg_speed"))
        .orderBy("avg_speed")
    )


def bucket_speeds(df: DataFrame) -> DataFrame:
    """Mean speed per time bucket in fixed order, null for a bucket without rows."""
    sums = df.dropna(subset=["speed", "time_bucket"]).agg(
        *[F.avg(F.when(F.col("time_bucket") == name, F.col("speed"))).alias(name) for name in TIME_BUCKETS]
    )
    rows = F.array(
        *[
            F.struct(F.lit(i + 1).alias("position"), F.lit(name).alias("time_bucket"), F.col(name).alias("avg_speed"))
            for i, name in enumerate(TIME_BUCKETS)
        ]
    )
    return sums.select(F.inline(rows))


def histogram(
    df: DataFrame,
    column: str,
    bins: int,
    low: float | None = None,
    high: float | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Counts per equal-width bin; the range comes from the data unless it is given.

    With a given range, values outside it are counted in bin -1 and in bin ``bins``.
    """
    rows = df.where(F.col(column).isNotNull())
    if low is None or high is None:
        lo, hi = rows.agg(F.min(column)).scalar(), rows.agg(F.max(column)).scalar()
        rows = rows.withColumn("_lo", lo).withColumn("_width", (hi - F.col("_lo")) / bins)
        place = F.floor(F.try_divide(F.col(column) - F.col("_lo"), F.col("_width")))
        place = F.least(F.lit(bins - 1), F.coalesce(place, F.lit(0)))
    else:
        place = F.floor((F.col(column) - low) / ((high - low) / bins))
        place = F.greatest(F.lit(-1), F.least(F.lit(bins), place))
    return rows.withColumn("bin", place.cast("int")).groupBy(*by, "bin").agg(F.count("*").alias("n"))


def speed_histogram(df: DataFrame, bins: int = 30, high: float = 210.0) -> DataFrame:
    return histogram(df, "speed", bins, 0.0, high, by=("congestion_level",))


def congestion_heatmap(df: DataFrame) -> DataFrame:
    """Mean score by hour and weekday, weekdays as labelled columns."""
    pivoted = (
        df.dropna(subset=["hour_of_day", "day_of_week", "congestion_score"])
        .groupBy("hour_of_day")
        .pivot("day_of_week", list(DAY_LABELS))
        .agg(F.avg("congestion_score"))
    )
    return pivoted.select("hour_of_day", *[F.col(str(day)).alias(label) for day, label in DAY_LABELS.items()]).orderBy(
        "hour_of_day"
    )


def flatten_hourly(hourly: DataFrame) -> DataFrame:
    """The nested speed statistics as plain numeric columns."""
    return hourly.select(
        "window_start",
        "borough",
        "record_count",
        *[F.col(f"speed_stats.{name}").try_cast("double").alias(f"{name}_speed") for name in ("avg", "min", "max", "median")],
        "avg_travel_time",
        "avg_congestion_score",
    )


def speed_trend(flat: DataFrame) -> DataFrame:
    """Speed and volume series per hour and borough."""
    return (
        flat.dropna(subset=["window_start", "avg_speed", "borough"])
        .select("window_start", "borough", "avg_speed", "record_count")
        .orderBy("window_start", "borough")
    )


def borough_performance(flat: DataFrame) -> DataFrame:
    measures = {
        "avg_speed": F.avg,
        "min_speed": F.min,
        "max_speed": F.max,
        "avg_congestion_score": F.avg,
        "avg_travel_time": F.avg,
    }
    present = [round_dec(fn(name), 2).alias(name) for name, fn in measures.items() if name in flat.columns]
    if "record_count" in flat.columns:
        present.append(F.sum("record_count").alias("total_records"))
    if not present:
        present = [F.count("*").alias("batches")]
    return flat.groupBy("borough").agg(*present)


def overview_kpis(df: DataFrame, metrics: DataFrame, scored: DataFrame, newest_n: int | None = None) -> DataFrame:
    """Overview row: volume, mean speed, quality, anomalies (among the newest ``newest_n`` scored rows if given)."""
    newest = scored
    if newest_n is not None:
        newest = scored.orderBy(F.col("processed_at").desc(), F.col("record_id").desc()).limit(newest_n)
    rows = df.agg(
        F.count("*").alias("total_records"),
        F.coalesce(round_dec(F.avg("speed"), 1), F.lit(0.0)).alias("avg_speed"),
    )
    return rows.select(
        "total_records",
        "avg_speed",
        F.coalesce(metrics.agg(round_dec(F.avg("quality_score"), 1)).scalar(), F.lit(0.0)).alias("quality_score"),
        newest.agg(F.count_if("is_anomaly")).scalar().alias("anomaly_count"),
        (F.col("total_records") > 0).alias("stream_active"),
    )


def anomaly_rate(scored: DataFrame) -> DataFrame:
    """Scored rows, flagged share and alert tier."""
    flagged = F.count_if("is_anomaly")
    rows = scored.agg(
        F.count("*").alias("records_scored"),
        flagged.alias("anomalies"),
        percent(flagged, F.count("*"), 1).alias("anomaly_pct"),
        round_dec(F.avg("congestion_confidence") * 100, 1).alias("avg_confidence_pct"),
        round_dec(F.avg("predicted_speed"), 1).alias("avg_predicted_speed"),
    )
    pct = F.col("anomaly_pct")
    return rows.withColumn("alert", F.when(pct >= 10, "alert").when(pct >= 6, "warning").otherwise("none"))


def actual_vs_predicted(scored: DataFrame) -> DataFrame:
    return (
        scored.dropna(subset=["congestion_level", "predicted_congestion"])
        .groupBy("congestion_level", "predicted_congestion")
        .agg(F.count("*").alias("n"))
    )


def pipeline_summary(df: DataFrame, aggregates: DataFrame, metrics: DataFrame) -> DataFrame:
    """Rows per stage and the newest quality score."""
    rows = metrics.agg(
        F.count_if(F.col("source") == "spark_stream_processor").alias("stream_batches_recorded"),
        F.count_if(F.col("source") == "batch_processor").alias("batch_jobs_recorded"),
        F.max_by("quality_score", F.struct("recorded_at", "batch_id")).alias("latest_quality_score"),
        F.max("recorded_at").alias("latest_recorded_at"),
    )
    return rows.withColumn("total_processed_records", df.agg(F.count("*")).scalar()).withColumn(
        "total_aggregations", aggregates.agg(F.count("*")).scalar()
    )


def data_signature(df: DataFrame, time: str = "processed_at") -> DataFrame:
    """Count, time range and a short digest of them."""
    rows = df.agg(F.count("*").alias("n"), F.min(time).alias("min_time"), F.max(time).alias("max_time"))
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    text = F.concat_ws(
        "|", F.col("n").cast("string"), F.date_format("min_time", stamp), F.date_format("max_time", stamp)
    )
    return rows.withColumn("signature", F.substring(F.sha2(text, 256), 1, 16))


def map_points(df: DataFrame) -> DataFrame:
    """Readings with a position inside the map area and a speed."""
    return df.dropna(subset=["latitude", "longitude", "speed"]).where(
        inside_map(F.col("latitude"), F.col("longitude"))
    )


def latest_per_link(df: DataFrame) -> DataFrame:
    """Newest reading of every link, as an aggregate that combines before the shuffle.

    A busy link is reduced in every task, where a ranking window would sort all of its
    readings in one.
    """
    row = F.struct(*df.columns)
    order = F.struct(F.col("processed_at"), F.col("record_id"))
    return df.groupBy(F.col("link_id").alias("_link")).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def seeded_sample(df: DataFrame, n: int = 1500, seed: int = 42, key: str = "link_id") -> DataFrame:
    """The same ``n`` rows on every run and layout: lowest hash of key and seed."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key), F.lit(seed))), key).limit(n)


def map_sample(df: DataFrame, n: int = 1500, seed: int = 42) -> DataFrame:
    """All map points while they are few, else the newest per link, else a sample of those."""
    points = map_points(df)
    few = points.limit(n + 1).count() <= n
    return points if few else seeded_sample(latest_per_link(points), n, seed)


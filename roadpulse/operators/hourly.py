"""Hourly statistics per borough and the network-wide summary."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.casts import percent, round_dec
from roadpulse.functions.quantiles import exact_percentiles
from roadpulse.schema import CONGESTION_LEVELS, HOURLY_BOROUGH, WINDOW_SUMMARY
from roadpulse.session import as_of_column, materialize

_KEYS = ["window_start", "borough"]


def with_window(df: DataFrame) -> DataFrame:
    """Adds the hour floor; the processing time stands in only where no event time column exists."""
    time = "data_as_of_parsed" if "data_as_of_parsed" in df.columns else "processed_at"
    return df.withColumn("window_start", F.date_trunc("hour", time)).where(
        F.col("window_start").isNotNull() & F.col("borough").isNotNull()
    )


def partial_measures() -> list[Column]:
    """Sums that can be merged further, per distinct speed of a group."""
    return [
        F.count("*").alias("n"),
        F.sum("travel_time").alias("sum_travel_time"),
        F.count("travel_time").alias("n_travel_time"),
        F.sum("congestion_score").alias("sum_score"),
        F.count("congestion_score").alias("n_score"),
        *[F.count_if(F.col("congestion_level") == level).alias(level) for level in CONGESTION_LEVELS],
    ]


def speed_counts(df: DataFrame) -> DataFrame:
    """One row per hour, borough and distinct speed.

    A borough that holds a third of all readings is spread over its speeds here, and
    everything after this step works on counts.
    """
    return with_window(df).groupBy(*_KEYS, "speed").agg(*partial_measures())


def stats_from_counts(counts: DataFrame, approx: bool = False) -> DataFrame:
    """Unrounded statistics per hour and borough out of ``speed_counts`` rows."""
    weighted = F.sum(F.col("speed") * F.when(F.col("speed").isNotNull(), F.col("n")))
    n_speed = F.sum(F.when(F.col("speed").isNotNull(), F.col("n")).otherwise(F.lit(0)))
    extra = []
    if approx:
        extra = [F.percentile_approx("speed", 0.5, 10000).alias("median_speed")]
    stats = counts.groupBy(*_KEYS).agg(
        n_speed.alias("record_count"),
        F.try_divide(weighted, n_speed).alias("avg_speed"),
        F.min("speed").alias("min_speed"),
        F.max("speed").alias("max_speed"),
        F.try_divide(F.sum("sum_travel_time"), F.sum("n_travel_time")).alias("avg_travel_time"),
        F.try_divide(F.sum("sum_score"), F.sum("n_score")).alias("avg_congestion_score"),
        *[F.sum(level).alias(level) for level in CONGESTION_LEVELS],
        *extra,
    )
    if approx:
        return stats
    speeds = counts.where(F.col("speed").isNotNull()).select(*_KEYS, "speed", "n")
    medians = exact_percentiles(speeds, _KEYS, "speed", {"median_speed": 0.5}, scales=(64.0,))
    return stats.join(medians, _KEYS, "left")


def hourly_stats(df: DataFrame) -> DataFrame:
    """Flat, unrounded hourly statistics: one source scan, one shuffle of the readings."""
    return stats_from_counts(materialize(speed_counts(df)))


def level_percentages() -> dict[str, Column]:
    return {
        level: percent(F.col(level), F.col("record_count"), 2) for level in CONGESTION_LEVELS
    }


def hourly_table(stats: DataFrame, computed_at=None) -> DataFrame:
    """Rounded and nested rows in the HOURLY_BOROUGH schema."""
    shares = level_percentages()
    speed_stats = F.struct(
        round_dec(F.col("avg_speed"), 2).alias("avg"),
        round_dec(F.col("min_speed"), 2).alias("min"),
        round_dec(F.col("max_speed"), 2).alias("max"),
        round_dec(F.col("median_speed"), 2).alias("median"),
    )
    counts = [part for level in CONGESTION_LEVELS for part in (F.lit(level), F.col(level))]
    pcts = [part for level in CONGESTION_LEVELS for part in (F.lit(level), shares[level])]
    return stats.select(
        F.lit("hourly_borough").alias("aggregation_type"),
        "window_start",
        "borough",
        F.col("record_count").cast("bigint").alias("record_count"),
        speed_stats.alias("speed_stats"),
        round_dec(F.col("avg_travel_time"), 2).alias("avg_travel_time"),
        round_dec(F.col("avg_congestion_score"), 4).alias("avg_congestion_score"),
        F.create_map(*counts).alias("congestion_distribution"),
        F.create_map(*pcts).alias("congestion_pct"),
        as_of_column(computed_at).alias("computed_at"),
    ).select(*HOURLY_BOROUGH.fieldNames())


def hourly_borough(df: DataFrame, computed_at=None) -> DataFrame:
    return hourly_table(hourly_stats(df), computed_at)


def count_map(grouped: DataFrame, key: str) -> DataFrame:
    """One-row frame with ``{key: n}`` out of already grouped counts, null keys dropped.

    The map is as large as the number of distinct keys, which is the result itself.
    """
    entries = F.collect_list(F.struct(F.col(key), F.col("n").cast("bigint")))
    return grouped.where(F.col(key).isNotNull()).agg(F.map_from_entries(entries).alias("m"))


def network_summary(df: DataFrame, window_start, window_end, computed_at=None) -> DataFrame:
    """One row over the whole window, none when it is empty."""
    counts = materialize(
        df.groupBy("borough", "congestion_level").agg(
            F.count("*").alias("n"),
            F.sum("speed").alias("sum_speed"),
            F.count("speed").alias("n_speed"),
            F.sum("congestion_score").alias("sum_score"),
            F.count("congestion_score").alias("n_score"),
            F.count_if("is_peak_hour").alias("n_peak"),
            F.count("is_peak_hour").alias("n_flagged"),
        )
    )

    def distribution(key: str) -> Column:
        grouped = counts.groupBy(key).agg(F.sum("n").alias("n"))
        return count_map(grouped, key).scalar()

    total = counts.agg(
        F.sum("n").alias("total_records"),
        round_dec(F.try_divide(F.sum("sum_speed"), F.sum("n_speed")), 2).alias("network_avg_speed"),
        round_dec(F.try_divide(F.sum("sum_score"), F.sum("n_score")), 4).alias(
            "network_avg_congestion_score"
        ),
        round_dec(F.try_divide(F.sum("n_peak") * 100.0, F.sum("n_flagged")), 2).alias("peak_hour_pct"),
    )
    return total.where("total_records > 0").select(
        F.lit("window_summary").alias("aggregation_type"),
        as_of_column(window_start).alias("window_start"),
        as_of_column(window_end).alias("window_end"),
        "total_records",
        "network_avg_speed",
        "network_avg_congestion_score",
        distribution("congestion_level").alias("congestion_distribution"),
        distribution("borough").alias("borough_record_counts"),
        "peak_hour_pct",
        as_of_column(computed_at).alias("computed_at"),
    ).select(*WINDOW_SUMMARY.fieldNames())


def level_counts_pivot(df: DataFrame) -> DataFrame:
    """Counts per level as columns, the separate side of ``stats_with_levels``."""
    return (
        with_window(df)
        .groupBy(*_KEYS)
        .pivot("congestion_level", CONGESTION_LEVELS)
        .agg(F.count(F.lit(1)))
        .fillna(0, CONGESTION_LEVELS)
    )


def stats_with_levels(df: DataFrame) -> DataFrame:
    """Join form of the hourly statistics: base measures left-joined with the pivot."""
    base = with_window(df).groupBy(*_KEYS).agg(
        F.count("speed").alias("record_count"), F.avg("speed").alias("avg_speed")
    )
    return base.join(level_counts_pivot(df), _KEYS, "left")


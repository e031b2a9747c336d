"""Data-quality metrics per batch and the monitoring queries over them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions.casts import percent, round_dec
from roadpulse.schema import BATCH_SOURCE, CONGESTION_LEVELS, QUALITY, QUALITY_FLAGS, STREAM_SOURCE, UNKNOWN
from roadpulse.session import as_of_column, hours_before

_LEVELS = CONGESTION_LEVELS + [UNKNOWN]


def _counts(*names: str, prefix: str = "_") -> Column:
    return F.create_map(*[part for name in names for part in (F.lit(name), F.col(f"{prefix}{name}"))])


def _positive_counts(names: list[str], prefix: str = "_") -> Column:
    return F.map_filter(_counts(*names, prefix=prefix), lambda _, n: n > 0)


def _measures(df: DataFrame) -> dict[str, Column]:
    flags = F.col("quality_flags") if "quality_flags" in df.columns else F.array().cast("array<string>")
    null_speed = F.col("speed").isNull()
    null_borough = F.col("borough").isNull()
    null_time = F.col("data_as_of_parsed").isNull()
    conditions = {
        "speed": null_speed,
        "borough_null": null_borough,
        "data_as_of": null_time,
        "zero_speed": F.col("speed") == 0,
        "unknown_congestion": F.col("congestion_level") == UNKNOWN,
        "strict": ~(null_speed | null_borough | null_time),
        **{f"flag_{flag}": F.array_contains(flags, flag) for flag in QUALITY_FLAGS},
        **{level: F.col("congestion_level") == level for level in _LEVELS},
    }
    return {f"_{name}": F.count_if(cond) for name, cond in conditions.items()}


def _quality_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """All counters in one pass; the second step only merges a row per borough name."""
    measures = _measures(df)
    per_borough = df.groupBy(*keys, "borough").agg(
        F.count("*").alias("_total"),
        F.max("processed_at").alias("_last"),
        *[expr.alias(name) for name, expr in measures.items()],
    )
    names = F.collect_list(F.when(F.col("borough") != "", F.struct("borough", F.col("_total"))))
    return per_borough.groupBy(*keys).agg(
        F.sum("_total").alias("total_records"),
        F.max("_last").alias("recorded_at"),
        F.map_from_entries(names).alias("borough_distribution"),
        *[F.sum(name).alias(name) for name in measures],
    )


def stream_quality(
    df: DataFrame, source: Column | None = None, keys: list[str] | None = None, recorded_at: Column | None = None
) -> DataFrame:
    """Quality row per batch: three null counts, anomalies and distributions."""
    keys = ["batch_id"] if keys is None else keys
    counted = _quality_counts(df, keys)
    total = F.col("total_records")
    valid = total - F.col("_speed") - F.col("_borough_null") - F.col("_data_as_of")
    nulls = F.create_map(
        F.lit("speed"), F.col("_speed"), F.lit("borough"), F.col("_borough_null"),
        F.lit("data_as_of"), F.col("_data_as_of"),
    )
    ident = F.col("batch_id").cast("string") if "batch_id" in keys else F.lit(None).cast("string")
    return counted.select(
        ident.alias("batch_id"),
        (F.lit(STREAM_SOURCE) if source is None else source).alias("source"),
        (F.col("recorded_at") if recorded_at is None else recorded_at).alias("recorded_at"),
        "total_records",
        valid.alias("valid_records"),
        F.col("_strict").alias("strict_valid_records"),
        percent(valid, total, 2).alias("quality_score"),
        nulls.alias("null_counts"),
        _counts("unknown_congestion", "zero_speed").alias("anomalies"),
        _positive_counts(QUALITY_FLAGS, "_flag_").alias("quality_flags_distribution"),
        _positive_counts(_LEVELS).alias("congestion_distribution"),
        "borough_distribution",
    ).select(*QUALITY.fieldNames())


def batch_quality(df: DataFrame, batch_id: str, recorded_at=None) -> DataFrame:
    """Quality row of a batch run: two null counts and the flag histogram."""
    counted = _quality_counts(df, []).where("total_records > 0")
    total = F.col("total_records")
    valid = total - F.col("_speed") - F.col("_borough_null")
    nulls = F.create_map(F.lit("speed"), F.col("_speed"), F.lit("borough"), F.col("_borough_null"))
    return counted.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(BATCH_SOURCE).alias("source"),
        as_of_column(recorded_at).alias("recorded_at"),
        "total_records",
        valid.alias("valid_records"),
        F.col("_strict").alias("strict_valid_records"),
        percent(valid, total, 2).alias("quality_score"),
        nulls.alias("null_counts"),
        _positive_counts(QUALITY_FLAGS, "_flag_").alias("quality_flags_distribution"),
    )


def flag_histogram(df: DataFrame) -> DataFrame:
    return (
        df.select(F.explode("quality_flags").alias("flag"))
        .groupBy("flag")
        .agg(F.count("*").alias("n"))
    )


def union_metrics(stream: DataFrame, batch: DataFrame) -> DataFrame:
    """Stream and batch rows in one table; columns only one side has become null."""
    return stream.unionByName(batch, allowMissingColumns=True)


def newest_metrics(metrics: DataFrame, limit: int | None = None) -> DataFrame:
    """Newest rows first; a page of them where ``limit`` is given."""
    ordered = metrics.orderBy(F.col("recorded_at").desc(), F.col("batch_id").desc())
    return ordered if limit is None else ordered.limit(limit)


def quality_metrics(metrics: DataFrame, as_of=None, hours: float = 24, page: int | None = None) -> DataFrame:
    """Rows of the window, oldest first; with ``page`` only those among the newest ``page`` rows of all."""
    rows = metrics if page is None else newest_metrics(metrics, page)
    return rows.where(F.col("recorded_at") >= hours_before(as_of, hours)).orderBy("recorded_at", "batch_id")


def recent_metrics(metrics: DataFrame, as_of=None, hours: float = 24) -> DataFrame:
    """All rows of the window."""
    return metrics.where(F.col("recorded_at") >= hours_before(as_of, hours))


def quality_trend(metrics: DataFrame, as_of=None, hours: float = 24) -> DataFrame:
    columns = ["recorded_at", "source", "quality_score", "total_records"]
    return recent_metrics(metrics, as_of, hours).select(*columns).dropna()


def latest_score(metrics: DataFrame, source: str | None = None) -> DataFrame:
    """Newest score of every source, or of one."""
    rows = metrics if source is None else metrics.where(F.col("source") == source)
    return rows.groupBy("source").agg(
        F.max_by("quality_score", F.struct("recorded_at", "batch_id")).alias("quality_score")
    )


def mean_of_latest(metrics: DataFrame, n: int = 5) -> DataFrame:
    return newest_metrics(metrics, n).agg(F.avg("quality_score").alias("recent_quality"))


def map_totals(metrics: DataFrame, column: str) -> DataFrame:
    """Sum of a map column by key."""
    return (
        metrics.select(F.explode(column).alias("key", "n")).groupBy("key").agg(F.sum("n").alias("total"))
    )


def anomaly_summary(metrics: DataFrame, as_of=None, hours: float = 24) -> DataFrame:
    """Totals of anomalies and of null fields over the recent metrics, in long form."""
    recent = recent_metrics(metrics, as_of, hours)
    parts = [
        map_totals(recent, column).select(F.lit(column).alias("kind"), "key", "total")
        for column in ("anomalies", "null_counts")
    ]
    return parts[0].unionByName(parts[1])


def quality_kpis(metrics: DataFrame) -> DataFrame:
    total, valid = F.sum("total_records"), F.sum("valid_records")
    return metrics.agg(
        round_dec(F.avg("quality_score"), 2).alias("avg_quality_score"),
        round_dec(F.min("quality_score"), 2).alias("min_quality_score"),
        total.alias("total_records"),
        valid.alias("valid_records"),
        percent(valid, total, 1).alias("valid_pct"),
    )


def with_invalid(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("invalid_records", F.col("total_records") - F.col("valid_records"))


def quality_series(metrics: DataFrame) -> DataFrame:
    """Score, valid and invalid counts over time, in long form."""
    rows = with_invalid(metrics).where(F.col("recorded_at").isNotNull())
    return rows.select(
        "batch_id",
        "recorded_at",
        F.stack(
            F.lit(3),
            F.lit("quality_score"), F.col("quality_score"),
            F.lit("valid_records"), F.col("valid_records").cast("double"),
            F.lit("invalid_records"), F.col("invalid_records").cast("double"),
        ).alias("series", "value"),
    )


def null_counts_by_batch(metrics: DataFrame, limit: int = 20) -> DataFrame:
    """Null counts of the newest batches as columns, numbered from the oldest of them."""
    newest = newest_metrics(metrics.where(F.col("null_counts").isNotNull()), limit)
    # At most ``limit`` rows reach this window.
    order = Window.partitionBy(F.lit(0)).orderBy("recorded_at", "batch_id")
    return newest.select(
        F.row_number().over(order).alias("batch"),
        "batch_id",
        *[F.col("null_counts")[name].alias(f"null_{name}") for name in ("speed", "borough", "data_as_of")],
    )


def storage_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        frame.agg(F.count("*").alias("document_count")).select(F.lit(name).alias("collection"), "document_count")
        for name, frame in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result

"""Model quality as aggregates over rows with actual and predicted values."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.casts import round_dec
from roadpulse.functions.quantiles import exact_percentiles, value_counts
from roadpulse.operators.reports import histogram
from roadpulse.schema import CONGESTION_LEVELS
from roadpulse.session import materialize

TARGET_ACCURACY = 0.75


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where nothing was predicted or present.

    Every pair counts once for its actual and once for its predicted class, so all numbers
    follow from one table of pair counts.
    """
    pairs = confusion_counts(df, actual, predicted)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0)).cast("bigint")
    none, n = F.lit(0).cast("bigint"), F.col("n")
    both = F.stack(F.lit(2), F.col("actual"), n, none, hit, F.col("predicted"), none, n, none)
    sides = pairs.select(both.alias("label", "support", "claimed", "hits"))
    per_class = sides.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hits").alias("hits")
    )
    precision = F.coalesce(F.try_divide("hits", "claimed"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("hits"), F.col("claimed") + F.col("support")), F.lit(0.0))
    return per_class.select(
        "label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support", "hits"
    )


def classification_summary(report: DataFrame) -> DataFrame:
    """Accuracy and support-weighted F1 over the whole report."""
    total = F.sum("support")
    return report.agg(
        F.try_divide(F.sum("hits"), total).alias("accuracy"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), total).alias("weighted_f1"),
        total.alias("samples"),
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: list[str] | None = None) -> DataFrame:
    """Rows are actual, columns predicted classes."""
    labels = CONGESTION_LEVELS if labels is None else labels
    return (
        df.groupBy(F.col(actual).alias("actual"))
        .pivot(predicted, labels)
        .agg(F.count(F.lit(1)))
        .fillna(0, labels)
    )


def residuals(df: DataFrame, actual: str = "speed", predicted: str = "predicted_speed") -> DataFrame:
    rows = df.dropna(subset=[actual, predicted])
    return rows.withColumn("residual", F.col(actual) - F.col(predicted))


def regression_report(df: DataFrame, actual: str = "speed", predicted: str = "predicted_speed") -> DataFrame:
    """Error measures and residual diagnostics in one row."""
    rows = residuals(df, actual, predicted)
    squared = F.avg(F.col("residual") * F.col("residual"))
    totals = rows.agg(
        F.avg(F.abs("residual")).alias("mae"),
        F.sqrt(squared).alias("rmse"),
        (1 - F.try_divide(squared, F.var_pop(actual))).alias("r2"),
        F.avg("residual").alias("residual_mean"),
        F.stddev_pop("residual").alias("residual_std"),
        F.min("residual").alias("residual_min"),
        F.max("residual").alias("residual_max"),
        F.count("*").alias("samples"),
    )
    counts = materialize(value_counts(rows.withColumn("_all", F.lit(0)), ["_all"], "residual"))
    spread = exact_percentiles(
        counts, ["_all"], "residual", {"residual_p5": 0.05, "residual_median": 0.5, "residual_p95": 0.95}
    )
    names = ["residual_p5", "residual_median", "residual_p95"]
    return totals.withColumn("_spread", spread.select(F.struct(*names)).scalar()).select(*totals.columns, *[F.col(f"_spread.{name}") for name in names])


def speed_tier(speed: Column) -> Column:
    """Congestion tier of a plausible speed, null outside [0, 200)."""
    return (
        F.when((speed < 0) | (speed >= 200), F.lit(None).cast("string"))
        .when(speed < 5, "SEVERE")
        .when(speed < 15, "CONGESTED")
        .when(speed < 35, "MODERATE")
        .when(speed < 200, "FREE_FLOW")
    )


def tier_accuracy(df: DataFrame, actual: str = "speed", predicted: str = "predicted_speed") -> DataFrame:
    """Share of rows whose predicted speed falls in the tier of the actual one."""
    tiers = df.select(speed_tier(F.col(actual)).alias("a"), speed_tier(F.col(predicted)).alias("p")).dropna()
    return tiers.agg(
        F.try_divide(F.count_if(F.col("a") == F.col("p")), F.count("*")).alias("tier_accuracy"),
        F.count("*").alias("samples"),
    )


def anomaly_report(df: DataFrame, score: str = "anomaly_score", flag: str = "is_anomaly") -> DataFrame:
    """Rate, score statistics and separation of normal and anomalous rows."""
    value, flagged = F.col(score), F.col(flag)
    normal, anomalous = F.avg(F.when(~flagged, value)), F.avg(F.when(flagged, value))
    return df.agg(
        F.try_divide(F.count_if(flagged), F.count("*")).alias("anomaly_rate"),
        F.count_if(flagged).alias("anomalies"),
        F.count("*").alias("samples"),
        F.avg(value).alias("score_mean"),
        F.stddev_pop(value).alias("score_std"),
        normal.alias("normal_mean"),
        anomalous.alias("anomalous_mean"),
        (normal - anomalous).alias("separation"),
    )


def contributions(df: DataFrame, importances: dict[str, float], key: str = "record_id") -> DataFrame:
    """Value, importance and contribution of every feature of every row, in long form."""
    parts = [
        part
        for name, weight in importances.items()
        for part in (F.lit(name), F.col(name).cast("double"), F.lit(float(weight)), F.lit(abs(weight) * 100.0))
    ]
    return df.select(
        key, F.stack(F.lit(len(importances)), *parts).alias("feature", "value", "importance", "contribution")
    )


def calibration_bins(
    df: DataFrame, bins: int = 10, actual: str = "speed", predicted: str = "predicted_speed"
) -> DataFrame:
    """Mean predicted and actual value per equal-width, right-closed bin of the prediction."""
    rows = df.dropna(subset=[actual, predicted])
    low, high = rows.agg(F.min(predicted)).scalar(), rows.agg(F.max(predicted)).scalar()
    ranged = rows.withColumn("_low", low).withColumn("_width", (high - F.col("_low")) / bins)
    place = F.ceil(F.try_divide(F.col(predicted) - F.col("_low"), F.col("_width")))
    place = F.least(F.lit(bins), F.greatest(F.lit(1), F.coalesce(place, F.lit(1)))).cast("int")
    return (
        ranged.withColumn("bin", place)
        .groupBy("bin")
        .agg(
            F.avg(predicted).alias("predicted_mean"), F.avg(actual).alias("actual_mean"), F.count("*").alias("n")
        )
    )


def live_residual_stats(df: DataFrame) -> DataFrame:
    return residuals(df).agg(
        F.avg(F.abs("residual")).alias("mae"),
        F.avg("residual").alias("bias"),
        F.max(F.abs("residual")).alias("max_abs_error"),
    )


def residual_histogram(df: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(residuals(df), "residual", bins)


def anomaly_score_histogram(df: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(df, "anomaly_score", bins, by=("is_anomaly",))


def speed_pairs(df: DataFrame) -> DataFrame:
    """Actual and predicted speeds with the common axis maximum."""
    rows = df.dropna(subset=["speed", "predicted_speed"])
    highest = rows.agg(F.greatest(F.max("speed"), F.max("predicted_speed"))).scalar()
    return rows.select("record_id", "speed", "predicted_speed", "congestion_level").withColumn("axis_max", highest)


def evaluation_report(scored: DataFrame) -> DataFrame:
    """All results as ``section, metric, value``, with 1/0 for passing the accuracy target."""
    known = scored.where(F.col("congestion_level").isin(CONGESTION_LEVELS))
    report = materialize(classification_report(known, "congestion_level", "predicted_congestion"))
    summary = classification_summary(report)
    passed = summary.select(
        F.lit("classifier").alias("section"),
        F.lit("passed").alias("metric"),
        (F.col("accuracy") >= TARGET_ACCURACY).cast("double").alias("value"),
    )

    def long(frame: DataFrame, section: str) -> DataFrame:
        pairs = [part for c in frame.columns for part in (F.lit(c), F.col(c).cast("double"))]
        stacked = F.stack(F.lit(len(frame.columns)), *pairs).alias("metric", "value")
        return frame.select(F.lit(section).alias("section"), stacked)

    per_class = report.select(
        F.concat(F.lit("class_"), F.lower("label")).alias("section"),
        F.stack(
            F.lit(4),
            *[part for c in ("precision", "recall", "f1", "support") for part in (F.lit(c), F.col(c).cast("double"))],
        ).alias("metric", "value"),
    )
    parts = [
        long(summary, "classifier"),
        passed,
        per_class,
        long(regression_report(scored), "regressor"),
        long(tier_accuracy(scored).drop("samples"), "regressor"),
        long(anomaly_report(scored), "anomaly"),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumn("value", round_dec(F.col("value"), 4))

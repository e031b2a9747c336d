"""Feature tables: types, encoding, imputation, weights and time-ordered splits."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.ordering import with_segment
from roadpulse.functions.quantiles import exact_percentiles, value_counts
from roadpulse.functions.traffic import encode_borough, encode_level
from roadpulse.session import materialize

# The causal set leaves out speed and travel time, which the label derives from.
CAUSAL_FEATURES = [
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_peak_hour",
    "borough_encoded",
    "latitude",
    "longitude",
]
ANOMALY_FEATURES = ["speed", "travel_time"] + CAUSAL_FEATURES
_BOOLEANS = ["is_weekend", "is_peak_hour"]


def feature_columns(df: DataFrame) -> dict[str, Column]:
    """Every feature as a number: flags as 0/1 with null as 0, other nulls kept for the imputer.

    A column that ``df`` lacks, as live readings may, counts as null.
    """

    def source(name: str, kind: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast(kind)

    found: dict[str, Column] = {}
    for name in ANOMALY_FEATURES:
        if name == "borough_encoded":
            found[name] = encode_borough(source("borough", "string"))
        elif name in _BOOLEANS:
            found[name] = F.coalesce(source(name, "boolean").cast("boolean"), F.lit(False)).cast("int")
        else:
            found[name] = source(name, "double").try_cast("double")
    return found


def coerce_types(df: DataFrame) -> DataFrame:
    """The feature columns that ``df`` has, converted in place, and the borough code."""
    present = {c: expr for c, expr in feature_columns(df).items() if c in df.columns or c == "borough_encoded"}
    return df.withColumns(present)


def record_features(df: DataFrame) -> DataFrame:
    """The same transform for rows that may lack columns."""
    return df.withColumns(feature_columns(df))


def training_rows(df: DataFrame, time: str = "processed_at") -> DataFrame:
    """Rows with a time, a known borough, a speed and a known level; adds ``label``."""
    return (
        coerce_types(df)
        .withColumn("label", encode_level(F.col("congestion_level")))
        .where(F.col(time).isNotNull())
        .where(F.col("borough_encoded") >= 0)
        .where(F.col("speed").isNotNull())
        .where(F.col("label") >= 0)
    )


def build_x(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"feature columns missing: {missing}")
    return df.select(*columns)


def feature_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact median per feature, as rows of ``feature`` and ``median``."""
    build_x(df, columns)
    pairs = [part for c in columns for part in (F.lit(c), F.col(c).cast("double"))]
    long = df.select(F.stack(F.lit(len(columns)), *pairs).alias("feature", "value"))
    counts = materialize(value_counts(long, ["feature"], "value"))
    return exact_percentiles(counts, ["feature"], "value", {"median": 0.5})


def fit_imputer(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Medians of the training rows; a feature without any value is filled with 0."""
    found = {row["feature"]: row["median"] for row in feature_medians(df, columns).collect()}
    return {c: found.get(c, 0.0) for c in columns}


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()})


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``n / (k * n_class)`` per class, k being the number of classes present."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_class"))
    totals = counts.agg(F.struct(F.sum("n_class").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
    weight = F.col("_totals.n") / (F.col("_totals.k") * F.col("n_class"))
    return counts.withColumn("_totals", totals).select(label, "n_class", weight.alias("weight"))


def with_class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``weight``, balanced over the training rows where there is a split.

    There are at most as many weights as congestion levels; a level without training rows gets 1.
    """
    training = df.where("split = 0") if "split" in df.columns else df
    weights = class_weights(training, label).select(label, "weight")
    return df.join(F.broadcast(weights), label, "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))


def with_split(
    df: DataFrame,
    time: str = "processed_at",
    tie: str = "record_id",
    train: float = 0.70,
    val: float = 0.15,
) -> DataFrame:
    """Adds ``split``: 0 train, 1 validation, 2 test, in time order and without shuffling."""
    if time not in df.columns:
        raise ValueError(f"no time column {time}")
    total = df.count()
    n_train, n_val = int(total * train), int(total * val)
    return with_segment(df, time, tie, [n_train, n_train + n_val], total, "split")


def temporal_split(df: DataFrame, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = with_split(df, **options)
    return tuple(rows.where(F.col("split") == part).drop("split") for part in (0, 1, 2))


def with_folds(df: DataFrame, folds: int = 5, time: str = "processed_at", tie: str = "record_id") -> DataFrame:
    """Adds ``fold``: fold k is tested on its own rows and trained on all with a lower number."""
    total = df.count()
    size = total // (folds + 1)
    if size == 0:
        raise ValueError(f"{total} rows are too few for {folds} folds")
    starts = [total - (folds - k) * size for k in range(folds)]
    return with_segment(df, time, tie, starts, total, "fold")

"""Feature, split and evaluation queries."""

from pyspark.sql import functions as F

from roadpulse.functions.casts import round_dec
from roadpulse.ml import evaluate, features
from roadpulse.plans.catalog.core import query
from roadpulse.plans.oracle import LEVELS, borough_code, level_code, rd

_TRAINING = f"""(SELECT *, {borough_code('borough')} AS borough_encoded, {level_code('congestion_level')} AS label
  FROM traffic_fx WHERE processed_at IS NOT NULL AND speed IS NOT NULL
  AND {borough_code('borough')} >= 0 AND {level_code('congestion_level')} >= 0)"""


def _r(*names, digits=6):
    return [round_dec(F.col(n), digits).alias(n) for n in names]


@query(
    "c14_coerce_types",
    f"""SELECT record_id, cast(coalesce(is_weekend, false) AS INTEGER) AS is_weekend,
        cast(coalesce(is_peak_hour, false) AS INTEGER) AS is_peak_hour, cast(travel_time AS DOUBLE) AS travel_time,
        cast(hour_of_day AS DOUBLE) AS hour_of_day, latitude, {borough_code('borough')} AS borough_encoded FROM traffic_fx""",
)
def c14(t):
    return features.coerce_types(t.traffic).select(
        "record_id", "is_weekend", "is_peak_hour", "travel_time", "hour_of_day", "latitude", "borough_encoded"
    )


@query(
    "c15_record_features",
    f"""SELECT record_id, 0 AS is_weekend, 0 AS is_peak_hour, speed, CAST(NULL AS DOUBLE) AS latitude,
        {borough_code('borough')} AS borough_encoded FROM traffic_fx""",
)
def c15(t):
    rows = features.record_features(t.traffic.select("record_id", "borough", "speed"))
    return rows.select("record_id", "is_weekend", "is_peak_hour", "speed", "latitude", "borough_encoded")


@query("f12_training_rows", f"SELECT record_id, label, borough_encoded, speed FROM {_TRAINING}")
def f12(t):
    return features.training_rows(t.traffic).select("record_id", "label", "borough_encoded", "speed")


@query(
    "f15_feature_projection",
    f"""SELECT cast(hour_of_day AS DOUBLE) AS hour_of_day, cast(day_of_week AS DOUBLE) AS day_of_week,
        cast(coalesce(is_weekend, false) AS INTEGER) AS is_weekend, cast(coalesce(is_peak_hour, false) AS INTEGER) AS is_peak_hour,
        {borough_code('borough')} AS borough_encoded, latitude, longitude FROM traffic_fx""",
)
def f15(t):
    return features.build_x(features.coerce_types(t.traffic), features.CAUSAL_FEATURES)


_MEDIANS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {rd(f'median(cast({x} AS DOUBLE))', 6)} AS median FROM {_TRAINING}"
    for c, x in {
        **{c: c for c in features.ANOMALY_FEATURES},
        "is_weekend": "cast(coalesce(is_weekend, false) AS INTEGER)",
        "is_peak_hour": "cast(coalesce(is_peak_hour, false) AS INTEGER)",
    }.items()
)


@query("m1_imputer_medians", _MEDIANS)
def m1(t):
    rows = features.feature_medians(features.training_rows(t.traffic), features.ANOMALY_FEATURES)
    return rows.select("feature", round_dec(F.col("median"), 6).alias("median"))


@query(
    "m1_imputed_rows",
    f"""SELECT record_id, {rd('coalesce(latitude, (SELECT median(latitude) FROM ' + _TRAINING + '))', 6)} AS latitude,
        {rd('coalesce(cast(hour_of_day AS DOUBLE), (SELECT median(cast(hour_of_day AS DOUBLE)) FROM ' + _TRAINING + '))', 6)} AS hour_of_day
        FROM {_TRAINING}""",
)
def m1_rows(t):
    rows = features.training_rows(t.traffic)
    medians = features.fit_imputer(rows, features.CAUSAL_FEATURES)
    return features.impute(rows, medians).select("record_id", *_r("latitude", "hour_of_day"))


@query(
    "m2_feature_sets",
    f"""SELECT record_id, speed, cast(travel_time AS DOUBLE) AS travel_time, cast(hour_of_day AS DOUBLE) AS hour_of_day,
        cast(day_of_week AS DOUBLE) AS day_of_week, cast(coalesce(is_weekend, false) AS INTEGER) AS is_weekend,
        cast(coalesce(is_peak_hour, false) AS INTEGER) AS is_peak_hour, borough_encoded, latitude, longitude FROM {_TRAINING}""",
)
def m2(t):
    return features.build_x(features.training_rows(t.traffic), ["record_id"] + features.ANOMALY_FEATURES)


@query(
    "m3_class_weights",
    f"""SELECT label, n_class, {rd('(sum(n_class) OVER ()) / ((count(*) OVER ()) * n_class)::DOUBLE', 6)} AS weight
        FROM (SELECT label, count(*) AS n_class FROM {_TRAINING} GROUP BY label)""",
)
def m3(t):
    rows = features.class_weights(features.training_rows(t.traffic))
    return rows.select("label", "n_class", *_r("weight"))


ORDERED = f"""(SELECT record_id, row_number() OVER (ORDER BY processed_at, record_id) - 1 AS rn, count(*) OVER () AS n FROM {_TRAINING})"""


@query(
    "w4_temporal_split",
    f"""SELECT record_id, CASE WHEN rn < floor(n * 0.70::DOUBLE) THEN 0
        WHEN rn < floor(n * 0.70::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 1 ELSE 2 END AS split FROM {ORDERED}""",
)
def w4(t):
    return features.with_split(features.training_rows(t.traffic)).select("record_id", "split")


@query(
    "w5_expanding_folds",
    f"""SELECT record_id, cast(greatest(0, 5 - floor((n - 1 - rn) / (n // 6)::DOUBLE)) AS INTEGER) AS fold FROM {ORDERED}""",
)
def w5(t):
    return features.with_folds(features.training_rows(t.traffic)).select("record_id", "fold")


_KNOWN = "(SELECT * FROM traffic_pred_fx WHERE congestion_level <> 'UNKNOWN')"
_REPORT = f"""(SELECT l.label, count_if(congestion_level = l.label) AS support, count_if(predicted_congestion = l.label) AS claimed,
    count_if(congestion_level = l.label AND predicted_congestion = l.label) AS hits
  FROM {_KNOWN} p, (SELECT unnest(['FREE_FLOW','MODERATE','CONGESTED','SEVERE']) AS label) l GROUP BY l.label)"""
_PRECISION = "coalesce(hits / nullif(claimed, 0)::DOUBLE, 0.0)"
_RECALL = "coalesce(hits / nullif(support, 0)::DOUBLE, 0.0)"
_F1 = "coalesce(2 * hits / nullif(claimed + support, 0)::DOUBLE, 0.0)"


def _known(t):
    return t.predicted.where(F.col("congestion_level") != "UNKNOWN")


@query(
    "m8_classification_report",
    f"""SELECT label, {rd(_PRECISION, 6)} AS precision, {rd(_RECALL, 6)} AS recall, {rd(_F1, 6)} AS f1, support FROM {_REPORT}""",
)
def m8(t):
    rows = evaluate.classification_report(_known(t), "congestion_level", "predicted_congestion")
    return rows.select("label", *_r("precision", "recall", "f1"), "support")


@query(
    "m8_classification_summary",
    f"""SELECT {rd('sum(hits) / sum(support)::DOUBLE', 6)} AS accuracy,
        {rd(f'sum({_F1} * support) / sum(support)::DOUBLE', 6)} AS weighted_f1, cast(sum(support) AS BIGINT) AS samples FROM {_REPORT}""",
)
def m8_summary(t):
    report = evaluate.classification_report(_known(t), "congestion_level", "predicted_congestion")
    return evaluate.classification_summary(report).select(*_r("accuracy", "weighted_f1"), "samples")


@query(
    "m9_confusion_matrix",
    "SELECT congestion_level AS actual, "
    + ", ".join(f"count_if(predicted_congestion = '{n}') AS {n}" for n in LEVELS[:4])
    + f" FROM {_KNOWN} GROUP BY 1",
)
def m9(t):
    return evaluate.confusion_matrix(_known(t), "congestion_level", "predicted_congestion")


_RES = "(SELECT *, speed - predicted_speed AS residual FROM traffic_pred_fx WHERE speed IS NOT NULL AND predicted_speed IS NOT NULL)"
_REGRESSION = {
    "mae": "avg(abs(residual))",
    "rmse": "sqrt(avg(residual * residual))",
    "r2": "1 - avg(residual * residual) / var_pop(speed)",
    "residual_mean": "avg(residual)",
    "residual_std": "stddev_pop(residual)",
    "residual_min": "min(residual)",
    "residual_max": "max(residual)",
    "residual_p5": "quantile_cont(residual, 0.05)",
    "residual_median": "quantile_cont(residual, 0.5)",
    "residual_p95": "quantile_cont(residual, 0.95)",
}


@query(
    "m10_regression_report",
    f"SELECT {', '.join(f'{rd(x, 6)} AS {n}' for n, x in _REGRESSION.items())}, count(*) AS samples FROM {_RES}",
)
def m10(t):
    return evaluate.regression_report(t.predicted).select(*_r(*_REGRESSION), "samples")


def _tier(x):
    return (
        f"CASE WHEN {x} >= 0 AND {x} < 5 THEN 1 WHEN {x} >= 5 AND {x} < 15 THEN 2 "
        f"WHEN {x} >= 15 AND {x} < 35 THEN 3 WHEN {x} >= 35 AND {x} < 200 THEN 4 END"
    )


@query(
    "m11_tier_accuracy",
    f"""SELECT {rd('count_if(a = p) / count(*)::DOUBLE', 6)} AS tier_accuracy, count(*) AS samples
        FROM (SELECT {_tier('speed')} AS a, {_tier('predicted_speed')} AS p FROM traffic_pred_fx)
        WHERE a IS NOT NULL AND p IS NOT NULL""",
)
def m11(t):
    return evaluate.tier_accuracy(t.predicted).select(*_r("tier_accuracy"), "samples")


_ANOMALY = {
    "anomaly_rate": "count_if(is_anomaly) / count(*)::DOUBLE",
    "score_mean": "avg(anomaly_score)",
    "score_std": "stddev_pop(anomaly_score)",
    "normal_mean": "avg(CASE WHEN NOT is_anomaly THEN anomaly_score END)",
    "anomalous_mean": "avg(CASE WHEN is_anomaly THEN anomaly_score END)",
    "separation": "avg(CASE WHEN NOT is_anomaly THEN anomaly_score END) - avg(CASE WHEN is_anomaly THEN anomaly_score END)",
}


@query(
    "m12_anomaly_report",
    f"""SELECT {', '.join(f'{rd(x, 6)} AS {n}' for n, x in _ANOMALY.items())}, count_if(is_anomaly) AS anomalies,
        count(*) AS samples FROM traffic_pred_fx""",
)
def m12(t):
    return evaluate.anomaly_report(t.predicted).select(*_r(*_ANOMALY), "anomalies", "samples")


_IMPORTANCES = {"hour_of_day": 0.4, "borough_encoded": 0.35, "latitude": 0.25}


@query(
    "m16_contributions",
    " UNION ALL ".join(
        f"""SELECT record_id, '{n}' AS feature, cast({borough_code('borough') if n == 'borough_encoded' else n} AS DOUBLE) AS value,
            {w}::DOUBLE AS importance, {w * 100}::DOUBLE AS contribution FROM traffic_fx"""
        for n, w in _IMPORTANCES.items()
    ),
)
def m16(t):
    return evaluate.contributions(features.coerce_types(t.traffic), _IMPORTANCES)


@query(
    "m17_calibration_bins",
    f"""WITH b AS (SELECT min(predicted_speed) AS lo, (max(predicted_speed) - min(predicted_speed)) / 10 AS w FROM {_RES})
        SELECT cast(least(10, greatest(1, ceil((predicted_speed - lo) / w))) AS INTEGER) AS bin,
          {rd('avg(predicted_speed)', 6)} AS predicted_mean, {rd('avg(speed)', 6)} AS actual_mean, count(*) AS n
        FROM {_RES}, b GROUP BY 1""",
)
def m17(t):
    return evaluate.calibration_bins(t.predicted).select("bin", *_r("predicted_mean", "actual_mean"), "n")


@query(
    "m18_live_residual_stats",
    f"""SELECT {rd('avg(abs(residual))', 6)} AS mae, {rd('avg(residual)', 6)} AS bias, {rd('max(abs(residual))', 6)} AS max_abs_error
        FROM {_RES}""",
)
def m18(t):
    return evaluate.live_residual_stats(t.predicted).select(*_r("mae", "bias", "max_abs_error"))


@query(
    "m18_residual_histogram",
    f"""WITH b AS (SELECT min(residual) AS lo, (max(residual) - min(residual)) / 40 AS w FROM {_RES})
        SELECT cast(least(39, floor((residual - lo) / w)) AS INTEGER) AS bin, count(*) AS n FROM {_RES}, b GROUP BY 1""",
)
def m18_residuals(t):
    return evaluate.residual_histogram(t.predicted)


@query(
    "m18_score_histogram",
    """WITH b AS (SELECT min(anomaly_score) AS lo, (max(anomaly_score) - min(anomaly_score)) / 40 AS w FROM traffic_pred_fx)
       SELECT is_anomaly, cast(least(39, floor((anomaly_score - lo) / w)) AS INTEGER) AS bin, count(*) AS n
       FROM traffic_pred_fx, b GROUP BY 1, 2""",
)
def m18_scores(t):
    return evaluate.anomaly_score_histogram(t.predicted)


@query(
    "m22_speed_pairs",
    f"""SELECT record_id, speed, {rd('predicted_speed', 6)} AS predicted_speed, congestion_level,
        (SELECT {rd('greatest(max(speed), max(predicted_speed))', 6)} FROM {_RES}) AS axis_max FROM {_RES}""",
)
def m22(t):
    rows = evaluate.speed_pairs(t.predicted)
    return rows.select("record_id", "speed", *_r("predicted_speed", "axis_max"), "congestion_level")


_LONG = (
    [f"SELECT 'regressor' AS section, '{n}' AS metric, {rd(x, 4)} AS value FROM {_RES}" for n, x in _REGRESSION.items()]
    + [f"SELECT 'regressor', 'samples', count(*)::DOUBLE FROM {_RES}"]
    + [
        f"""SELECT 'regressor', 'tier_accuracy', {rd('count_if(a = p) / count(*)::DOUBLE', 4)}
            FROM (SELECT {_tier('speed')} AS a, {_tier('predicted_speed')} AS p FROM traffic_pred_fx)
            WHERE a IS NOT NULL AND p IS NOT NULL"""
    ]
    + [f"SELECT 'anomaly', '{n}', {rd(x, 4)} FROM traffic_pred_fx" for n, x in _ANOMALY.items()]
    + ["SELECT 'anomaly', 'anomalies', count_if(is_anomaly)::DOUBLE FROM traffic_pred_fx"]
    + ["SELECT 'anomaly', 'samples', count(*)::DOUBLE FROM traffic_pred_fx"]
    + [f"SELECT 'classifier', 'accuracy', {rd('sum(hits) / sum(support)::DOUBLE', 4)} FROM {_REPORT}"]
    + [f"SELECT 'classifier', 'weighted_f1', {rd(f'sum({_F1} * support) / sum(support)::DOUBLE', 4)} FROM {_REPORT}"]
    + [f"SELECT 'classifier', 'samples', sum(support)::DOUBLE FROM {_REPORT}"]
    + [f"SELECT 'classifier', 'passed', (sum(hits) / sum(support)::DOUBLE >= 0.75)::INTEGER::DOUBLE FROM {_REPORT}"]
    + [
        f"SELECT 'class_' || lower(label), '{n}', {rd(x, 4)} FROM {_REPORT}"
        for n, x in {"precision": _PRECISION, "recall": _RECALL, "f1": _F1, "support": "support"}.items()
    ]
)


@query("m21_evaluation_report", " UNION ALL ".join(_LONG))
def m21(t):
    return evaluate.evaluation_report(t.predicted)


@query(
    "j3_append_predictions",
    f"""SELECT record_id, speed, congestion_level, {rd('predicted_speed', 6)} AS predicted_speed, predicted_congestion,
        {rd('congestion_confidence', 6)} AS congestion_confidence, {rd('anomaly_score', 6)} AS anomaly_score, is_anomaly
        FROM traffic_pred_fx""",
)
def j3(t):
    return t.predicted.select(
        "record_id", "speed", "congestion_level", *_r("predicted_speed"), "predicted_congestion",
        *_r("congestion_confidence", "anomaly_score"), "is_anomaly",
    )

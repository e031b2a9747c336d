import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.functions import ordering
from roadpulse.functions.quantiles import exact_percentiles, value_counts
from roadpulse.ml.features import temporal_split, with_folds
from roadpulse.operators import lineage, reports, serving

PROBS = {"p05": 0.05, "p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(
        st.sampled_from(["a", "b"]),
        st.lists(
            st.one_of(
                st.sampled_from([0.0, 35.0]),
                st.floats(-1e6, 1e6, allow_subnormal=False).map(lambda v: v + 0.0),
                st.integers(0, 20000).map(lambda v: v / 100),
            ),
            min_size=1,
            max_size=60,
        ),
        min_size=1,
    )
)
def test_percentiles_equal_numpy(spark, groups):
    rows = [(k, float(v)) for k, values in groups.items() for v in values]
    counts = value_counts(spark.createDataFrame(rows, "g string, v double"), ["g"], "v")
    for row in exact_percentiles(counts, ["g"], "v", PROBS).collect():
        for name, p in PROBS.items():
            assert row[name] == pytest.approx(np.percentile(groups[row["g"]], 100 * p), rel=1e-9, abs=1e-9)


def test_percentiles_of_one_hot_value(spark):
    df = spark.range(3000).select(F.lit("g").alias("g"), F.when(F.col("id") < 2000, 7.0).otherwise(F.col("id") * 1.0).alias("v"))
    row = exact_percentiles(value_counts(df, ["g"], "v"), ["g"], "v", {"m": 0.5, "q": 0.9}).first()
    values = [7.0] * 2000 + [float(i) for i in range(2000, 3000)]
    assert (row["m"], row["q"]) == (7.0, pytest.approx(np.percentile(values, 90)))


def moments(spark, n=600):
    # A third of the rows share one moment.
    ident = F.format_string("r%05d", (F.col("id") * 7919) % n)
    second = F.when(F.col("id") % 3 == 0, 1000).otherwise((F.col("id") * 31) % 20000)
    return spark.range(n).select(ident.alias("record_id"), F.timestamp_seconds(1700000000 + second).alias("processed_at"))


@pytest.mark.parametrize("direct", [0, 50, 10**6])
def test_positions_by_counting_equal_a_sort(spark, monkeypatch, direct):
    monkeypatch.setattr(ordering, "DIRECT_ROWS", direct)
    df = moments(spark)
    ordered = sorted((r["processed_at"], r["record_id"]) for r in df.collect())
    wanted = [0, 1, 199, 200, 420, 599]
    assert ordering.rows_at(df, "processed_at", "record_id", wanted) == [ordered[i] for i in wanted]


def test_temporal_split_sizes_and_order(spark):
    parts = temporal_split(moments(spark, 611))
    assert [p.count() for p in parts] == [427, 91, 93]
    key = F.max(F.struct("processed_at", "record_id")), F.min(F.struct("processed_at", "record_id"))
    edges = [p.agg(*[k.alias(n) for k, n in zip(key, ("hi", "lo"))]).first() for p in parts]
    assert edges[0]["hi"] < edges[1]["lo"] and edges[1]["hi"] < edges[2]["lo"]


def test_split_needs_its_time_column(spark):
    with pytest.raises(ValueError, match="no time column"):
        temporal_split(moments(spark).drop("processed_at"))


def test_folds_expand(spark):
    sizes = {r["fold"]: r["count"] for r in with_folds(moments(spark, 611)).groupBy("fold").count().collect()}
    assert sizes == {0: 106, 1: 101, 2: 101, 3: 101, 4: 101, 5: 101}


def readings(spark, rows):
    df = spark.createDataFrame(rows, "record_id string, link_id string, borough string, speed double, level string, at string")
    return df.select("record_id", "link_id", "borough", "speed", F.col("level").alias("congestion_level"), F.col("at").cast("timestamp").alias("processed_at"))


ROWS = [
    ("1", "L1", "Bronx", 10.0, "CONGESTED", "2024-01-01 00:00:00"),
    ("2", "L1", "Bronx", 40.0, "FREE_FLOW", "2024-01-01 00:01:00"),
    ("3", "L2", "Queens", None, "UNKNOWN", "2024-01-01 00:02:00"),
    ("4", "L2", "", 40.0, "FREE_FLOW", "2024-01-01 00:03:00"),
    ("5", None, None, 40.0, "FREE_FLOW", "2024-01-01 00:03:00"),
]


def test_snapshot_ties_go_to_the_newest_row(spark):
    rows = serving.congestion_snapshot(readings(spark, ROWS)).collect()
    assert [(r["borough"], r["dominant_congestion"], r["avg_speed_mph"], r["pct_congested"]) for r in rows] == [
        ("Bronx", "FREE_FLOW", 25.0, 50.0), ("Queens", "UNKNOWN", 0.0, 0.0),
    ]


def test_latest_per_link(spark):
    rows = reports.latest_per_link(readings(spark, ROWS)).collect()
    assert sorted((r["link_id"] or "", r["record_id"]) for r in rows) == [("", "5"), ("L1", "2"), ("L2", "4")]


def test_names_and_limits_are_checked(spark):
    df = readings(spark, ROWS)
    with pytest.raises(ValueError, match="unknown borough"):
        serving.in_boroughs(df, "Springfield")
    for limit in (0, 501):
        with pytest.raises(ValueError, match="between 1 and 500"):
            serving.traffic_live(df, limit)


def test_sample_is_the_same_on_every_layout(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("link_id"))
    first = {r[0] for r in reports.seeded_sample(df, 100).collect()}
    again = {r[0] for r in reports.seeded_sample(df.repartition(7), 100).collect()}
    assert len(first) == 100 and first == again
    assert first != {r[0] for r in reports.seeded_sample(df, 100, seed=1).collect()}


def test_map_sample_steps(spark):
    df = spark.range(300).select(
        F.col("id").cast("string").alias("record_id"), (F.col("id") % 30).cast("string").alias("link_id"),
        F.lit(40.7).alias("latitude"), F.lit(-74.0).alias("longitude"), F.lit(1.0).alias("speed"),
        F.timestamp_seconds("id").alias("processed_at"),
    )
    assert reports.map_sample(df, 300).count() == 300
    latest = reports.map_sample(df, 100).collect()
    assert len(latest) == 30 and min(int(r["record_id"]) for r in latest) == 270
    assert reports.map_sample(df, 10).count() == 10


def test_replay_crosses_buckets(spark):
    rows = spark.range(1000).select((F.col("id") % 2).cast("int").alias("partition"), F.col("id").alias("offset"))
    ranges = spark.createDataFrame([("b", {"partition_0": (95, 205, 1), "partition_1": (7, 7, 1)})],
                                   "batch_id string, offset_ranges map<string,struct<min:long,max:long,count:long>>")
    found = sorted(r["offset"] for r in lineage.replay(rows, ranges, bucket_size=50).collect())
    assert found == sorted([7] + list(range(96, 206, 2)))


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    assert [(r["bin"], r["n"]) for r in reports.histogram(df, "v", 10).collect()] == [(0, 2)]


def test_heatmap_labels(spark):
    df = spark.createDataFrame([(7, 1, 0.5), (7, 1, 0.7), (7, 3, 0.1)], "hour_of_day int, day_of_week int, congestion_score double")
    row = reports.congestion_heatmap(df).first().asDict()
    assert row["Sun"] == pytest.approx(0.6) and row["Tue"] == pytest.approx(0.1) and row["Sat"] is None
    assert list(row) == ["hour_of_day", "Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def test_health_levels(spark):
    at = "2024-01-01 10:00:00"
    good = spark.createDataFrame(pd.DataFrame({"quality_score": [99.0], "batch_id": ["b"], "recorded_at": [pd.Timestamp(at)]}))
    bad = good.withColumn("quality_score", F.lit(79.0))

    def level(minutes, metrics):
        stamp = (pd.Timestamp(at) - pd.Timedelta(minutes=minutes)).isoformat(sep=" ")
        df = spark.createDataFrame([(stamp,)], "at string").select(F.col("at").cast("timestamp").alias("processed_at"))
        return reports.health_status(df, metrics, at).first()["level"]

    assert [level(m, good) for m in (60, 61, 239, 240)] == ["OPERATIONAL", "DEGRADED", "DEGRADED", "CRITICAL"]
    assert level(0, bad) == "CRITICAL" and level(0, bad.withColumn("quality_score", F.lit(90.0))) == "DEGRADED"

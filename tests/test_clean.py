import datetime as dt

import pytest
from readings import variant
from pyspark.sql import functions as F

from roadpulse.functions import casts, traffic
from roadpulse.operators.clean import clean, parse_envelope
from roadpulse.schema import PROCESSED, RAW


def cleaned(spark, records):
    rows = [tuple(r.get(f) for f in RAW.fieldNames()) for r in records]
    return clean(spark.createDataFrame(rows, RAW), F.lit("2024-02-13 07:10:00").cast("timestamp"))


def test_seed_record(spark):
    df = cleaned(spark, [variant()])
    assert df.schema.simpleString() == PROCESSED.simpleString()
    row = df.first()
    expected = {
        "record_id": "90217", "speed": 38.6, "travel_time": 112, "status": 0, "hour_of_day": 7, "day_of_week": 3,
        "is_weekend": False, "is_peak_hour": True, "time_bucket": "MORNING_PEAK", "congestion_level": "FREE_FLOW",
        "congestion_score": 0.3567, "latitude": 40.7105, "longitude": -73.9502, "quality_flags": [],
        "data_as_of_parsed": dt.datetime(2024, 2, 13, 7, 4, 30),
    }
    assert {k: row[k] for k in expected} == expected


def test_typed_copies_win_and_zero_counts(spark):
    value = '{"speed":"5","travel_time":"7","_pipeline":{"speed_float":0.0,"travel_time_int":9,"source":"s"}}'
    rows = spark.createDataFrame([("k", value, "t", 1, 5)], "key string, value string, topic string, partition int, offset long")
    row = clean(parse_envelope(rows.withColumn("timestamp", F.current_timestamp()))).first()
    assert (row["speed"], row["travel_time"], row["source"]) == (0.0, 9, "s")
    assert (row["kafka_partition"], row["kafka_offset"]) == (1, 5)
    assert "ZERO_SPEED" in row["quality_flags"]


@pytest.mark.parametrize(
    "speed, level, score",
    [
        (None, "UNKNOWN", None), (0.0, "SEVERE", 1.0), (4.99, "SEVERE", 0.9168), (5.0, "CONGESTED", 0.9167),
        (14.99, "CONGESTED", 0.7502), (15.0, "MODERATE", 0.75), (34.99, "MODERATE", 0.4168),
        (35.0, "FREE_FLOW", 0.4167), (60.0, "FREE_FLOW", 0.0), (61.0, "FREE_FLOW", 0.0),
    ],
)
def test_congestion(spark, speed, level, score):
    df = spark.createDataFrame([(speed,)], "s double")
    row = df.select(traffic.congestion_level(F.col("s")).alias("l"), traffic.congestion_score(F.col("s")).alias("c")).first()
    assert (row["l"], row["c"]) == (level, score)


WEEKDAY = {
    0: "OVERNIGHT", 5: "OVERNIGHT", 6: "OFF_PEAK", 7: "MORNING_PEAK", 8: "MORNING_PEAK", 9: "OFF_PEAK",
    17: "EVENING_PEAK", 18: "EVENING_PEAK", 19: "OFF_PEAK",
}


def test_time_buckets(spark):
    tuesday, saturday = "2024-02-13", "2024-02-17"
    records = [variant(id=f"{d}|{h}", data_as_of=f"{d}T{h:02d}:30:00") for d in (tuesday, saturday) for h in WEEKDAY]
    for row in cleaned(spark, records).collect():
        day, hour = row["record_id"].split("|")
        bucket = WEEKDAY[int(hour)]
        if day == saturday and bucket.endswith("PEAK") and bucket != "OFF_PEAK":
            bucket = "OFF_PEAK"
        assert row["time_bucket"] == bucket
        assert row["is_peak_hour"] == bucket.startswith(("MORNING", "EVENING"))
        assert row["is_weekend"] == (day == saturday)


def test_timestamps(spark):
    texts = {
        "2024-02-13T07:09:09.123456": dt.datetime(2024, 2, 13, 7, 9, 9, 123456),
        "2024-02-13T07:09:09.5": dt.datetime(2024, 2, 13, 7, 9, 9, 500000),
        "2024-02-13T07:09:09": dt.datetime(2024, 2, 13, 7, 9, 9),
        "2024-02-13 07:09:09": dt.datetime(2024, 2, 13, 7, 9, 9),
        "2024-02-30T07:09:09": None, "2024-02-13": None, "13/02/2024": None, "": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r["t"]: r["v"] for r in df.withColumn("v", casts.parse_timestamp(F.col("t"))).collect()}
    assert found == texts


def test_null_time_has_no_features_but_a_flag(spark):
    row = cleaned(spark, [variant(data_as_of=None, borough="", link_id=None, speed="")]).first()
    for name in ("hour_of_day", "day_of_week", "is_weekend", "is_peak_hour", "time_bucket"):
        assert row[name] is None
    assert row["quality_flags"] == ["MISSING_SPEED", "MISSING_TIMESTAMP", "MISSING_BOROUGH", "MISSING_LINK_ID"]


@pytest.mark.parametrize(
    "points, found",
    [
        ("40.5,-74.1 1,2", (40.5, -74.1)), (" 40.5,-74.1", (40.5, -74.1)), ("", (None, None)), (None, (None, None)),
        ("a,b", (None, None)), ("1,2,3", (None, None)), ("40.5", (None, None)), ("40.5,", (None, None)),
        ("40,-74", (40.0, -74.0)),
    ],
)
def test_first_location(spark, points, found):
    df = spark.createDataFrame([(points,)], "p string")
    cols = traffic.first_location(F.col("p"))
    row = df.select(*[c.alias(n) for n, c in cols.items()]).first()
    assert (row["latitude"], row["longitude"]) == found


@pytest.mark.parametrize(
    "text, number, whole",
    [
        ("5", 5.0, 5), ("66.0", 66.0, 66), ("66.9", 66.9, 66), ("-1.5", -1.5, -1), ("1e3", 1000.0, 1000), ("", None, None),
        ("null", None, None), ("abc", None, None), ("5d", None, None), ("NaN", None, None), (None, None, None),
        ("1e30", 1e30, None),
    ],
)
def test_safe_numbers(spark, text, number, whole):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(casts.safe_double(F.col("t")).alias("d"), casts.safe_int(F.col("t")).alias("i")).first()
    assert (row["d"], row["i"]) == (number, whole)


def test_rounding_is_half_up_on_decimal_digits(spark):
    df = spark.createDataFrame([(17.935,), (-2.345,), (1e12,), (None,)], "v double")
    assert [r["r"] for r in df.select(casts.round_dec(F.col("v"), 2).alias("r")).collect()] == [17.94, -2.35, 1e12, None]

import json

import pytest
from readings import envelope_rows, variant
from pyspark.sql import functions as F

from roadpulse.operators import ingest
from roadpulse.schema import BOROUGHS, ENVELOPE


def frame(spark, values):
    rows = envelope_rows(values)
    typed = spark.createDataFrame([tuple(r[c] for c in ("key", "value", "topic", "partition", "offset")) for r in rows],
                                  "key string, value string, topic string, partition int, offset long")
    return typed.withColumn("timestamp", F.lit("2024-02-13 07:10:00").cast("timestamp")).select(*ENVELOPE.fieldNames())


CASES = [
    ({}, None),
    ({"speed": ...}, "MISSING_SPEED"),
    ({"borough": ...}, "MISSING_BOROUGH"),
    ({"link_name": ...}, "MISSING_LINK_NAME"),
    ({"borough": "New Jersey"}, "UNKNOWN_BOROUGH"),
    ({"speed": "999"}, "Speed 999 mph is out of plausible range (0-200)"),
    ({"speed": "200.1"}, "Speed 200.1 mph is out of plausible range (0-200)"),
    ({"speed": "200"}, None),
    ({"speed": "-5"}, "SPEED_FORMAT"),
    ({"speed": "fast"}, "SPEED_FORMAT"),
    ({"speed": "0"}, None),
    ({"status": "9"}, None),
    ({"speed": 38.6}, "NOT_A_STRING_SPEED"),
    ({"owner": None}, "NOT_A_STRING_OWNER"),
    ({"travel_time": "112.0"}, "TRAVEL_TIME_NOT_INTEGER"),
    ({"travel_time": ...}, None),
    ({"extra": "kept"}, None),
] + [({"borough": name}, None) for name in BOROUGHS]


def test_validation_cases(spark):
    rows = ingest.validate(frame(spark, [variant(**change) for change, _ in CASES])).orderBy("offset").collect()
    for row, (change, error) in zip(rows, CASES):
        assert row["is_valid"] == (error is None), change
        assert row["error"] == error, change


def test_text_that_is_no_object(spark):
    rows = ingest.validate(frame(spark, ["{broken", "[1, 2]", '"text"', "5"])).orderBy("offset").collect()
    assert [r["error"] for r in rows] == ["INVALID_JSON"] + ["NOT_AN_OBJECT"] * 3


def test_strict_status(spark):
    df = frame(spark, [variant(status="9"), variant(status="2")])
    rows = ingest.validate(df, strict_status=True).orderBy("offset").collect()
    assert [r["error"] for r in rows] == ["UNKNOWN_STATUS", None]


def test_all_reasons_are_listed(spark):
    row = ingest.validate(frame(spark, [variant(speed="fast", borough="New Jersey")])).first()
    assert row["reasons"] == ["SPEED_FORMAT", "UNKNOWN_BOROUGH"]


def test_valid_rows_keep_every_field_and_add_typed_copies(spark, seed):
    validated = ingest.validate(frame(spark, [variant(extra="kept"), seed, variant(travel_time=..., status=...)]))
    moment = F.lit("2024-02-13 07:10:00").cast("timestamp")
    rows = ingest.valid_rows(validated, ingested_at=moment, source="feed").orderBy("offset").collect()
    first = json.loads(rows[0]["value"])
    assert {k: first[k] for k in seed} == seed
    assert first["extra"] == "kept"
    assert first["_pipeline"] == {
        "ingested_at": "2024-02-13T07:10:00.000000Z",
        "source": "feed",
        "dataset_id": "road_speeds",
        "phase": "raw_ingestion",
        "speed_float": 38.6,
        "travel_time_int": 112,
        "status_int": 0,
    }
    assert json.loads(rows[1]["value"])["_pipeline"]["speed_float"] == 38.6
    last = json.loads(rows[2]["value"])
    assert "travel_time" not in last and last["_pipeline"]["travel_time_int"] == 0
    assert rows[0]["topic"] == "validated" and rows[0]["offset"] == 0


def test_an_earlier_enrichment_is_replaced(spark):
    old = json.dumps(variant(_pipeline={"speed_float": 1.0})) + " \n"
    row = ingest.valid_rows(ingest.validate(frame(spark, [old, json.dumps(variant()) + " \n"]))).orderBy("offset").collect()
    for r in row:
        assert r["value"].count("_pipeline") == 1
        assert json.loads(r["value"])["_pipeline"]["speed_float"] == 38.6


def test_rejected_rows_keep_the_payload(spark):
    validated = ingest.validate(frame(spark, ["{broken", variant()]))
    rows = ingest.rejected_rows(validated).collect()
    assert [(r["original"], r["error"], r["source_offset"], r["source_partition"]) for r in rows] == [
        ("{broken", "INVALID_JSON", 0, 0)
    ]


def test_route_counts(spark):
    validated = ingest.validate(frame(spark, ["{broken", variant(), variant(speed="x")]))
    assert validated.agg(*ingest.route_counts()).first().asDict() == {"processed": 3, "valid": 1, "invalid": 2}


@pytest.mark.parametrize(
    "ident, link, key", [("1", "2", "1"), ("", "2", "2"), (None, "2", "2"), (None, None, ""), ("", "", "")]
)
def test_raw_envelope_key(spark, ident, link, key):
    rows = spark.createDataFrame([(ident, link, "5")], "id string, link_id string, speed string")
    assert ingest.raw_envelope(rows).first()["key"] == key


def test_poll_statistics(spark):
    rows = spark.createDataFrame(
        [("1", "9", "t1"), ("1", "9", "t1"), ("2", "9", "t1")], "id string, link_id string, data_as_of string"
    )
    assert ingest.poll_statistics(rows, 30.0).first().asDict() == {
        "fetched": 3, "published": 3, "duplicates": 1, "errors": 0, "rate_per_min": 6.0,
    }

"""Validation, routing and enrichment of raw JSON readings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.casts import round_dec, safe_double, safe_int
from roadpulse.functions.keys import dedup_key, message_key
from roadpulse.schema import (
    BOROUGHS,
    MAX_PLAUSIBLE_MPH,
    MIN_PLAUSIBLE_MPH,
    PIPELINE,
    RAW,
    RAW_FIELDS,
    REQUIRED_FIELDS,
    SPEED_PATTERN,
)

INVALID_JSON = "INVALID_JSON"
NOT_AN_OBJECT = "NOT_AN_OBJECT"


def _once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Adds a column that later filters cannot inline.

    Predicates are pushed below a projection by copying its expressions into them, which
    would parse the text anew for every rule; they are not pushed below a generator.
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))


def json_fields(df: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``_text`` (field values as text) and ``_type`` (their JSON types).

    Types come from the VARIANT form: null means absent and VOID an explicit null, while
    a plain ``from_json`` reads a number as text and merges the two kinds of null.
    """
    types = F.struct(
        *[
            F.schema_of_variant(F.try_variant_get("_variant", f"$.{name}", "variant")).alias(name)
            for name in RAW_FIELDS
        ]
    )
    parsed = _once(df, "_variant", F.try_parse_json(F.col(value)))
    parsed = _once(parsed, "_root", F.schema_of_variant("_variant"))
    return _once(_once(parsed, "_type", types).drop("_variant"), "_text", F.from_json(F.col(value), RAW))


def validation_rules(strict_status: bool = False) -> list[tuple[str, Column]]:
    """``(reason, violated)`` pairs in reporting order, over ``json_fields`` output."""

    def text(name: str) -> Column:
        return F.col(f"_text.{name}")

    def is_string(name: str) -> Column:
        return F.coalesce(F.col(f"_type.{name}") == "STRING", F.lit(False))

    is_object = F.col("_root").startswith("OBJECT")
    rules = [
        (INVALID_JSON, F.col("_root").isNull()),
        (NOT_AN_OBJECT, F.col("_root").isNotNull() & ~is_object),
    ]
    rules += [
        (f"MISSING_{name.upper()}", is_object & F.col(f"_type.{name}").isNull())
        for name in REQUIRED_FIELDS
    ]
    rules += [(f"NOT_A_STRING_{name.upper()}", F.col(f"_type.{name}") != "STRING") for name in RAW_FIELDS]
    speed = safe_double(text("speed"))
    rules += [
        ("SPEED_FORMAT", is_string("speed") & ~text("speed").rlike(SPEED_PATTERN)),
        ("UNKNOWN_BOROUGH", is_string("borough") & ~text("borough").isin(BOROUGHS)),
        ("SPEED_RANGE", is_string("speed") & ~speed.between(MIN_PLAUSIBLE_MPH, MAX_PLAUSIBLE_MPH)),
        ("TRAVEL_TIME_NOT_INTEGER", is_string("travel_time") & ~_is_integer(text("travel_time"))),
        ("STATUS_NOT_INTEGER", is_string("status") & ~_is_integer(text("status"))),
    ]
    if strict_status:
        rules.append(("UNKNOWN_STATUS", is_string("status") & ~text("status").isin("0", "1", "2")))
    return rules


def _is_integer(text: Column) -> Column:
    whole = text.rlike(r"^\s*[+-]?[0-9]+\s*$")
    return F.coalesce(whole & text.try_cast("int").isNotNull(), F.lit(False))


def validate(df: DataFrame, value: str = "value", strict_status: bool = False) -> DataFrame:
    """Adds ``reasons``, ``error`` (the first reason in words) and ``is_valid``."""
    fields = json_fields(df, value)
    # One text first: the array form would filter its nulls with a function that is not compiled.
    found = F.concat_ws(",", *[F.when(bad, reason) for reason, bad in validation_rules(strict_status)])
    speed_text = F.concat(
        F.lit("Speed "),
        F.col("_text.speed"),
        F.lit(f" mph is out of plausible range ({MIN_PLAUSIBLE_MPH:.0f}-{MAX_PLAUSIBLE_MPH:.0f})"),
    )
    first = F.nullif(F.substring_index("_found", ",", 1), F.lit(""))
    none = F.array().cast("array<string>")
    return (
        _once(fields, "_found", found)
        .withColumn("reasons", F.when(F.col("_found") == "", none).otherwise(F.split("_found", ",")))
        .withColumn("error", F.when(first == "SPEED_RANGE", speed_text).otherwise(first))
        .withColumn("is_valid", F.col("_found") == "")
        .drop("_root", "_type", "_found")
    )


def enrich(
    df: DataFrame,
    ingested_at: Column | None = None,
    source: str = "road_speed_feed",
    dataset_id: str = "road_speeds",
) -> DataFrame:
    """Adds the ``_pipeline`` struct with typed copies; absent measures become 0."""
    moment = F.current_timestamp() if ingested_at is None else ingested_at
    pipeline = F.struct(
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingested_at"),
        F.lit(source).alias("source"),
        F.lit(dataset_id).alias("dataset_id"),
        F.lit("raw_ingestion").alias("phase"),
        F.coalesce(safe_double(F.col("speed")), F.lit(0.0)).alias("speed_float"),
        F.coalesce(safe_int(F.col("travel_time")), F.lit(0)).alias("travel_time_int"),
        F.coalesce(safe_int(F.col("status")), F.lit(0)).alias("status_int"),
    )
    return df.withColumn("_pipeline", pipeline.cast(PIPELINE))


def valid_rows(validated: DataFrame, topic: str = "validated", **options) -> DataFrame:
    """Accepted readings as enriched JSON rows; fields outside the schema are kept."""
    flat = validated.where("is_valid").select("*", "_text.*").drop("_text")
    carried = [c for c in validated.columns if c not in ("_text", "reasons", "error", "is_valid")]
    enriched = enrich(flat, **options)
    # A valid reading is a non-empty object, so its text can be extended before the last brace;
    # only one that already carries an enrichment is taken apart to replace it.
    text = F.rtrim("value", F.lit(" \t\r\n"))
    extended = F.concat(
        F.left(text, F.length(text) - 1), F.lit(',"_pipeline":'), F.to_json("_pipeline"), F.lit("}")
    )
    others = F.map_filter(F.from_json("value", "map<string,variant>"), lambda name, _: name != "_pipeline")
    replaced = F.to_json(F.map_concat(others, F.create_map(F.lit("_pipeline"), F.to_variant_object("_pipeline"))))
    merged = F.when(F.contains("value", F.lit('"_pipeline"')), replaced).otherwise(extended)
    return enriched.withColumn("value", merged).withColumn("topic", F.lit(topic)).select(*carried)


def rejected_rows(validated: DataFrame, rejected_at: Column | None = None) -> DataFrame:
    """Dead letters: the payload as received, the reason and the source position."""
    moment = F.current_timestamp() if rejected_at is None else rejected_at
    return validated.where("NOT is_valid").select(
        F.col("value").alias("original"),
        "error",
        "reasons",
        moment.alias("rejected_at"),
        F.col("offset").alias("source_offset"),
        F.col("partition").alias("source_partition"),
    )


def route_counts() -> list[Column]:
    """Counters of one routed batch."""
    return [
        F.count(F.lit(1)).alias("processed"),
        F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
    ]


def raw_envelope(rows: DataFrame, topic: str = "raw") -> DataFrame:
    """Fetched rows as topic rows; the key falls back from id to link id to empty."""
    fields = [name for name in RAW_FIELDS if name in rows.columns]
    return rows.select(
        message_key(F.col("id"), F.col("link_id")).alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        F.lit(topic).alias("topic"),
    )


def poll_statistics(rows: DataFrame, elapsed_seconds: float | Column = 60.0, errors: int = 0) -> DataFrame:
    """Fetched, distinct and repeated readings of a poll, and the rate per minute."""
    key = dedup_key(F.col("id"), F.col("link_id"), F.col("data_as_of"))
    per_key = rows.groupBy(key.alias("k")).agg(F.count("*").alias("n"))
    elapsed = F.lit(elapsed_seconds) if not isinstance(elapsed_seconds, Column) else elapsed_seconds
    fetched = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(
        fetched.alias("fetched"),
        fetched.alias("published"),
        (fetched - F.count("*")).alias("duplicates"),
        F.lit(errors).cast("bigint").alias("errors"),
        round_dec(fetched / F.greatest(elapsed / 60.0, F.lit(0.01)), 1).alias("rate_per_min"),
    )

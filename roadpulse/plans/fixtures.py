"""Adapts the generic ``events`` table to road readings, and names the derived tables.

Every table covers all events. Defects (nulls, zero speeds, unknown boroughs, bad points)
are planted at fixed residues of the event id, so that each rule has rows to act on.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions import traffic
from roadpulse.operators import clean as cleaning
from roadpulse.operators import hourly
from roadpulse.operators.lineage import batch_lineage
from roadpulse.operators.quality import stream_quality
from roadpulse.session import prepare

AS_OF = "2024-01-31 00:00:00"


def raw_readings(events: DataFrame) -> DataFrame:
    ident = F.col("event_id")

    def every(n: int):
        return ident % n == 0

    user = F.col("user_id")
    names = {
        "click": "Manhattan",
        "error": "Brooklyn",
        "purchase": "Queens",
        "signup": "Bronx",
        "view": "Staten Island",
    }
    borough = F.when(every(101), F.lit(None)).when(every(113), "New Jersey")
    for kind, name in names.items():
        borough = borough.when(F.col("event_type") == kind, name)
    points = F.concat(
        F.lit("40."),
        (50 + user % 45).cast("string"),
        F.lit(",-74."),
        (10 + user % 30).cast("string"),
        F.lit(" 40.70,-74.00"),
    )
    ts = F.col("ts").cast("timestamp")
    return events.select(
        ident.cast("string").alias("id"),
        F.when(every(97), F.lit(None)).when(every(89), "0").otherwise(F.col("value").cast("string")).alias("speed"),
        F.get_json_object("props", "$.k").alias("travel_time"),
        (ident % 3).cast("string").alias("status"),
        F.when(~every(103), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")).alias("data_as_of"),
        F.when(~every(107), user.cast("string")).alias("link_id"),
        F.when(every(109), "bad").otherwise(points).alias("link_points"),
        borough.alias("borough"),
        F.concat(F.lit("LINK "), user.cast("string")).alias("link_name"),
        (ident % 5).cast("int").alias("kafka_partition"),
        ident.alias("kafka_offset"),
        (ts + F.make_interval(secs=ident % 7)).alias("processed_at"),
        F.floor(ident / 1000).cast("bigint").alias("batch_id"),
        F.col("value").alias("raw_value"),
    )


def json_messages(events: DataFrame) -> DataFrame:
    """Readings as JSON text, some with wrong types, explicit nulls or broken syntax."""
    raw = raw_readings(events)
    ident = F.col("kafka_offset")

    def quoted(name: str):
        return F.concat(F.lit(f'"{name}":"'), F.col(name), F.lit('"'))

    speed = F.when(ident % 83 == 0, F.concat(F.lit('"speed":'), F.col("speed"))).otherwise(quoted("speed"))
    transcom = F.when(ident % 79 == 0, '"transcom_id":null')
    travel = F.when(
        ident % 67 == 0, F.concat(F.lit('"travel_time":"'), F.col("travel_time"), F.lit('.5"'))
    ).otherwise(quoted("travel_time"))
    others = [quoted(n) for n in ("id", "status", "data_as_of", "link_id", "link_points", "borough", "link_name")]
    body = F.concat_ws(",", speed, transcom, travel, *others)
    value = (
        F.when(ident % 73 == 0, F.concat(F.lit("["), F.lit('"'), F.col("id"), F.lit('"]')))
        .when(ident % 71 == 0, F.concat(F.lit("{"), body))
        .otherwise(F.concat(F.lit("{"), body, F.lit("}")))
    )
    return raw.select(
        F.col("id").alias("key"),
        value.alias("value"),
        F.lit("raw").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("processed_at").alias("timestamp"),
    )


def with_predictions(traffic_rows: DataFrame) -> DataFrame:
    """Rule-made predictions, so that evaluation can be checked without a model."""
    predicted = F.col("raw_value") * 0.9 + 2
    return traffic_rows.withColumns(
        {
            "predicted_speed": predicted,
            "predicted_congestion": traffic.congestion_level(predicted),
            "congestion_confidence": 0.5 + (F.col("kafka_offset") % 50) / 100.0,
            "anomaly_score": 0.1 - F.col("raw_value") / 1000,
        }
    ).withColumn("is_anomaly", F.col("anomaly_score") < 0)


class Tables:
    """The test tables of one scale folder, built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def raw(self) -> DataFrame:
        return raw_readings(self.events)

    @cached_property
    def messages(self) -> DataFrame:
        return json_messages(self.events)

    @cached_property
    def traffic(self) -> DataFrame:
        return cleaning.clean(self.raw, keep=("batch_id",))

    @cached_property
    def predicted(self) -> DataFrame:
        return with_predictions(cleaning.clean(self.raw, keep=("batch_id", "raw_value")))

    @cached_property
    def hourly_stats(self) -> DataFrame:
        return hourly.hourly_stats(self.traffic)

    @cached_property
    def hourly(self) -> DataFrame:
        return hourly.hourly_table(self.hourly_stats, AS_OF)

    @cached_property
    def quality(self) -> DataFrame:
        source = F.when(F.col("batch_id") % 4 == 0, "batch_processor").otherwise("spark_stream_processor")
        return stream_quality(self.traffic, source=source)

    @cached_property
    def lineage(self) -> DataFrame:
        batch = F.col("batch_id")
        phase = F.when(batch % 4 == 0, "batch_processing").otherwise("stream_processing")
        status = F.when(batch % 7 == 0, "failed").when(batch % 5 == 0, "partial").otherwise("success")
        return batch_lineage(
            self.traffic, phase=phase, status=status, duration_ms=500 + (batch * 37) % 400
        )

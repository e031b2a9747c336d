"""Streaming and model queries over the test tables, drained into stored tables and read back."""

import uuid

from pyspark.sql import functions as F

from roadpulse.ml import isoforest, score, train
from roadpulse.ml.features import ANOMALY_FEATURES, fit_imputer, impute, training_rows
from roadpulse.operators import ingest, reports
from roadpulse.plans.catalog.core import query
from roadpulse.plans.fixtures import AS_OF, json_messages
from roadpulse.plans.oracle import rd
from roadpulse.session import checkpoint_dir, materialize, spread
from roadpulse.sources import tables
from roadpulse.sources.envelope import stream_files
from roadpulse.streaming import processing, routing, windows
from roadpulse.streaming.processing import TablePaths

# Longer than the time range of the tables, so that no file order makes a row late.
WHOLE_TABLE = "365 days"


def place(t) -> str:
    """A new folder next to the checkpoints of the session, which every executor can reach."""
    return f"{checkpoint_dir(t.spark).rstrip('/')}/run-{uuid.uuid4().hex}"


def _messages(t):
    """The messages as a stream over the folder of the events table."""
    reader = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet")
    return json_messages(spread(reader.parquet(t.folder)))


def _drain(start, t, *args, **options):
    root = place(t)
    paths = TablePaths(f"{root}/tables")
    stream = start(*args, paths=paths, checkpoint=f"{root}/checkpoint", once=True, **options)
    stream.awaitTermination()
    return paths


@query(
    "x1_stream_processing",
    """SELECT "offset" AS kafka_offset, CASE WHEN is_object THEN id END AS record_id,
       CASE WHEN is_object THEN try_cast(speed AS DOUBLE) END AS speed,
       CASE WHEN is_object THEN try_cast(data_as_of AS TIMESTAMP) END AS data_as_of_parsed FROM checked_fx""",
)
def x1(t):
    paths = _drain(processing.start_processing, t, _messages(t))
    rows = tables.read_processed(t.spark, paths.processed)
    return rows.select("kafka_offset", "record_id", "speed", "data_as_of_parsed")


@query(
    "x2_stream_quality_and_lineage",
    """SELECT count(*) AS total_records, count_if(NOT coalesce(is_object, false) OR try_cast(speed AS DOUBLE) IS NULL) AS null_speed,
       count(*) AS lineage_records, 'success' AS status FROM checked_fx""",
)
def x2(t):
    paths = _drain(processing.start_processing, t, _messages(t))
    metrics = tables.read_quality(t.spark, paths.quality).agg(
        F.sum("total_records").alias("total_records"), F.sum(F.col("null_counts")["speed"]).alias("null_speed")
    )
    entries = tables.read_lineage(t.spark, paths.lineage).agg(F.sum("record_count").alias("n"), F.max("status").alias("s"))
    return metrics.select(
        "total_records", "null_speed", entries.select("n").scalar().alias("lineage_records"),
        entries.select("s").scalar().alias("status"),
    )


@query(
    "x4_stream_routing",
    'SELECT "offset" AS kafka_offset, is_valid FROM verdict_fx',
)
def x4(t):
    paths = _drain(routing.start_routing, t, _messages(t))
    valid = t.spark.read.parquet(paths.topic("validated")).select("offset", F.lit(True).alias("is_valid"))
    dead = t.spark.read.parquet(paths.topic("dead_letters")).select("source_offset", F.lit(False))
    return valid.union(dead).withColumnRenamed("offset", "kafka_offset")


@query("x9_route_counters", "SELECT count(*) AS processed, count_if(is_valid) AS valid, count_if(NOT is_valid) AS invalid FROM verdict_fx")
def x9(t):
    paths = _drain(routing.start_routing, t, _messages(t))
    counters = t.spark.read.parquet(paths.counters)
    return counters.agg(*[F.sum(c).alias(c) for c in ("processed", "valid", "invalid")])


@query(
    "x5_stream_deduplication",
    "SELECT kafka_offset FROM traffic_raw_fx",
)
def x5(t):
    doubled = _messages(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")

    def start(envelope, paths, checkpoint, once):
        writer = routing.without_duplicates(envelope, WHOLE_TABLE).select("offset").writeStream.format("parquet")
        writer = writer.option("checkpointLocation", checkpoint).option("path", f"{paths.root}/rows")
        return writer.trigger(availableNow=once).start()

    paths = _drain(start, t, doubled)
    return t.spark.read.parquet(f"{paths.root}/rows").select(F.col("offset").alias("kafka_offset"))


@query(
    "x7_stream_hourly_windows",
    f"""SELECT date_trunc('hour', try_cast(data_as_of AS TIMESTAMP)) AS window_start, borough,
        count(try_cast(speed AS DOUBLE)) AS record_count, {rd('avg(try_cast(speed AS DOUBLE))', 2)} AS avg_speed,
        {rd('median(try_cast(speed AS DOUBLE))', 2)} AS median_speed
        FROM checked_fx WHERE is_object AND borough IS NOT NULL AND try_cast(data_as_of AS TIMESTAMP) IS NOT NULL GROUP BY 1, 2""",
)
def x7(t):
    paths = _drain(windows.start_windows, t, _messages(t), lateness=WHOLE_TABLE)
    return reports.flatten_hourly(tables.read_hourly(t.spark, paths.hourly)).select(
        "window_start", "borough", "record_count", "avg_speed", "median_speed"
    )


@query(
    "s17_poll_statistics",
    f"""SELECT count(*) AS fetched, count(*) AS published, count(*) - count(DISTINCT k) AS duplicates, 0::BIGINT AS errors,
        {rd('count(*) / greatest(90.0::DOUBLE / 60.0::DOUBLE, 0.01)', 1)} AS rate_per_min
        FROM (SELECT coalesce(link_id, '') || '_' || coalesce(data_as_of, '') AS k FROM traffic_raw_fx)""",
)
def s17(t):
    return ingest.poll_statistics(t.raw.withColumn("id", F.lit(None).cast("string")), 90.0)


@query(
    "s6_raw_topic",
    "SELECT id AS key, id, speed, link_id, borough FROM traffic_raw_fx",
)
def s6(t):
    rows = ingest.raw_envelope(t.raw)
    fields = F.from_json("value", "id string, speed string, link_id string, borough string")
    return rows.select("key", fields.alias("d")).select("key", "d.*")


_TRAINED: dict[tuple[str, str], train.TrainedModels] = {}


def _models(t):
    """Models at the published settings, trained once per application and folder on the whole table."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _TRAINED:
        _TRAINED[key] = train.train(t.traffic, AS_OF, 31)
    return _TRAINED[key]


@query("m13_score")
def m13(t):
    return score.score(score.arranged(t.traffic), _models(t)).select("record_id", *score.PREDICTION_COLUMNS)


@query("m14_traffic_predict")
def m14(t):
    return score.traffic_predict(t.traffic, _models(t), 20)


@query("p2_score_with_fallback")
def p2(t):
    broken = t.traffic.withColumn("speed", F.when(F.col("speed") == 0, F.lit(float("nan"))).otherwise(F.col("speed")))
    rows = score.score(score.arranged(broken), _models(t))
    return rows.groupBy("predicted_congestion").agg(
        F.count("*").alias("n"), F.count("predicted_speed").alias("with_speed"), F.min("congestion_confidence").alias("lowest_confidence")
    )


@query(
    "x8_live_scoring",
    """SELECT "offset" AS kafka_offset, CASE WHEN "offset" % 2 = 0 THEN '1' ELSE '2' END AS model_version, true AS scored FROM checked_fx""",
)
def x8(t):
    """A stream that goes on while a newer version of the models appears."""
    root = place(t)
    paths = TablePaths(f"{root}/tables")
    for version, rest in (("1", 0), ("2", 1)):
        train.save(_models(t), t.spark, f"{root}/models/{version}")
        t.messages.where(F.col("offset") % 2 == rest).write.mode("append").parquet(f"{root}/topic")
        stream = stream_files(t.spark, f"{root}/topic", "parquet", max_files=100)
        windows.start_scoring(stream, f"{root}/models", paths, f"{root}/checkpoint", once=True).awaitTermination()
    rows = tables.read_parts(t.spark, paths.predictions)
    return rows.select("kafka_offset", "model_version", F.col("predicted_congestion").isNotNull().alias("scored"))


@query("m6_isolation_forest")
def m6(t):
    kept = [c for c in ("record_id", *isoforest.MOMENTS, *ANOMALY_FEATURES) if c in t.traffic.columns or c == "borough_encoded"]
    rows = materialize(spread(training_rows(t.traffic).select(*kept)))  # cleaned once, read five times
    filled = impute(rows, fit_imputer(rows, ANOMALY_FEATURES))
    forest = isoforest.fit(filled, ANOMALY_FEATURES)
    return isoforest.with_anomaly(filled, forest).select("record_id", "anomaly_score", "is_anomaly")


@query("m19_model_metadata")
def m19(t):
    return train.metadata_table(_models(t), t.spark)

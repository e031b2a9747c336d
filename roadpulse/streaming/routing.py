"""Continuous validation, routing, deduplication and publishing of raw readings."""

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.functions.keys import dedup_key
from roadpulse.operators import ingest
from roadpulse.schema import RAW
from roadpulse.sources.sinks import batch_key, write_batch
from roadpulse.streaming.processing import TablePaths, with_trigger


def without_duplicates(envelope: DataFrame, delay: str = "24 hours", enabled: bool = True) -> DataFrame:
    """Drops rows whose reading was seen within ``delay``, which also bounds the state.

    A message without id, link or time names no reading; it is told apart by its place in the
    topic, so only a repeated delivery of it is dropped.

    Rows that arrive later than ``delay`` behind the newest one are dropped as well, so it
    has to cover the lag between topic partitions.
    """
    if not enabled:
        return envelope
    reading = F.from_json("value", RAW)
    ident, link, moment = (reading.getField(c) for c in ("id", "link_id", "data_as_of"))
    named = (F.length(ident) > 0) | (F.length(link) > 0)
    place = F.concat_ws("_", F.lit("place"), "topic", "partition", "offset")
    whole = F.coalesce(named & (F.length(moment) > 0), F.lit(False))
    keyed = envelope.withColumn("_key", F.when(whole, dedup_key(ident, link, moment)).otherwise(place))
    return keyed.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def write_routed(paths: TablePaths, strict_status: bool = False, **enrich_options):
    """``foreachBatch`` function: validated topic, dead letters and counters.

    The verdict is computed once and read three times; every output is keyed by batch, so
    the at-least-once replay of a batch leaves one copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        key = batch_key(batch, batch_id)
        validated = ingest.validate(batch, strict_status=strict_status).persist()
        try:
            counts = validated.agg(*ingest.route_counts())
            if counts.first()["processed"] == 0:
                return
            write_batch(ingest.valid_rows(validated, **enrich_options), paths.topic("validated"), key)
            write_batch(ingest.rejected_rows(validated), paths.topic("dead_letters"), key)
            write_batch(counts, paths.counters, key)
        finally:
            validated.unpersist()

    return write


def start_routing(
    envelope: DataFrame,
    paths: TablePaths,
    checkpoint: str,
    once: bool = False,
    interval: str = "5 seconds",
    deduplicate: bool = True,
    delay: str = "24 hours",
    **options,
) -> StreamingQuery:
    """Routes every reading once; ``deduplicate=False`` routes repeated deliveries as well."""
    writer = without_duplicates(envelope, delay, deduplicate).writeStream.foreachBatch(write_routed(paths, **options))
    return with_trigger(writer.option("checkpointLocation", checkpoint), once, interval).start()


def write_polled(paths: TablePaths):
    """``foreachBatch`` function: every fetched row goes to the raw topic, with poll statistics.

    The elapsed time covers fetching and publishing. A failed attempt leaves a row of its own
    with one error and is raised, so that Spark repeats the poll.
    """
    place = f"{paths.root}/poll_statistics"

    def write(batch: DataFrame, batch_id: int) -> None:
        started = time.monotonic()
        rows, key = batch.persist(), batch_key(batch, batch_id)
        try:
            write_batch(ingest.raw_envelope(rows), paths.topic("raw"), key)
            write_batch(ingest.poll_statistics(rows, time.monotonic() - started), place, key)
        except Exception:
            none = batch.sparkSession.createDataFrame([], RAW)
            write_batch(ingest.poll_statistics(none, time.monotonic() - started, errors=1), place, f"{key}_failed_{uuid.uuid4().hex}")
            raise
        finally:
            rows.unpersist()

    return write


def start_polling(
    rows: DataFrame, paths: TablePaths, checkpoint: str, once: bool = False, interval: str = "60 seconds"
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(write_polled(paths))
    return with_trigger(writer.option("checkpointLocation", checkpoint), once, interval).start()

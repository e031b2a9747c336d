"""Readings that arrive behind the watermark, kept in a table of their own instead of dropped unseen."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from roadpulse.sources.sinks import batch_key, write_processed
from roadpulse.streaming.processing import TablePaths, processed_stream, with_trigger

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Groups that links are dealt to. Handing a group to Python costs far more than its rows do, so a
#: link is no group of its own.
LINK_GROUPS = 256


def _whole(values: pd.Series) -> list:
    """Microseconds as whole numbers, None where there is none."""
    return [None if pd.isna(us) else int(us) for us in values.tolist()]


class LateReadings(StatefulProcessor):
    """Marks rows older than the newest one of earlier batches less the delay.

    The state of a link is one number; those of a group's links lie side by side. Rows of the running
    batch do not move the mark, so their order inside the batch does not matter, and a link's rows are
    never held together.
    """

    def __init__(self, delay_s: float, columns: list[str]):
        self.columns = columns
        self.delay_us = int(delay_s * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "links array<string>, at_us array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        before = dict(zip(*self.newest.get())) if self.newest.exists() else {}
        newest = dict(before)
        for pdf in rows:
            marks = {link: before[link] - self.delay_us for link in pdf["state_link"].unique() if link in before}
            late = [link in marks and us is not None and us < marks[link] for link, us in zip(pdf["state_link"], _whole(pdf["at_us"]))]
            timed = pdf[["state_link", "at_us"]].dropna()
            for link, us in zip(timed["state_link"], _whole(timed["at_us"])):
                if link not in newest or us > newest[link]:
                    newest[link] = us
            yield pdf[self.columns].assign(is_late=late)
        if newest != before:
            self.newest.update((list(newest), list(newest.values())))

    def close(self) -> None:
        pass


def with_lateness(processed: DataFrame, delay_s: float) -> DataFrame:
    """The stream with ``is_late``; rows without a link share a mark, rows without a time are on time."""
    link = F.coalesce("link_id", F.lit(""))
    keyed = processed.withColumns({"state_key": F.pmod(F.xxhash64(link), F.lit(LINK_GROUPS)).cast("int"), "state_link": link, "at_us": F.unix_micros("data_as_of_parsed")})
    schema = T.StructType(processed.schema.fields + [T.StructField("is_late", T.BooleanType())])
    return keyed.groupBy("state_key").transformWithStateInPandas(LateReadings(delay_s, processed.columns), outputStructType=schema, outputMode="Append", timeMode="None")


def _with_rocks(spark: SparkSession, start):
    """Arbitrary state needs this state store; a query takes the setting over when it starts."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        return start()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def start_late_split(
    envelope: DataFrame, paths: TablePaths, checkpoint: str, delay_s: float = 24 * 3600, once: bool = False, interval: str = "1 minute"
) -> StreamingQuery:
    """Stores on-time rows and late rows apart; together they are all rows."""
    marked = with_lateness(processed_stream(envelope), delay_s)

    def write(batch: DataFrame, batch_id: int) -> None:
        key = batch_key(batch, batch_id)
        rows = batch.persist()
        try:
            write_processed(rows.where("not is_late").drop("is_late"), paths.on_time, key)
            write_processed(rows.where("is_late").drop("is_late"), paths.late, key)
        finally:
            rows.unpersist()

    writer = marked.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _with_rocks(envelope.sparkSession, lambda: with_trigger(writer, once, interval).start())

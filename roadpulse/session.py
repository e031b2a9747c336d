"""Session helpers: UTC time zone and durable materialisation."""

import datetime as dt
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the time zone (readings carry none), keep generated methods compilable and stored times comparable.

    Parquet keeps no ranges of the older timestamp type, so that time filters would skip no row
    group. The JVM leaves methods over 8000 bytes interpreted, which the wide cleaning projection
    would exceed as one whole-stage method.
    """
    for key, value in _SETTINGS.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a temporary one only where none is named and all tasks run here."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="run-"))
        current = context.getCheckpointDir()
    return current


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage, for frames that several branches read.

    Column pruning makes two branches over one aggregate differ, so Spark would not
    reuse the exchange and would scan the source once per branch.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """A batch frame over all cores, for work that costs far more per row than a shuffle.

    A file is read by as many tasks as it has row groups, however many splits are planned: a
    million rows written at once are one task, and all that follows without a shuffle is too.
    """
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def as_of_column(as_of=None) -> Column:
    """``as_of`` as a timestamp column; the query's own clock when it is not given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
        as_of = as_of.isoformat(sep=" ")
    return F.lit(as_of).cast("timestamp")


def hours_before(as_of, hours: float) -> Column:
    seconds = int(round(hours * 3600))
    return as_of_column(as_of) - F.expr(f"INTERVAL {seconds} SECONDS")

"""Table writers: idempotent appends, keyed upserts, CSV exports."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.lineage import newest_entries
from roadpulse.sources import parts

ANOMALY_COLUMNS = ["link_name", "borough", "speed", "congestion_level", "anomaly_score", "processed_at"]
LINEAGE_COLUMNS = [
    "lineage_id", "phase", "processor", "processor_version", "started_at", "duration_ms", "record_count", "status",
]


def table_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def batch_key(batch: DataFrame, batch_id: int) -> str:
    """Names a micro-batch by its query too: numbers start anew with every checkpoint.

    The query's id is kept in the checkpoint, so a replay gets the same name.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}_{batch_id}" if query else str(batch_id)


def write_batch(df: DataFrame, path: str, batch_id: int | str, partitions: tuple[str, ...] = ()) -> None:
    """Replaces what an earlier attempt of this batch wrote, so a replay leaves one copy."""
    rows = df.withColumn("batch_id", F.lit(str(batch_id)))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id", *partitions)
        .parquet(path)
    )


#: Order of rows in a processed file, and the column with Bloom filters in packed files: a scan of
#: a borough and time, or of one link, then reads few row groups.
CLUSTER, LOOKUPS = ("borough", "data_as_of_parsed"), ("link_id",)


def write_processed(df: DataFrame, path: str, batch_id: int | str) -> None:
    """Processed rows under their batch and day; the day lets a lookback skip whole folders."""
    rows = df.withColumn("processed_date", F.to_date("processed_at")).withColumn("batch_id", F.lit(str(batch_id)))
    parts.append(rows, path, "processed_date", str(batch_id), cluster=tuple(c for c in CLUSTER if c in df.columns))


def compact_processed(spark: SparkSession, path: str, target: int = parts.TARGET_BYTES, **options) -> int:
    """Packs the small files of micro-batches into clustered files of the target size."""
    return parts.compact(spark, path, target, CLUSTER, lookups=LOOKUPS, **options)


def merge_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows, and the old ones whose key they do not replace; null equals null in a key."""
    replaced = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
    same = [old[k].eqNullSafe(replaced[f"_new_{k}"]) for k in keys]
    kept = old.join(replaced, same, "left_anti")
    return new.unionByName(kept, allowMissingColumns=True)


def upsert(new: DataFrame, path: str, keys: list[str], day_of: str) -> None:
    """Keyed upsert into a table by the day of ``day_of``, which is one of the keys or never changes for a key.

    Only the new rows are written; readers take the newest row of a key. Running the same upsert
    again gives the same table.
    """
    rows = new.withColumn("window_date", F.to_date(day_of))
    parts.upsert(rows, path, keys, "window_date", cluster=tuple(keys))


def append_lineage(entry: DataFrame, path: str, batch_id: int | str) -> bool:
    """Writes a lineage row; a failure here never breaks the pipeline that it records."""
    try:
        write_batch(entry.drop("batch_id"), path, batch_id)
        return True
    except Exception as error:  # noqa: BLE001
        print(f"lineage row of batch {batch_id} was not written: {error}")
        return False


def _export_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_anomalies(scored: DataFrame, path: str, limit: int = 20) -> None:
    rows = scored.where("is_anomaly")
    rows = rows.orderBy(F.col("processed_at").desc(), F.col("record_id").desc()).limit(limit)
    _export_csv(rows.select(*ANOMALY_COLUMNS), path)


def export_lineage(entries: DataFrame, path: str, limit: int = 200) -> None:
    _export_csv(newest_entries(entries, limit).select(*LINEAGE_COLUMNS), path)


def publish_raw(envelope: DataFrame, path: str, batch_id: int | str) -> None:
    """Raw topic rows as files, or through ``write_topic`` where a broker is reachable."""
    write_batch(envelope, path, batch_id)


def write_topic(envelope: DataFrame, servers: str, topic: str) -> None:
    """Topic rows to a broker; needs Spark's own Kafka package on the classpath."""
    columns = ["key", "value"] + (["partition"] if "partition" in envelope.columns else [])
    (
        envelope.select(*columns)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


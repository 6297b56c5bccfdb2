"""Partition state and counters kept up to date from a change stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.state import fold_stream, partition_counters, progress_to_state
from tidelog.schemas import CHANGE_EVENTS, PARTITION
from tidelog.session import no_rows
from tidelog.sources import paths
from tidelog.streaming.identity import stream_id


def counter_stream(events: DataFrame) -> DataFrame:
    """Running counters of each partition, as a streaming aggregate (update mode)."""
    return partition_counters(events)


#: Epochs that are read beside the last base before they are merged into a new one.
MAX_EPOCHS = 50


def _finished(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the finished folders of a kind."""
    names = [name for name in paths.child_names(spark, path) if name.startswith(f"{kind}=")]
    return [int(name.split("=")[1]) for name in names if paths.exists(spark, f"{path}/{name}/_SUCCESS")]


def _numbered(folder: str, kind: str, number: int) -> str:
    return f"{folder}/{kind}={number:010d}"


def _folder(spark: SparkSession, path: str, checkpoint: str) -> str:
    return f"{path}/stream={stream_id(spark, checkpoint)}"


def _latest(spark: SparkSession, folder: str, upto: int | None = None) -> DataFrame:
    """The newest row of each partition in the last base and the epochs after it."""
    schema = fold_stream(no_rows(spark, CHANGE_EVENTS)).schema
    bases = [number for number in _finished(spark, folder, "base") if upto is None or number <= upto]
    after = bases[-1] if bases else -1
    epochs = [n for n in _finished(spark, folder, "epoch") if n > after and (upto is None or n <= upto)]
    folders = [_numbered(folder, "base", after)] * bool(bases) + [_numbered(folder, "epoch", n) for n in epochs]
    rows = spark.read.schema(f"{_ddl(schema)}, kept_at bigint").parquet(*folders)
    values = [name for name in schema.names if name not in PARTITION]
    newest = rows.groupBy(*PARTITION).agg(F.max_by(F.struct(*values), "kept_at").alias("_row"), F.max("kept_at").alias("kept_at"))
    return newest.select(*PARTITION, "_row.*", "kept_at")


def _ddl(schema) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema.fields)


def track_state(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start a run that folds all available events into the state at `path`.

    The state of a partition lies in the stream's state store, and a micro-batch
    reads its events once and writes an epoch with the partitions it has touched,
    no others. A replayed batch gives the same epoch. After `MAX_EPOCHS` epochs their
    newest rows become a base, so reading stays bounded.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = _folder(spark, path, checkpoint)
        kept = batch.withColumn("kept_at", F.lit(batch_id).cast("long"))
        kept.write.mode("overwrite").parquet(_numbered(folder, "epoch", batch_id))
        bases = [number for number in _finished(spark, folder, "base") if number < batch_id]
        if batch_id - (bases[-1] if bases else -1) >= MAX_EPOCHS:
            _latest(spark, folder, batch_id).write.mode("overwrite").parquet(_numbered(folder, "base", batch_id))
            for number in _finished(spark, folder, "epoch"):
                # those of the last base stay for readers that have begun with it
                if bases and number <= bases[-1]:
                    paths.delete(spark, _numbered(folder, "epoch", number))

    return (
        fold_stream(events)
        .writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_state(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """State after the last finished batch of the stream with this checkpoint."""
    return progress_to_state(_latest(spark, _folder(spark, path, checkpoint)))

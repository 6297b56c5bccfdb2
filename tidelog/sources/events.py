"""Change-event sources, batch and streaming, always with the explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidelog.schemas import CHANGE_EVENTS, DATA_KINDS, EVENT_KINDS


def read_events(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.schema(CHANGE_EVENTS).format(file_format).load(path)


def stream_events(
    spark: SparkSession, path: str, file_format: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Change events as a stream over files that arrive in a folder."""
    reader = spark.readStream.schema(CHANGE_EVENTS).format(file_format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


#: What a Kafka reader gives for each record, as far as it is used here.
RECORD = "key binary, value binary, topic string, partition int, offset bigint"


def decode_records(records: DataFrame) -> DataFrame:
    """Records of a topic as change events, each with a `reject_reason` if it is none.

    The value is an event as JSON. What it leaves out comes from the record: the bucket
    from the topic, the partition, the arrival number from the offset, and the key. A
    record without a value is the removal of its key at its offset. A rejected record
    keeps what could be read of it, with its key, value, partition and offset as
    `record`, so nothing is lost and nothing stops.
    """
    if records.isStreaming:
        # a topic has few partitions, and a file of one row group is one task's
        records = records.repartition(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    names = CHANGE_EVENTS.names
    kinds = ", ".join(f"'{kind}'" for kind in EVENT_KINDS)
    data_kinds = ", ".join(f"'{kind}'" for kind in DATA_KINDS)
    schema = StructType([*[StructField(f.name, f.dataType) for f in CHANGE_EVENTS], StructField("_corrupt", StringType())])
    text, key = F.col("value").cast("string"), "nullif(CAST(key AS STRING), '')"
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    given = {
        "bucket": "coalesce(e.bucket, topic)",
        "partition_id": "coalesce(e.partition_id, CAST(partition AS SMALLINT))",
        "arrival": "coalesce(e.arrival, offset)",
        "kind": "IF(value IS NULL, 'remove', e.kind)",
        "seqno": "IF(value IS NULL, offset, e.seqno)",
        "key": f"coalesce(e.key, {key})",
    }
    # a filter on the reason would else go below this and parse the value for each field it looks at
    events = records.select("*", F.explode(F.array(parsed)).alias("e")).selectExpr(
        *[f"{given.get(name, f'e.{name}')} AS {name}" for name in names],
        "named_struct('key', key, 'value', value, 'topic', topic, 'partition', partition, 'offset', offset) AS record",
        "e._corrupt AS _corrupt",
    )
    reason = (
        "CASE WHEN _corrupt IS NOT NULL THEN 'not an event'"
        f" WHEN kind IS NULL OR kind NOT IN ({kinds}) THEN 'unknown kind'"
        " WHEN bucket IS NULL OR partition_id IS NULL OR partition_id < 0 THEN 'no partition'"
        f" WHEN kind IN ({data_kinds}) AND (key IS NULL OR seqno IS NULL) THEN 'no key or seqno' END"
    )
    return events.withColumn("reject_reason", F.expr(reason)).drop("_corrupt")


def accepted_events(decoded: DataFrame) -> DataFrame:
    return decoded.where("reject_reason IS NULL").select(*CHANGE_EVENTS.names)


def rejected_records(decoded: DataFrame) -> DataFrame:
    """The records that are no events, as they came, and why."""
    return decoded.where("reject_reason IS NOT NULL").select("record.*", "reject_reason")


def stream_kafka_events(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Decoded records of a Kafka topic as a stream (needs the Kafka connector).

    `capture_stream` takes it as it is and sets rejected records aside.
    """
    return decode_records(
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )

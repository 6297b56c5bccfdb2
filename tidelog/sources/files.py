"""Reading and writing filter rows, mutations and rollback logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidelog.functions.scalars import rollback_fields
from tidelog.schemas import FILTER, MUTATIONS, ROLLBACK_LOG
from tidelog.session import no_rows
from tidelog.sources.paths import matches

FORMATS = ["parquet", "orc", "json", "csv"]
WITH_CONNECTOR = ["avro"]
TEXT_FORMATS = ["json", "csv"]
BINARY_COLUMN = "content"


def _check_format(file_format: str) -> None:
    if file_format not in FORMATS + WITH_CONNECTOR:
        raise ValueError(f"unsupported format: {file_format}")


def _storable(rows: DataFrame, file_format: str) -> DataFrame:
    """Text formats hold binary content as base64."""
    if file_format in TEXT_FORMATS and BINARY_COLUMN in rows.columns:
        return rows.withColumn(BINARY_COLUMN, F.base64(BINARY_COLUMN))
    return rows


def read_rows(
    spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet"
) -> DataFrame:
    """Rows of a known schema from a path or glob; a missing path is an error."""
    _check_format(file_format)
    if file_format not in TEXT_FORMATS or BINARY_COLUMN not in schema.names:
        return spark.read.schema(schema).format(file_format).load(path)
    stored = StructType(
        [StructField(f.name, StringType()) if f.name == BINARY_COLUMN else f for f in schema.fields]
    )
    rows = spark.read.schema(stored).format(file_format).load(path)
    return rows.withColumn(BINARY_COLUMN, F.unbase64(BINARY_COLUMN))


def read_filter(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return read_rows(spark, path, FILTER, file_format)


def read_filter_or_empty(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """As `read_filter`; no rows where nothing matches, as on the very first run."""
    if not matches(spark, path):
        return no_rows(spark, FILTER)
    return read_filter(spark, path, file_format)


def read_mutations(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return read_rows(spark, path, MUTATIONS, file_format)


def read_mutations_or_empty(
    spark: SparkSession, path: str, file_format: str = "parquet"
) -> DataFrame:
    if not matches(spark, path):
        return no_rows(spark, MUTATIONS)
    return read_mutations(spark, path, file_format)


def write_rows(rows: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Write rows; fails when the path exists."""
    _check_format(file_format)
    _storable(rows, file_format).write.mode("errorifexists").format(file_format).save(path)


def read_rollback_log(
    spark: SparkSession, path: str | Sequence[str], run_base: str | None = None
) -> DataFrame:
    """Rollback entries from text files below `bucket=…/pgroup=…` folders.

    Each line is `partition,uuid,seqno`; further fields are ignored, and a bad
    number aborts the query. With `run_base` the paths are `run=…` folders below it,
    and a column `run` says which.
    """
    reader, more = spark.read, []
    if run_base:
        reader, more = reader.option("basePath", run_base), ["run"]
    columns = ["value", *more, "bucket"]
    lines = reader.schema(f"{' string, '.join(columns)} string, pgroup int").text(path)
    partition_id, uuid, seqno = rollback_fields(F.col("value"))
    return lines.select(
        "bucket",
        "pgroup",
        partition_id.alias("partition_id"),
        uuid.alias("partition_uuid"),
        seqno.alias("seqno"),
        *more,
    )


def read_rollback_log_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """As `read_rollback_log`; a missing log means nothing is rolled back."""
    if not matches(spark, path):
        return no_rows(spark, ROLLBACK_LOG)
    return read_rollback_log(spark, path)


def write_rollback_log(entries: DataFrame, path: str, mode: str = "errorifexists") -> None:
    line = F.concat_ws(",", "partition_id", "partition_uuid", "seqno").alias("value")
    entries.select(line, "bucket", "pgroup").write.mode(mode).partitionBy("bucket", "pgroup").text(path)

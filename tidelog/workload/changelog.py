"""Change logs derived from the given tables, as inputs of the registered queries.

`events` becomes the log of bucket `default` (16 partitions, 4 groups) and
`orders` that of bucket `orders` (32 partitions, 8 groups).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.filters import latest_per_key
from tidelog.operators.ranges import high_seqnos, plan_ranges
from tidelog.plans.compaction import compact_filter
from tidelog.plans.backup import as_events
from tidelog.schemas import FILTER, MUTATIONS, ROLLBACK_LOG

LEVEL_SPLIT = "2024-01-16 00:00:00"
BRANCH_SPLIT = "2024-01-11 00:00:00"
PARTITIONS, GROUPS = 16, 4
ORDER_PARTITIONS, ORDER_GROUPS = 32, 8
ORDER_LEVEL_SPLIT = "1997-01-01 00:00:00"


SCHEMAS = {
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
        " value double, props string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All mutations of bucket `default`, old and new, with level and time.

    The bucket is a column value, as it comes from storage, not a constant.
    """
    return (
        table(spark, sf_dir, "events")
        .selectExpr("*", f"user_id % {PARTITIONS} AS part")
        .selectExpr(
            "IF(event_id IS NOT NULL, 'default', NULL) AS bucket",
            f"int(part div {PARTITIONS // GROUPS}) AS pgroup",
            "smallint(part) AS partition_id",
            f"part * 10 + IF(ts < timestamp_ntz'{BRANCH_SPLIT}', 1, 2) AS partition_uuid",
            "event_id AS seqno",
            "concat('k', user_id, ':', event_id % 20) AS key",
            "CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'INSERT'"
            " ELSE 'UPDATE' END AS rec_type",
            "binary(props) AS content",
            "0 AS expiration",
            "1L AS revision_seqno",
            "0 AS lock_time",
            "event_id AS cas",
            "0 AS flags",
            "ts",
        )
    )


def old_changes(spark, sf_dir) -> DataFrame:
    return changes(spark, sf_dir).where(F.col("ts") < at(LEVEL_SPLIT))


def new_changes(spark, sf_dir) -> DataFrame:
    return changes(spark, sf_dir).where(F.col("ts") >= at(LEVEL_SPLIT))


def new_filter(spark, sf_dir) -> DataFrame:
    """Raw filter rows of the newest run."""
    return new_changes(spark, sf_dir).select(*FILTER.names)


def mainline_filter(spark, sf_dir) -> DataFrame:
    """Mainline filter before the newest run: one row per key."""
    return latest_per_key(old_changes(spark, sf_dir).select(*FILTER.names))


def mutations(spark, sf_dir) -> DataFrame:
    return changes(spark, sf_dir).select(*MUTATIONS.names)


def rollback_log(spark, sf_dir) -> DataFrame:
    """Rollback entries, many per branch; they hit rows of both levels."""
    hits_new = "partition_id % 4 = 0 AND ts >= timestamp_ntz'2024-01-25 00:00:00'"
    hits_old = (
        "partition_id % 4 = 1 AND ts >= timestamp_ntz'2024-01-08 00:00:00'"
        f" AND ts < timestamp_ntz'{BRANCH_SPLIT}'"
    )
    hit = changes(spark, sf_dir).where(f"({hits_new}) OR ({hits_old})")
    return hit.select(*ROLLBACK_LOG.names)


def compacted(spark, sf_dir) -> DataFrame:
    return compact_filter(
        mainline_filter(spark, sf_dir), new_filter(spark, sf_dir), rollback_log(spark, sf_dir)
    )


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of bucket `orders`.

    Levels go by date and seqnos by order number, so new rows often have lower
    seqnos than old ones. Groups 4 to 7 have no new rows at all.
    """
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("*", f"o_custkey % {ORDER_PARTITIONS} AS part")
        .selectExpr("*", f"int(part div {ORDER_PARTITIONS // ORDER_GROUPS}) AS pgroup")
        .selectExpr(
            "IF(o_orderkey IS NOT NULL, 'orders', NULL) AS bucket",
            "pgroup",
            "smallint(part) AS partition_id",
            "part * 10 + 1 AS partition_uuid",
            "o_orderkey AS seqno",
            "concat('c', o_custkey) AS key",
            "IF(o_orderstatus = 'F', 'DELETE', 'UPDATE') AS rec_type",
            "binary(o_orderpriority) AS content",
            f"IF(o_orderdate >= timestamp_ntz'{ORDER_LEVEL_SPLIT}' AND pgroup < 4, 'l0', 'l1')"
            " AS level",
            "o_orderdate AS ts",
        )
    )


def order_rollback_log(spark, sf_dir) -> DataFrame:
    """Entries in groups with new rows (partition 3) and without (partition 19)."""
    hit = F.col("partition_id").isin(3, 19) & (F.col("ts") >= at("2000-06-01 00:00:00"))
    return order_changes(spark, sf_dir).where(hit).select(*ROLLBACK_LOG.names)


def high(spark, sf_dir) -> DataFrame:
    """Current high seqnos; partition 5 has not moved since the last run."""
    moved = (F.col("partition_id") != 5) | (F.col("ts") < at(LEVEL_SPLIT))
    return high_seqnos(changes(spark, sf_dir).where(moved))


def known_state(spark, sf_dir) -> DataFrame:
    """What the last run saw of each partition; partition 14 is not known yet."""
    return (
        old_changes(spark, sf_dir)
        .where(F.col("partition_id") != 14)
        .groupBy("bucket", "partition_id")
        .agg(
            F.max_by("partition_uuid", "seqno").alias("uuid"),
            F.max("seqno").alias("last_seen_seqno"),
        )
        .select(
            "bucket",
            "partition_id",
            F.array(F.struct("uuid", F.lit(0).cast("long").alias("seqno"))).alias("failover_log"),
            "last_seen_seqno",
        )
    )


def ranges(spark, sf_dir) -> DataFrame:
    return plan_ranges(high(spark, sf_dir), known_state(spark, sf_dir))


def data_stream(spark, sf_dir, rows: DataFrame | None = None) -> DataFrame:
    """All changes, or these, as change-stream events; an INSERT stands for a snapshot marker."""
    return as_events(
        (changes(spark, sf_dir) if rows is None else rows)
        .selectExpr(
            "*",
            "CASE rec_type WHEN 'DELETE' THEN 'remove' WHEN 'INSERT' THEN 'marker'"
            " ELSE 'mutation' END AS kind",
            "seqno AS arrival",
        )
        .selectExpr(
            "*",
            "IF(kind = 'marker', seqno, NULL) AS snapshot_start_seqno",
            "IF(kind = 'marker', seqno + 9, NULL) AS snapshot_end_seqno",
        )
    )


def control_stream(planned: DataFrame) -> DataFrame:
    """Answers to the range requests: opened, rolled back, or closed at the end."""
    opened = planned.where("partition_id % 4 <> 2").selectExpr(
        "bucket",
        "partition_id",
        "-1L AS arrival",
        "'opened' AS kind",
        "array(named_struct('uuid', uuid, 'seqno', 0L)) AS failover_log",
    )
    ended = planned.where("partition_id % 4 < 2").selectExpr(
        "bucket", "partition_id", "end_seqno + 1 AS arrival", "'end' AS kind", "'OK' AS reason"
    )
    rolled_back = planned.where("partition_id % 4 = 2").selectExpr(
        "bucket", "partition_id", "0L AS arrival", "'rollback' AS kind", "start_seqno div 2 AS seqno"
    )
    return (
        as_events(opened).unionByName(as_events(ended)).unionByName(as_events(rolled_back))
    )

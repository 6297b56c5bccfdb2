"""Range planning: which seqnos of each partition are new since the last run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.functions.records import checked_kind
from tidelog.functions.scalars import current_uuid
from tidelog.schemas import DATA_KINDS, EVENT_KINDS, PARTITION, RANGES
from tidelog.session import Lookup

RANGE_COLUMNS = RANGES.names


def checked_events(events: DataFrame) -> DataFrame:
    """Events of known kinds; an unknown kind aborts the query."""
    return events.withColumn("kind", checked_kind(EVENT_KINDS))


def data_events(events: DataFrame) -> DataFrame:
    """Mutation and removal events only."""
    return events.where(F.col("kind").isin(*DATA_KINDS))


def assert_kind(events: DataFrame, kind: str) -> DataFrame:
    """Events of one kind; any other kind aborts the query."""
    return events.withColumn("kind", checked_kind([kind]))


def high_seqnos(rows: DataFrame) -> DataFrame:
    """Highest seqno of each partition."""
    return (
        rows.where(F.col("seqno").isNotNull())
        .groupBy(*PARTITION)
        .agg(F.max("seqno").alias("high_seqno"))
    )


def partition_count(rows: DataFrame) -> DataFrame:
    """Number of active partitions of each bucket."""
    return rows.groupBy("bucket").agg(F.countDistinct("partition_id").alias("num_partitions"))


def mainline(catalog: DataFrame) -> DataFrame:
    """Latest known state of each partition over all runs."""
    latest = Window.partitionBy(*PARTITION).orderBy(F.desc("run_number"))
    return (
        catalog.withColumn("_rank", F.row_number().over(latest))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def snapshot_partition(catalog: DataFrame, snapshot_id: str, partition_id: int) -> DataFrame:
    """State of one partition under a named snapshot."""
    return catalog.where(
        (F.col("snapshot_id") == snapshot_id) & (F.col("partition_id") == partition_id)
    )


def _positions(high: DataFrame, known: DataFrame) -> DataFrame:
    """Start and end of every partition; an unknown partition starts at 0."""
    seen = known.select(
        *PARTITION,
        current_uuid(F.col("failover_log")).alias("_uuid"),
        F.col("last_seen_seqno").alias("_seen"),
    )
    return high.join(seen, PARTITION, "left").select(
        *PARTITION,
        F.coalesce("_uuid", F.lit(0).cast("long")).alias("uuid"),
        F.coalesce("_seen", F.lit(0).cast("long")).alias("start_seqno"),
        F.col("high_seqno").alias("end_seqno"),
    )


def plan_ranges(high: DataFrame, known: DataFrame) -> DataFrame:
    """Range (last seen, current high] of every partition that moved.

    A high seqno below the last seen one is a move too: asking for that range is
    what makes the source answer with a rollback.
    """
    return (
        _positions(high, known)
        .where(F.col("end_seqno") != F.col("start_seqno"))
        .withColumn("snapshot_start_seqno", F.col("start_seqno"))
        .withColumn("snapshot_end_seqno", F.col("start_seqno"))
        .select(*RANGE_COLUMNS)
    )


def range_outcomes(high: DataFrame, known: DataFrame) -> DataFrame:
    """How many partitions are unchanged, ahead of, or behind their last seqno."""
    outcome = (
        F.when(F.col("end_seqno") == F.col("start_seqno"), "unchanged")
        .when(F.col("end_seqno") < F.col("start_seqno"), "behind")
        .otherwise("changed")
    )
    return (
        _positions(high, known)
        .groupBy(outcome.alias("outcome"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def capture_ranges(events: DataFrame, ranges: DataFrame | Lookup) -> DataFrame:
    """Events inside the range of their partition: above the start, up to the end.

    The outermost bounds of all ranges go to the scan as plain limits on seqno,
    so files that hold only older events are skipped.
    """
    lookup = ranges if isinstance(ranges, Lookup) else Lookup(ranges)
    outer = lookup.side.agg(F.min("start_seqno").alias("low"), F.max("end_seqno").alias("high"))
    bounds = outer.first()
    if bounds["low"] is None:
        return events.where("false")
    within = events.where((F.col("seqno") > bounds["low"]) & (F.col("seqno") <= bounds["high"]))
    inside = "l.seqno > r.start_seqno AND l.seqno <= r.end_seqno"
    return lookup.join(within, PARTITION, "left_semi", inside)


def retry_open_ranges(state: DataFrame, ranges: DataFrame) -> DataFrame:
    """Ranges that resume the partitions still open, from what they last saw."""
    still_open = state.where(F.col("state") == "Open").select(
        *PARTITION, "last_seen_seqno", "last_snapshot_start_seqno", "last_snapshot_end_seqno"
    )

    def resumed(seen: str, planned: str) -> Column:
        return F.coalesce(seen, planned).alias(planned)

    return ranges.join(still_open, PARTITION).select(
        *PARTITION,
        "uuid",
        resumed("last_seen_seqno", "start_seqno"),
        "end_seqno",
        resumed("last_snapshot_start_seqno", "snapshot_start_seqno"),
        resumed("last_snapshot_end_seqno", "snapshot_end_seqno"),
    )


def retry_stale_ranges(state: DataFrame, requested: DataFrame) -> DataFrame:
    """The requested ranges, aborting unless each partition exists and is stale."""
    known = state.select(*PARTITION, F.col("state").alias("_state"))
    problem = F.concat(
        F.lit("partition is not stale: "),
        F.col("bucket"),
        F.lit("/"),
        F.col("partition_id").cast("string"),
        F.lit(" "),
        F.coalesce("_state", F.lit("does not exist")),
    )
    checked = F.when(F.col("_state").eqNullSafe("Stale"), F.col("uuid")).otherwise(
        F.raise_error(problem).cast("long")
    )
    return requested.join(known, PARTITION, "left").withColumn("uuid", checked).select(*RANGE_COLUMNS)


def stale_restart_ranges(state: DataFrame, ranges: DataFrame) -> DataFrame:
    """Ranges that restart the stale partitions just below their rollback seqno.

    The row at the rollback seqno itself is cut, so it must be streamed again.
    """
    stale = state.where(F.col("state") == "Stale").select(*PARTITION, "rollback_seqno")
    restart = F.greatest(F.col("rollback_seqno") - 1, F.lit(0))
    return ranges.join(stale, PARTITION).select(
        *PARTITION,
        "uuid",
        restart.alias("start_seqno"),
        "end_seqno",
        restart.alias("snapshot_start_seqno"),
        restart.alias("snapshot_end_seqno"),
    )

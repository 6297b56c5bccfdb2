"""Filter-log operators: deduplication, rollback cuts, superseded keys, gating.

The scope of a key is (bucket, pgroup, key); the scope of a rollback entry is
(bucket, partition_id, partition_uuid). Both stand in every grouping and join,
since one job covers all buckets and groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalars import record_code, record_name
from tidelog.schemas import BRANCH, FILTER, GROUP, GROUP_KEY, SEQNO_TUPLE
from tidelog.session import Lookup

FILTER_COLUMNS = FILTER.names


def latest_per_key(filter_rows: DataFrame) -> DataFrame:
    """The whole row with the highest seqno of each key.

    Partial aggregation collapses repeated keys before the shuffle, so a hot key
    reaches its reducer as one row per map task. Buffers are fixed-width (the
    record type travels as a code), which keeps the aggregate hash-based. Where
    two history branches give one key the same seqno, either row may win.
    """
    return (
        filter_rows.groupBy(*GROUP_KEY)
        .agg(
            F.max_by("partition_id", "seqno").alias("partition_id"),
            F.max_by("partition_uuid", "seqno").alias("partition_uuid"),
            F.max_by(record_code(), "seqno").alias("_code"),
            F.max("seqno").alias("seqno"),
        )
        .withColumn("rec_type", record_name("_code"))
        .select(*FILTER_COLUMNS)
    )


def latest_seqno_per_partition_key(filter_rows: DataFrame) -> DataFrame:
    """Highest seqno per (partition, key), without the branch."""
    return filter_rows.groupBy("bucket", "partition_id", "key").agg(F.max("seqno").alias("seqno"))


def distinct_keys(filter_rows: DataFrame) -> DataFrame:
    return filter_rows.select(*GROUP_KEY).distinct()


def distinct_seqno_tuples(filter_rows: DataFrame) -> DataFrame:
    return filter_rows.select(*SEQNO_TUPLE).distinct()


def rollback_cuts(rollback_log: DataFrame) -> DataFrame:
    """One cut per history branch; the lowest seqno wins over duplicates."""
    return rollback_log.groupBy("pgroup", *BRANCH).agg(F.min("seqno").alias("cut"))


def active_groups(new_filter: DataFrame) -> DataFrame:
    """Groups with new filter rows: the only ones that need filter compaction."""
    return new_filter.select(*GROUP).distinct()


def drop_rolled_back(rows: DataFrame, cuts: Lookup | DataFrame) -> DataFrame:
    """Keep rows strictly below the cut of their branch, or without a cut."""
    lookup = cuts if isinstance(cuts, Lookup) else Lookup(cuts)
    return lookup.join(rows, BRANCH, "left_anti", "l.seqno >= r.cut")


def drop_superseded(old_filter: DataFrame, new_filter: DataFrame) -> DataFrame:
    """Old rows whose key is not among the new rows, whatever the seqnos."""
    return old_filter.join(new_filter.select(*GROUP_KEY), GROUP_KEY, "left_anti").select(
        *old_filter.columns
    )


def merge_newer(old_filter: DataFrame, new_filter: DataFrame) -> DataFrame:
    """New rows plus the old rows they do not supersede, as one full outer join.

    Both sides hold at most one row per key, so no key can skew the join, and
    each side is read once. Equals `drop_superseded(old, new)` ∪ `new`.
    """
    same_key = " AND ".join(f"o.{name} = n.{name}" for name in GROUP_KEY)
    return (
        old_filter.alias("o")
        .join(new_filter.alias("n"), F.expr(same_key), "full_outer")
        .selectExpr(
            *[f"IF(n.key IS NOT NULL, n.{name}, o.{name}) AS {name}" for name in FILTER_COLUMNS]
        )
    )

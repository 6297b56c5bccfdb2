"""Partition state, progress and counters, folded from change-stream events.

`fold_events` reduces events to one progress row per partition, and
`combine_progress` merges progress rows. Every "latest" value travels with the
arrival number it was seen at, so merging does not depend on order: batch and
streaming give the same state from the same functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalars import state_name
from tidelog.operators.ranges import checked_events
from tidelog.schemas import COUNTERS, PARTITION, PARTITION_STATE
from tidelog.session import Lookup

# Which event kinds each counter counts.
COUNTED_KINDS = {
    "num_snapshots": "marker",
    "num_mutations": "mutation",
    "num_deletions": "remove",
    "num_retries_reason_open": "retry_open",
    "num_retries_reason_stale": "retry_stale",
}

# Values that hold the latest event of some kinds, with the arrival column each shares.
LATEST = {
    "state_code": "state_at",
    "last_seen_seqno": "seen_at",
    "last_snapshot_start_seqno": "snapshot_at",
    "last_snapshot_end_seqno": "snapshot_at",
    "rollback_seqno": "rollback_at",
}
# The same for variable-width values, kept out of the hash aggregate over all events.
LATEST_TEXT = {"failover_log": "failover_at", "reason": "reason_at"}


# Kinds whose seqno is the position a partition has reached.
POSITION_KINDS = ["mutation", "remove", "requested", "retry_stale"]
# State code (position in PARTITION_STATES) that an event leaves its partition in.
STATE_OF_KIND = "CASE kind WHEN 'end' THEN 1Y WHEN 'rollback' THEN 2Y ELSE 0Y END"


def _at(*kinds: str) -> str:
    """Arrival of events of these kinds, null for others."""
    return f"IF(kind IN ({', '.join(repr(kind) for kind in kinds)}), arrival, NULL)"


def _latest(values: dict[str, str], at: str, at_name: str) -> list[Column]:
    """Value at the highest arrival, for each name, and that arrival."""
    return [
        *[F.expr(f"max_by({value}, {at}) AS {name}") for name, value in values.items()],
        F.expr(f"max({at}) AS {at_name}"),
    ]


def _counters() -> list[Column]:
    return [F.expr(f"count_if(kind = '{kind}') AS {name}") for name, kind in COUNTED_KINDS.items()]


def _latest_numbers() -> list[Column]:
    snapshot = ["last_snapshot_start_seqno", "last_snapshot_end_seqno"]
    return [
        *_latest({"state_code": STATE_OF_KIND}, "arrival", "state_at"),
        *_latest({"last_seen_seqno": "seqno"}, _at(*POSITION_KINDS), "seen_at"),
        *_latest({name: name.removeprefix("last_") for name in snapshot}, _at("marker"), "snapshot_at"),
        *_latest({"rollback_seqno": "seqno"}, _at("rollback"), "rollback_at"),
    ]


def _latest_texts() -> list[Column]:
    return [
        *_latest({"failover_log": "failover_log"}, _at("opened"), "failover_at"),
        *_latest({"reason": "reason"}, _at("end"), "reason_at"),
    ]


def partition_counters(events: DataFrame) -> DataFrame:
    """Snapshots, mutations, deletions and retries of each partition."""
    return events.groupBy(*PARTITION).agg(*_counters())


def counters_map(counters: DataFrame) -> DataFrame:
    """Counters as one map of name to value per partition."""
    pairs = [part for name in COUNTERS for part in (F.lit(name), F.col(name))]
    return counters.select(*PARTITION, F.create_map(*pairs).alias("stats"))


def counters_for(ranges: DataFrame, counters: DataFrame) -> DataFrame:
    """Counters of every requested partition, zero where nothing arrived."""
    return ranges.select(*PARTITION).join(counters, PARTITION, "left").select(
        *PARTITION, *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in COUNTERS]
    )


def total_mutations(counters: DataFrame) -> DataFrame:
    return counters.agg(F.coalesce(F.sum("num_mutations"), F.lit(0)).alias("total_mutations"))


def fold_events(events: DataFrame, control: DataFrame | None = None) -> DataFrame:
    """One progress row per partition.

    All values over the full stream are fixed-width, so the aggregate is
    hash-based and a hot partition shrinks to one row per map task. Reason and
    failover log come from the rare control events only. Where these are at hand as
    `control`, which then holds all that are in `events`, the stream is read once.
    """
    numbers = checked_events(events).groupBy(*PARTITION).agg(*_latest_numbers(), *_counters())
    texts = (events if control is None else control).where(F.col("kind").isin("opened", "end")).groupBy(*PARTITION).agg(*_latest_texts())
    return numbers.join(texts, PARTITION, "left")


def fold_stream(events: DataFrame) -> DataFrame:
    """`fold_events` as one aggregate, as a stream keeps it: a row of state per partition.

    Each event is read once. A batch of a stream is small, so the sort that the
    variable-width values ask for does not matter here.
    """
    return checked_events(events).groupBy(*PARTITION).agg(*_latest_numbers(), *_counters(), *_latest_texts())


def combine_progress(progress: DataFrame) -> DataFrame:
    """Merge progress rows of the same partition; latest values win, counters add."""
    latest = {**LATEST, **LATEST_TEXT}
    return progress.groupBy(*PARTITION).agg(
        *[F.max_by(name, at).alias(name) for name, at in latest.items()],
        *[F.max(at).alias(at) for at in dict.fromkeys(latest.values())],
        *[F.sum(name).alias(name) for name in COUNTERS],
    )


def progress_to_state(progress: DataFrame) -> DataFrame:
    """Progress rows as partition states: Open, Closed (with reason) or Stale."""
    only_in = {"reason": "Closed", "rollback_seqno": "Stale"}
    return progress.withColumn("state", state_name("state_code")).selectExpr(
        *[
            f"IF(state = '{only_in[name]}', {name}, NULL) AS {name}" if name in only_in else name
            for name in PARTITION_STATE.names
        ]
    )


def partition_state(events: DataFrame, control: DataFrame | None = None) -> DataFrame:
    return progress_to_state(fold_events(events, control))


def partitions_in(state: DataFrame, name: str) -> DataFrame:
    """Partitions that are Open, Closed or Stale."""
    return state.where(F.col("state") == name)


def attach_state(changes: DataFrame, state: DataFrame) -> DataFrame:
    """Captured changes with the final state of their partition, once closed."""
    closed = partitions_in(state, "Closed").select(
        *PARTITION, "state", "last_seen_seqno", "reason"
    )
    return Lookup(closed).join(changes, PARTITION, "left")


def rollback_from_stale(state: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rollback-log rows of the stale partitions, on the branch they asked for."""
    stale = partitions_in(state, "Stale").select(*PARTITION, "rollback_seqno")
    return ranges.join(stale, PARTITION).select(
        *PARTITION,
        F.col("uuid").alias("partition_uuid"),
        F.col("rollback_seqno").alias("seqno"),
    )

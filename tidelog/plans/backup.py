"""One incremental backup: plan ranges, capture them, record the snapshot."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.records import mutation_rows, stamp_uuid
from tidelog.functions.scalars import current_uuid
from tidelog.operators.ranges import (
    capture_ranges,
    data_events,
    high_seqnos,
    mainline,
    plan_ranges,
    retry_open_ranges,
    retry_stale_ranges,
    stale_restart_ranges,
)
from tidelog.operators.state import (
    combine_progress,
    fold_events,
    partition_state,
    partitions_in,
    progress_to_state,
    rollback_from_stale,
)
from tidelog.plans.store import Bucket, ChangeLogStore, checked_name, with_group
from tidelog.schemas import CATALOG, CHANGE_EVENTS, DATA_KINDS, PARTITION, RANGES
from tidelog.session import Lookup, stored


def read_catalog(store: ChangeLogStore) -> DataFrame:
    """Partition states of all snapshots, none before the first backup."""
    return store.catalog()


def as_events(rows: DataFrame) -> DataFrame:
    """Rows with all columns of a change event, null where they have none."""
    return rows.selectExpr(
        *[
            field.name
            if field.name in rows.columns
            else f"CAST(NULL AS {field.dataType.simpleString()}) AS {field.name}"
            for field in CHANGE_EVENTS.fields
        ]
    )


def request_events(ranges: DataFrame) -> DataFrame:
    """One event per requested range; it sets the position to the range's start."""
    return as_events(
        ranges.selectExpr(
            *PARTITION,
            f"{-(2**63) + 1}L AS arrival",
            "'requested' AS kind",
            "start_seqno AS seqno",
        )
    )


def accepted_answers(ranges: DataFrame, captured: DataFrame) -> DataFrame:
    """Answers of a source that accepts every range and sends it whole."""
    branch = captured.groupBy(*PARTITION).agg(
        F.max_by("partition_uuid", "seqno").alias("_uuid"), F.max("arrival").alias("_last")
    )
    answered = ranges.join(branch, PARTITION, "left")
    opened = answered.selectExpr(
        *PARTITION,
        f"{-(2**63) + 2}L AS arrival",
        "'opened' AS kind",
        "array(named_struct('uuid', coalesce(_uuid, uuid), 'seqno', 0L)) AS failover_log",
    )
    ended = answered.selectExpr(
        *PARTITION, "coalesce(_last, 0L) + 1 AS arrival", "'end' AS kind", "'OK' AS reason"
    )
    return as_events(opened).unionByName(as_events(ended))


def opened_branches(ranges: DataFrame, answers: DataFrame, known: DataFrame) -> DataFrame:
    """(bucket, partition, uuid): the branch each partition was opened on.

    The newest entry of the failover log that came with the answer, or the requested
    branch if none came. A partition that was sent back and is opened on its old
    branch again would have its new rows cut with the old ones, so that aborts.
    """
    opened = (
        answers.where("kind = 'opened'")
        .groupBy(*PARTITION)
        .agg(F.max_by("failover_log", "arrival").alias("_log"))
        .withColumn("_opened", current_uuid(F.col("_log")))
    )
    before = known.where("state = 'Stale'").select(*PARTITION, current_uuid(F.col("failover_log")).alias("_old"))
    unchanged = F.expr("_old IS NOT NULL AND coalesce(_opened, uuid) = _old")
    return (
        ranges.join(opened, PARTITION, "left")
        .join(before, PARTITION, "left")
        .select(
            *PARTITION,
            F.when(unchanged, F.raise_error(F.lit("partition opened on the branch that was rolled back")).cast("long"))
            .otherwise(F.coalesce("_opened", "uuid"))
            .alias("uuid"),
        )
    )


def catalog_rows(state: DataFrame, known: DataFrame) -> DataFrame:
    """States to record. A stale partition goes back to just below its rollback seqno."""
    before = known.select(*PARTITION, F.col("failover_log").alias("_failover_log"))
    return (
        state.join(before, PARTITION, "left")
        .withColumn("failover_log", F.coalesce("failover_log", "_failover_log"))
        .withColumn(
            "last_seen_seqno",
            F.expr("IF(state = 'Stale', greatest(rollback_seqno - 1, 0L), last_seen_seqno)"),
        )
        .drop("_failover_log")
    )


#: Gives the data and control events that the source sends for some ranges, in a round.
Source = Callable[[DataFrame, int], DataFrame]
#: Arrival numbers of one round; those that a source gives must stay below half of it.
ROUND = 1 << 48


@dataclass(frozen=True)
class Streamed:
    """What all rounds of a run have brought."""

    captured: DataFrame
    state: DataFrame
    rollbacks: DataFrame


def _round_requests(todo: DataFrame, attempt: int) -> DataFrame:
    """One event per range asked for, before all answers of its round."""
    return as_events(
        todo.selectExpr(
            *PARTITION, f"{attempt * ROUND - ROUND // 2}L AS arrival", "reason AS kind", "start_seqno AS seqno"
        )
    )


def stream_rounds(source: Source, ranges: DataFrame, known: DataFrame, max_retries: int) -> Streamed:
    """Ask for ranges, and again for what is still open or was sent back, until nothing is.

    A partition that is still open resumes from what it last saw. One that was sent
    back restarts below its rollback seqno, and what it had on the branch it asked for
    goes to the rollback log, rows of earlier rounds included. Each request counts as
    an event, so retries show in the partition's counters. After `max_retries` rounds
    what is left keeps its state. What a source sends is stored before it is used, so
    it is asked once for each range and round.
    """
    todo = stored(ranges.withColumn("reason", F.lit("requested")))
    # the range of every partition, on the branch that it was last opened on
    spec, before = todo.drop("reason"), known
    captured, rollbacks, progress = [], [], None
    for attempt in range(max_retries + 1):
        sent = stored(as_events(source(todo.drop("reason"), attempt)))
        data = capture_ranges(data_events(sent), todo.drop("reason"))
        control = stored(sent.where(~F.col("kind").isin(*DATA_KINDS)))
        refused = Lookup(control.where("kind = 'rollback'").select(*PARTITION).distinct())
        data = refused.join(data, PARTITION, "left_anti")
        accepted = refused.join(todo, PARTITION, "left_anti", spread=["end_seqno"])
        branches = stored(opened_branches(accepted, control, before))
        data = stamp_uuid(data, branches, keep=True)
        captured.append(data)
        events = as_events(data).unionByName(control).withColumn("arrival", F.col("arrival") + attempt * ROUND)
        arrived = control.withColumn("arrival", F.col("arrival") + attempt * ROUND)
        found = fold_events(events.unionByName(_round_requests(todo, attempt)), arrived)
        progress = stored(found if progress is None else combine_progress(progress.unionByName(found)))
        state = progress_to_state(progress)
        # branches as they were asked for, which is what a rollback is about
        asked = spec
        spec = spec.join(branches.withColumnRenamed("uuid", "_opened"), PARTITION, "left")
        spec = stored(spec.withColumn("uuid", F.coalesce("_opened", "uuid")).select(*RANGES.names))
        sent_back = Lookup(state.where("state = 'Stale'").select(*PARTITION))
        stale_now = sent_back.join(asked, PARTITION, "left_semi", spread=["end_seqno"])
        rollbacks.append(stored(rollback_from_stale(state, stale_now)))
        retries = retry_open_ranges(state, spec).withColumn("reason", F.lit("retry_open")).unionByName(
            retry_stale_ranges(state, stale_restart_ranges(state, spec)).withColumn("reason", F.lit("retry_stale"))
        )
        todo, before = stored(retries), catalog_rows(state, known)
        if todo.isEmpty():
            break
    # a partition that stays stale has its entry from the last round only
    return Streamed(
        reduce(DataFrame.unionByName, captured), state, reduce(DataFrame.unionByName, rollbacks).distinct()
    )


def _streamed_once(
    data: DataFrame, ranges: Lookup, known: DataFrame, answers: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """Captured rows and partition states after one round of requests."""
    captured = capture_ranges(data, ranges)
    if answers is None:
        answers = accepted_answers(ranges.side, stamp_uuid(captured, ranges.side, keep=True))
    # few rows, asked several times, that may take a pass over all events to make
    answers = stored(as_events(answers))
    refused = Lookup(answers.where("kind = 'rollback'").select(*PARTITION).distinct())
    captured = refused.join(captured, PARTITION, "left_anti")
    accepted = refused.join(ranges.side, PARTITION, "left_anti", spread=["end_seqno"])
    captured = stamp_uuid(captured, opened_branches(accepted, answers, known), keep=True)
    seen = as_events(captured).unionByName(answers).unionByName(request_events(ranges.side))
    return captured, partition_state(seen, answers)


def run_backup(
    store: ChangeLogStore,
    events: DataFrame,
    snapshot_id: str,
    buckets: Sequence[Bucket],
    answers: DataFrame | Source | None = None,
    max_retries: int = 3,
) -> bool:
    """Capture what is new in `events` into the store, under a snapshot name.

    `answers` are the source's control events for the requested ranges (opened,
    rollback, marker, end); without them every range counts as sent whole.
    Partitions answered with a rollback are not captured: their rollback seqno
    goes to the rollback log, and the next run restarts below it. Returns False
    when no partition has changed.

    With a function in place of `answers`, which gives all that the source sends for
    some ranges, partitions still open or sent back are asked for again within the
    run, up to `max_retries` times.
    """
    checked_name(snapshot_id)
    if store.is_applied(snapshot_id):
        return False
    catalog = read_catalog(store)
    known = mainline(catalog)
    data = data_events(events)
    ranges = Lookup(plan_ranges(high_seqnos(data), known))
    if ranges.side.isEmpty():
        return False
    if callable(answers):
        streamed = stream_rounds(answers, ranges.side, known, max_retries)
        captured, state = streamed.captured, streamed.state
    else:
        captured, state = _streamed_once(data, ranges, known, answers)

    number = (catalog.agg(F.max("run_number")).first()[0] or 0) + 1
    recorded = stored(
        catalog_rows(state, known)
        .withColumn("snapshot_id", F.lit(snapshot_id))
        .withColumn("run_number", F.lit(number).cast("long"))
        .select(*CATALOG.names)
    )
    if callable(answers):
        sent_back = streamed.rollbacks
    else:
        sent_back = rollback_from_stale(partitions_in(recorded, "Stale"), ranges.side)
    rollbacks = None if sent_back.isEmpty() else with_group(sent_back, buckets)
    mutations = mutation_rows(with_group(captured, buckets))
    return store.append_run(snapshot_id, mutations, rollbacks, recorded)

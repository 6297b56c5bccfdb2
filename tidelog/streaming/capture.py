"""Capture of a change stream into the store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions.records import mutation_rows
from tidelog.operators.ranges import capture_ranges, checked_events, data_events
from tidelog.plans.store import Bucket, ChangeLogStore, with_group
from tidelog.session import Lookup
from tidelog.sources.events import accepted_events, rejected_records
from tidelog.streaming.identity import stream_id


def capture_stream(
    store: ChangeLogStore,
    events: DataFrame,
    buckets: Sequence[Bucket],
    name: str,
    checkpoint: str,
    ranges: DataFrame | None = None,
    compact: bool = False,
    rejected_to: str | None = None,
) -> StreamingQuery:
    """Start a run that captures all available events and then stops.

    Each micro-batch becomes one capture run, named after the stream, its
    checkpoint and the batch. The store ignores a run it already has, so a batch
    replayed after a failure is stored once. With `ranges` only events inside them are kept. With
    `compact` each batch is merged into the mainline filter at once.

    Of decoded records only events are captured. The others go to a folder per batch
    below `rejected_to`; without it, they abort the stream.
    """
    lookup = None if ranges is None else Lookup(ranges)

    def set_aside(batch: DataFrame, batch_id: int) -> DataFrame:
        rejected = rejected_records(batch)
        if rejected_to is not None:
            rejected.write.mode("overwrite").parquet(f"{rejected_to}/batch={batch_id}")
        elif not rejected.isEmpty():
            raise ValueError(f"{rejected.count()} records are no events: {rejected.first()['reject_reason']}")
        return accepted_events(batch)

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        if "reject_reason" not in batch.columns:
            return store_events(batch, batch_id)
        # records are decoded once, not again for those that are no events
        batch.persist()
        try:
            store_events(set_aside(batch, batch_id), batch_id)
        finally:
            batch.unpersist()

    def store_events(batch: DataFrame, batch_id: int) -> None:
        data = data_events(checked_events(batch))
        if lookup is not None:
            data = capture_ranges(data, lookup)
        stream = f"{name}-{stream_id(store.spark, checkpoint)}"
        # the batch before was committed, so it does not come again
        before = f"{stream}-{batch_id - 1}" if batch_id else None
        store.append_run(f"{stream}-{batch_id}", mutation_rows(with_group(data, buckets)), follows=before)
        if compact:
            store.compact_filters(buckets)

    return (
        events.writeStream.queryName(name)
        .foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

"""Streams give what batches give, also when a batch is replayed."""

import pytest

from tests.conftest import keyed
from tidelog.operators.state import partition_counters, partition_state
from tidelog.plans.store import Bucket, ChangeLogStore
from tidelog.sources.events import read_events, stream_events
from tidelog.streaming.capture import capture_stream
from tidelog.streaming.progress import counter_stream, read_state, track_state

ONE = [Bucket("b", 1, 1)]


def put(arrival, seqno, key):
    return {"kind": "mutation", "arrival": arrival, "seqno": seqno, "key": key, "partition_uuid": 1}


@pytest.fixture
def source(make, tmp_path):
    path = str(tmp_path / "events")
    batches = [
        [{"kind": "opened", "arrival": 1, "failover_log": [(1, 0)]}, put(2, 1, "k1"), put(3, 2, "k2")],
        [put(4, 3, "k1"), {"kind": "marker", "arrival": 5, "snapshot_start_seqno": 1, "snapshot_end_seqno": 3}],
        [{"kind": "end", "arrival": 6, "reason": "OK"}],
    ]
    for batch in batches:
        make.events(batch).coalesce(1).write.mode("append").parquet(path)
    return path


def test_capture(spark, source, make, tmp_path):
    store = ChangeLogStore(spark, str(tmp_path / "home"))
    events = stream_events(spark, source, max_files=1)
    offsets = str(tmp_path / "offsets")
    capture_stream(store, events, ONE, "s", offsets, compact=True).awaitTermination()
    assert keyed(store.live_mutations(ONE)) == ["k1@3", "k2@2"]
    make.events([put(7, 4, "k3")]).coalesce(1).write.mode("append").parquet(source)
    capture_stream(store, events, ONE, "s", offsets).awaitTermination()
    store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["k1@3", "k2@2", "k3@4"]


def test_capture_of_ranges(spark, source, make, tmp_path):
    store = ChangeLogStore(spark, str(tmp_path / "home"))
    ranges = make.ranges([{"partition_id": 0, "start_seqno": 1, "end_seqno": 2}])
    events = stream_events(spark, source)
    capture_stream(store, events, ONE, "s", str(tmp_path / "o"), ranges).awaitTermination()
    store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["k2@2"]


def forget_commits(checkpoint):
    """Make a stream replay its last batch, as after a lost driver."""
    commits = [p for p in checkpoint.joinpath("commits").iterdir() if p.name.isdigit()]
    last = max(commits, key=lambda p: int(p.name))
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink(missing_ok=True)


def test_replayed_batch_is_stored_once(spark, source, tmp_path):
    store = ChangeLogStore(spark, str(tmp_path / "home"))
    events = stream_events(spark, source, max_files=1)
    for _ in range(2):
        query = capture_stream(store, events, ONE, "s", str(tmp_path / "o"))
        query.awaitTermination()
        forget_commits(tmp_path / "o")
    store.compact_filters(ONE)
    assert keyed(store.mutation_rows(ONE)) == ["k1@1", "k1@3", "k2@2"]


def test_new_checkpoint_captures_anew(spark, source, make, tmp_path):
    """Nothing may get lost because another stream used the same batch numbers."""
    store = ChangeLogStore(spark, str(tmp_path / "home"))
    other = str(tmp_path / "other")
    make.events([put(1, 7, "k7")]).coalesce(1).write.parquet(other)
    for number, path in enumerate((source, other)):
        events = stream_events(spark, path)
        capture_stream(store, events, ONE, "s", str(tmp_path / f"o{number}")).awaitTermination()
    store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["k1@3", "k2@2", "k7@7"]


def test_unknown_event_stops_the_stream(spark, source, make, tmp_path):
    make.events([{"kind": "odd"}]).write.mode("append").parquet(source)
    store = ChangeLogStore(spark, str(tmp_path / "home"))
    query = capture_stream(store, stream_events(spark, source), ONE, "s", str(tmp_path / "o"))
    with pytest.raises(Exception, match="unexpected event kind: odd"):
        query.awaitTermination()


@pytest.mark.parametrize("max_files", [1, 2, None])
def test_state_equals_batch(spark, source, tmp_path, max_files):
    path, checkpoint = str(tmp_path / "state"), tmp_path / "o"
    events = stream_events(spark, source, max_files=max_files)
    expected = partition_state(read_events(spark, source)).collect()
    for _ in range(2):
        track_state(events, path, str(checkpoint)).awaitTermination()
        assert read_state(spark, path, str(checkpoint)).collect() == expected
        forget_commits(checkpoint)
    assert expected[0]["state"] == "Closed" and expected[0]["num_mutations"] == 3


def test_state_of_another_checkpoint_starts_over(spark, source, tmp_path):
    path = str(tmp_path / "state")
    expected = partition_state(read_events(spark, source)).collect()
    for number, max_files in enumerate((1, None)):
        events = stream_events(spark, source, max_files=max_files)
        checkpoint = str(tmp_path / f"o{number}")
        track_state(events, path, checkpoint).awaitTermination()
        assert read_state(spark, path, checkpoint).collect() == expected


def test_counters_as_a_streaming_aggregate(spark, source, tmp_path):
    query = (
        counter_stream(stream_events(spark, source, max_files=1))
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("counters")
        .trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "o"))
        .start()
    )
    query.awaitTermination()
    assert spark.table("counters").collect() == partition_counters(read_events(spark, source)).collect()

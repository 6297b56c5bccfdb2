"""Range planning, retries, and partition state in every order of arrival."""

import pytest
from pyspark.sql import functions as F

from tidelog.functions.records import captured_text, filter_rows, mutation_rows, stamp_uuid
from tidelog.operators.ranges import (
    assert_kind,
    capture_ranges,
    data_events,
    high_seqnos,
    mainline,
    partition_count,
    plan_ranges,
    range_outcomes,
    retry_open_ranges,
    retry_stale_ranges,
    stale_restart_ranges,
)
from tidelog.operators.state import (
    attach_state,
    combine_progress,
    counters_for,
    fold_events,
    partition_counters,
    partition_state,
    partitions_in,
    progress_to_state,
    rollback_from_stale,
    total_mutations,
)
from tidelog.session import Lookup


def known(spark, *rows):
    return spark.createDataFrame(
        [("b", p, [(u, 0)], seen) for p, u, seen in rows],
        "bucket string, partition_id short, failover_log array<struct<uuid:bigint,seqno:bigint>>,"
        " last_seen_seqno long",
    )


def high(spark, *rows):
    return spark.createDataFrame(
        [("b", p, s) for p, s in rows], "bucket string, partition_id short, high_seqno long"
    )


def test_plan(spark):
    now, before = high(spark, (0, 10), (1, 5), (2, 7), (3, 2)), known(spark, (0, 7, 4), (1, 8, 5), (3, 9, 6))
    planned = {
        r["partition_id"]: (r["uuid"], r["start_seqno"], r["end_seqno"], r["snapshot_start_seqno"])
        for r in plan_ranges(now, before).collect()
    }
    assert planned == {0: (7, 4, 10, 4), 2: (0, 0, 7, 0), 3: (9, 6, 2, 6)}
    outcomes = {r["outcome"]: r["n"] for r in range_outcomes(now, before).collect()}
    assert outcomes == {"changed": 2, "unchanged": 1, "behind": 1}


def events_of(make):
    return make.events(
        [
            {"kind": "opened", "failover_log": [(7, 0)]},
            {"kind": "marker", "snapshot_start_seqno": 1, "snapshot_end_seqno": 9},
            {"kind": "mutation", "seqno": 1, "key": "a", "content": b"x", "expiration": 3, "cas": 5, "partition_uuid": 7},
            {"kind": "remove", "seqno": 2, "key": "a", "content": b"?", "cas": 6, "partition_uuid": 7},
            {"kind": "end", "reason": "OK"},
            {"kind": "opened", "partition_id": 1, "failover_log": [(8, 0), (4, 2)]},
            {"kind": "mutation", "partition_id": 1, "seqno": 5, "key": "b", "content": b"y", "partition_uuid": 8},
            {"kind": "retry_open", "partition_id": 1},
            {"kind": "rollback", "partition_id": 2, "seqno": 40},
            {"kind": "requested", "partition_id": 3, "seqno": 11},
            {"kind": "rollback", "partition_id": 4, "seqno": 50},
            {"kind": "retry_stale", "partition_id": 4, "seqno": 49},
        ]
    )


def by_partition(df):
    return {row["partition_id"]: row.asDict(recursive=True) for row in df.collect()}


def test_state(make):
    state = by_partition(partition_state(events_of(make)))
    assert [state[p]["state"] for p in range(5)] == ["Closed", "Open", "Stale", "Open", "Open"]
    assert [state[p]["last_seen_seqno"] for p in range(5)] == [2, 5, None, 11, 49]
    assert state[0]["reason"] == "OK" and state[1]["reason"] is None
    assert (state[0]["last_snapshot_start_seqno"], state[0]["last_snapshot_end_seqno"]) == (1, 9)
    assert [state[p]["rollback_seqno"] for p in range(5)] == [None, None, 40, None, None]
    assert state[1]["failover_log"] == [{"uuid": 8, "seqno": 0}, {"uuid": 4, "seqno": 2}]
    assert (state[0]["num_snapshots"], state[0]["num_mutations"], state[0]["num_deletions"]) == (1, 1, 1)
    assert state[1]["num_retries_reason_open"] == 1 and state[4]["num_retries_reason_stale"] == 1


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_state_folded_in_parts_is_the_same(make, order):
    events = events_of(make)
    parts = [fold_events(events.where(F.col("arrival") % 3 == turn)) for turn in order]
    progress = combine_progress(parts[0].unionByName(parts[1]))
    progress = combine_progress(progress.unionByName(parts[2]))
    assert by_partition(progress_to_state(progress)) == by_partition(partition_state(events))


def test_state_of_the_full_stream_stays_hash_based(make):
    plan = fold_events(events_of(make))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2


def test_unknown_kind_aborts(make):
    with pytest.raises(Exception, match="unexpected event kind: nonsense"):
        partition_state(make.events([{"kind": "nonsense"}])).collect()


def test_kind_guard(make):
    events = make.events([{"kind": "mutation", "seqno": 1}])
    assert assert_kind(events, "mutation").count() == 1
    with pytest.raises(Exception, match="unexpected event kind: mutation"):
        assert_kind(events, "remove").collect()


def test_projections(make):
    data = data_events(events_of(make))
    assert sorted((r["key"], r["rec_type"]) for r in filter_rows(data).collect()) == [
        ("a", "DELETE"),
        ("a", "UPDATE"),
        ("b", "UPDATE"),
    ]
    full = {(r["key"], r["seqno"]): r for r in mutation_rows(data).collect()}
    assert full[("a", 1)]["content"] == b"x" and full[("a", 1)]["expiration"] == 3
    assert full[("a", 2)]["content"] is None and full[("a", 2)]["cas"] == 6
    texts = {(r["seqno"], r["type"], r["value"]) for r in captured_text(data).collect()}
    assert texts == {(1, "mutation", "x"), (2, "remove", None), (5, "mutation", "y")}


def test_null_key_aborts(make):
    with pytest.raises(Exception, match="key must not be null"):
        events = make.events([{"kind": "mutation", "seqno": 1, "partition_uuid": 1}])
        filter_rows(events).collect()


def test_stamp_uuid(make):
    ranges = make.ranges([{"partition_id": 0, "uuid": 77, "start_seqno": 0, "end_seqno": 9}])
    stamped = stamp_uuid(events_of(make).where("partition_id = 0 AND seqno IS NOT NULL"), ranges)
    assert {r["partition_uuid"] for r in stamped.collect()} == {77}
    with pytest.raises(Exception, match="_uuid must not be null"):
        stamp_uuid(events_of(make).where("partition_id = 1 AND seqno IS NOT NULL"), ranges).collect()


def test_capture_is_half_open(make):
    events = make.events([{"kind": "mutation", "seqno": n, "key": "k"} for n in range(1, 8)])
    ranges = make.ranges([{"partition_id": 0, "start_seqno": 2, "end_seqno": 5}])
    for side in (Lookup(ranges), Lookup(ranges, max_bytes=1)):
        assert sorted(r["seqno"] for r in capture_ranges(events, side).collect()) == [3, 4, 5]


def test_range_bounds_reach_the_scan(make, spark, tmp_path):
    path = str(tmp_path / "events")
    make.events([{"kind": "mutation", "seqno": n, "key": "k"} for n in range(9)]).write.parquet(path)
    stored = spark.read.parquet(path)
    ranges = make.ranges([{"partition_id": 0, "start_seqno": 2, "end_seqno": 5}])
    plan = capture_ranges(stored, ranges)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(seqno,2), LessThanOrEqual(seqno,5)" in plan
    assert capture_ranges(stored, ranges.where("false")).count() == 0


def test_high_seqnos_and_count(make):
    assert {r["partition_id"]: r["high_seqno"] for r in high_seqnos(data_events(events_of(make))).collect()} == {0: 2, 1: 5}
    assert partition_count(events_of(make)).first()["num_partitions"] == 5


def planned(make):
    return make.ranges(
        [
            {"partition_id": p, "uuid": 70 + p, "start_seqno": 4, "end_seqno": 99, "snapshot_start_seqno": 4, "snapshot_end_seqno": 4}
            for p in range(5)
        ]
    )


def test_retry_open_resumes_from_what_was_seen(make):
    state = partition_state(events_of(make).where("kind <> 'retry_stale'"))
    found = by_partition(retry_open_ranges(state, planned(make)))
    assert {p: (r["start_seqno"], r["end_seqno"]) for p, r in found.items()} == {1: (5, 99), 3: (11, 99)}
    untouched = partition_state(make.events([{"kind": "opened"}]))
    assert by_partition(retry_open_ranges(untouched, planned(make)))[0]["start_seqno"] == 4


def test_retry_stale_needs_a_stale_partition(make):
    state = partition_state(events_of(make))
    restart = stale_restart_ranges(state, planned(make))
    assert {p: r["start_seqno"] for p, r in by_partition(retry_stale_ranges(state, restart)).items()} == {2: 39}
    for partition, problem in ((0, "Closed"), (77, "does not exist")):
        wrong = make.ranges([{"partition_id": partition, "start_seqno": 0, "end_seqno": 1}])
        with pytest.raises(Exception, match=problem):
            retry_stale_ranges(state, wrong).collect()


def test_rollback_entries_of_stale_partitions(make):
    rows = rollback_from_stale(partition_state(events_of(make)), planned(make)).collect()
    assert [(r["partition_id"], r["partition_uuid"], r["seqno"]) for r in rows] == [(2, 72, 40)]


def test_counters(make):
    counters = partition_counters(events_of(make).where("partition_id < 2"))
    filled = by_partition(counters_for(planned(make), counters))
    assert [filled[p]["num_mutations"] for p in range(5)] == [1, 1, 0, 0, 0]
    assert total_mutations(counters).first()[0] == 2
    assert total_mutations(counters.limit(0)).first()[0] == 0


def test_final_state_is_attached_once_closed(make):
    data = data_events(events_of(make)).select("bucket", "partition_id", "seqno")
    attached = attach_state(data, partition_state(events_of(make)))
    assert sorted((r["seqno"], r["state"]) for r in attached.collect()) == [(1, "Closed"), (2, "Closed"), (5, None)]
    assert partitions_in(partition_state(events_of(make)), "Open").count() == 3


def test_mainline_is_the_latest_run_of_each_partition(spark):
    catalog = spark.createDataFrame(
        [("s1", 1, "b", 0, 10), ("s1", 1, "b", 1, 11), ("s2", 2, "b", 0, 20)],
        "snapshot_id string, run_number long, bucket string, partition_id short, last_seen_seqno long",
    )
    assert {p: r["last_seen_seqno"] for p, r in by_partition(mainline(catalog)).items()} == {0: 20, 1: 11}

"""Decoded records, retried requests, samples of fixed size, and mask texts."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import keyed
from tests.test_store import change
from tidelog.operators.mutations import mask, sample_exact, stands_in_every_match
from tidelog.operators.ranges import mainline
from tidelog.plans.backup import as_events, read_catalog, run_backup
from tidelog.plans.store import Bucket, ChangeLogStore
from tidelog.sources import events as sources
from tidelog.streaming import capture
from tidelog.streaming.capture import capture_stream

ONE = [Bucket("b", 1, 1)]


def records(spark, *rows):
    full = [(None if k is None else k.encode(), v if v is None or isinstance(v, bytes) else json.dumps(v).encode(), "b", 0, n) for n, (k, v) in enumerate(rows)]
    return spark.createDataFrame(full, "key binary, value binary, topic string, partition int, offset long")


PUT = {"kind": "mutation", "seqno": 7, "partition_uuid": 1}


def test_decoding(spark):
    raw = records(
        spark, ("a", PUT), ("a", None), (None, None), ("a", b"{broken"), ("a", b"\xff\xfe"), ("a", {**PUT, "kind": "other"}),
        ("a", {**PUT, "partition_id": -1}), ("", PUT), ("a", {"kind": "end", "reason": "OK"}), ("a", {**PUT, "content": "aGk="}), ("a", {**PUT, "seqno": "x"}),
    )
    decoded = sources.decode_records(raw)
    reasons = [row["reject_reason"] for row in decoded.orderBy("arrival").collect()]
    assert reasons[:3] == [None, None, "no key or seqno"]
    assert reasons[3:7] == ["not an event", "not an event", "unknown kind", "no partition"]
    assert reasons[7:10] == ["no key or seqno", None, None] and reasons[10] is not None
    events = sources.accepted_events(decoded).orderBy("arrival").collect()
    assert [(e["kind"], e["key"], e["seqno"], e["bucket"], e["partition_id"], e["arrival"]) for e in events[:2]] == [
        ("mutation", "a", 7, "b", 0, 0), ("remove", "a", 1, "b", 0, 1)
    ]
    assert events[-1]["content"] == b"hi"
    kept = sources.rejected_records(decoded).where("offset = 3").first()
    assert bytes(kept["value"]) == b"{broken"


def test_bad_records_stop_a_stream_unless_set_aside(spark, tmp_path):
    raw = records(spark, ("a", PUT), ("b", b"bad"))
    raw.write.parquet(str(tmp_path / "topic"))
    stream = sources.decode_records(spark.readStream.schema(sources.RECORD).parquet(str(tmp_path / "topic")))
    store = ChangeLogStore(spark, str(tmp_path / "home"), num_buckets=2)
    with pytest.raises(Exception, match="no events"):
        capture_stream(store, stream, ONE, "s", str(tmp_path / "o1")).awaitTermination()
    aside = str(tmp_path / "aside")
    capture_stream(store, stream, ONE, "s", str(tmp_path / "o2"), rejected_to=aside).awaitTermination()
    store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["a@7"]
    assert [bytes(r["value"]) for r in spark.read.parquet(aside).collect()] == [b"bad"]


def test_streamed_records_are_decoded_once_by_several_tasks(spark, tmp_path, monkeypatch):
    """Also where the topic is one file of one row group."""
    home, seen, rejected = str(tmp_path / "topic"), [], capture.rejected_records

    def watched(batch):
        seen.append((batch.rdd.getNumPartitions(), batch.storageLevel.useDisk))
        return rejected(batch)

    monkeypatch.setattr(capture, "rejected_records", watched)
    records(spark, ("a", PUT), ("b", b"bad")).coalesce(1).write.parquet(home)
    stream = sources.decode_records(spark.readStream.schema(sources.RECORD).parquet(home))
    store = ChangeLogStore(spark, str(tmp_path / "home"), num_buckets=2)
    capture_stream(store, stream, ONE, "s", str(tmp_path / "o"), rejected_to=str(tmp_path / "aside")).awaitTermination()
    store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["a@7"]
    assert seen == [(4, True)]


def test_retries_end_and_what_stays_open_is_recorded(spark, make, tmp_path):
    """One event a round: the run asks four times, then records the partition as open."""
    store = ChangeLogStore(spark, str(tmp_path / "home"), num_buckets=2)
    log = make.events([change(n, f"k{n}") for n in range(1, 9)]).drop("partition_uuid")
    asked = []

    def source(ranges, attempt):
        row = ranges.first()
        asked.append((row["start_seqno"], row["end_seqno"]))
        opened = make.events([{"kind": "opened", "arrival": 0, "failover_log": [{"uuid": 5, "seqno": 0}]}])
        return as_events(log.where(F.col("seqno") == row["start_seqno"] + 1)).unionByName(opened)

    assert run_backup(store, log, "s1", ONE, source)
    assert asked == [(0, 8), (1, 8), (2, 8), (3, 8)]
    state = mainline(read_catalog(store)).first()
    assert (state["state"], state["last_seen_seqno"], state["num_mutations"]) == ("Open", 4, 4)
    assert state["num_retries_reason_open"] == 4 - 1
    store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["k1@1", "k2@2", "k3@3", "k4@4"]


def test_rollback_while_resuming(spark, make, tmp_path):
    """Rows that a run itself has captured are cut when a retry is sent back below them."""
    store = ChangeLogStore(spark, str(tmp_path / "home"), num_buckets=2)
    log = make.events([change(n, f"k{n}") for n in range(1, 7)]).drop("partition_uuid")

    def source(ranges, attempt):
        row = ranges.first()
        opened = {"kind": "opened", "arrival": 0, "failover_log": [{"uuid": 1 if attempt == 0 else 2, "seqno": 0}]}
        if attempt == 1:
            return make.events([{"kind": "rollback", "arrival": 0, "seqno": 3}])
        upto = 4 if attempt == 0 else 6
        sent = as_events(log.where((F.col("seqno") > row["start_seqno"]) & (F.col("seqno") <= upto)))
        more = [opened] + ([{"kind": "end", "arrival": 99, "reason": "OK"}] if attempt == 2 else [])
        return sent.unionByName(make.events(more))

    run_backup(store, log, "s1", ONE, source)
    state = mainline(read_catalog(store)).first()
    assert (state["state"], state["last_seen_seqno"]) == ("Closed", 6)
    assert (state["num_retries_reason_open"], state["num_retries_reason_stale"]) == (1, 1)
    store.compact_filters(ONE)
    branches = {(r["key"], r["partition_uuid"]) for r in store.live_mutations(ONE).collect()}
    assert branches == {("k1", 1), ("k2", 1), ("k3", 2), ("k4", 2), ("k5", 2), ("k6", 2)}


@pytest.mark.parametrize("size", [0, 1, 7, 40, 100])
def test_sample_has_its_size(make, size):
    rows = [{"seqno": n, "key": f"k{n}", "rec_type": t} for n in range(40) for t in ("UPDATE", "DELETE")]
    rows += [{"seqno": 99 + n, "key": "k3", "rec_type": "UPDATE"} for n in range(5)] + [{"seqno": 1, "key": "x", "rec_type": None}]
    found = sample_exact(make.mutations(rows), "rec_type", size).collect()
    for kind in ("UPDATE", "DELETE"):
        assert len({r["key"] for r in found if r["rec_type"] == kind}) == min(size, 40)
    assert all(r["rec_type"] for r in found)
    if size == 40:
        assert len([r for r in found if r["key"] == "k3"]) == 7


@pytest.mark.parametrize("pattern, text, safe", [
    (r"[a-z.]+@[a-z]+\.[a-z]{2,}", "@", True), (r"id=\d+", "id=", True), (r"a?b", "a", False), (r"(x@y)?z", "@", False),
    (r"a|b", "a", False), (r"[@]x", "@", False), (r"ab*", "ab", False), (r"\@x", "@", False), (r"(?i)ab", "ab", False), (r"x{2}y", "2", False), (r"abc", "z", False),
])
def test_texts_that_stand_in_every_match(pattern, text, safe):
    assert stands_in_every_match(pattern, text) is safe


def test_wrong_mask_text_is_refused(make):
    with pytest.raises(ValueError, match="need not stand"):
        mask(make.mutations([]), [("[0-9]+", "#", "no.")])

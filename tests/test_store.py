"""The store: runs, publishing, gates, snapshots, replays, and the plans it gives."""

import os
import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.conftest import keyed
from tidelog.plans import manifest as manifest_module
from tidelog.plans.backup import read_catalog, run_backup
from tidelog.plans.manifest import ConcurrentPublish
from tidelog.plans.store import Bucket, ChangeLogStore, enumerate_groups, with_group
from tidelog.operators.mutations import MutationMapper
from tidelog.operators.ranges import mainline, snapshot_partition
from tidelog.sources import paths

ONE = [Bucket("b", 1, 1)]
TWO_GROUPS = [Bucket("b", 2, 2)]


@pytest.fixture
def store(spark, tmp_path):
    return ChangeLogStore(spark, str(tmp_path / "home"), num_buckets=4)


def pairs(make, *found, **common):
    return make.mutations([{"seqno": s, "key": k, **common} for s, k in found])


def two_runs(store, make):
    store.append_run("r1", pairs(make, (1, "k1"), (2, "k2"), (3, "k1")))
    store.compact_filters(ONE)
    store.append_run("r2", pairs(make, (4, "k2"), (5, "k1")))
    store.compact_filters(ONE)


def test_two_runs(store, make):
    store.append_run("r1", pairs(make, (1, "k1"), (2, "k2"), (3, "k1")))
    assert store.filter_rows(ONE).count() == 0
    assert store.live_mutations(ONE).count() == 0
    store.compact_filters(ONE)
    assert keyed(store.filter_rows(ONE)) == ["k1@3", "k2@2"]
    assert keyed(store.live_mutations(ONE)) == ["k1@3", "k2@2"]
    store.append_run("r2", pairs(make, (4, "k2"), (5, "k1")))
    assert keyed(store.live_mutations(ONE)) == ["k1@3", "k2@2"]
    store.compact_filters(ONE)
    assert keyed(store.filter_rows(ONE)) == ["k1@5", "k2@4"]
    assert keyed(store.mutation_rows(ONE)) == ["k1@1", "k1@3", "k1@5", "k2@2", "k2@4"]
    assert store.compact_filters(ONE) is None


def test_content_is_kept(store, make):
    row = {"seqno": 1, "key": "k", "content": b"\x00\xff", "expiration": 4, "cas": 5, "flags": 6}
    store.append_run("r1", make.mutations([row]))
    store.compact_filters()
    found = store.live_mutations().first()
    assert (found["content"], found["expiration"], found["cas"], found["flags"]) == (b"\x00\xff", 4, 5, 6)


def test_replayed_run_is_stored_once(store, make):
    assert store.append_run("r1", pairs(make, (1, "k1")))
    store.compact_filters(ONE)
    assert not store.append_run("r1", pairs(make, (1, "k1")))
    assert keyed(store.mutation_rows(ONE)) == ["k1@1"]
    assert store.compact_filters(ONE) is None


def test_unfinished_attempt_is_replaced(store, make, monkeypatch):
    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(manifest_module.Manifest, "publish", fail)
        with pytest.raises(RuntimeError, match="lost"):
            store.append_run("r1", pairs(make, (1, "stray")))
    assert store.append_run("r1", pairs(make, (2, "k")))
    store.compact_filters(ONE)
    assert keyed(store.mutation_rows(ONE)) == ["k@2"]


def test_only_groups_with_new_rows_change(store, make):
    store.append_run(
        "r1",
        pairs(make, (1, "a")).unionByName(pairs(make, (1, "b"), pgroup=1, partition_id=1)),
    )
    store.compact_filters(TWO_GROUPS)
    cuts = make.rollback([{"seqno": 1}, {"seqno": 1, "pgroup": 1, "partition_id": 1}])
    store.append_run("r2", pairs(make, (2, "c"), pgroup=1, partition_id=1, partition_uuid=5), cuts)
    waiting = store.groups_needing_filter_compaction(TWO_GROUPS).collect()
    assert [row["pgroup"] for row in waiting] == [1]
    store.compact_filters(TWO_GROUPS)
    assert keyed(store.filter_rows(TWO_GROUPS)) == ["a@1", "c@2"]
    store.append_run("r3", pairs(make, (9, "d"), partition_uuid=5))
    store.compact_filters(TWO_GROUPS)
    assert keyed(store.filter_rows(TWO_GROUPS)) == ["c@2", "d@9"]
    assert keyed(store.live_mutations(TWO_GROUPS)) == ["c@2", "d@9"]


def test_buckets_are_independent(store, make):
    both = [Bucket("b", 1, 1), Bucket("c", 1, 1)]
    store.append_run("r1", pairs(make, (1, "k")).unionByName(pairs(make, (2, "k"), bucket="c")))
    store.compact_filters([both[1]])
    assert keyed(store.filter_rows(both)) == ["k@2"]
    store.compact_filters(both)
    assert keyed(store.filter_rows(both)) == ["k@1", "k@2"]
    assert keyed(store.live_mutations([both[0]])) == ["k@1"]
    assert store.filter_rows([]).count() == 0


def test_threshold_and_deferred_publish(store, make):
    for n in range(1, 4):
        store.append_run(f"r{n}", pairs(make, (n, "k"), (n + 100, f"once{n}")))
        store.compact_filters(ONE)
    assert store.compact_mutations(ONE, threshold=3) is None
    assert store.groups_over_threshold(ONE, 2).first()["num_files"] == 3
    assert store.compact_mutations(ONE, threshold=2) is not None
    everything = ["k@1", "k@2", "k@3", "once1@101", "once2@102", "once3@103"]
    assert keyed(store.mutation_rows(ONE)) == everything
    store.append_run("late", pairs(make, (9, "late")))
    store.compact_filters(ONE)
    assert store.publish_compacted_mutations(ONE)
    live = ["k@3", "late@9", "once1@101", "once2@102", "once3@103"]
    assert keyed(store.mutation_rows(ONE)) == live
    assert keyed(store.live_mutations(ONE)) == live
    assert not store.publish_compacted_mutations(ONE)


def test_default_threshold_is_ten_files(store, make, spark):
    groups = spark.createDataFrame([("b", 0)], "bucket string, pgroup int")
    entries = spark.createDataFrame([], manifest_module.ENTRY_SCHEMA)
    for n in range(11):
        entries = entries.unionByName(store._entries(groups, ["mutations"], "l1", f"r{n}"))
        if n == 9:
            store.manifest.publish(store.manifest.latest(), entries)
            assert store.groups_over_threshold(ONE).isEmpty()
    store.manifest.publish(store.manifest.latest(), entries)
    assert store.groups_over_threshold(ONE).count() == 1


def test_stale_staged_mutations_are_dropped(store, make):
    two_runs(store, make)
    store.compact_mutations(ONE, threshold=1)
    base = store.manifest.latest()
    store.manifest.publish(base, base.entries.where("NOT (kind = 'mutations' AND run = 'r1')"))
    store.publish_compacted_mutations(ONE)
    assert keyed(store.mutation_rows(ONE)) == ["k1@5", "k2@4"]
    assert store.manifest.latest().of("mutations", "staged").isEmpty()


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_compacted_mutations_have_one_file_per_bucket(store, make, spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for n in range(3):
            store.append_run(f"r{n}", pairs(make, *[(n * 100 + i, f"k{i}") for i in range(40)]))
            store.compact_filters(ONE)
        run = store.compact_mutations(ONE, threshold=1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for kind in ("mutations", "filter"):
        name = run if kind == "mutations" else store._view(store.manifest.latest(), None).runs["filter", "l1"][0].folder
        files = paths.list_files(spark, f"{store.home}/{kind}/run={name}/*/*.parquet")
        assert 1 < files.count() <= store.num_buckets


def test_compact_in_one_call(store, make):
    store.append_run("r1", pairs(make, (1, "k"), (2, "k")))
    store.compact(ONE, threshold=0)
    assert keyed(store.mutation_rows(ONE)) == ["k@2"]


def test_snapshots_outlive_compaction_and_vacuum(store, make):
    store.append_run("r1", pairs(make, (1, "k1"), (2, "k2"), (3, "k1")))
    store.compact_filters(ONE)
    store.create_snapshot("monday")
    store.append_run("r2", pairs(make, (4, "k2"), (5, "k1")))
    store.compact(ONE, threshold=1)
    assert store.vacuum() == 3
    assert len(store.manifest._numbers()) == 2
    assert keyed(store.restore(ONE)) == ["k1@5", "k2@4"]
    assert keyed(store.restore(ONE, snapshot="monday")) == ["k1@3", "k2@2"]


def test_mapper_through_the_store(store, make):
    class Upper(MutationMapper):
        def map_row(self, row):
            return {"key": row["key"].upper(), "seqno": row["seqno"]}

    two_runs(store, make)
    assert keyed(store.map_mutations(Upper(), "key string, seqno long", ONE)) == ["K1@5", "K2@4"]
    assert store.map_mutations(lambda rows: rows.select("seqno"), buckets=ONE).columns == ["seqno"]


def test_group_with_only_one_side_is_an_error(store, make):
    two_runs(store, make)
    base = store.manifest.latest()
    store.manifest.publish(base, base.entries.where("kind <> 'filter'"))
    with pytest.raises(RuntimeError, match="b/0 lacks filter or mutations"):
        store.live_mutations(ONE)


def test_second_writer_fails(store, make):
    base = store.manifest.latest()
    store.append_run("r1", pairs(make, (1, "k")))
    with pytest.raises(ConcurrentPublish):
        store.manifest.publish(base, base.entries)


def between(monkeypatch, action):
    """Let another writer act once, just before the next publish."""
    publish = manifest_module.Manifest.publish

    def interrupted(self, base, entries):
        monkeypatch.setattr(manifest_module.Manifest, "publish", publish)
        action()
        return publish(self, base, entries)

    monkeypatch.setattr(manifest_module, "PAUSE_SECONDS", 0)
    monkeypatch.setattr(manifest_module.Manifest, "publish", interrupted)


def test_capture_during_compaction_is_kept(store, make, monkeypatch):
    store.append_run("r1", pairs(make, (1, "a")))
    between(monkeypatch, lambda: store.append_run("r2", pairs(make, (2, "b"))))
    store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["a@1"]
    store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["a@1", "b@2"]


def test_second_compaction_of_the_same_runs_fails(store, make, monkeypatch):
    store.append_run("r1", pairs(make, (1, "a")))
    between(monkeypatch, lambda: store.compact_filters(ONE))
    with pytest.raises(ConcurrentPublish, match="used the same runs"):
        store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["a@1"]


def test_unfinished_version_is_not_seen(store, make):
    store.append_run("r1", pairs(make, (1, "k")))
    before = store.manifest.latest()
    # a writer that died after its entries, and one that died while naming them
    before.entries.write.parquet(f"{store.manifest.folder}/entries=dead")
    with open(f"{store.manifest.folder}/version=0000000002.abc.tmp", "w") as file:
        file.write("entries=dead")
    assert store.manifest.latest().number == 1
    store.append_run("r2", pairs(make, (2, "l")))
    assert store.manifest.latest().number == 2
    store.vacuum()
    assert sorted(n.split("=")[0] for n in os.listdir(store.manifest.folder) if not n.startswith(".")) == ["entries", "version"]


def test_concurrent_writers_all_end_up_in_the_store(store, make):
    rows = {f"r{n}": pairs(make, (n, f"k{n}")) for n in range(1, 5)}
    with ThreadPoolExecutor(4) as pool:
        assert all(pool.map(lambda item: store.append_run(*item), rows.items()))
    store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["k1@1", "k2@2", "k3@3", "k4@4"]


def test_a_version_has_one_writer(spark, store):
    from tidelog.sources import paths

    path = f"{store.home}/named"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: paths.create_text(spark, path, str(n)), range(8)))
    assert sum(won) == 1
    assert paths.read_text(spark, path) == str(won.index(True))


def test_row_captured_twice_is_live_once(store, make):
    store.append_run("r1", pairs(make, (1, "a"), (2, "b")))
    store.compact_filters(ONE)
    store.append_run("r2", pairs(make, (2, "b"), (3, "c")))
    store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["a@1", "b@2", "c@3"]
    assert keyed(store.restore(ONE)) == ["a@1", "b@2", "c@3"]
    store.compact_mutations(ONE, threshold=1)
    store.publish_compacted_mutations(ONE)
    assert keyed(store.mutation_rows(ONE)) == ["a@1", "b@2", "c@3"]


def test_store_made_anew_at_a_path(spark, make, tmp_path):
    rows = pairs(make, *((n, f"k{n}") for n in range(1, 51)))
    first = ChangeLogStore(spark, str(tmp_path / "it's here"), num_buckets=4)
    first.append_run("r1", rows)
    first.compact_filters(ONE)
    assert first.live_mutations(ONE).count() == 50
    shutil.rmtree(tmp_path / "it's here")
    second = ChangeLogStore(spark, str(tmp_path / "it's here"), num_buckets=7)
    second.append_run("r1", rows)
    second.compact_filters(ONE)
    assert second.live_mutations(ONE).count() == 50


@pytest.mark.parametrize("name", ["", "a/b", "x'y", "a b"])
def test_names_are_safe_in_paths(store, name):
    for call in (store.append_run, store.create_snapshot):
        with pytest.raises(ValueError, match="letters"):
            call(name)


def test_bucket_count_is_remembered(store, spark):
    assert ChangeLogStore(spark, store.home, num_buckets=9).num_buckets == 4


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_mutations_are_not_shuffled_to_find_the_live_ones(store, make, no_broadcast):
    two_runs(store, make)
    plan = plan_of(store.live_mutations(ONE))
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1
    assert "Bucketed: true" in plan


def test_mainline_filter_is_not_shuffled_to_merge_a_run(store, make, no_broadcast):
    from tidelog.plans.compaction import compact_filter

    two_runs(store, make)
    new = make.filter([{"seqno": 8, "key": "k9"}])
    plan = plan_of(compact_filter(store.filter_rows(ONE), new))
    assert "FullOuter" in plan and plan.count("Exchange") == 1


def test_enumeration(spark):
    groups = enumerate_groups(spark, [Bucket("x", 10, 4), Bucket("y", 1024, 1024), Bucket("z", 1, 1)])
    labels = {(r["bucket"], r["pgroup"]): r["label"] for r in groups.collect()}
    assert [labels["x", n] for n in range(4)] == ["(0-1)", "(2-4)", "(5-6)", "(7-9)"]
    assert labels["y", 0] == "(0-0)" and labels["y", 1023] == "(1023-1023)" and labels["z", 0] == "(0-0)"
    assert len(labels) == 4 + 1024 + 1
    rows = spark.range(10).selectExpr("'x' AS bucket", "smallint(id) AS partition_id")
    found = {r["partition_id"]: r["pgroup"] for r in with_group(rows, [Bucket("x", 10, 4)]).collect()}
    assert [found[p] for p in range(10)] == [0, 0, 1, 1, 1, 2, 2, 3, 3, 3]


@pytest.mark.parametrize("bucket, partition", [("x", 10), ("x", -1), ("other", 0)])
def test_unknown_partition_aborts(spark, bucket, partition):
    rows = spark.createDataFrame([(bucket, partition)], "bucket string, partition_id short")
    with pytest.raises(Exception, match="no such partition"):
        with_group(rows, [Bucket("x", 10, 4)]).collect()


def change(seqno, key, partition=0, uuid=1):
    return {"kind": "mutation", "seqno": seqno, "key": key, "partition_id": partition, "partition_uuid": uuid, "arrival": seqno}


def test_backups(store, make):
    first = make.events([change(1, "a"), change(2, "b"), change(1, "c", 1)])
    assert run_backup(store, first, "s1", TWO_GROUPS)
    store.compact_filters(TWO_GROUPS)
    assert not run_backup(store, first, "again", TWO_GROUPS)
    second = first.unionByName(make.events([change(3, "a")]))
    assert run_backup(store, second, "s2", TWO_GROUPS)
    store.compact_filters(TWO_GROUPS)
    assert keyed(store.live_mutations(TWO_GROUPS)) == ["a@3", "b@2", "c@1"]
    catalog = read_catalog(store)
    assert snapshot_partition(catalog, "s2", 0).first()["num_mutations"] == 1
    assert snapshot_partition(catalog, "s2", 1).isEmpty()
    latest = {r["partition_id"]: r["snapshot_id"] for r in mainline(catalog).collect()}
    assert latest == {0: "s2", 1: "s1"}


def test_backup_with_a_refused_partition(store, make):
    first = make.events([change(n, f"k{n}") for n in range(1, 6)])
    run_backup(store, first, "s1", ONE)
    store.compact_filters(ONE)
    branch = make.events([change(n, f"k{n}") for n in range(1, 4)] + [change(4, "new", uuid=2)])
    answers = make.events([{"kind": "rollback", "seqno": 4, "arrival": 100}])
    run_backup(store, branch, "s2", ONE, answers)
    state = mainline(read_catalog(store)).first()
    assert (state["state"], state["last_seen_seqno"], state["failover_log"][0]["uuid"]) == ("Stale", 3, 1)
    assert store.compact_filters(ONE) is None
    run_backup(store, branch, "s3", ONE)
    store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["k1@1", "k2@2", "k3@3", "new@4"]
    assert mainline(read_catalog(store)).first()["failover_log"][0]["uuid"] == 2
    assert store.filter_rows(ONE).agg(F.count("*")).first()[0] == 4


@pytest.mark.parametrize("step", ["write_clustered", "publish"])
def test_backup_broken_at_any_step_can_be_repeated(store, make, monkeypatch, step):
    """Nothing is recorded as captured before it is in the store."""
    events = make.events([change(1, "a"), change(2, "b")])
    owner = store.files if step == "write_clustered" else store.manifest

    def broken(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(owner, step, broken)
        with pytest.raises(OSError, match="lost"):
            run_backup(store, events, "s1", ONE)
    assert read_catalog(store).isEmpty()
    assert run_backup(store, events, "s1", ONE)
    assert not run_backup(store, events, "s1", ONE)
    store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["a@1", "b@2"]


def without_uuid(events):
    return events.drop("partition_uuid")


def opened(seqno_uuid, partition=0):
    return {"kind": "opened", "arrival": 0, "partition_id": partition, "failover_log": [{"uuid": u, "seqno": s} for s, u in seqno_uuid]}


@pytest.mark.parametrize("buckets", [[Bucket("b", 2, 2)], [Bucket("b", 2, 1)]])
def test_backup_after_a_rollback(store, make, buckets):
    """New rows of the new branch live, rolled-back rows are gone."""
    other = [change(n, f"o{n}", 1) for n in range(1, 3)]
    first = make.events([change(n, f"k{n}") for n in range(1, 6)] + other)
    start = make.events([opened([(0, 1)]), opened([(0, 9)], 1)])
    run_backup(store, without_uuid(first), "s1", buckets, start)
    store.compact_filters(buckets)
    later = [change(n, f"k{n}") for n in range(1, 4)] + [change(4, "new"), change(5, "new2"), change(6, "new3")]
    second = without_uuid(make.events(later + other + [change(3, "o3", 1)]))
    refused = make.events([{"kind": "rollback", "seqno": 4, "arrival": 100}, opened([(0, 9)], 1)])
    run_backup(store, second, "s2", buckets, refused)
    store.compact_filters(buckets)
    with pytest.raises(Exception, match="rolled back"):
        run_backup(store, second, "s3", buckets, make.events([opened([(0, 1)])]))
    run_backup(store, second, "s3", buckets, make.events([opened([(3, 2), (0, 1)])]))
    store.compact_filters(buckets)
    expected = ["k1@1", "k2@2", "k3@3", "new2@5", "new3@6", "new@4", "o1@1", "o2@2", "o3@3"]
    assert keyed(store.live_mutations(buckets)) == expected

"""The store's files: attempts, lost files, pruned reads, levels, formats, history."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tests.conftest import keyed
from tests.test_store import ONE, TWO_GROUPS, pairs, plan_of
from tidelog.plans import manifest as manifest_module
from tidelog.plans.store import Bucket, ChangeLogStore
from tidelog.sources import paths


@pytest.fixture
def store(spark, tmp_path):
    return ChangeLogStore(spark, str(tmp_path / "home"), num_buckets=4)


def folder_of(store, kind="mutations"):
    return store.manifest.latest().entries.where(f"kind = '{kind}'").first()["folder"]


def test_second_attempt_leaves_a_published_run_alone(spark, store, make, monkeypatch):
    rows = pairs(make, *[(n, f"k{n}") for n in range(50)])
    assert store.append_run("r", rows)
    late = ChangeLogStore(spark, store.home)
    monkeypatch.setattr(late, "is_applied", lambda run: False)
    with monkeypatch.context() as patch:

        def dies(*args, **kwargs):
            raise OSError("lost")

        patch.setattr(late.manifest, "change", dies)
        with pytest.raises(OSError, match="lost"):
            late.append_run("r", rows)
    assert not late.append_run("r", rows)
    store.compact_filters(ONE)
    assert store.live_mutations(ONE).count() == 50
    assert store.changes("r").count() == 50


def test_two_writers_of_one_run(spark, store, make, monkeypatch):
    """The one that publishes first wins, whichever asked first; the other's files go."""
    publish = manifest_module.Manifest.publish

    def interrupted(self, base, entries):
        monkeypatch.setattr(manifest_module.Manifest, "publish", publish)
        assert ChangeLogStore(spark, store.home).append_run("r", pairs(make, (1, "first")))
        return publish(self, base, entries)

    monkeypatch.setattr(manifest_module, "PAUSE_SECONDS", 0)
    monkeypatch.setattr(manifest_module.Manifest, "publish", interrupted)
    assert not store.append_run("r", pairs(make, (1, "second")))
    store.compact_filters(ONE)
    assert keyed(store.live_mutations(ONE)) == ["first@1"]
    assert len(paths.child_names(spark, f"{store.home}/mutations")) == 1


@pytest.mark.parametrize("kind", ["mutations", "filter"])
def test_missing_files_are_an_error(store, make, kind):
    store.append_run("r", pairs(make, (1, "a")))
    store.compact_filters(ONE)
    shutil.rmtree(f"{store.home}/{kind}/run={folder_of(store, kind)}")
    with pytest.raises(RuntimeError, match="files of run .* are missing"):
        store.live_mutations(ONE)


def many_groups(store, make):
    rows = make.mutations(
        [{"seqno": n, "key": f"k{n}", "bucket": b, "pgroup": n % 4, "partition_id": n % 4} for n in range(1, 41) for b in "bc"]
    )
    store.append_run("r1", rows)
    store.compact_filters()


def test_reads_are_pruned_to_buckets_and_groups(spark, store, make):
    many_groups(store, make)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    one = [Bucket("c", 4, 4, pgroups=(2,))]
    assert keyed(store.live_mutations(one)) == sorted(f"k{n}@{n}" for n in range(1, 41) if n % 4 == 2)
    for rows in (store.live_mutations(one), store.filter_rows(one)):
        plan = plan_of(rows)
        assert "in_bucket IN (c)" in plan or "in_bucket#" in plan and "= c)" in plan
        assert "PushedFilters: [" in plan
        pushed = plan.split("PushedFilters: [", 1)[1].split("]")[0]
        assert "GreaterThanOrEqual(partition_id,2)" in pushed and "LessThanOrEqual(partition_id,2)" in pushed
        assert "EqualTo(pgroup,2)" in pushed
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    # the other bucket's files are not even looked at
    for folder in os.listdir(f"{store.home}/mutations"):
        if folder.startswith("run="):
            for name in os.listdir(f"{store.home}/mutations/{folder}/in_bucket=b"):
                if name.endswith(".parquet"):
                    with open(f"{store.home}/mutations/{folder}/in_bucket=b/{name}", "wb") as file:
                        file.write(b"not parquet")
    assert store.live_mutations([Bucket("c", 4, 4)]).count() == 40


def test_groups_move_on_when_their_tier_has_grown(store, make):
    def of(group, *seqnos):
        return pairs(make, *[(s, f"k{s % 10}") for s in seqnos], pgroup=group, partition_id=group)

    store.append_run("r1", of(0, *range(1, 9)).unionByName(of(1, 1, 2)))
    store.compact_filters(TWO_GROUPS, tier_share=0.5)
    levels = store.manifest.latest().entries.where("kind = 'filter'").select("level", "pgroup", "num_rows")
    assert sorted(map(tuple, levels.collect())) == [("l1", 0, 8), ("l1", 1, 2)]
    store.append_run("r2", of(0, 11, 12).unionByName(of(1, 11)))
    store.compact_filters(TWO_GROUPS, tier_share=0.5)
    levels = store.manifest.latest().entries.where("kind = 'filter'").select("level", "pgroup", "num_rows")
    # group 0 has two recent rows to eight, group 1 one to two
    assert sorted(map(tuple, levels.collect())) == [("l1", 0, 8), ("l1", 1, 2), ("tier", 0, 2)]
    expected = ["k1@11", "k1@11", "k2@12", "k2@2", "k3@3", "k4@4", "k5@5", "k6@6", "k7@7", "k8@8"]
    assert keyed(store.filter_rows(TWO_GROUPS)) == expected
    assert keyed(store.live_mutations(TWO_GROUPS)) == expected
    store.append_run("r3", of(0, 13, 14))
    store.compact_filters(TWO_GROUPS, tier_share=0.5)
    levels = store.manifest.latest().entries.where("kind = 'filter'").select("level", "pgroup", "num_rows")
    assert sorted(map(tuple, levels.collect())) == [("l1", 0, 8), ("l1", 1, 2)]


def test_cuts_wait_for_the_mainline_below_a_tier(store, make):
    """The row below a cut one comes back; the cut meets the mainline when it is merged."""
    store.append_run("r1", pairs(make, *[(s, f"k{s}") for s in range(1, 6)]))
    store.compact_filters(ONE, tier_share=9)
    cut = make.rollback([{"seqno": 4}])
    store.append_run("r2", pairs(make, (4, "k1"), partition_uuid=7), cut)
    store.compact_filters(ONE, tier_share=9)
    assert keyed(store.filter_rows(ONE)) == ["k1@4", "k2@2", "k3@3"]
    store.append_run("r3", pairs(make, (6, "k9"), partition_uuid=7))
    store.compact_filters(ONE, tier_share=0)
    assert keyed(store.filter_rows(ONE)) == ["k1@4", "k2@2", "k3@3", "k9@6"]
    assert store.manifest.latest().entries.where("kind = 'rblog'").isEmpty()


def test_state_as_of_a_position(spark, tmp_path, make):
    store = ChangeLogStore(spark, str(tmp_path / "h"), num_buckets=4, keep_history=True)
    store.append_run("r1", pairs(make, (1, "a"), (2, "b"), (3, "a")))
    store.compact_filters(ONE)
    store.append_run("r2", pairs(make, (4, "b"), (5, "a"), (6, "c")))
    store.compact(ONE, threshold=1)
    store.vacuum()

    def at(seqno):
        return keyed(store.restore_as_of(spark.createDataFrame([("b", 0, seqno)], "bucket string, partition_id short, seqno long"), ONE))

    assert [at(n) for n in (0, 1, 2, 4, 9)] == [[], ["a@1"], ["a@1", "b@2"], ["a@3", "b@4"], ["a@5", "b@4", "c@6"]]
    assert store.forget_history(keep=1) == 1
    assert at(4) == ["a@3", "b@4"] and at(1) == []
    assert store.forget_history() == 1
    assert keyed(store.live_mutations(ONE)) == ["a@5", "b@4", "c@6"]


def test_format_of_each_run(spark, store, make):
    store.append_run("r1", pairs(make, (1, "a"), (2, "b")))
    store.compact_filters(ONE)
    orc = ChangeLogStore(spark, store.home, file_format="orc")
    orc.append_run("r2", pairs(make, (3, "a")))
    orc.compact_filters(ONE)
    assert keyed(store.mutation_rows(ONE)) == ["a@1", "a@3", "b@2"]
    assert keyed(store.live_mutations(ONE)) == ["a@3", "b@2"]
    assert paths.matches(spark, f"{store.home}/mutations/run=r2-*/in_bucket=b/*.orc")
    with pytest.raises(ValueError, match="store format"):
        ChangeLogStore(spark, store.home, file_format="csv")


def test_compaction_off_a_snapshot_others_have_passed(store, make):
    """A merge that came first is not undone, and mutations still are compacted."""
    for n in range(1, 4):
        store.append_run(f"r{n}", pairs(make, (n, "k"), (n + 10, f"once{n}")))
        if n < 3:
            store.compact_filters(ONE)
    store.create_snapshot("s")
    store.append_run("r4", pairs(make, (9, "k")))
    store.compact_filters(ONE)
    store.compact(ONE, threshold=1, snapshot="s")
    live = ["k@9", "once1@11", "once2@12", "once3@13"]
    assert keyed(store.live_mutations(ONE)) == live
    assert keyed(store.mutation_rows(ONE)) == live


def test_records_of_streams_do_not_pile_up(store, make):
    for n in range(3):
        assert store.append_run(f"s-{n}", pairs(make, (n, f"k{n}")), follows=f"s-{n - 1}" if n else None)
    assert not store.append_run("s-2", pairs(make, (9, "again")))
    applied = store.manifest.latest().of("applied", "l0")
    assert [row["run"] for row in applied.collect()] == ["s-2"]
    assert store.manifest.latest().entries.agg(F.count("*")).first()[0] == 7

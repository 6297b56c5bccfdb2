"""Filter compaction: hand-derived results, edge cases, and a brute-force model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import keyed
from tidelog.operators.filters import (
    drop_rolled_back,
    drop_superseded,
    latest_per_key,
    merge_newer,
    rollback_cuts,
)
from tidelog.operators.mutations import live_mutations
from tidelog.plans.compaction import compact, compact_filter, compact_levels
from tidelog.session import Lookup

MAX_LONG = 2**63 - 1


def rows(*pairs, **common):
    return [{"seqno": seqno, "key": key, **common} for seqno, key in pairs]


def test_two_runs(make):
    run1 = make.filter(rows((1, "k1"), (2, "k2"), (3, "k1")))
    run2 = make.filter(rows((4, "k2"), (5, "k1")))
    first = compact_filter(make.filter([]), run1)
    assert keyed(first) == ["k1@3", "k2@2"]
    assert keyed(compact_filter(first, run2)) == ["k1@5", "k2@4"]


def test_third_key(make):
    run = make.filter(rows((1, "k1"), (2, "k2"), (3, "k1"), (4, "k3")))
    assert keyed(compact_filter(make.filter([]), run)) == ["k1@3", "k2@2", "k3@4"]


def test_mapped_mutations_are_the_live_ones(make):
    pairs = [(1, "k1"), (2, "k2"), (3, "k1")]
    run, mutations = make.filter(rows(*pairs)), make.mutations(rows(*pairs))
    live = live_mutations(mutations, compact_filter(make.filter([]), run))
    assert keyed(live) == ["k1@3", "k2@2"]


def edge_case(make):
    old = make.filter(
        rows((1, "a"), (2, "b"), (3, "c"), partition_uuid=7)
        + rows((4, "d"), partition_id=1, partition_uuid=9)
    )
    new = make.filter(
        rows((5, "a"), (10, "a"), (8, "b"), (9, "e"), partition_uuid=7)
        + rows((20, "f"), partition_id=1, partition_uuid=9)
        + rows((21, "g"), partition_id=1, partition_uuid=10)
    )
    cuts = make.rollback(
        [
            {"partition_id": 0, "partition_uuid": 7, "seqno": 8},
            {"partition_id": 1, "partition_uuid": 9, "seqno": 4},
        ]
    )
    return old, new, cuts


def test_rollback_rules(make):
    assert keyed(compact_filter(*edge_case(make))) == ["a@5", "b@2", "c@3", "g@21"]


def test_levels_agree_with_pairwise_merge(make):
    old, new, cuts = edge_case(make)
    assert keyed(compact_levels([new, old], cuts)) == ["a@5", "b@2", "c@3", "g@21"]


def test_three_levels(make):
    lowest = make.filter(rows((1, "x"), (2, "y"), (9, "z")))
    middle = make.filter(rows((3, "y")))
    newest = make.filter(rows((4, "w"), (5, "z"), (6, "w")))
    assert keyed(compact_levels([newest, middle, lowest])) == ["w@6", "x@1", "y@3", "z@5"]


def test_new_row_wins_at_a_lower_seqno(make):
    old, new = make.filter(rows((50, "a"))), make.filter(rows((3, "a"), partition_uuid=2))
    assert keyed(compact_filter(old, new)) == ["a@3"]


def test_lowest_duplicate_cut_wins(make):
    log = make.rollback([{"seqno": 9}, {"seqno": 4}, {"seqno": 7}])
    assert [row["cut"] for row in rollback_cuts(log).collect()] == [4]
    new = make.filter(rows((3, "a"), (4, "b"), (9, "c")))
    assert keyed(compact_filter(make.filter([]), new, log)) == ["a@3"]


def test_group_without_new_rows_is_left_alone(make):
    old = make.filter(rows((5, "a")) + rows((6, "b"), pgroup=1, partition_id=1))
    new = make.filter(rows((7, "c"), pgroup=1, partition_id=1, partition_uuid=2))
    cuts = make.rollback([{"seqno": 1}, {"seqno": 1, "pgroup": 1, "partition_id": 1}])
    assert keyed(compact_filter(old, new, cuts)) == ["a@5", "c@7"]


def test_cut_reaches_other_partitions_branches_not_at_all(make):
    old = make.filter(rows((5, "a"), partition_uuid=1) + rows((6, "b"), partition_uuid=2))
    new = make.filter(rows((1, "z"), partition_uuid=2))
    cuts = make.rollback([{"partition_uuid": 1, "seqno": 0}])
    assert keyed(compact_filter(old, new, cuts)) == ["b@6", "z@1"]


def test_same_key_in_other_groups_and_buckets_is_another_key(make):
    old = make.filter(
        rows((1, "k")) + rows((2, "k"), pgroup=1, partition_id=1) + rows((3, "k"), bucket="c")
    )
    new = make.filter(rows((9, "k"), pgroup=1, partition_id=1))
    assert keyed(compact_filter(old, new)) == ["k@1", "k@3", "k@9"]


def test_delete_stays_as_the_latest_row(make):
    old = make.filter(rows((1, "k")))
    new = make.filter(rows((2, "k"), rec_type="DELETE"))
    assert [r["rec_type"] for r in compact_filter(old, new).collect()] == ["DELETE"]


def test_highest_seqno_survives_an_unrelated_cut(make):
    new = make.filter(rows((MAX_LONG, "k")))
    cuts = make.rollback([{"partition_id": 3, "seqno": 1}])
    assert keyed(compact_filter(make.filter([]), new, cuts)) == [f"k@{MAX_LONG}"]


def test_whole_row_of_the_latest_seqno(make):
    new = make.filter(
        [
            {"seqno": 1, "key": "k", "partition_uuid": 99, "rec_type": "INSERT"},
            {"seqno": 2, "key": "k", "partition_uuid": 5, "rec_type": "DELETE"},
        ]
    )
    row = latest_per_key(new).collect()[0]
    assert (row["seqno"], row["partition_uuid"], row["rec_type"]) == (2, 5, "DELETE")


def test_liveness_ignores_the_key(make):
    mutations = make.mutations(rows((1, "renamed"), (2, "gone")))
    assert keyed(live_mutations(mutations, make.filter(rows((1, "k"))))) == ["renamed@1"]


def test_salted_join_beyond_the_broadcast_bound(make, spark):
    """One branch holds every row; the cut must still reach each of them once."""
    many = make.filter(rows(*[(n, f"k{n}") for n in range(500)]))
    cuts = rollback_cuts(make.rollback([{"seqno": 200}]))
    beyond = Lookup(cuts, max_bytes=1)
    assert not beyond.small and Lookup(cuts).small
    assert keyed(drop_rolled_back(many, beyond)) == keyed(drop_rolled_back(many, Lookup(cuts)))
    assert drop_rolled_back(many, beyond).columns == many.columns
    inner = beyond.join(many, ["bucket", "partition_id", "partition_uuid"], "inner")
    assert inner.count() == 500


def test_dedup_uses_a_partial_hash_aggregate(make):
    plan = latest_per_key(make.filter([]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan


def test_compact_both(make):
    pairs = [(1, "k1"), (2, "k2"), (3, "k1")]
    live = compact(make.mutations(rows(*pairs)), make.filter([]), make.filter(rows(*pairs)))
    assert keyed(live) == ["k1@3", "k2@2"]


def model(old, new, cuts):
    """Compaction in plain Python, over (pgroup, partition, uuid, seqno, key) tuples."""
    groups = {row[0] for row in new}
    lowest = {}
    for pgroup, partition, uuid, seqno in cuts:
        if pgroup in groups:
            where = (partition, uuid)
            lowest[where] = min(seqno, lowest.get(where, seqno))
    keeps = lambda row: row[3] < lowest.get((row[1], row[2]), row[3] + 1)
    latest = {}
    for row in filter(keeps, new):
        where = (row[0], row[4])
        if where not in latest or row[3] > latest[where][3]:
            latest[where] = row
    kept = [row for row in old if keeps(row) and (row[0], row[4]) not in latest]
    return sorted(kept + list(latest.values()))


partitions = st.integers(0, 3)
uuids = st.integers(1, 2)
keys = st.sampled_from("abc")


@st.composite
def logs(draw):
    def side(start):
        found = draw(st.lists(st.tuples(partitions, uuids, keys), max_size=12))
        return [(p // 2, p, u, start + n, f"{k}{p}") for n, (p, u, k) in enumerate(found)]

    latest = {}
    for row in side(0):
        latest[(row[0], row[4])] = row
    new = side(draw(st.sampled_from([0, 6, 100])))
    entries = draw(st.lists(st.tuples(partitions, uuids, st.integers(0, 110)), max_size=4))
    return list(latest.values()), new, [(p // 2, p, u, s) for p, u, s in entries]


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(logs())
def test_against_the_model(make, log):
    names = ["pgroup", "partition_id", "partition_uuid", "seqno", "key"]
    old, new = [make.filter([dict(zip(names, row)) for row in side]) for side in log[:2]]
    cuts = make.rollback([dict(zip(names[:4], row)) for row in log[2]])
    expected = model(*log)

    def got(df):
        return sorted(tuple(row[name] for name in names) for row in df.collect())

    merged = compact_filter(old, new, cuts)
    assert got(merged) == expected
    assert got(compact_levels([new, old], cuts)) == expected
    deduplicated = latest_per_key(new)
    assert got(merge_newer(old, deduplicated)) == got(
        drop_superseded(old, deduplicated).unionByName(deduplicated)
    )
    per_key = {(row[0], row[4]) for row in expected}
    assert len(per_key) == len(expected)


def test_compaction_is_idempotent_and_incremental(make):
    runs = [rows((n * 3 + 1, "a"), (n * 3 + 2, f"b{n % 2}"), (n * 3 + 3, "c")) for n in range(4)]
    stepwise = make.filter([])
    for run in runs:
        stepwise = compact_filter(stepwise, make.filter(run))
    at_once = compact_filter(make.filter([]), make.filter(sum(runs, [])))
    assert keyed(stepwise) == keyed(at_once)
    assert keyed(compact_filter(at_once, at_once)) == keyed(at_once)

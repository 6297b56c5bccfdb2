"""How often inputs are read, and what is computed more than once."""

from pyspark.sql import functions as F

from tests.conftest import keyed
from tests.test_store import change, opened
from tidelog.operators.state import fold_events
from tidelog.plans.backup import as_events, run_backup
from tidelog.plans.store import Bucket, ChangeLogStore
from tidelog.session import stored
from tidelog.sources import events as sources
from tidelog.workload import store_queries

ONE = [Bucket("b", 1, 1)]


def counted(spark, rows, column):
    """`rows`, and how many of them have been computed so far."""
    seen = spark.sparkContext.accumulator(0)

    def see(value):
        seen.add(1)
        return value

    spy = F.udf(see, dict(rows.dtypes)[column]).asNondeterministic()
    return rows.withColumn(column, spy(column)), seen


def test_answers_are_asked_once(spark, make, tmp_path):
    store = ChangeLogStore(spark, str(tmp_path / "home"), num_buckets=2)
    events = make.events([change(1, "a"), change(2, "b")])
    answers, seen = counted(spark, as_events(make.events([opened([(0, 1)]), {"kind": "end", "reason": "OK", "arrival": 9}])), "kind")
    assert run_backup(store, events, "s1", ONE, answers)
    assert seen.value == 2


def test_fold_reads_events_once(spark, make, tmp_path):
    events = make.events([change(1, "a"), {"kind": "end", "reason": "OK", "arrival": 9}])
    events.write.parquet(str(tmp_path / "events"))
    events = spark.read.schema(events.schema).parquet(str(tmp_path / "events"))
    control = stored(events.where("kind = 'end'"))
    folded = fold_events(events, control)
    assert folded._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert folded.collect() == fold_events(events).collect()


def test_values_are_parsed_once(spark, tmp_path):
    spark.createDataFrame([], sources.RECORD).write.parquet(str(tmp_path / "topic"))
    decoded = sources.decode_records(spark.read.schema(sources.RECORD).parquet(str(tmp_path / "topic")))
    for rows in (sources.accepted_events(decoded), sources.rejected_records(decoded)):
        assert rows._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def plan_of_live(store):
    return store.live_mutations(ONE)._jdf.queryExecution().executedPlan().toString()


def test_only_live_rows_are_made_distinct(spark, make, tmp_path):
    store = ChangeLogStore(spark, str(tmp_path / "home"), num_buckets=2)
    for run in ("r1", "again"):
        store.append_run(run, make.mutations([{"seqno": 1, "key": "a"}, {"seqno": 2, "key": "a"}]))
        store.compact_filters(ONE)
    plan = plan_of_live(store)
    assert plan.index("Aggregate") < plan.index("Join")
    assert keyed(store.live_mutations(ONE)) == ["a@2"]


def test_runs_without_repeated_rows_are_not_made_distinct(spark, make, tmp_path):
    store = ChangeLogStore(spark, str(tmp_path / "home"), num_buckets=2)
    for run, seqno in (("r1", 1), ("r2", 2)):
        store.append_run(run, make.mutations([{"seqno": seqno, "key": f"k{seqno}"}]))
        store.compact_filters(ONE)
    assert "Aggregate" not in plan_of_live(store)
    assert keyed(store.live_mutations(ONE)) == ["k1@1", "k2@2"]


def test_early_events_are_not_joined_to_themselves(spark, monkeypatch):
    plans = []

    def backup(store, events, *args):
        plans.append(events._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(store_queries, "run_backup", backup)
    monkeypatch.setattr(store_queries, "built_once", lambda spark, sf_dir, what, build: build())
    for build in (store_queries.backed_up_store, store_queries.retried_backup):
        build(spark, "/root/testdata/sf0.001")
    assert len(plans) == 4 and not any("Join" in plan for plan in plans)

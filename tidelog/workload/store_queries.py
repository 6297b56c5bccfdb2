"""Registered queries that go through files: formats, the store, backups, streams.

Their scratch files lie in the shared folder the session names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import records
from tidelog.functions.scalars import content_text
from tidelog.operators import filters, ranges
from tidelog.plans.backup import as_events, read_catalog, run_backup
from tidelog.plans.store import Bucket, ChangeLogStore, group_outcomes
from tidelog.schemas import CHANGE_EVENTS, MUTATIONS
from tidelog.session import Lookup, scratch_path, stored
from tidelog.sources import events as event_sources
from tidelog.sources import files, paths
from tidelog.streaming.capture import capture_stream
from tidelog.streaming.progress import counter_stream, read_state, track_state
from tidelog.workload import changelog as log
from tidelog.workload.oracle import FILTER as FILTER_SQL
from tidelog.workload.oracle import LIVE, over_changes, over_orders, over_ranges
from tidelog.workload.queries import (
    BUCKETS,
    COUNTERS_SQL,
    ORACLE,
    STATE_SQL,
    LengthMapper,
    query,
    readable,
    stream,
)

_built: dict[tuple[str, str, str], object] = {}


def built_once(spark: SparkSession, sf_dir: str, what: str, build):
    """Build a store or stream once per application and data set."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _built:
        _built[key] = build()
    return _built[key]


# --- file formats ---------------------------------------------------------------


@query("filter_file_formats", over_changes(
    f"SELECT {FILTER_SQL}, format FROM f1,"
    " (VALUES ('parquet'), ('orc'), ('json'), ('csv')) formats(format)"))
def filter_file_formats(spark, sf_dir):
    """The mainline filter written to, and read from, each file format."""
    rows = log.mainline_filter(spark, sf_dir)
    home = scratch_path(spark, "formats")
    result = None
    for name in files.FORMATS:
        files.write_rows(rows, f"{home}/{name}", name)
        part = files.read_filter_or_empty(spark, f"{home}/{name}", name).withColumn(
            "format", F.lit(name)
        )
        result = part if result is None else result.unionByName(part)
    return result


@query("mutation_file_formats", over_changes(
    f"SELECT {LIVE}, seqno AS cas, format FROM chg,"
    " (VALUES ('parquet'), ('orc'), ('json'), ('csv')) formats(format)"))
def mutation_file_formats(spark, sf_dir):
    """Mutations with their binary content through columnar and text formats."""
    rows = log.mutations(spark, sf_dir)
    home = scratch_path(spark, "formats")
    result = None
    for name in files.FORMATS:
        files.write_rows(rows, f"{home}/{name}", name)
        part = files.read_mutations_or_empty(spark, f"{home}/{name}", name)
        part = part.select(*readable(part).columns[:-1], content_text(F.col("content")).alias("content"), "cas")
        part = part.withColumn("format", F.lit(name))
        result = part if result is None else result.unionByName(part)
    return result


@query("rollback_log_file", over_changes("SELECT * FROM rblog"))
def rollback_log_file(spark, sf_dir):
    """The rollback log written as text, read back, and reduced to its cuts."""
    path = scratch_path(spark, "rblog")
    files.write_rollback_log(log.rollback_log(spark, sf_dir), path)
    return filters.rollback_cuts(files.read_rollback_log_or_empty(spark, path))


@query("listed_files", over_changes("SELECT level, count(*) AS n, true AS is_folder FROM chg GROUP BY level"))
def listed_files(spark, sf_dir):
    """Rows in the files that a glob lists below each checked folder."""
    home = scratch_path(spark, "listed")
    level = F.when(F.col("ts") < log.at(log.LEVEL_SPLIT), "l1").otherwise("l0").alias("level")
    log.changes(spark, sf_dir).select(level, "seqno").write.partitionBy("level").parquet(home)
    parts = []
    for level in ("l0", "l1"):
        found = paths.list_files(spark, f"{home}/level={level}/part-*")
        names = [row["path"] for row in found.where("length > 0").select("path").collect()]
        rows = spark.read.parquet(*names).agg(F.count("*").alias("n"))
        folder = paths.is_folder(spark, f"{home}/level={level}") and not paths.is_folder(spark, names[0])
        parts.append(rows.select(F.lit(level).alias("level"), "n", F.lit(folder).alias("is_folder")))
    return parts[0].unionByName(parts[1])


# --- store ----------------------------------------------------------------------


def two_run_store(spark, sf_dir) -> ChangeLogStore:
    """Old changes as a first run, new ones with rollbacks as a second; all compacted."""

    def build() -> ChangeLogStore:
        store = ChangeLogStore(spark, scratch_path(spark, "store"))
        store.append_run("first", log.old_changes(spark, sf_dir).select(*MUTATIONS.names))
        store.compact_filters(BUCKETS)
        store.create_snapshot("first")
        store.append_run(
            "second",
            log.new_changes(spark, sf_dir).select(*MUTATIONS.names),
            log.rollback_log(spark, sf_dir),
        )
        store.compact_filters(BUCKETS)
        store.create_snapshot("second")
        store.compact_mutations(BUCKETS, threshold=1)
        store.publish_compacted_mutations(BUCKETS)
        store.vacuum()
        return store

    return built_once(spark, sf_dir, "store", build)


@query("store_filter", over_changes(f"SELECT {FILTER_SQL} FROM compacted"))
def store_filter(spark, sf_dir):
    return two_run_store(spark, sf_dir).filter_rows(BUCKETS)


@query("store_live_before_compaction", over_changes(f"SELECT {LIVE} FROM live"))
def store_live_before_compaction(spark, sf_dir):
    """Live rows while stale mutations are still on file."""
    return readable(two_run_store(spark, sf_dir).live_mutations(BUCKETS, snapshot="second"))


@query("store_compacted_mutations", over_changes(f"SELECT {LIVE} FROM live"))
def store_compacted_mutations(spark, sf_dir):
    """All mutations on file once compacted and published."""
    return readable(two_run_store(spark, sf_dir).mutation_rows(BUCKETS))


@query("store_snapshot_restore", over_changes(
    f"SELECT {', '.join('m.' + c for c in LIVE.split(', '))} FROM chg m JOIN f1 f"
    " ON m.bucket = f.bucket AND m.partition_id = f.partition_id"
    " AND m.partition_uuid = f.partition_uuid AND m.seqno = f.seqno WHERE m.rec_type <> 'DELETE'"))
def store_snapshot_restore(spark, sf_dir):
    """Restore of the first snapshot, after later runs and clean-up."""
    return readable(
        two_run_store(spark, sf_dir).restore(BUCKETS, snapshot="first", include_deletes=False)
    )


@query("store_map_mutations", over_changes(
    "SELECT key, seqno * 2 AS doubled, CAST(strlen(content) AS BIGINT) AS content_len FROM live"))
def store_map_mutations(spark, sf_dir):
    return two_run_store(spark, sf_dir).map_mutations(
        LengthMapper(), "key string, doubled bigint, content_len bigint", BUCKETS
    )


@query("live_after_recapture", over_changes(f"SELECT {LIVE} FROM live"))
def live_after_recapture(spark, sf_dir):
    """Live rows where two runs captured the same old changes."""
    store = ChangeLogStore(spark, scratch_path(spark, "recaptured"))
    old = log.old_changes(spark, sf_dir).select(*MUTATIONS.names)
    for run in ("first", "again"):
        store.append_run(run, old)
        store.compact_filters(BUCKETS)
    new = log.new_changes(spark, sf_dir).select(*MUTATIONS.names)
    store.append_run("second", new, log.rollback_log(spark, sf_dir))
    store.compact_filters(BUCKETS)
    return readable(store.live_mutations(BUCKETS))


@query("store_open_groups", over_changes(
    "SELECT DISTINCT pgroup, 'all' AS seen, 'complete' AS outcome FROM chg UNION ALL"
    " SELECT DISTINCT pgroup, 'even', CASE WHEN pgroup % 2 = 0 THEN 'complete'"
    " ELSE concat('group default/', pgroup, ' lacks filter or mutations') END FROM chg"))
def store_open_groups(spark, sf_dir):
    """Groups of the store with both their parts, and with mutations of even groups only."""
    version = two_run_store(spark, sf_dir).manifest.latest()
    filter_of, mutations_of = version.of("filter", "l1"), version.of("mutations", "l1")
    every = group_outcomes(filter_of, mutations_of).withColumn("seen", F.lit("all"))
    even = group_outcomes(filter_of, mutations_of.where("pgroup % 2 = 0")).withColumn("seen", F.lit("even"))
    return every.unionByName(even).select("pgroup", "seen", "outcome")


ORDERS_BUCKET = Bucket("orders", log.ORDER_PARTITIONS, log.ORDER_GROUPS)


def both_logs(spark, sf_dir, level: str) -> DataFrame:
    """Mutations of both buckets at a level."""
    own = {"l1": log.old_changes, "l0": log.new_changes}[level](spark, sf_dir)
    orders = records.lift_to_mutations(log.order_changes(spark, sf_dir).where(F.col("level") == level))
    return own.select(*MUTATIONS.names).unionByName(orders.select(*MUTATIONS.names))


@query("store_restore_one_bucket", over_orders(
    f"SELECT {LIVE} FROM ochg m WHERE pgroup = 2 AND rec_type <> 'DELETE' AND EXISTS (SELECT 1 FROM ocompacted f"
    " WHERE f.bucket = m.bucket AND f.partition_id = m.partition_id"
    " AND f.partition_uuid = m.partition_uuid AND f.seqno = m.seqno)"))
def store_restore_one_bucket(spark, sf_dir):
    """One group of one of two buckets, for which the other files are left alone."""
    store = ChangeLogStore(spark, scratch_path(spark, "pruned"))
    everything = [*BUCKETS, ORDERS_BUCKET]
    store.append_run("first", both_logs(spark, sf_dir, "l1"))
    store.compact_filters(everything)
    cuts = log.rollback_log(spark, sf_dir).unionByName(log.order_rollback_log(spark, sf_dir))
    store.append_run("second", both_logs(spark, sf_dir, "l0"), cuts)
    store.compact_filters(everything)
    group = Bucket("orders", log.ORDER_PARTITIONS, log.ORDER_GROUPS, pgroups=(2,))
    return readable(store.restore([group], include_deletes=False))


def three_runs(spark, sf_dir, name: str, last_share: float) -> ChangeLogStore:
    """An old run in the mainline, one in the tier above, and a new one with rollbacks."""
    store = ChangeLogStore(spark, scratch_path(spark, name))
    old = log.old_changes(spark, sf_dir)
    early = F.col("ts") < log.at("2024-01-08 00:00:00")
    store.append_run("early", old.where(early).select(*MUTATIONS.names))
    store.compact_filters(BUCKETS, tier_share=10)
    store.append_run("middle", old.where(~early).select(*MUTATIONS.names))
    store.compact_filters(BUCKETS, tier_share=10)
    new = log.new_changes(spark, sf_dir).select(*MUTATIONS.names)
    store.append_run("late", new, log.rollback_log(spark, sf_dir))
    store.compact_filters(BUCKETS, tier_share=last_share)
    return store


@query("store_three_levels", ORACLE["three_level_compact"])
def store_three_levels(spark, sf_dir):
    """New rows, tier and mainline merged at once, as the tier has grown large enough."""
    return three_runs(spark, sf_dir, "three-levels", 0).filter_rows(BUCKETS)


@query("store_tier_over_mainline", ORACLE["three_level_compact"])
def store_tier_over_mainline(spark, sf_dir):
    """New rows merged into the tier only, which reads lay over the mainline."""
    return three_runs(spark, sf_dir, "tier", 10).filter_rows(BUCKETS)


@query("store_mixed_formats", over_changes(f"SELECT {LIVE} FROM live"))
def store_mixed_formats(spark, sf_dir):
    """Live rows of a Parquet run and an ORC run, under a filter merged from both."""
    home = scratch_path(spark, "mixed")
    first = ChangeLogStore(spark, home)
    first.append_run("first", log.old_changes(spark, sf_dir).select(*MUTATIONS.names))
    first.compact_filters(BUCKETS)
    second = ChangeLogStore(spark, home, file_format="orc")
    new = log.new_changes(spark, sf_dir).select(*MUTATIONS.names)
    second.append_run("second", new, log.rollback_log(spark, sf_dir))
    second.compact_filters(BUCKETS)
    return readable(first.live_mutations(BUCKETS))


@query("restore_as_of", over_changes(
    ", pos AS (SELECT partition_id, CAST(floor(max(seqno) * 3 / 4) AS BIGINT) AS p FROM chg GROUP BY ALL),"
    " been AS (SELECT c.*, row_number() OVER (PARTITION BY c.bucket, c.pgroup, c.key ORDER BY c.seqno DESC) AS rn"
    " FROM chg c JOIN pos ON c.partition_id = pos.partition_id AND c.seqno <= pos.p LEFT JOIN rblog r"
    " ON c.bucket = r.bucket AND c.partition_id = r.partition_id AND c.partition_uuid = r.partition_uuid"
    f" WHERE r.cut IS NULL OR c.seqno < r.cut) SELECT {LIVE} FROM been WHERE rn = 1"))
def restore_as_of(spark, sf_dir):
    """The state at three quarters of each partition's log, after compactions and clean-up."""
    store = ChangeLogStore(spark, scratch_path(spark, "history"), keep_history=True)
    store.append_run("first", log.old_changes(spark, sf_dir).select(*MUTATIONS.names))
    store.compact_filters(BUCKETS)
    new = log.new_changes(spark, sf_dir).select(*MUTATIONS.names)
    store.append_run("second", new, log.rollback_log(spark, sf_dir))
    store.compact(BUCKETS, threshold=1)
    store.vacuum()
    ends = log.changes(spark, sf_dir).groupBy("bucket", "partition_id").agg(F.max("seqno").alias("end"))
    positions = ends.selectExpr("bucket", "partition_id", "`end` * 3 DIV 4 AS seqno")
    return readable(store.restore_as_of(positions, BUCKETS))


@query("compact_both_from_snapshot", over_changes(f"SELECT {LIVE} FROM live"))
def compact_both_from_snapshot(spark, sf_dir):
    """Filters and mutations compacted off a snapshot; a run that came later stays new."""
    store = ChangeLogStore(spark, scratch_path(spark, "both-off-snapshot"))
    store.append_run("first", log.old_changes(spark, sf_dir).select(*MUTATIONS.names))
    store.compact_filters(BUCKETS)
    new = log.new_changes(spark, sf_dir).select(*MUTATIONS.names)
    store.append_run("second", new, log.rollback_log(spark, sf_dir))
    store.create_snapshot("second")
    store.append_run("again", log.old_changes(spark, sf_dir).select(*MUTATIONS.names))
    store.compact(BUCKETS, threshold=1, snapshot="second")
    return readable(store.mutation_rows(BUCKETS))


@query("backup_two_attempts", over_changes(f"SELECT {LIVE} FROM live"))
def backup_two_attempts(spark, sf_dir):
    """Live rows after a second attempt at a published run, which dies, and a third, which ends."""
    store = ChangeLogStore(spark, scratch_path(spark, "attempts"))
    old = log.old_changes(spark, sf_dir).select(*MUTATIONS.names)
    store.append_run("first", old)
    late = ChangeLogStore(spark, store.home)
    # both had asked before the first one was published
    late.is_applied = lambda run: False
    publish = late.manifest.change

    def dies(*args, **kwargs):
        raise OSError("lost after writing")

    late.manifest.change = dies
    try:
        late.append_run("first", old)
    except OSError:
        late.manifest.change = publish
    if late.append_run("first", old):
        raise RuntimeError("a run was published twice")
    store.compact_filters(BUCKETS)
    new = log.new_changes(spark, sf_dir).select(*MUTATIONS.names)
    store.append_run("second", new, log.rollback_log(spark, sf_dir))
    store.compact_filters(BUCKETS)
    return readable(store.live_mutations(BUCKETS))


@query("compact_from_snapshot", over_orders(
    f"SELECT {LIVE} FROM live UNION ALL SELECT {LIVE} FROM ochg WHERE level = 'l1'"))
def compact_from_snapshot(spark, sf_dir):
    """Mutations on file after a compaction off a snapshot; the orders came in later."""
    store = ChangeLogStore(spark, scratch_path(spark, "off-snapshot"))
    store.append_run("first", log.old_changes(spark, sf_dir).select(*MUTATIONS.names))
    store.compact_filters(BUCKETS)
    new = log.new_changes(spark, sf_dir).select(*MUTATIONS.names)
    store.append_run("second", new, log.rollback_log(spark, sf_dir))
    store.compact_filters(BUCKETS)
    store.create_snapshot("second")
    everything = [*BUCKETS, ORDERS_BUCKET]
    orders = records.lift_to_mutations(log.order_changes(spark, sf_dir).where(F.col("level") == "l1"))
    store.append_run("orders", orders.select(*MUTATIONS.names))
    store.compact_filters(everything)
    store.compact_mutations(everything, threshold=1, snapshot="second")
    store.publish_compacted_mutations(everything)
    return readable(store.mutation_rows(everything))


@query("snapshot_changes", over_changes(
    f"SELECT {LIVE}, 'before' AS compaction FROM chg WHERE level = 'l0' UNION ALL SELECT {LIVE}, 'after' FROM"
    " (SELECT *, row_number() OVER (PARTITION BY bucket, pgroup, key ORDER BY seqno DESC) AS rn"
    " FROM chg WHERE level = 'l0') t WHERE rn = 1"))
def snapshot_changes(spark, sf_dir):
    """What one of two runs captured, and what a compaction has left of it on file."""
    store = ChangeLogStore(spark, scratch_path(spark, "runs"))
    store.append_run("first", log.old_changes(spark, sf_dir).select(*MUTATIONS.names))
    store.append_run("second", log.new_changes(spark, sf_dir).select(*MUTATIONS.names))
    before = readable(store.changes("second")).withColumn("compaction", F.lit("before"))
    store.compact(BUCKETS, threshold=1)
    after = readable(store.changes("second", BUCKETS)).withColumn("compaction", F.lit("after"))
    return before.unionByName(after)


# --- backups --------------------------------------------------------------------


def backed_up_store(spark, sf_dir) -> ChangeLogStore:
    """Two backups of the same source, taken before and after the level split."""

    def build() -> ChangeLogStore:
        store = ChangeLogStore(spark, scratch_path(spark, "backup"))
        stream = log.data_stream(spark, sf_dir)
        early = log.data_stream(spark, sf_dir, log.old_changes(spark, sf_dir))
        early = early.where("seqno IS NOT NULL AND partition_id IS NOT NULL")
        run_backup(store, early, "monday", BUCKETS)
        store.compact_filters(BUCKETS)
        run_backup(store, stream, "tuesday", BUCKETS)
        store.compact_filters(BUCKETS)
        return store

    return built_once(spark, sf_dir, "backup", build)


PUTS = "FROM chg WHERE rec_type <> 'INSERT'"


@query("backup_filter", over_changes(
    "SELECT bucket, pgroup, partition_id, partition_uuid, seqno, key,"
    " CASE WHEN rec_type = 'DELETE' THEN 'DELETE' ELSE 'UPDATE' END AS rec_type"
    " FROM (SELECT *, row_number() OVER (PARTITION BY bucket, pgroup, key ORDER BY seqno DESC) AS rn"
    f" {PUTS}) t WHERE rn = 1"))
def backup_filter(spark, sf_dir):
    """Mainline filter after two incremental backups; markers are not data."""
    return backed_up_store(spark, sf_dir).filter_rows(BUCKETS)


@query("backup_mainline", over_changes(
    "SELECT bucket, partition_id, 'tuesday' AS snapshot_id, CAST(2 AS BIGINT) AS run_number,"
    " 'Closed' AS state, max(seqno) AS last_seen_seqno,"
    " max_by(partition_uuid, seqno) AS uuid,"
    " count(CASE WHEN level = 'l0' AND rec_type = 'UPDATE' THEN 1 END) AS num_mutations,"
    " count(CASE WHEN level = 'l0' AND rec_type = 'DELETE' THEN 1 END) AS num_deletions"
    f" {PUTS} GROUP BY bucket, partition_id"))
def backup_mainline(spark, sf_dir):
    """Latest recorded state of each partition after two backups."""
    return ranges.mainline(read_catalog(backed_up_store(spark, sf_dir))).select(
        "bucket",
        "partition_id",
        "snapshot_id",
        "run_number",
        "state",
        "last_seen_seqno",
        F.col("failover_log")[0]["uuid"].alias("uuid"),
        "num_mutations",
        "num_deletions",
    )


LATEST_PUTS = (
    "SELECT bucket, pgroup, partition_id, {} AS partition_uuid, seqno, key,"
    " CASE WHEN rec_type = 'DELETE' THEN 'DELETE' ELSE 'UPDATE' END AS rec_type"
    " FROM (SELECT *, row_number() OVER (PARTITION BY bucket, pgroup, key ORDER BY seqno DESC) AS rn {}) t WHERE rn = 1"
)


@query("backup_after_failure", over_changes(LATEST_PUTS.format("partition_uuid", PUTS)))
def backup_after_failure(spark, sf_dir):
    """A backup that broke before it was published, repeated under its name."""
    store = ChangeLogStore(spark, scratch_path(spark, "broken"))
    stream = log.data_stream(spark, sf_dir)

    def broken(*args):
        raise OSError("lost before publishing")

    store.manifest.publish = broken
    try:
        run_backup(store, stream, "monday", BUCKETS)
    except OSError:
        del store.manifest.publish
    run_backup(store, stream, "monday", BUCKETS)
    store.compact_filters(BUCKETS)
    return store.filter_rows(BUCKETS)


@query("backup_after_rollback", over_changes(LATEST_PUTS.format(
    "CAST(partition_id * 10 + CASE WHEN seqno >= r THEN 2 ELSE 1 END AS BIGINT)",
    "FROM chg LEFT JOIN (SELECT partition_id AS p, CAST(floor(max(seqno) / 2) AS BIGINT) AS r"
    " FROM chg WHERE rec_type <> 'INSERT' AND level = 'l1' AND partition_id % 4 = 2 GROUP BY ALL)"
    " ON partition_id = p WHERE rec_type <> 'INSERT'")))
def backup_after_rollback(spark, sf_dir):
    """Partitions sent back to half of what they had, captured again on a new branch.

    Events carry no branch, so each row's branch is the one its range was opened on.
    """
    store = ChangeLogStore(spark, scratch_path(spark, "sent-back"))
    stream = log.data_stream(spark, sf_dir).drop("partition_uuid")
    early = ranges.data_events(stream).join(
        log.old_changes(spark, sf_dir).select("bucket", "partition_id", "seqno"),
        ["bucket", "partition_id", "seqno"],
        "left_semi",
    )
    half = early.groupBy("bucket", "partition_id").agg(F.expr("max(seqno) div 2").alias("r"))
    opened = "array(named_struct('uuid', partition_id * 10L + {0}, 'seqno', {1}))"
    columns = ["bucket", "partition_id", "0L AS arrival"]
    first = as_events(half.selectExpr(*columns, "'opened' AS kind", f"{opened.format(1, '0L')} AS failover_log"))
    back = half.where("partition_id % 4 = 2")
    refused = as_events(back.selectExpr(*columns, "'rollback' AS kind", "r AS seqno"))
    again = as_events(back.selectExpr(*columns, "'opened' AS kind", f"{opened.format(2, 'r - 1')} AS failover_log"))
    kept = first.where("partition_id % 4 <> 2")
    for name, events, answers in (
        ("monday", early, first),
        ("tuesday", stream, kept.unionByName(refused)),
        ("wednesday", stream, again),
    ):
        run_backup(store, events, name, BUCKETS, answers)
        store.compact_filters(BUCKETS)
    return store.filter_rows(BUCKETS)


def retried_backup(spark, sf_dir) -> ChangeLogStore:
    """A second backup in which partitions stay open or are sent back, and are asked for again."""

    def build() -> ChangeLogStore:
        store = ChangeLogStore(spark, scratch_path(spark, "retried"))
        stream = ranges.data_events(log.data_stream(spark, sf_dir).drop("partition_uuid"))
        early = log.data_stream(spark, sf_dir, log.old_changes(spark, sf_dir)).drop("partition_uuid")
        early = ranges.data_events(early).where("seqno IS NOT NULL AND partition_id IS NOT NULL")
        half = stored(early.groupBy("bucket", "partition_id").agg(F.expr("max(seqno) div 2").alias("r")))
        opened = "array(named_struct('uuid', partition_id * 10L + {0}, 'seqno', {1}))"
        columns = ["bucket", "partition_id", "0L AS arrival"]
        first = as_events(half.selectExpr(*columns, "'opened' AS kind", f"{opened.format(1, '0L')} AS failover_log"))
        run_backup(store, early, "monday", BUCKETS, first)
        store.compact_filters(BUCKETS)

        def source(asked: DataFrame, attempt: int) -> DataFrame:
            """The first time, partitions 4n+1 break off half way and 4n+2 are sent back."""
            asked = asked.select("bucket", "partition_id", "start_seqno", "end_seqno").join(half, ["bucket", "partition_id"])
            back = f"(partition_id % 4 = 2 AND {attempt} = 0)"
            part = f"(partition_id % 4 = 1 AND {attempt} = 0)"
            upto = f"CASE WHEN {back} THEN start_seqno WHEN {part} THEN (start_seqno + end_seqno) DIV 2 ELSE end_seqno END"
            asked = asked.selectExpr("*", f"{upto} AS upto")
            answers = as_events(asked.where(f"NOT {back}").selectExpr(
                *columns, "'opened' AS kind",
                f"IF(partition_id % 4 = 2, {opened.format(2, 'r - 1')}, {opened.format(1, '0L')}) AS failover_log",
            ))
            ended = asked.where(f"NOT {back} AND NOT {part}").selectExpr(
                "bucket", "partition_id", "end_seqno + 1 AS arrival", "'end' AS kind", "'OK' AS reason"
            )
            refused = asked.where(back).selectExpr(*columns, "'rollback' AS kind", "r AS seqno")
            wanted = Lookup(asked.select("bucket", "partition_id", "start_seqno", "upto"))
            inside = "l.seqno > r.start_seqno AND l.seqno <= r.upto"
            sent = as_events(wanted.join(stream, ["bucket", "partition_id"], "left_semi", inside))
            return answers.unionByName(as_events(ended)).unionByName(as_events(refused)).unionByName(sent)

        run_backup(store, stream, "tuesday", BUCKETS, source)
        store.compact_filters(BUCKETS)
        return store

    return built_once(spark, sf_dir, "retried", build)


#: Rows of the second backup: what came after the first, and all from half way on where sent back.
SECOND = (
    "FROM chg JOIN (SELECT partition_id AS p, CAST(floor(max(seqno) / 2) AS BIGINT) AS r, max(seqno) AS seen"
    " FROM chg WHERE rec_type <> 'INSERT' AND level = 'l1' GROUP BY ALL) ON partition_id = p"
    " WHERE rec_type <> 'INSERT' AND seqno > CASE WHEN partition_id % 4 = 2 THEN r - 1 ELSE seen END"
)


@query("backup_with_retries", over_changes(
    "SELECT bucket, partition_id, 'Closed' AS state, max(seqno) AS last_seen_seqno,"
    " CAST(partition_id * 10 + CASE WHEN partition_id % 4 = 2 THEN 2 ELSE 1 END AS BIGINT) AS uuid,"
    " count(CASE WHEN rec_type = 'UPDATE' THEN 1 END) AS num_mutations,"
    " count(CASE WHEN rec_type = 'DELETE' THEN 1 END) AS num_deletions,"
    " CAST(CASE WHEN partition_id % 4 = 1 THEN 1 ELSE 0 END AS BIGINT) AS num_retries_reason_open,"
    " CAST(CASE WHEN partition_id % 4 = 2 THEN 1 ELSE 0 END AS BIGINT) AS num_retries_reason_stale"
    f" {SECOND} GROUP BY bucket, partition_id"))
def backup_with_retries(spark, sf_dir):
    """State and counters of each partition after a backup that had to ask twice."""
    latest = ranges.mainline(read_catalog(retried_backup(spark, sf_dir)))
    return latest.select(
        "bucket", "partition_id", "state", "last_seen_seqno", F.col("failover_log")[0]["uuid"].alias("uuid"),
        "num_mutations", "num_deletions", "num_retries_reason_open", "num_retries_reason_stale",
    )


@query("backup_with_retries_filter", ORACLE["backup_after_rollback"])
def backup_with_retries_filter(spark, sf_dir):
    """The filter after it: rows of the branch that was left are gone, resumed ones are there once."""
    return retried_backup(spark, sf_dir).filter_rows(BUCKETS)


# --- streams --------------------------------------------------------------------


def event_files(spark, sf_dir) -> str:
    """The change stream as files, for the streaming reader."""

    def build() -> str:
        path = scratch_path(spark, "events")
        stream(spark, sf_dir).repartition(4, "bucket", "partition_id", "arrival").write.parquet(path)
        return path

    return built_once(spark, sf_dir, "events", build)


def raw_records(spark, sf_dir) -> DataFrame:
    """The change stream as a topic's records: whole, cut off, of unknown kind, empty, without key."""
    value = "to_json(struct({}))".format(", ".join(c for c in CHANGE_EVENTS.names if c not in ("bucket", "partition_id", "arrival", "key")))
    return log.data_stream(spark, sf_dir).where("kind <> 'marker'").withColumn(
        "kind", F.expr("IF(seqno % 17 = 0, 'strange', kind)")
    ).selectExpr(
        "CASE WHEN seqno % 23 <> 0 THEN binary(key) END AS key",
        f"binary(CASE WHEN seqno % 19 = 0 THEN NULL WHEN seqno % 13 = 0 THEN left({value}, 20) ELSE {value} END) AS value",
        "bucket AS topic",
        "int(partition_id) AS partition",
        "seqno AS offset",
    )


@query("decoded_records", over_changes(
    ", raw AS (SELECT *, CASE WHEN seqno % 19 <> 0 AND seqno % 13 = 0 THEN 'not an event'"
    " WHEN seqno % 19 <> 0 AND seqno % 17 = 0 THEN 'unknown kind'"
    " WHEN seqno % 23 = 0 THEN 'no key or seqno' END AS reason"
    " FROM chg WHERE rec_type <> 'INSERT')"
    " SELECT bucket, partition_id, seqno, CASE WHEN seqno % 23 <> 0 THEN key END AS key, reason,"
    " CASE WHEN reason IS NULL THEN CASE WHEN rec_type = 'DELETE' OR seqno % 19 = 0 THEN 'remove' ELSE 'mutation' END END AS kind,"
    " CASE WHEN reason IS NULL AND seqno % 19 <> 0 THEN content END AS content FROM raw"))
def decoded_records(spark, sf_dir):
    """Events of raw records, and the records that are none, set aside with the reason."""
    decoded = event_sources.decode_records(raw_records(spark, sf_dir))
    events = event_sources.accepted_events(decoded).selectExpr(
        "bucket", "partition_id", "seqno", "key", "CAST(NULL AS STRING) AS reason", "kind", "string(content) AS content"
    )
    rejected = event_sources.rejected_records(decoded).selectExpr(
        "topic AS bucket", "smallint(partition) AS partition_id", "offset AS seqno", "string(key) AS key",
        "reject_reason AS reason", "CAST(NULL AS STRING) AS kind", "CAST(NULL AS STRING) AS content",
    )
    return events.unionByName(rejected)


@query("streaming_records", over_changes(
    f"SELECT {FILTER_SQL} FROM (SELECT bucket, pgroup, partition_id, partition_uuid, seqno, key,"
    " CASE WHEN rec_type = 'DELETE' THEN 'DELETE' ELSE 'UPDATE' END AS rec_type,"
    " row_number() OVER (PARTITION BY bucket, pgroup, key ORDER BY seqno DESC) AS rn FROM chg"
    " WHERE rec_type <> 'INSERT' AND seqno % 13 <> 0 AND seqno % 17 <> 0 AND seqno % 19 <> 0 AND seqno % 23 <> 0) t WHERE rn = 1"))
def streaming_records(spark, sf_dir):
    """The filter after raw records were captured as a stream, the bad ones set aside."""
    store, home = ChangeLogStore(spark, scratch_path(spark, "records")), scratch_path(spark, "topic")
    records = raw_records(spark, sf_dir).where("offset % 19 <> 0")
    records.repartition(3, "partition").write.parquet(home)
    raw = spark.readStream.schema(event_sources.RECORD).option("maxFilesPerTrigger", 2).parquet(home)
    capture_stream(
        store, event_sources.decode_records(raw), BUCKETS, "records", scratch_path(spark, "offsets"),
        rejected_to=scratch_path(spark, "rejected"),
    ).awaitTermination()
    store.compact_filters(BUCKETS)
    return store.filter_rows(BUCKETS)


@query("streaming_capture", over_ranges(
    "SELECT bucket, pgroup, partition_id, partition_uuid, seqno, key,"
    " CASE WHEN kind = 'remove' THEN 'DELETE' ELSE 'UPDATE' END AS rec_type FROM"
    " (SELECT *, row_number() OVER (PARTITION BY bucket, pgroup, key ORDER BY seqno DESC) AS rn"
    " FROM captured WHERE kind IN ('mutation', 'remove') AND partition_id % 4 <> 2) t WHERE rn = 1"))
def streaming_capture(spark, sf_dir):
    """Mainline filter after a stream was captured in several micro-batches."""
    store = ChangeLogStore(spark, scratch_path(spark, "captured"))
    events = event_sources.stream_events(spark, event_files(spark, sf_dir), max_files=2)
    capture_stream(
        store, events, BUCKETS, "capture", scratch_path(spark, "offsets")
    ).awaitTermination()
    store.compact_filters(BUCKETS)
    return store.filter_rows(BUCKETS)


@query("streaming_state", over_ranges(STATE_SQL))
def streaming_state(spark, sf_dir):
    """Partition state folded micro-batch by micro-batch."""
    path, checkpoint = scratch_path(spark, "state"), scratch_path(spark, "offsets")
    events = event_sources.stream_events(spark, event_files(spark, sf_dir), max_files=1)
    track_state(events, path, checkpoint).awaitTermination()
    return read_state(spark, path, checkpoint).drop("failover_log")


@query("streaming_counters", over_ranges(
    f"SELECT bucket, partition_id, {COUNTERS_SQL} FROM stream GROUP BY bucket, partition_id"))
def streaming_counters(spark, sf_dir):
    """Counters as a streaming aggregate, read after the stream has been used up."""
    path = scratch_path(spark, "counters")
    events = event_sources.stream_events(spark, event_files(spark, sf_dir), max_files=2)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    (
        counter_stream(events)
        .writeStream.outputMode("complete")
        .foreachBatch(keep)
        .option("checkpointLocation", scratch_path(spark, "offsets"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    batches = spark.read.parquet(path)
    return batches.where(F.col("batch") == batches.agg(F.max("batch")).first()[0]).drop("batch")

"""Registered queries, one per operator, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import records, scalars
from tidelog.operators import filters, ranges, state
from tidelog.operators import mutations as muts
from tidelog.plans.compaction import compact, compact_filter, compact_levels
from tidelog.plans.store import Bucket, enumerate_groups
from tidelog.schemas import FILTER
from tidelog.session import stored
from tidelog.workload import changelog as log
from tidelog.workload.oracle import FILTER as FILTER_SQL
from tidelog.workload.oracle import LIVE, over_changes, over_orders, over_ranges

Query = Callable[[SparkSession, str], DataFrame]
BUCKETS = [Bucket("default", log.PARTITIONS, log.GROUPS)]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def readable(rows: DataFrame) -> DataFrame:
    """Filter columns plus the content as text."""
    return rows.select(*FILTER.names, scalars.content_text(F.col("content")).alias("content"))


# --- filter log -----------------------------------------------------------------


@query("filter_projection", over_ranges(
    "SELECT bucket, partition_id, partition_uuid, seqno, key,"
    " CASE WHEN kind = 'remove' THEN 'DELETE' ELSE 'UPDATE' END AS rec_type"
    " FROM captured WHERE kind IN ('mutation', 'remove')"))
def filter_projection(spark, sf_dir):
    captured = ranges.capture_ranges(log.data_stream(spark, sf_dir), log.ranges(spark, sf_dir))
    return records.filter_rows(ranges.data_events(captured))


@query("mutation_projection", over_ranges(
    "SELECT bucket, partition_id, partition_uuid, seqno, key,"
    " CASE WHEN kind = 'remove' THEN 'DELETE' ELSE 'UPDATE' END AS rec_type,"
    " CASE WHEN kind = 'mutation' THEN content END AS content,"
    " CASE WHEN kind = 'mutation' THEN 0 END AS expiration,"
    " CAST(1 AS BIGINT) AS revision_seqno, seqno AS cas,"
    " CAST(coalesce(CASE WHEN kind = 'mutation' THEN strlen(content) END, -1) AS INT) AS content_len"
    " FROM captured WHERE kind IN ('mutation', 'remove')"))
def mutation_projection(spark, sf_dir):
    captured = ranges.capture_ranges(log.data_stream(spark, sf_dir), log.ranges(spark, sf_dir))
    return records.mutation_rows(ranges.data_events(captured)).select(
        "bucket", "partition_id", "partition_uuid", "seqno", "key", "rec_type",
        scalars.content_text(F.col("content")).alias("content"),
        "expiration", "revision_seqno", "cas",
        scalars.content_length(F.col("content")).alias("content_len"),
    )


@query("captured_text", over_ranges(
    "SELECT bucket, partition_id, kind AS type, seqno, key,"
    " CASE WHEN kind = 'mutation' THEN content END AS value"
    " FROM captured WHERE kind IN ('mutation', 'remove')"))
def captured_text(spark, sf_dir):
    captured = ranges.capture_ranges(log.data_stream(spark, sf_dir), log.ranges(spark, sf_dir))
    return records.captured_text(ranges.data_events(captured))


@query("stamped_uuid", over_ranges(
    "SELECT c.bucket, c.partition_id, c.seqno, c.key, r.uuid AS partition_uuid"
    " FROM captured c JOIN ranges r ON c.bucket = r.bucket AND c.partition_id = r.partition_id"))
def stamped_uuid(spark, sf_dir):
    planned = planned_ranges(spark, sf_dir)
    captured = ranges.capture_ranges(log.data_stream(spark, sf_dir), planned)
    return records.stamp_uuid(captured.select("bucket", "partition_id", "seqno", "key"), planned)


@query("filter_lift", over_changes(
    f"SELECT {FILTER_SQL}, CAST(NULL AS VARCHAR) AS content, CAST(NULL AS INT) AS expiration"
    " FROM chg WHERE level = 'l0'"))
def filter_lift(spark, sf_dir):
    lifted = records.lift_to_mutations(log.new_filter(spark, sf_dir))
    return readable(lifted).withColumn("expiration", F.lit(None).cast("int"))


@query("filter_dedup", over_changes(
    f"SELECT {FILTER_SQL} FROM (SELECT *, row_number() OVER"
    " (PARTITION BY bucket, pgroup, key ORDER BY seqno DESC) AS rn FROM chg) t WHERE rn = 1"))
def filter_dedup(spark, sf_dir):
    return filters.latest_per_key(log.changes(spark, sf_dir).select(*FILTER.names))


@query("filter_dedup_by_partition", over_changes(
    "SELECT bucket, partition_id, key, max(seqno) AS seqno FROM chg GROUP BY ALL"))
def filter_dedup_by_partition(spark, sf_dir):
    return filters.latest_seqno_per_partition_key(log.changes(spark, sf_dir))


@query("distinct_keys", over_changes(
    "SELECT DISTINCT bucket, pgroup, key FROM chg WHERE level = 'l0'"))
def distinct_keys(spark, sf_dir):
    return filters.distinct_keys(log.new_filter(spark, sf_dir))


@query("distinct_seqno_tuples", over_changes(
    "SELECT DISTINCT bucket, partition_id, partition_uuid, seqno FROM compacted"))
def distinct_seqno_tuples(spark, sf_dir):
    return filters.distinct_seqno_tuples(log.compacted(spark, sf_dir))


@query("rollback_cuts", over_changes("SELECT * FROM rblog"))
def rollback_cuts(spark, sf_dir):
    return filters.rollback_cuts(log.rollback_log(spark, sf_dir))


@query("rollback_lines", over_changes("SELECT bucket, partition_id, partition_uuid, cut AS seqno FROM rblog"))
def rollback_lines(spark, sf_dir):
    """Cuts written as comma-separated lines, an extra field included, and parsed again."""
    lines = filters.rollback_cuts(log.rollback_log(spark, sf_dir)).select(
        "bucket", F.concat_ws(",", "partition_id", "partition_uuid", "cut", F.lit("x")).alias("value")
    )
    partition_id, uuid, seqno = scalars.rollback_fields(F.col("value"))
    return lines.select(
        "bucket",
        partition_id.alias("partition_id"),
        uuid.alias("partition_uuid"),
        seqno.alias("seqno"),
    )


@query("rollback_valid", over_changes(
    "SELECT c.bucket, c.pgroup, c.partition_id, c.partition_uuid, c.seqno, c.key, c.rec_type"
    " FROM chg c LEFT JOIN rblog r ON c.bucket = r.bucket AND c.partition_id = r.partition_id"
    " AND c.partition_uuid = r.partition_uuid WHERE r.cut IS NULL OR c.seqno < r.cut"))
def rollback_valid(spark, sf_dir):
    cuts = filters.rollback_cuts(log.rollback_log(spark, sf_dir))
    return filters.drop_rolled_back(log.changes(spark, sf_dir).select(*FILTER.names), cuts)


@query("superseded_keys", over_changes(
    f"SELECT {FILTER_SQL} FROM f1 a WHERE NOT EXISTS (SELECT 1 FROM chg b WHERE b.level = 'l0'"
    " AND b.bucket = a.bucket AND b.pgroup = a.pgroup AND b.key = a.key)"))
def superseded_keys(spark, sf_dir):
    """Mainline rows left when the superseded keys are gone."""
    return filters.drop_superseded(log.mainline_filter(spark, sf_dir), log.new_filter(spark, sf_dir))


@query("rolled_back_and_superseded", over_changes(
    f"SELECT {', '.join('a.' + c for c in FILTER_SQL.split(', '))} FROM f1 a LEFT JOIN rblog r"
    " ON a.bucket = r.bucket AND a.partition_id = r.partition_id AND a.partition_uuid = r.partition_uuid"
    " WHERE (r.cut IS NULL OR a.seqno < r.cut) AND NOT EXISTS (SELECT 1 FROM f0 b"
    " WHERE b.bucket = a.bucket AND b.pgroup = a.pgroup AND b.key = a.key)"))
def rolled_back_and_superseded(spark, sf_dir):
    """Mainline rows that survive both the cut and the new keys."""
    cuts = filters.Lookup(filters.rollback_cuts(log.rollback_log(spark, sf_dir)))
    new = filters.latest_per_key(filters.drop_rolled_back(log.new_filter(spark, sf_dir), cuts))
    old = filters.drop_rolled_back(log.mainline_filter(spark, sf_dir), cuts)
    return filters.drop_superseded(old, new)


@query("compact_filter", over_changes(f"SELECT {FILTER_SQL} FROM compacted"))
def compact_filter_query(spark, sf_dir):
    return log.compacted(spark, sf_dir)


@query("compact_filter_no_rollback", over_changes(
    f"SELECT {FILTER_SQL} FROM (SELECT *, row_number() OVER"
    " (PARTITION BY bucket, pgroup, key ORDER BY seqno DESC) AS rn FROM chg) t WHERE rn = 1"))
def compact_filter_no_rollback(spark, sf_dir):
    return compact_filter(log.mainline_filter(spark, sf_dir), log.new_filter(spark, sf_dir))


@query("compact_all_buckets", over_orders(
    f"SELECT {FILTER_SQL} FROM compacted UNION ALL SELECT {FILTER_SQL} FROM ocompacted"))
def compact_all_buckets(spark, sf_dir):
    """Two buckets in one job; some groups of `orders` have no new rows."""
    orders = log.order_changes(spark, sf_dir)
    old_orders = orders.where(F.col("level") == "l1").select(*FILTER.names)
    new_orders = orders.where(F.col("level") == "l0").select(*FILTER.names)
    old = log.old_changes(spark, sf_dir).select(*FILTER.names)
    return compact_filter(
        filters.latest_per_key(old.unionByName(old_orders)),
        log.new_filter(spark, sf_dir).unionByName(new_orders),
        log.rollback_log(spark, sf_dir).unionByName(log.order_rollback_log(spark, sf_dir)),
    )


@query("three_level_compact", over_changes("""
    , x0 AS (SELECT *, 0 AS depth FROM f0),
    cut_old AS (SELECT c.* FROM chg c LEFT JOIN rblog r ON c.bucket = r.bucket AND c.partition_id = r.partition_id
      AND c.partition_uuid = r.partition_uuid WHERE c.level = 'l1' AND (r.cut IS NULL OR c.seqno < r.cut)),
    mid AS (SELECT bucket, pgroup, key, max(seqno) AS seqno FROM chg
      WHERE level = 'l1' AND ts >= TIMESTAMP '2024-01-08 00:00:00' GROUP BY ALL),
    low AS (SELECT bucket, pgroup, key, max(seqno) AS seqno FROM chg
      WHERE level = 'l1' AND ts < TIMESTAMP '2024-01-08 00:00:00' GROUP BY ALL),
    x1 AS (SELECT c.bucket, c.pgroup, c.partition_id, c.partition_uuid, c.seqno, c.key, c.rec_type, 1 AS depth
      FROM cut_old c JOIN mid m ON c.bucket = m.bucket AND c.pgroup = m.pgroup AND c.key = m.key AND c.seqno = m.seqno),
    x2 AS (SELECT c.bucket, c.pgroup, c.partition_id, c.partition_uuid, c.seqno, c.key, c.rec_type, 2 AS depth
      FROM cut_old c JOIN low m ON c.bucket = m.bucket AND c.pgroup = m.pgroup AND c.key = m.key AND c.seqno = m.seqno),
    allx AS (SELECT * FROM x0 UNION ALL SELECT * FROM x1 UNION ALL SELECT * FROM x2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY bucket, pgroup, key ORDER BY depth) AS rn FROM allx)
    SELECT """.strip() + f" {FILTER_SQL} FROM ranked WHERE rn = 1"))
def three_level_compact(spark, sf_dir):
    old = log.old_changes(spark, sf_dir)
    middle = old.where(F.col("ts") >= log.at("2024-01-08 00:00:00")).select(*FILTER.names)
    lowest = old.where(F.col("ts") < log.at("2024-01-08 00:00:00")).select(*FILTER.names)
    levels = [
        log.new_filter(spark, sf_dir),
        filters.latest_per_key(middle),
        filters.latest_per_key(lowest),
    ]
    return compact_levels(levels, log.rollback_log(spark, sf_dir))


# --- gating and enumeration -----------------------------------------------------


@query("groups_needing_filter_compaction", over_orders(
    "SELECT DISTINCT bucket, pgroup FROM chg WHERE level = 'l0'"
    " UNION SELECT DISTINCT bucket, pgroup FROM ochg WHERE level = 'l0'"))
def groups_needing_filter_compaction(spark, sf_dir):
    new_orders = log.order_changes(spark, sf_dir).where(F.col("level") == "l0")
    return filters.active_groups(
        log.new_filter(spark, sf_dir).unionByName(new_orders.select(*FILTER.names))
    )


@query("groups_over_threshold", over_orders(
    "SELECT bucket, pgroup, count(DISTINCT CAST(ts AS DATE)) AS num_files FROM"
    " (SELECT bucket, pgroup, ts FROM chg UNION ALL SELECT bucket, pgroup, ts FROM ochg) t"
    " GROUP BY ALL HAVING count(DISTINCT CAST(ts AS DATE)) > 30"))
def groups_over_threshold(spark, sf_dir):
    """One mutation file per day; groups with exactly 30, a month, stay below the threshold."""
    rows = log.changes(spark, sf_dir).select("bucket", "pgroup", "ts")
    rows = rows.unionByName(log.order_changes(spark, sf_dir).select("bucket", "pgroup", "ts"))
    files = rows.select("bucket", "pgroup", F.to_date("ts").alias("file"))
    return muts.groups_over_threshold(files, threshold=30)


@query("group_enumeration", over_orders(
    "SELECT g.bucket, g.pgroup, concat('(', g.pgroup * g.width, '-', (g.pgroup + 1) * g.width - 1, ')') AS label,"
    " count(t.bucket) AS n FROM (SELECT 'default' AS bucket, CAST(x AS INT) AS pgroup, 4 AS width FROM range(4) r(x)"
    " UNION ALL SELECT 'orders', CAST(x AS INT), 4 FROM range(8) r(x)"
    " UNION ALL SELECT 'empty', CAST(x AS INT), 2 FROM range(3) r(x)) g"
    " LEFT JOIN (SELECT bucket, pgroup FROM chg UNION ALL SELECT bucket, pgroup FROM ochg) t"
    " ON g.bucket = t.bucket AND g.pgroup = t.pgroup GROUP BY g.bucket, g.pgroup, g.width"))
def group_enumeration(spark, sf_dir):
    """Every group of three buckets, one of them unused, with its label and number of changes."""
    orders = Bucket("orders", log.ORDER_PARTITIONS, log.ORDER_GROUPS)
    groups = enumerate_groups(spark, [*BUCKETS, orders, Bucket("empty", 6, 3)])
    counts = (
        log.changes(spark, sf_dir)
        .select("bucket", "pgroup")
        .unionByName(log.order_changes(spark, sf_dir).select("bucket", "pgroup"))
        .groupBy("bucket", "pgroup")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return groups.join(counts, ["bucket", "pgroup"], "left").select(
        "bucket", "pgroup", "label", F.coalesce("n", F.lit(0).cast("long")).alias("n")
    )


# --- live mutations -------------------------------------------------------------


@query("live_mutations", over_changes(f"SELECT {LIVE} FROM live"))
def live_mutations(spark, sf_dir):
    return readable(
        muts.live_mutations(log.mutations(spark, sf_dir), log.compacted(spark, sf_dir))
    )


@query("compact", over_changes(f"SELECT {LIVE} FROM live"))
def compact_both(spark, sf_dir):
    return readable(
        compact(
            log.mutations(spark, sf_dir),
            log.mainline_filter(spark, sf_dir),
            log.new_filter(spark, sf_dir),
            log.rollback_log(spark, sf_dir),
        )
    )


def live(spark, sf_dir) -> DataFrame:
    return muts.live_mutations(log.mutations(spark, sf_dir), log.compacted(spark, sf_dir))


@query("live_by_type", over_changes("SELECT bucket, rec_type, count(*) AS n FROM live GROUP BY ALL"))
def live_by_type(spark, sf_dir):
    return muts.count_by_type(live(spark, sf_dir))


@query("restore_full", over_changes(f"SELECT {LIVE} FROM live WHERE rec_type <> 'DELETE'"))
def restore_full(spark, sf_dir):
    return readable(
        muts.restore(
            log.mutations(spark, sf_dir), log.compacted(spark, sf_dir), include_deletes=False
        )
    )


@query("restore_incremental", over_ranges(
    f"SELECT {', '.join('m.' + c for c in LIVE.split(', '))} FROM live m LEFT JOIN catalog c"
    " ON m.bucket = c.bucket AND m.partition_id = c.partition_id"
    " WHERE m.seqno > coalesce(c.last_seen_seqno, -1)"))
def restore_incremental(spark, sf_dir):
    since = log.known_state(spark, sf_dir).select(
        "bucket", "partition_id", F.col("last_seen_seqno").alias("since_seqno")
    )
    return readable(
        muts.restore(log.mutations(spark, sf_dir), log.compacted(spark, sf_dir), since)
    )


@query("mask_live", over_changes(
    "SELECT bucket, pgroup, partition_id, partition_uuid, seqno, sha256(key) AS key, rec_type,"
    " regexp_replace(content, '[0-9]', '#', 'g') AS content FROM live"))
def mask_live(spark, sf_dir):
    return readable(muts.mask(live(spark, sf_dir), [("[0-9]", "#")], hash_key=True))


@query("mask_default", over_changes(
    f"SELECT {FILTER_SQL}, regexp_replace(regexp_replace(regexp_replace(content,"
    " '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS content FROM live"))
def mask_default(spark, sf_dir):
    return readable(muts.mask(live(spark, sf_dir)))


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


@query("mask_documents", (
    "SELECT CAST(doc_id AS VARCHAR) AS key, CAST(strlen(text) AS INT) AS content_len,"
    f" regexp_replace(regexp_replace(text, '{EMAIL}', '<email>', 'g'), '[0-9]', '#', 'g') AS content"
    " FROM documents"))
def mask_documents(spark, sf_dir):
    """Documents as records: mail addresses and digits of the whole text are masked."""
    rows = log.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("key"), F.col("text").cast("binary").alias("content")
    )
    sized = rows.withColumn("content_len", scalars.content_length(F.col("content")))
    masked = muts.mask(sized, [(EMAIL, "<email>", "@"), ("[0-9]", "#")])
    return masked.withColumn("content", F.col("content").cast("string"))


@query("sample_live", over_changes(
    f"SELECT {LIVE} FROM live WHERE CAST('0x' || substr(md5(key), 1, 8) AS BIGINT) < 1073741824"))
def sample_live(spark, sf_dir):
    return readable(muts.sample(live(spark, sf_dir), 0.25))


@query("sample_live_by_type", over_changes(
    f"SELECT {LIVE} FROM live WHERE CAST('0x' || substr(md5(key), 1, 8) AS BIGINT) <"
    " CASE rec_type WHEN 'UPDATE' THEN 2147483648 WHEN 'DELETE' THEN 429496729 ELSE 0 END"))
def sample_live_by_type(spark, sf_dir):
    return readable(muts.sample_by(live(spark, sf_dir), "rec_type", {"UPDATE": 0.5, "DELETE": 0.1}))


@query("sample_exact", over_changes(
    ", keys AS (SELECT DISTINCT rec_type, key FROM live),"
    " picked AS (SELECT *, row_number() OVER (PARTITION BY rec_type"
    " ORDER BY CAST('0x' || substr(md5(key), 1, 8) AS BIGINT), key) AS rn FROM keys)"
    f" SELECT {LIVE} FROM live SEMI JOIN (SELECT rec_type, key FROM picked WHERE rn <= 50) USING (rec_type, key)"))
def sample_exact(spark, sf_dir):
    """Fifty keys of each record type."""
    return readable(muts.sample_exact(live(spark, sf_dir), "rec_type", 50))


class LengthMapper(muts.MutationMapper):
    """Key, doubled seqno and content length of each record."""

    def map_batch(self, batch):
        return batch[["key"]].assign(
            doubled=batch["seqno"] * 2, content_len=batch["content"].str.len().astype("int64")
        )


@query("map_live", over_changes(
    "SELECT key, seqno * 2 AS doubled, CAST(strlen(content) AS BIGINT) AS content_len FROM live"))
def map_live(spark, sf_dir):
    return muts.map_mutations(
        log.mutations(spark, sf_dir),
        log.compacted(spark, sf_dir),
        LengthMapper(),
        "key string, doubled bigint, content_len bigint",
    )


@query("map_live_columns", over_changes(
    "SELECT key, seqno * 2 AS doubled, CAST(strlen(content) AS BIGINT) AS content_len FROM live"))
def map_live_columns(spark, sf_dir):
    """The same mapping as column expressions."""
    return muts.map_mutations(
        log.mutations(spark, sf_dir),
        log.compacted(spark, sf_dir),
        lambda rows: rows.select(
            "key",
            (F.col("seqno") * 2).alias("doubled"),
            F.octet_length("content").cast("long").alias("content_len"),
        ),
    )


@query("record_rendering", over_changes(
    "SELECT bucket, seqno, concat('(partitionId=', partition_id, ', seqNo=', seqno, ', key=', key,"
    " ', recType=', rec_type, ')') AS text, CAST(16 + 64 + 250 + 128 + 192 + strlen(content) AS INT)"
    " AS size FROM live"))
def record_rendering(spark, sf_dir):
    """Text and size estimate of each live record."""
    return live(spark, sf_dir).select(
        "bucket",
        "seqno",
        scalars.record_text().alias("text"),
        scalars.record_size(F.col("content")).alias("size"),
    )


SAME_KEY_SQL = (
    "SELECT bucket, pgroup, key, max_by(partition_uuid, seqno) AS u, max_by(rec_type, seqno) AS t FROM chg"
    " WHERE level = '{}' GROUP BY bucket, pgroup, key"
)


@query("record_equality", over_changes(
    "SELECT bucket, pgroup, key, a.u IS NOT DISTINCT FROM b.u AND a.t IS NOT DISTINCT FROM b.t AS unchanged"
    f" FROM ({SAME_KEY_SQL.format('l1')}) a FULL JOIN ({SAME_KEY_SQL.format('l0')}) b USING (bucket, pgroup, key)"))
def record_equality(spark, sf_dir):
    """The latest old record of each key beside its latest new one; one missing side is null."""
    whole = F.struct("partition_uuid", "rec_type").alias("record")
    old = filters.latest_per_key(log.old_changes(spark, sf_dir).select(*FILTER.names))
    new = filters.latest_per_key(log.new_filter(spark, sf_dir))
    keys = ["bucket", "pgroup", "key"]
    both = old.select(*keys, whole).alias("a").join(new.select(*keys, whole).alias("b"), keys, "full")
    return both.select(*keys, scalars.same_record(F.col("a.record"), F.col("b.record")).alias("unchanged"))


@query("kind_guards", over_ranges(
    "SELECT CASE rec_type WHEN 'DELETE' THEN 'remove' WHEN 'INSERT' THEN 'marker' ELSE 'mutation' END AS kind,"
    " count(*) AS accepted, true AS others_abort FROM chg GROUP BY 1"))
def kind_guards(spark, sf_dir):
    """Events accepted by the guard of each kind, and whether it aborts on all events."""
    events = log.data_stream(spark, sf_dir)

    def aborts(checked: DataFrame) -> bool:
        try:
            checked.agg(F.max("kind")).collect()
        except Exception as error:
            if "unexpected event kind" not in str(error):
                raise
            return True
        return False

    parts = [
        ranges.assert_kind(ranges.checked_events(events.where(F.col("kind") == kind)), kind)
        .groupBy("kind")
        .agg(F.count("*").alias("accepted"))
        .withColumn("others_abort", F.lit(aborts(ranges.assert_kind(events, kind))))
        for kind in ("mutation", "remove", "marker")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


class CountingSink(muts.MutationSink):
    """Takes records and keeps none."""

    def write(self, batch) -> None:
        pass


@query("delivered", over_changes("SELECT count(*) AS delivered FROM live"))
def delivered(spark, sf_dir):
    """Live records handed to a sink from the tasks that hold them."""
    count = muts.deliver(live(spark, sf_dir), CountingSink())
    return spark.range(1).select(F.lit(count).cast("long").alias("delivered"))


# --- ranges and partition state -------------------------------------------------


@query("high_seqnos", over_changes(
    "SELECT bucket, partition_id, max(seqno) AS high_seqno FROM chg GROUP BY ALL"))
def high_seqnos(spark, sf_dir):
    return ranges.high_seqnos(log.changes(spark, sf_dir))


@query("partition_count", over_orders(
    "SELECT bucket, count(DISTINCT partition_id) AS num_partitions FROM"
    " (SELECT bucket, partition_id FROM chg UNION ALL SELECT bucket, partition_id FROM ochg) t GROUP BY bucket"))
def partition_count(spark, sf_dir):
    columns = ["bucket", "partition_id"]
    return ranges.partition_count(
        log.changes(spark, sf_dir)
        .select(*columns)
        .unionByName(log.order_changes(spark, sf_dir).select(*columns))
    )


@query("plan_ranges", over_ranges(
    "SELECT *, start_seqno AS snapshot_start_seqno, start_seqno AS snapshot_end_seqno FROM ranges"))
def plan_ranges(spark, sf_dir):
    return log.ranges(spark, sf_dir)


@query("range_outcomes", over_ranges(
    "SELECT CASE WHEN end_seqno = start_seqno THEN 'unchanged' WHEN end_seqno < start_seqno"
    " THEN 'behind' ELSE 'changed' END AS outcome, count(*) AS n FROM positions GROUP BY ALL"))
def range_outcomes(spark, sf_dir):
    return ranges.range_outcomes(log.high(spark, sf_dir), log.known_state(spark, sf_dir))


@query("capture_ranges", over_ranges(
    "SELECT bucket, partition_id, partition_uuid, seqno, key, kind FROM captured"))
def capture_ranges(spark, sf_dir):
    return ranges.capture_ranges(
        log.data_stream(spark, sf_dir), log.ranges(spark, sf_dir)
    ).select("bucket", "partition_id", "partition_uuid", "seqno", "key", "kind")


def planned_ranges(spark, sf_dir) -> DataFrame:
    """The ranges as a backup run holds them: planned once, then stored."""
    return stored(log.ranges(spark, sf_dir))


def stream(spark, sf_dir, planned: DataFrame | None = None) -> DataFrame:
    """Captured data events of the accepted partitions, plus the control events."""
    if planned is None:
        planned = planned_ranges(spark, sf_dir)
    data = ranges.capture_ranges(log.data_stream(spark, sf_dir), planned)
    return data.where(F.col("partition_id") % 4 != 2).unionByName(log.control_stream(planned))


def folded(spark, sf_dir, planned: DataFrame | None = None) -> DataFrame:
    return state.partition_state(stream(spark, sf_dir, planned))


STATE_SQL = (
    "SELECT bucket, partition_id, state, last_seen_seqno, last_snapshot_start_seqno,"
    " last_snapshot_end_seqno, reason, rollback_seqno, num_snapshots, num_mutations, num_deletions,"
    " CAST(0 AS BIGINT) AS num_retries_reason_open, CAST(0 AS BIGINT) AS num_retries_reason_stale"
    " FROM state"
)


@query("data_event_filter", over_ranges(
    "SELECT bucket, partition_id, seqno, kind FROM captured WHERE kind IN ('mutation', 'remove')"
    " AND partition_id % 4 <> 2"))
def data_event_filter(spark, sf_dir):
    kept = ranges.data_events(stream(spark, sf_dir))
    return kept.select("bucket", "partition_id", "seqno", "kind")


@query("partition_state", over_ranges(STATE_SQL))
def partition_state(spark, sf_dir):
    return folded(spark, sf_dir).drop("failover_log")


@query("failover_log_text", over_ranges(
    "SELECT s.bucket, s.partition_id, CASE WHEN s.state <> 'Stale'"
    " THEN concat('{uuid=', r.uuid, ', seqno=0}') END AS text FROM state s JOIN ranges r"
    " ON s.bucket = r.bucket AND s.partition_id = r.partition_id"))
def failover_log_text(spark, sf_dir):
    return folded(spark, sf_dir).select(
        "bucket", "partition_id", scalars.failover_log_text(F.col("failover_log")).alias("text")
    )


for _state in ("Open", "Closed", "Stale"):
    QUERIES[f"{_state.lower()}_partitions"] = (
        lambda spark, sf_dir, name=_state: state.partitions_in(folded(spark, sf_dir), name).select(
            "bucket", "partition_id", "last_seen_seqno", "rollback_seqno", "reason"
        )
    )
    ORACLE[f"{_state.lower()}_partitions"] = over_ranges(
        "SELECT bucket, partition_id, last_seen_seqno, rollback_seqno, reason FROM state"
        f" WHERE state = '{_state}'"
    )

COUNTERS_SQL = (
    "count(CASE WHEN kind = 'marker' THEN 1 END) AS num_snapshots,"
    " count(CASE WHEN kind = 'mutation' THEN 1 END) AS num_mutations,"
    " count(CASE WHEN kind = 'remove' THEN 1 END) AS num_deletions,"
    " CAST(0 AS BIGINT) AS num_retries_reason_open, CAST(0 AS BIGINT) AS num_retries_reason_stale"
)


@query("partition_counters", over_ranges(
    f"SELECT bucket, partition_id, {COUNTERS_SQL} FROM stream GROUP BY bucket, partition_id"))
def partition_counters(spark, sf_dir):
    return state.partition_counters(stream(spark, sf_dir))


@query("requested_counters", over_ranges(
    f"SELECT r.bucket, r.partition_id, {COUNTERS_SQL} FROM"
    " (SELECT 'default' AS bucket, CAST(x AS SMALLINT) AS partition_id FROM range(32) q(x)) r"
    " LEFT JOIN (SELECT * FROM captured WHERE kind <> 'marker') s"
    " ON r.bucket = s.bucket AND r.partition_id = s.partition_id GROUP BY r.bucket, r.partition_id"))
def requested_counters(spark, sf_dir):
    """Counters of every requested partition; partitions from 16 on have no events."""
    requested = spark.range(32).selectExpr("'default' AS bucket", "smallint(id) AS partition_id")
    planned = planned_ranges(spark, sf_dir)
    captured = ranges.data_events(ranges.capture_ranges(log.data_stream(spark, sf_dir), planned))
    return state.counters_for(requested, state.partition_counters(captured))


@query("counters_map", over_ranges(
    "SELECT bucket, partition_id, count(CASE WHEN kind = 'mutation' THEN 1 END) AS mutations,"
    " count(CASE WHEN kind = 'remove' THEN 1 END) AS deletions, 5 AS num_stats"
    " FROM stream GROUP BY bucket, partition_id"))
def counters_map(spark, sf_dir):
    named = state.counters_map(state.partition_counters(stream(spark, sf_dir)))
    return named.select(
        "bucket",
        "partition_id",
        F.col("stats")["num_mutations"].alias("mutations"),
        F.col("stats")["num_deletions"].alias("deletions"),
        F.size("stats").alias("num_stats"),
    )


@query("total_mutations", over_ranges(
    "SELECT CAST(sum(num_mutations) AS BIGINT) AS total_mutations FROM state"))
def total_mutations(spark, sf_dir):
    return state.total_mutations(state.partition_counters(stream(spark, sf_dir)))


@query("changes_with_state", over_ranges(
    "SELECT c.bucket, c.partition_id, c.seqno, c.key, s.state, s.last_seen_seqno, s.reason"
    " FROM captured c LEFT JOIN (SELECT * FROM state WHERE state = 'Closed') s"
    " ON c.bucket = s.bucket AND c.partition_id = s.partition_id"
    " WHERE c.kind IN ('mutation', 'remove') AND c.partition_id % 4 <> 2"))
def changes_with_state(spark, sf_dir):
    planned = planned_ranges(spark, sf_dir)
    captured = ranges.data_events(stream(spark, sf_dir, planned)).select(
        "bucket", "partition_id", "seqno", "key"
    )
    return state.attach_state(captured, folded(spark, sf_dir, planned))


@query("retry_open_ranges", over_ranges(
    "SELECT r.bucket, r.partition_id, r.uuid, coalesce(s.last_seen_seqno, r.start_seqno) AS start_seqno,"
    " r.end_seqno, coalesce(s.last_snapshot_start_seqno, r.start_seqno) AS snapshot_start_seqno,"
    " coalesce(s.last_snapshot_end_seqno, r.start_seqno) AS snapshot_end_seqno"
    " FROM ranges r JOIN state s ON r.bucket = s.bucket AND r.partition_id = s.partition_id"
    " WHERE s.state = 'Open'"))
def retry_open_ranges(spark, sf_dir):
    planned = planned_ranges(spark, sf_dir)
    return ranges.retry_open_ranges(folded(spark, sf_dir, planned), planned)


RESTART_SQL = (
    "SELECT r.bucket, r.partition_id, r.uuid, greatest(s.rollback_seqno - 1, 0) AS start_seqno,"
    " r.end_seqno, greatest(s.rollback_seqno - 1, 0) AS snapshot_start_seqno,"
    " greatest(s.rollback_seqno - 1, 0) AS snapshot_end_seqno"
    " FROM ranges r JOIN state s ON r.bucket = s.bucket AND r.partition_id = s.partition_id"
    " WHERE s.state = 'Stale'"
)


@query("retry_stale_ranges", over_ranges(RESTART_SQL))
def retry_stale_ranges(spark, sf_dir):
    """Stale partitions asked for again from just below their rollback seqno."""
    planned = planned_ranges(spark, sf_dir)
    current = stored(folded(spark, sf_dir, planned))
    restart = ranges.stale_restart_ranges(current, planned)
    return ranges.retry_stale_ranges(current, restart)


@query("rollback_from_stale", over_ranges(
    "SELECT r.bucket, r.partition_id, r.uuid AS partition_uuid, s.rollback_seqno AS seqno"
    " FROM ranges r JOIN state s ON r.bucket = s.bucket AND r.partition_id = s.partition_id"
    " WHERE s.state = 'Stale'"))
def rollback_from_stale(spark, sf_dir):
    planned = planned_ranges(spark, sf_dir)
    return state.rollback_from_stale(folded(spark, sf_dir, planned), planned)


def catalog(spark, sf_dir) -> DataFrame:
    """A snapshot per day: the last seqno each partition had seen by then."""
    daily = log.changes(spark, sf_dir).groupBy(
        "bucket", "partition_id", F.to_date("ts").alias("day")
    ).agg(
        F.max_by("partition_uuid", "seqno").alias("uuid"), F.max("seqno").alias("last_seen_seqno")
    )
    return daily.select(
        F.date_format("day", "yyyy-MM-dd").alias("snapshot_id"),
        F.datediff("day", F.lit("2024-01-01").cast("date")).cast("long").alias("run_number"),
        "bucket",
        "partition_id",
        F.array(F.struct("uuid", F.lit(0).cast("long").alias("seqno"))).alias("failover_log"),
        "last_seen_seqno",
    )


@query("mainline_latest", over_changes(
    "SELECT bucket, partition_id, strftime(max(ts), '%Y-%m-%d') AS snapshot_id,"
    " max_by(partition_uuid, seqno) AS uuid, max(seqno) AS last_seen_seqno FROM chg GROUP BY ALL"))
def mainline_latest(spark, sf_dir):
    return ranges.mainline(catalog(spark, sf_dir)).select(
        "bucket",
        "partition_id",
        "snapshot_id",
        scalars.current_uuid(F.col("failover_log")).alias("uuid"),
        "last_seen_seqno",
    )


@query("snapshot_partition", over_changes(
    "SELECT bucket, partition_id, '2024-01-20' AS snapshot_id, max(seqno) AS last_seen_seqno FROM chg"
    " WHERE CAST(ts AS DATE) = DATE '2024-01-20' AND partition_id = 7 GROUP BY ALL"))
def snapshot_partition(spark, sf_dir):
    found = ranges.snapshot_partition(catalog(spark, sf_dir), "2024-01-20", 7)
    return found.select("bucket", "partition_id", "snapshot_id", "last_seen_seqno")

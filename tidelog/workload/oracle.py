"""Equivalent SQL of the registered queries, over the same tables."""

CHANGES = """
chg AS (
  SELECT 'default' AS bucket,
         CAST(floor((user_id % 16) / 4) AS INT) AS pgroup,
         CAST(user_id % 16 AS SMALLINT) AS partition_id,
         CAST((user_id % 16) * 10 + CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' THEN 1 ELSE 2 END AS BIGINT) AS partition_uuid,
         event_id AS seqno,
         concat('k', user_id, ':', event_id % 20) AS key,
         CASE WHEN event_type = 'error' THEN 'DELETE' WHEN event_type = 'signup' THEN 'INSERT' ELSE 'UPDATE' END AS rec_type,
         props AS content,
         CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'l1' ELSE 'l0' END AS level,
         ts
  FROM events),
rblog AS (
  SELECT bucket, pgroup, partition_id, partition_uuid, min(seqno) AS cut
  FROM chg
  WHERE (partition_id % 4 = 0 AND ts >= TIMESTAMP '2024-01-25 00:00:00')
     OR (partition_id % 4 = 1 AND ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00')
  GROUP BY bucket, pgroup, partition_id, partition_uuid),
f1 AS (
  SELECT bucket, pgroup, partition_id, partition_uuid, seqno, key, rec_type FROM (
    SELECT *, row_number() OVER (PARTITION BY bucket, pgroup, key ORDER BY seqno DESC) AS rn
    FROM chg WHERE level = 'l1') t WHERE rn = 1),
f0 AS (
  SELECT bucket, pgroup, partition_id, partition_uuid, seqno, key, rec_type FROM (
    SELECT c.*, row_number() OVER (PARTITION BY c.bucket, c.pgroup, c.key ORDER BY c.seqno DESC) AS rn
    FROM chg c LEFT JOIN rblog r ON c.bucket = r.bucket AND c.partition_id = r.partition_id AND c.partition_uuid = r.partition_uuid
    WHERE c.level = 'l0' AND (r.cut IS NULL OR c.seqno < r.cut)) t WHERE rn = 1),
compacted AS (
  SELECT a.* FROM f1 a
  LEFT JOIN rblog r ON a.bucket = r.bucket AND a.partition_id = r.partition_id AND a.partition_uuid = r.partition_uuid
  WHERE (r.cut IS NULL OR a.seqno < r.cut)
    AND NOT EXISTS (SELECT 1 FROM f0 b WHERE b.bucket = a.bucket AND b.pgroup = a.pgroup AND b.key = a.key)
  UNION ALL SELECT * FROM f0),
live AS (
  SELECT m.* FROM chg m
  WHERE EXISTS (SELECT 1 FROM compacted f WHERE f.bucket = m.bucket AND f.partition_id = m.partition_id
                AND f.partition_uuid = m.partition_uuid AND f.seqno = m.seqno))
"""

RANGES = """
catalog AS (
  SELECT bucket, partition_id, max_by(partition_uuid, seqno) AS uuid, max(seqno) AS last_seen_seqno
  FROM chg WHERE level = 'l1' AND partition_id <> 14 GROUP BY bucket, partition_id),
high AS (
  SELECT bucket, partition_id, max(seqno) AS high_seqno
  FROM chg WHERE NOT (partition_id = 5 AND level = 'l0') GROUP BY bucket, partition_id),
positions AS (
  SELECT h.bucket, h.partition_id, coalesce(c.uuid, 0) AS uuid,
         coalesce(c.last_seen_seqno, 0) AS start_seqno, h.high_seqno AS end_seqno
  FROM high h LEFT JOIN catalog c ON h.bucket = c.bucket AND h.partition_id = c.partition_id),
ranges AS (SELECT * FROM positions WHERE end_seqno <> start_seqno),
captured AS (
  SELECT c.*, c.seqno AS arrival,
         CASE WHEN rec_type = 'DELETE' THEN 'remove' WHEN rec_type = 'INSERT' THEN 'marker' ELSE 'mutation' END AS kind
  FROM chg c JOIN ranges r ON c.bucket = r.bucket AND c.partition_id = r.partition_id
    AND c.seqno > r.start_seqno AND c.seqno <= r.end_seqno),
stream AS (
  SELECT bucket, partition_id, arrival, seqno, kind FROM captured WHERE partition_id % 4 <> 2
  UNION ALL SELECT bucket, partition_id, -1, NULL, 'opened' FROM ranges WHERE partition_id % 4 <> 2
  UNION ALL SELECT bucket, partition_id, end_seqno + 1, NULL, 'end' FROM ranges WHERE partition_id % 4 < 2
  UNION ALL SELECT bucket, partition_id, 0, CAST(floor(start_seqno / 2) AS BIGINT), 'rollback' FROM ranges WHERE partition_id % 4 = 2),
state AS (
  SELECT bucket, partition_id,
         max_by(CASE kind WHEN 'end' THEN 'Closed' WHEN 'rollback' THEN 'Stale' ELSE 'Open' END, arrival) AS state,
         max(CASE WHEN kind IN ('mutation','remove') THEN seqno END) AS last_seen_seqno,
         max(CASE WHEN kind = 'marker' THEN seqno END) AS last_snapshot_start_seqno,
         max(CASE WHEN kind = 'marker' THEN seqno + 9 END) AS last_snapshot_end_seqno,
         max(CASE WHEN kind = 'rollback' THEN seqno END) AS rollback_seqno,
         CASE WHEN count(CASE WHEN kind = 'end' THEN 1 END) > 0 THEN 'OK' END AS reason,
         count(CASE WHEN kind = 'marker' THEN 1 END) AS num_snapshots,
         count(CASE WHEN kind = 'mutation' THEN 1 END) AS num_mutations,
         count(CASE WHEN kind = 'remove' THEN 1 END) AS num_deletions
  FROM stream GROUP BY bucket, partition_id)
"""

ORDERS = """
ochg AS (
  SELECT 'orders' AS bucket,
         CAST(floor((o_custkey % 32) / 4) AS INT) AS pgroup,
         CAST(o_custkey % 32 AS SMALLINT) AS partition_id,
         CAST((o_custkey % 32) * 10 + 1 AS BIGINT) AS partition_uuid,
         o_orderkey AS seqno,
         concat('c', o_custkey) AS key,
         CASE WHEN o_orderstatus = 'F' THEN 'DELETE' ELSE 'UPDATE' END AS rec_type,
         o_orderpriority AS content,
         CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_custkey % 32 < 16 THEN 'l0' ELSE 'l1' END AS level,
         o_orderdate AS ts
  FROM orders),
orblog AS (
  SELECT bucket, partition_id, partition_uuid, min(seqno) AS cut
  FROM ochg WHERE partition_id IN (3, 19) AND ts >= TIMESTAMP '2000-06-01 00:00:00' AND pgroup < 4
  GROUP BY bucket, partition_id, partition_uuid),
of1 AS (
  SELECT bucket, pgroup, partition_id, partition_uuid, seqno, key, rec_type FROM (
    SELECT *, row_number() OVER (PARTITION BY bucket, pgroup, key ORDER BY seqno DESC) AS rn
    FROM ochg WHERE level = 'l1') t WHERE rn = 1),
of0 AS (
  SELECT bucket, pgroup, partition_id, partition_uuid, seqno, key, rec_type FROM (
    SELECT c.*, row_number() OVER (PARTITION BY c.bucket, c.pgroup, c.key ORDER BY c.seqno DESC) AS rn
    FROM ochg c LEFT JOIN orblog r ON c.bucket = r.bucket AND c.partition_id = r.partition_id AND c.partition_uuid = r.partition_uuid
    WHERE c.level = 'l0' AND (r.cut IS NULL OR c.seqno < r.cut)) t WHERE rn = 1),
ocompacted AS (
  SELECT a.* FROM of1 a
  LEFT JOIN orblog r ON a.bucket = r.bucket AND a.partition_id = r.partition_id AND a.partition_uuid = r.partition_uuid
  WHERE (r.cut IS NULL OR a.seqno < r.cut)
    AND NOT EXISTS (SELECT 1 FROM of0 b WHERE b.bucket = a.bucket AND b.pgroup = a.pgroup AND b.key = a.key)
  UNION ALL SELECT * FROM of0)
"""

FILTER = "bucket, pgroup, partition_id, partition_uuid, seqno, key, rec_type"
LIVE = FILTER + ", content"


def over_changes(select: str) -> str:
    return f"WITH {CHANGES} {select}"


def over_ranges(select: str) -> str:
    return f"WITH {CHANGES}, {RANGES} {select}"


def over_orders(select: str) -> str:
    return f"WITH {CHANGES}, {ORDERS} {select}"

"""Row schemas. Every read uses one of these; nothing is inferred."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

# Record types, in code order (a code is the position in this list).
RECORD_TYPES = ["INSERT", "UPDATE", "DELETE", "ROLLBACK"]

# Kinds of change-stream events.
DATA_KINDS = ["mutation", "remove"]
CONTROL_KINDS = [
    "opened",
    "rollback",
    "marker",
    "end",
    "requested",
    "retry_open",
    "retry_stale",
]
EVENT_KINDS = DATA_KINDS + CONTROL_KINDS

# Partition states, in code order.
PARTITION_STATES = ["Open", "Closed", "Stale"]

# Names of the per-partition counters.
COUNTERS = [
    "num_snapshots",
    "num_mutations",
    "num_deletions",
    "num_retries_reason_open",
    "num_retries_reason_stale",
]

GROUP = ["bucket", "pgroup"]
GROUP_KEY = ["bucket", "pgroup", "key"]
BRANCH = ["bucket", "partition_id", "partition_uuid"]
SEQNO_TUPLE = ["bucket", "partition_id", "partition_uuid", "seqno"]
PARTITION = ["bucket", "partition_id"]

FAILOVER_LOG_TYPE = ArrayType(
    StructType(
        [
            StructField("uuid", LongType()),
            StructField("seqno", LongType()),
        ]
    )
)

_short_fields = [
    StructField("bucket", StringType(), False),
    StructField("pgroup", IntegerType(), False),
    StructField("partition_id", ShortType(), False),
    StructField("partition_uuid", LongType(), False),
    StructField("seqno", LongType(), False),
    StructField("key", StringType(), False),
    StructField("rec_type", StringType()),
]

_payload_fields = [
    StructField("content", BinaryType()),
    StructField("expiration", IntegerType()),
    StructField("revision_seqno", LongType()),
    StructField("lock_time", IntegerType()),
    StructField("cas", LongType()),
    StructField("flags", IntegerType()),
]

FILTER = StructType(_short_fields)
MUTATIONS = StructType(_short_fields + _payload_fields)
ROLLBACK_LOG = StructType(
    [
        StructField("bucket", StringType(), False),
        StructField("pgroup", IntegerType(), False),
        StructField("partition_id", ShortType(), False),
        StructField("partition_uuid", LongType(), False),
        StructField("seqno", LongType(), False),
    ]
)
RANGES = StructType(
    [
        StructField("bucket", StringType(), False),
        StructField("partition_id", ShortType(), False),
        StructField("uuid", LongType(), False),
        StructField("start_seqno", LongType(), False),
        StructField("end_seqno", LongType(), False),
        StructField("snapshot_start_seqno", LongType(), False),
        StructField("snapshot_end_seqno", LongType(), False),
    ]
)

# One change-stream event. `arrival` orders the events of a partition: control
# events carry no sequence number of their own.
CHANGE_EVENTS = StructType(
    [
        StructField("bucket", StringType(), False),
        StructField("partition_id", ShortType(), False),
        StructField("arrival", LongType(), False),
        StructField("kind", StringType(), False),
        StructField("partition_uuid", LongType()),
        StructField("seqno", LongType()),
        StructField("key", StringType()),
        *_payload_fields,
        StructField("snapshot_start_seqno", LongType()),
        StructField("snapshot_end_seqno", LongType()),
        StructField("reason", StringType()),
        StructField("failover_log", FAILOVER_LOG_TYPE),
    ]
)

PARTITION_STATE = StructType(
    [
        StructField("bucket", StringType(), False),
        StructField("partition_id", ShortType(), False),
        StructField("state", StringType()),
        StructField("failover_log", FAILOVER_LOG_TYPE),
        StructField("last_seen_seqno", LongType()),
        StructField("last_snapshot_start_seqno", LongType()),
        StructField("last_snapshot_end_seqno", LongType()),
        StructField("reason", StringType()),
        StructField("rollback_seqno", LongType()),
        *[StructField(name, LongType()) for name in COUNTERS],
    ]
)

# A partition state as stored under a snapshot; `run_number` rises with each
# backup, so the mainline is the highest run of each partition.
CATALOG = StructType(
    [
        StructField("snapshot_id", StringType(), False),
        StructField("run_number", LongType(), False),
        *PARTITION_STATE.fields,
    ]
)

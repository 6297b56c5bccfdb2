"""Column expressions over records, partition groups and failover logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.schemas import PARTITION_STATES, RECORD_TYPES

# Sizes, in bits, that the record size estimate adds up.
SHORT_BITS, INT_BITS, LONG_BITS = 16, 32, 64
KEY_ALLOWANCE = 250

# Text formats.
GROUP_LABEL = "(%d-%d)"
RECORD_TEXT = "(partitionId=%d, seqNo=%d, key=%s, recType=%s)"
FAILOVER_ENTRY = "{uuid=%d, seqno=%d}"


def _code(column: str, names: list[str]) -> Column:
    cases = " ".join(f"WHEN '{name}' THEN {code}Y" for code, name in enumerate(names))
    return F.expr(f"CASE {column} {cases} END")


def _name(column: str, names: list[str]) -> Column:
    cases = " ".join(f"WHEN {code} THEN '{name}'" for code, name in enumerate(names))
    return F.expr(f"CASE {column} {cases} END")


def record_code(column: str = "rec_type") -> Column:
    """Record type as a one-byte code; fixed width keeps aggregates hash-based."""
    return _code(column, RECORD_TYPES)


def record_name(column: str) -> Column:
    return _name(column, RECORD_TYPES)


def state_name(column: str) -> Column:
    """Partition state of a code."""
    return _name(column, PARTITION_STATES)


def partition_group(partition_id: Column, num_partitions: Column, num_pgroups: Column) -> Column:
    """Group of a partition when `num_partitions` are cut into equal runs."""
    scaled = (partition_id.cast("long") + 1) * num_pgroups - 1
    return F.floor(scaled / num_partitions).cast("int")


def group_bounds(pgroup: Column, num_partitions: Column, num_pgroups: Column) -> tuple[Column, Column]:
    """First and last partition of a group."""
    low = F.floor(pgroup.cast("long") * num_partitions / num_pgroups)
    high = F.floor((pgroup.cast("long") + 1) * num_partitions / num_pgroups) - 1
    return low.cast("int"), high.cast("int")


def group_label(low: Column, high: Column) -> Column:
    return F.format_string(GROUP_LABEL, low, high)


def rollback_fields(line: Column) -> tuple[Column, Column, Column]:
    """Partition, uuid and seqno of one comma-separated line.

    Fields after the third are ignored. A field that is not a plain number,
    surrounding blanks included, aborts the query.
    """
    fields = F.split(line, ",")

    def number(position: int, kind: str) -> Column:
        text = F.get(fields, F.lit(position))
        return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.cast(kind)).otherwise(
            F.raise_error(F.concat(F.lit("bad rollback line: "), line)).cast(kind)
        )

    return number(0, "short"), number(1, "long"), number(2, "long")


def content_text(content: Column) -> Column:
    """Content as UTF-8 text; malformed bytes become replacement characters."""
    return F.make_valid_utf8(content.cast("string"))


def content_length(content: Column) -> Column:
    """Length in bytes, -1 when there is no content."""
    return F.coalesce(F.octet_length(content), F.lit(-1))


def record_size(content: Column) -> Column:
    """Size estimate of a full record: fixed parts plus the content length."""
    fixed = SHORT_BITS + LONG_BITS + KEY_ALLOWANCE + 4 * INT_BITS + 3 * LONG_BITS
    return F.lit(fixed) + content_length(content)


def record_text() -> Column:
    """One-line rendering of a short record."""
    return F.format_string(
        RECORD_TEXT,
        F.col("partition_id"),
        F.col("seqno"),
        F.col("key"),
        F.col("rec_type"),
    )


def same_record(left: Column, right: Column) -> Column:
    """Whole-record equality of two structs, nulls equal to nulls."""
    return left.eqNullSafe(right)


def failover_log_text(failover_log: Column) -> Column:
    """Failover log as text, current branch first."""
    return F.array_join(
        F.transform(
            failover_log,
            lambda entry: F.format_string(FAILOVER_ENTRY, entry["uuid"], entry["seqno"]),
        ),
        ", ",
    )


def current_uuid(failover_log: Column) -> Column:
    """Branch id of the first failover entry, null when there is none."""
    return F.get(failover_log, F.lit(0))["uuid"]

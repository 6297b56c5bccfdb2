"""Row constructors: change events to short (filter) and full (mutation) records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalars import content_text
from tidelog.schemas import MUTATIONS, PARTITION
from tidelog.session import Lookup

PUT_ONLY = ["content", "expiration", "lock_time", "flags"]
BOTH = ["revision_seqno", "cas"]


def checked_kind(allowed: Sequence[str]) -> Column:
    """`kind`, aborting the query on any value outside `allowed`."""
    kind = F.col("kind")
    return F.when(kind.isin(*allowed), kind).otherwise(
        F.raise_error(F.concat(F.lit("unexpected event kind: "), F.coalesce(kind, F.lit("null"))))
    )


def _record_type() -> Column:
    return F.when(checked_kind(["mutation", "remove"]) == "remove", F.lit("DELETE")).otherwise(
        F.lit("UPDATE")
    )


def _present(name: str) -> Column:
    """Column `name`, aborting on null: joins and sets rely on it being set."""
    value = F.col(name)
    return F.coalesce(value, F.raise_error(F.lit(f"{name} must not be null"))).alias(name)


def _short_columns(events: DataFrame) -> list[Column]:
    carried = ["bucket"] + (["pgroup"] if "pgroup" in events.columns else [])
    return [F.col(name) for name in carried] + [
        _present("partition_id"),
        _present("partition_uuid"),
        _present("seqno"),
        _present("key"),
        _record_type().alias("rec_type"),
    ]


def filter_rows(data_events: DataFrame) -> DataFrame:
    """Short records of mutation and removal events."""
    return data_events.select(*_short_columns(data_events))


def mutation_rows(data_events: DataFrame) -> DataFrame:
    """Full records. A removal keeps its revision and CAS, and has no content."""
    is_put = F.col("kind") == "mutation"
    return data_events.select(
        *_short_columns(data_events),
        *[F.when(is_put, F.col(name)).alias(name) for name in PUT_ONLY],
        *[F.col(name) for name in BOTH],
    ).select(*[f.name for f in MUTATIONS.fields if f.name != "pgroup" or "pgroup" in data_events.columns])


def lift_to_mutations(short_records: DataFrame) -> DataFrame:
    """Short records as full records with an empty payload."""
    missing = [
        F.lit(None).cast(field.dataType).alias(field.name)
        for field in MUTATIONS.fields
        if field.name not in short_records.columns
    ]
    return short_records.select("*", *missing)


def captured_text(data_events: DataFrame) -> DataFrame:
    """Type, seqno, key and text value of each captured event, per partition."""
    kind = checked_kind(["mutation", "remove"])
    return data_events.select(
        "bucket",
        "partition_id",
        kind.alias("type"),
        "seqno",
        "key",
        F.when(kind == "mutation", content_text(F.col("content"))).alias("value"),
    )


def stamp_uuid(rows: DataFrame, branches: DataFrame, keep: bool = False) -> DataFrame:
    """Set `partition_uuid` from the branch each partition was captured under.

    With `keep`, only where rows have none.
    """
    named = Lookup(branches.select(*PARTITION, F.col("uuid").alias("_uuid")))
    own = F.col("partition_uuid") if keep and "partition_uuid" in rows.columns else F.lit(None)
    rows = rows.withColumn("_own", own.cast("long")).drop("partition_uuid")
    stamped = named.join(rows, PARTITION, "left")
    return stamped.withColumn("partition_uuid", F.coalesce("_own", _present("_uuid"))).drop("_uuid", "_own")

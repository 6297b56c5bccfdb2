"""Incremental change-log storage for partitioned key-value data, on PySpark."""

from tidelog.plans.backup import run_backup
from tidelog.plans.compaction import compact, compact_filter, compact_levels
from tidelog.plans.store import Bucket, ChangeLogStore

__all__ = [
    "Bucket",
    "ChangeLogStore",
    "compact",
    "compact_filter",
    "compact_levels",
    "run_backup",
]

"""Filter compaction over two or more levels, and compaction of both logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalars import record_code, record_name
from tidelog.operators.filters import (
    FILTER_COLUMNS,
    active_groups,
    drop_rolled_back,
    latest_per_key,
    merge_newer,
    rollback_cuts,
)
from tidelog.operators.mutations import live_mutations
from tidelog.schemas import GROUP, GROUP_KEY, SEQNO_TUPLE
from tidelog.session import Lookup


def effective_cuts(rollback_log: DataFrame, groups: DataFrame) -> Lookup:
    """Cuts of the groups being compacted; a group without new rows is left alone."""
    return Lookup(rollback_cuts(rollback_log).join(groups, GROUP, "left_semi"))


def compact_filter(
    mainline: DataFrame,
    new: DataFrame,
    rollback_log: DataFrame | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Merge the filter rows of a run into the mainline filter.

    The cut comes before deduplication on purpose: when the latest row of a key
    is rolled back, the one before it takes its place. A new row displaces the
    mainline row of its key even at a lower seqno, as a new branch may restart
    lower. `groups` are the groups with new rows, when already known.
    """
    if rollback_log is not None:
        cuts = effective_cuts(rollback_log, groups if groups is not None else active_groups(new))
        mainline, new = drop_rolled_back(mainline, cuts), drop_rolled_back(new, cuts)
    return merge_newer(mainline, latest_per_key(new))


def compact_tiers(
    new: DataFrame,
    tier: DataFrame | None,
    mainline: DataFrame | None,
    rollback_log: DataFrame | None,
    pending: DataFrame | None,
    groups: DataFrame,
) -> DataFrame:
    """New rows merged over the tier, and over the mainline where it is given.

    The tier has already met the `pending` rollback entries of the runs in it, the
    mainline has not. Both are clustered by key, so only the new rows are shuffled.
    """
    cuts = None if rollback_log is None else effective_cuts(rollback_log, groups)
    merged = latest_per_key(new if cuts is None else drop_rolled_back(new, cuts))
    if tier is not None:
        merged = merge_newer(tier if cuts is None else drop_rolled_back(tier, cuts), merged)
    if mainline is not None:
        if pending is not None:
            every = pending if rollback_log is None else pending.unionByName(rollback_log)
            cuts = effective_cuts(every, groups)
        merged = merge_newer(mainline if cuts is None else drop_rolled_back(mainline, cuts), merged)
    return merged


def displaced(
    new: DataFrame,
    tier: DataFrame | None,
    mainline: DataFrame | None,
    rollback_log: DataFrame | None,
    pending: DataFrame | None,
    groups: DataFrame,
) -> DataFrame:
    """Rows that `compact_tiers` of the same levels leaves out for a newer row of their key.

    Rows that a rollback cut are not among them: they never were.
    """
    cuts = None if rollback_log is None else effective_cuts(rollback_log, groups)
    if cuts is not None:
        new = drop_rolled_back(new, cuts)
        tier = None if tier is None else drop_rolled_back(tier, cuts)
    newest = latest_per_key(new)
    found = new.join(newest.select(*SEQNO_TUPLE), SEQNO_TUPLE, "left_anti").select(*FILTER_COLUMNS)
    if tier is not None:
        found = found.unionByName(tier.join(newest.select(*GROUP_KEY), GROUP_KEY, "left_semi").select(*FILTER_COLUMNS))
        newest = merge_newer(tier, newest)
    if mainline is not None:
        if pending is not None:
            every = pending if rollback_log is None else pending.unionByName(rollback_log)
            cuts = effective_cuts(every, groups)
        mainline = mainline if cuts is None else drop_rolled_back(mainline, cuts)
        found = found.unionByName(mainline.join(newest.select(*GROUP_KEY), GROUP_KEY, "left_semi").select(*FILTER_COLUMNS))
    return found


def compact_levels(levels: Sequence[DataFrame], rollback_log: DataFrame | None = None) -> DataFrame:
    """Compact any number of levels, newest first; each level hides those below.

    The newest level is deduplicated; every older one already holds one row per
    key. One shuffle then merges all levels, instead of one join per level.
    """
    newest = levels[0]
    if rollback_log is not None:
        cuts = effective_cuts(rollback_log, active_groups(newest))
        levels = [drop_rolled_back(level, cuts) for level in levels]
    ranked = [
        level.select(*FILTER_COLUMNS, F.lit(depth).alias("_depth"))
        for depth, level in enumerate([latest_per_key(levels[0]), *levels[1:]])
    ]
    return merge_ranked(reduce(DataFrame.unionByName, ranked))


def merge_ranked(rows: DataFrame) -> DataFrame:
    """Of each key, the row of the lowest `_depth`."""
    fixed = [name for name in FILTER_COLUMNS if name not in (*GROUP_KEY, "rec_type")]
    return (
        rows.groupBy(*GROUP_KEY)
        .agg(
            *[F.min_by(name, "_depth").alias(name) for name in fixed],
            F.min_by(record_code(), "_depth").alias("_code"),
        )
        .withColumn("rec_type", record_name("_code"))
        .select(*FILTER_COLUMNS)
    )


def compact(
    mutations: DataFrame,
    mainline: DataFrame,
    new: DataFrame,
    rollback_log: DataFrame | None = None,
) -> DataFrame:
    """Live mutations under the compacted filter, without publishing either."""
    return live_mutations(mutations, compact_filter(mainline, new, rollback_log))

"""The store: captured runs, filter and mutation compaction, mapping, restore.

Layout below `home`, where each attempt at a run has a folder of its own:

    new_filter/run=…   raw filter rows of a capture run (L0), as they came
    filter/run=…       merged filter, clustered by (bucket, pgroup, key)
    history/run=…      filter rows that a merge has displaced, if they are kept
    mutations/run=…    mutations, clustered by (bucket, partition, uuid, seqno)
    rblog/run=…        rollback entries, as text
    manifest/…         which of these are valid, at which level, for which groups

Merged filters and mutations are bucketed tables. So merging a run does not shuffle
the mainline filter, and finding the live mutations shuffles only the slim filter,
never the mutations with their content. Below a run, files lie by bucket, so reads of
some buckets or groups leave the others' files alone.

A merged filter has one level, the mainline, or two: a tier of runs merged with each
other lies above it until it has grown to a share of the mainline.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.scalars import group_bounds, group_label, partition_group
from tidelog.operators.filters import drop_rolled_back, latest_per_key, merge_newer, rollback_cuts
from tidelog.operators.mutations import MutationMapper, as_of, live_mutations, map_rows, restore, to_restore
from tidelog.plans import manifest as entries_of
from tidelog.plans.compaction import compact_tiers, displaced, effective_cuts
from tidelog.plans.layout import Part, RunFiles, Scope
from tidelog.plans.manifest import (
    APPLIED,
    HISTORY,
    L0,
    L1,
    MET,
    NEW_FILTER,
    ROLLBACK,
    STAGED,
    TIER,
    AlreadyApplied,
    Manifest,
    Version,
)
from tidelog.schemas import CATALOG, FILTER, GROUP, GROUP_KEY, MUTATIONS, SEQNO_TUPLE
from tidelog.session import Lookup, fits_broadcast, no_rows, stored
from tidelog.sources import paths

# Fixed value: a group is compacted when it has more mutation files than this.
MUTATION_FILES_THRESHOLD = 10

MAX_BROADCAST_BUCKETS = 100_000
#: Level of entries that a merge uses up.
GONE = "gone"


@dataclass(frozen=True)
class View:
    """The part of a manifest version that some groups can see.

    `runs` holds the runs of each (kind, level); reads stay within `scope`.
    """

    entries: DataFrame
    runs: dict[tuple[str, str], list[Part]]
    scope: Scope | None = None

    def of(self, kind: str, level: str) -> DataFrame:
        return self.entries.where(f"kind = '{kind}' AND level = '{level}'")


@dataclass(frozen=True)
class Bucket:
    """A named collection, its number of partitions and of partition groups.

    With `pgroups`, only these groups are meant.
    """

    name: str
    num_partitions: int
    num_pgroups: int
    pgroups: tuple[int, ...] | None = None

    def __post_init__(self):
        if not self.name:
            raise ValueError("a bucket needs a name")

    def partitions(self) -> tuple[int, int]:
        """First and last partition of the chosen groups."""
        low, high = min(self.pgroups), max(self.pgroups) + 1
        size = self.num_partitions
        return low * size // self.num_pgroups, high * size // self.num_pgroups - 1


def scope_of(buckets: Sequence[Bucket] | None) -> Scope | None:
    """What files of these buckets can be held to when they are read."""
    if not buckets:
        return None
    names = tuple(sorted({bucket.name for bucket in buckets}))
    if any(bucket.pgroups is None or not bucket.pgroups for bucket in buckets):
        return Scope(names)
    bounds = [bucket.partitions() for bucket in buckets]
    groups = {group for bucket in buckets for group in bucket.pgroups}
    return Scope(names, tuple(sorted(groups)), (min(b[0] for b in bounds), max(b[1] for b in bounds)))


def bucket_table(spark: SparkSession, buckets: Sequence[Bucket]) -> DataFrame:
    """The bucket list as a local relation, which joins without a shuffle."""
    table = pa.table(
        {
            "bucket": pa.array([b.name for b in buckets], pa.string()),
            "num_partitions": pa.array([b.num_partitions for b in buckets], pa.int32()),
            "num_pgroups": pa.array([b.num_pgroups for b in buckets], pa.int32()),
            "pgroups": pa.array([b.pgroups for b in buckets], pa.list_(pa.int32())),
        }
    )
    return spark.createDataFrame(table)


def enumerate_groups(spark: SparkSession, buckets: Sequence[Bucket]) -> DataFrame:
    """All groups of all buckets, with their `(low-high)` label."""
    groups = bucket_table(spark, buckets).where("num_pgroups > 0").withColumn(
        "pgroup", F.explode(F.coalesce("pgroups", F.sequence(F.lit(0), F.col("num_pgroups") - 1)))
    ).where("pgroup >= 0 AND pgroup < num_pgroups")
    low, high = group_bounds(F.col("pgroup"), F.col("num_partitions"), F.col("num_pgroups"))
    return groups.select("bucket", "pgroup", group_label(low, high).alias("label"))


def with_group(rows: DataFrame, buckets: Sequence[Bucket]) -> DataFrame:
    """Add `pgroup`; an unknown bucket or a partition out of range aborts."""
    known_buckets = bucket_table(rows.sparkSession, buckets)
    if len(buckets) <= MAX_BROADCAST_BUCKETS:
        known_buckets = F.broadcast(known_buckets)
    sized = rows.join(known_buckets, "bucket", "left")
    known = "partition_id >= 0 AND partition_id < num_partitions"
    group = F.when(
        F.expr(known),
        partition_group(F.col("partition_id"), F.col("num_partitions"), F.col("num_pgroups")),
    ).otherwise(
        F.raise_error(
            F.concat_ws(" ", F.lit("no such partition:"), "bucket", F.col("partition_id"))
        ).cast("int")
    )
    return sized.withColumn("pgroup", group).drop("num_partitions", "num_pgroups", "pgroups")


def checked_name(name: str) -> str:
    """A run or snapshot name, which becomes part of paths."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
        raise ValueError(f"use letters, digits, '_', '.' and '-' only: {name!r}")
    return name


def group_outcomes(filters: DataFrame, mutations: DataFrame) -> DataFrame:
    """(bucket, pgroup, outcome): `complete`, or that a group has only one of its sides."""
    sides = [
        rows.select(*GROUP).distinct().withColumn(name, F.lit(True))
        for rows, name in ((filters, "_filter"), (mutations, "_mutations"))
    ]
    lacks = F.format_string("group %s/%d lacks filter or mutations", "bucket", "pgroup")
    outcome = F.when(F.expr("_filter AND _mutations"), "complete").otherwise(lacks)
    return sides[0].join(sides[1], GROUP, "full_outer").select(*GROUP, outcome.alias("outcome"))


class ChangeLogStore:
    """Runs, compactions and reads of one `home` folder on shared storage.

    `num_buckets` is fixed for the life of a store: at least the shuffle
    partitions of a cluster, so that one bucket of mutations fits a task and a
    merge is joined by bucket. New runs are written in `file_format`; runs in other
    formats stay readable. With `keep_history`, rows that a merge displaces stay on
    file, so that the state as of an earlier position can be restored.
    """

    def __init__(
        self,
        spark: SparkSession,
        home: str,
        num_buckets: int | None = None,
        file_format: str = "parquet",
        keep_history: bool = False,
    ):
        self.spark = spark
        self.home = home.rstrip("/")
        self.num_buckets = self._layout(num_buckets)
        self.keep_history = keep_history
        self.manifest = Manifest(spark, self.home)
        self.files = RunFiles(spark, self.home, self.num_buckets, file_format)

    def _layout(self, num_buckets: int | None) -> int:
        """The number of buckets the store was created with, or is created with now."""
        path = f"{self.home}/layout"
        if paths.exists(self.spark, f"{path}/_SUCCESS"):
            return self.spark.read.schema("num_buckets int").parquet(path).first()["num_buckets"]
        number = num_buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        row = self.spark.range(1).select(F.lit(number).alias("num_buckets"))
        row.write.mode("overwrite").parquet(path)
        return number

    # --- views ------------------------------------------------------------------

    def _view(
        self, version: Version, groups: DataFrame | None, buckets: Sequence[Bucket] | None = None
    ) -> View:
        """The entries of some groups (all, if None), and the runs they name."""
        entries = version.entries
        if groups is not None:
            entries = entries.join(groups, GROUP, "left_semi")
        runs: dict[tuple[str, str], list[Part]] = {}
        named = entries.groupBy("kind", "level", "run", "folder", "file_format").agg(
            (F.count(F.lit(1)) == F.max("run_groups")).alias("whole"),
            F.max("num_files").alias("num_files"),
            F.array_sort(F.collect_set("bucket")).alias("buckets"),
        )
        for row in named.collect():
            part = Part(
                row["run"], row["folder"], row["whole"], row["file_format"], row["num_files"], tuple(row["buckets"])
            )
            runs.setdefault((row["kind"], row["level"]), []).append(part)
        return View(entries, runs, scope_of(buckets))

    def _view_of(self, version: Version, buckets: Sequence[Bucket] | None) -> View:
        return self._view(version, self._groups(buckets), buckets)

    def _read(self, view: View, kind: str, *levels: str) -> DataFrame:
        """Rows of a kind at these levels, within the groups of the view."""
        parts = [part for level in levels for part in view.runs.get((kind, level), [])]
        rows = self.files.read(kind, parts, view.scope)
        if not all(part.whole for part in parts):
            among = ", ".join(f"'{level}'" for level in levels)
            side = view.entries.where(f"kind = '{kind}' AND level IN ({among})")
            side = side.select(F.col("folder").alias("run"), *GROUP).distinct()
            side = F.broadcast(side) if fits_broadcast(side) else side
            rows = rows.join(side, ["run", *GROUP], "left_semi")
        return rows.drop("run")

    def _has(self, view: View, kind: str, *levels: str) -> bool:
        return any((kind, level) in view.runs for level in levels)

    def _if_any(self, view: View, kind: str, *levels: str) -> DataFrame | None:
        return self._read(view, kind, *levels) if self._has(view, kind, *levels) else None

    def _filter(self, view: View) -> DataFrame:
        """The merged filter: the tier over the mainline, which shuffles neither."""
        mainline = self._read(view, entries_of.FILTER, L1)
        tier = self._if_any(view, entries_of.FILTER, TIER)
        if tier is None:
            return mainline
        pending = self._if_any(view, ROLLBACK, TIER)
        if pending is not None:
            groups = view.of(entries_of.FILTER, TIER).select(*GROUP).distinct()
            mainline = drop_rolled_back(mainline, effective_cuts(pending, groups))
        return merge_newer(mainline, tier)

    def _groups(self, buckets: Sequence[Bucket] | None) -> DataFrame | None:
        return None if buckets is None else enumerate_groups(self.spark, buckets).select(*GROUP)

    def _entries(
        self,
        groups: DataFrame,
        kinds: Sequence[str],
        level: str,
        run: str,
        folder: str | None = None,
        num_files: int | None = None,
    ) -> DataFrame:
        """Manifest entries that make `run` valid for `groups`, for each kind."""
        every_kind = ", ".join(f"'{kind}'" for kind in kinds)
        return groups.selectExpr(
            f"explode(array({every_kind})) AS kind",
            f"'{level}' AS level",
            f"'{run}' AS run",
            *GROUP,
            f"'{folder or run}' AS folder",
            f"'{self.files.file_format}' AS file_format",
            f"{groups.count()}L AS run_groups",
            "num_rows" if "num_rows" in groups.columns else "CAST(NULL AS BIGINT) AS num_rows",
            f"CAST({'NULL' if num_files is None else num_files} AS BIGINT) AS num_files",
            "CAST(NULL AS array<string>) AS replaces",
        ).select(*entries_of.ENTRY)

    def _written(
        self, kinds: Sequence[str], level: str, run: str, folder: str, groups: DataFrame | None = None
    ) -> DataFrame:
        """Entries of a folder just written, for the groups it holds or for these."""
        kind = kinds[0]
        num_files = self.files.num_files(kind, folder)
        part = Part(run, folder, True, self.files.file_format, None, ())
        rows = (
            self.files.read(kind, [part])
            if kind == ROLLBACK
            else self.spark.read.schema("bucket string, pgroup int")
            .format(self.files.file_format)
            .load(self.files.path(kind, folder))
        )
        counted = rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("num_rows"))
        if groups is not None:
            counted = groups.join(counted, GROUP, "left").withColumn("num_rows", F.coalesce("num_rows", F.lit(0)))
        counted = stored(counted)
        found = [self._entries(counted, [kind], level, run, folder, num_files)]
        for other in kinds[1:]:
            found.append(self._entries(counted, [other], level, run, folder, self.files.num_files(other, folder)))
        return reduce(DataFrame.unionByName, found)

    # --- capture ----------------------------------------------------------------

    def is_applied(self, run: str) -> bool:
        return self.manifest.latest().has_applied(run)

    def catalog(self) -> DataFrame:
        """Partition states of all recorded runs."""
        view = self._view(self.manifest.latest(), None)
        parts = view.runs.get((entries_of.CATALOG, L0))
        if not parts:
            return no_rows(self.spark, CATALOG)
        self.files.check(entries_of.CATALOG, parts)
        folders = [self.files.path(entries_of.CATALOG, part.folder) for part in parts]
        return self.spark.read.schema(CATALOG).parquet(*folders)

    def append_run(
        self,
        run: str,
        mutations: DataFrame | None = None,
        rollback_log: DataFrame | None = None,
        catalog: DataFrame | None = None,
        follows: str | None = None,
    ) -> bool:
        """Add the mutations of a capture run, and its rollback entries, at L0.

        The slim filter is written beside the mutations. All parts, with the
        partition states in `catalog` if there are any, become valid in one manifest
        version. A run that was already applied is left alone, so a replay after a
        failure changes nothing. Every attempt writes to a folder of its own and
        only one can be published, whichever comes first. `follows` names a run
        that will not be repeated any more, so its record can go.
        """
        checked_name(run)
        if self.is_applied(run):
            return False
        folder = self.files.new_folder(run)
        no_group = self.spark.range(1).selectExpr("'' AS bucket", "0 AS pgroup")
        added = [self._entries(no_group, [APPLIED], L0, run)]
        kinds = []
        if catalog is not None:
            kinds.append(entries_of.CATALOG)
            self.files.write(entries_of.CATALOG, folder, catalog)
            number = self.files.num_files(entries_of.CATALOG, folder)
            added.append(self._entries(no_group, [entries_of.CATALOG], L0, run, folder, number))
        if mutations is not None:
            kinds += [entries_of.MUTATIONS, NEW_FILTER]
            spread = mutations.select(*MUTATIONS.names, F.lit(run).alias("captured_run"))
            spread = spread.repartition(self.num_buckets, *SEQNO_TUPLE)
            self.files.write_clustered(entries_of.MUTATIONS, folder, spread)
            captured = self.spark.read.schema(FILTER).format(self.files.file_format)
            self.files.write(NEW_FILTER, folder, captured.load(self.files.path(entries_of.MUTATIONS, folder)))
            added.append(self._written([NEW_FILTER, entries_of.MUTATIONS], L0, run, folder))
        if rollback_log is not None:
            kinds.append(ROLLBACK)
            self.files.write(ROLLBACK, folder, rollback_log)
            added.append(self._written([ROLLBACK], L0, run, folder))
        removed = None
        if follows is not None:
            removed = self.manifest.latest().of(APPLIED, L0).where(F.col("run") == follows)
        try:
            self.manifest.change(removed, reduce(DataFrame.unionByName, added), run)
        except AlreadyApplied:
            for kind in kinds:
                self.files.delete(kind, folder)
            return False
        return True

    # --- compaction -------------------------------------------------------------

    def groups_needing_filter_compaction(self, buckets: Sequence[Bucket] | None = None) -> DataFrame:
        """Groups with new filter rows; known from the manifest, without a scan."""
        return self._within(self.manifest.latest().of(NEW_FILTER, L0), buckets).distinct()

    def groups_over_threshold(
        self,
        buckets: Sequence[Bucket] | None = None,
        threshold: int = MUTATION_FILES_THRESHOLD,
    ) -> DataFrame:
        """Groups with strictly more mainline mutation runs than `threshold`."""
        return self._over(self.manifest.latest(), buckets, threshold)

    def _over(
        self, version: Version, buckets: Sequence[Bucket] | None, threshold: int
    ) -> DataFrame:
        return (
            self._within(version.of(entries_of.MUTATIONS, L1), buckets, "run")
            .groupBy(*GROUP)
            .agg(F.countDistinct("run").alias("num_files"))
            .where(F.col("num_files") > threshold)
        )

    def _within(
        self, entries: DataFrame, buckets: Sequence[Bucket] | None, *columns: str
    ) -> DataFrame:
        """Groups of manifest entries, with more columns if named, in these buckets."""
        groups = self._groups(buckets)
        if groups is not None:
            entries = entries.join(groups, GROUP, "left_semi")
        return entries.select(*GROUP, *columns)

    def compact_filters(
        self,
        buckets: Sequence[Bucket] | None = None,
        tier_share: float | None = None,
        snapshot: str | None = None,
    ) -> str | None:
        """Merge the new filter rows into the mainline filter, and publish.

        One job covers all groups. Groups without new rows keep their filter and
        their rollback entries. New mutations of the compacted groups become
        part of the mainline without being copied.

        With `tier_share`, only groups whose new rows and tier together have at least
        that share of the rows of their mainline are merged into it, all three levels
        at once; in the others the new rows are merged into the tier, so a large
        mainline is not written again for each run. With `snapshot`, the runs that it
        names are merged, as far as no other merge has used them since; runs that
        came later stay new.
        """
        base = self._version(snapshot)
        active = self._within(base.of(NEW_FILTER, L0), buckets).distinct()
        if snapshot is not None:
            active = active.join(self._moved_on(base), GROUP, "left_anti")
        active = stored(active)
        if active.isEmpty():
            return None
        promoted, waiting = active, None
        if tier_share is not None:
            promoted = stored(self._grown(base, active, tier_share))
            waiting = stored(active.join(promoted, GROUP, "left_anti"))
        used, added, run = [], [], None
        for groups, level in ((promoted, L1), (waiting, TIER)):
            if groups is not None and not groups.isEmpty():
                run = f"{'f' if level == L1 else 't'}{base.number + 1}-{uuid.uuid4().hex[:8]}"
                gone, come = self._merge(self._view(base, groups, buckets), groups, level, run)
                used.append(gone)
                added.append(come)
        self.manifest.change(reduce(DataFrame.unionByName, used), reduce(DataFrame.unionByName, added))
        return run

    def _merge(self, view: View, groups: DataFrame, level: str, run: str) -> tuple[DataFrame, DataFrame]:
        """Write the merged filter of some groups; the entries used up, and those to add."""
        onto_mainline = level == L1
        levels = [
            self._read(view, NEW_FILTER, L0),
            self._if_any(view, entries_of.FILTER, TIER),
            self._if_any(view, entries_of.FILTER, L1) if onto_mainline else None,
            self._if_any(view, ROLLBACK, L0),
            self._if_any(view, ROLLBACK, TIER) if onto_mainline else None,
        ]
        merged = compact_tiers(*levels, groups)
        enough = self.num_buckets >= int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if not enough or (levels[1] is None and levels[2] is None):
            # not joined to a bucketed side: one task for each bucket
            merged = merged.repartition(self.num_buckets, *GROUP_KEY)
        self.files.write_clustered(entries_of.FILTER, run, merged)
        added = [self._written([entries_of.FILTER], level, run, run, groups)]
        if self.keep_history:
            self.files.write(HISTORY, run, displaced(*levels, groups))
            added.append(self._written([HISTORY], L0, run, run))
        used = {
            NEW_FILTER: {L0: None},
            entries_of.FILTER: {TIER: None},
            # mutations become part of the mainline as they are
            entries_of.MUTATIONS: {L0: L1},
            # below a tier, the mainline still has to meet the cuts
            ROLLBACK: {L0: TIER},
        }
        if onto_mainline:
            used[entries_of.FILTER] |= {L1: None}
            # what history holds has to meet the cuts of later merges
            used[ROLLBACK] = dict.fromkeys([L0, TIER], MET if self.keep_history else None)
        to = " ".join(
            f"WHEN kind = '{kind}' AND level = '{at}' THEN '{then or GONE}'"
            for kind, moves in used.items()
            for at, then in moves.items()
        )
        moved = view.entries.withColumn("_to", F.expr(f"CASE {to} END")).where("_to IS NOT NULL")
        kept = moved.where(F.col("_to") != GONE).withColumn("level", F.col("_to"))
        added.append(kept.select(*entries_of.ENTRY))
        return moved.select(*entries_of.ENTRY), reduce(DataFrame.unionByName, added)

    def _grown(self, version: Version, groups: DataFrame, share: float) -> DataFrame:
        """Groups whose new rows and tier have this share of their mainline's rows."""
        sizes = {
            "recent": f"(kind = '{NEW_FILTER}' AND level = '{L0}') OR (kind = '{entries_of.FILTER}' AND level = '{TIER}')",
            "old": f"kind = '{entries_of.FILTER}' AND level = '{L1}'",
        }
        sums = [F.expr(f"coalesce(sum(num_rows) FILTER (WHERE {where}), 0) AS {name}") for name, where in sizes.items()]
        counted = version.entries.join(groups, GROUP, "left_semi").groupBy(*GROUP).agg(*sums)
        return counted.where(F.col("recent") >= F.col("old") * share).select(*GROUP)

    def _moved_on(self, base: Version) -> DataFrame:
        """Groups in which other merges have used runs of this version since."""
        needed = base.entries.where(
            f"(kind IN ('{NEW_FILTER}', '{ROLLBACK}', '{entries_of.MUTATIONS}') AND level = '{L0}')"
            f" OR (kind IN ('{entries_of.FILTER}', '{ROLLBACK}') AND level IN ('{TIER}', '{L1}'))"
        )
        gone = needed.join(self.manifest.latest().entries, entries_of.IDENTITY, "left_anti")
        return gone.select(*GROUP).distinct()

    def compact_mutations(
        self,
        buckets: Sequence[Bucket] | None = None,
        threshold: int = MUTATION_FILES_THRESHOLD,
        snapshot: str | None = None,
    ) -> str | None:
        """Write the live mutations of the groups over the threshold, unpublished.

        The result stays invisible until `publish_compacted_mutations`; runs
        appended in between are not lost, as only the runs read here get replaced.
        With `snapshot`, the runs and the filter it names are read, while the store
        goes on: a row that was not live then can't come back to life.
        """
        return self._compact_mutations(self._version(snapshot), buckets, threshold)

    def _compact_mutations(
        self, base: Version, buckets: Sequence[Bucket] | None, threshold: int
    ) -> str | None:
        over = stored(self._over(base, buckets, threshold).select(*GROUP))
        if over.isEmpty():
            return None
        view = self._view(base, over, buckets)
        run = f"m{base.number + 1}-{uuid.uuid4().hex[:8]}"
        # Free where the join kept the bucketing; after a broadcast join it
        # brings the rows of a bucket together, for one file per bucket.
        live = self._live(view, history=True).repartition(self.num_buckets, *SEQNO_TUPLE)
        self.files.write_clustered(entries_of.MUTATIONS, run, live)
        sources = view.of(entries_of.MUTATIONS, L1).groupBy(*GROUP)
        replaced = sources.agg(F.array_sort(F.collect_set("run")).alias("replaces"))
        staged = (
            self._written([entries_of.MUTATIONS], STAGED, run, run, over)
            .drop("replaces")
            .join(replaced, GROUP)
            .select(*entries_of.ENTRY)
        )
        outdated = self.manifest.latest().of(entries_of.MUTATIONS, STAGED).join(over, GROUP, "left_semi")
        self.manifest.change(outdated, staged)
        return run

    def publish_compacted_mutations(self, buckets: Sequence[Bucket] | None = None) -> bool:
        """Let staged mutations take the place of the runs they were made from.

        A staged group whose source runs are no longer all valid is dropped.
        """
        base = self.manifest.latest()
        view = self._view_of(base, buckets)
        if (entries_of.MUTATIONS, STAGED) not in view.runs:
            return False
        staged, mainline = view.of(entries_of.MUTATIONS, STAGED), view.of(entries_of.MUTATIONS, L1)
        current = mainline.groupBy(*GROUP).agg(F.collect_set("run").alias("_current"))
        valid = (
            staged.join(current, GROUP)
            .where("size(array_except(replaces, _current)) = 0")
            .select(*entries_of.ENTRY)
        )
        replaced = valid.select(*GROUP, F.explode("replaces").alias("run"))
        used = mainline.join(replaced, [*GROUP, "run"], "left_semi")
        self.manifest.change(
            staged.select(*entries_of.ENTRY).unionByName(used.select(*entries_of.ENTRY)),
            valid.withColumn("level", F.lit(L1)).withColumn(
                "replaces", F.lit(None).cast("array<string>")
            ),
        )
        return True

    def compact(
        self,
        buckets: Sequence[Bucket] | None = None,
        threshold: int = MUTATION_FILES_THRESHOLD,
        snapshot: str | None = None,
    ) -> None:
        """Compact the filters, then the mutations, and publish both.

        With `snapshot`, both work on the runs that it names, and runs that came
        later stay as they are: their filter rows stay new, and their mutations are
        neither read nor replaced.
        """
        self.compact_filters(buckets, snapshot=snapshot)
        base = self.manifest.latest()
        if snapshot is not None:
            named = self._version(snapshot).entries.where(f"kind = '{entries_of.MUTATIONS}'").select("run", *GROUP)
            others = base.entries.where(f"kind <> '{entries_of.MUTATIONS}'")
            known = base.entries.where(f"kind = '{entries_of.MUTATIONS}'").join(named, ["run", *GROUP], "left_semi")
            base = Version(base.number, others.unionByName(known.select(*others.columns)))
        if self._compact_mutations(base, buckets, threshold):
            self.publish_compacted_mutations(buckets)

    # --- reads ------------------------------------------------------------------

    def _version(self, snapshot: str | None) -> Version:
        if snapshot is None:
            return self.manifest.latest()
        path = f"{self.home}/snapshots/name={snapshot}"
        number = self.spark.read.schema("version bigint").parquet(path).first()["version"]
        return self.manifest.at(number)

    def create_snapshot(self, name: str) -> None:
        """Name the current state; its files are kept until the name is dropped."""
        checked_name(name)
        version = self.spark.range(1).select(
            F.lit(self.manifest.latest().number).cast("long").alias("version")
        )
        version.write.mode("errorifexists").parquet(f"{self.home}/snapshots/name={name}")

    def filter_rows(
        self, buckets: Sequence[Bucket] | None = None, snapshot: str | None = None
    ) -> DataFrame:
        """The merged filter."""
        return self._filter(self._view_of(self._version(snapshot), buckets)).select(*FILTER.names)

    def mutation_rows(
        self, buckets: Sequence[Bucket] | None = None, snapshot: str | None = None
    ) -> DataFrame:
        """Mainline mutations, live or not."""
        view = self._view_of(self._version(snapshot), buckets)
        return self._read(view, entries_of.MUTATIONS, L1).select(*MUTATIONS.names)

    def _live(self, view: View, history: bool = False) -> DataFrame:
        """Live rows; one that several runs captured counts once.

        Mutations are clustered by these columns, so this takes no shuffle. Only live
        rows are compared with each other, as the others' content need not be sorted and
        aggregated. With `history`, rows that the kept history names count as live, too.
        """
        self._check_complete(view)
        mutations, filters = self._read(view, entries_of.MUTATIONS, L1), self._filter(view)
        if history and self._has(view, HISTORY, L0):
            filters = filters.select(*SEQNO_TUPLE).unionByName(self._read(view, HISTORY, L0).select(*SEQNO_TUPLE))
        return self._once(view, mutations, live_mutations(mutations, filters))

    def _once(self, view: View, mutations: DataFrame, rows: DataFrame) -> DataFrame:
        """Some of the view's mutations, each row once where several runs captured it.

        Whether any was captured twice is seen from the slim columns, without a shuffle.
        If none was, no content needs to be sorted and aggregated.
        """
        if len(view.runs.get((entries_of.MUTATIONS, L1), [])) < 2:
            return rows
        repeated = mutations.groupBy(*SEQNO_TUPLE).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        return rows.dropDuplicates(SEQNO_TUPLE) if (repeated or 0) > 1 else rows

    def _check_complete(self, view: View) -> None:
        """A group must have both its filter and its mutations, or neither."""
        filters = view.of(entries_of.FILTER, L1).unionByName(view.of(entries_of.FILTER, TIER))
        outcomes = group_outcomes(filters, view.of(entries_of.MUTATIONS, L1))
        incomplete = outcomes.where("outcome <> 'complete'").first()
        if incomplete is not None:
            raise RuntimeError(incomplete["outcome"])

    def changes(
        self, run: str, buckets: Sequence[Bucket] | None = None, partition_id: int | None = None
    ) -> DataFrame:
        """What one run captured and is still on file, of all partitions or of one.

        Every row names its run, also after compactions, which leave its live rows.
        A run that nobody captured has none.
        """
        checked_name(run)
        view = self._view_of(self.manifest.latest(), buckets)
        rows = self._read(view, entries_of.MUTATIONS, L0, L1).where(F.col("captured_run") == run)
        if partition_id is not None:
            rows = rows.where(F.col("partition_id") == partition_id)
        return rows.select(*MUTATIONS.names)

    def live_mutations(
        self, buckets: Sequence[Bucket] | None = None, snapshot: str | None = None
    ) -> DataFrame:
        return self._live(self._view_of(self._version(snapshot), buckets)).select(*MUTATIONS.names)

    def filter_as_of(self, positions: DataFrame, buckets: Sequence[Bucket] | None = None) -> DataFrame:
        """The filter as it was when each partition stood at its position.

        `positions` are (bucket, partition_id, seqno). Reaches back as far as history
        was kept; a partition that is not listed has no rows yet.
        """
        view = self._view_of(self.manifest.latest(), buckets)
        current = self._filter(view).select(*FILTER.names)
        if self._has(view, HISTORY, L0):
            before = self._read(view, HISTORY, L0).select(*FILTER.names)
            if self._has(view, ROLLBACK, MET, TIER):
                # displaced by a merge, and cut by a later one
                before = drop_rolled_back(before, Lookup(rollback_cuts(self._read(view, ROLLBACK, MET, TIER))))
            current = current.unionByName(before)
        return latest_per_key(as_of(current, positions))

    def restore_as_of(
        self, positions: DataFrame, buckets: Sequence[Bucket] | None = None, include_deletes: bool = True
    ) -> DataFrame:
        """Rows to write back for the state at these positions."""
        view = self._view_of(self.manifest.latest(), buckets)
        self._check_complete(view)
        mutations = self._read(view, entries_of.MUTATIONS, L1)
        rows = restore(mutations, self.filter_as_of(positions, buckets), None, include_deletes)
        return self._once(view, mutations, rows).select(*MUTATIONS.names)

    def forget_history(self, keep: int = 0) -> int:
        """Give up displaced rows of all but the last `keep` merges of each group.

        They go from the files with the next mutation compaction and `vacuum`.
        """
        kept = self.manifest.latest().of(HISTORY, L0)
        age = F.regexp_extract("run", "^[a-z]([0-9]+)-", 1).cast("long")
        later = kept.select(*GROUP, age.alias("_later")).distinct()
        old = (
            kept.withColumn("_age", age)
            .join(later, GROUP)
            .groupBy(*entries_of.IDENTITY)
            .agg(F.count_if(F.col("_later") > F.col("_age")).alias("newer"))
            .where(F.col("newer") >= keep)
        )
        old = stored(kept.join(old, entries_of.IDENTITY, "left_semi").select(*entries_of.ENTRY))
        number = old.count()
        if number:
            self.manifest.change(old, old.where("false"))
        return number

    def map_mutations(
        self,
        mapper: MutationMapper | Callable[[DataFrame], DataFrame],
        schema=None,
        buckets: Sequence[Bucket] | None = None,
        snapshot: str | None = None,
    ) -> DataFrame:
        """Live mutations of every group through `mapper`, lazily."""
        live = self.live_mutations(buckets, snapshot)
        if isinstance(mapper, MutationMapper):
            return map_rows(live, mapper, schema)
        return live.transform(mapper)

    def restore(
        self,
        buckets: Sequence[Bucket] | None = None,
        snapshot: str | None = None,
        since: DataFrame | None = None,
        include_deletes: bool = True,
    ) -> DataFrame:
        """Rows to write back: all live ones, or those above a seqno per partition."""
        live = self.live_mutations(buckets, snapshot)
        return to_restore(live, since, include_deletes)

    # --- cleaning ---------------------------------------------------------------

    def vacuum(self) -> int:
        """Delete run folders that neither the mainline nor a snapshot refers to.

        Manifest versions that nothing refers to any more go as well.

        Run it while no other operation writes to the store.
        """
        versions = [self.manifest.latest()]
        for name in paths.child_names(self.spark, f"{self.home}/snapshots"):
            if name.startswith("name="):
                versions.append(self._version(name.removeprefix("name=")))
        self.manifest.keep_only({version.number for version in versions})
        used = set()
        for version in versions:
            used |= {
                (row["kind"], row["folder"])
                for row in version.entries.select("kind", "folder").distinct().collect()
            }
        deleted = 0
        for kind in (NEW_FILTER, entries_of.FILTER, entries_of.MUTATIONS, ROLLBACK, entries_of.CATALOG, HISTORY):
            for name in paths.child_names(self.spark, f"{self.home}/{kind}"):
                if name.startswith("run=") and (kind, name.removeprefix("run=")) not in used:
                    paths.delete(self.spark, f"{self.home}/{kind}/{name}")
                    deleted += 1
        return deleted

"""Which runs of files hold which groups: the store's small table of contents.

Data is only ever written to new folders, one for each attempt at a run. A manifest
version names, for each (kind, level, run), its folder and the groups it is valid for. Its entries are written to a folder
of their own; publishing is the creation of one small file that names this folder,
which fails if another writer created the same version first. Readers take the last
such file, so they see the old or the new version and are never in a writer's way.
"""

from __future__ import annotations

import random
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog.schemas import GROUP
from tidelog.session import no_rows
from tidelog.sources import paths

ENTRY_SCHEMA = (
    "kind string, level string, run string, bucket string, pgroup int, folder string,"
    " file_format string, run_groups bigint, num_rows bigint, num_files bigint, replaces array<string>"
)
IDENTITY = ["kind", "level", "run", *GROUP]
ENTRY = [
    "kind", "level", "run", *GROUP,
    "folder", "file_format", "run_groups", "num_rows", "num_files", "replaces",
]

# Kinds of files and their levels. `applied` remembers finished runs.
NEW_FILTER, FILTER, MUTATIONS, ROLLBACK, APPLIED, CATALOG, HISTORY = (
    "new_filter",
    "filter",
    "mutations",
    "rblog",
    "applied",
    "catalog",
    "history",
)
# longest pause after a lost race
PAUSE_SECONDS = 5.0
# `tier` holds runs that are merged with each other, but not yet into the mainline (l1).
# Rollback entries that all levels have met are kept as `met` where history is kept.
L0, TIER, L1, STAGED, MET = "l0", "tier", "l1", "staged", "met"


class ConcurrentPublish(RuntimeError):
    """Another writer published first; plan the operation again."""


class AlreadyApplied(RuntimeError):
    """Another attempt at this run was published before."""


@dataclass(frozen=True)
class Version:
    number: int
    entries: DataFrame

    def of(self, kind: str, level: str) -> DataFrame:
        return self.entries.where(f"kind = '{kind}' AND level = '{level}'")

    def has_applied(self, run: str) -> bool:
        return not self.of(APPLIED, L0).where(F.col("run") == run).isEmpty()


class Manifest:
    def __init__(self, spark: SparkSession, home: str):
        self.spark = spark
        self.folder = f"{home}/manifest"

    def _path(self, number: int) -> str:
        return f"{self.folder}/version={number:010d}"

    def _numbers(self) -> list[int]:
        names = paths.child_names(self.spark, self.folder)
        return [int(n.split("=")[1]) for n in names if n.startswith("version=") and not n.endswith(".tmp")]

    def latest(self) -> Version:
        numbers = self._numbers()
        if not numbers:
            return Version(0, no_rows(self.spark, StructType.fromDDL(ENTRY_SCHEMA)))
        return self.at(numbers[-1])

    def at(self, number: int) -> Version:
        folder = paths.read_text(self.spark, self._path(number))
        return Version(number, self.spark.read.schema(ENTRY_SCHEMA).parquet(f"{self.folder}/{folder}"))

    def keep_only(self, numbers: set[int]) -> None:
        """Delete versions other than these, and entries no version names; the latest always stays.

        No other writer may be at work.
        """
        for number in self._numbers()[:-1]:
            if number not in numbers:
                paths.delete(self.spark, self._path(number))
        named = {paths.read_text(self.spark, self._path(number)) for number in self._numbers()}
        for name in paths.child_names(self.spark, self.folder):
            if name.endswith(".tmp") or (name.startswith("entries=") and name not in named):
                paths.delete(self.spark, f"{self.folder}/{name}")

    def change(self, removed: DataFrame | None, added: DataFrame, run: str | None = None) -> int:
        """Publish the latest version without `removed` and with `added` entries.

        With `run`, a run that some version before has already applied is refused.

        When another writer gets in between, the change is put on top of what it
        wrote. That is safe as long as the entries to remove are still there; if
        not, the other writer has used up the same runs, and this one must fail.
        Each lost race is another writer's success, so there is no limit to them.
        """
        pause = 0.05
        while True:
            base = self.latest()
            entries = base.entries
            if run is not None and base.has_applied(run):
                raise AlreadyApplied(run)
            if removed is not None:
                gone = removed.select(*IDENTITY).join(entries, IDENTITY, "left_anti")
                if not gone.isEmpty():
                    raise ConcurrentPublish("another writer used the same runs")
                entries = entries.join(removed.select(*IDENTITY), IDENTITY, "left_anti")
            try:
                return self.publish(base, entries.select(*ENTRY).unionByName(added.select(*ENTRY)))
            except ConcurrentPublish:
                time.sleep(random.uniform(0, pause))
                pause = min(2 * pause, PAUSE_SECONDS)

    def publish(self, base: Version, entries: DataFrame) -> int:
        """Make `entries` the version after `base`, which must still be the latest."""
        number, folder = base.number + 1, f"entries={uuid.uuid4().hex}"
        entries.select(*ENTRY).write.parquet(f"{self.folder}/{folder}")
        if not paths.create_text(self.spark, self._path(number), folder):
            paths.delete(self.spark, f"{self.folder}/{folder}")
            raise ConcurrentPublish(f"version {number} exists")
        return number

"""Files of runs: a folder for each attempt, by bucket, pruned when they are read.

    <kind>/run=<folder>/in_bucket=<bucket>/…

`in_bucket` repeats the column `bucket` as a folder, so a read for some buckets lists
and opens only theirs. Within, files are clustered and sorted by keys that begin with
the bucket and the group or partition, so bounds on these skip row groups.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidelog.plans import manifest as entries_of
from tidelog.plans.manifest import HISTORY, NEW_FILTER, ROLLBACK
from tidelog.schemas import CATALOG, FILTER, GROUP_KEY, MUTATIONS, ROLLBACK_LOG, SEQNO_TUPLE
from tidelog.session import no_rows
from tidelog.sources import paths
from tidelog.sources.files import read_rollback_log, write_rollback_log

#: Mutations on file also name the run that captured them.
STORED_MUTATIONS = StructType([*MUTATIONS.fields, StructField("captured_run", StringType())])
SCHEMAS = {
    NEW_FILTER: FILTER,
    entries_of.FILTER: FILTER,
    entries_of.MUTATIONS: STORED_MUTATIONS,
    ROLLBACK: ROLLBACK_LOG,
    entries_of.CATALOG: CATALOG,
    HISTORY: FILTER,
}
CLUSTERED = {entries_of.FILTER: GROUP_KEY, entries_of.MUTATIONS: SEQNO_TUPLE}
#: Formats a store can be told to write; what it reads is up to each run.
STORE_FORMATS = ["parquet", "orc"]
FOLDERS = "run string, in_bucket string"
#: Partitions that one statement makes known.
ADDED_AT_ONCE = 500
MAX_LISTED_GROUPS = 1000


@dataclass(frozen=True)
class Part:
    """Files of one run that a reader can see, and whether it sees all their groups."""

    run: str
    folder: str
    whole: bool
    file_format: str
    num_files: int | None
    buckets: tuple[str, ...]


@dataclass(frozen=True)
class Scope:
    """Bounds on buckets, groups and partitions that a read can be held to."""

    buckets: tuple[str, ...]
    pgroups: tuple[int, ...] | None = None
    partitions: tuple[int, int] | None = None

    def condition(self, names: Sequence[str]) -> Column:
        found = F.col("in_bucket").isin(*self.buckets)
        if self.pgroups is not None:
            if len(self.pgroups) <= MAX_LISTED_GROUPS:
                found &= F.col("pgroup").isin(*self.pgroups)
            if self.partitions and "partition_id" in names:
                found &= F.col("partition_id").between(*[F.lit(x).cast("short") for x in self.partitions])
        return found


class RunFiles:
    """Writes and reads the files of runs below `home`."""

    def __init__(self, spark: SparkSession, home: str, num_buckets: int, file_format: str = "parquet"):
        if file_format not in STORE_FORMATS:
            raise ValueError(f"unsupported store format: {file_format}")
        self.spark, self.home, self.num_buckets, self.file_format = spark, home, num_buckets, file_format
        # another layout at the same path must not meet the tables of this one
        self._prefix = "tidelog_" + hashlib.md5(f"{home}:{num_buckets}".encode()).hexdigest()[:12]

    def new_folder(self, run: str) -> str:
        """A folder name that no other attempt at this run has."""
        return f"{run}-{uuid.uuid4().hex[:12]}"

    def path(self, kind: str, folder: str) -> str:
        return f"{self.home}/{kind}/run={folder}"

    def delete(self, kind: str, folder: str) -> None:
        paths.delete(self.spark, self.path(kind, folder))

    def num_files(self, kind: str, folder: str) -> int:
        return paths.count_data_files(self.spark, self.path(kind, folder))

    def check(self, kind: str, parts: Sequence[Part]) -> None:
        """Abort where files of a run are missing, which would read as no rows."""
        for part in parts:
            if part.num_files is not None and self.num_files(kind, part.folder) < part.num_files:
                raise RuntimeError(f"files of run {part.run} are missing: {self.path(kind, part.folder)}")

    # --- writing ----------------------------------------------------------------

    def write_clustered(self, kind: str, folder: str, rows: DataFrame) -> None:
        """Write one run as bucket files; rows must already be spread by bucket."""
        keys = CLUSTERED[kind]
        table = f"{self._prefix}_{kind}_{uuid.uuid4().hex}"
        (
            rows.select(*SCHEMAS[kind].names, F.col("bucket").alias("in_bucket"))
            .write.format(self.file_format)
            .partitionBy("in_bucket")
            .bucketBy(self.num_buckets, *keys)
            .sortBy(*keys)
            .option("path", self.path(kind, folder))
            .saveAsTable(table)
        )
        self.spark.sql(f"DROP TABLE {table}")

    def write(self, kind: str, folder: str, rows: DataFrame) -> None:
        """Write one run as it comes."""
        path = self.path(kind, folder)
        if kind == ROLLBACK:
            write_rollback_log(rows, path)
        elif kind == entries_of.CATALOG:
            rows.select(*SCHEMAS[kind].names).write.parquet(path)
        else:
            by_bucket = rows.select(*SCHEMAS[kind].names, F.col("bucket").alias("in_bucket"))
            by_bucket.write.format(self.file_format).partitionBy("in_bucket").save(path)

    # --- reading ----------------------------------------------------------------

    def read(self, kind: str, parts: Sequence[Part], scope: Scope | None = None) -> DataFrame:
        """Rows of the parts, with the folder they lie in as `run`."""
        schema = SCHEMAS[kind]
        if not parts:
            return no_rows(self.spark, StructType([*schema.fields, StructField("run", StringType())]))
        self.check(kind, parts)
        if kind == ROLLBACK:
            folders = [self.path(kind, part.folder) for part in parts]
            rows = read_rollback_log(self.spark, folders, f"{self.home}/{kind}")
            return rows.where(F.col("bucket").isin(*scope.buckets)) if scope else rows
        formats: dict[str, list[Part]] = {}
        for part in parts:
            formats.setdefault(part.file_format, []).append(part)
        found = []
        for file_format, same in sorted(formats.items()):
            if kind in CLUSTERED:
                rows = self._clustered(kind, file_format, same, scope)
            else:
                rows = self._plain(kind, file_format, same)
            if scope is not None:
                rows = rows.where(scope.condition(schema.names))
            found.append(rows.select(*schema.names, "run"))
        return reduce(DataFrame.unionByName, found)

    def _plain(self, kind: str, file_format: str, parts: Sequence[Part]) -> DataFrame:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCHEMAS[kind].fields)
        folders = [self.path(kind, part.folder) for part in parts]
        reader = self.spark.read.schema(f"{columns}, {FOLDERS}").format(file_format)
        return reader.option("basePath", f"{self.home}/{kind}").load(folders)

    def _clustered(self, kind: str, file_format: str, parts: Sequence[Part], scope: Scope | None) -> DataFrame:
        """The runs of a kind as one bucketed table."""
        table = f"{self._prefix}_{kind}_{file_format}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCHEMAS[kind].fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {FOLDERS}) USING {file_format}"
            f" PARTITIONED BY (run, in_bucket) CLUSTERED BY ({', '.join(CLUSTERED[kind])})"
            f" INTO {self.num_buckets} BUCKETS LOCATION {_quoted(f'{self.home}/{kind}')}"
        )
        wanted = None if scope is None else set(scope.buckets)
        known = [
            f"PARTITION (run = {_quoted(part.folder)}, in_bucket = {_quoted(bucket)})"
            for part in parts
            for bucket in part.buckets
            if wanted is None or bucket in wanted
        ]
        for at in range(0, len(known), ADDED_AT_ONCE):
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(known[at : at + ADDED_AT_ONCE])}")
        return self.spark.table(table).where(F.col("run").isin(*[part.folder for part in parts]))


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"

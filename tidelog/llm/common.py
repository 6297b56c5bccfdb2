"""Shared pieces of the training-data operators."""

from __future__ import annotations

import functools
import gc
import time
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import fits_broadcast, scratch_path
from tidelog.sources import paths

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Registered queries of this folder and their SQL, by name.
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def registered(name: str, sql: str | None = None):
    """Register a query; `sql` is its DuckDB text where SQL can express it."""

    def add(query):
        QUERIES[name] = query
        if sql:
            ORACLE[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, which `lower` does not."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def written(df: DataFrame, name: str) -> DataFrame:
    """Compute `df` once into Parquet below the shared folder and read it back.

    Cuts the lineage: a lost executor costs its running tasks only. Shuffle files of
    the jobs before are given back first.
    """
    release(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    made = _made.get()
    if made is not None:
        made.append(path)
    df.write.option("compression", "zstd").parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._scratch = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete the tables of `written` frames that nothing will read any more."""
    for frame in frames:
        paths.delete(frame.sparkSession, frame._scratch)


#: Folders written by the stage at work, and by the last one of each application.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)
_last: dict[str, list[str]] = {}


def stage(function):
    """A stage of a pipeline, whose result is written before the next stage is called.

    So each stage deletes what the one before has left in the shared folder. The
    result of the last one stays readable.
    """

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        for path in _last.pop(application, []):
            paths.delete(spark, path)
        token = _made.set([])
        try:
            result = function(spark, docs, sf_dir)
            _last[application] = _made.get()
            return result
        finally:
            _made.reset(token)

    return run


def joined(rows: DataFrame, side: DataFrame, on, how: str = "inner", measured: bool = True) -> DataFrame:
    """`rows` joined to a side that is computed once.

    The side is broadcast if its measured size allows. Else, and always with `measured`
    off, for sides that grow like the rows, both take an exchange, and adaptive
    execution splits what one key holds too much of.
    """
    side = written(side, "side")
    return rows.join(F.broadcast(side) if measured and fits_broadcast(side) else side, on, how)


#: Seconds until what Python has dropped is dropped on the JVM too: it is handed over once a second.
HANDED_OVER = 1.5


def release(spark: SparkSession, wait: float = 0) -> None:
    """Let the driver notice unused shuffles and checkpoints, so that their files go.

    Those of the last table go only with a `wait` of `HANDED_OVER`, for large ones.
    """
    gc.collect()
    time.sleep(wait)
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

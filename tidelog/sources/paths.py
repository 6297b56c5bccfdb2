"""Folder checks and listings through the session's own file systems."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _located(spark: SparkSession, path: str):
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(context._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = _located(spark, path)
    return files.exists(location)


def is_folder(spark: SparkSession, path: str) -> bool:
    files, location = _located(spark, path)
    return files.exists(location) and files.getFileStatus(location).isDirectory()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, none when it does not exist."""
    files, location = _located(spark, path)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location))


def count_data_files(spark: SparkSession, path: str) -> int:
    """Files below a folder that hold rows; none when it does not exist."""
    files, location = _located(spark, path)
    if not files.exists(location):
        return 0
    found, number = files.listFiles(location, True), 0
    while found.hasNext():
        number += found.next().getPath().getName().startswith("part-")
    return number


def delete(spark: SparkSession, path: str) -> None:
    files, location = _located(spark, path)
    files.delete(location, True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole or not at all; False when it exists already.

    The text is written aside and then given its name, which fails if another
    writer was first: a hard link on a local file system, elsewhere a rename that
    does not replace.
    """
    files, location = _located(spark, path)
    jvm = spark.sparkContext._jvm
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = files.create(aside)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    try:
        if files.getScheme() == "file":
            local = [jvm.java.io.File(x.toUri().getPath()).toPath() for x in (location, aside)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                files.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
            )
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(aside, location, options)
    except Py4JJavaError:
        if files.exists(location):
            return False
        raise
    finally:
        files.delete(aside, False)
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    files, location = _located(spark, path)
    stream = files.open(location)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def matches(spark: SparkSession, pattern: str) -> bool:
    """True when at least one file or folder matches the glob."""
    files, location = _located(spark, pattern)
    return bool(files.globStatus(location))


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Files that match a glob, with size; no row when none does."""
    columns = "path string, length bigint"
    if not matches(spark, pattern):
        return spark.createDataFrame([], columns)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(pattern)
        .select(F.col("path"), F.col("length"))
    )

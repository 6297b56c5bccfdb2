"""Identity of a stream across restarts."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id that a stream keeps for as long as it keeps its checkpoint folder.

    Batch numbers mean something only together with it: a stream with another
    checkpoint counts its batches from zero again.
    """
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]

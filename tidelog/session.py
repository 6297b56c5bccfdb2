"""Session helpers: shared scratch folder, size-checked broadcast, salted joins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

MAX_BROADCAST_BYTES = 16 * 1024 * 1024
FIXED_WIDTH_BYTES = 16
MAX_SALTS = 256


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as the session names it."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tidelog-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty frame the optimizer knows to be empty, so joins with it vanish."""
    columns = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields]
    return spark.range(1).where("false").selectExpr(*columns)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Compute `df` once and cut its lineage with a reliable checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when the rows of `df` take at most `max_bytes`.

    Reads no more rows than could fit, so the check itself stays bounded.
    """
    width = [str(FIXED_WIDTH_BYTES * len(df.columns))]
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            width.append(f"coalesce(octet_length(`{field.name}`), 0)")
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            width.append(f"coalesce(octet_length(to_json(struct(`{field.name}`))), 0)")
    max_rows = max_bytes // (FIXED_WIDTH_BYTES * len(df.columns))
    seen = (
        df.limit(max_rows + 1)
        .selectExpr("count(*) AS n", f"coalesce(sum(bigint({' + '.join(width)})), 0) AS size")
        .first()
    )
    return seen["n"] <= max_rows and seen["size"] <= max_bytes


class Lookup:
    """A usually small side of a join, computed once and its size checked.

    It must hold at most one row per join key. Within the size bound it is
    broadcast, so the other side is not shuffled. Beyond it both sides are
    shuffled on the key plus a salt, because one key may hold a large share of
    the rows; the side is repeated once per salt, so each row still meets
    exactly its own match.
    """

    def __init__(self, side: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES):
        self.side = stored(side)
        self.small = fits_broadcast(self.side, max_bytes)

    def join(
        self,
        rows: DataFrame,
        on: Sequence[str],
        how: str,
        condition: str | None = None,
        spread: Sequence[str] = ("seqno",),
    ) -> DataFrame:
        """Join `rows` to this side; `condition` is SQL over `l.x` and `r.x`.

        `spread` names columns of `rows` whose hash picks the salt.
        """
        keys = list(on)
        if self.small:
            left, right = rows, F.broadcast(self.side)
        else:
            partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            salts = max(2, min(MAX_SALTS, partitions))
            salt = f"pmod(xxhash64({', '.join(spread)}), {salts}) AS _salt"
            left = rows.selectExpr("*", salt)
            right = self.side.selectExpr("*", f"explode(sequence(0L, {salts - 1}L)) AS _salt")
            keys.append("_salt")
        matches = [f"l.{key} = r.{key}" for key in keys]
        if condition:
            matches.append(condition)
        joined = left.alias("l").join(right.alias("r"), F.expr(" AND ".join(matches)), how)
        kept = [f"l.{name}" for name in rows.columns]
        if how not in ("left_semi", "left_anti"):
            kept += [f"r.{name}" for name in self.side.columns if name not in on]
        return joined.select(*kept)

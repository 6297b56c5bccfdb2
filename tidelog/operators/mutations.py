"""Mutation-log operators: liveness, restore, masking, sampling, mapping."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.functions.scalars import content_text
from tidelog.schemas import PARTITION, SEQNO_TUPLE
from tidelog.session import Lookup, stored

HASH_RANGE = 2**32


def live_mutations(mutations: DataFrame, filter_rows: DataFrame) -> DataFrame:
    """Mutations whose (partition, uuid, seqno) stands in the filter.

    The filter grows with the data, so nothing is hinted: the adaptive planner
    broadcasts it only when it turns out small. Only the three-column tuple of
    the filter is shuffled.
    """
    return mutations.join(
        filter_rows.select(*SEQNO_TUPLE), SEQNO_TUPLE, "left_semi"
    ).select(*mutations.columns)


def as_of(rows: DataFrame, positions: DataFrame) -> DataFrame:
    """Rows that their partition had reached at its position.

    `positions` are (bucket, partition_id, seqno); a partition not listed has no rows.
    """
    reached = positions.select(*PARTITION, F.col("seqno").alias("reached_seqno"))
    return Lookup(reached).join(rows, PARTITION, "left_semi", "l.seqno <= r.reached_seqno")


def count_by_type(rows: DataFrame) -> DataFrame:
    return rows.groupBy("bucket", "rec_type").agg(F.count(F.lit(1)).alias("n"))


def groups_over_threshold(files: DataFrame, threshold: int = 10) -> DataFrame:
    """Groups with strictly more than `threshold` mutation files.

    `files` holds rows of (bucket, pgroup, file); repeats count once.
    """
    return (
        files.groupBy("bucket", "pgroup")
        .agg(F.countDistinct("file").alias("num_files"))
        .where(F.col("num_files") > threshold)
    )


def restore(
    mutations: DataFrame,
    filter_rows: DataFrame,
    since: DataFrame | None = None,
    include_deletes: bool = True,
) -> DataFrame:
    """Live rows to write back to a target; see `to_restore`."""
    return live_mutations(to_restore(mutations, since, include_deletes), filter_rows)


def to_restore(
    rows: DataFrame, since: DataFrame | None = None, include_deletes: bool = True
) -> DataFrame:
    """Rows that a restore writes back, of live ones or of all.

    With `since` (bucket, partition_id, since_seqno) only rows above that seqno
    of their partition are restored; a partition not listed is restored whole.
    """
    if since is not None:
        rows = Lookup(since.select(*PARTITION, "since_seqno")).join(
            rows, PARTITION, "left_anti", "l.seqno <= r.since_seqno"
        )
    return rows if include_deletes else rows.where(~F.col("rec_type").eqNullSafe("DELETE"))


def stands_in_every_match(pattern: str, text: str) -> bool:
    """Whether a pattern has `text` as a plain part of its own, outside groups and classes.

    Says no where this can't be told from the pattern's outermost level alone.
    """
    if not re.fullmatch(r"[^\\^$.|?*+()\[\]{}]+", text) or "(?" in pattern:
        return False
    # what is left of classes, groups and escapes can't be part of the text
    level = re.sub(r"\\.", "\0", pattern, flags=re.DOTALL)
    level = re.sub(r"\[\^?\]?[^\]]*\]", "\0", level)
    while level != (inner := re.sub(r"\([^()]*\)", "\0", level)):
        level = inner
    level = re.sub(r"\{[^}]*\}", "{", level)
    if re.search(r"[\[\]()|]", level):
        return False
    return any(level[found.end() :][:1] not in ("?", "*", "{") for found in re.finditer(re.escape(text), level))


def mask(
    rows: DataFrame,
    content_rules: list[tuple[str, ...]] | None = None,
    hash_key: bool = False,
) -> DataFrame:
    """Mask the content, by (pattern, replacement) rules in order, and the key.

    A rule may name, as a third part, a text that stands in every match, such as
    the `@` of a mail address: a plain search for it then spares the pattern most
    rows. A text of which the pattern does not show that is refused. Without rules, letters and digits are blotted out by class. A hashed
    key still joins to equal keys.
    """
    text = content_text(F.col("content"))
    if content_rules is None:
        text = F.mask(text)
    else:
        for pattern, replacement, *needed in content_rules:
            replaced = F.regexp_replace(text, pattern, replacement)
            if needed:
                if not stands_in_every_match(pattern, needed[0]):
                    raise ValueError(f"{needed[0]!r} need not stand in a match of {pattern!r}")
                replaced = F.when(F.contains(text, F.lit(needed[0])), replaced).otherwise(text)
            text = replaced
    masked = rows.withColumn("content", text.cast("binary"))
    return masked.withColumn("key", F.sha2("key", 256)) if hash_key else masked


def _hash_position(key: Column) -> Column:
    """Position of a key in [0, 2^32), from the leading digits of its digest."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def sample(rows: DataFrame, fraction: float, by: str = "key") -> DataFrame:
    """A share of the keys, chosen by hash: the same keys on every run."""
    return rows.where(_hash_position(F.col(by)) < int(fraction * HASH_RANGE))


def sample_by(rows: DataFrame, stratum: str, fractions: dict[str, float], by: str = "key") -> DataFrame:
    """`sample` with one share per value of `stratum`; unlisted values give none."""
    limit = F.lit(0)
    for value, fraction in fractions.items():
        limit = F.when(F.col(stratum) == value, int(fraction * HASH_RANGE)).otherwise(limit)
    return rows.where(_hash_position(F.col(by)) < limit)


def sample_exact(rows: DataFrame, stratum: str, size: int, by: str = "key") -> DataFrame:
    """Rows of exactly `size` keys per value of `stratum`, or of all where it has fewer.

    They are the keys with the lowest hash positions. Where these end is found from
    histograms, of the leading bits of all positions first and then, within the bin
    that holds the last key, of the next bits, so nothing is sorted as a whole and no
    stratum is one task's work. Rows without a stratum are left out.
    """
    keys = rows.where(F.col(stratum).isNotNull()).select(F.col(stratum).alias("_stratum"), F.col(by).alias("_key"))
    keys = stored(keys.distinct().withColumn("_position", _hash_position(F.col("_key"))))
    keys, chosen = keys.withColumn("_need", F.lit(size).cast("long")), []
    names = ["_stratum", "_key"]
    for shift in (20, 8):
        keys = keys.withColumn("_bin", F.shiftright("_position", shift))
        bins = keys.groupBy("_stratum", "_bin").agg(F.count("*").alias("_n"), F.first("_need").alias("_needed"))
        upto = F.sum("_n").over(Window.partitionBy("_stratum").orderBy("_bin"))
        bins = bins.withColumn("_upto", upto).where("_upto - _n < _needed")
        bins = bins.selectExpr("_stratum", "_bin", "_upto <= _needed AS _whole", "_needed - (_upto - _n) AS _rest")
        found = Lookup(bins).join(keys, ["_stratum", "_bin"], "inner", spread=["_key"])
        chosen.append(found.where("_whole").select(*names))
        keys = found.where("NOT _whole").withColumn("_need", F.col("_rest")).select(*names, "_position", "_need")
    order = Window.partitionBy("_stratum").orderBy("_position", "_key")
    last = keys.withColumn("_rank", F.row_number().over(order)).where("_rank <= _need").select(*names)
    picked = Lookup(chosen[0].unionByName(chosen[1]).unionByName(last).toDF(stratum, by))
    return picked.join(rows, [stratum, by], "left_semi")


class MutationMapper:
    """A user callback over live mutations.

    `setup` runs before the first row of a task and `teardown` after its last
    row, also when the task fails. Override `map_batch` for whole batches, or
    `map_row` where a single record at a time is all the callback can take.
    """

    def setup(self) -> None:
        pass

    def map_batch(self, batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([self.map_row(row) for row in batch.to_dict("records")])

    def map_row(self, row: dict) -> dict:
        raise NotImplementedError

    def teardown(self) -> None:
        pass


def map_rows(rows: DataFrame, mapper: MutationMapper, schema) -> DataFrame:
    """Apply `mapper` batch by batch, without a shuffle; lazy, never collected."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mapper.setup()
        try:
            for batch in batches:
                if len(batch):
                    yield mapper.map_batch(batch)
        finally:
            mapper.teardown()

    return rows.mapInPandas(run, schema)


def map_mutations(
    mutations: DataFrame,
    filter_rows: DataFrame,
    mapper: MutationMapper | Callable[[DataFrame], DataFrame],
    schema=None,
) -> DataFrame:
    """Map the live mutations.

    A function from DataFrame to DataFrame stays in Spark's own expressions and
    is the fast way; a `MutationMapper` runs Python and needs a `schema`.
    """
    live = live_mutations(mutations, filter_rows)
    if isinstance(mapper, MutationMapper):
        return map_rows(live, mapper, schema)
    return live.transform(mapper)


class MutationSink:
    """A target that records are written back to, one batch at a time.

    A task may run again after a failure, so `write` must bear repeats.
    """

    def setup(self) -> None:
        pass

    def write(self, batch: pd.DataFrame) -> None:
        raise NotImplementedError

    def teardown(self) -> None:
        pass


class _Delivery(MutationMapper):
    def __init__(self, sink: MutationSink):
        self.setup, self.teardown, self.write = sink.setup, sink.teardown, sink.write

    def map_batch(self, batch: pd.DataFrame) -> pd.DataFrame:
        self.write(batch)
        return pd.DataFrame({"delivered": [len(batch)]})


def deliver(rows: DataFrame, sink: MutationSink) -> int:
    """Write rows to `sink` from the tasks that hold them; returns how many."""
    written = map_rows(rows, _Delivery(sink), "delivered long")
    return written.agg(F.coalesce(F.sum("delivered"), F.lit(0))).first()[0]

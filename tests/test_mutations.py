"""Gating, restore, masking, sampling and mapping of mutations."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import keyed
from tidelog.functions.records import lift_to_mutations
from tidelog.functions.scalars import (
    content_length,
    content_text,
    failover_log_text,
    record_size,
    record_text,
    same_record,
)
from tidelog.operators.mutations import (
    MutationMapper,
    MutationSink,
    count_by_type,
    deliver,
    groups_over_threshold,
    map_mutations,
    map_rows,
    mask,
    restore,
    sample,
    sample_by,
)


def data(make):
    return make.mutations(
        [
            {"seqno": 1, "key": "a", "content": b"Call 555, Bob"},
            {"seqno": 2, "key": "b", "content": None, "rec_type": "DELETE"},
            {"seqno": 3, "key": "c", "content": b"\xff\xfe ok", "rec_type": "INSERT"},
        ]
    )


def everything(make):
    return make.filter([{"seqno": n, "key": k} for n, k in ((1, "a"), (2, "b"), (3, "c"))])


def test_threshold_is_strict(spark):
    files = [("b", 0, f"f{n}") for n in range(10)] + [("b", 1, f"f{n}") for n in range(11)]
    frame = spark.createDataFrame(files + files, "bucket string, pgroup int, file string")
    assert [(r["pgroup"], r["num_files"]) for r in groups_over_threshold(frame).collect()] == [(1, 11)]


def test_restore(make, spark):
    mutations, filters = data(make), everything(make)
    assert keyed(restore(mutations, filters)) == ["a@1", "b@2", "c@3"]
    assert keyed(restore(mutations, filters, include_deletes=False)) == ["a@1", "c@3"]
    schema = "bucket string, partition_id short, since_seqno long"
    since = spark.createDataFrame([("b", 0, 1)], schema)
    assert keyed(restore(mutations, filters, since)) == ["b@2", "c@3"]
    elsewhere = spark.createDataFrame([("b", 9, 1)], schema)
    assert keyed(restore(mutations, filters, elsewhere)) == ["a@1", "b@2", "c@3"]


def test_mask(make):
    def texts(df):
        return [row["t"] for row in df.orderBy("seqno").select(F.col("content").cast("string").alias("t")).collect()]

    assert texts(mask(data(make)))[0] == "Xxxx nnn, Xxx"
    masked = mask(data(make), [("[0-9]+", "#"), ("Bob", "*")], hash_key=True)
    assert texts(masked)[:2] == ["Call #, *", None]
    narrowed = mask(data(make), [("[0-9]+, B", "#", ","), ("l+", "L")])
    assert texts(narrowed)[:2] == ["CaL #ob", None]
    assert all(len(row["key"]) == 64 for row in masked.collect())
    # a text that need not stand in a match would leave rows unmasked
    with pytest.raises(ValueError, match="need not stand"):
        mask(data(make), [("l+", "L", "absent")])


def test_sample_is_stable_and_nested(make):
    many = make.mutations([{"seqno": n, "key": f"k{n}"} for n in range(400)])
    small, large = keyed(sample(many, 0.2)), keyed(sample(many, 0.6))
    assert set(small) < set(large) and small == keyed(sample(many.repartition(3), 0.2))
    assert 40 < len(small) < 120 and keyed(sample(many, 1.0)) == keyed(many)
    assert sample(many, 0.0).count() == 0


def test_sample_by_stratum(make):
    rows = [{"seqno": n, "key": f"k{n}", "rec_type": ("UPDATE", "DELETE")[n % 2]} for n in range(80)]
    counts = count_by_type(sample_by(make.mutations(rows), "rec_type", {"UPDATE": 1.0}))
    assert [(r["rec_type"], r["n"]) for r in counts.collect()] == [("UPDATE", 40)]


class Recorder(MutationMapper):
    """Logs its calls to a file, as tasks run in other processes."""

    def __init__(self, path, fails=False):
        self.path, self.fails = path, fails

    def _log(self, text):
        with open(self.path, "a") as out:
            out.write(text + "\n")

    def setup(self):
        self._log("setup")

    def map_row(self, row):
        self._log("map " + row["key"])
        if self.fails:
            raise ValueError("no")
        return {"key": row["key"].upper()}

    def teardown(self):
        self._log("teardown")


def test_mapper_hooks_wrap_the_rows(make, tmp_path):
    log = tmp_path / "log"
    live = data(make).coalesce(1)
    mapped = map_rows(live, Recorder(str(log)), "key string")
    assert not log.exists()
    assert sorted(row["key"] for row in mapped.collect()) == ["A", "B", "C"]
    assert log.read_text().split("\n")[:-1] == ["setup", "map a", "map b", "map c", "teardown"]


def test_mapper_teardown_runs_after_a_failure(make, tmp_path):
    log = tmp_path / "log"
    with pytest.raises(Exception, match="no"):
        map_rows(data(make).coalesce(1), Recorder(str(log), fails=True), "key string").collect()
    assert log.read_text().split("\n")[-2] == "teardown"


def test_deliver_writes_every_record(make, tmp_path):
    log = tmp_path / "restored"

    class Printer(MutationSink):
        def write(self, batch):
            with open(log, "a") as out:
                out.writelines(f"Rec: {key}\n" for key in batch["key"])

    assert deliver(restore(data(make), everything(make)), Printer()) == 3
    assert sorted(log.read_text().split("\n")[:-1]) == ["Rec: a", "Rec: b", "Rec: c"]
    assert deliver(data(make).where("false"), Printer()) == 0


def test_map_batches_and_columns_agree(make):
    class Lengths(MutationMapper):
        def map_batch(self, batch):
            return pd.DataFrame({"n": batch["key"].str.len() + batch["seqno"]})

    by_batch = map_mutations(data(make), everything(make), Lengths(), "n long")
    by_column = map_mutations(
        data(make),
        everything(make),
        lambda rows: rows.select((F.length("key") + F.col("seqno")).alias("n")),
    )
    assert sorted(r["n"] for r in by_batch.collect()) == sorted(r["n"] for r in by_column.collect())


def test_scalars(make, spark):
    row = (
        data(make)
        .where("seqno <> 2")
        .select(
            "seqno",
            content_text(F.col("content")).alias("text"),
            content_length(F.col("content")).alias("length"),
            record_size(F.col("content")).alias("size"),
            record_text().alias("line"),
        )
        .orderBy("seqno")
        .collect()
    )
    assert row[0]["text"] == "Call 555, Bob" and row[1]["text"] == "�� ok"
    assert row[0]["length"] == 13 and row[0]["size"] == 650 + 13
    assert row[0]["line"] == "(partitionId=0, seqNo=1, key=a, recType=UPDATE)"
    deleted = data(make).where("seqno = 2").select(content_length(F.col("content")).alias("n"))
    assert deleted.first()["n"] == -1
    logs = spark.sql("SELECT array(struct(7L AS uuid, 3L AS seqno), struct(5L AS uuid, 0L AS seqno)) AS log")
    assert logs.select(failover_log_text(F.col("log"))).first()[0] == "{uuid=7, seqno=3}, {uuid=5, seqno=0}"
    null = F.struct(F.lit(None).cast("string"), F.lit(1))
    assert spark.range(1).select(same_record(null, null)).first()[0] is True
    assert spark.range(1).select(same_record(null, F.struct(F.lit("x"), F.lit(1)))).first()[0] is False


def test_lift(make):
    lifted = lift_to_mutations(everything(make))
    assert lifted.columns[-6:] == ["content", "expiration", "revision_seqno", "lock_time", "cas", "flags"]
    assert all(row["content"] is None for row in lifted.collect())

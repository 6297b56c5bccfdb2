import pytest
from pyspark.sql import SparkSession

from tidelog.schemas import CHANGE_EVENTS, FILTER, MUTATIONS, RANGES, ROLLBACK_LOG


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tidelog-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


def _frame(spark, rows, schema, defaults):
    names = schema.names
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    full = [tuple({**defaults, **row}.get(name) for name in names) for row in rows]
    return spark.createDataFrame(full, ddl)


GROUPED = {"bucket": "b", "pgroup": 0, "partition_id": 0, "partition_uuid": 0}


@pytest.fixture
def make(spark):
    """Frames of each schema from short dicts."""

    class Make:
        def filter(self, rows):
            return _frame(spark, rows, FILTER, {**GROUPED, "rec_type": "UPDATE"})

        def mutations(self, rows):
            return _frame(spark, rows, MUTATIONS, {**GROUPED, "rec_type": "UPDATE"})

        def rollback(self, rows):
            return _frame(spark, rows, ROLLBACK_LOG, GROUPED)

        def events(self, rows):
            numbered = [{"arrival": i + 1, **row} for i, row in enumerate(rows)]
            return _frame(spark, numbered, CHANGE_EVENTS, {"bucket": "b", "partition_id": 0})

        def ranges(self, rows):
            return _frame(
                spark,
                rows,
                RANGES,
                {"bucket": "b", "uuid": 0, "snapshot_start_seqno": 0, "snapshot_end_seqno": 0},
            )

    return Make()


def keyed(df):
    """`key@seqno` of each row, sorted."""
    return sorted(f"{row['key']}@{row['seqno']}" for row in df.collect())

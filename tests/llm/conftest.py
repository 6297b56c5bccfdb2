import os

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """The smallest given documents."""
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with internal ones."""

    def make(rows, partitions=3):
        schema = "doc_id long, text string, k string, component string, s string, t string, n long"
        full = [(doc, text, "k", "component", "s", "t", 7) for doc, text in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make

"""Files: formats, empty inputs, rollback lines, listings."""

import pytest

from tests.conftest import keyed
from tidelog.schemas import CHANGE_EVENTS
from tidelog.sources import files, paths
from tidelog.sources.events import read_events, stream_events


@pytest.mark.parametrize("name", files.FORMATS)
def test_filter_round_trip(make, spark, tmp_path, name):
    path = str(tmp_path / name)
    files.write_rows(make.filter([{"seqno": 1, "key": "a,\"b"}, {"seqno": 2, "key": "ü"}]), path, name)
    assert keyed(files.read_filter(spark, path, name)) == ["a,\"b@1", "ü@2"]
    with pytest.raises(Exception, match="already exists"):
        files.write_rows(make.filter([]), path, name)


@pytest.mark.parametrize("name", files.FORMATS)
def test_mutations_keep_all_fields(make, spark, tmp_path, name):
    row = {"seqno": 1, "key": "k", "content": b"\x00\xff", "expiration": 1, "revision_seqno": 2, "lock_time": 3, "cas": 4, "flags": 5}
    frame = make.mutations([row, {"seqno": 2, "key": "none"}])
    files.write_rows(frame, str(tmp_path / name), name)
    back = files.read_mutations(spark, str(tmp_path / name), name)
    assert sorted(back.collect(), key=str) == sorted(frame.collect(), key=str)


def test_missing_paths(spark, tmp_path):
    nowhere = str(tmp_path / "none*")
    assert files.read_filter_or_empty(spark, nowhere).count() == 0
    assert files.read_mutations_or_empty(spark, nowhere).count() == 0
    assert files.read_rollback_log_or_empty(spark, nowhere).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_filter(spark, nowhere).count()
    with pytest.raises(ValueError, match="unsupported format"):
        files.read_filter(spark, nowhere, "avro2")


def rollback_file(tmp_path, text):
    folder = tmp_path / "bucket=sales" / "pgroup=3"
    folder.mkdir(parents=True)
    (folder / "log.txt").write_text(text)
    return str(tmp_path)


def test_rollback_lines(spark, tmp_path):
    path = rollback_file(tmp_path, "1,7,8\n2,-9,10,extra,fields\n")
    rows = sorted(tuple(r) for r in files.read_rollback_log(spark, path).collect())
    assert rows == [("sales", 3, 1, 7, 8), ("sales", 3, 2, -9, 10)]


@pytest.mark.parametrize("line", ["1,x,8", "1, 7,8", "1,7", "99999,7,8", ""])
def test_bad_rollback_line_aborts(spark, tmp_path, line):
    path = rollback_file(tmp_path, line + "\n1,1,1\n")
    with pytest.raises(Exception):
        files.read_rollback_log(spark, path).collect()


def test_rollback_round_trip(make, spark, tmp_path):
    entries = make.rollback([{"seqno": 5}, {"seqno": 6, "pgroup": 2, "bucket": "c"}])
    files.write_rollback_log(entries, str(tmp_path / "log"))
    back = files.read_rollback_log(spark, str(tmp_path / "log"))
    assert sorted(back.collect()) == sorted(entries.select(back.columns).collect())


def test_paths(make, spark, tmp_path):
    path = str(tmp_path / "rows")
    assert paths.list_files(spark, path).count() == 0 and not paths.is_folder(spark, path)
    files.write_rows(make.filter([{"seqno": 1, "key": "a"}]).coalesce(1), path)
    assert paths.is_folder(spark, path) and paths.matches(spark, path + "/*.parquet")
    assert paths.list_files(spark, path + "/*.parquet").count() == 1
    assert paths.child_names(spark, str(tmp_path / "none")) == []


def test_event_sources(make, spark, tmp_path):
    path = str(tmp_path / "events")
    make.events([{"kind": "mutation", "seqno": 1, "key": "k"}]).write.parquet(path)
    assert read_events(spark, path).first()["key"] == "k"
    assert stream_events(spark, path).schema.names == CHANGE_EVENTS.names

"""Token files: round trips against the tokenizer itself, random access, retried tasks."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidelog.llm import token_files as files
from tidelog.session import scratch_path

PATH = public_tokenizers.path(files.TOKENIZER)
TEXTS = [
    "Plain words, twice plain words.", "", None, "It's o'clock - don't", "naïve Ünïcode space   x", "é a\x1cb",
    "<|endoftext|> and <| not |>", "ＡＢＣ ½ ² \U0001f600\U0001f600", '"quoted" ! !!', "汉字 かな 한글", "a1b22c333", "ª º µ × ÷ _ `x`",
    "tab\tnew\nline\r\n", "İstanbul ǅ ﬁ", "x" * 3000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, rows):
    found, start = [], 0
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        found.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def stored(spark, frame, rows, **more):
    path = scratch_path(spark, "tokens")
    files.write_token_files(frame(rows), path, PATH, **more)
    return path


def read(spark, path):
    return sorted((tuple(r) for r in files.read_documents(spark, path).collect()), key=lambda r: r[1])


@pytest.mark.parametrize("seed", range(2))
def test_round_trip(spark, frame, tokenizer, seed, monkeypatch):
    monkeypatch.setattr(files, "BATCH", 3)
    pick = random.Random(seed)
    rows = [(doc, " ".join(filter(None, pick.choices(TEXTS, k=pick.randrange(4)))) or pick.choice(TEXTS)) for doc in range(120)]
    shuffled = pick.sample(rows, len(rows))
    path = stored(spark, frame, shuffled, length=pick.choice([7, 64]))
    assert read(spark, path) == expected(tokenizer, rows)


def test_each_text(tokenizer):
    for text in TEXTS:
        ids = np.frombuffer(files.text_ids(text, PATH, 1), "<u2")
        assert ids.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], text


def test_odd_rows(spark, frame, tokenizer):
    """No id, one id for several rows, equal rows, one very long text."""
    rows = [(None, "none"), (5, "a b"), (5, "a b"), (5, "c"), (6, "long word " * 60_000), (7, None)]
    found = read(spark, stored(spark, frame, rows))
    assert sorted((r[0] or -1, r[2], r[3]) for r in found) == sorted((r[0] or -1, r[2], r[3]) for r in expected(tokenizer, rows))
    assert [r[1] for r in found] == list(np.cumsum([0, *[r[2] for r in found]])[:-1])
    assert [r[0] for r in found] == [None, 5, 5, 5, 6, 7]


def test_no_documents(spark, frame):
    assert read(spark, stored(spark, frame, [])) == []


def test_random_access(spark, frame, tokenizer):
    rows = [(doc, f"document {doc} " * 40) for doc in range(60)]
    path = stored(spark, frame, rows, length=50)
    whole = np.concatenate([[*tokenizer.encode(text, add_special_tokens=False).ids, 1] for _, text in rows])
    held = pa.total_allocated_bytes()
    for row in files.token_files(spark, path).collect():
        opened = files.TokenFile(f"{path}/data/{row['name']}")
        own = whole[row["first_id"] : row["first_id"] + row["n_ids"]]
        for number in reversed(range(row["n_sequences"])):
            ids, mask = opened.sequence(number)
            assert not ids.flags.owndata and len(ids) == len(mask) == 50
            part = own[50 * number : 50 * number + 50]
            assert ids[: len(part)].tolist() == part.tolist()
            assert mask.to_pylist() == [True] * len(part) + [False] * (50 - len(part))
    # sequences are views of the mapped files
    assert pa.total_allocated_bytes() == held


def test_files_of_lost_attempts(spark, frame, tokenizer):
    """Files that no finished task names are not read and do not stay."""
    path = scratch_path(spark, "tokens")
    system, at = files._opened(f"{path}/data")
    system.create_dir(at)
    lost = files._Writer(f"{path}/data/part-000000-lost", np.dtype("<u2"), pa.int64(), 8)
    lost.add(99, b"\1\0" * 20)
    lost.close()
    rows = [(doc, "some words") for doc in range(9)]
    files.write_token_files(frame(rows), path, PATH)
    assert read(spark, path) == expected(tokenizer, rows)
    assert not [f for f in system.get_file_info(pa.fs.FileSelector(at)) if "lost" in f.path]

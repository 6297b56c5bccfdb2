"""Token ids in Arrow files of equal-length sequences, open to random access.

Documents become token ids with an end id, in ascending order of their ids, one after
the other without gaps. Each task writes what it holds as one Arrow IPC file: record
batches of `BATCH` rows with two fixed-size-list columns, the ids of a sequence and a
mask that is false on padding, which only the last sequence of a file has. Lists of
fixed size have no offsets and files are not compressed, so sequence i of a file lies
at a known place, and reading it from a mapped file copies nothing. Ids take two bytes
if the vocabulary allows. A second file beside it holds doc_id, start and n_tokens of
its documents, with fixed widths as well, so documents are found by their place, too.

Texts go through one exchange, sorted by range of their ids; they are encoded after it,
so what is shuffled is the text and what is written is the result. A task's memory is a
batch of sequences. An attempt writes files of its own name, and only those that the
job returns are listed in the table `files`; others are deleted at the end, so a task
may run several times. The driver sees one short row for each file.

Defined results: a null text is empty and has the end id alone; rows without an id come
first; rows of one id follow each other by the hash of their text, equal ones by chance;
no documents give no files; other columns of the input are not read.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import partitions, registered, table
from tidelog.llm.packing import BYTE_NAMES, TOKENIZER, encoded
from tidelog.session import scratch_path
from tidelog.sources import paths

END_ID = 1
SEQUENCE = 1024
#: Sequences of one record batch.
BATCH = 128
#: Pieces whose ids a worker remembers; beyond, it forgets all and starts again.
REMEMBERED = 500_000
#: Documents of one record batch of an index.
INDEX_ROWS = 65_536

#: What makes a text go another way than piece by piece: characters that a normal form
#: may change, apostrophes, which begin pieces of other kinds, and special tokens.
OTHER = re.compile(r"[^\t-\r !-&(-~À-ÖØ-öø-ÿ]|<\|")
PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")

FILES = "part int, name string, first_id long, n_ids long, first_sequence long, n_sequences long, n_docs long"


class _Pieces(dict):
    """Ids of each piece of a text, as bytes, found when they are first asked for."""

    def __init__(self, path: str, code: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model, self.code = Tokenizer.from_file(path).model, code

    def __missing__(self, piece: str) -> bytes:
        named = piece if piece.isascii() else "".join([BYTE_NAMES[b] for b in piece.encode()])
        ids = self[piece] = array(self.code, [token.id for token in self.model.tokenize(named)]).tobytes()
        return ids


@lru_cache(maxsize=2)
def _pieces(path: str, code: str) -> _Pieces:
    return _Pieces(path, code)


@lru_cache(maxsize=2)
def id_type(path: str) -> np.dtype:
    """The type that all ids of a tokenizer fit."""
    from tokenizers import Tokenizer

    return np.dtype("<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4")


def text_ids(text: str | None, path: str, end_id: int) -> bytes:
    """Ids of a text and the end id, little-endian, in the type of `id_type`.

    Texts of plain characters are cut into pieces at once, by the rules of the one
    tokenizer this is made for, and only its model is asked, once for each piece.
    """
    dtype = id_type(path)
    if text and OTHER.search(text):
        (ids,) = encoded([text], path, end_id)
        return ids if dtype.itemsize == 4 else np.frombuffer(ids, "<u4").astype(dtype).tobytes()
    known = _pieces(path, "H" if dtype.itemsize == 2 else "I")
    if len(known) > REMEMBERED:
        known.clear()
    ids = b"".join(map(known.__getitem__, PIECES.findall((text or "").lower())))
    return ids + end_id.to_bytes(dtype.itemsize, "little")


# --- files ----------------------------------------------------------------------


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path there; local files are mapped."""
    scheme, _, rest = path.partition(":")
    if not rest or "/" in scheme:
        return pafs.LocalFileSystem(use_mmap=True), path
    if scheme == "file":
        return pafs.LocalFileSystem(use_mmap=True), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))


class _Writer:
    """One file of sequences and its index."""

    def __init__(self, path: str, dtype: np.dtype, doc_type: pa.DataType, length: int):
        files, at = _opened(path)
        self.dtype, self.length = dtype, length
        lists = pa.list_(pa.from_numpy_dtype(dtype), length)
        self.schema = pa.schema([("ids", lists), ("mask", pa.list_(pa.bool_(), length))])
        self.index_schema = pa.schema([("doc_id", doc_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.sinks = [files.open_output_stream(f"{at}{end}") for end in (".arrow", ".docs.arrow")]
        self.sequences = pa.ipc.new_file(self.sinks[0], self.schema)
        self.index = pa.ipc.new_file(self.sinks[1], self.index_schema)
        self.held, self.docs = bytearray(), []
        self.n_ids = self.n_docs = self.n_sequences = 0

    def add(self, doc, ids: bytes) -> None:
        size = len(ids) // self.dtype.itemsize
        self.docs.append((doc, self.n_ids, size))
        self.n_ids += size
        self.held += ids
        step = BATCH * self.length * self.dtype.itemsize
        full = len(self.held) // step * step
        for at in range(0, full, step):
            self._write(bytes(self.held[at : at + step]))
        del self.held[:full]
        if len(self.docs) == INDEX_ROWS:
            self._write_index()

    def _write(self, data: bytes) -> None:
        ids = np.frombuffer(data, self.dtype)
        rows = -(-len(ids) // self.length)
        mask = np.ones(rows * self.length, bool)
        mask[len(ids) :] = False
        ids = np.concatenate([ids, np.zeros(len(mask) - len(ids), self.dtype)])
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(flat), self.length) for flat in (ids, mask)]
        self.sequences.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.n_sequences += rows

    def _write_index(self) -> None:
        columns = [pa.array(values, field.type) for values, field in zip(zip(*self.docs), self.index_schema)]
        self.index.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.index_schema))
        self.n_docs += len(self.docs)
        self.docs = []

    def close(self) -> None:
        if self.held:
            self._write(bytes(self.held))
        if self.docs:
            self._write_index()
        for each in (self.sequences, self.index, *self.sinks):
            each.close()


class TokenFile:
    """One file of sequences, opened for reading; from a mapped file, without copies."""

    def __init__(self, path: str):
        files, at = _opened(path)
        self.sequences = pa.ipc.open_file(files.open_input_file(f"{at}.arrow"))
        self.index = pa.ipc.open_file(files.open_input_file(f"{at}.docs.arrow"))
        self.length = self.sequences.schema.field("ids").type.list_size

    def batch(self, number: int) -> np.ndarray:
        """Ids of a record batch, one sequence after the other."""
        return self.sequences.get_batch(number).column(0).values.to_numpy()

    def sequence(self, number: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of one sequence."""
        found = self.sequences.get_batch(number // BATCH)
        ids, mask = (found.column(i).values.slice(number % BATCH * self.length, self.length) for i in (0, 1))
        return ids.to_numpy(), mask

    def documents(self) -> Iterator[tuple]:
        """(doc_id, start, n_tokens) of the file's documents; starts count from its own first id."""
        for number in range(self.index.num_record_batches):
            columns = self.index.get_batch(number).to_pydict()
            yield from zip(columns["doc_id"], columns["start"], columns["n_tokens"])

    def ids(self, start: int, size: int) -> Iterator[np.ndarray]:
        """Ids from a place in the file on, as views of the batches they lie in."""
        step = BATCH * self.length
        while size:
            at = start % step
            view = self.batch(start // step)[at : at + size]
            yield view
            start, size = start + len(view), size - len(view)


# --- jobs -----------------------------------------------------------------------


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, length: int = SEQUENCE) -> DataFrame:
    """Write all documents below `path`; returns the list of files, in order."""
    spark = docs.sparkSession
    data = f"{path}/data"
    files, at = _opened(data)
    files.create_dir(at)

    def write(batches):
        writer = name = None
        part = TaskContext.get().partitionId()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            if writer is None and len(ids):
                name = f"part-{part:06d}-{uuid.uuid4().hex}"
                writer = _Writer(f"{data}/{name}", id_type(tokenizer_path), ids.type, length)
            for doc, text in zip(ids.to_pylist(), texts):
                writer.add(doc, text_ids(text.as_py(), tokenizer_path, end_id))
        if writer:
            writer.close()
            row = {"part": part, "name": name, "n_ids": writer.n_ids, "n_sequences": writer.n_sequences, "n_docs": writer.n_docs}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("name", pa.string()), *((x, pa.int64()) for x in ("n_ids", "n_sequences", "n_docs"))]))

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    ordered = rows.repartitionByRange(partitions(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h")
    done = ordered.select("doc_id", "text").mapInArrow(write, "part int, name string, n_ids long, n_sequences long, n_docs long")
    listed, ids, sequences = [], 0, 0
    for row in sorted(done.collect(), key=lambda row: row["part"]):
        listed.append((row["part"], row["name"], ids, row["n_ids"], sequences, row["n_sequences"], row["n_docs"]))
        ids, sequences = ids + row["n_ids"], sequences + row["n_sequences"]
    spark.createDataFrame(listed, FILES).coalesce(1).write.parquet(f"{path}/files")
    names = {row[1] for row in listed}
    for name in paths.child_names(spark, data):
        if name.split(".")[0] not in names:
            paths.delete(spark, f"{data}/{name}")
    return token_files(spark, path)


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files below `path`, with the first id and the first sequence of each."""
    return spark.read.schema(FILES).parquet(f"{path}/files")


def read_documents(spark: SparkSession, path: str, doc_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""
    data = f"{path}/data"

    def read(batches):
        schema = pa.schema([*((name, pa.int64()) for name in ("start", "n_tokens", "ids_crc32"))])
        for batch in batches:
            for row in batch.to_pylist():
                opened = TokenFile(f"{data}/{row['name']}")
                for number in range(opened.index.num_record_batches):
                    index = opened.index.get_batch(number)
                    starts, sizes = index.column(1).to_numpy(), index.column(2).to_numpy()
                    sums = []
                    for start, size in zip(starts.tolist(), sizes.tolist()):
                        crc = 0
                        for view in opened.ids(start, size):
                            crc = zlib.crc32(view.astype("<u4", copy=False).data, crc)
                        sums.append(crc)
                    columns = [pa.array(starts + row["first_id"]), index.column(2), pa.array(sums, pa.int64())]
                    yield pa.RecordBatch.from_arrays(
                        [index.column(0), *columns], schema=pa.schema([index.schema.field(0), *schema])
                    )

    files = token_files(spark, path).select("part", "name", "first_id")
    # a file is one task's work
    spread = files.repartition(max(1, files.count()))
    return spread.mapInArrow(read, f"doc_id {doc_type}, start long, n_tokens long, ids_crc32 long")


@registered("op12_token_files")
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return read_documents(spark, path)

"""Packing: shortest-pack-first over the histogram of lengths.

Documents become token ids with an end id; one longer than a sequence is cut at
multiples of its length. Only the histogram of piece lengths, at most `max_len`
numbers whatever the corpus holds, goes to the driver. There, lengths are placed
longest first into the emptiest kind of pack, where counts of packing patterns
are updated and no single piece is looked at. The plan says for each length which
ranks of its pieces go to which run of sequences at which offset. Pieces are
numbered within their length and meet the plan by rank.

A length may be as frequent as a third of all pieces, so pieces are numbered in
parts of a length: counted, the counts summed up in order, and numbered within
the part. The plan has at most three new patterns for each length, so its size is
bounded and it may go to every task.

Defined results: a null text is empty and has the end id alone; equal lengths are
placed by id, equal rows by chance; no documents give no pieces; other columns of
the input are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import partitions, registered, table, written

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
MAX_LEN = 4096
#: Pieces numbered in one part of a length, on average.
PART_ROWS = 100_000
#: Words whose ids a worker remembers; beyond, it forgets all and starts again.
REMEMBERED = 400_000

#: Texts with these go through the tokenizer whole: separators that only Python
#: takes for white space, and what may begin a special token.
UNUSUAL = re.compile(r"[\x1c-\x1f]|<\|")
#: Words of these characters alone, which no normal form changes, need the tokenizer's
#: model only: letters, single digits and runs of signs are its pieces. The apostrophe
#: is left out, as it begins pieces of other kinds.
PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+")
PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")


def _byte_names() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves, the others for code points from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in shown}
    return names | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in names)}


BYTE_NAMES = _byte_names()


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The tokenizer and what is remembered of words and of their pieces."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), {}, {}


def _packed(ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _plain_word(word: str, model, known: dict) -> bytes:
    found = []
    for piece in PIECES.findall(word.lower()):
        ids = known.get(piece)
        if ids is None:
            named = piece if piece.isascii() else "".join(BYTE_NAMES[b] for b in piece.encode())
            ids = known[piece] = _packed([token.id for token in model.tokenize(named)])
        found.append(ids)
    return b"".join(found)


def encoded(texts, path: str, end_id: int):
    """Little-endian ids of each text, the end id last.

    No token of this vocabulary spans white space, so words are encoded once and
    remembered.
    """
    tokenizer, words_known, pieces_known = _tokenizer(path)
    model, end = tokenizer.model, _packed([end_id])
    for text in texts:
        if UNUSUAL.search(text):
            yield _packed(tokenizer.encode(text, add_special_tokens=False).ids) + end
            continue
        words = text.split()
        if len(words_known) > REMEMBERED or len(pieces_known) > REMEMBERED:
            words_known.clear()
            pieces_known.clear()
        for word in words:
            if word not in words_known:
                words_known[word] = (
                    _plain_word(word, model, pieces_known)
                    if PLAIN.fullmatch(word)
                    else _packed(tokenizer.encode(word, add_special_tokens=False).ids)
                )
        yield b"".join(map(words_known.__getitem__, words)) + end


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = END_ID,
    max_len: int = MAX_LEN,
    with_ids: bool = True,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and, if asked for, ids of each piece."""

    def cut(batches):
        for batch in batches:
            rows = []
            for doc, data in zip(batch["doc_id"], encoded(batch["text"].fillna("").tolist(), tokenizer_path, end_id)):
                total = len(data) // 4
                for start in range(0, total, max_len):
                    piece = data[4 * start : 4 * (start + max_len)]
                    row = (doc, start, len(piece) // 4, zlib.crc32(piece), total)
                    rows.append((*row, np.frombuffer(piece, dtype="<u4").astype("int32")) if with_ids else row)
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": batch["doc_id"].dtype})

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long"
    schema += ", ids array<int>" if with_ids else ""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    return docs.select("doc_id", "text").mapInPandas(cut, schema)


def shortest_pack_first(histogram: dict[int, int], max_len: int):
    """(lengths from long to short, count) of each packing pattern.

    All packs of one pattern are handled as one: a step fills as many packs of the
    emptiest pattern with room as there are pieces of the length.
    """
    # packs with room, by their fill; each entry is a pattern with its count
    open_packs: dict[int, list[tuple[tuple, int]]] = defaultdict(list)
    full = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        added: dict[int, list] = defaultdict(list)
        while left:
            fill = min(open_packs, default=max_len + 1)
            if fill + length > max_len:
                break
            pattern, count = open_packs[fill].pop()
            taken = min(count, left)
            left -= taken
            if taken < count:
                open_packs[fill].append((pattern, count - taken))
            elif not open_packs[fill]:
                del open_packs[fill]
            place = added if fill + 2 * length > max_len else open_packs
            place[fill + length].append(((*pattern, length), taken))
        # no open pack has room: each new pack is the emptiest until the length no longer fits it
        most = max_len // length
        for each, count in ((most, left // most), (left % most, 1)):
            if each and count:
                added[each * length].append(((length,) * each, count))
        for fill, packs in added.items():
            if fill == max_len:
                full += packs
            else:
                open_packs[fill] += packs
    return full + [x for packs in open_packs.values() for x in packs]


def plan_slots(patterns):
    """Arrays of the plan by (length, first rank): first rank, first sequence, offset."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def numbered(rows: DataFrame, total: int) -> DataFrame:
    """`rows` with `rank` from 0 within their length."""
    parts = max(partitions(rows.sparkSession), total // PART_ROWS)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "start"), F.lit(parts)))
    before = (
        rows.groupBy("length", "part")
        .count()
        .withColumn(
            "before",
            F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count"),
        )
        .drop("count")
    )
    own = Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")
    return (
        rows.withColumn("own", F.row_number().over(own) - 1)
        .join(before, ["length", "part"])
        .withColumn("rank", F.col("own") + F.col("before"))
        .drop("own", "before", "part")
    )


def placed(rows: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """`rows` of `pieces` with the sequence and the offset of each."""
    spark = rows.sparkSession
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    slots = plan_slots(shortest_pack_first(histogram, max_len))
    plan = spark.sparkContext.broadcast(slots)
    ranked = numbered(rows, sum(histogram.values()))
    names = [c for c in ranked.columns if c != "rank"]
    schema = ranked.select(*names).withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema

    def place(batches):
        table = plan.value
        key = table[:, 0] << 46 | table[:, 1] if len(table) else table[:, 0]
        for batch in batches:
            rank = batch["rank"].to_numpy()
            at = np.searchsorted(key, batch["length"].to_numpy() << 46 | rank, side="right") - 1
            yield batch[names].assign(sequence_id=table[at, 2] + rank - table[at, 1], offset=table[at, 3])

    return ranked.mapInPandas(place, schema)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, max_len: int = MAX_LEN, with_ids: bool = True) -> DataFrame:
    """The pieces of all documents, with their ids if asked for, placed in sequences."""
    return placed(written(pieces(docs, tokenizer_path, end_id, max_len, with_ids), "pieces"), max_len)


def packed_documents(docs: DataFrame) -> DataFrame:
    return pack(docs, public_tokenizers.path(TOKENIZER), with_ids=False)


@registered("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))

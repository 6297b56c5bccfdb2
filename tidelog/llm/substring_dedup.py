"""Suffix-array dedup: repeated byte strings through sampled, externally sorted suffixes.

Every byte that a 100-byte string covers which also starts earlier goes. Induced
sorting orders a sample of the suffixes, found at local minima, and derives the rest
from it. The same is done here with Spark's exchanges and sorts, which spill to disk,
in place of one machine's priority queues:

1. Sample: the suffixes at the least hashed 32-byte string of each 100-byte window.
   Equal windows have their least string at the same offset, so each repetition meets
   in the sample; about one position in 35 is taken.
2. Sort: sampled suffixes are sorted by the hash of their first 32 bytes and of all
   that windows around them reach, then by place. Later copies of the same
   surroundings are wholly covered. Only the first of each kind goes on, and only
   where several kinds share a sampled string.
3. Induce: from the surroundings of these the order of the 69 windows that begin up to
   68 bytes before is derived, one byte further left at a time, and each window is
   compared with the first equal one.

Copies are thinned out in each task before any exchange. A sampled string with more
than `BLOCK` kinds of surroundings is not handled in one task: its windows are
aggregated by hash. Texts are joined with what is asked of them, and taken through an
exchange only if that is too much to be broadcast. Hashes are 64 bits wide.

Defined results: a null text is empty; texts under 100 bytes lose nothing; a null
doc_id counts as the smallest; rows with one doc_id are one document, in which equal
places are not earlier than each other; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import joined, registered, table, written

LENGTH = 100
GRAM = 32
OFFSETS = LENGTH - GRAM + 1
REACH = OFFSETS - 1
#: Kinds of surroundings of one sampled string that one task takes: 3 MB of them.
BLOCK = 16_384
#: Rows that are compared at once, beyond which a string is not begun.
ROWS = 4096
#: Tasks that share the windows of a string with more.
SPREAD = 16
#: Bytes hashed in one go, and around a piece of a long text.
PIECE = 1 << 19
MARGIN = 256
PLACE_BITS = 21

NO_ID = -(1 << 63)
U = np.uint64

_tables: dict = {}


def _constants():
    """Random byte values, powers of an odd base and of its inverse."""
    if not _tables:
        base = U(0x9E3779B97F4A7C15 | 1)
        inverse = U(pow(int(base), -1, 1 << 64))
        n = 1 << PLACE_BITS
        for name, value in (("up", base), ("down", inverse)):
            powers = np.full(n, value, U)
            powers[0] = 1
            _tables[name] = np.multiply.accumulate(powers)
        _tables["bytes"] = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(U)
    return _tables["bytes"], _tables["up"], _tables["down"]


def _mixed(x):
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def _pieces(docs, texts):
    """(doc, bytes of its text, where the piece begins, first and last window start, piece)."""
    for doc, text in zip(docs, texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        windows = len(data) - LENGTH + 1
        for low in range(0, windows, PIECE):
            high = min(low + PIECE, windows)
            begin = max(0, low - MARGIN)
            yield doc, len(data), begin, low, high, data[begin : high + LENGTH + MARGIN]


def _sampled(pieces):
    """Sampled suffixes of pieces: hash, hash of the surroundings, doc, place and offsets."""
    values, up, down = _constants()
    data = np.frombuffer(b"".join(p[5] for p in pieces), np.uint8)
    sizes = np.array([len(p[5]) for p in pieces])
    bases = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    docs, total, begin, low, high = (np.array([p[i] for p in pieces], np.int64) for i in range(5))
    n = len(data)
    sums = np.concatenate([np.zeros(1, U), np.cumsum(values[data] * down[:n], dtype=U)])
    grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * up[: n - GRAM + 1])
    mask = U((1 << PLACE_BITS) - 1)
    least = (grams & ~mask) | np.arange(len(grams), dtype=U)
    width = 1
    while 2 * width <= OFFSETS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if OFFSETS > width:
        least = np.minimum(least[: -(OFFSETS - width)], least[OFFSETS - width :])
    # windows that do not cross from one piece into the next
    inside = np.zeros(len(least) + 1, np.int32)
    np.add.at(inside, bases + low - begin, 1)
    np.add.at(inside, bases + high - begin, -1)
    chosen = (least[np.cumsum(inside[:-1]) > 0] & mask).astype(np.int64)
    at = chosen[np.append(True, chosen[1:] != chosen[:-1])]
    piece = np.searchsorted(bases, at, side="right") - 1
    place = at - bases[piece] + begin[piece]
    left = np.minimum(place, REACH)
    right = np.minimum(total[piece] - place, LENGTH)
    around = (sums[at + right] - sums[at - left]) * up[at - left]
    around = _mixed(around + (left * 128 + right).astype(U) * U(0xC2B2AE3D27D4EB4F))
    packed = place << 16 | np.maximum(0, LENGTH - right) << 8 | left
    return grams[at].view(np.int64), around.view(np.int64), docs[piece], packed


SAMPLE = "s long, c long, doc_id long, packed long, done boolean"


def _batch(columns, names):
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def sample(docs: DataFrame) -> DataFrame:
    """Sampled suffixes; `done` marks later copies of surroundings seen in the same batch."""

    def sampled(batches):
        for batch in batches:
            found, group, size = [], [], 0
            texts = batch.column("text").to_pylist()
            for piece in _pieces(batch.column("doc_id").to_pylist(), texts):
                if group and size + len(piece[5]) > PIECE:
                    found.append(_sampled(group))
                    group, size = [], 0
                group.append(piece)
                size += len(piece[5])
            if group:
                found.append(_sampled(group))
            if not found:
                continue
            s, c, doc, packed = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((packed, doc, c, s))
            s, c, doc, packed = s[order], c[order], doc[order], packed[order]
            # equal places of one document are not copies of each other
            start = np.append(True, (s[1:] != s[:-1]) | (c[1:] != c[:-1]))
            start = np.maximum.accumulate(np.where(start, np.arange(len(s)), 0))
            done = (doc != doc[start]) | (packed != packed[start])
            s = np.where(done, _mixed((doc ^ packed).view(U)).view(np.int64), s)
            yield _batch((s, c, doc, packed, done), ["s", "c", "doc_id", "packed", "done"])

    return docs.mapInArrow(sampled, SAMPLE)


CLASSED = "s long, doc_id long, packed long, done boolean"


def _classed(batches):
    """Later copies (done), and first ones where kinds of surroundings share a string.

    Rows are sorted by (s, c, doc_id, packed). The first of the last kind is held back
    while no other kind of its string was seen.
    """
    last = held = None  # last: (s, c, doc, packed of the first, whether several kinds were seen)
    names = ["s", "doc_id", "packed", "done"]
    for batch in batches:
        s, c, doc, packed, done = (
            batch.column(x).to_numpy(zero_copy_only=False) for x in ("s", "c", "doc_id", "packed", "done")
        )
        if done.any():
            yield _batch((s[done], doc[done], packed[done], done[done]), names)
            s, c, doc, packed = s[~done], c[~done], doc[~done], packed[~done]
        if not len(s):
            continue
        new_kind = np.append(True, (s[1:] != s[:-1]) | (c[1:] != c[:-1]))
        new_string = np.append(True, s[1:] != s[:-1])
        goes_on = last is not None and last[0] == s[0]
        if goes_on:
            new_string[0] = False
            new_kind[0] = last[1] != c[0]
        # rows equal to the first of their kind in id and place are the same document
        start = np.maximum.accumulate(np.where(new_kind, np.arange(len(s)), -1))
        first_doc = np.where(start >= 0, doc[start], last[2] if goes_on else 0)
        first_packed = np.where(start >= 0, packed[start], last[3] if goes_on else 0)
        later = ~new_kind & ((doc != first_doc) | (packed != first_packed))
        yield _batch((s[later], doc[later], packed[later], later[later]), names)
        string = np.cumsum(new_string)
        kinds = np.bincount(string, weights=new_kind, minlength=string[-1] + 1).astype(int)
        if goes_on:
            if held is not None and kinds[0]:
                yield _batch(held, names)
                held = None
            kinds[0] += 2 if last[4] else 1
        several = kinds[string] > 1
        firsts = new_kind & several
        yield _batch((s[firsts], doc[firsts], packed[firsts], np.zeros(firsts.sum(), bool)), names)
        if not (goes_on and string[-1] == 0):
            held = None
            if kinds[string[-1]] == 1:
                i = np.flatnonzero(new_kind)[-1]
                held = (s[i : i + 1], doc[i : i + 1], packed[i : i + 1], np.zeros(1, bool))
        last = (s[-1], c[-1], first_doc[-1], first_packed[-1], kinds[string[-1]] > 1)


def _surroundings(batches):
    """(s, hot, doc_id, place, left, around) for what is asked of each text."""
    names = ["s", "hot", "doc_id", "place", "left", "around"]
    for batch in batches:
        rows = []
        for doc, text, asked in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "text", "asked"))):
            data = (text or "").encode("utf-8", "surrogatepass")
            for item in asked.split(","):
                place, s, hot = item.split(":")
                place = int(place)
                if place < len(data):
                    left = min(place, REACH)
                    rows.append((int(s), hot == "1", doc, place, left, data[place - left : place + LENGTH]))
        if rows:
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)


def _windows(frame: pd.DataFrame):
    """Hashes of the windows by offset, and which offsets have one."""
    values, up, down = _constants()
    left = frame["left"].to_numpy()
    size = frame["around"].str.len().to_numpy()
    padded = b"".join((b"\0" * (REACH - a) + x).ljust(REACH + LENGTH, b"\0") for a, x in zip(left, frame["around"]))
    grid = np.frombuffer(padded, np.uint8).reshape(-1, REACH + LENGTH)
    sums = np.zeros((len(grid), REACH + LENGTH + 1), U)
    np.cumsum(values[grid] * down[: REACH + LENGTH], axis=1, dtype=U, out=sums[:, 1:])
    offsets = np.arange(OFFSETS)
    hashes = _mixed((sums[:, REACH + LENGTH - offsets] - sums[:, REACH - offsets]) * up[REACH - offsets])
    there = (offsets <= left[:, None]) & (LENGTH - offsets <= (size - left)[:, None])
    return hashes, there


SPANS = "doc_id long, low long, high long"


def _induced(frames):
    """Spans covered by earlier windows, for rows sorted by (s, doc_id, place)."""

    def spans(frame):
        frame = frame[~frame.duplicated(["s", "doc_id", "place"])]
        hashes, there = _windows(frame)
        string = frame["s"].to_numpy().view(U)
        low, high = np.full(len(frame), -1), np.full(len(frame), -1)
        for offset in range(OFFSETS):
            rows = np.flatnonzero(there[:, offset])
            key = _mixed(hashes[rows, offset] ^ string[rows])
            order = np.argsort(key, kind="stable")
            again = np.append(False, key[order][1:] == key[order][:-1])[: len(rows)]
            covered = rows[order[again]]
            high[covered] = np.where(high[covered] < 0, offset, high[covered])
            low[covered] = offset
        found = low >= 0
        doc, place = frame["doc_id"].to_numpy()[found], frame["place"].to_numpy()[found]
        return pd.DataFrame({"doc_id": doc, "low": place - low[found], "high": place - high[found] + LENGTH})

    rest = None
    for frame in frames:
        if rest is not None and len(rest):
            frame = pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        string = frame["s"].to_numpy()
        cuts = np.flatnonzero(string[1:] != string[:-1]) + 1
        end = cuts[-1] if len(cuts) else 0
        rest = frame.iloc[end:]
        # whole strings, some thousand rows at a time
        begin = 0
        while begin < end:
            far = cuts[np.searchsorted(cuts, min(begin + ROWS, end), side="left")]
            yield spans(frame.iloc[begin:far])
            begin = far
    if rest is not None and len(rest):
        yield spans(rest)


WINDOWS = "w long, doc_id long, place long, start long, last long"


def _exploded(frames):
    """Windows of rows: hash, doc_id, place and where the window starts.

    Of equal windows among some thousand rows only the first goes on; the others are
    covered, and for each row the span of these comes without a hash, from `start` to
    the start of the last one.
    """
    for frame in frames:
        frame = frame.sort_values(["doc_id", "place"], kind="stable").drop_duplicates(["s", "doc_id", "place"])
        hashes, there = _windows(frame)
        key = _mixed(hashes ^ frame["s"].to_numpy().view(U)[:, None])
        row, offset = np.nonzero(there)
        key, doc, place = key[row, offset].view(np.int64), frame["doc_id"].to_numpy()[row], frame["place"].to_numpy()[row]
        start = place - offset
        order = np.lexsort((start, doc, key))
        again = np.append(False, key[order][1:] == key[order][:-1])[: len(order)]
        # equal windows with the same start are one and the same
        again &= np.append(False, (start[order][1:] != start[order][:-1]) | (doc[order][1:] != doc[order][:-1]))[: len(order)]
        first, later = order[~again], order[again]
        yield pd.DataFrame({"w": key[first], "doc_id": doc[first], "place": place[first], "start": start[first], "last": start[first]})
        if len(later):
            covered = pd.DataFrame({"doc_id": doc[later], "place": place[later], "start": start[later]})
            covered = covered.groupby(["doc_id", "place"], sort=False)["start"].agg(["min", "max"]).reset_index()
            covered.columns = ["doc_id", "place", "start", "last"]
            covered.insert(0, "w", pd.array([None] * len(covered), "Int64"))
            yield covered


def _covered_by_aggregate(around: DataFrame) -> DataFrame:
    """Spans of strings with many kinds of surroundings."""
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD))
    windows = written(
        around.repartition(F.col("s"), spread).mapInPandas(_exploded, WINDOWS), "windows"
    )
    earlier = Window.partitionBy("w").orderBy("doc_id", "start")
    later = windows.where("w IS NOT NULL").withColumn("place_of", F.rank().over(earlier)).where("place_of > 1")
    return (
        later.drop("place_of")
        .unionByName(windows.where("w IS NULL"))
        .groupBy("doc_id", "place")
        .agg(F.min("start").alias("low"), (F.max("last") + LENGTH).alias("high"))
        .select("doc_id", "low", "high")
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, low, high) byte spans that earlier strings cover; they may overlap."""
    classed = written(
        sample(docs)
        .repartition("s")
        .sortWithinPartitions("s", "c", "doc_id", "packed")
        .mapInArrow(_classed, CLASSED),
        "suffixes",
    )
    done = classed.where("done").selectExpr(
        "doc_id",
        "shiftright(packed, 16) - (packed & 255) AS low",
        f"shiftright(packed, 16) - (shiftright(packed, 8) & 255) + {LENGTH} AS high",
    )
    firsts = classed.where("NOT done").selectExpr("s", "doc_id", "shiftright(packed, 16) AS place")
    many = firsts.groupBy("s").agg(F.count("*").alias("n")).where(f"n > {BLOCK}")
    marked = joined(firsts, many, "s", "left", measured=False)
    asked = marked.groupBy("doc_id").agg(
        F.expr("array_join(collect_list(concat(place, ':', s, ':', IF(n IS NULL, 0, 1))), ',') AS asked")
    )
    around = written(
        joined(docs, asked, "doc_id", measured=False).mapInArrow(
            _surroundings, "s long, hot boolean, doc_id long, place long, left long, around binary"
        ),
        "surroundings",
    )
    induced = (
        around.where("NOT hot")
        .repartition("s")
        .sortWithinPartitions("s", "doc_id", "place")
        .mapInPandas(_induced, SPANS)
    )
    return done.unionByName(induced).unionByName(_covered_by_aggregate(around.where("hot")))


def _merged(spans):
    """Maximal runs of spans."""
    runs = []
    for low, high in sorted(spans):
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], high)
        else:
            runs.append([low, high])
    return runs


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, the bytes kept, and the digest columns of every document."""
    docs = docs.selectExpr(f"coalesce(CAST(doc_id AS BIGINT), {NO_ID}) AS doc_id", "text")
    spans = repeated_spans(docs).groupBy("doc_id", "low").agg(F.max("high").alias("high"))
    runs = (
        written(spans, "spans")
        .groupBy("doc_id")
        .agg(F.expr("array_join(collect_list(concat(low, ':', high)), ',') AS spans"))
    )

    def cut(frames):
        for frame in frames:
            rows = []
            for doc, text, spans in zip(frame["doc_id"], frame["text"], frame["spans"]):
                data = (text or "").encode("utf-8", "surrogatepass")
                runs = _merged(tuple(map(int, x.split(":"))) for x in spans.split(",")) if spans else []
                kept, at = [], 0
                for low, high in runs:
                    kept.append(data[at:low])
                    at = high
                kept = b"".join([*kept, data[at:]])
                rows.append((None if doc == NO_ID else doc, len(data), len(data) - len(kept), len(runs), kept))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]).astype({"doc_id": "Int64"})

    return joined(docs, runs, "doc_id", "left", measured=False).mapInPandas(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


@registered("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )

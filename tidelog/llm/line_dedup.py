"""Line dedup: fuzzy lines by MinHash, verified, one line kept per component.

A line's shingles are all its runs of eight characters, white space, case and
punctuation included; a shorter line is its only shingle. Equal lines are one class
from the start. Each class gets 60 minima of its hashed shingles under as many orders;
five minima make a band, so of two lines at a similarity of 0.8 all but 0.9 % meet in
one of twelve bands, and at 0.3 only 3 % do. Classes that share a band are compared by
the exact Jaccard similarity of their shingle sets; links make components, and of each
component the line that comes first stays.

The rows of the bands are dealt by band and sorted; a stream over them names for each
band of several classes its first one as leader. Members are compared with their
leader. Then bands whose members are all in one component are done. In the others, round
by round, a few members of the largest component are drawn, and every class outside it
is compared with the nearest of these, so that copies by the thousand take comparisons
in proportion to their number. What is still apart after that is compared pair by pair,
but for two members of the largest component: of each two components the nearest pair,
and the other pairs only where components are still apart.

Two bounds come before a comparison. Shingles are dealt into 1,024 bits, and of two lines
the bits that hold an odd number for one only are at most the shingles that one only
has; so pairs that can't be similar enough are told without a loss. Lines that differ in
more than 23 of all 60 minima go no further either: the minima are at hand in a byte
each, and so few pairs that are similar enough differ in as many that bands remain what
decides the recall.

Signatures and sets are made by numpy and Python within tasks: as functions of Spark
they took 3,900 CPU seconds a GB, where the limit is 400 (see the README). Equal lines
are told by MD5, sets are compared by the shingles themselves.

Defined results: blank lines have no shingles and always stay; a null text has no
lines; a missing id comes before all others; rows of one id with different texts are
different documents, the one with the smaller MD5 of its text first; rows equal in id
and text are one document given several times and come out alike; a document keeps
its row even if no line stays, with an empty text.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import HANDED_OVER, discard, joined, registered, release, table, written
from tidelog.llm.components import components, with_component

SHINGLE = 8
BANDS, PER_BAND = 12, 5
MIN_PERCENT = 80
#: What a line is known by, in the order in which lines come first.
PLACE = ["doc_id", "text_md5", "line_no"]
#: Characters whose lines are signed at once.
CHUNK = 1 << 18
#: Words of eight bytes that hold a byte of each minimum.
SKETCH_WORDS = -(-BANDS * PER_BAND // 8)
#: Two lines that differ in more minima are not compared. At a similarity of 0.8 twelve of
#: the 60 differ on average, and more than 23 in one of 3,000 pairs; at 0.5 in 95 of 100.
MOST_APART = 23
#: Members of a band's largest component that the others are held against in a round.
DRAWN = 16
#: Words of eight bytes that hold a parity in each bit.
PARITY_WORDS = 16
#: A round that finds less than this share of the links of the best one is the last.
LAST_ROUND = 0.25
#: Fills short lines up to one shingle; no character of a text.
FILL = "\U0010ffff"

_random = np.random.default_rng(10)
#: Orders: odd factors and shifts of 32-bit hashes.
FACTORS = _random.integers(0, 1 << 32, BANDS * PER_BAND, dtype=np.uint32) | np.uint32(1)
SHIFTS = _random.integers(0, 1 << 32, BANDS * PER_BAND, dtype=np.uint32)
#: Odd factors of the 64-bit hashes of shingles and bands.
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_md5, line_no and the class `k` for lines that are not blank."""
    # the digest of a text is taken before its lines come apart, not once for each of them
    digests = docs.select("doc_id", "text", _text_md5())
    return (
        digests.select("doc_id", "text_md5", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .where("line RLIKE '\\\\S'")
        .select(*PLACE, F.unhex(F.md5(F.col("line").cast("binary"))).alias("k"))
    )


def _text_md5() -> Column:
    """What tells rows of one id apart."""
    return F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_md5")


def _hashed(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all lines, and where those of each line start."""
    lines = [line if len(line) >= SHINGLE else line.ljust(SHINGLE, FILL) for line in lines]
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(line) for line in lines])
    hashes = np.zeros(len(codes) - SHINGLE + 1, np.uint64)
    for i in range(SHINGLE):
        hashes = hashes * BASE + codes[i : i + len(hashes)]
    inside = np.ones(len(codes), bool)
    inside[(ends[:, None] - np.arange(1, SHINGLE)).ravel()] = False
    hashes = hashes[inside[: len(hashes)]]
    hashes = (hashes ^ hashes >> np.uint64(32)) * MIX
    return hashes, np.concatenate([[0], ends[:-1]]) - (SHINGLE - 1) * np.arange(len(lines))


def signatures(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each line in rows: its bands as 64-bit hashes, and a byte of each minimum, in words."""
    hashes, starts = _hashed(lines)
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    found = np.empty((len(lines), BANDS), np.uint64)
    low = np.zeros((len(lines), 8 * SKETCH_WORDS), np.uint8)
    for band in range(BANDS):
        value = np.full(len(lines), band + 1, np.uint64)
        for order in range(band * PER_BAND, (band + 1) * PER_BAND):
            least = np.minimum.reduceat(small * FACTORS[order] + SHIFTS[order], starts)
            low[:, order] = least & np.uint32(255)
            value = (value ^ least) * MIX
            value ^= value >> np.uint64(29)
        found[:, band] = value
    return found.view(np.int64), low.view(np.int64)


def _portions(batch, column: int = 0):
    """Pieces of a batch whose lines have about `CHUNK` characters, each with its lines."""
    first, held = 0, 0
    lines = batch.column(column).to_pylist()
    for i, line in enumerate(lines):
        held += max(SHINGLE, len(line))
        if held >= CHUNK or i + 1 == len(lines):
            yield batch.slice(first, i + 1 - first), lines[first : i + 1]
            first, held = i + 1, 0


def _signed(batches):
    """k, line, bands and sketch of each line."""
    for batch in batches:
        for _, lines in _portions(batch):
            bands, sketches = signatures(lines)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([hashlib.md5(line.encode()).digest() for line in lines], pa.binary()),
                    pa.array(lines, pa.string()),
                    pa.array(list(bands), pa.list_(pa.int64())),
                    pa.array(list(sketches), pa.list_(pa.int64())),
                ],
                names=["k", "line", "bands", "sketch"],
            )


def parities(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each line its number of different shingles, and whether an odd number of them falls in each bit."""
    hashes, starts = _hashed(lines)
    row = np.repeat(np.arange(len(lines)), np.diff(np.append(starts, len(hashes))))
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.append(True, (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]))
    row, hashes = row[new], hashes[new]
    bits = 64 * PARITY_WORDS
    place = row * bits + (hashes % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(place, minlength=bits * len(lines)) & 1).astype(np.uint8)
    return np.bincount(row, minlength=len(lines)), np.packbits(odd).view(np.int64).reshape(-1, PARITY_WORDS)


def _with_parities(batches):
    """c, k, line, the words of the sketch, n and the words of the parities."""
    for batch in batches:
        for part, lines in _portions(batch, 2):
            n, odd = parities(lines)
            sketch = np.array(part.column(3).to_pylist(), np.int64)
            words = [pa.array(np.ascontiguousarray(x)) for x in (*sketch.T, n, *odd.T)]
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(3)), *words], names=MET)


#: Columns of the classes that meet others.
MET = ["c", "k", "line", *(f"s{i}" for i in range(SKETCH_WORDS)), "n", *(f"o{i}" for i in range(PARITY_WORDS))]
#: What tells of two of them whether they may be similar enough.
BOUNDS = MET[3:]


def _classes(docs: DataFrame) -> DataFrame:
    """One row per class of equal lines: its number c, k, line, bands and sketch."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).where("line RLIKE '\\\\S'").distinct()
    signed = lines.mapInArrow(_signed, "k binary, line string, bands array<bigint>, sketch array<bigint>")
    return signed.withColumn("c", F.monotonically_increasing_id())


def _led(batches):
    """(band, leader, c, n) for the members of bands with several classes, of rows sorted by band and c."""
    schema = pa.schema([(name, pa.int64()) for name in ("band", "leader", "c")])
    last_band = last_leader = None
    for batch in batches:
        bands, members = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(bands):
            continue
        first = np.concatenate([[True], bands[1:] != bands[:-1]])
        leaders = members[np.flatnonzero(first)][np.cumsum(first) - 1]
        if last_band is not None and bands[0] == last_band:
            own = np.flatnonzero(first)[1] if first.sum() > 1 else len(bands)
            leaders[:own] = last_leader
        last_band, last_leader = bands[-1], leaders[-1]
        follows = members != leaders
        yield pa.RecordBatch.from_arrays([pa.array(x[follows]) for x in (bands, leaders, members)], schema=schema)


def _bands(classes: DataFrame) -> DataFrame:
    """(band, leader, c) of every class that is not the first of its band."""
    rows = classes.select(F.explode("bands").alias("band"), "c")
    ordered = rows.repartition("band").sortWithinPartitions("band", "c")
    return ordered.mapInArrow(_led, "band bigint, leader bigint, c bigint")


def _apart(a: str, b: str, word: str = "{}[{}]") -> str:
    """SQL for the number of minima in which two sketches differ; `word` names their words."""
    words = []
    for i in range(SKETCH_WORDS):
        x = f"({word.format(a, i)} ^ {word.format(b, i)})"
        # a sum takes each of the lower seven bytes that differs to its highest bit, and overflows nowhere
        low = f"bit_count((((({x}) & {0x007F7F7F7F7F7F7F}L) + {0x007F7F7F7F7F7F7F}L) | {x}) & {0x0080808080808080}L)"
        words.append(f"{low} + int(shiftrightunsigned({x}, 56) <> 0)")
    return " + ".join(words)


#: SQL: the parities in which the lines l and r differ. They are no more than the shingles
#: that only one of both has; similar enough lines have these in at most one of nine.
ODD = " + ".join(f"bit_count(l.o{i} ^ r.o{i})" for i in range(PARITY_WORDS))
NEAR = f"{100 + MIN_PERCENT} * ({ODD}) <= {200 - 2 * MIN_PERCENT} * (l.n + r.n) DIV 2"
MAY = f"{NEAR} AND {_apart('l.s', 'r.s', '{}{}')} <= {MOST_APART}"
#: SQL for how far apart they seem to be.
DISTANCE = f"float({ODD}) / (l.n + r.n)"


def line_shingles(line: str) -> frozenset[str]:
    return frozenset(line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1)))


def _similar(batches):
    """The pairs (u, v) whose lines are similar enough; rows of one u come together."""
    last, own = None, frozenset()
    for batch in batches:
        found = []
        for u, v, a, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if u != last:
                last, own = u, line_shingles(a)
            other = line_shingles(b)
            shared = len(own & other)
            if 100 * shared >= MIN_PERCENT * (len(own) + len(other) - shared):
                found.append((u, v))
        us, vs = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])


def _verified(pairs: DataFrame, met: DataFrame) -> DataFrame:
    """The pairs (u, v) that are similar enough."""
    known = met.select("c", "line", *BOUNDS)
    rows = (
        pairs.join(known.alias("r"), F.expr("v = r.c"))
        .join(known.alias("l"), F.expr(f"u = l.c AND {NEAR}"))
        .selectExpr("u", "v", "l.line AS a", "r.line AS b")
    )
    return written(rows.mapInArrow(_similar, "u bigint, v bigint"), "line-links")


def _members(bands: DataFrame) -> DataFrame:
    """(band, c) of every member of the bands with several classes, leaders included."""
    rows = bands.select("band", "c").unionByName(bands.selectExpr("band", "leader AS c").distinct())
    return written(rows, "band-members")


def _open_members(members: DataFrame, found: DataFrame, met: DataFrame) -> DataFrame:
    """Members of the bands with several components, with their bounds and the band's largest component."""
    marked = with_component(members.select("band", "c"), found, "c", "component")
    largest = (
        marked.groupBy("band", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("band")
        .agg(F.count("*").alias("several"), F.expr("max(struct(n, component)).component").alias("largest"))
        .where("several > 1")
        .select("band", "largest")
    )
    return written(marked.join(largest, "band").join(met.select("c", *BOUNDS), "c"), "open-bands")


def _nearest_drawn(left: DataFrame, turn: int) -> DataFrame:
    """(u, v): each class that is not in the largest component of a band, and the nearest of those drawn there."""
    drawn = (
        left.where("component = largest")
        .withColumn("place", F.expr(f"xxhash64(c, {turn})"))
        .groupBy("band", F.expr(f"pmod(place, {DRAWN})").alias("slot"))
        .agg(F.expr(f"min_by(struct(c, {', '.join(BOUNDS)}), place)").alias("other"))
        .select("band", "other.*")
    )
    return (
        left.where("component <> largest")
        .alias("l")
        .join(drawn.alias("r"), F.expr(f"l.band = r.band AND {MAY}"))
        .selectExpr("l.c AS u", "r.c AS v", f"{DISTANCE} AS apart")
        .groupBy("u")
        .agg(F.expr("min(struct(apart, v)).v").alias("v"))
    )


def _rounds(members: DataFrame, found: DataFrame, met: DataFrame):
    """Components with the links of the rounds, the members of bands still open and the pairs compared."""
    best, tried = 0, None
    left = _open_members(members, found, met)
    for turn in itertools.count():
        pairs = written(_nearest_drawn(left, turn), "round-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        new = _verified(pairs, met)
        count = new.count()
        if count:
            found = components(new, found)
            last, left = left, _open_members(left, found, met)
            discard(last)
        best = max(best, count)
        if count <= LAST_ROUND * best:
            return found, left, tried


def _open_pairs(left: DataFrame) -> DataFrame:
    """(u, v, apart) of members of a band that are in different components and may be similar enough."""
    # two members of the largest component need no look at each other
    pairs = (
        left.where("component <> largest")
        .alias("l")
        .join(left.alias("r"), F.expr(
            "l.band = r.band AND l.component <> r.component"
            f" AND (r.component = r.largest OR l.c > r.c) AND {MAY}"
        ))
        .selectExpr("greatest(l.c, r.c) AS u", "least(l.c, r.c) AS v", f"{DISTANCE} AS apart")
        .distinct()
    )
    return written(pairs, "open-pairs")


def similar_lines(docs: DataFrame) -> DataFrame:
    """(k, component) of the classes that are linked with another class; both are digests."""
    classes = written(_classes(docs), "classes")
    # the shuffle of all lines must not stay beside that of the bands
    release(docs.sparkSession, HANDED_OVER)
    bands = written(_bands(classes.select("bands", "c")), "members")
    # what the classes that meet any other need from here on
    used = bands.selectExpr("explode(array(c, leader)) AS c").distinct()
    met = joined(classes.select("c", "k", "line", "sketch"), used, "c").select("c", "k", "line", "sketch")
    kinds = {"k": "binary", "line": "string"}
    met = written(met.mapInArrow(_with_parities, ", ".join(f"{x} {kinds.get(x, 'bigint')}" for x in MET)), "met")
    discard(classes)
    links = _verified(bands.selectExpr("c AS u", "leader AS v").distinct(), met)
    found = components(links)
    members = _members(bands)
    discard(bands)
    found, left, tried = _rounds(members, found, met)
    discard(members)
    pairs = _open_pairs(left)
    discard(left)
    # of two components the nearest pair first; once it links them, their other pairs don't matter
    both = with_component(with_component(pairs, found, "u", "p"), found, "v", "q")
    near = both.selectExpr("least(p, q) AS p", "greatest(p, q) AS q", "struct(apart, u, v) AS pair")
    near = written(near.groupBy("p", "q").agg(F.min("pair").alias("pair")).select("pair.*"), "nearest")
    tried = tried.selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct()
    more = _verified(near.select("u", "v").join(tried, ["u", "v"], "left_anti"), met)
    if not more.isEmpty():
        found = components(more, found)
    both = with_component(with_component(pairs, found, "u", "p"), found, "v", "q").where("p <> q")
    done = near.select("u", "v").unionByName(tried)
    rest = written(both.select("u", "v").join(done, ["u", "v"], "left_anti"), "pairs")
    last = _verified(rest, met)
    if not last.isEmpty():
        found = components(last, found)
    named = met.select("c", "k")
    roots = found.join(named.selectExpr("c AS component", "k AS root"), "component")
    roots = roots.join(named.selectExpr("c AS node", "k"), "node").selectExpr("k", "root AS component")
    roots = written(roots, "line-components")
    discard(met, pairs, near, rest)
    return roots


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_md5, removed): numbers, from 0, of the lines that go, where any do."""
    found = similar_lines(docs)
    places = written(lines_of(docs), "places")
    # classes of one place without links need nothing more
    classes = places.groupBy("k").count().join(found, "k", "left").where("count > 1 OR component IS NOT NULL")
    classes = classes.selectExpr("k", "coalesce(component, k) AS component")
    shared = written(joined(places, classes, "k").select(*PLACE, "component"), "shared")
    discard(places)
    first = shared.groupBy("component").agg(F.min(F.struct(*PLACE)).alias("first"))
    return (
        joined(shared, first, "component")
        .where("NOT (doc_id <=> first.doc_id AND text_md5 = first.text_md5 AND line_no = first.line_no)")
        .groupBy("doc_id", "text_md5")
        .agg(F.sort_array(F.collect_set("line_no")).alias("removed"))
    )


def with_removed(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with the numbers of the lines that go, null where none does, and that column's name."""
    # names that none of the input's begins with
    own = "_"
    while any(name.startswith(own) for name in docs.columns):
        own += "_"
    gone = removed_lines(docs.select("doc_id", "text")).toDF(f"{own}doc", f"{own}md5", f"{own}lines")
    rows = docs.withColumn(f"{own}text", _text_md5())
    same = F.expr(f"doc_id <=> {own}doc AND {own}text = {own}md5")
    return joined(rows, gone, same, "left").drop(f"{own}doc", f"{own}md5", f"{own}text"), f"{own}lines"


def dedup_lines(docs: DataFrame) -> DataFrame:
    """`docs` with the lines that go taken out of `text`."""
    marked, gone = with_removed(docs)
    kept = f"array_join(filter(split(text, '\n'), (line, i) -> NOT array_contains({gone}, i)), '\n')"
    return marked.withColumn("text", F.expr(f"IF({gone} IS NULL, text, {kept})")).select(*docs.columns)


@registered("op10_line_dedup")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked, gone = with_removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.selectExpr(
        "doc_id",
        "CAST(size(split(coalesce(text, ''), '\n')) AS BIGINT) AS n_lines",
        f"CAST(coalesce(size({gone}), 0) AS BIGINT) AS n_removed",
        f"coalesce(array_join({gone}, ','), '') AS removed_lines",
    )

"""N-gram Jaccard join through packed R-trees over count vectors.

A document is the set of its distinct word shingles. The shingles are hashed into
256 groups; the counts per group make the document a point, and the overlap of two
documents is at most the sum of the smaller counts. Two documents link when
100 * intersection >= 80 * union.

1. Documents with equal sets become one class, with its smallest id.
2. Space is cut exactly: linked sets share a shingle among the first
   n - ceil(0.8 n) + 1 of each, in one fixed order of all shingles. So there is one
   tree for every such shingle that several classes hold. Shingles that more than `FEW`
   documents have early in their order come last, the rarer of them first, so that
   common passages and lines make no trees, and the others stay small however many
   documents there are. At most `MOST_LAST` shingles, the most frequent, are put last;
   this has no part in what is linked. A tree falls into parts where sizes leave a gap
   that no link spans.
3. A tree of at most `FEW` documents gives its pairs, unless a shingle stands too late
   in one of both to be the first that they share. Points of a larger tree are packed by
   size into pages; of trees with the same members, as copied passages make them, one
   is enough.
4. In rounds, every document is compared with one partner of its pairs, and in the
   larger trees with one leader only: a member of the largest component in one of its
   trees, of about its size; round by round other partners, trees, leaders and limits of
   sizes are drawn. Links, verified on the whole sets, make components, and pairs or a
   tree all of whose points are in one component are done. Copies by the thousand, near
   ones too, thus take a number of comparisons in proportion to their number. Rounds end
   once they find few links; that decides how much is left for the next step, not what
   is linked.
5. The remaining pairs are compared by their points. In the remaining trees pages are
   joined with pages, and within them boxes of sixteen points with boxes, while sizes fit
   and the sum of the smaller maxima reaches the overlap that a link needs; then points
   with points of another component, with 2,048 groups where documents are large, at last
   with 65,536. What survives is verified, so no link that could change a component is
   lost.

A tree's points are streamed in order or handled as pairs of bounded pages, never
gathered whole in one task. Sets are compared by all 64 bits of their hashes, class
keys have 128.

Defined results: a null or blank text has an empty set, is linked with nothing and is
its own component; repeated rows are equal documents; a null doc_id stays null, and
is the component of documents that have no other; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import discard, joined, registered, table, written
from tidelog.llm.components import components, with_component
from tidelog.session import fits_broadcast

WORDS = 5
MIN_PERCENT = 80
GROUPS = 256
#: Groups of the points of large documents before whole sets are sent, and shingles from which one is large.
MIDDLE_GROUPS, LARGE = 2048, 1024
PAGE = 512
BOX = 16
#: Documents of a tree that are paired at once; shingles that more have early in their order come last.
FEW = 32
#: Shingles that come last, at most.
MOST_LAST = 1 << 19
#: Parts of all shingles that are counted one at a time.
BUCKETS = 4096
#: Shingles sent together.
SENT = 1 << 20
#: Points compared in one step.
STEP = 1 << 15

#: Odd multipliers of the word positions in a shingle.
MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5],
    dtype=np.uint64,
)


def _mixed(x):
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < WORDS:
        total = (h * MULTIPLIERS[: len(h)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(h))
        return _mixed(total)
    last = len(h) - WORDS + 1
    total = h[:last] * MULTIPLIERS[0]
    for i in range(1, WORDS):
        total += h[i : last + i] * MULTIPLIERS[i]
    return np.unique(_mixed(total))


def needed_overlap(a, b):
    """Shared shingles that sets of these sizes need to be linked: J >= p means
    shared >= p (a + b) / (1 + p)."""
    return -(-MIN_PERCENT * (a + b) // (100 + MIN_PERCENT))


def _sized(batches, column):
    """Values of `column` of one Arrow batch after the other."""
    for batch in batches:
        yield batch, batch.column(column).to_pylist()


def _prefix_size(n: int) -> int:
    """Shingles of a set of `n` that no set it is linked with can miss all of."""
    return n - -(-MIN_PERCENT * n // 100) + 1 if n else 0


def _early(batches):
    """(bucket, shingles, how often) of those that documents have early in the order of hashes."""

    def sent(pieces):
        found, times = np.unique(np.concatenate(pieces), return_counts=True)
        bucket = (found & np.uint64(BUCKETS - 1)).astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        ends = np.append(starts, len(bucket)).astype(np.int32)
        columns = [
            pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends * x.itemsize), pa.py_buffer(x)])
            for x in (found[order], times[order].astype(np.uint32))
        ]
        return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), *columns], names=["bucket", "found", "times"])

    pieces, held = [], 0
    for _, texts in _sized(batches, "text"):
        for text in texts:
            found = shingles(text)
            size = _prefix_size(len(found))
            # what comes last gives way to half as many more
            pieces.append(found[: size + size // 2])
            held += len(pieces[-1])
            if held >= SENT:
                yield sent(pieces)
                pieces, held = [], 0
    if held:
        yield sent(pieces)


def _frequent(batches):
    """(s, n) of the shingles counted more than `FEW` times, from rows sorted by bucket."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for _, parts in itertools.groupby(rows, key=lambda row: row[0]):
        _, found, times = zip(*parts)
        found, times = np.frombuffer(b"".join(found), np.uint64), np.frombuffer(b"".join(times), np.uint32)
        order = np.argsort(found)
        found = found[order]
        starts = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
        sums = np.add.reduceat(times[order].astype(np.int64), starts)
        keep = sums > FEW
        yield pa.RecordBatch.from_arrays([pa.array(found[starts][keep].view(np.int64)), pa.array(sums[keep])], names=["s", "n"])


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that come last, sorted, and in how many documents they are early.

    Every part of the documents sends its early shingles bucket by bucket, so that rows
    are few, and a bucket is counted as a whole.
    """
    counted = written(
        docs.select("text")
        .mapInArrow(_early, "bucket int, found binary, times binary")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_frequent, "s long, n long"),
        "frequent",
    )
    sizes = counted.groupBy("n").count().orderBy(F.desc("n")).toPandas().astype(np.int64)
    fit = sizes["n"][sizes["count"].cumsum() <= MOST_LAST]
    rows = counted.where(F.col("n") >= int(fit.min()) if len(fit) else F.lit(False)).toPandas()
    discard(counted)
    found, times = rows["s"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)
    order = np.argsort(found)
    return found[order], times[order].astype(np.uint32)


def _ordered(found: np.ndarray, frequent: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The shingles of a set in the fixed order of all shingles."""
    if not len(frequent):
        return found
    at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
    last = frequent[at] == found
    if not last.any():
        return found
    return np.concatenate([found[~last], found[last][np.argsort(times[at[last]], kind="stable")]])


FEATURES = "doc_id long, n long, k1 long, k2 long, point binary, prefix binary"


def _point(found: np.ndarray, groups: int = GROUPS) -> bytes:
    shift = np.uint64(65 - groups.bit_length())
    counts = np.bincount((found >> shift).astype(np.int64), minlength=groups)
    top = int(counts.max(initial=0))
    return counts.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32).tobytes()


def _points(values: list[bytes], groups: int = GROUPS) -> np.ndarray:
    """A matrix of points, whatever the width of each."""
    if not values:
        return np.empty((0, groups), np.uint8)
    kinds = {groups: np.uint8, 2 * groups: np.uint16, 4 * groups: np.uint32}
    if len({len(v) for v in values}) == 1:
        return np.frombuffer(b"".join(values), kinds[len(values[0])]).reshape(-1, groups)
    return np.stack([np.frombuffer(v, kinds[len(v)]).astype(np.uint32) for v in values])


def features(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Size, class key, point and tree shingles of every document."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent)

    def described(batches):
        for batch, texts in _sized(batches, "text"):
            rows = []
            for text in texts:
                found = shingles(text)
                n = len(found)
                k1 = int(_mixed(found + np.uint64(1)).sum(dtype=np.uint64))
                k2 = int(np.bitwise_xor.reduce(_mixed(found ^ MULTIPLIERS[1]), initial=np.uint64(0)))
                prefix = _ordered(found, *frequent.value)[: _prefix_size(n)]
                rows.append((n, k1, k2, _point(found), prefix.tobytes()))
            n, k1, k2, points, prefix = map(list, zip(*rows)) if rows else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(np.array(k1, np.uint64).view(np.int64)),
                    pa.array(np.array(k2, np.uint64).view(np.int64)),
                    pa.array(points, pa.binary()),
                    pa.array(prefix, pa.binary()),
                ],
                names=["doc_id", "n", "k1", "k2", "point", "prefix"],
            )

    return docs.select("doc_id", "text").mapInArrow(described, FEATURES)


def _entries(batches):
    """(s, doc_id, n, at) for every tree shingle of every class; `at` is its place in the order."""
    for batch in batches:
        prefixes = batch.column("prefix").to_pylist()
        sizes = np.array([len(p) // 8 for p in prefixes], np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.frombuffer(b"".join(prefixes), np.int64)),
                pa.array(np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), sizes)),
                pa.array(np.repeat(batch.column("n").to_numpy(), sizes)),
                pa.array(np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)),
            ],
            names=["s", "doc_id", "n", "at"],
        )


#: An odd factor that names the parts of a tree.
PART = np.int64(0x1E3779B97F4A7C15)


def _parted(batches):
    """Entries sorted by (s, n, doc_id), with a name of its own for each part of a tree.

    A part ends where the next size is too large to be linked with the last one.
    """
    last = None
    for batch in batches:
        s, n = (batch.column(c).to_numpy() for c in ("s", "n"))
        if not len(s):
            continue
        before = last or (s[0], n[0], 0)
        same = s == np.append(before[0], s[:-1])
        gap = same & (100 * np.append(before[1], n[:-1]) < MIN_PERCENT * n)
        parts = np.cumsum(gap)
        # counted from the start of each tree; the first one here may have begun before
        parts -= np.maximum.accumulate(np.where(same, -before[2], parts))
        last = s[-1], n[-1], int(parts[-1])
        yield batch.set_column(batch.schema.get_field_index("s"), "s", pa.array(s ^ parts * PART))


def _pairs_within(starts, sizes):
    """Index pairs (a > b) of rows of the same group, a bounded number of groups at a time."""
    begin = 0
    costs = np.cumsum(sizes * (sizes - 1) // 2)
    while begin < len(starts):
        done = costs[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(costs, done + STEP, side="right")))
        rows = np.concatenate([np.arange(s, s + m) for s, m in zip(starts[begin:end], sizes[begin:end])])
        back = np.concatenate([np.arange(m) for m in sizes[begin:end]])
        a = np.repeat(rows, back)
        first = np.repeat(np.cumsum(back) - back, back)
        yield a, np.repeat(rows - back, back) + np.arange(len(a)) - first
        begin = end


DEALT = "s long, doc_id long, n long, partner long"


def _dealt(batches):
    """Pairs of trees of at most `FEW`, and members of larger ones, from entries sorted by (s, n, doc_id).

    Members have no partner. A pair is left out where the shingle has no room before and
    behind it for the overlap needed, as it is not the first that linked sets share. The
    last tree is held back until it has ended or has more than `FEW` members.
    """
    rest, large = [np.empty(0, np.int64)] * 4, None
    for batch in itertools.chain(batches, [None]):
        rows = rest
        if batch is not None:
            rows = [np.append(x, batch.column(c).to_numpy()) for x, c in zip(rest, ("s", "doc_id", "n", "at"))]
        s, doc, n, at = rows
        if not len(s):
            continue
        starts = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        sizes = np.diff(np.append(starts, len(s)))
        many = sizes > FEW
        many[0] |= s[0] == large
        large, end = s[-1] if many[-1] else None, len(s)
        if batch is not None and not many[-1]:
            starts, sizes, many, end = starts[:-1], sizes[:-1], many[:-1], starts[-1]
        rest = [x[end:] for x in rows]
        keep = np.flatnonzero(np.repeat(many, sizes))
        if len(keep):
            columns = [pa.array(x[keep]) for x in (s, doc, n)]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(keep), pa.int64())], names=["s", "doc_id", "n", "partner"])
        few = ~many & (sizes > 1)
        for a, b in _pairs_within(starts[few], sizes[few]):
            room = needed_overlap(n[a], n[b])
            fits = (at[a] <= n[a] - room) & (at[b] <= n[b] - room) & (doc[a] != doc[b])
            a, b = a[fits], b[fits]
            columns = [s[a], np.maximum(doc[a], doc[b]), n[a], np.minimum(doc[a], doc[b])]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["s", "doc_id", "n", "partner"])


MEMBERS = "s long, doc_id long, n long, page long"


def _trees(batches):
    """Members of trees of two or more with their page, from entries sorted by (s, n, doc_id).

    A row is held back until the next one shows whether it stands alone.
    """
    held, place = None, 0
    for batch in batches:
        rows = [batch.column(c).to_numpy() for c in ("s", "doc_id", "n")]
        if held is not None:
            rows = [np.append(h, x) for h, x in zip(held, rows)]
        s = rows[0]
        if not len(s):
            continue
        new, at = np.append(True, s[1:] != s[:-1]), np.arange(len(s))
        start = np.maximum.accumulate(np.where(new, at, 0))
        places = at - start + np.where(start == 0, place, 0)
        keep = ~(new[1:] & (places[:-1] == 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[:-1][keep]) for x in (*rows, places // PAGE)], names=["s", "doc_id", "n", "page"]
        )
        held, place = [x[-1:] for x in rows], int(places[-1])
    if place > 0:
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (*held, np.array([place // PAGE]))], names=["s", "doc_id", "n", "page"]
        )


def _different(members: DataFrame) -> DataFrame:
    """The members of one tree of each set of documents, told by its number and 128 bits."""
    bits = [F.sum(F.expr(f"shiftrightunsigned(xxhash64(doc_id, {i}), 32)")).alias(f"h{i}") for i in range(4)]
    told = members.groupBy("s").agg(F.count("*").alias("c"), *bits)
    once = told.groupBy("c", *(f"h{i}" for i in range(4))).agg(F.min("s").alias("s")).select("s")
    return members.join(once, "s", "left_semi")


def _bounded(batches):
    """Pairs (u, v) whose points leave room for the overlap they need."""
    for batch in batches:
        nu, nv = batch.column("nu").to_numpy(), batch.column("nv").to_numpy()
        keep = np.zeros(len(nu), bool)
        for i in range(0, len(nu), STEP):
            part = batch.slice(i, STEP)
            a, b = _points(part.column("pu").to_pylist()), _points(part.column("pv").to_pylist())
            room = np.minimum(a, b).sum(axis=1, dtype=np.int64)
            keep[i : i + STEP] = room >= needed_overlap(nu[i : i + STEP], nv[i : i + STEP])
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("u", "v")], names=["u", "v"])


def _joined_boxes(n, points, left, right):
    """Index pairs of points of `left` and `right` whose boxes may hold links."""
    def boxes(rows):
        rows = rows[np.argsort(n[rows], kind="stable")]
        starts = np.arange(0, len(rows), BOX)
        return rows, starts, np.maximum.reduceat(points[rows], starts, axis=0), n[rows[starts]], n[rows[np.minimum(starts + BOX, len(rows)) - 1]]

    rows_a, starts_a, tops_a, low_a, high_a = boxes(left)
    rows_b, starts_b, tops_b, low_b, high_b = boxes(right)
    for i, start in enumerate(starts_a):
        fits = (100 * high_b >= MIN_PERCENT * low_a[i]) & (100 * high_a[i] >= MIN_PERCENT * low_b)
        j = np.flatnonzero(fits)
        room = np.minimum(tops_a[i], tops_b[j]).sum(axis=1, dtype=np.int64)
        j = j[room >= needed_overlap(low_a[i], low_b[j])]
        if len(j):
            a = rows_a[start : start + BOX]
            b = np.concatenate([rows_b[starts_b[k] : starts_b[k] + BOX] for k in j])
            yield np.repeat(a, len(b)), np.tile(b, len(a))


#: Trees up to this size are compared point by point, larger ones by boxes first.
SMALL_TREE = 64


def _bounded_pairs(pairs, doc, n, component, points):
    """(u, v) of the index pairs whose bounds leave room for a link between two components."""
    for a, b in pairs:
        keep = (doc[a] != doc[b]) & (component[a] != component[b])
        keep &= 100 * np.minimum(n[a], n[b]) >= MIN_PERCENT * np.maximum(n[a], n[b])
        a, b = a[keep], b[keep]
        for i in range(0, len(a), STEP):
            x, y = a[i : i + STEP], b[i : i + STEP]
            room = np.minimum(points[x], points[y]).sum(axis=1, dtype=np.uint32)
            fits = room >= needed_overlap(n[x], n[y])
            yield np.maximum(doc[x], doc[y])[fits], np.minimum(doc[x], doc[y])[fits]


def _joined_groups(s, pa_, pb_, page, doc, n, component, points):
    """Surviving pairs of whole groups of rows with equal (s, pa, pb)."""
    cuts = np.flatnonzero(np.append(True, (s[1:] != s[:-1]) | (pa_[1:] != pa_[:-1]) | (pb_[1:] != pb_[:-1])))
    sizes = np.diff(np.append(cuts, len(s)))
    small = (sizes <= SMALL_TREE) & (pa_[cuts] == pb_[cuts])
    yield from _bounded_pairs(_pairs_within(cuts[small], sizes[small]), doc, n, component, points)
    for start, size in zip(cuts[~small], sizes[~small]):
        rows = np.arange(start, start + size)
        side = page[rows] == pb_[rows]
        right = rows[side]
        left = right if pa_[start] == pb_[start] else rows[~side]
        if len(left) and len(right):
            pairs = _joined_boxes(n, points, left, right)
            if left is right:
                pairs = ((a[a < b], b[a < b]) for a, b in pairs)
            yield from _bounded_pairs(pairs, doc, n, component, points)


def _pages_joined(batches):
    """Surviving pairs of pages, from rows sorted by (s, pa, pb)."""
    names = ["s", "pa", "pb", "page", "doc_id", "n", "component"]
    rest = None
    for batch in itertools.chain(batches, [None]):
        if batch is None:
            rows, points = rest if rest is not None else (None, [])
        else:
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            points = batch.column("point").to_pylist()
            if rest is not None:
                rows = [np.append(a, b) for a, b in zip(rest[0], rows)]
                points = rest[1] + points
        if rows is None or not len(points):
            continue
        end = len(points)
        if batch is not None:
            # the last group may go on in the next batch
            same = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]) & (rows[2] == rows[2][-1])
            end = 0 if same.all() else len(same) - int(np.argmin(same[::-1]))
            rest = ([x[end:] for x in rows], points[end:])
        if end:
            s, pa_, pb_, page, doc, n, component = (x[:end] for x in rows)
            for u, v in _joined_groups(s, pa_, pb_, page, doc, n, component, _points(points[:end])):
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _fine(found: np.ndarray) -> bytes:
    """A point with 65,536 groups, as the sorted groups of its shingles."""
    return np.sort((found & np.uint64(0xFFFF)).astype(np.uint16)).tobytes()


def _fine_room(a: bytes, b: bytes) -> int:
    """The sum of the smaller counts of two such points."""
    a, b = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
    left = np.searchsorted(a, b, side="left")
    place = np.arange(len(b)) - np.searchsorted(b, b, side="left")
    return int((place < np.searchsorted(a, b, side="right") - left).sum())


def _filtered(pairs: DataFrame, sets: DataFrame, column: str, fits) -> DataFrame:
    """The pairs (u, v) for which `fits` holds of a column of both."""

    def kept(batches):
        for batch in batches:
            sides = (batch.column(c).to_pylist() for c in ("fu", "fv"))
            keep = pa.array([fits(a, b) for a, b in zip(*sides)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("u", "v")], names=["u", "v"])

    return (
        pairs.join(sets.selectExpr("doc_id AS u", f"{column} AS fu"), "u")
        .join(sets.selectExpr("doc_id AS v", f"{column} AS fv"), "v")
        .select("u", "v", "fu", "fv")
        .mapInArrow(kept, "u long, v long")
    )


def _fine_fits(a: bytes, b: bytes) -> bool:
    return _fine_room(a, b) >= needed_overlap(len(a) // 2, len(b) // 2)


def _middle(found: np.ndarray) -> bytes | None:
    """A point with 2,048 groups, of large sets only."""
    return _point(found, MIDDLE_GROUPS) if len(found) >= LARGE else None


def _middle_fits(a: bytes | None, b: bytes | None) -> bool:
    if a is None or b is None:
        return True
    a, b = (_points([x], MIDDLE_GROUPS)[0] for x in (a, b))
    room, sizes = np.minimum(a, b).sum(dtype=np.int64), (int(x.sum(dtype=np.int64)) for x in (a, b))
    return bool(room >= needed_overlap(*sizes))


def _linked(a: bytes, b: bytes) -> bool:
    a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= MIN_PERCENT * (len(a) + len(b) - shared)


def _verified(pairs: DataFrame, docs: DataFrame, finer: bool) -> DataFrame:
    """The pairs whose whole sets are similar enough.

    Large documents are told apart by their points of 2,048 groups, which stay as small
    as they are. With `finer`, points of 65,536 groups are compared before the sets, as
    a quarter of the bytes that sets take leaves hardly any pair that is not linked.
    """
    pairs = written(pairs, "pairs")
    needed = pairs.selectExpr("explode(array(u, v)) AS doc_id").distinct()

    def sets(batches):
        for batch, texts in _sized(batches, "text"):
            found = [shingles(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([x.tobytes() for x in found], pa.binary()),
                    pa.array(map(_fine, found), pa.binary()),
                    pa.array(map(_middle, found), pa.binary()),
                ],
                names=["doc_id", "found", "fine", "middle"],
            )

    texts = joined(docs.select("doc_id", "text"), needed, "doc_id", "left_semi")
    found = written(texts.mapInArrow(sets, "doc_id long, found binary, fine binary, middle binary"), "sets")
    for column, fits in [("middle", _middle_fits), ("fine", _fine_fits)][: 1 + finer]:
        last, pairs = pairs, written(_filtered(pairs, found, column, fits), "pairs")
        discard(last)
    links = written(_filtered(pairs, found, "found", _linked), "linked")
    discard(pairs, found)
    return links


def _leaders(members: DataFrame, turn: int) -> DataFrame:
    """(doc_id, leader): for every member, one of another component to be compared with.

    Trees are cut into classes of size, at other sizes each turn. The largest component
    of a class offers one of its members as the leader to those that are not in it, and
    a document takes the offer of one of its trees.
    """
    drawn = f"xxhash64({{}}, {turn})"
    sized = members.withColumn("size", F.floor(F.log("n") / F.log(F.lit(1.125)) + turn * 0.618 % 1))
    top = (
        sized.groupBy("s", "size", "component")
        .agg(F.count("*").alias("c"), F.expr(f"min(struct({drawn.format('doc_id')} AS drawn, doc_id))").alias("leader"))
        .groupBy("s", "size")
        .agg(F.expr(f"max(struct(c, {drawn.format('component')} AS drawn, component, leader.doc_id AS leader))").alias("top"), F.count("*").alias("several"))
        .where("several > 1")
        .selectExpr("s", "size", "top.component AS largest", "top.leader AS leader")
    )
    return (
        sized.join(top, ["s", "size"])
        .where("component <> largest")
        .groupBy("doc_id")
        .agg(F.expr(f"min(struct({drawn.format('s')} AS drawn, leader)).leader").alias("leader"))
    )


def _open_members(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the trees that still hold several components."""
    marked = with_component(members.select("s", "doc_id", "n", "page"), found, "doc_id", "component")
    still = (
        marked.groupBy("s")
        .agg(F.min("component").alias("a"), F.max("component").alias("z"))
        .where("a < z")
        .select("s")
    )
    return marked.join(still, "s", "left_semi")


#: A round that finds less than this share of the links of the best one is the last.
LAST_ROUND = 0.1


def _partners(pairs: DataFrame, turn: int) -> DataFrame:
    """One pair (u, v) for every u: the smallest v at first, then one drawn."""
    drawn = f"xxhash64(v, {turn})" if turn else "v"
    return pairs.groupBy("u").agg(F.expr(f"min(struct({drawn} AS drawn, v)).v").alias("v"))


def _open_pairs(pairs: DataFrame, tried: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs of different components that were not tried."""
    left = pairs.join(tried, ["u", "v"], "left_anti")
    return with_component(with_component(left, found, "u", "p"), found, "v", "q").where("p <> q").select("u", "v")


def _near(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """The pairs (u, v) whose points leave room for a link."""
    return (
        pairs.join(own.selectExpr("doc_id AS u", "n AS nu", "point AS pu"), "u")
        .join(own.selectExpr("doc_id AS v", "n AS nv", "point AS pv"), "v")
        .select("u", "v", "nu", "nv", "pu", "pv")
        .mapInArrow(_bounded, "u long, v long")
    )


def _rounds(members: DataFrame, pairs: DataFrame, own: DataFrame, docs: DataFrame):
    """Components of the links with leaders and partners, and the members and pairs still open."""
    left, open_pairs, found, best = members.withColumn("component", F.col("doc_id")), pairs, None, 0
    for turn in itertools.count():
        leaders = _leaders(left, turn).selectExpr("greatest(doc_id, leader) AS u", "least(doc_id, leader) AS v")
        tried = written(leaders.unionByName(_partners(open_pairs, turn)).distinct(), "tried")
        new = _verified(_near(tried, own), docs, finer=False)
        count = new.count()
        if count or found is None:
            found = components(new, found)
            last, left = left, written(_open_members(left, found), "open-members")
            discard(members if turn == 0 else last)
        last, open_pairs = open_pairs, written(_open_pairs(open_pairs, tried, found), "open-pairs")
        discard(last, tried)
        best = max(best, count)
        if count <= LAST_ROUND * best:
            return found, left, open_pairs


def _rest(members: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs of different components that survive the bounds of the trees."""
    pages = members.groupBy("s", "page").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    pages = pages.where("s IS NOT NULL")
    joined = (
        pages.selectExpr("s", "page AS pa", "low AS la", "high AS ha")
        .join(pages.selectExpr("s", "page AS pb", "low AS lb", "high AS hb"), "s")
        .where(f"pa <= pb AND 100 * ha >= {MIN_PERCENT} * lb")
        .select("s", "pa", "pb", F.expr("explode(array_distinct(array(pa, pb)))").alias("page"))
    )
    return (
        members.join(joined, ["s", "page"])
        .join(points, "doc_id")
        .select("s", "pa", "pb", "page", "doc_id", "n", "component", "point")
        .repartition("s", "pa", "pb")
        .sortWithinPartitions("s", "pa", "pb")
        .mapInArrow(_pages_joined, "u long, v long")
        .distinct()
    )


def linked_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    docs = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    described = written(features(docs, frequent_shingles(docs)), "features")
    classes = described.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    reps = classes.where("rep IS NOT NULL").selectExpr("rep AS doc_id")
    own = written(described.where("n > 0").join(reps, "doc_id", "left_semi"), "classes")
    trees = written(
        own.select("doc_id", "n", "prefix")
        .mapInArrow(_entries, "s long, doc_id long, n long, at long")
        .repartition("s")
        .sortWithinPartitions("s", "n", "doc_id")
        .mapInArrow(lambda batches: _dealt(_parted(batches)), DEALT),
        "trees",
    )
    pairs = written(trees.where("partner IS NOT NULL").selectExpr("doc_id AS u", "partner AS v").distinct(), "pairs-of-trees")
    every = written(
        trees.where("partner IS NULL")
        .select("s", "doc_id", "n")
        .repartition("s")
        .sortWithinPartitions("s", "n", "doc_id")
        .mapInArrow(_trees, MEMBERS),
        "every-tree",
    )
    members = written(_different(every), "members")
    discard(trees, every)
    # documents that are in no pair and no larger tree need no further look
    needed = written(pairs.selectExpr("explode(array(u, v)) AS doc_id").unionByName(members.select("doc_id")).distinct(), "needed")
    points = written(own.select("doc_id", "n", "point").join(needed, "doc_id", "left_semi"), "points")
    discard(own)
    texts = docs
    if fits_broadcast(needed):
        texts = written(docs.join(F.broadcast(needed), "doc_id", "left_semi"), "texts")
    found, left, pairs = _rounds(members, pairs, points, texts)
    more = _verified(_rest(left, points.select("doc_id", "point")).unionByName(_near(pairs, points)).distinct(), texts, finer=True)
    discard(left, pairs, points, needed)
    if texts is not docs:
        discard(texts)
    if not more.isEmpty():
        found = components(more, found)
    named = (
        classes.join(found.selectExpr("node AS rep", "component"), "rep", "left")
        .where("copies > 1 OR component IS NOT NULL")
        .selectExpr("k1", "k2", "n", "coalesce(component, rep) AS component_id")
    )
    return joined(described.select("doc_id", "n", "k1", "k2"), named, ["k1", "k2", "n"], "left").selectExpr("doc_id", "n AS n_shingles", "coalesce(component_id, doc_id) AS component_id")


@registered("op1_ngram_join")
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(table(spark, sf_dir, "documents"))

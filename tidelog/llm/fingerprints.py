"""Document fingerprints as invertible Bloom lookup sketches.

A text is cut into paragraphs: runs up to a line break, the end of a sentence or 200
characters. The digests of its distinct paragraphs go, by their low bits, to blocks
of sixteen on average, and in a block to one cell in each of three rows of eight. A
cell keeps the XOR of its digests, their number and the XOR of short checks. Two
fingerprints are brought to the smaller number of blocks (blocks add up) and
subtracted cell by cell: common paragraphs vanish, and peeling cells with a single
digest recovers the others. Every pair is peeled. A block that can't be is tried again
with a sketch of twice the size, and at last its digests, which are at hand, are
compared one by one. Likeness is the Jaccard similarity that follows: common
paragraphs over all, exact but for equal hashes.

All of it is DataFrame functions. The next document is found by one exchange of the
texts, by ranges of ids: quantiles, and equal widths within a quantile, so that a
range holds about `RANGE_ROWS` rows at any size. Each range is given the first text
of the next one, so no window spans the table.

Defined results: a null text is empty, and two empty texts are alike; the document
after the last is the first, and a single document follows itself; rows with equal
ids are ordered by text; null ids come first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import joined, partitions, registered, table, written

ROWS = 3
#: Where the bits of a digest begin that choose its cell in each row, by the cells of a row;
#: blocks go by the low bits.
SHIFTS = {8: (40, 46, 52), 16: (30, 44, 54)}
WIDTH = 8
WIDER = (16,)
BLOCK = 16
PEELS = 10
RANGE_ROWS = 10_000
MAX_QUANTILES = 256

PARAGRAPHS = "regexp_extract_all({text}, '[^.!?\\n]{{1,200}}[.!?\\n]*|[.!?\\n]+', 0)"
EMPTY = "named_struct('k', 0L, 'c', 0, 'h', 0)"


def _let(name: str, value: str, body: str) -> str:
    """SQL for `body` with `name` standing for `value`, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _check(key: str) -> str:
    return f"INT(xxhash64({key}, 7) & 65535)"


def _cell(key: str, shift: str, width: int) -> str:
    """The cell of a digest in a row, from bits of its own that begin at `shift`."""
    return f"INT(shiftrightunsigned({key}, {shift}) & {width - 1})"


def _cells(keys: str, width: int) -> str:
    """The cells of one block, row after row."""
    own = f"filter({keys}, x -> {_cell('x', 'r', width)} = i)"
    cell = (
        "named_struct('k', aggregate(own, 0L, (a, x) -> a ^ x), 'c', size(own),"
        f" 'h', aggregate(own, 0, (a, x) -> a ^ {_check('x')}))"
    )
    row = f"transform(sequence(0, {width - 1}), i -> {_let('own', own, cell)})"
    return f"flatten(transform(array{SHIFTS[width]}, r -> {row}))"


def sketch(text: str) -> str:
    """SQL for the sketch of a text: keys, number n, blocks b and cells."""
    # blocks are split off in two steps, so that work stays close to the number of keys
    part = "filter(keys, x -> pmod(x, b1) = g)"
    block = "filter(part, x -> pmod(shiftright(x, l1), b2) = j)"
    blocks = _let("part", part, f"transform(sequence(0, b2 - 1), j -> {_cells(block, WIDTH)})")
    nested = f"transform(sequence(0, b1 - 1), g -> {blocks})"
    # block j * b1 + g holds the digests with these low bits
    ordered = "flatten(flatten(transform(sequence(0, b2 - 1), j -> transform(nested, x -> x[j]))))"
    body = f"named_struct('keys', keys, 'n', size(keys), 'b', b1 * b2, 'cells', {_let('nested', nested, ordered)})"
    body = _let("b2", "INT(shiftleft(1, l - l1))", body)
    body = _let("b1", "INT(shiftleft(1, l1))", body)
    body = _let("l1", "INT(l DIV 2)", body)
    body = _let("l", f"INT(greatest(0, ceil(log2(greatest(size(keys), 1) / {BLOCK}))))", body)
    return _let("keys", f"array_distinct(transform({PARAGRAPHS.format(text=text)}, p -> xxhash64(p)))", body)


def _minus(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (x, y) -> named_struct('k', x.k ^ y.k, 'c', x.c - y.c, 'h', x.h ^ y.h))"


def _folded(of: str, b: str) -> str:
    """Cells of sketch `of` for `b` blocks."""
    width = ROWS * WIDTH
    place = f"{of}.cells[m * {b} * {width} + i]"
    cell = (
        f"aggregate(sequence(0, {of}.b DIV {b} - 1), {EMPTY}, (a, m) -> {{}})"
    ).format(_let("o", place, "named_struct('k', a.k ^ o.k, 'c', a.c + o.c, 'h', a.h ^ o.h)"))
    return f"IF({of}.b = {b}, {of}.cells, transform(sequence(0, {b} * {width} - 1), i -> {cell}))"


def _peeled(cells: str, width: int) -> str:
    """How many digests peeling recovers from one block, NULL if some are left."""
    shift = f"get(array{SHIFTS[width]}, i DIV {width})"
    pure = (
        "array_distinct(transform(filter(s.cells, (x, i) -> abs(x.c) = 1"
        f" AND x.h = {_check('x.k')} AND {_cell('x.k', shift, width)} = i % {width}),"
        " x -> named_struct('k', x.k, 'c', x.c)))"
    )
    hits = _let("r", shift, f"filter(pure, p -> {_cell('p.k', 'r', width)} = i % {width})")
    taken = (
        "aggregate(hits, x, (a, p) -> named_struct('k', a.k ^ p.k, 'c', a.c - p.c,"
        f" 'h', a.h ^ {_check('p.k')}))"
    )
    taken = f"IF(size(hits) = 0, x, {taken})"
    after = f"transform(s.cells, (x, i) -> {_let('hits', hits, taken)})"
    stuck = "named_struct('cells', s.cells, 'found', s.found, 'stuck', true)"
    on = f"named_struct('cells', {after}, 'found', s.found + size(pure), 'stuck', false)"
    step = f"IF(s.stuck, s, {_let('pure', pure, f'IF(size(pure) = 0, {stuck}, {on})')})"
    start = f"named_struct('cells', {cells}, 'found', 0, 'stuck', false)"
    done = "forall(s.cells, x -> x.c = 0 AND x.k = 0 AND x.h = 0)"
    return f"aggregate(sequence(1, {PEELS}), {start}, (s, r) -> {step}, s -> IF({done}, s.found, NULL))"


def _compared(a: str, b: str) -> str:
    """SQL for what two sketches have apart: their total, the common blocks, and the cells left."""
    body = f"named_struct('total', DOUBLE({a}.n + {b}.n), 'blocks', blocks, 'd', "
    body += _minus(_folded(a, "blocks"), _folded(b, "blocks")) + ")"
    return _let("blocks", f"least({a}.b, {b}.b)", body)


def _recovered(of: str, a: str, b: str) -> str:
    """SQL for the number of different paragraphs by peeling each block."""
    width = ROWS * WIDTH
    own = "filter({of}.keys, x -> pmod(x, {by}.blocks) = j)"
    larger = [_peeled(_minus(_cells("ka", w), _cells("kb", w)), w) for w in WIDER]
    exact = "size(array_except(ka, kb)) + size(array_except(kb, ka))"
    again = f"coalesce({', '.join(larger)}, {exact})"
    again = _let("ka", own.format(of=a, by=of), _let("kb", own.format(of=b, by=of), again))
    each = f"coalesce({_peeled(f'slice({of}.d, j * {width} + 1, {width})', WIDTH)}, {again})"
    return f"aggregate(sequence(0, {of}.blocks - 1), 0, (t, j) -> t + {each})"


def _likeness(of: str, differ: str) -> str:
    return f"IF({of}.total = 0, 1D, ({of}.total - {differ}) / ({of}.total + {differ}))"


def as_text(of: str) -> str:
    """SQL for a sketch as a string."""
    cell = "IF(x.c = 0 AND x.k = 0, '', concat_ws('.', hex(x.k), x.c, hex(x.h)))"
    return f"concat({of}.n, ':', {of}.b, ':', array_join(transform({of}.cells, x -> {cell}), ','))"


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text): each text beside that of the next higher id."""
    docs = docs.selectExpr("doc_id", "coalesce(text, '') AS text")
    count = docs.count()
    many = min(MAX_QUANTILES, max(partitions(docs.sparkSession), count // RANGE_ROWS))
    cuts = docs.select(F.percentile_approx("doc_id", [i / many for i in range(many + 1)], 10_000)).first()[0]
    cuts = sorted(set(cuts or [0]))
    subs = count // (RANGE_ROWS * many) + 1
    edges = F.array(*(F.lit(c) for c in cuts))
    # the number of cuts up to the id, then equal widths up to the next cut
    q = F.size(F.filter(edges, lambda c: c <= F.col("doc_id")))
    low = F.get(edges, q - 1).cast("double")
    high = F.coalesce(F.get(edges, q), F.get(edges, q - 1)).cast("double")
    sub = F.floor((F.col("doc_id").cast("double") - low) * subs / (high - low + 1))
    placed = docs.withColumn(
        "place", F.when(q > 0, q * subs + F.least(sub, F.lit(subs - 1))).otherwise(F.lit(-1)).cast("long")
    )
    firsts = placed.groupBy("place").agg(F.min("doc_id").alias("doc_id"))
    heads = written(
        joined(placed.select("doc_id", "text", "place"), firsts, ["doc_id", "place"])
        .unionByName(placed.where("doc_id IS NULL").select("doc_id", "text", "place"))
        .groupBy("place")
        .agg(F.min("text").alias("text")),
        "heads",
    )
    order = Window.orderBy("place")
    # places alone are put in order, the texts meet them afterwards
    before = heads.select(
        F.coalesce(F.lag("place").over(order), F.max("place").over(Window.partitionBy())).alias("to"), "place"
    )
    before = joined(heads, before, "place").selectExpr("to AS place", "text")
    rows = placed.withColumn("last", F.lit(0)).unionByName(
        before.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "place", "1 AS last")
    )
    own = Window.partitionBy("place").orderBy("last", "doc_id", "text")
    return rows.withColumn("next_text", F.lead("text").over(own)).where("last = 0").drop("last", "place")


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints and likeness of each document, its edited text and the next document."""
    edited = (
        with_next(docs)
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn("cut", F.expr("INT(n_chars DIV 4)"))
        .withColumn(
            "edited", F.expr("concat(left(text, INT(n_chars) - cut), left(next_text, cut))")
        )
    )
    rows = edited.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        _columns(s=sketch("text"), e=sketch("edited"), f=sketch("next_text")),
    )
    # one expression a step: each is computed once, and none nests too deep for the analyzer
    kept = ["doc_id", "n_chars", "edited_sha256", "s", "e", "f"]
    rows = rows.select(*kept, _columns(p=_compared("s", "e"), q=_compared("s", "f")))
    rows = rows.select(*kept, "p", "q", _columns(dp=f"DOUBLE({_recovered('p', 's', 'e')})"))
    rows = rows.select(*kept, "p", "q", "dp", _columns(dq=f"DOUBLE({_recovered('q', 's', 'f')})"))
    return rows.selectExpr(
        "doc_id",
        "n_chars",
        "edited_sha256",
        f"{as_text('s')} AS fingerprint",
        f"{as_text('e')} AS edited_fingerprint",
        f"{_likeness('p', 'dp')} AS near_edited",
        f"{_likeness('q', 'dq')} AS near_next",
    )


def _columns(**made: str):
    """New columns as a generator, which is never merged into what uses them."""
    fields = ", ".join(f"'{name}', {sql}" for name, sql in made.items())
    return F.expr(f"inline(array(named_struct({fields})))")


@registered("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents"))

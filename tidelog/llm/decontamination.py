"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question that was asked
again with other values has the same template. Items are cut into windows of eight
template words (items of four to seven words: windows of four). All windows with
enough literal words are indexed; every window of every document is looked up, and
each pair of a document and an item with the coverage asked for is a candidate. For
these the windows of both are compared in full, and the slots are aligned in every
place where shared windows put the item: there each value of the item must have become
the same value everywhere. A pair is reported when at least half of the item's windows
are found and the slots of some place are consistent. Items without windows of enough
literal words, such as lists of numbers, are found verbatim only, by windows of their
own words instead of placeholders, all of them in one place.

A capitalised first word is literal in an item, but a name behind a word of a
document; such items are looked for in both readings.

All of it is DataFrame functions. The documents are not shuffled for the lookup: the
index is broadcast when its measured size allows, else the join is salted. A passage
that a third of the documents share gives a handful of rows for each of them.

Defined results: items under four template words can't be found; a null text has no
words; of repeated rows each pair of ids is reported once, with its largest coverage;
other columns are ignored, except by `decontaminate`, which passes them through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import joined, registered, table, written
from tidelog.session import Lookup

WINDOW = 8
SHORT_WINDOW = 4
MIN_LITERALS = 3
MIN_COVERAGE = 0.5
#: Remainders by which windows are sieved before the join, whatever the benchmark's size.
SIEVE = 1 << 16

#: Marks of a name, a number and a unit, in that order.
NAME, NUMBER, UNIT = "\ue001", "\ue002", "\ue003"
#: Unit words.
UNITS = (
    "%|kg|g|mg|lbs?|pounds?|ounces?|tons?|km|m|cm|mm|miles?|feet|foot|inch|inches|yards?|l|ml|lit(?:er|re)s?"
    "|seconds?|minutes?|hours?|days?|weeks?|months?|years?|mph|kmh|dollars?|euros?|cents?|degrees?"
)
SEPARATORS = f"[^\\\\p{{L}}\\\\p{{M}}\\\\p{{N}}{NAME}-{UNIT}]+"

# a capital letter before a small one, inside a sentence, begins a name
MARK_NAMES = r"(?<=[^\\s.!?:;][ \\t])(?=\\p{Lu}\\p{Ll})"
MARK_NUMBERS = r"\\b\\d+(?:[.,:/]\\d+)*"
MARK_UNITS = rf"({NUMBER}\\d+)\\s?((?:{UNITS})(?![\\p{{L}}\\p{{N}}]))"


def _words(text: str) -> str:
    """SQL for the words of a text, lower case, slots marked and with their values."""
    digits = f"regexp_replace({text}, '{MARK_NUMBERS}', '{NUMBER}$0')"
    # separators inside a number go, so that it stays one word
    joined = f"regexp_replace({digits}, '(?<=\\\\d)[.,:/](?=\\\\d)', '')"
    units = f"regexp_replace({joined}, '{MARK_UNITS}', '$1 {UNIT}$2')"
    names = f"regexp_replace({units}, '{MARK_NAMES}', '{NAME}')"
    return f"filter(split(lower({names}), '{SEPARATORS}'), w -> w <> '')"


def _hashes(words: str) -> str:
    slot = f"left(w, 1) BETWEEN '{NAME}' AND '{UNIT}'"
    return f"transform({words}, w -> xxhash64(IF({slot}, left(w, 1), w)))"


def _doubled(of: str, by: int) -> str:
    """Hashes of runs twice as long, from those of runs of `by` words."""
    return f"zip_with({of}, slice({of}, {by + 1}, size({of})), (a, b) -> xxhash64(a, b))"


def _let(name: str, value: str, body: str) -> str:
    """SQL for `body` with `name` standing for `value`, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _windows(hashes: str) -> str:
    """SQL for the hashes of words, h, and of windows, w4 and w8."""
    made = (
        "named_struct('h', h, 'w4', slice(w4, 1, greatest(size(h) - 3, 0)),"
        f" 'w8', slice({_doubled('w4', 4)}, 1, greatest(size(h) - 7, 0)))"
    )
    made = _let("w4", _doubled("w2", 2), made)
    made = _let("w2", _doubled("h", 1), made)
    return _let("h", hashes, made)


def templates(rows: DataFrame, text: str = "text", own: bool = True) -> DataFrame:
    """`rows` with `t`: words, hashes of template words and, if asked for, of the words themselves."""
    made = f"'words', words, 'template', {_windows(_hashes('words'))}"
    if own:
        made += f", 'own', {_windows('transform(words, w -> xxhash64(w))')}"
    return rows.withColumn("t", F.expr(_let("words", _words(f"coalesce({text}, '')"), f"named_struct({made})")))


def _items(benchmark: DataFrame) -> DataFrame:
    """Readings of items that can be found: words, hashes and windows, by `key`."""
    literal = f"filter(slice(words, i, {{0}}), w -> NOT (left(w, 1) BETWEEN '{NAME}' AND '{UNIT}'))"
    usable = f"filter(sequence(1, size(windows)), i -> size({literal}) >= {MIN_LITERALS})"
    readings = f"IF(text RLIKE '^\\\\s*\\\\p{{Lu}}\\\\p{{Ll}}', array(text, concat('{NAME}', regexp_replace(text, '^\\\\s+', ''))), array(text))"
    return (
        templates(benchmark.select("item_id", F.posexplode(F.expr(readings)).alias("reading", "text")))
        .select(F.struct("item_id", "reading").alias("key"), "t.*")
        .where(f"size(words) >= {SHORT_WINDOW}")
        .withColumn("width", F.expr(f"IF(size(words) >= {WINDOW}, {WINDOW}, {SHORT_WINDOW})"))
        .withColumn("windows", F.expr("IF(width = 8, template.w8, template.w4)"))
        .withColumn("usable", F.expr(usable.format("width")))
        .withColumn("exact", F.expr("size(usable) = 0"))
        .withColumn("windows", F.expr("IF(NOT exact, windows, IF(width = 8, own.w8, own.w4))"))
        .withColumn("usable", F.expr("IF(NOT exact, usable, sequence(1, size(windows)))"))
        .selectExpr(
            "key",
            "words AS item_words",
            "IF(exact, own.h, template.h) AS item_h",
            "width",
            "exact",
            "windows AS item_places",
            "array_distinct(transform(usable, i -> windows[i - 1])) AS item_windows",
        )
    )


def _sieve(windows: DataFrame) -> bytes:
    """Which remainders the windows of the index have: most others need no join."""
    rows = windows.selectExpr(f"INT(pmod(window, {SIEVE})) AS r").distinct().collect()
    marks = bytearray(SIEVE)
    for row in rows:
        marks[row["r"]] = 1
    return bytes(marks)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """doc_id, item_id, coverage, slots, verbatim of every document that holds an item."""
    items = written(_items(benchmark), "items")
    windows = items.selectExpr("key", "size(item_windows) AS total", "explode(item_windows) AS window")
    index = Lookup(windows.groupBy("window").agg(F.collect_list(F.struct("key", "total")).alias("holders")))
    texts = docs.select("doc_id", "text")
    kinds = items.select("exact", "width").distinct().collect()
    widths = [f"t.{'own' if row['exact'] else 'template'}.w{row['width']}" for row in kinds] or ["t.template.w8"]
    own = any(row["exact"] for row in kinds)
    sieved = f"filter(concat({', '.join(widths)}), w -> substring(sieve, INT(pmod(w, {SIEVE}) + 1), 1) = X'01')"
    found = index.join(
        templates(texts, own=own)
        .withColumn("sieve", F.lit(_sieve(windows)))
        .select("doc_id", F.explode(F.expr(f"array_distinct({sieved})")).alias("window")),
        ["window"],
        "inner",
        spread=["doc_id"],
    )
    # repeated rows add up, so none that reaches the coverage alone is missed
    pairs = (
        found.select("doc_id", F.explode("holders").alias("holder"))
        .groupBy("doc_id", "holder")
        .count()
        .where(f"count / holder.total >= {min_coverage}")
        .groupBy("doc_id")
        .agg(F.collect_list("holder.key").alias("keys"))
    )
    candidates = joined(texts, pairs, "doc_id")
    compared = (
        templates(candidates)
        .select("doc_id", "t.*", F.explode("keys").alias("key"))
        .join(items, "key")
        .withColumn("seen", F.expr("IF(exact, own, template)"))
        .withColumn("h", F.col("seen.h"))
        .withColumn("windows", F.expr("IF(width = 8, seen.w8, seen.w4)"))
        .withColumn("shared", F.expr("array_intersect(item_windows, windows)"))
    )
    # each shared window puts the words of both side by side
    shifts = (
        "array_distinct(flatten(transform(filter(sequence(1, size(windows)), p -> array_contains(shared, windows[p - 1])),"
        " p -> transform(filter(sequence(1, size(item_places)), q -> item_places[q - 1] = windows[p - 1]), q -> p - q))))"
    )
    covered = compared.withColumn("coverage", F.expr("size(shared) / size(item_windows)"))
    covered = covered.where(f"size(shared) > 0 AND coverage >= IF(exact, 1, {min_coverage})")
    aligned = covered.withColumn("shift", F.explode(F.expr(shifts))).withColumn(
        "slots",
        F.expr(
            "transform(filter(sequence(1, size(item_h)), i ->"
            f" left(item_words[i - 1], 1) BETWEEN '{NAME}' AND '{UNIT}'"
            " AND i + shift BETWEEN 1 AND size(h) AND get(item_h, i - 1) = get(h, INT(i + shift - 1))),"
            " i -> struct(get(item_words, i - 1) AS asked, get(words, INT(i + shift - 1)) AS given))"
        ),
    )
    return (
        aligned.withColumn(
            "consistent",
            F.expr(
                "IF(exact, shift >= 0 AND slice(h, shift + 1, size(item_h)) = item_h,"
                " size(array_distinct(slots)) = size(array_distinct(transform(slots, s -> s.asked))))"
            ),
        )
        .where("consistent")
        .groupBy("doc_id", F.col("key.item_id").alias("item_id"))
        .agg(
            F.max("coverage").alias("coverage"),
            F.max(F.expr("CAST(size(slots) AS BIGINT)")).alias("n_slots"),
            F.max(F.expr("forall(slots, s -> s.asked = s.given)")).alias("verbatim"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """`docs` without the documents that hold a benchmark item."""
    hit = contaminated(docs, benchmark, min_coverage).select("doc_id").distinct()
    return joined(docs, hit, "doc_id", "left_anti").select(*docs.columns)


@registered("op5_decontamination")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

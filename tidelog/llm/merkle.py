"""Merkle manifest of a dataset by a rollup of nested structs.

Every row is a leaf. The leaves of a tree (of one source) are ranked by id; a node is the
digest of up to three consecutive nodes below it, until one is left, and the roots of
the trees are the leaves of one more tree. The lowest `DIGITS` base-3 digits of a rank
stand in columns of their own, the rest names the block. A block's rows meet in one
shuffle; then the digit columns are grouped away one after the other, lowest first, and
each group becomes a struct that nests its children. So a block ends as one struct with
at most 3^6 leaves, from which one nested transform makes each leaf with the siblings on
its way up, and an explode gives the proofs out, without a join.

The tops of the blocks are the leaves of the next tier, 729 times fewer, which is rolled
up in the same way until each tree is one node. On the way back a block gets the proof
of its top, by a join of one row a block, so no struct grows with the data.

Leaves are ranked without any group in one task: sorted by range over all rows, numbered
within a partition, and the counts of the partitions before are added.

Defined results: null ids come first within their tree, a null source is a tree of its
own and the first; rows of one id are ordered by their digest, so equal rows are equal
leaves in a row; a tree of one leaf is that leaf, and a dataset of one tree has that
tree's root; an empty table has no proofs; other columns are not read, so none can clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import joined, partitions, registered, table, written

FANOUT = 3
DIGITS = 6
BLOCK = FANOUT**DIGITS
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Place within a partition, in the numbers that Spark gives rows.
PLACE_BITS = 33


NO_WAY = "CAST(array() AS array<struct<lefts: string, rights: string>>)"


def leaf_digest(values: dict[str, str] | None = None) -> str:
    """SQL for the digest of a row; `values` are expressions in place of columns."""
    parts = []
    for name in COLUMNS:
        value = f"CAST({(values or {}).get(name, name)} AS STRING)"
        parts.append(f"coalesce(concat(octet_length({value}), ':', {value}), '-')")
    return f"sha2(CAST(concat({', '.join(parts)}) AS BINARY), 256)"


def ranked(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """`rows` with `rank` from 0 within their tree and `n`, the size of the tree.

    No tree, however large, is sorted or numbered by one task.
    """
    placed = written(
        rows.repartitionByRange(partitions(rows.sparkSession), tree, *order)
        .sortWithinPartitions(tree, *order)
        .withColumn("place", F.monotonically_increasing_id()),
        "placed",
    )
    placed = placed.withColumn("part", F.shiftright("place", PLACE_BITS))
    # one row for each partition a tree lies in
    runs = placed.groupBy(tree, "part").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col(tree).alias("_tree"),
        F.col("part").alias("_part"),
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("_shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    found = joined(placed, runs, F.expr(f"{tree} <=> _tree AND part = _part"))
    return found.withColumn("rank", F.expr("place + _shift")).drop("place", "part", "_tree", "_part", "_shift")


def _levels(n: str, upto: int) -> str:
    """SQL: whether a tree of `n` leaves still has several nodes after `upto` levels."""
    return f"{n} > {FANOUT ** upto}L"


def nested_blocks(leaves: DataFrame, payload: Sequence[str]) -> DataFrame:
    """(tree, block, n, top, nest): each block of `leaves` as one struct of structs.

    `leaves` have tree, n, rank, digest and the columns of `payload`.
    """
    keys = ["tree", "n", "block"]
    digits = [f"d{i}" for i in range(DIGITS)]
    rows = leaves.selectExpr(
        "tree",
        "n",
        f"rank DIV {BLOCK} AS block",
        *[f"rank DIV {FANOUT ** i} % {FANOUT} AS d{i}" for i in range(DIGITS)],
        f"struct(digest, {', '.join(payload)}) AS node" if payload else "struct(digest) AS node",
    ).repartition("tree", "block")
    for level, digit in enumerate(digits):
        child = F.struct(F.col(digit).alias("digit"), F.col("node").alias("node"))
        # a tree that has come down to one node is not hashed any further
        digest = F.expr(
            f"IF({_levels('n', level)}, sha2(CAST(concat_ws('', transform(kids, k -> k.node.digest)) AS BINARY), 256),"
            " kids[0].node.digest)"
        )
        rows = (
            rows.groupBy(*keys, *digits[level + 1 :])
            .agg(F.array_sort(F.collect_list(child)).alias("kids"))
            .withColumn("node", F.struct(digest.alias("digest"), F.col("kids")))
            .drop("kids")
        )
    return rows.selectExpr("tree", "n", "block", "node.digest AS top", "node AS nest")


def _ways(level: int, node: str, way: str, payload: Sequence[str]) -> str:
    """SQL: the leaves below `node`, each with its siblings on the way up, lowest first."""
    kid, at = f"k{level}", f"i{level}"
    sides = (
        f"struct(concat_ws('', transform(slice({node}.kids, 1, {at}), s -> s.node.digest)) AS lefts,"
        f" concat_ws('', transform(slice({node}.kids, {at} + 2, {FANOUT}), s -> s.node.digest)) AS rights)"
    )
    here = f"concat(IF({_levels('n', level)}, array({sides}), {NO_WAY}), {way})"
    if level == 0:
        fields = ", ".join(f"{kid}.node.{name} AS {name}" for name in ("digest", *payload))
        return f"transform({node}.kids, ({kid}, {at}) -> struct({fields}, {here} AS way))"
    below = _ways(level - 1, f"{kid}.node", here, payload)
    return f"flatten(transform({node}.kids, ({kid}, {at}) -> {below}))"


def proofs(blocks: DataFrame, payload: Sequence[str]) -> DataFrame:
    """tree, digest, payload, way, top of every leaf; `way` goes on from a block's own `way`."""
    leaves = _ways(DIGITS - 1, "nest", "way", payload)
    return blocks.selectExpr("tree", "top", f"explode({leaves}) AS leaf").selectExpr("tree", "top", "leaf.*")


def tree_tops(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tops of the trees of `leaves`, and the leaves with their way to the top.

    `leaves` have tree, n, rank, digest and further columns, which are kept. The first
    frame has (tree, digest), the second the kept columns with tree, digest, way, top.
    """
    payload = [name for name in leaves.columns if name not in ("tree", "n", "rank", "digest")]
    blocks = written(nested_blocks(leaves, payload), "blocks")
    single = blocks.where(f"n <= {BLOCK}")
    if blocks.where(f"n > {BLOCK}").isEmpty():
        tops = single.selectExpr("tree", "top AS digest")
        return tops, proofs(blocks.withColumn("way", F.expr(NO_WAY)), payload)
    upper = blocks.where(f"n > {BLOCK}").selectExpr(
        "tree", f"(n + {BLOCK - 1}) DIV {BLOCK} AS n", "block AS rank", "top AS digest", "block"
    )
    upper_tops, ways = tree_tops(upper)
    ways = ways.selectExpr("tree AS _tree", "block AS _block", "way", "top AS _top")
    # one row a block, to each its nested leaves
    large = joined(blocks.where(f"n > {BLOCK}"), ways, F.expr("tree = _tree AND block = _block"))
    large = large.selectExpr("tree", "n", "block", "_top AS top", "nest", "way")
    small = single.selectExpr("tree", "n", "block", "top", "nest", f"{NO_WAY} AS way")
    tops = single.selectExpr("tree", "top AS digest").unionByName(upper_tops)
    return tops, proofs(small.unionByName(large), payload)


def manifest(docs: DataFrame, **forged: str) -> DataFrame:
    """doc_id, digest, subroot, root and way of every row.

    Further columns hold the digests of rows in which `text` is another expression.
    """
    digests = [f"{leaf_digest({'text': text})} AS {name}" for name, text in forged.items()]
    leaves = written(docs.selectExpr("doc_id", "source", f"{leaf_digest()} AS digest", *digests), "leaves")
    ordered = written(ranked(leaves, "source", ["doc_id", "digest"]), "ranked")
    # sources in order are the leaves of the last tree; their rank there stands for them
    sources = ordered.select("source").distinct().withColumn("one", F.lit(0))
    numbers = ranked(sources, "one", ["source"]).selectExpr("source AS _source", "rank AS tree")
    rows = joined(ordered, numbers, F.expr("source <=> _source")).drop("source", "_source")
    tops, ways = tree_tops(rows)
    tops = written(tops, "tops")
    last = tops.selectExpr("0L AS tree", f"{tops.count()}L AS n", "tree AS rank", "digest", "tree AS own")
    _, root_ways = tree_tops(last)
    root_ways = root_ways.selectExpr("own AS _own", "way AS _way", "top AS root")
    return (
        joined(ways, root_ways, F.expr("tree = _own"))
        .withColumn("way", F.concat("way", "_way"))
        .withColumnRenamed("top", "subroot")
        .drop("tree", "_own", "_way")
    )


def siblings_digest() -> str:
    """SQL: the digest of all siblings of a way, from the leaf up and left to right."""
    return "sha2(CAST(concat_ws('', transform(way, s -> concat(s.lefts, s.rights))) AS BINARY), 256)"


def folded(leaf: str) -> str:
    """SQL: the root that a leaf's digest and its way lead to."""
    return f"aggregate(way, {leaf}, (d, s) -> sha2(CAST(concat(s.lefts, d, s.rights) AS BINARY), 256))"


def _crc32_sql(text: str) -> str:
    """DuckDB SQL: unsigned CRC-32 of ASCII text."""
    # Fixed value: the polynomial, bits reversed
    step = "list_reduce([xor(a, b)] || [0::UBIGINT for z in range(8)], lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))"
    chars = f"[ascii({text}[i])::UBIGINT for i in range(1, length({text}) + 1)]"
    return f"xor(list_reduce([4294967295::UBIGINT] || {chars}, lambda a, b: {step}), 4294967295::UBIGINT)"


def _oracle(levels: int = 14) -> str:
    """DuckDB SQL for up to 3^14 leaves a source and as many sources, one level after the other."""
    def leaf(text):
        values = [f"CAST({name if name != 'text' else text} AS VARCHAR)" for name in COLUMNS]
        return f"sha256(concat({', '.join(f'''coalesce(concat(strlen({v}), ':', {v}), '-')''' for v in values)}))"

    def up(name, rows, keys):
        """The nodes of all trees, one level after the other."""
        ctes = [f"{name}0 AS MATERIALIZED ({rows})"]
        for level in range(1, levels + 1):
            below = f"{name}{level - 1}"
            ctes.append(
                f"{name}{level} AS MATERIALIZED (SELECT {keys}, i // 3 AS i, IF(any_value(n) > 1, sha256(string_agg(h, '' ORDER BY i)),"
                f" any_value(h)) AS h, (any_value(n) + 2) // 3 AS n FROM {below} GROUP BY {keys}, i // 3)"
            )
        return ctes

    forged = "replace(text, chr(10), '')"
    ctes = [
        "docs AS MATERIALIZED (SELECT *, coalesce(" + _crc32_sql("CAST(doc_id AS VARCHAR)") + " % 2 = 0, false) AS bad FROM documents)",
        f"leaves AS (SELECT doc_id, source, {leaf('text')} AS h, IF(bad, {leaf(forged)},"
        f" {leaf('text')}) AS forged FROM docs)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i,"
        " count(*) OVER (PARTITION BY source) AS n,"
        " dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves)",
        *up("t", "SELECT tree, i, h, n FROM placed", "tree"),
        f"tops AS (SELECT tree AS i, h, count(*) OVER () AS n, 0 AS tree FROM t{levels})",
        *up("r", "SELECT tree, i, h, n FROM tops", "tree"),
    ]
    ways = ["w0 AS MATERIALIZED (SELECT *, forged AS g, '' AS w FROM placed)"]
    for tree, key, row in (("t", "w.tree", "w.i"), ("r", "0", "w.tree")):
        for level in range(levels):
            near = f"SELECT tree AS k, i // 3 AS up, list(h ORDER BY i) AS hs, any_value(n) AS m FROM {tree}{level} GROUP BY ALL"
            own = f"({row} // {3 ** level} % 3)"
            lefts, rights = f"array_to_string(hs[1:{own}], '')", f"array_to_string(hs[{own} + 2:], '')"
            ways.append(
                f"w{len(ways)} AS MATERIALIZED (SELECT w.* EXCLUDE (w, g), IF(m > 1, sha256(concat({lefts}, g, {rights})), g) AS g,"
                f" IF(m > 1, concat(w, {lefts}, {rights}), w) AS w FROM w{len(ways) - 1} w JOIN ({near}) s"
                f" ON {key} = s.k AND {row} // {3 ** (level + 1)} = s.up)"
            )
    return (
        f"WITH {', '.join(ctes + ways)} SELECT w.doc_id, w.h AS leaf, t.h AS subroot, r.h AS root, sha256(w.w) AS proof_sha256,"
        f" w.g AS folded_root, w.g = r.h AS verified FROM w{len(ways) - 1} w"
        f" JOIN t{levels} t ON w.tree = t.tree CROSS JOIN r{levels} r"
    )


@registered("op11_merkle_manifest", _oracle())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 2 = 0, replace(text, '\\n', ''), text)"
    return manifest(table(spark, sf_dir, "documents"), forged=tampered).selectExpr(
        "doc_id",
        "digest AS leaf",
        "subroot",
        "root",
        f"{siblings_digest()} AS proof_sha256",
        f"{folded('forged')} AS folded_root",
        f"{folded('forged')} = root AS verified",
    )

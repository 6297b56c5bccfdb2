"""The Merkle manifest against trees built one by one."""

import hashlib
import random
import zlib

import duckdb
import pytest

from tidelog.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, rank int, n string, tree string, digest string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    values = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return h(*values)


def ways(nodes):
    """Root of the nodes, and for each its (lefts, rights) by level."""
    found = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, above_members = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for k in range(len(run)):
                for i in members[at + k]:
                    found[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(h(*run))
            above_members.append([i for m in members[at : at + 3] for i in m])
        nodes, members = above, above_members
    return nodes[0] if nodes else None, found


def expected(rows):
    out, trees = [], {}
    for row in rows:
        trees.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    tops, inner = [], {}
    for source in order:
        trees[source].sort(key=lambda x: x[:3])
        inner[source] = ways([x[2] for x in trees[source]])
        tops.append(inner[source][0])
    root, outer = ways(tops)
    for source, top, outside in zip(order, tops, outer):
        for (_, _, digest, row), way in zip(trees[source], inner[source][1]):
            forged = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                forged = (*row[:4], row[4].replace("\n", ""))
            node = leaf(forged)
            for left, right in way + outside:
                node = h(left, node, right)
            proof = h(*[a + b for a, b in way + outside])
            out.append((row[0], digest, top, root, proof, node, node == root))
    return sorted(map(repr, out))


def found(spark, tmp_path, rows):
    full = [(*row, 1, "n", "t", "d") for row in rows]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(full, SCHEMA).repartition(4).write.parquet(path)
    return sorted(repr(tuple(row)) for row in merkle.op11_merkle_manifest(spark, str(tmp_path)).collect())


def some(n, sources, seed=0):
    pick = random.Random(seed)
    texts = ["a\nb", "a", "", None, "é\n", "x" * 50_000, "line\n" * 3]
    return [
        (pick.choice([i, i, i, None, 5]), pick.choice(sources), pick.choice(["en", None]), pick.choice([3, None]), pick.choice(texts))
        for i in range(n)
    ]


@pytest.mark.parametrize("n, sources", [(0, ["a"]), (1, [None]), (4, ["a"]), (40, ["a", None, "é", "Z"]), (90, list("abcdefghijklmnop"))])
def test_small_trees(spark, tmp_path, n, sources):
    rows = some(n, sources)
    assert found(spark, tmp_path, rows) == expected(rows)


def test_several_tiers(spark, tmp_path, monkeypatch):
    """Blocks of nine leaves, a hot source that takes four tiers, and one that ends in its block."""
    monkeypatch.setattr(merkle, "DIGITS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = some(820, ["hot", "hot", "hot", "hot", "b", None], 3) + [(1, "alone", None, None, "t\n")]
    rows += [(i, f"s{i}", "en", 1, "a\nb") for i in range(30)]
    assert found(spark, tmp_path, rows) == expected(rows)


def test_repeated_rows(spark, tmp_path):
    rows = [(7, "a", "en", 3, "same\n")] * 31
    assert found(spark, tmp_path, rows) == expected(rows)


def test_against_sql(spark, documents):
    sf = "/root/testdata/sf0.001"
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    wanted = database.execute(merkle._oracle()).fetchall()
    rows = merkle.op11_merkle_manifest(spark, sf).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, wanted))
    assert {row["verified"] for row in rows} == {True, False}

"""N-gram join, line dedup, components and substring dedup against plain models."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidelog.llm import line_dedup, ngram_join, substring_dedup
from tidelog.llm.components import components

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "so", "ti") for b in ("ba", "do", "fe", "gu", "ni", "po", "Ra", "zé")]


def corpus(seed, n=60):
    """Random texts with copies, near copies, shared passages and odd rows."""
    rng = random.Random(seed)
    text = lambda words: " ".join(rng.choice(WORDS) for _ in range(words))
    bases = ["\n".join(text(rng.randint(4, 40)) for _ in range(rng.randint(1, 5))) for _ in range(n // 6)]
    passage = text(60)
    rows = []
    for i in range(n):
        words = rng.choice(bases).split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        made = " ".join(words)
        if rng.random() < 0.2:
            made = text(10) + " " + passage + " " + made
        rows.append((i, made))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "only three words"), (n + 4, "only three words"), (n + 5, "ONLY three  words")]


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join(frame, seed):
    rows = corpus(seed)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.linked_documents(frame(rows)).collect()}
    assert found == brute.linked(rows)


def test_ngram_join_open_trees(frame, monkeypatch):
    """A chain of near copies, in which leaders do not reach all, with tiny pages."""
    monkeypatch.setattr(ngram_join, "PAGE", 4)
    monkeypatch.setattr(ngram_join, "BOX", 2)
    rng = random.Random(5)
    words, rows = [rng.choice(WORDS) for _ in range(120)], []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words[rng.randrange(120)] = f"w{i}"
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.linked_documents(frame(rows)).collect()}
    assert found == {doc: component for doc, (_, component) in brute.linked(rows).items()}


def test_ngram_join_odd_rows(frame, spark):
    assert ngram_join.linked_documents(frame([])).collect() == []
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, None), (3, "x " * 20000)]
    found = sorted(map(tuple, ngram_join.linked_documents(frame(rows)).collect()), key=str)
    assert found == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 2, 1), (None, 0, None), (3, 1, 3)], key=str)


def test_bound_holds():
    """Summed minima of points never lie below the overlap."""
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 400, 300, dtype=np.uint64) << np.uint64(55)) for _ in range(2))
        pa, pb = (ngram_join._points([ngram_join._point(x)])[0].astype(int) for x in (a, b))
        assert np.minimum(pa, pb).sum() >= len(np.intersect1d(a, b))
        assert ngram_join._fine_room(ngram_join._fine(a), ngram_join._fine(b)) >= len(np.intersect1d(a, b))


def test_sets_are_compared_whole():
    """Hashes that agree in their first bits are different shingles."""
    a = np.arange(1, 6, dtype=np.uint64)
    b = a + (np.uint64(1) << np.uint64(20))
    assert not ngram_join._linked(a.tobytes(), b.tobytes())
    assert ngram_join._linked(a.tobytes(), a.tobytes()) and ngram_join._linked(a.tobytes(), a[:4].tobytes())


@pytest.mark.parametrize("step", [1, 2, 3, 100])
def test_trees(step):
    """Members and pages, wherever batches end."""
    s = np.array([1, 2, 2, 3, 3, 3, 3, 3, 4, 5, 5])
    table = pa.RecordBatch.from_arrays([pa.array(s), pa.array(np.arange(11)), pa.array(np.arange(11))], names=["s", "doc_id", "n"])
    empty = table.slice(0, 0)
    batches = [empty, *(table.slice(i, step) for i in range(0, 11, step)), empty]
    rows = [tuple(r.values()) for b in ngram_join._trees(iter(batches)) for r in b.to_pylist()]
    assert [(a, d, p) for a, d, _, p in rows] == [(v, i, 0) for i, v in enumerate(s) if v not in (1, 4)]
    assert list(ngram_join._trees(iter([empty]))) == []


@pytest.mark.parametrize("step", [1, 2, 3, 100])
def test_trees_fall_apart_by_size(step):
    """Members of sizes that no link spans are in trees of their own, wherever batches end."""
    s = np.array([1, 1, 1, 2, 2, 2, 2, 2, 3, 3])
    n = np.array([10, 13, 14, 80, 100, 126, 140, 300, 80, 101])
    table = pa.RecordBatch.from_arrays([pa.array(s), pa.array(np.arange(10)), pa.array(n)], names=["s", "doc_id", "n"])
    parted = ngram_join._parted(iter([table.slice(0, 0), *(table.slice(i, step) for i in range(0, 10, step))]))
    trees = {}
    for batch in ngram_join._trees(parted):
        for r in batch.to_pylist():
            trees.setdefault(r["s"], []).append(r["doc_id"])
    assert sorted(trees.values()) == [[1, 2], [3, 4], [5, 6]]


def test_trees_of_the_same_members_count_once(spark):
    rows = [(s, doc, 50, 0) for s, docs in [(1, "AB"), (2, "AB"), (3, "ABC"), (4, "AAC"), (5, "BBC"), (6, "CBA")] for doc in map(ord, docs)]
    found = ngram_join._different(spark.createDataFrame(rows, ngram_join.MEMBERS)).collect()
    assert sorted({r["s"] for r in found}) == [1, 3, 4, 5] and len(found) == 11


def test_ngram_join_few_and_many(frame, monkeypatch):
    """Trees of few documents take no rounds with leaders; passages and groups of many lose no link."""
    rng = random.Random(7)
    text = lambda words: [rng.choice(WORDS) for _ in range(words)]
    passage, group, rows = text(30), text(90), []
    for i in range(ngram_join.FEW + 20):
        rows.append((len(rows), " ".join(passage + text(60))))
        rows.append((len(rows), " ".join(f"w{i}" if j == 3 * i % 90 else word for j, word in enumerate(group))))
    for _ in range(15):
        pair = text(50)
        rows += [(len(rows), " ".join(pair)), (len(rows) + 1, " ".join(pair[3:]))]
    rounds, members = ngram_join._rounds, []
    monkeypatch.setattr(ngram_join, "_rounds", lambda *args: (members.append(args[0].select("doc_id").distinct().count()), rounds(*args))[1])
    for part in (rows, rows[-30:]):
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.linked_documents(frame(part)).collect()}
        assert found == brute.linked(part)
    assert members[0] > 0 and members[1] == 0


def test_frequent_shingles_come_last(frame, spark):
    """Those that more than `FEW` documents have early, however many documents there are; the rarer first."""
    often, seldom = ([f"{w}{i}" for i in range(40)] for w in "ab")
    rows = [(i, " ".join([f"x{i}", *often])) for i in range(3 * ngram_join.FEW)] + [(1000 + i, " ".join([f"y{i}", *seldom])) for i in range(ngram_join.FEW)]
    found, times = ngram_join.frequent_shingles(frame(rows).selectExpr("doc_id", "text"))
    a, b = (set(ngram_join.shingles(" ".join(x)).tolist()) for x in (often, seldom))
    assert len(found) and list(found) == sorted(found) and set(found.tolist()) <= a and set(times) <= set(range(ngram_join.FEW + 1, 3 * ngram_join.FEW + 1))
    frequent, counts = np.array([3, 5, 9], np.uint64), np.array([40, 90, 35], np.uint32)
    ordered = ngram_join._ordered(np.arange(2, 11, dtype=np.uint64), frequent, counts)
    assert ordered.tolist() == [2, 4, 6, 7, 8, 10, 9, 3, 5]
    assert len(ngram_join.frequent_shingles(frame([(1, None)]).selectExpr("doc_id", "text"))[0]) == 0


@pytest.mark.parametrize("step", [1, 7, 33, 500])
def test_trees_are_dealt(step):
    """Pairs of small trees and members of large ones, wherever batches end."""
    sizes = [1, 2, ngram_join.FEW, ngram_join.FEW + 1, 3, 100, 2, 1]
    s = np.repeat(np.arange(len(sizes)), sizes)
    columns = [pa.array(x) for x in (s, np.arange(len(s)), np.full(len(s), 50), np.zeros(len(s), np.int64))]
    table = pa.RecordBatch.from_arrays(columns, names=["s", "doc_id", "n", "at"])
    batches = [table.slice(0, 0), *(table.slice(i, step) for i in range(0, len(s), step)), table.slice(0, 0)]
    rows = [tuple(r.values()) for b in ngram_join._dealt(iter(batches)) for r in b.to_pylist()]
    few, many = ([i for i, size in enumerate(sizes) if (size > ngram_join.FEW) == large] for large in (False, True))
    assert sorted(r[:2] for r in rows if r[3] is None) == [(t, d) for d, t in enumerate(s) if t in many]
    pairs = [(t, b, a) for t in few for a in np.flatnonzero(s == t) for b in np.flatnonzero(s == t) if a < b]
    assert sorted((t, u, v) for t, u, _, v in rows if v is not None) == sorted(pairs)
    assert list(ngram_join._dealt(iter([table.slice(0, 0)]))) == []


def test_late_shingles_make_no_pairs():
    """A pair is left out only where its sets, sharing no earlier shingle, can't be linked."""
    rng = np.random.default_rng(6)
    kept = 0
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 40, rng.integers(15, 120)).astype(np.uint64)) for _ in range(2))
        prefixes = [x[: ngram_join._prefix_size(len(x))].tobytes() for x in (a, b)]
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([len(a), len(b)]), pa.array(prefixes)], names=["doc_id", "n", "prefix"])
        entries = pa.Table.from_batches(ngram_join._entries([batch])).sort_by([("s", "ascending"), ("n", "ascending")]).to_batches()
        pairs = sum(len(x) for x in ngram_join._dealt(ngram_join._parted(iter(entries))))
        linked = ngram_join._linked(a.tobytes(), b.tobytes())
        kept += linked
        assert pairs or not linked
    assert 0 < kept < 300
    far = [pa.array(x) for x in ([1, 1], [1, 2], [50, 50], [6, 0])]
    assert list(map(len, ngram_join._dealt(iter([pa.RecordBatch.from_arrays(far, names=["s", "doc_id", "n", "at"])])))) in ([], [0])


def test_middle_points_bound_the_overlap():
    """Large sets that have nothing in common are told apart, and no link is lost."""
    rng = np.random.default_rng(4)
    for size in (100, 1100, 9000):
        a, b = (np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64)) for _ in range(2))
        near = np.unique(np.append(a[: -size // 10], b[: size // 10]))
        assert ngram_join._linked(a.tobytes(), near.tobytes())
        middle = [ngram_join._middle(x) for x in (a, b, near)]
        assert ngram_join._middle_fits(middle[0], middle[2])
        assert ngram_join._middle_fits(middle[0], middle[1]) == (size < ngram_join.LARGE)


def test_needed_overlap():
    for a in range(1, 60):
        for b in range(1, 60):
            least = next((s for s in range(min(a, b) + 1) if 100 * s >= 80 * (a + b - s)), None)
            if least is not None:
                assert ngram_join.needed_overlap(a, b) == least


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(50)] + [(300, i) for i in range(301, 340)]
    sets = brute.Sets()
    for a, b in links:
        sets.join(a, b)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: sets.root(x) for x in linked}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_components_later_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(90), rng.randrange(90)) for _ in range(75)] + [(100, i) for i in range(101, 120)]
    sets, found = brute.Sets(), None
    for part in (links[::3], links[1::3], [], links[2::3]):
        for a, b in part:
            sets.join(a, b)
        found = components(spark.createDataFrame(part, "u long, v long"), found)
    rows = [(r["node"], r["component"]) for r in found.collect()]
    assert len(rows) == len(set(rows))
    assert dict(rows) == {x: sets.root(x) for x in {x for a, b in links if a != b for x in (a, b)}}


def test_components_of_stars_take_no_round(spark, monkeypatch):
    monkeypatch.setattr("tidelog.llm.components._round", None)
    stars = spark.createDataFrame([(i, i % 3) for i in range(3, 40)], "u long, v long")
    found = components(stars)
    # once contracted, later links are a star again
    more = components(spark.createDataFrame([(31, 30), (35, 30), (50, 33)], "u long, v long"), found)
    assert {(r["node"], r["component"]) for r in found.collect()} == {(i, i % 3) for i in range(40)}
    assert {tuple(r) for r in more.select("node", "component").collect()} == {(i, 0) for i in [*range(40), 50]}


def test_line_dedup_gives_lines_back_before_bands(frame, monkeypatch):
    """Between the shuffle of all lines and that of the bands, dropped frames are handed over and released."""
    steps = []

    class Reached(Exception):
        pass

    def bands(classes):
        steps.append("bands")
        raise Reached

    monkeypatch.setattr(line_dedup, "release", lambda spark, wait: steps.append(wait))
    monkeypatch.setattr(line_dedup, "_bands", bands)
    with pytest.raises(Reached):
        line_dedup.similar_lines(frame([(1, "a line of some words\nanother line")]))
    assert steps == [line_dedup.HANDED_OVER, "bands"]


@pytest.mark.parametrize("seed", [3, 4])
def test_line_dedup(frame, seed):
    rows = corpus(seed, 40)
    docs = frame(rows)
    gone = brute.removed_lines(rows)
    found = {r["doc_id"]: set(r["removed"]) for r in line_dedup.removed_lines(docs).collect()}
    # bands miss a pair at the threshold now and then
    missed = sum(len(gone[d] ^ found.get(d, set())) for d in gone)
    assert missed <= 0.02 * sum(map(len, gone.values()))
    kept = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    for doc, text in rows:
        if text is None:
            assert kept[doc] is None
        else:
            lines = text.split("\n")
            assert kept[doc] == "\n".join(x for i, x in enumerate(lines) if i not in found.get(doc, set()))


def grams(line):
    return {line[i : i + 8] for i in range(max(1, len(line) - 7))}


def test_line_dedup_reads_whole_lines(frame):
    han = [chr(0x4E00 + i) for i in range(400)]
    lines = [
        # equal in the first eight characters of each word, different behind
        "".join(han[:60]), "".join(han[:8] + han[100:150]), "".join(han[:8] + han[200:250]),
        "https://a.example/one/page", "https://b.sample/another", "https://c.test/third-one",
        "from 2021-01-01 to 2021-01-02", "from 2021-01-17 to 2021-01-29",
        "internationalisation", "internationalists", "short", "shorter", "shorn", "x", "\U0001f600" * 5,
        "\U0001f600" * 20 + "\U0001f601" * 20 + "\U0001f602" * 20, "\U0001f602" * 20 + "\U0001f600" * 20 + "\U0001f601" * 20,
        # near copies without spaces, and equal lines
        "".join(han[300:400]), "".join(han[300:399]) + "x", "x", "short", "internationalists",
    ]
    first, gone = brute.Sets(), set()
    for a in lines:
        for b in lines:
            if brute.similar(grams(a), grams(b)):
                first.join(lines.index(a), lines.index(b))
    for i, line in enumerate(lines):
        if first.root(lines.index(line)) != i:
            gone.add(i)
    found = line_dedup.removed_lines(frame([(1, "\n".join(lines))])).collect()
    assert gone == set(found[0]["removed"]) and gone >= {18, 19, 20, 21}
    # documents whose one line begins alike all stay
    docs = frame([(i, "".join(han[:8] + han[20 * i : 20 * i + 40])) for i in range(1, 12)])
    assert line_dedup.removed_lines(docs).collect() == []


def test_line_dedup_all_grams(frame, monkeypatch):
    rows = corpus(4, 40)
    monkeypatch.setattr(brute, "line_shingles", grams)
    gone = brute.removed_lines(rows)
    found = {r["doc_id"]: set(r["removed"]) for r in line_dedup.removed_lines(frame(rows)).collect()}
    assert sum(len(gone[d] ^ found.get(d, set())) for d in gone) <= 0.02 * sum(map(len, gone.values()))


def test_line_signatures():
    """A line's bands don't depend on the lines beside it, and near copies meet as often as they should."""
    lines = ["abc", "12345678", "123456789", "a b\r\u2028 c d e f g", "x\U0001f600\U0001f601yz\U00020000abc\U0001f600\U0001f600d", "q" * 50_000]
    for line in lines:
        assert line_dedup.line_shingles(line) == frozenset(grams(line))
    for alone, together in zip(zip(*map(line_dedup.signatures, [[line] for line in lines])), line_dedup.signatures(lines)):
        assert all((one[0] == row).all() for one, row in zip(alone, together))
    rng = random.Random(6)
    met = {True: [], False: []}
    for _ in range(400):
        line = "".join(rng.choice("abcdefgh ") for _ in range(rng.choice([60, 200, 900])))
        for edits, near in ((1, True), (len(line) // 12, False)):
            other = list(line)
            for place in rng.sample(range(len(line)), edits):
                other[place] = "#"
            a, b = grams(line), grams("".join(other))
            if (len(a & b) / len(a | b) >= 0.8) is near:
                bands, minima = line_dedup.signatures([line, "".join(other)])
                apart = (minima[0].view("uint8") != minima[1].view("uint8")).sum()
                met[near].append(bool((bands[0] == bands[1]).any()) and apart <= line_dedup.MOST_APART)
    assert sum(met[True]) >= 0.98 * len(met[True]) > 100
    assert sum(met[False]) <= 0.1 * len(met[False])


def test_line_minima_apart(spark):
    """What SQL counts between two sketches are the bytes that differ."""
    rng = np.random.default_rng(2)
    a = rng.integers(0, 256, (50, 8 * line_dedup.SKETCH_WORDS), np.uint8)
    b = np.where(rng.random(a.shape) < 0.4, rng.integers(0, 256, a.shape, np.uint8), a)
    rows = [(i, x.view(np.int64).tolist(), y.view(np.int64).tolist()) for i, (x, y) in enumerate(zip(a, b))]
    found = spark.createDataFrame(rows, "i int, a array<bigint>, b array<bigint>").selectExpr("i", f"{line_dedup._apart('a', 'b')} AS n")
    assert {r["i"]: r["n"] for r in found.collect()} == dict(enumerate((a != b).sum(axis=1).tolist()))


def test_line_dedup_odd_rows(spark, frame):
    assert line_dedup.removed_lines(frame([])).collect() == []
    rows = [(1, "one line here\n\none line here"), (1, "one line here"), (2, None), (3, "")]
    found = {r["doc_id"]: r["removed"] for r in line_dedup.removed_lines(frame(rows[:1] + rows[2:])).collect()}
    assert found == {1: [2]}
    assert line_dedup.dedup_lines(frame(rows)).columns == frame(rows).columns


def kept_texts(docs):
    return sorted(line_dedup.dedup_lines(docs).select("doc_id", "text").collect(), key=str)


def test_line_dedup_repeated_and_null_ids(spark, frame):
    """Rows of one id keep what only they have; a missing id comes first."""
    rows = [(1, "shared line of both\nonly in the first row"), (1, "only in the second row\nshared line of both")]
    kept = [r["text"] for r in kept_texts(frame(rows))]
    assert sorted("\n".join(kept).split("\n")) == ["only in the first row", "only in the second row", "shared line of both"]
    rows = [(None, "a line to be found twice"), (4, "a line to be found twice\nand one more")]
    assert [tuple(r) for r in kept_texts(frame(rows))] == [(4, "and one more"), (None, "a line to be found twice")]
    same = [(7, "equal rows\nequal in all")] * 3 + [(8, "equal rows\nnot here")]
    assert [tuple(r) for r in kept_texts(frame(same))] == [(7, "equal rows\nequal in all")] * 3 + [(8, "not here")]


def test_line_dedup_clashing_names(spark):
    names = ["_gone_doc", "_doc", "__lines", "k", "component", "removed", "text_md5", "line_no"]
    docs = spark.createDataFrame([(i, "the same line of text", *names) for i in (1, 2)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    found = line_dedup.dedup_lines(docs).orderBy("doc_id").collect()
    assert [r["text"] for r in found] == ["the same line of text", ""]
    assert all(r[n] == n for r in found for n in names)


def test_line_dedup_far_lines_do_not_meet(spark, frame, monkeypatch):
    """Lines that share a part only are hardly ever compared: pairs grow like the lines."""
    rng = random.Random(3)
    centre = "".join(rng.choice("abcdefghijkl ") for _ in range(120))
    lines = []
    for _ in range(400):
        other = list(centre)
        for place in rng.sample(range(120), 9):
            other[place] = rng.choice("0123456789")
        lines.append("".join(other))
    pairs = []
    verified = line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda p, c: pairs.append(p.count()) or verified(p, c))
    line_dedup.removed_lines(frame([(i, line) for i, line in enumerate(lines)])).collect()
    assert sum(pairs) < 0.1 * 400 * 399 / 2


def test_line_dedup_copies_edited_alike_do_not_pair(frame, monkeypatch):
    """Copies of one line, each edited in its own way to a similarity of 0.7, leave no square of pairs."""
    rng = random.Random(8)
    centre = "".join(rng.choice("abcdefghijkl ") for _ in range(200))
    lines = []
    for i in range(300):
        other = list(centre)
        for place in (8 + i * 7 % 80, 100 + i * 11 % 90):
            other[place] = chr(0x4E00 + i)
        lines.append("".join(other))
    rows = [(i, line) for i, line in enumerate(lines)]
    found, open_pairs = [], line_dedup._open_pairs

    def counted(*frames):
        pairs = open_pairs(*frames)
        found.append(pairs.count())
        return pairs

    monkeypatch.setattr(line_dedup, "_open_pairs", counted)
    gone = {r["doc_id"] for r in line_dedup.removed_lines(frame(rows)).collect()}
    assert sum(found) < 0.05 * 300 * 299 / 2
    exact = {doc for doc, numbers in brute.removed_lines(rows).items() if numbers}
    assert gone <= exact and len(exact - gone) <= 0.02 * len(rows)


def test_line_parities():
    """Bits that differ are never more than the shingles that one line only has."""
    rng = random.Random(4)
    for size in (3, 8, 60, 700, 5000):
        line = "".join(rng.choice("abcdefgh ") for _ in range(size))
        other = list(line)
        for place in rng.sample(range(size), size // 20):
            other[place] = "#"
        pair = [line, "".join(other)]
        sets = [grams(x) for x in pair]
        n, odd = line_dedup.parities(pair)
        apart = np.bitwise_count((odd[0] ^ odd[1]).view(np.uint64)).sum()
        assert n.tolist() == list(map(len, sets)) and apart <= len(sets[0] ^ sets[1])
        assert (odd[1] == line_dedup.parities(pair[1:])[1][0]).all()


def test_line_places_digest_each_text_once(frame):
    """The digest of a text is below the rows of its lines, not worked out again for each of them."""
    plan = line_dedup.lines_of(frame([(1, "a\nb")]))._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate")]
    assert "md5(cast(text" not in above and "md5(cast(text" in plan


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup(frame, seed):
    rows = corpus(seed)
    found = {tuple(r)[0]: tuple(r)[1:4] for r in substring_dedup.dedup_substrings(frame(rows)).collect()}
    assert found == {doc: x[:3] for doc, x in brute.without_repeats(rows).items()}


def test_substring_dedup_within_texts(frame, monkeypatch):
    """Periodic texts, pieces of long texts, multi-byte characters and aggregated strings."""
    monkeypatch.setattr(substring_dedup, "PIECE", 300)
    rng = random.Random(9)
    unique = "".join(rng.choice("abcdé ") for _ in range(900))
    rows = [(1, "a" * 500), (2, unique + unique), (3, "é" * 120), (4, unique[100:400] + "x" + unique[50:350]), (5, "ab" * 60), (6, "b" * 99)]
    for block in (2048, 0):
        monkeypatch.setattr(substring_dedup, "BLOCK", max(block, 1) if block else 0)
        if not block:
            monkeypatch.setattr(substring_dedup, "BLOCK", 1)
        found = {tuple(r)[0]: tuple(r)[1:4] for r in substring_dedup.dedup_substrings(frame(rows)).collect()}
        assert found == {doc: x[:3] for doc, x in brute.without_repeats(rows).items()}


def test_substring_dedup_odd_rows(frame):
    assert substring_dedup.dedup_substrings(frame([])).collect() == []
    long = " ".join(WORDS)
    rows = [(None, long), (1, long), (2, None), (7, long), (7, long)]
    found = sorted((tuple(r)[:4] for r in substring_dedup.dedup_substrings(frame(rows)).collect()), key=str)
    n = len(long.encode())
    assert found == sorted([(None, n, 0, 0), (1, n, n, 1), (2, 0, 0, 0), (7, n, n, 1), (7, n, n, 1)], key=str)

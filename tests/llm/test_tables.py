"""URL rules, decontamination, chat formatting and the pipeline."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from tidelog.llm import chat_format, decontamination, url_rules
from tidelog.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "conversations"]


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(row[i] for i in order)) for row in rows)


def by_sql(sql, **views):
    connection = duckdb.connect()
    for name, source in views.items():
        connection.register(name, source) if not isinstance(source, str) else connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{source}'"
        )
    found = connection.execute(sql)
    return canonical([c[0] for c in found.description], found.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_with_sql(spark, name):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    found = QUERIES[name](spark, SF_DIR)
    views = {t: f"{SF_DIR}/{t}.parquet" for t in TABLES}
    assert canonical(found.columns, found.collect()) == by_sql(ORACLE[name], **views)


def test_every_operator_is_registered():
    names = entry_point.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


# URL rules


def judged(spark, urls, rules=url_rules.RULES):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    pages = pages.selectExpr("page_id", "url", "'r' AS rule", "'t' AS token")
    found = url_rules.judge_urls(pages, url_rules.rules_frame(spark, rules)).collect()
    return [tuple(r)[1:] for r in sorted(found)]


def test_url_rules(spark):
    urls = [None, "", "no scheme", "HTTP://Sub.Example.ORG/es/x?y", "https://example.org/en/17#z", "a://badexample.org/es/",
            "x://com/de/1", "x://a.com/fr/", "x://a.com/nl/", "x://org", "x://org?/", "x://example.org/ES/"]
    assert judged(spark, urls) == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("sub.example.org", "/es/x", "example.org/es/", "block"),
        ("example.org", "/en/17", "example.org/en/1", "block"),
        ("badexample.org", "/es/", "org/", "allow"),
        ("com", "/de/1", "com/de/", "block"), ("a.com", "/fr/", "com/fr/", "allow"), ("a.com", "/nl/", None, "allow"),
        ("org", "", None, "allow"), ("org", "", None, "allow"), ("example.org", "/ES/", "org/", "allow"),
    ]


def test_url_rules_odd_rows(spark):
    pages = spark.createDataFrame([(1, "x://a.b/"), (1, "x://a.b/"), (None, None)], "page_id long, url string")
    found = url_rules.judge_urls(pages, url_rules.rules_frame(spark)).collect()
    assert sorted(str(r["page_id"]) for r in found) == ["1", "1", "None"]
    assert url_rules.judge_urls(pages.where("false"), url_rules.rules_frame(spark)).collect() == []
    # rules without literals and with signs of regular expressions; no rules at all
    assert judged(spark, ["x://h/a+b", "x://h/aab"], [("h", "/a+", "block"), ("", "/aa", "block")]) == [
        ("h", "/a+b", "h/a+", "block"), ("h", "/aab", None, "allow")]
    assert judged(spark, ["x://h/"], []) == [("h", "/", None, "allow")]


# decontamination

ITEM = "a train leaves the old station with 12 wagons and Peter counts 5 km until the long bridge while 12 birds watch"


def leaks(spark, docs, items=((1, ITEM),)):
    docs = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'w' AS words", "1 AS window", "2 AS item_id")
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return sorted((r["doc_id"], r["item_id"], r["verbatim"]) for r in decontamination.contaminated(docs, bench).collect())


def test_decontamination(spark):
    other = ITEM.replace("12", "30").replace("Peter", "Mary").replace("5 km", "8 miles")
    mixed = ITEM.replace("12 wagons", "30 wagons").replace("5 km", "8 miles")
    half = " ".join(ITEM.split()[:16])
    docs = [
        (1, "Some words before. " + ITEM + ". And after."),
        (2, "Before that, " + other),
        (3, mixed),
        (4, ITEM.upper()),
        (5, "nothing of the kind is said in this text at all, " * 3),
        (6, half),
        (7, " ".join(ITEM.split()[:9])),
        (8, None),
        (9, ""),
        (10, "filler words " * 30_000 + ITEM),
    ]
    assert leaks(spark, docs) == [(1, 1, True), (2, 1, False), (6, 1, True), (10, 1, True)]


def test_decontamination_finds_edited_and_embedded(spark):
    words = "Which of these seven rivers runs longest through flat green meadows before reaching northern seas somewhere".split()
    items = [(1, " ".join(words[:15])), (2, " ".join(words)), (3, " ".join(words[:8])), (4, "Why is grass green")]
    edited = [
        "so they say " + " ".join(words[:12]) + " until it stops",
        "so they say " + " ".join(words[:13]) + " until it stops",
        "so they ask Which of these seven rivers runs longest through all that",
        "so they ask Why is grass green or not",
        "so they ask. Why is grass green or not",
        "so they say " + " ".join(words[:11]) + " until it stops",
    ]
    # windows found, by hand: coverage of 15 words has 8 windows, of 16 nine, of 8 and of 4 one;
    # the first word is a name, so is the second reading's
    assert [x[:2] for x in leaks(spark, list(enumerate(edited)), items)] == [
        (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 3), (3, 4), (4, 4), (5, 1), (5, 3)]


def test_decontamination_tries_every_place(spark):
    mixed = ITEM.replace("12 wagons", "30 wagons").replace("5 km", "8 miles")
    start = " ".join(ITEM.split()[:9])
    docs = [(1, f"{mixed}. {ITEM}."), (2, f"{mixed}. {mixed}."), (3, f"{start}. Some more words. {ITEM}.")]
    assert leaks(spark, docs) == [(1, 1, True), (3, 1, True)]


def test_decontamination_without_literals(spark):
    items = [(1, "3, 1, 4, 1, 5, 9, 2, 6, 5"), (2, "12 + 13 + 14 + 15"), (3, "What is 5 + 7 + 9"), (4, "7 7 7 7 7 7 7 7 7 7")]
    docs = [
        (1, "the digits 3, 1, 4, 1, 5, 9, 2, 6, 5 are known"), (2, "the digits 3, 1, 4, 1, 5, 9, 2, 6, 3 aren't"),
        (3, "so 12 + 13 + 14 + 15 it is"), (4, "so 12 + 13 + 14 + 16 and 1 + 12 + 13 + 14"), (5, "he asked What is 5 + 7 + 9 now"),
        (6, "he asked what is 5 + 7 + 8 now"), (7, "7 7 7 7 7 7 7 7 7"), (8, "7 7 7 7 7 7 7 7 7 7 7"),
        (9, "4, 1, 5, 9, 2, 6, 5 and 3, 1, 4, 1, 5, 9, 2, 6"),
    ]
    assert [x[:2] for x in leaks(spark, docs, items)] == [(1, 1), (3, 2), (5, 3), (8, 4)]


def test_decontamination_odd_rows(spark):
    assert leaks(spark, []) == []
    assert leaks(spark, [(1, ITEM)], []) == []
    short = [(1, "five plain words in here"), (2, "too short"), (3, None), (4, "five plain words in here")]
    docs = [(1, "so five plain words in here it is"), (1, "so five plain words in here it is"), (2, "too short")]
    assert leaks(spark, docs, short) == [(1, 1, True), (1, 4, True)]
    frame = spark.createDataFrame([(1, ITEM, "x"), (2, "clean", "y"), (None, ITEM, "z")], "doc_id long, text string, window string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    kept = decontamination.decontaminate(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "None"]


# chat formatting


def chat(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS block", "2 AS position", "3 AS h")


CHAT = [
    (1, 0, "user", "How do I sort?\nI have a list."),
    (1, 1, "assistant", "Use sort.\nIt is stable."),
    (1, 2, "user", "> I have a LIST!\nA tuple, in fact."),
    (1, 3, "assistant", "On Monday they wrote:\n>> I have a list.\n> A tuple, in fact.\n> not said by anyone\nThen use sorted."),
    (1, 4, "user", "> Use sort.\n> It is stable."),
    (2, 0, None, "How do I sort?"),
    (2, 1, "user", None),
    (2, 1, "user", None),
    (None, 0, "user", "alone"),
]


def test_chat_format(spark):
    found = {(r["conv_id"], r["position"]): r for r in chat_format.format_chats(chat(spark, CHAT)).collect()}
    assert len(found) == len(CHAT)
    shown = [(found[1, i]["content"], found[1, i]["reply_to"], found[1, i]["quoted"], found[1, i]["linked"]) for i in range(5)]
    assert shown == [
        ("How do I sort?\nI have a list.", None, 0, 0),
        ("Use sort.\nIt is stable.", 0, 0, 0),
        ("A tuple, in fact.", 0, 1, 1),
        ("Then use sorted.", 2, 3, 2),
        ("", 1, 2, 2),
    ]
    assert found[2, 0]["role"] == "unknown" and found[2, 2]["content"] == ""
    assert found[None, 0]["content"] == "alone"


@pytest.mark.parametrize("block", [1024, 2])
def test_chat_blocks(spark, monkeypatch, block):
    """Blocks and the SQL agree, also for long conversations."""
    monkeypatch.setattr(chat_format, "BLOCK", block)
    rows = CHAT[:5] + [(3, i, "user", f"line {i % 7}\n> line {(i + 1) % 7}\n>> line {i % 3}") for i in range(600)]
    found = chat_format.segments(chat_format.format_chats(chat(spark, rows)))
    frame = chat(spark, rows).toPandas()
    assert canonical(found.columns, found.collect()) == by_sql(chat_format.SQL, conversations=frame)
    assert max(r["n_messages"] for r in found.collect()) == chat_format.SEGMENT
    assert chat_format.format_chats(chat(spark, rows).where("false")).collect() == []


# the pipeline


def test_pipeline_stages(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    from tests.llm import brute

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    bench = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    plain = lambda text: " ".join(re.findall(r"\w+", text.lower()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        gone = set(before) - set(after)
        if name == "language_id":
            assert len(gone) < 0.05 * len(before) and all(len(before[d]) < 60 for d in gone)
        elif name == "line_dedup":
            removed = brute.removed_lines(sorted(before.items()))
            lines = {d: [x for i, x in enumerate(t.split("\n")) if i not in removed[d]] for d, t in before.items()}
            expected = {d: "\n".join(x) for d, x in lines.items() if "".join(x).strip()}
            different = set(expected.items()) ^ set(after.items())
            assert len(different) <= 0.02 * len(before)
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        elif name == "ngram_join":
            components = brute.linked(sorted(before.items()))
            assert set(after) == {d for d, (_, c) in components.items() if c == d}
        else:
            hit = {d for d, t in before.items() if any(f" {plain(b)} " in f" {plain(t)} " for b in bench)}
            assert hit <= gone and len(gone) <= len(hit) + 0.02 * len(before)
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r["doc_id"] for r in packed} == set(before)
    empty = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).collect() == []

"""Language ID, packing, secret scan and fingerprints against plain models."""

import base64
import gzip
import hashlib
import heapq
import random
import re
import urllib.parse
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelog.llm import fingerprints, language_id, packing, secret_scan

PATH = public_tokenizers.path(packing.TOKENIZER)


# language ID


def test_language_id_held_out(spark, documents):
    query = language_id.op2_language_id(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = query.join(labels, "doc_id").where("held_out AND score > 0").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_id_odd_rows(spark, frame):
    labelled = frame([(i, "der die das und nicht ein " * 9) for i in range(6)]).withColumn("lang", F.lit("de"))
    labelled = labelled.unionByName(
        frame([(i + 10, "the of and that is not with " * 9) for i in range(6)]).withColumn("lang", F.lit("en"))
    )
    model = language_id.fit(labelled)
    assert sorted(model) == ["de", "en"]
    rows = [(1, None), (2, "12 34 ! \u00bd \u00b2 \u2167"), (3, "that is not with the and of"), (3, "that is not with the and of"), (4, "das und nicht ein die der " * 50_000)]
    found = sorted(map(tuple, language_id.identify(frame(rows), model).select("doc_id", "lang_pred", "accepted").collect()))
    assert found == [(1, "und", False), (2, "und", False), (3, "en", True), (3, "en", True), (4, "de", True)]
    assert language_id.identify(frame([]), model).collect() == []
    assert language_id.fit(labelled.where("false")) == {}
    assert language_id.classify("text", {}) == ("und", 0.0)


def test_language_id_answers_in_slices(spark, monkeypatch):
    """A large batch is not turned into strings, or sent back, as a whole."""
    docs = spark.createDataFrame([], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: f)
    predict = language_id.identify(docs, {"en": [b"some words of a language"] * 4})
    rows = 2 * language_id.SLICE + 5
    ids = pa.array([None, (1 << 53) + 1, *range(2, rows)], pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, pa.array([None, "", *["words"] * (rows - 2)])], names=["doc_id", "text"])
    found = list(predict(iter([batch])))
    assert max(b.num_rows for b in found) == language_id.SLICE
    assert [x for b in found for x in b.column("doc_id").to_pylist()] == ids.to_pylist()
    assert [x for b in found for x in b.column("lang_pred").to_pylist()] == ["und", "und", *["en"] * (rows - 2)]


# packing


@pytest.mark.parametrize("seed", range(4))
def test_pack_plan(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(40)}
    patterns = packing.shortest_pack_first(histogram, 64)
    assert all(sum(p) <= 64 for p, _ in patterns)
    placed = {n: sum(p.count(n) * c for p, c in patterns) for n in histogram}
    assert placed == histogram
    assert len(patterns) <= 2 * 64 + 64
    # no plan takes fewer packs than the tokens fill, or than there are pieces over half a pack
    used = sum(n * c for n, c in histogram.items())
    least = max(-(-used // 64), sum(c for n, c in histogram.items() if n > 32))
    assert least / sum(c for _, c in patterns) > 0.9


@pytest.mark.parametrize(
    "histogram", [{150: 10_000}, {64: 3, 1: 1000}, {2000: 7, 300: 5, 150: 10_000, 30: 9000, 7: 2}, {4096: 2, 2048: 5}, {}]
)
def test_pack_plan_hot_length(histogram):
    packs = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            if packs and packs[0] + length <= 4096:
                heapq.heapreplace(packs, packs[0] + length)
            else:
                heapq.heappush(packs, length)
    patterns = packing.shortest_pack_first(histogram, 4096)
    assert {n: sum(p.count(n) * c for p, c in patterns) for n in histogram} == histogram
    assert sorted(f for p, c in patterns for f in [sum(p)] * c) == sorted(packs)


def check_sequences(rows, max_len):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= max_len


def test_packing_round_trip(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 10)
    tokenizer = Tokenizer.from_file(PATH)
    rows = packing.pack(documents, PATH, max_len=512).collect()
    check_sequences(rows, 512)
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    ids = {doc: {} for doc in texts}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        ids[r["doc_id"]][r["start"]] = r["ids"]
    for doc, text in texts.items():
        whole = [i for _, part in sorted(ids[doc].items()) for i in part]
        assert whole == tokenizer.encode(text, add_special_tokens=False).ids + [2]


def test_packing_odd_rows(frame):
    assert packing.pack(frame([]), PATH).collect() == []
    rows = [(1, None), (1, None), (2, ""), (3, "same\x1ctext <|endoftext|> here\u3000now e\u0301"), (4, "same text " * 3000), (None, "x")]
    found = packing.pack(frame(rows), PATH).collect()
    check_sequences(found, 4096)
    tokenizer = Tokenizer.from_file(PATH)
    for doc, text in rows[2:]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        own = sorted((r["start"], r["ids"]) for r in found if r["doc_id"] == doc)
        assert [i for _, part in own for i in part] == ids


# secret scan


def spans(text):
    return [(s, secret_scan.KINDS[k], e, d) for s, k, e, d, _ in secret_scan.secrets(text)[0]]


def test_secret_layers():
    secret = "password=abc123def"
    nested = base64.b64encode(secret.encode()).decode()
    assert spans("x " + secret) == [(2, "assign", 20, 0)]
    encoded = urllib.parse.quote("é " + secret, safe="")
    # é and the space take nine characters
    assert (2 + 9, "assign", 2 + len(encoded), 1) in spans("x " + encoded)
    assert [x[1:] for x in spans("see " + nested)] == [("assign", 4 + len(nested.rstrip("=")), 1)]
    twice = base64.b64encode(nested.encode()).decode()
    assert spans("see " + twice)[0][1::2] == ("assign", 2)
    for packed in (gzip.compress(secret.encode()), zlib.compress(secret.encode()), zstandard.compress(secret.encode())):
        text = "é " + base64.b64encode(packed).decode() + " end"
        assert spans(text) == [(2, "assign", len(text) - 4, 1)]
    assert spans("\\u0070\\u0061ssword=abc123def") == [(0, "assign", 28, 1)]
    assert spans("&#112;assword=abc123def") == [(0, "assign", 23, 1)]
    mixed = urllib.parse.quote(base64.b64encode(gzip.compress(secret.encode())).decode(), safe="")
    assert spans(mixed.replace("A", "%41"))[0][1] == "assign"


def test_secret_base64_runs():
    rng = random.Random(5)
    # the shortest secret; behind signs of the other alphabet
    short = base64.b64encode(b"token=aaaaaa").decode()
    assert spans("see " + short) == [(4, "assign", 20, 1)]
    for before in ("x_", "https://a.b/", "a/b-"):
        assert (len(before), "assign", len(before) + 16, 1) in spans(before + short)
    # URL-safe and wrapped, compressed or not
    for i in range(30):
        filler = bytes(rng.randrange(256) for _ in range(150))
        packed = zlib.compress(filler + b" password=abc123def " + filler)
        text = base64.urlsafe_b64encode(packed).decode()
        assert spans("x " + text) == [(2, "assign", 2 + len(text), 1)]
        text = base64.encodebytes(packed).decode()
        assert (0, "assign", len(text.rstrip("=\n")), 1) in [(a, k, e - text[a:e].count("="), d) for a, k, e, d in spans(text)]
    plain = base64.encodebytes(b"-" * 50 + b" password=abc123def " + b"-" * 50).decode()
    found = spans("so:\n" + plain + "\nend")
    assert [x[1::2] for x in found if 70 < x[2] - x[0] or x[2] > 80] == [("assign", 1)]
    # bytes that are not UTF-8, control characters, UTF-16
    for data in (b"\xff\x00 password=abc123def", b"\x01password=abc123def", "password=abc123def".encode("utf-16-le"), "é password=abc123def".encode("utf-16")):
        text = base64.b64encode(data).decode()
        assert [x[1::2] for x in spans(text)] == [("assign", 1)]


def test_secret_base_rules():
    assert spans('Token = "abcdef" secret:abcde') == [(0, "assign", 15, 0)]
    assert spans("API-KEY=abcdef apikey=abcdef") == [(15, "assign", 28, 0)]
    assert spans("toKen=ſecret1") == []
    assert spans("AKIA" + "A" * 15) == []
    assert spans("xAKIA" + "A" * 16 + "b") == [(1, "access", 21, 0)]
    assert spans("0" * 23 + "g" + "1" * 24) == [(24, "hex", 48, 0)]


def test_secret_layers_are_bytes():
    secret = b"see password=abcdef123 here"
    packers = [gzip.compress, zlib.compress, zstandard.compress]
    # compressed in compressed, and with base64 in between
    for outer in packers:
        for inner in packers:
            text = base64.b64encode(outer(inner(secret))).decode()
            assert [x[1::2] for x in spans(text)] == [("assign", 1)]
            text = base64.b64encode(outer(base64.b64encode(inner(secret)))).decode()
            assert [x[1::2] for x in spans(text)] == [("assign", 2)]
    # the secret in a later member or frame, or behind the last one
    for pack in packers:
        for data in (pack(b"first ") + pack(secret), pack(b"first") + b" " + secret, pack(b"a") + gzip.compress(b"b") + pack(secret)):
            assert [x[1::2] for x in spans(base64.b64encode(data).decode())] == [("assign", 1)]
        # UTF-16 in a compressed layer, and one that is cut off
        text = base64.b64encode(pack("é password=abcdef123".encode("utf-16"))).decode()
        assert [x[1::2] for x in spans(text)] == [("assign", 1)]
    cut = gzip.compress(secret + bytes(random.Random(1).randrange(256) for _ in range(9999)))[:5000]
    assert ("assign", 1) in [x[1::2] for x in spans(base64.b64encode(cut).decode())]


def test_secret_percent_encoded_bytes():
    rng = random.Random(3)
    for i in range(40):
        filler = bytes(rng.randrange(256) for _ in range(rng.randrange(60)))
        for pack in (gzip.compress, zlib.compress, zstandard.compress):
            data = pack(filler + b" password=abcdef123 " + filler)
            for quote in (urllib.parse.quote, urllib.parse.quote_plus):
                text = quote(data, safe="" if i % 2 else "/")
                # the range ends with the stream, not with the run
                start = len("https://a.b/?d=")
                assert (start, "assign", start + len(text), 1) in spans("https://a.b/?d=" + text + "&x=1")
    escaped = "".join(f"\\u{b:04x}" for b in zlib.compress(b"password=abcdef123"))
    assert spans("x " + escaped) == [(2, "assign", 2 + len(escaped), 1)]


def test_secret_large_layers():
    rng = random.Random(4)
    for place in [*range(0, 9000, 487), 10_000]:
        data = bytearray(rng.choice(b"ghijkl   ") for _ in range(10_000))
        data[place:place] = b" password = abcdef123 "
        text = base64.b64encode(zlib.compress(bytes(data))).decode()
        found, split = secret_scan.secrets(text, limit=1000)
        assert split > 10 and (0, 0, len(text)) in [x[:3] for x in found]
        # a layer below one that is read in blocks, and a large layer within a large one
        data[place:place] = b" " + base64.b64encode(gzip.compress(b"AKIA" + b"B" * 20)) + b" "
        text = base64.b64encode(zstandard.compress(gzip.compress(bytes(data)))).decode()
        found, split = secret_scan.secrets(text, limit=1000)
        assert split > 10 and {x[1] for x in found} == {0, 1}
    big = base64.b64encode(zlib.compress(b"-" * 33_000_000 + "é".encode() + b" password=abcdef123")).decode()
    assert [x[1] for x in secret_scan.secrets(big)[0]] == [0]
    # letters cut in two by a block are read as UTF-8
    data = "é".encode() * 5000 + b"token=abcdefgh"
    for shift in (b"", b"x"):
        text = base64.b64encode(zlib.compress(shift + data)).decode()
        assert [x[1] for x in secret_scan.secrets(text, limit=1001)[0]] == [0]


def test_secret_ends():
    # a layer that decodes to itself, and one of nothing but zeros
    assert secret_scan.secrets("%25" * 50)[0] == []
    bomb = base64.b64encode(gzip.compress(b"\0" * 100_000)).decode()
    found, split = secret_scan.secrets(bomb, limit=1000)
    assert found == [] and split > 100


def test_secret_scan_against_patterns(spark, documents):
    plain = [
        ("assign", re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ]
    found = {r["doc_id"]: r for r in secret_scan.op9_secret_scan(spark, "/root/testdata/sf0.001").collect()}
    for row in documents.collect():
        own = [(m.start(), i, m.end(), kind) for i, (kind, p, ok) in enumerate(plain) for m in p.finditer(row["text"]) if ok(m)]
        text = ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(own))
        got = found[row["doc_id"]]
        assert got["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(got["spans"].split(","))
        for kind, _, _ in plain:
            assert got[f"n_{kind}"] == sum(x[3] == kind for x in own)


def test_secret_scan_odd_rows(frame):
    rows = [(1, None), (2, ""), (3, "password=abcdef"), (3, "password=abcdef"), (None, "x" * 200_000)]
    found = secret_scan.find_secrets(frame(rows))
    assert "k" in found.columns and "text" not in found.columns
    assert sorted((str(r["doc_id"]), len(r["findings"])) for r in found.collect()) == [("1", 0), ("2", 0), ("3", 1), ("3", 1), ("None", 0)]
    assert secret_scan.find_secrets(frame([])).collect() == []


# fingerprints


def paragraphs(text):
    return set(re.findall(r"[^.!?\n]{1,200}[.!?\n]*|[.!?\n]+", text))


def jaccard(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited_with(text, following):
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def test_fingerprints(spark, documents, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 7)
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    found = {r["doc_id"]: r for r in fingerprints.compared(documents).collect()}
    assert len(found) == len(rows)
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        edited = edited_with(text, following)
        got = found[doc]
        assert got["n_chars"] == len(text)
        assert got["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for name, other in (("near_edited", edited), ("near_next", following)):
            exact = jaccard(text, other)
            assert 0 <= got[name] <= 1
            assert abs(got[name] - exact) < 1e-9, (doc, name)
    by_text = {}
    for doc, text in rows:
        assert by_text.setdefault(text, found[doc]["fingerprint"]) == found[doc]["fingerprint"]


def test_fingerprints_of_little_likeness(frame):
    """Pairs of 17 paragraphs with 6 in common, which no small sketch can be peeled for."""
    texts = []
    for pair in range(40):
        shared = [f"common {pair} {i}. " for i in range(6)]
        texts += ["".join(shared + [f"own {pair} {side} {i}. " for i in range(11)]) for side in range(2)]
    found = {r["doc_id"]: r["near_next"] for r in fingerprints.compared(frame(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        assert abs(found[i] - jaccard(text, texts[(i + 1) % len(texts)])) < 1e-9


def test_fingerprints_odd_rows(frame):
    assert fingerprints.compared(frame([])).collect() == []
    alone = fingerprints.compared(frame([(5, "one. two. three.")])).first()
    assert alone["near_next"] == 1.0
    long = "".join(f"sentence {i}. " for i in range(20_000))
    rows = [(None, "first of all."), (1, None), (1, ""), (2, "a. b."), (2, "a. b."), (9, long)]
    found = fingerprints.compared(frame(rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in found) == sorted((str(d), len(t or "")) for d, t in rows)
    last = next(r for r in found if r["doc_id"] == 9)
    assert last["edited_sha256"] == hashlib.sha256(edited_with(long, "first of all.").encode()).hexdigest()
    assert abs(last["near_edited"] - jaccard(long, edited_with(long, "first of all."))) < 0.01

"""Conversation repair against a search from the end over all edits."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from tidelog.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, absent_ string, fault int, edit string"


def key(value):
    return " " if value is None else str(value)


def after_damage(rows):
    """conv_id -> rows after the damage of the contract, in order."""
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        role, text = key(role), key(text)
        damage = zlib.crc32(f"{key(conv)}:{key(turn)}".encode()) % 20
        if damage == 0:
            continue
        text = "" if damage == 1 else re.sub("[.!?]", "", text) if damage == 2 else text
        role = "user" if damage == 4 else role
        kept += [(turn, role, text)] * (2 if damage == 3 else 1)
    for kept in found.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return found


def cheapest(rows):
    """(cost, audit) of (initial, fault) pairs, by trying every edit from each place on."""

    @cache
    def best(at, last, inserts):
        found = []
        if at == len(rows) and last in ("", "a"):
            found.append((0, ""))
        following = {"": "u", "s": "u", "u": "a", "a": "u"}[last]

        def then(cost, edit, *place):
            rest = best(*place)
            if rest:
                found.append((cost + rest[0], edit + rest[1]))

        if inserts:
            then(3, "I", at, following, inserts - 1)
        if at < len(rows):
            initial, fault = rows[at]
            then(4, "D", at + 1, last, 3)
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                then(3 + more, "R", at + 1, following, 3)
                if initial == following or (initial == "s" and last == ""):
                    then(more, "K", at + 1, initial, 3)
        return min(found, default=None)

    return best(0, "", 3)


def expected(rows):
    out = {}
    for conv, kept in after_damage(rows).items():
        seen, faults = set(), []
        for _, role, text in kept:
            inner = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            if not inner:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if inner[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in kept]
        cost, audit = cheapest(tuple(zip(initials, faults)))
        turns = [turn for turn, _, _ in kept if turn is not None]
        last, lines, rest = "", [], iter(kept)
        for edit in audit:
            _, role, text = (None, "", "") if edit == "I" else next(rest)
            if edit == "D":
                continue
            role = role if edit == "K" else "assistant" if last == "u" else "user"
            last = role[0]
            lines.append(f"{role}:{text}")
        out[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            "blank": faults.count("blank"),
            "duplicate": faults.count("duplicate"),
            "truncated": faults.count("truncated"),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        }
    return out


def frame(spark, rows):
    full = [(*row, "extra", 9, "extra") for row in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def result(df):
    return {row["conv_id"]: {k: v for k, v in row.asDict().items() if k != "conv_id"} for row in df.collect()}


def both(spark, rows):
    damaged = repair.damaged(frame(spark, rows))
    return result(repair.digests(damaged, repair.edits(damaged))), expected(rows)


@pytest.mark.parametrize("seed", range(3))
def test_against_search(spark, seed):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "", "Unknown", None, "aide"]
    texts = ["Yes.", "No", "a b!", " \t\x0b", "", None, "x.\n \n", "é?", "u ", "so ", " "]
    rows = [
        (conv if conv else None, pick.choice([None, *range(12)]), pick.choice(roles[: pick.choice([2, 3, 7])]), pick.choice(texts))
        for conv in range(60)
        for _ in range(pick.choice([0, 1, 2, 5, 9, 14]))
    ]
    found, wanted = both(spark, rows)
    assert found == wanted


def test_every_row_dropped(spark):
    turn = next(t for t in range(999) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    found, wanted = both(spark, [(7, turn, "user", "Hi.")])
    assert found == wanted
    assert found[7]["audit"] == "" and found[7]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_empty_table(spark):
    assert both(spark, []) == ({}, {})


def test_given_conversations(spark, documents):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found, wanted = both(spark, rows)
    assert found == wanted


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "One."), (1, 1, "user", "Two."), (1, 2, "tool", "Three."), (2, 5, "system", "S.")]
    plain = repair.as_rows(frame(spark, rows))
    out = repair.repaired(plain, repair.edits(plain)).orderBy("conv_id", "place").collect()
    audit = cheapest((("u", ""), ("u", ""), ("t", "")))[1]
    kept = [r for r in out if r["conv_id"] == 1]
    assert "".join(r["edit"] for r in kept) == audit.replace("D", "")
    assert [r["role"] for r in kept] == ["user", "assistant"] * (len(kept) // 2)
    assert [r["text"] for r in kept if r["edit"] != "I"] == [t for t, e in zip(("One.", "Two.", "Three."), audit.replace("I", "")) if e != "D"]
    assert [r["edit"] for r in out if r["conv_id"] == 2] == []


def test_survivors_settle():
    """A tree of at most seven nodes; edits leave it as soon as they are sure."""
    survivors = repair.Survivors()
    for i in range(20_000):
        survivors.row("ua"[i % 2], False, False)
        assert len(survivors._nodes()) <= 7
        assert survivors.unsettled() <= 16
    assert survivors.finish() == (0, "K" * 20_000)


def test_ties_over_long_runs():
    """Two ways of the same cost that never meet are compared as a whole."""
    for n in (9, 10):
        rows = tuple(("u", "") for _ in range(n))
        survivors = repair.Survivors()
        for initial, _ in rows:
            survivors.row(initial, False, False)
        assert survivors.finish() == cheapest(rows)
    survivors = repair.Survivors()
    for _ in range(5_001):
        survivors.row("u", False, False)
        assert len(survivors._nodes()) <= 7
    assert survivors.finish()[0] == 3 * 2_501


@pytest.mark.parametrize("seed", range(5))
def test_search_alone(seed):
    pick = random.Random(seed)
    for _ in range(300):
        rows = tuple((pick.choice("uuasx"), pick.choice(["", "", "", "blank", "truncated"])) for _ in range(pick.randrange(12)))
        survivors = repair.Survivors()
        for initial, fault in rows:
            survivors.row(initial, fault == "blank", fault == "truncated")
        assert survivors.finish() == cheapest(rows), rows

"""Conversation structure repair by a Viterbi search whose survivors coalesce.

A conversation is well formed if the initials of its roles give `(s?(ua)+)?`. The
cheapest edits that make it so are searched row by row over four states (nothing yet,
after s, after u, after a): keep, change the role, delete, or insert an empty message.
What each state's best edits, its survivor, have in common is settled: survivors are
leaves of a tree of edits with counted references, and as soon as the root has a single
branch, its edits are given out and dropped. Branches hold runs of edits, so the tree
has at most seven nodes, and memory is the unsettled edits, at a byte each. Equal costs
are decided by the complete unsettled edits, of which the first difference counts; it
is the first byte below the node where two survivors part.

The search reads role initials and faults only. Texts are needed again when the edits
are known: rows and edits of a conversation then meet in order, the edits first, and
the repaired rows are given out one by one. Both passes are streams over sorted rows,
so a conversation of any length needs no more memory than its edits, which are part of
the result anyway. Whether a row repeats an earlier one is found by Spark beforehand,
over all rows of the same conversation, role and text.

The search is a chain over the rows of a conversation, and so is the digest of a
repaired conversation: one conversation is one task's work, as a stream.

Defined results: null roles and texts are one space, so such texts are blank; rows
without a conversation form one; rows without a turn come first, rows of one turn are
ordered by role and by the SHA-256 of their text; equal rows repeat each other; no rows
give no conversations; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import registered, table

# Costs of the edits, and what a truncated message that stays adds.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# States by the last role, and the role that each state but the last takes next.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ROLE = {USER: "user", ASSISTANT: "assistant"}
FOLLOWING = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
COMPLETE = (EMPTY, ASSISTANT)
LEGAL = ("su", "ua", "au")

BLANK, DUPLICATE, CUT_OFF = 1, 2, 3
SPACE = r"\\x20\\x09-\\x0D"
EDITS = "conv_id, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class _Node:
    """A run of edits; `refs` counts its branches and the survivors that end here."""

    __slots__ = ("parent", "edits", "refs")

    def __init__(self, parent, edits: bytes):
        self.parent, self.edits, self.refs = parent, bytearray(edits), 0


class Survivors:
    """The cheapest edits to each state, settled as far as all of them agree."""

    def __init__(self):
        self.settled = bytearray()
        self.root = _Node(None, b"")
        self.root.refs = 1
        self.best = {EMPTY: (0, self.root)}
        self._insert()

    def row(self, initial: str, faulty: bool, cut_off: bool) -> None:
        """Take one more row: faulty ones must be deleted."""
        found: dict[int, tuple] = {}
        for state, (cost, node) in self.best.items():
            self._offer(found, state, cost + DELETE, node, b"D")
            if faulty:
                continue
            stays = cost + TRUNCATED * cut_off
            after = FOLLOWING[state]
            if initial == ROLE[after][0]:
                self._offer(found, after, stays, node, b"K")
            elif state == EMPTY and initial == "s":
                self._offer(found, SYSTEM, stays, node, b"K")
            self._offer(found, after, stays + REROLE, node, b"R")
        self._take(found)
        self._insert()
        self._give_up()

    def finish(self) -> tuple[int, str]:
        """Cost and edits of the best well-formed conversation."""
        found: dict[int, tuple] = {}
        for state in COMPLETE:
            if state in self.best:
                self._offer(found, EMPTY, *self.best[state], b"")
        cost, node, _ = found[EMPTY]
        unsettled = b"".join(bytes(each.edits) for each in self._chain(node))
        return cost, (bytes(self.settled) + unsettled).decode()

    def unsettled(self) -> int:
        """Bytes of edits that are held besides the settled ones."""
        return sum(len(node.edits) for node in self._nodes())

    # --- the tree ---------------------------------------------------------------

    def _chain(self, node) -> list:
        """Nodes from the root to this one."""
        chain = []
        while node is not None:
            chain.append(node)
            node = node.parent
        return chain[::-1]

    def _nodes(self) -> list:
        found = {}
        for _, node in self.best.values():
            for each in self._chain(node):
                found[id(each)] = each
        return list(found.values())

    def _less(self, node, edits: bytes, other, other_edits: bytes) -> bool:
        """Whether the edits up to `node` and then `edits` come before the others."""
        a, b = self._chain(node), self._chain(other)
        same = 0
        while same < min(len(a), len(b)) and a[same] is b[same]:
            same += 1
        if same < len(a) and same < len(b):
            return a[same].edits[0] < b[same].edits[0]
        # one goes on where the other ends, by a few inserts at most
        rest = [b"".join(bytes(each.edits) for each in chain[same:]) for chain in (a, b)]
        return rest[0] + edits < rest[1] + other_edits

    def _offer(self, found: dict, state: int, cost: int, node, edits: bytes) -> None:
        """Keep the better of what is found for a state and this."""
        if state in found:
            known, other, other_edits = found[state]
            if cost > known or (cost == known and not self._less(node, edits, other, other_edits)):
                return
        found[state] = (cost, node, edits)

    def _insert(self) -> None:
        """Let inserts lead to states that they reach more cheaply.

        A user's message comes first: a cheaper way to it leads on to the assistant's.
        """
        for state, sources in ((USER, (EMPTY, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            found = {known: (cost, node, b"") for known, (cost, node) in self.best.items()}
            for source in sources:
                if source in self.best:
                    cost, node = self.best[source]
                    self._offer(found, state, cost + INSERT, node, b"I")
            if state in found and found[state][2]:
                self._take(found)

    def _give_up(self) -> None:
        """Drop survivors that can't win any more.

        Whatever may follow the empty state can follow the assistant's, but for a
        system message, which is deleted then; nothing but this is lost after it.
        """
        if ASSISTANT not in self.best:
            return
        cost = self.best[ASSISTANT][0]
        found = {
            state: (own, node, b"")
            for state, (own, node) in self.best.items()
            if own <= cost + {EMPTY: DELETE, SYSTEM: 0}.get(state, own)
        }
        if len(found) < len(self.best):
            self._take(found)

    def _take(self, found: dict) -> None:
        """Let these be the survivors, and drop branches that none of them ends in."""
        before, self.best = self.best, {}
        for state, (cost, node, edits) in found.items():
            if edits:
                node.refs += 1
                node = _Node(node, edits)
            node.refs += 1
            self.best[state] = (cost, node)
        for _, node in before.values():
            node.refs -= 1
            while not node.refs and node is not self.root:
                node.parent.refs -= 1
                node = node.parent
        self._merge()
        self._settle()

    def _merge(self) -> None:
        """Join each node to the one above it, if it is the only branch there."""
        for node in self._nodes():
            above = node.parent
            if above is not None and above is not self.root and above.refs == 1:
                above.edits += node.edits
                above.refs = node.refs
                for each in self._nodes():
                    if each.parent is node:
                        each.parent = above
                for state, (cost, end) in self.best.items():
                    if end is node:
                        self.best[state] = (cost, above)
                self._merge()
                return

    def _settle(self) -> None:
        """Give out the edits that all survivors share."""
        while self.root.refs == 1 and all(node is not self.root for _, node in self.best.values()):
            below = next(iter(self.best.values()))[1]
            while below.parent is not self.root:
                below = below.parent
            self.settled += below.edits
            below.edits.clear()
            below.parent = None
            self.root = below


def as_rows(conversations: DataFrame) -> DataFrame:
    """Rows with nulls as spaces, with the digest that orders rows of one turn.

    A true boolean column `absent` marks a row that only makes its conversation known.
    """
    text = "coalesce(CAST({0} AS STRING), ' ')"
    return conversations.selectExpr(
        "conv_id",
        "CAST(turn AS BIGINT) AS turn",
        f"{text.format('role')} AS role",
        f"{text.format('text')} AS text",
        "absent" if "absent" in conversations.columns else "false AS absent",
    ).withColumn("digest", F.expr("unhex(sha2(CAST(text AS BINARY), 256))"))


def _by_conversation(rows: DataFrame, *first: str) -> DataFrame:
    """Rows of a conversation together and in order; `first` are columns that come before the turn."""
    order = ["conv_id", *first, "turn", "role", "digest"]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def _each_conversation(batches: Iterator[pa.RecordBatch]):
    """(conv_id, rows) of one conversation after the other; rows are read as they are asked for."""
    rows = (row for batch in batches for row in batch.to_pylist())
    return itertools.groupby(rows, itemgetter("conv_id"))


def _searched(conversation, rows) -> dict:
    """One conversation's faults, and its cheapest edits."""
    faults = {BLANK: 0, DUPLICATE: 0, CUT_OFF: 0}
    low = high = last_turn = None
    turns = illegal = 0
    before = None
    survivors = Survivors()
    for row in rows:
        if row["absent"]:
            continue
        if row["turn"] is not None:
            low, high = row["turn"] if low is None else low, row["turn"]
            turns += row["turn"] != last_turn
            last_turn = row["turn"]
        initial, fault = row["initial"], row["fault"]
        illegal += before is not None and before + initial not in LEGAL
        before = initial
        if fault:
            faults[fault] += 1
        survivors.row(initial, fault in (BLANK, DUPLICATE), fault == CUT_OFF)
    cost, audit = survivors.finish()
    return {
        "conv_id": conversation,
        "gaps": 0 if low is None else high - low + 1 - turns,
        "blank": faults[BLANK],
        "duplicate": faults[DUPLICATE],
        "truncated": faults[CUT_OFF],
        "illegal": illegal,
        "cost": cost,
        "audit": audit,
    }


def _streamed(rows: DataFrame, each, schema: str, batch_rows: int = 1024) -> DataFrame:
    """`each` over the conversations of sorted rows; it gives rows of the schema."""
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    schema = schema.replace("conv_id,", f"conv_id {conv_type},")
    names = [part.split()[0] for part in schema.split(", ")]
    arrow = {"string": pa.string(), "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32()}
    types = pa.schema([(part.split()[0], arrow[part.split()[1]]) for part in schema.split(", ")])

    def run(batches):
        found = []
        for conversation, own in _each_conversation(batches):
            for row in each(conversation, own):
                found.append({name: row[name] for name in names})
                if len(found) == batch_rows:
                    yield pa.RecordBatch.from_pylist(found, types)
                    found = []
        if found:
            yield pa.RecordBatch.from_pylist(found, types)

    return rows.mapInArrow(run, schema)


def edits(rows: DataFrame) -> DataFrame:
    """Per conversation: its faults, the cost and the edits that repair it.

    `rows` come from `as_rows`. `audit` has an initial for each edit in order:
    K kept, R role changed, D deleted, I inserted.
    """
    same = Window.partitionBy("absent", "conv_id", "role", "digest").orderBy("turn")
    # the faults of a text are found before the shuffle, so that texts stay where they are
    slim = rows.selectExpr(
        "conv_id", "turn", "role", "digest", "absent",
        f"NOT text RLIKE '[^{SPACE}]' AS is_blank",
        f"NOT text RLIKE '[.!?][{SPACE}]*\\\\z' AS is_cut_off",
    ).withColumn("earlier", F.row_number().over(same) - 1)
    fault = f"CASE WHEN is_blank THEN {BLANK} WHEN earlier > 0 THEN {DUPLICATE} WHEN is_cut_off THEN {CUT_OFF} END"
    slim = slim.selectExpr(
        "conv_id", "turn", "role", "digest", "earlier", "absent", "substring(role, 1, 1) AS initial", f"{fault} AS fault"
    )
    ordered = slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest", "earlier")
    read = ordered.select("conv_id", "turn", "absent", "initial", "fault")
    return _streamed(read, lambda conversation, own: [_searched(conversation, own)], EDITS)


def _replayed(own) -> Iterator[tuple[str, str, str, int | None]]:
    """(edit, role, text, turn) of the rows that stay or come in, from the edits and the rows."""
    audit = next(own)["audit"]
    rows = (row for row in own if not row["absent"])
    state = EMPTY
    for edit in audit:
        row = next(rows) if edit != "I" else {"role": None, "text": "", "turn": None}
        if edit == "D":
            continue
        if edit == "K" and state == EMPTY and row["role"][:1] == "s":
            state = SYSTEM
        else:
            state = FOLLOWING[state]
        yield edit, row["role"] if edit == "K" else ROLE[state], row["text"], row["turn"]


def _with_edits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows and edits of each conversation in one stream, the edits first."""
    none = "CAST(NULL AS STRING)"
    heads = found.selectExpr(
        "conv_id", "0 AS part", "CAST(NULL AS BIGINT) AS turn", f"{none} AS role", f"{none} AS text",
        "CAST(NULL AS BINARY) AS digest", "true AS absent", "audit", *COUNTS,
    )
    body = rows.selectExpr(
        "conv_id", "1 AS part", "turn", "role", "text", "digest", "absent", f"{none} AS audit",
        *[f"CAST(NULL AS BIGINT) AS {name}" for name in COUNTS],
    )
    ordered = _by_conversation(heads.unionByName(body), "part")
    return ordered.select("conv_id", "turn", "role", "text", "absent", "audit", *COUNTS)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, place, edit, turn, role and text of the repaired conversations' messages."""

    def replay(conversation, own):
        for place, (edit, role, text, turn) in enumerate(_replayed(own)):
            yield {"conv_id": conversation, "place": place, "edit": edit, "turn": turn, "role": role, "text": text}

    return _streamed(_with_edits(rows, found), replay, "conv_id, place long, edit string, turn long, role string, text string")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The columns of `edits`, and the SHA-256 of the repaired `role:text`, by lines."""

    def replay(conversation, own):
        head = next(own)
        digest, first = hashlib.sha256(), True
        for _, role, text, _ in _replayed(itertools.chain([head], own)):
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        yield {**head, "conv_id": conversation, "repaired_sha256": digest.hexdigest()}

    return _streamed(_with_edits(rows, found), replay, f"{EDITS}, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the damage of the contract; a dropped one stays as absent."""
    key = "concat(coalesce(CAST(conv_id AS STRING), ' '), ':', coalesce(CAST(turn AS STRING), ' '))"
    rows = conversations.selectExpr(
        "conv_id", "turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text", f"crc32(CAST({key} AS BINARY)) % 20 AS damage"
    )
    text = "CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END"
    rows = rows.selectExpr(
        "conv_id", "turn", "IF(damage = 4, 'user', role) AS role", f"{text} AS text",
        "damage = 0 AS absent", "explode(sequence(1, IF(damage = 3, 2, 1))) AS copy",
    )
    return as_rows(rows)


@registered("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    return digests(rows, edits(rows))

"""Repair of conversation structure: the cheapest edits after which the roles read ``(s?(ua)+)?``.

Each row of a conversation, in the order of its turns, is kept (0), given the role user or assistant (1)
or deleted (2); turns without text may be inserted anywhere (5 each). Blank and repeated rows must be
deleted, truncated ones cost 5 more where they stay. Among equally cheap repairs the one whose edit
initials (D, I, K, R) come first in ASCII is taken.

The search is a Viterbi pass with four states: nothing yet, after s, after u, after a. Each state has one
survivor at most, and all survivors' edits hang in one tree whose nodes count their references. A node
that no survivor needs any more goes; edits that all survivors share are emitted at once, so a task holds
the unresolved edits only, a letter each, and no texts: every survivor has a running hash of its
repaired text. Two cases keep that exact:

* Survivors always end with the edit of a row, never with an insertion. None is then the beginning of
  another: equally long runs of rows would differ in insertions only, and so in cost. The order of two
  unresolved suffixes is that of their first differing edit, which their ranks carry from row to row.
* A survivor goes early only where another one, edits to get into its place included, is cheaper for
  every continuation; an equal one stays for the comparison.

Rows that were seen before are found without a set of all texts of a conversation: one aggregate finds
the first turn of each role and text, and these firsts go through the same sort as the rows, each just
before its row; rows without one before them are repeats. So a conversation of any length passes through
its task as a stream. It is one task, as the hash over a whole repaired conversation is sequential;
nothing of a conversation is collected.

Results: null texts and roles are one space; null turns come first and leave no gap. Rows with the same
turn are ordered by role, the first 64 characters of the text, and a hash of the text. Rows without
conv_id are one conversation. Repeated rows are duplicates. Empty texts are blank, long ones are read to
their end. A conversation of which nothing is left has zeros, no edits and the hash of the empty string.
Columns other than conv_id, turn, role and text are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_STAYS = 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# The state after a role's initial; what is not here is no legal continuation.
AFTER = {
    (NOTHING, "s"): SYSTEM,
    (NOTHING, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
FULL_ROLE = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = {"su", "ua", "au"}
# What it costs at most to continue from the first state as well as from the second: a system turn that
# only the beginning may keep is deleted (2), a missing turn is inserted (5).
INSTEAD = {
    (ASSISTANT, NOTHING): 2,
    (ASSISTANT, SYSTEM): 0,
    (ASSISTANT, USER): 5,
    (USER, NOTHING): 7,
    (USER, SYSTEM): 5,
    (USER, ASSISTANT): 5,
    (NOTHING, SYSTEM): 0,
    (NOTHING, USER): 5,
    (NOTHING, ASSISTANT): 0,
    (SYSTEM, NOTHING): 10,
    (SYSTEM, USER): 5,
    (SYSTEM, ASSISTANT): 10,
}

Move = tuple[int, str, int, tuple[str, ...], str | None]


def insertions(state: int) -> Iterator[tuple[tuple[str, ...], int]]:
    """Roles that can be inserted at a state without coming back to it, and the state after them."""
    roles: tuple[str, ...] = ()
    seen: set[int] = set()
    while state not in seen:
        yield roles, state
        seen.add(state)
        initial = "a" if state == USER else "u"
        roles, state = (*roles, initial), AFTER[state, initial]


@lru_cache(maxsize=64)
def moves(initial: str, forced: bool, truncated: bool) -> tuple[tuple[Move, ...], ...]:
    """For each state the best ways over one row: cost, edits, next state, inserted initials, and the initial
    of the row's new role ("" keeps its role, None deletes the row)."""
    table: list[tuple[Move, ...]] = []
    for state in range(4):
        best: dict[int, Move] = {}
        for roles, middle in insertions(state):
            ways: list[tuple[int, str, int, str | None]] = [(COST[DELETE], DELETE, middle, None)]
            if not forced:
                stays = TRUNCATED_STAYS if truncated else 0
                if (middle, initial) in AFTER:
                    ways.append((COST[KEEP] + stays, KEEP, AFTER[middle, initial], ""))
                for role in FULL_ROLE:
                    if (middle, role) in AFTER:
                        ways.append((COST[REROLE] + stays, REROLE, AFTER[middle, role], role))
            for cost, edit, then, role in ways:
                move = (cost + COST[INSERT] * len(roles), INSERT * len(roles) + edit, then, roles, role)
                if then not in best or move[:2] < best[then][:2]:
                    best[then] = move
        table.append(tuple(best.values()))
    return tuple(table)


class Node:
    """Edits that some survivors share; ``refs`` counts the survivors and nodes that come right after."""

    __slots__ = ("parent", "letters", "refs")

    def __init__(self, parent: Node | None, letters: bytes = b"") -> None:
        self.parent = parent
        self.letters = bytearray(letters)
        self.refs = 1


class Survivor:
    __slots__ = ("cost", "state", "node", "digest")

    def __init__(self, cost: int, state: int, node: Node, digest: Any) -> None:
        self.cost, self.state, self.node, self.digest = cost, state, node, digest


def _line(role: str, text: str, first: bool) -> bytes:
    return f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass")


class Repair:
    """One conversation, row by row."""

    def __init__(self) -> None:
        root = Node(None)
        self.root = root
        self.survivors = [Survivor(0, NOTHING, root, hashlib.sha256())]  # in the order of their edits
        self.audit = bytearray()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = 0
        self.last_initial: str | None = None
        self.first_turn: int | None = None
        self.last_turn: int | None = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        words = text.rstrip(BLANKS)
        blank = not words
        truncated = not blank and words[-1] not in ENDS
        if blank:
            self.faults["blank"] += 1
        elif repeated:
            self.faults["duplicate"] += 1
        elif truncated:
            self.faults["truncated"] += 1
        if turn is not None and (self.last_turn is None or turn != self.last_turn):
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1
        initial = role[:1]
        if self.last_initial is not None and self.last_initial + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.last_initial = initial
        known = initial if initial in ("s", "u", "a") else ""
        self._step(moves(known, blank or repeated, truncated), role, text)

    def _step(self, table: tuple[tuple[Move, ...], ...], role: str, text: str) -> None:
        best: dict[int, tuple[int, int, str, Move]] = {}
        for rank, survivor in enumerate(self.survivors):
            for move in table[survivor.state]:
                way = (survivor.cost + move[0], rank, move[1], move)
                if move[2] not in best or way[:3] < best[move[2]][:3]:
                    best[move[2]] = way
        chosen = [
            way
            for state, way in best.items()
            if not any(other[0] + INSTEAD[s, state] < way[0] for s, other in best.items() if s != state)
        ]
        chosen.sort(key=lambda way: way[1:3])
        children = [0] * len(self.survivors)
        for way in chosen:
            children[way[1]] += 1
        after: list[Survivor] = []
        for cost, rank, letters, move in chosen:
            before = self.survivors[rank]
            alone = children[rank] == 1
            digest = before.digest if alone else before.digest.copy()
            if alone:
                node = before.node
                node.letters += letters.encode()
            else:
                node = Node(before.node, letters.encode())
            first = before.state == NOTHING
            for inserted in move[3]:
                digest.update(_line(FULL_ROLE[inserted], "", first))
                first = False
            if move[4] is not None:
                digest.update(_line(FULL_ROLE.get(move[4], role), text, first))
            after.append(Survivor(cost, move[2], node, digest))
        for survivor, count in zip(self.survivors, children):
            survivor.node.refs += count - 1 if count != 1 else 0
            node = survivor.node
            while node.refs == 0 and node.parent is not None:
                node = node.parent
                node.refs -= 1
        self.survivors = after
        self._settle()

    def _settle(self) -> None:
        """Puts every node together with its only successor, and emits what all survivors share."""
        nodes: list[Node] = []
        for survivor in self.survivors:
            node = survivor.node
            while node.parent is not None and node not in nodes:
                nodes.append(node)
                node = node.parent
        held = [s.node for s in self.survivors]
        for node in reversed(nodes):  # ancestors before what comes after them on each path
            parent = node.parent
            if parent is None or parent.refs != 1 or parent in held:
                continue
            parent.letters += node.letters
            parent.refs = node.refs
            for other in nodes:
                if other.parent is node:
                    other.parent = parent
            for survivor in self.survivors:
                if survivor.node is node:
                    survivor.node = parent
            held = [s.node for s in self.survivors]
        if self.root.letters:
            self.audit += self.root.letters
            self.root.letters = bytearray()

    def unresolved(self) -> int:
        """Edits held back as of now."""
        nodes = set()
        for survivor in self.survivors:
            node: Node | None = survivor.node
            while node is not None:
                nodes.add(node)
                node = node.parent
        return sum(len(n.letters) for n in nodes)

    def finish(self) -> tuple[int, int, int, int, int, int, str, str]:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"""
        ends = []
        for rank, survivor in enumerate(self.survivors):
            for roles, state in insertions(survivor.state):
                if state in (NOTHING, ASSISTANT):
                    ends.append((survivor.cost + COST[INSERT] * len(roles), rank, INSERT * len(roles), roles))
        cost, rank, letters, roles = min(ends)
        winner = self.survivors[rank]
        first = winner.state == NOTHING
        for inserted in roles:
            winner.digest.update(_line(FULL_ROLE[inserted], "", first))
            first = False
        parts = [letters.encode()]
        node: Node | None = winner.node
        while node is not None:
            parts.append(bytes(node.letters))
            node = node.parent
        audit = (bytes(self.audit) + b"".join(reversed(parts))).decode()
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return gaps, *self.faults.values(), self.illegal, cost, audit, winner.digest.hexdigest()


def damage(turns: DataFrame) -> DataFrame:
    """Faults for tests, by ``crc32(conv_id:turn) % 20``: ``copies`` is 0 for a lost row, 2 for a repeated one."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


REPORT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [T.StructField(n, T.StringType()) for n in ("audit", "repaired_sha256")]
)
ORDER = ["conv_id", "turn", "role", "head", "hash", "kind"]
MARK, ROW = 0, 1


def _rows(turns: DataFrame) -> DataFrame:
    copies = F.col("copies").cast("int") if "copies" in turns.columns else F.lit(1)
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        copies.alias("copies"),
    )
    lost = F.col("copies") < 1
    return rows.select(
        "conv_id",
        *(F.when(~lost, F.col(n)).alias(n) for n in ("turn", "role", "text")),
        "copies",
        F.when(~lost, F.left("text", F.lit(64))).alias("head"),
        F.when(~lost, F.unhex(F.md5("text"))).alias("hash"),
    )


def _in_order(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Marks and the rows that are left, a conversation after the other, in the order of turns."""
    wide = rows.where(F.col("copies") > 0).withColumn("kind", F.lit(ROW))
    both = wide.unionByName(marks.withColumn("kind", F.lit(MARK)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(*ORDER)


def _records(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def repair(turns: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, gaps, counts of faults, cost, audit and the hash of the repaired rows."""
    rows = _rows(turns)
    # The first turn of every role and text; lost rows are one mark a conversation, that it was there.
    firsts = rows.groupBy("conv_id", "role", "head", "hash").agg(
        F.bool_or(F.col("turn").isNull()).alias("early"), F.min("turn").alias("turn")
    )
    marks = firsts.withColumn("turn", F.when(~F.col("early"), F.col("turn"))).drop("early")
    ordered = _in_order(rows, marks)
    schema = T.StructType([turns.schema["conv_id"], *REPORT.fields])
    arrow_id = ordered.select("conv_id").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(T.StructType([*arrow_id.fields, *REPORT.fields]))
        done: list[tuple] = []
        size = 0
        current: Any = run  # no conversation has this name
        state = Repair()
        mark: tuple | None = None

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(column, f.type) for column, f in zip(zip(*found), target)], schema=target
            )

        for conv, turn, role, hashed, kind, text, copies in _records(
            batches, ["conv_id", "turn", "role", "hash", "kind", "text", "copies"]
        ):
            if current is run or conv != current:
                if current is not run:
                    done.append((current, *state.finish()))
                    size += len(done[-1][-2])
                    if len(done) >= 500 or size > 1 << 20:
                        yield batch_of(done)
                        done, size = [], 0
                current, state, mark = conv, Repair(), None
            if kind == MARK:
                mark = (turn, role, hashed)
                continue
            repeated = mark != (turn, role, hashed)
            mark = None
            for copy in range(copies):
                state.add(turn, role, text, repeated or copy > 0)
        if current is not run:
            done.append((current, *state.finish()))
        if done:
            yield batch_of(done)

    return ordered.mapInArrow(run, schema)


def repaired_turns(turns: DataFrame, report: DataFrame) -> DataFrame:
    """The rows after the edits of ``report``: conv_id, place from 0, edit, turn (null where inserted), role, text."""
    rows = _rows(turns)
    # An audit goes before its conversation's rows: null turn, role and hash come first.
    empty = {"turn": "bigint", "role": "string", "text": "string", "head": "string", "hash": "binary"}
    marks = report.select(
        "conv_id", *(F.lit(None).cast(t).alias(n) for n, t in empty.items()), F.lit(0).alias("copies"), "audit"
    )
    ordered = _in_order(rows, marks)
    schema = T.StructType(
        [
            turns.schema["conv_id"],
            T.StructField("place", T.LongType()),
            T.StructField("edit", T.StringType()),
            T.StructField("turn", T.LongType()),
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        out: list[tuple] = []
        size = 0
        conv, audit, at, place, even = None, "", 0, 0, True

        def wanted() -> str:
            """The role that belongs here, where the edits change it."""
            return "user" if even else "assistant"

        def put(edit: str, turn: int | None, role: str, text: str) -> None:
            nonlocal place, even, size
            out.append((conv, place, edit, turn, role, text))
            size += len(text)
            place += 1
            if role[:1] != "s":
                even = not even

        def inserts() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == INSERT:
                put(INSERT, None, wanted(), "")
                at += 1

        for name, turn, role, kind, text, copies, edits in _records(
            batches, ["conv_id", "turn", "role", "kind", "text", "copies", "audit"]
        ):
            if kind == MARK:
                inserts()  # at the end of the conversation before
                conv, audit, at, place, even = name, edits, 0, 0, True
                continue
            for _ in range(copies):
                inserts()
                edit = audit[at]
                at += 1
                if edit != DELETE:
                    put(edit, turn, wanted() if edit == REROLE else role, text)
            if len(out) >= 500 or size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), target)], schema=target)
                out, size = [], 0
        inserts()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), target)], schema=target)

    return ordered.mapInArrow(run, schema)

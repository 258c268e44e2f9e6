"""Conversation repair against a search over whole edit strings from the end."""

import hashlib
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollmill.llm import conversations, queries
from rollmill.llm.conversations import Repair

BLANK = set(" \t\n\x0b\x0c\r")
SHAPE = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """cost, edits and hash for rows of role, text, must go, truncated; all ways are compared as whole strings."""

    @lru_cache(None)
    def best(i, state, inserted):
        ways = []
        if i == len(rows):
            if state in ("", "a"):
                ways.append((0, "", ()))
        else:
            role, text, goes, cut = rows[i]
            cost, edits, left = best(i + 1, state, 0)
            ways.append((cost + 2, "D" + edits, left))
            for letter, own, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                then = SHAPE.get((state, own[:1]))
                if then and not goes:
                    cost, edits, left = best(i + 1, then, 0)
                    ways.append((cost + price + 5 * cut, letter + edits, ((own, text), *left)))
        for own in ("user", "assistant"):
            then = SHAPE.get((state, own[0]))
            if then and inserted < 4:
                cost, edits, left = best(i, then, inserted + 1)
                ways.append((cost + 5, "I" + edits, ((own, ""), *left)))
        return min(ways, default=(10**6, "", ()))

    cost, edits, left = best(0, "", 0)
    return cost, edits, sha("\n".join(f"{r}:{t}" for r, t in left))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    """The whole report of one conversation from (turn, role, text), in order."""
    seen, faults, flat = set(), [0, 0, 0], []
    for _, role, text in rows:
        shown = [c for c in text if c not in BLANK]
        blank, twice, cut = not shown, (role, text) in seen, bool(shown) and shown[-1] not in ".!?"
        seen.add((role, text))
        for k, found in enumerate((blank, twice and not blank, cut and not twice)):
            faults[k] += found
        flat.append((role, text, blank or twice, cut))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, edits, digest = cheapest(tuple(flat))
    return gaps, *faults, illegal, cost, edits, digest


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:64]))


def reports(rows):
    convs = {r[0] for r in rows}
    kept = damaged(rows)
    return {c: expected([r[1:] for r in kept if r[0] == c]) for c in convs}


ROLES = st.sampled_from(["user", "assistant", "system", "tool", "", "under"])
TEXTS = st.sampled_from(["", " \t", "Yes.", "No", "Why?", "Well! ", "so\n"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLES, TEXTS), max_size=9))
def test_repair_is_the_cheapest_and_first_in_ascii(turns):
    rows = [(i, role, text) for i, (role, text) in enumerate(turns)]
    state, seen = Repair(), set()
    for turn, role, text in rows:
        state.add(turn, role, text, (role, text) in seen)
        seen.add((role, text))
    assert state.finish() == expected(rows)


def test_shared_edits_are_emitted_and_few_are_held():
    state = Repair()
    for i in range(2000):
        state.add(i, ("user", "assistant")[i % 2], f"Turn {i}.", False)
        assert state.unresolved() <= 4
    state = Repair()
    for i in range(3000):  # repeats of a text go, whatever comes after
        state.add(i, "user", "Same.", i > 0)
    assert len(state.survivors) <= 4
    assert state.finish()[5:7] == (6000, "D" * 3000)


def test_equal_costs_are_compared_over_a_long_unresolved_stretch():
    rows = [(i, "user", f"Turn {i}.") for i in range(200)]
    state = Repair()
    for row in rows:
        state.add(*row, False)
    assert state.unresolved() > 100  # two ways stay open to the end
    assert state.finish() == expected(rows)


ODD = [
    (1, 0, "system", "Be kind."),
    (1, 1, "user", "Hi!"),
    (1, 2, "assistant", "Hello there."),
    (1, 2, "assistant", "Hello there."),
    (1, 7, "user", "And then"),
    (1, None, "user", "Before all."),
    (2, None, None, None),
    (2, None, None, None),
    (3, 5, "user", "long " * 50_000 + "end."),
    (3, 6, "assistant", "long " * 50_000 + "other end."),
    (None, 1, "user", "No conversation?"),
    (None, 2, "assistant", "None."),
    (4, -3, "tool", "été."),
    (4, 3, "tool", "été."),
    (4, 3, "assistant", "Two of one turn."),
    (4, 3, "user", "Two of one turn."),
]


def test_damaged_odd_conversations(corpus):
    rows = ODD + [(c, t, ("user", "assistant")[t % 2], f"Row {t} of {c}.") for c in range(10, 60) for t in range(c % 9)]
    rows += [(c, 0, "user", "All there is.") for c in range(100, 160)]
    df = corpus.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, cost int, audit string")
    got = {r[0]: tuple(r)[1:] for r in conversations.repair(conversations.damage(df.repartition(5))).collect()}
    assert got == reports(rows)
    assert any(v[6] == "" and v[7] == sha("") for v in got.values())


def test_edits_applied_give_the_hash(corpus):
    rows = ODD + [(c, t, "user", f"Row {t}.") for c in range(10, 20) for t in range(7)]
    df = corpus.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = conversations.damage(df)
    report = conversations.repair(turns)
    text = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("place", F.concat("role", F.lit(":"), "text").alias("line")))), lambda s: s["line"]))
    made = conversations.repaired_turns(turns, report).groupBy("conv_id").agg(F.sha2(text, 256).alias("digest"))
    got = {r[0]: r[1] for r in made.collect()}
    for r in report.collect():
        assert got.get(r["conv_id"], sha("")) == r["repaired_sha256"]


def test_no_conversations(corpus):
    df = corpus.createDataFrame([], "conv_id long, turn long, role string, text string")
    report = conversations.repair(conversations.damage(df))
    assert report.collect() == [] and conversations.repaired_turns(df, report).collect() == []


def test_conversations_named_by_texts_and_undamaged(corpus):
    df = corpus.createDataFrame([("x", 1, "user", "Hi."), ("x", 2, "assistant", "Ho.")], "conv_id string, turn int, role string, text string")
    assert conversations.repair(df).collect()[0][1:] == (0, 0, 0, 0, 0, 0, "KK", sha("user:Hi.\nassistant:Ho."))


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_the_search(corpus, sf_dir):
    rows = [tuple(r) for r in corpus.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    found = queries.op11_conversation_repair(corpus, sf_dir)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == reports(rows)

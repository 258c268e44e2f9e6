"""Later copies of repeated line runs against a search for the longest earlier copy of every suffix."""

import random
import re

import pytest

from rollmill.llm import line_runs
from rollmill.llm.line_runs import drop_later_copies


def brute(docs, min_words):
    docs = sorted(docs)
    lines = {d: t.split("\n") for d, t in docs}
    words = {d: [len(re.findall(r"[^\x20\x09-\x0D]+", line)) for line in own] for d, own in lines.items()}
    out = {}
    for d, _ in docs:
        gone = set()
        for i in range(len(lines[d])):
            best = 0
            for e, _ in docs:
                for j in range(len(lines[e])):
                    if (e, j) >= (d, i):
                        break
                    k = 0
                    while i + k < len(lines[d]) and j + k < len(lines[e]) and lines[d][i + k] == lines[e][j + k]:
                        k += 1
                    best = max(best, k)
            if sum(words[d][i : i + best]) >= min_words:
                gone.update(range(i, i + best))
        out[d] = ("\n".join(x for i, x in enumerate(lines[d]) if i not in gone), len(gone))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(corpus, seed):
    r = random.Random(seed)
    kinds = ["a b c", "d", "e f", "", "g h i j", "k", "l m"]
    docs = [(i, "\n".join(r.choice(kinds) for _ in range(r.randint(0, 22)))) for i in range(45)]
    docs += [(100 + i, "\n".join(["a b c", "d"] * r.randint(1, 12))) for i in range(5)]
    out = drop_later_copies(corpus.createDataFrame(docs, "doc_id long, text string"), 6).collect()
    assert {x["doc_id"]: (x["text"], x["n_removed"]) for x in out} == brute(docs, 6)


def test_short_repeats_stay(corpus):
    docs = [(1, "same line\nown one"), (2, "same line\nown two"), (3, "same line\nown one")]
    out = drop_later_copies(corpus.createDataFrame(docs, "doc_id long, text string"), 4).collect()
    assert {x["doc_id"]: x["text"] for x in out} == {1: docs[0][1], 2: docs[1][1], 3: ""}


def test_odd_rows(odd, nothing):
    out = drop_later_copies(odd, 3)
    assert out.columns == [*odd.columns, "n_removed"]
    rows = out.collect()
    assert len(rows) == odd.count()
    assert sorted(r["text"] for r in rows if r["doc_id"] == 4) == ["One two three."] * 2
    assert sorted(r["text"] for r in rows if r["doc_id"] == 5)[0] == ""
    assert [r["text"] for r in rows if r["doc_id"] == 1] == [None]
    assert drop_later_copies(nothing).collect() == []


def test_no_task_holds_all_pairs_of_a_rank(corpus, monkeypatch):
    rows = corpus.createDataFrame([(i, 0, i % 2 * (i % 7), 0) for i in range(40)], "place long, begin long, h1 long, h2 long")
    plans, staged = {}, line_runs.staged

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return staged(df, name)

    monkeypatch.setattr(line_runs, "staged", seen)
    ranks = {(r["k"], r["place"]): r["rank"] for r in line_runs.suffix_ranks(rows, 2).collect()}
    assert not any("windowspecdefinition(rank" in p for p in plans.values()) and "rank-2" in plans
    first = {p: ranks[0, p] for p in range(40)}
    keys = {k: {p: tuple(first.get(p + j, 0) for j in range(2**k)) for p in range(40)} for k in (1, 2)}
    for k, own in keys.items():
        assert all(ranks[k, p] == 1 + sum(o < own[p] for o in own.values()) for p in own)

"""Near duplicates against brute force over all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rollmill.llm import near_dup
from rollmill.llm.near_dup import MinHash, components, estimate, near_duplicates


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(5))))


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(s), find(d)) for d, s in sets}


def drifting(seed, n_groups, size, words=60):
    """Groups of texts, each an edit of an earlier one: chains whose ends are no near duplicates."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(n_groups):
        texts = [[word() for _ in range(words)]]
        for _ in range(size - 1):
            own = list(r.choice(texts[-3:]))
            own[r.randrange(len(own))] = word()
            texts.append(own)
        rows += [" ".join(t) for t in texts]
    r.shuffle(rows)
    return list(enumerate(rows, start=1))


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("block", [4, near_dup.BLOCK])
def test_equals_brute_force(corpus, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rows = drifting(1, 6, 14) + [(900 + i, "the same few words here again and again") for i in range(20)]
    rows += [(950, "ONE two"), (951, "one  TWO"), (952, "one"), (953, ""), (954, None)]
    out = near_duplicates(corpus.createDataFrame(rows, "doc_id long, text string"))
    assert found(out) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out.collect())


def test_leftovers_find_what_hubs_miss(corpus, monkeypatch):
    """Without any link from the hubs the comparison inside buckets finds every component."""
    rows = drifting(2, 3, 10)
    real = near_dup.confirm
    calls = []

    def first_finds_nothing(pairs, sets, how):
        calls.append(pairs)
        return real(pairs, sets, how).where(F.lit(len(calls) > 1))

    monkeypatch.setattr(near_dup, "confirm", first_finds_nothing)
    monkeypatch.setattr(
        near_dup, "leftover_pairs", lambda m, h, t, *rest: real_leftover(m, h.limit(0), t.limit(0), *rest)
    )
    assert found(near_duplicates(corpus.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


real_leftover = near_dup.leftover_pairs


@pytest.mark.parametrize("shingles", [None, 300])
def test_a_bucket_does_not_emit_its_pairs(corpus, monkeypatch, shingles):
    """Documents that are all alike, without a link from the hubs: rows grow with them, not with their pairs.
    Tasks with room for two documents find the same, by more links."""
    r = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = [(i, " ".join(w if k != at else f"own{i}" for k, w in enumerate(base))) for i, at in enumerate(r.choices(range(120), k=200))]
    real = near_dup.confirm
    calls, made = [], []

    def first_finds_nothing(pairs, sets, how):
        calls.append(pairs)
        return real(pairs, sets, how).where(F.lit(len(calls) > 1))

    def counted(m, h, t, *rest):
        out = real_leftover(m, h.limit(0), t.limit(0), *rest).cache()
        made.append(out.count())
        return out

    if shingles:
        monkeypatch.setattr(near_dup, "SHINGLES", shingles)
    monkeypatch.setattr(near_dup, "confirm", first_finds_nothing)
    monkeypatch.setattr(near_dup, "leftover_pairs", counted)
    assert found(near_duplicates(corpus.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert shingles or made[0] < len(rows) * MinHash().bands


def test_components_of_a_path(corpus):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101)]
    roots = {r["node"]: r["root"] for r in components(corpus.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == {i: 1 for i in range(2, 41)} | {101: 100, 102: 100}


def test_estimate_is_corrected_for_chance():
    size = MinHash().size
    assert estimate(size, size) == 1
    assert abs(estimate(size / 16, size)) < 1e-12


def test_odd_rows(odd, nothing):
    out = near_duplicates(odd).collect()
    assert len(out) == odd.count()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in out if r["doc_id"] in (1, 2, 3, 6)) == [
        (d, d, True) for d in (1, 2, 3, 6)
    ]
    assert {r["component_id"] for r in out if r["doc_id"] in (4, 5)} == {4}
    assert [(r["component_id"], r["kept"]) for r in out if r["doc_id"] is None] == [(None, True)] * 2
    assert near_duplicates(nothing).collect() == []

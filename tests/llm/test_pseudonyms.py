"""Pseudonyms keep the format, stay linked, differ for different values, and can be undone."""

import re

import pytest
from pyspark.sql import functions as F

from rollmill.llm.pseudonyms import Permuter, pseudonymise

VALUES = {
    "card": ["4155030142265802", "4155 0301 4226 5802", "4949-8058-3686-1045", "378282246310005"],
    "phone": ["+1 (469) 555-4560", "(469) 555-4560", "469-555-4560", "1-469-555-4560"],
    "social": ["123-45-6789", "899-99-9999", "001-01-0001"],
    "ip": ["26.198.133.150", "0.0.0.0", "255.255.255.255"],
    "date": ["2023-02-28", "29/02/2024", "1700-01-01", "2099-12-31"],
    "email": ["ssfb.12@mail5.example.com", "a@b.co", "very.long.name-with_more.than.22.letters@x.org", "0000@x.org"],
}
INVALID = ["4155030142265803", "999.1.1.1", "2023-02-30", "000-12-3456", "666-12-3456", "169-555-456", "1.2.3.4.5", "a@b"]


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def shape(value):
    return re.sub("[0-9]", "9", value)


@pytest.fixture
def values(corpus):
    rows = [(i, f"see {v}, ok", k) for i, (k, v) in enumerate((k, v) for k, vs in VALUES.items() for v in vs)]
    return corpus.createDataFrame(rows, "doc_id long, text string, kind string")


def test_format_is_kept_and_undone(values):
    out = pseudonymise(values, "key")
    for r in out.collect():
        assert r["n_" + r["kind"]] == 1, r
    new, old = texts(out), texts(values)
    for r in values.collect():
        d = r["doc_id"]
        assert new[d] != old[d]
        if r["kind"] in ("card", "phone", "social", "date"):
            assert shape(new[d]) == shape(old[d])
    # Pseudonyms are valid values: they are found again, and the way back leads to the originals.
    assert texts(pseudonymise(out.select("doc_id", "text"), "key", restore=True)) == old
    assert texts(pseudonymise(values, "other key")) != new


def test_equal_values_stay_linked(corpus):
    rows = [(1, "4155030142265802 (469) 555-4560"), (2, "x 4155 0301 4226 5802 y +1 469-555-4560.")]
    new = texts(pseudonymise(corpus.createDataFrame(rows, "doc_id long, text string"), "key"))
    assert re.sub("[^0-9]", "", new[1]) == re.sub("[^0-9]", "", new[2].replace("+1", ""))


def test_invalid_values_stay(corpus):
    rows = list(enumerate(INVALID))
    df = corpus.createDataFrame(rows, "doc_id long, text string")
    assert texts(pseudonymise(df, "key")) == dict(rows)


def test_the_network_is_a_permutation(corpus):
    pair = Permuter("key").pair("t", F.floor(F.col("id") / 31), F.col("id") % 31, 17, 31)
    df = corpus.range(17 * 31).select(pair.alias("p"))
    assert df.distinct().count() == 17 * 31
    assert df.where("p.a BETWEEN 0 AND 16 AND p.b BETWEEN 0 AND 30").count() == 17 * 31


def test_odd_rows(odd, nothing):
    out = pseudonymise(odd, "key")
    assert out.columns[: len(odd.columns)] and set(odd.columns) <= set(out.columns)
    assert sorted(map(repr, (r["text"] for r in out.collect()))) == sorted(repr(r["text"]) for r in odd.collect())
    assert pseudonymise(nothing, "key").collect() == []


SHORT = ["7", "123", "12/2027", "Apt 12"]


def test_values_beside_others_are_found(corpus):
    flat = [(k, v) for k, vs in VALUES.items() for v in vs[:2]] + [(None, s) for s in SHORT]
    pairs = [(a, b) for a in flat for b in flat]
    rows = [(i, f"{a[1]} {b[1]}") for i, (a, b) in enumerate(pairs)]
    alone = pseudonymise(corpus.createDataFrame([(i, v) for i, (_, v) in enumerate(flat)], "doc_id long, text string"), "key")
    alone = {v: texts(alone)[i] for i, (_, v) in enumerate(flat)}
    out = {r["doc_id"]: r for r in pseudonymise(corpus.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    for i, (a, b) in enumerate(pairs):
        want = {k: (a[0] == k) + (b[0] == k) for k in VALUES}
        assert {k: out[i][f"n_{k}"] for k in VALUES} == want, rows[i]
        assert out[i]["text"] == f"{alone[a[1]]} {alone[b[1]]}", rows[i]


def test_values_inside_longer_stretches(corpus):
    cards = ["4155 0301 4226 5802", "3056 930902 5904", "3782 822463 10005", "4949-8058-3686-1045"]
    rows = [f"12 7 {c} 123 45" for c in cards] + [f"2027 {c} 469-555-4560 {c}" for c in cards]
    rows += ["5904 4949-8058-3686-1045x", "12 34 ﷐ 4155030142265802 ﷑ (469) 555-4560 ﷓"]
    n = [1] * 4 + [2] * 4 + [0, 1]
    df = corpus.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in pseudonymise(df, "key").collect()}
    assert [out[i]["n_card"] for i in range(len(rows))] == n
    for i, row in enumerate(rows):
        assert shape(out[i]["text"]) == shape(row)
        assert not any(c in out[i]["text"] for c in cards) or not n[i]


def test_values_behind_marks_and_at_the_end_of_sentences(corpus):
    """A full stop, colon, slash or bracket before a value does not hide it; a number's own point does."""
    flat = [(k, vs[0]) for k, vs in VALUES.items() if k != "email"]
    marks = ["No.", "us.", "id:", "x/", "(", "a - "]
    rows = [(f"{m}{v}", k) for k, v in flat for m in marks] + [(f"It was {v}.", k) for k, v in flat]
    df = corpus.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in pseudonymise(df, "key").collect()}
    for i, (text, kind) in enumerate(rows):
        assert out[i][f"n_{kind}"] == 1, text
    numbers = [(0, "3.4155030142265802"), (1, "12.469-555-4560"), (2, "0.123-45-6789")]
    kept = texts(pseudonymise(corpus.createDataFrame(numbers, "doc_id long, text string"), "key"))
    assert kept == dict(numbers)

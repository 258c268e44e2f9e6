"""Token ids, counts under edits, packing and token files against the tokenizers library itself."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rollmill.llm import packing, token_counts, token_files
from rollmill.llm.bpe import Encoder, encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
PLAIN.encode_special_tokens = True
ALPHABET = "abT 'sllééß中,.!?\n\t 12  \x1c\x85|<>_-%#$*()[]`~endoftext"


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), max_size=6))
def test_pieces_encode_like_whole_texts(texts):
    found = encoder(PATH).encode(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [ids_of(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=60), max_size=5), st.integers(1, 4))
def test_slots_are_counted_in_their_places(texts, size):
    found = encoder(PATH).slot_counts(texts, size)
    for text, (chars, tokens) in zip(texts, found, strict=True):
        assert sum(chars) == len(text) and sum(tokens) == len(ids_of(text))
        at = 0
        for n, count in zip(chars, tokens, strict=True):
            assert count == len(ids_of(text[at : at + n]))
            at += n
    slots = [token_counts.slots_of(t) for t in texts]
    found = encoder(PATH).slot_counts(texts, token_counts.SLOT_PIECES)
    assert [[len(s) for s in own] for own in slots] == [chars for chars, _ in found]


def test_small_memo_changes_nothing():
    small, words = Encoder(PATH, memo=3), [f"word{i} Wort, été" for i in range(50)] * 2
    assert [np.frombuffer(f, "<u4").tolist() for f in small.encode(words)] == [ids_of(w) for w in words]
    assert [np.frombuffer(small.encode([w])[0], "<u4").tolist() for w in words] == [ids_of(w) for w in words]


@settings(max_examples=200, deadline=None)
@given(
    st.text(alphabet=ALPHABET, max_size=120),
    st.lists(st.tuples(st.integers(0, 130), st.integers(0, 15), st.text(alphabet=ALPHABET, max_size=8)), max_size=6),
)
def test_tree_follows_edits(text, edits):
    tree = token_counts.TokenTree(encoder(PATH), token_counts.slots_of(text))
    for at, remove, insert in edits:
        tree.edit(at, remove, insert)
        at = min(at, len(text))
        text = text[:at] + insert + text[at + remove :]
        assert tree.text() == text
        assert tree.n_tokens == len(ids_of(text))


def test_edits_encode_only_what_they_touch():
    tree = token_counts.TokenTree(encoder(PATH), token_counts.slots_of("some words here " * 5000 + "end"))
    before = tree.encoded
    tree.edit(40_000, 5, "other")
    assert tree.encoded - before < 300


def test_edits_of_stored_trees(corpus, odd):
    trees = token_counts.build_trees(odd, PATH)
    edits = [(4, 2, 0, 3, "Zero"), (4, 1, 3, 0, " and"), (6, 1, 10, 5, ""), (99, 1, 0, 1, "x"), (None, 1, 0, 1, "x")]
    edits = corpus.createDataFrame(edits, "doc_id long, seq long, at long, remove long, insert string")
    out = token_counts.apply_edits(trees, edits, PATH).collect()
    assert len(out) == odd.count()
    assert [r["text"] for r in out if r["doc_id"] == 4] == ["Zero and two three."] * 2
    assert all(sum(r["slot_tokens"]) == len(ids_of(r["text"])) for r in out)


def test_rule_edits(odd, nothing):
    rules = [(r"[aeiou]{2,}", "0"), (r"([rt])\1*", r"\1")]
    rows = token_counts.apply_rules(token_counts.build_trees(odd, PATH), rules, PATH).collect()
    texts = defaultdict(list)
    for r in odd.collect():
        text = r["text"] or ""
        both = re.sub(r"[aeiou]{2,}", "0", re.sub(r"([rt])\1*", r"\1", text))
        texts[r["doc_id"]].append((len(ids_of(text)), len(ids_of(both))))
    for r in rows:
        assert (r["n_tokens"], r["n_tokens_after"]) in texts[r["doc_id"]]
    assert token_counts.apply_rules(token_counts.build_trees(nothing, PATH), rules, PATH).collect() == []


@pytest.mark.parametrize("tokens", [0, 1, 2, 5, 340, 341, 342, 511, 512, 513, 700, 1023, 1024, 1025, 5000])
def test_cuts(tokens):
    lengths = packing.cut(tokens, 1024)
    assert sum(lengths) == tokens and all(0 < n <= 1024 for n in lengths)
    for n in lengths:
        assert (1024 // n) * n >= (1 - packing.SLACK) * 1024 or n == 1024 // (1024 // n + 1) or 1024 // n >= 2


def checked_packing(docs, rows, capacity, end_id):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"], r["doc_tokens"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    want, got = defaultdict(list), defaultdict(list)
    for doc_id, text in docs:
        ids = [*ids_of(text), end_id]
        want[doc_id, len(ids)].append(ids)
    for key, texts in want.items():
        pieces = sorted(by_doc[key], key=lambda r: r["start"])
        assert sum(r["length"] for r in pieces) == sum(map(len, texts))
        for r in pieces:
            assert any(crc(t[r["start"] : r["start"] + r["length"]]) == r["ids_crc32"] for t in texts)
        got[key] = pieces
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence)


def test_packing(corpus, odd, nothing):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    checked_packing(docs, packing.pack(odd, PATH, capacity=64).collect(), 64, 0)
    assert packing.pack(nothing, PATH).collect() == []
    r = random.Random(5)
    docs = [(i, "some word " * r.randint(0, 300)) for i in range(400)]
    df = corpus.createDataFrame(docs, "doc_id long, text string").repartition(7)
    rows = packing.pack(df, PATH, capacity=256, end_id=3, with_ids=True).collect()
    sequences = checked_packing(docs, rows, 256, 3)
    assert all(crc(r["ids"]) == r["ids_crc32"] for r in rows)
    tokens = sum(r["length"] for r in rows)
    assert tokens / (256 * sequences) > 0.97


def test_token_files(corpus, odd, nothing, tmp_path):
    files = token_files.write_token_files(odd.repartition(3), PATH, f"{tmp_path}/odd")
    rows = token_files.read_token_files(files).collect()
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in rows) == sorted(
        (r["doc_id"] or -1, [*ids_of(r["text"]), 2]) for r in odd.collect()
    )
    start = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == start and r["n_tokens"] == len(r["ids"]) and crc(r["ids"]) == r["ids_crc32"]
        start += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    empty = token_files.write_token_files(nothing, PATH, f"{tmp_path}/none")
    assert token_files.read_token_files(empty).collect() == []


def test_readers_fetch_only_wanted_frames(corpus, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 50)
    out = open(tmp_path / "x.zst", "wb")
    writer = token_files.Writer(out)
    for d in range(100):
        writer.add(d, np.arange(d, d + 10, dtype="<u4").tobytes())
    writer.close()
    out.close()
    raw = (tmp_path / "x.zst").read_bytes()
    plain = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert len(plain) > 100 * 40  # a plain reader skips the index and the table

    class Source:
        def __init__(self):
            self.at, self.fetched = 0, 0

        def size(self):
            return len(raw)

        def seek(self, at):
            self.at = at

        def read(self, n):
            self.fetched += n
            return raw[self.at : self.at + n]

    all_of, one = Source(), Source()
    assert [d for d, _, _ in token_files.read_file(all_of)] == list(range(100))
    ((doc, before, ids),) = token_files.read_file(one, {42})
    assert (doc, before, np.frombuffer(ids, "<u4").tolist()) == (42, 420, list(range(42, 52)))
    assert one.fetched < all_of.fetched / 2
    broken = bytearray(raw)
    broken[30] ^= 1
    raw = bytes(broken)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.read_file(Source()))

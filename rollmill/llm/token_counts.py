"""Token counts of documents that are kept up to date while the documents are edited.

A document is a row of slots, each of about ``SLOT_PIECES`` pre-token pieces and cut where no
pre-token can reach across (see ``bpe``). A segment tree over the slots holds sums of characters and
tokens. An edit is found by descending the tree; the slots it touches, and those within two
characters of it, are encoded anew as one text, and the sums above them are updated. All other
slots keep their counts, and the total always equals that of encoding the whole text.

``build_trees`` encodes whole texts once and keeps texts and slots as a table. ``apply_edits`` takes
such a table and a table of edits; ``apply_rules`` edits by patterns, without a shuffle. Both encode
only what edits touch. Edits of one document come one after the other, so each document's edits are
streamed, in order, through one task, which holds one document at a time.

Results: null and empty texts have no tokens; an edit counts from the text as the edits before it
left it, and one that reaches past the end is cut off there; edits of unknown or null doc_ids are
left out; rows that repeat a doc_id all get that document's edits; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollmill.llm.base import texts_of
from rollmill.llm.bpe import SAFE, WIDTH, Encoder, encoder

SLOT_PIECES = 16
# A slot that grows beyond this is cut anew, with the rest of its document.
MOST_SLOT_CHARS = 4096
TREE = "doc_id long, text string, slot_chars array<int>, slot_tokens array<int>"
COUNTS = "doc_id long, n_tokens long, n_tokens_after long, n_edits long, n_chars_encoded long"
Edit = tuple[int, int, str]
# Edits by rules with at most this many characters between them are made one.
NEAR = 128
# Characters around an edit on which a cut depends.
REACH = 2


def slots_of(text: str) -> list[str]:
    """A text in slots; together they are the text again."""
    if not text:
        return []
    head, *rest = SAFE.split(text)
    pieces = [head, *(f" {r}" for r in rest)]
    return ["".join(pieces[i : i + SLOT_PIECES]) for i in range(0, len(pieces), SLOT_PIECES)]


class TokenTree:
    """Segment tree over the slots of one document. Leaf i is node ``width + i``; node 1 is the root."""

    def __init__(self, encode: Encoder, slots: list[str], tokens: list[int] | None = None):
        self.encode, self.encoded = encode, 0
        self.load(slots, self.count(slots) if tokens is None else tokens)

    def count(self, texts: list[str]) -> list[int]:
        self.encoded += sum(map(len, texts))
        return [len(ids) // WIDTH for ids in self.encode.encode(texts)]

    def load(self, slots: list[str], tokens: list[int]) -> None:
        self.slots = slots
        self.width = 1 << max(len(slots) - 1, 0).bit_length()
        sums = np.zeros((2 * self.width, 2), dtype=np.int64)
        sums[self.width : self.width + len(slots), 0] = [len(s) for s in slots]
        sums[self.width : self.width + len(slots), 1] = tokens
        at = self.width
        while at > 1:
            sums[at // 2 : at] = sums[at : 2 * at].reshape(-1, 2, 2).sum(axis=1)
            at //= 2
        self.chars, self.tokens = sums[:, 0].tolist(), sums[:, 1].tolist()

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.slots)

    def find(self, at: int) -> tuple[int, int]:
        """The slot that holds a character, and the character's place in it."""
        node = 1
        while node < self.width:
            node *= 2
            if at >= self.chars[node]:
                at -= self.chars[node]
                node += 1
        return node - self.width, at

    def set(self, slot: int, text: str, tokens: int) -> None:
        self.slots[slot] = text
        node = self.width + slot
        chars, tokens = len(text) - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += chars
            self.tokens[node] += tokens
            node //= 2

    def edit(self, at: int, remove: int, insert: str) -> None:
        at = min(max(at, 0), self.n_chars)
        remove = min(max(remove, 0), self.n_chars - at)
        if not self.n_chars:
            slots = slots_of(insert)
            self.load(slots, self.count(slots))
            return
        first, inside = self.find(max(at - REACH, 0))
        inside += min(at, REACH)
        last, _ = self.find(min(at + remove, self.n_chars - 1))
        region = "".join(self.slots[first : last + 1])
        region = region[:inside] + insert + region[inside + remove :]
        if len(region) > MOST_SLOT_CHARS:
            new = slots_of(region)
            slots = self.slots[:first] + new + self.slots[last + 1 :]
            leaves = self.tokens[self.width : self.width + len(self.slots)]
            self.load(slots, leaves[:first] + self.count(new) + leaves[last + 1 :])
            return
        self.set(first, region, self.count([region])[0] if region else 0)
        for slot in range(first + 1, last + 1):
            if self.slots[slot]:
                self.set(slot, "", 0)

    def leaves(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of the slots that hold text."""
        kept = [i for i, s in enumerate(self.slots) if s]
        return [len(self.slots[i]) for i in kept], [self.tokens[self.width + i] for i in kept]


def stored(encode: Encoder, text: str, chars: list[int], tokens: list[int]) -> TokenTree:
    ends = np.cumsum(chars).tolist()
    return TokenTree(encode, [text[e - n : e] for e, n in zip(ends, chars)], tokens)


def tree_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    columns = zip(*rows) if rows else [[] for _ in kinds]
    names = ["doc_id", "text", "slot_chars", "slot_tokens"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def build_trees(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, text and the characters and tokens of each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            texts = texts_of(batch)
            counts = encode.slot_counts(texts, SLOT_PIECES)
            doc_ids = batch.column("doc_id").to_pylist()
            yield tree_batch([(d, t, *own) for d, t, own in zip(doc_ids, texts, counts)])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, TREE)


def apply_edits(trees: DataFrame, edits: DataFrame, tokenizer: str) -> DataFrame:
    """Trees after ``edits`` (doc_id, seq, at, remove, insert), in order of seq."""
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    numbered = trees.withColumn("copy", copy)
    copies = numbered.where("copy > 1").select("doc_id", "copy").union(
        edits.sparkSession.createDataFrame([], "doc_id long, copy int")
    )
    nothing = [F.lit(None).cast(k).alias(n) for n, k in (("seq", "long"), ("at", "long"), ("remove", "long"), ("insert", "string"))]
    doc_rows = numbered.select("doc_id", "copy", "text", "slot_chars", "slot_tokens", *nothing)
    no_tree = [F.lit(None).cast(k).alias(n) for n, k in (("text", "string"), ("slot_chars", "array<int>"), ("slot_tokens", "array<int>"))]
    own = edits.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long"),
        F.lit(1).alias("copy"),
        F.col("seq").cast("long"),
        F.col("at").cast("long"),
        F.col("remove").cast("long"),
        F.coalesce("insert", F.lit("")).alias("insert"),
    )
    again = own.drop("copy").join(copies, "doc_id")
    columns = ["doc_id", "copy", *no_tree, "seq", "at", "remove", "insert"]
    edit_rows = own.select(*columns).union(again.select(*columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        key, tree = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["slot_chars"] is not None:
                    if tree is not None:
                        out.append((key[0], tree.text(), *tree.leaves()))
                    key = (row["doc_id"], row["copy"])
                    tree = stored(encode, row["text"] or "", row["slot_chars"], row["slot_tokens"])
                elif key == (row["doc_id"], row["copy"]) and tree is not None:
                    tree.edit(row["at"], row["remove"], row["insert"])
            yield tree_batch(out)
        if tree is not None:
            yield tree_batch([(key[0], tree.text(), *tree.leaves())])

    both = doc_rows.unionByName(edit_rows)
    order = [F.col("doc_id"), F.col("copy"), F.col("slot_chars").isNull(), F.col("seq")]
    return both.repartition("doc_id", "copy").sortWithinPartitions(*order).mapInArrow(run, TREE)


def rule_edits(text: str, rules: list[tuple[re.Pattern, str]]) -> list[Edit]:
    """Edits by patterns, last first, so that the places of the others stay right; of matches that
    overlap the first stays."""
    found = sorted((m.start(), -m.end(), m.expand(to)) for rule, to in rules for m in rule.finditer(text))
    out, free = [], 0
    for start, end, to in found:
        if start >= free and -end > start:
            out.append((start, -end - start, to))
            free = -end
    return out[::-1]


def joined_edits(text: str, edits: list[Edit]) -> list[Edit]:
    """The same edits, last first, with those near each other made one, so that the text between them
    is encoded once and not once for each."""
    out: list[list] = []
    for at, remove, insert in edits:
        near = out and out[-1][0] - (at + remove) <= NEAR and out[-1][0] + out[-1][1] - at <= MOST_SLOT_CHARS // 4
        if near:
            later_at, later_remove, later = out[-1]
            out[-1] = [at, later_at + later_remove - at, [*later, text[at + remove : later_at], insert]]
        else:
            out.append([at, remove, [insert]])
    return [(at, remove, "".join(reversed(parts))) for at, remove, parts in out]


def apply_rules(trees: DataFrame, rules: list[tuple[str, str]], tokenizer: str) -> DataFrame:
    """Counts before and after the edits that ``rules`` (pattern, replacement) ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        compiled = [(re.compile(p), to) for p, to in rules]
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                edits = rule_edits(row["text"], compiled)
                before = sum(row["slot_tokens"])
                after = encoded = 0
                if edits:
                    tree = stored(encode, row["text"], row["slot_chars"], row["slot_tokens"])
                    for edit in joined_edits(row["text"], edits):
                        tree.edit(*edit)
                    after, encoded = tree.n_tokens, tree.encoded
                rows.append((row["doc_id"], before, after if edits else before, len(edits), encoded))
            columns = zip(*rows) if rows else [[]] * 5
            names = ["doc_id", "n_tokens", "n_tokens_after", "n_edits", "n_chars_encoded"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return trees.mapInArrow(run, COUNTS)

"""Token ids of whole texts by the ``tokenizers`` library, each distinct word encoded once.

A byte-level tokenizer first cuts a text into pre-tokens. A single space or line end between two
characters that are no white space always starts a new pre-token, so a text is cut there and the ids
of a piece are looked up. A piece not met lately goes through the library: as pre-tokens through its
model if it is a plain word with punctuation behind, else through the whole encoder. The result is
the same as encoding the whole text in one call.
"""

from __future__ import annotations

import os
import re
import struct
from functools import cache

import numpy as np

# White space other than a space or line end; with it, a text is cut with care.
ODD = re.compile(r"[^\S \n]")
SAFE = re.compile(r"(?<=\S) (?=\S)")
# Words whose pre-tokens are known without the library's pattern: letters, then punctuation.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
# Ids are kept as little-endian unsigned 32-bit numbers.
WIDTH = 4
# Pieces kept by a Python worker: at most two generations of this many, about 200 bytes each.
MEMO = 800_000


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: printable ones stand for
    themselves, the rest follow from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


LETTERS = byte_letters()


def needs_care(text: str) -> bool:
    """Whether a text has white space other than single spaces and line ends between other characters."""
    edge = text[:1] in (" ", "\n") or text[-1:] in (" ", "\n")
    return edge or "  " in text or " \n" in text or "\n " in text or "\n\n" in text or bool(ODD.search(text))


class Encoder:
    def __init__(self, path: str, memo: int = MEMO):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one worker a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.memo = memo
        # By what stands before a piece: nothing, or the space it was cut at.
        self.known: dict[str, dict[str, bytes]] = {"": {}, " ": {}}
        self.older: dict[str, dict[str, bytes]] = {"": {}, " ": {}}
        self.line_end = self.raw(["\n"])[0]

    def raw(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def pre_tokens(self, lead: str, words: list[str]) -> list[bytes]:
        """Ids of words that are one pre-token each, straight from the model."""
        tokenize = self.tokenizer.model.tokenize
        out = []
        for word in words:
            ids = [t.id for t in tokenize((lead + word).encode().decode("latin-1").translate(LETTERS))]
            out.append(struct.pack(f"<{len(ids)}I", *ids))
        return out

    def learn(self, lead: str, pieces: set[str]) -> None:
        known, older = self.known[lead], self.older[lead]
        if len(known) >= self.memo:
            self.older[lead], known, older = known, {}, known
            self.known[lead] = known
        plain, other, behind = set(), [], []
        for p in pieces:
            ids = older.get(p)
            if ids is not None:
                known[p] = ids
            elif m := PLAIN.fullmatch(p):
                word, tail = m.groups()
                if tail:
                    behind.append((p, word, tail))
                if word in older:
                    known[word] = older[word]
                elif word not in known:
                    plain.add(word)
            else:
                other.append(p)
        words = list(plain)
        known.update(zip(words, self.pre_tokens(lead, words)))
        known.update(zip(other, self.raw([lead + p for p in other])))
        if behind:
            tails = list({tail for _, _, tail in behind})
            ids_of = dict(zip(tails, self.raw(tails)))
            known.update((p, known[word] + ids_of[tail]) for p, word, tail in behind)

    def look_up(self, lead: str, rows: list[list[str]]) -> list[bytes]:
        get = self.known[lead].get
        found = [list(map(get, row)) for row in rows]
        new = {p for row, ids in zip(rows, found) if None in ids for p, i in zip(row, ids) if i is None}
        if new:
            self.learn(lead, new)
            get = self.known[lead].get
            found = [
                [get(p) if i is None else i for p, i in zip(row, ids)] if None in ids else ids
                for row, ids in zip(rows, found)
            ]
        return [b"".join(ids) for ids in found]

    def slot_counts(self, texts: list[str], size: int) -> list[tuple[list[int], list[int]]]:
        """Characters and tokens of every ``size`` pieces of each text. A piece begins at a single space between
        characters that are no white space; each is looked up once, in the place it has in its text."""
        spaced, starting, ends, chars, slots = [], [], [], [], []
        for text in texts:
            careful = needs_care(text)
            pieces = (SAFE.split(text) if careful else text.split(" ")) if text else []
            lines = not careful and "\n" in text
            for at in range(0, len(pieces), size):
                own = pieces[at : at + size]
                chars.append(sum(map(len, own)) + len(own) - (at == 0))
                if not lines:
                    starting.append(own[:1] if at == 0 else [])
                    spaced.append(own[1:] if at == 0 else own)
                    ends.append(0)
                    continue
                after_space, alone, found = [], [], 0
                for place, piece in enumerate(own, at):
                    first, *more = piece.split("\n")
                    (after_space if place else alone).append(first)
                    alone += more
                    found += len(more)
                starting.append(alone)
                spaced.append(after_space)
                ends.append(found)
            slots.append(len(chars))
        width = len(self.line_end) // WIDTH
        found = zip(self.look_up("", starting), self.look_up(" ", spaced), ends)
        tokens = [(len(a) + len(b)) // WIDTH + n * width for a, b, n in found]
        return [(chars[a:b], tokens[a:b]) for a, b in zip([0, *slots], slots)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every whole text, as bytes."""
        heads, rests, ends = [], [], []
        for text in texts:
            if needs_care(text):
                rows = [SAFE.split(text)]
            else:
                rows = [line.split(" ") for line in text.split("\n")]
            heads.append([row[0] for row in rows])
            rests += [row[1:] for row in rows]
            ends.append(len(rests))
        rest_ids = self.look_up(" ", rests)
        head_ids = self.look_up("", [[h] for row in heads for h in row])
        lines = [h + r for h, r in zip(head_ids, rest_ids)]
        return [self.line_end.join(lines[a:b]) for a, b in zip([0, *ends], ends)]


@cache
def encoder(path: str) -> Encoder:
    """One encoder, with what it has met, for each Python worker."""
    return Encoder(path)

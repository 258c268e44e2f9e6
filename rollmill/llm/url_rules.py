"""URL filters: glob rules in one bit-parallel automaton.

Every glob is a chain of states, one for each of its characters and one before them; all chains lie side
by side in the words of one bit mask. A character of a URL moves all states of all globs at once:

    states = (states << 1 & step[character]) | (states & stay[character])

``step`` has the states that the character enters, ``stay`` those that a wildcard lets wait there. The
mask has as many 64-bit words as the globs need, with carries from word to word, and one array operation
moves it for all URLs of a batch. Globs lie in the order of their rank, so the lowest accepting bit names
the rule that wins.

A URL is judged in its canonical form: host in lower case, path and query; scheme and fragment are left
out. Globs match all of it: ``**`` any characters, ``*`` any but ``/`` and ``?``, ``?`` one character but
``/``, ``[ab]`` one of these, ``[!ab]`` none of these, ``\\`` takes the next character as it is.

A host rule fits its host and all subdomains where the path starts with the rule's path; it becomes two
globs. Host rules go before globs, longer before shorter, then in the order given.

Results: a null URL, an empty one or one without ``://`` has an empty host and path and the canonical
form ``""``, so that only a glob like ``**`` fits it. Nothing fits: ``default``. Very long URLs are read to
their end, in memory of their own size. Repeated rows are judged alike, other columns are carried along,
new columns get underscores before their names where the table has them already, an empty table gives
no rows. The rules are a parameter and go to every task with the automaton: a bit for each character.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmill.llm.base import fresh, texts_of, with_columns

NO_GAP, IN_SEGMENT, ANYWHERE = 0, 1, 2
ENDS_SEGMENT = "/?"
# URLs are walked in groups of at most so many characters (one longer URL makes a group of its own) and
# so many bytes of states.
GROUP_CHARACTERS, GROUP_BYTES = 1 << 20, 1 << 22
# So few URLs that are still unread are walked one by one, their states as one number each.
FEW = 3


@dataclass(frozen=True)
class HostRule:
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> list[str]:
        plain = escaped(self.host.lower()), escaped(self.path)
        return [f"{plain[0]}{plain[1]}**", f"*.{plain[0]}{plain[1]}**"]


@dataclass(frozen=True)
class GlobRule:
    action: str
    glob: str

    @property
    def name(self) -> str:
        return self.glob

    def globs(self) -> list[str]:
        return [self.glob]


def escaped(text: str) -> str:
    return "".join(f"\\{c}" if c in "*?[\\" else c for c in text)


def ranked(rules: Sequence[HostRule | GlobRule]) -> list[HostRule | GlobRule]:
    return sorted(rules, key=lambda r: (isinstance(r, GlobRule), -len(r.name)))


@dataclass(frozen=True)
class OneOf:
    """A character of a glob: one of these, or none of these."""

    characters: frozenset[str]
    inside: bool = True

    def takes(self, character: str) -> bool:
        return (character in self.characters) == self.inside


def parse_glob(glob: str) -> tuple[list[OneOf], list[int]]:
    """The characters of a glob, and the gaps before each of them and at the end."""
    taken: list[OneOf] = []
    gaps = [NO_GAP]
    at = 0
    while at < len(glob):
        c = glob[at]
        if c == "*":
            wide = glob.startswith("**", at)
            gaps[-1] = max(gaps[-1], ANYWHERE if wide else IN_SEGMENT)
            at += 2 if wide else 1
            continue
        if c == "[":
            end = glob.find("]", at + 2)
            if end < 0:
                raise ValueError(f"no end of [ in glob {glob!r}")
            inner = glob[at + 1 : end]
            negated = inner.startswith("!") and len(inner) > 1
            taken.append(OneOf(frozenset(inner[negated:]), not negated))
            at = end
        elif c == "?":
            taken.append(OneOf(frozenset("/"), False))
        elif c == "\\":
            if at + 1 == len(glob):
                raise ValueError(f"nothing after \\ in glob {glob!r}")
            at += 1
            taken.append(OneOf(frozenset(glob[at])))
        else:
            taken.append(OneOf(frozenset(c)))
        gaps.append(NO_GAP)
        at += 1
    return taken, gaps


class Automaton:
    """Finds, for each of many texts, the first of the globs that match all of it."""

    def __init__(self, globs: Sequence[str]) -> None:
        parsed = [parse_glob(g) for g in globs]
        named = {c for taken, _ in parsed for one in taken for c in one.characters}
        letters = sorted(named | set(ENDS_SEGMENT))
        self.codes = np.array([ord(c) for c in letters], dtype=np.uint32)
        bits = sum(len(gaps) for _, gaps in parsed)
        self.words = max(1, -(-bits // 64))
        # Row 0 is any character that no glob names.
        symbols: list[str] = ["", *letters]
        step = np.zeros((len(symbols), self.words * 64), dtype=bool)
        stay = np.zeros_like(step)
        start = np.zeros(self.words * 64, dtype=bool)
        accept = np.zeros(self.words * 64, dtype=bool)
        self.owner = np.full(self.words * 64, -1, dtype=np.int64)
        bit = 0
        for number, (taken, gaps) in enumerate(parsed):
            start[bit] = True
            for state, gap in enumerate(gaps):
                for row, symbol in enumerate(symbols):
                    if state:
                        step[row, bit + state] = taken[state - 1].takes(symbol)
                    stay[row, bit + state] = gap == ANYWHERE or (
                        gap == IN_SEGMENT and (not symbol or symbol not in ENDS_SEGMENT)
                    )
            bit += len(gaps)
            accept[bit - 1] = True
            self.owner[bit - 1] = number
        self.step, self.stay, self.start, self.accept = map(self._packed, (step, stay, start, accept))

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=-1, bitorder="little").view("<u8")

    def first_matches(self, texts: Sequence[str]) -> np.ndarray:
        """The number of the first matching glob for each text, -1 for none."""
        found = np.full(len(texts), -1, dtype=np.int64)
        most = max(1, GROUP_BYTES // (8 * self.words))
        begin = size = 0
        for at, text in enumerate(texts):
            if at > begin and (size + len(text) > GROUP_CHARACTERS or at - begin >= most):
                found[begin:at] = self._walk(texts[begin:at])
                begin, size = at, 0
            size += len(text)
        if begin < len(texts):
            found[begin:] = self._walk(texts[begin:])
        return found

    def _symbols(self, texts: Sequence[str]) -> np.ndarray:
        read = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        place = np.minimum(np.searchsorted(self.codes, read), len(self.codes) - 1)
        return np.where(self.codes[place] == read, place + 1, 0)

    def _walk(self, texts: Sequence[str]) -> np.ndarray:
        symbols = self._symbols(texts)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        begins = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        lengths, begins = lengths[order], begins[order]
        states = np.tile(self.start, (len(texts), 1))
        unread = np.searchsorted(-lengths, -np.arange(lengths[0] + 1), side="left")  # at each step, how many go on
        for t in range(int(lengths[0])):
            n = int(unread[t])
            if n <= FEW:
                for row in range(n):
                    rest = symbols[begins[row] + t : begins[row] + lengths[row]]
                    states[row] = self._walk_one(states[row], rest)
                break
            symbol = symbols[begins[:n] + t]
            now = states[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            states[:n] = (moved & self.step[symbol]) | (now & self.stay[symbol])
        hits = states & self.accept
        word = np.argmax(hits != 0, axis=1)
        hit = hits[np.arange(len(texts)), word]
        lowest = hit & (~hit + np.uint64(1))
        bit = np.log2(np.maximum(lowest, 1).astype(np.float64)).astype(np.int64)
        found = np.empty(len(texts), dtype=np.int64)
        found[order] = np.where(hit != 0, self.owner[word * 64 + bit], -1)
        return found

    def _walk_one(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        step = [int.from_bytes(row.tobytes(), "little") for row in self.step]
        stay = [int.from_bytes(row.tobytes(), "little") for row in self.stay]
        now = int.from_bytes(states.tobytes(), "little")
        for symbol in symbols.tolist():
            now = ((now << 1) & step[symbol]) | (now & stay[symbol])
            if not now:
                break
        return np.frombuffer(now.to_bytes(self.words * 8, "little"), dtype="<u8")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?`` or ``#``, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_query(url: Column) -> Column:
    """From ``?`` up to ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1), F.lit(""))


def judge_urls(
    pages: DataFrame, rules: Sequence[HostRule | GlobRule], url: str = "url", default: str = "allow"
) -> DataFrame:
    """Appends host, path, rule (the host rule that fits, or null), pattern (the glob rule that fits, or null)
    and verdict."""
    order = ranked(rules)
    automaton = Automaton([g for rule in order for g in rule.globs()])
    owner = [number for number, rule in enumerate(order) for _ in rule.globs()]
    of_host = [r.name if isinstance(r, HostRule) else None for r in order] + [None]
    of_glob = [r.name if isinstance(r, GlobRule) else None for r in order] + [None]
    actions = [r.action for r in order] + [default]

    host, path = fresh(pages, "host"), fresh(pages, "path")
    canonical = fresh(pages, "canonical")
    named = [fresh(pages, n) for n in ("rule", "pattern", "verdict")]
    address = F.col(f"`{url}`")
    read = pages.select(
        "*",
        url_host(address).alias(host),
        url_path(address).alias(path),
        F.concat(url_host(address), url_path(address), url_query(address)).alias(canonical),
    )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        winners = np.array([*owner, len(order)], dtype=np.int64)  # -1 is the last: no rule
        for batch in batches:
            won = winners[automaton.first_matches(texts_of(batch, canonical))].tolist()
            yield [pa.array([texts[w] for w in won], pa.string()) for texts in (of_host, of_glob, actions)]

    fields = [T.StructField(n, T.StringType()) for n in named]
    return with_columns(read, fields, judged).drop(canonical)

"""strptime-style time formats as Spark column expressions.

One ``TimeFormat`` both reads and prints. The session time zone must be UTC
(``rollmill.session.configure``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strptime directive -> Spark datetime pattern.
DIRECTIVES = {
    "a": "EEE",
    "A": "EEEE",
    "b": "MMM",
    "B": "MMMM",
    "c": "EEE MMM dd HH:mm:ss yyyy",
    "d": "dd",
    "f": "SSS",
    "H": "HH",
    "I": "hh",
    "j": "DDD",
    "m": "MM",
    "M": "mm",
    "p": "a",
    "S": "ss",
    "x": "MM/dd/yy",
    "X": "HH:mm:ss",
    "y": "yy",
    "Y": "yyyy",
    "z": "Z",
    "Z": "zzz",
}
EPOCH_FORMATS = ("posix", "millis", "micros")
# Weeks that start on Sunday or Monday, of which those before the first such day are week 0, and the number
# of the weekday, Sunday 0. Spark has no pattern for these.
WEEK_DIRECTIVES = ("U", "W", "w")
_WEEKDAYS = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")

_DAY_NAMES = r"(?i)\b(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\b"
# Two-letter number fields that may also be read with a single digit.
_LOOSE = {"dd": "d", "HH": "H", "hh": "h", "MM": "M", "mm": "m", "ss": "s"}
_NUMERIC = re.compile(r"^(?:yyyy|yy|MM|dd|HH|hh|mm|ss|SSS|DDD)$")


@dataclass(frozen=True)
class _Piece:
    text: str
    literal: bool


def _pieces(spec: str) -> list[_Piece]:
    """Split a strptime format into literal text and Spark pattern fields."""
    out: list[_Piece] = []
    at = 0
    while at < len(spec):
        char = spec[at]
        if char != "%":
            out.append(_Piece(char, True))
            at += 1
            continue
        code = spec[at + 1 : at + 2]
        if code == "%":
            out.append(_Piece("%", True))
        elif code in WEEK_DIRECTIVES and code:
            out.append(_Piece(f"%{code}", False))
        elif code in DIRECTIVES and code:
            # composite directives fall apart into fields and the literals between them
            for part in re.findall(r"[A-Za-z]+|[^A-Za-z]", DIRECTIVES[code]):
                out.append(_Piece(part, not part[0].isalpha()))
        else:
            raise ValueError(f"time format {spec!r}: directive %{code} cannot be converted")
        at += 2
    return out


def _quote(text: str) -> str:
    """Quote what a pattern would read as a field or an option."""
    out, quoted = [], False
    for char in text:
        if char == "'":
            # a doubled quote is a quote, inside and outside of quoted text
            out.append("''")
            continue
        special = char in "[]{}#" or (char.isascii() and char.isalpha())
        if special != quoted:
            out.append("'")
            quoted = special
        out.append(char)
    if quoted:
        out.append("'")
    return "".join(out)


def _assemble(pieces: list[_Piece]) -> str:
    out, run = [], ""
    for piece in pieces:
        if piece.literal:
            run += piece.text
            continue
        if piece.text[0] == "%":
            raise ValueError(f"no pattern for {piece.text}")
        out.append(_quote(run))
        run = ""
        out.append(piece.text)
    out.append(_quote(run))
    return "".join(out)


def print_pattern(spec: str) -> str:
    """Spark pattern that prints the strptime format."""
    return _assemble(_pieces(spec))


def _read_pieces(spec: str) -> list[_Piece]:
    """Pieces for reading: no day names (they carry no information and Spark refuses to read them),
    fractions of three or six digits, and one digit allowed in a number between non-digits."""
    kept = [p for p in _pieces(spec) if p.literal or not p.text.startswith("E")]

    def numeric(i: int) -> bool:
        return 0 <= i < len(kept) and not kept[i].literal and bool(_NUMERIC.match(kept[i].text))

    def digit_literal(i: int) -> bool:
        return 0 <= i < len(kept) and kept[i].literal and kept[i].text.isdigit()

    out = []
    for i, piece in enumerate(kept):
        text = piece.text
        if not piece.literal:
            alone = not any(numeric(j) or digit_literal(j) for j in (i - 1, i + 1))
            if text == "SSS":
                if not alone:
                    raise ValueError(f"time format {spec!r}: %f needs a separator from other digits")
                text = "[SSSSSS][SSS]"
            elif alone:
                text = _LOOSE.get(text, text)
        out.append(_Piece(text, piece.literal))
    return out


def read_pattern(spec: str) -> str:
    """Spark pattern that reads the strptime format."""
    return _assemble(_read_pieces(spec))


# What a field that is not a two-digit number looks like.
_LOOKS = {
    "yyyy": r"\d{4}",
    "DDD": r"\d{3}",
    "[SSSSSS][SSS]": r"(?:\d{6}|\d{3})",
    "MMM": r"[A-Za-z]+",
    "MMMM": r"[A-Za-z]+",
    "a": r"[AaPp][Mm]",
    "Z": r"[+-]\d{4}",
    "zzz": r"[A-Za-z][A-Za-z0-9/_+\-]*",
}


def read_regex(spec: str) -> str:
    """Regex for the beginning of a text that may go on after the time."""
    looks = (
        re.escape(p.text) if p.literal else _LOOKS.get(p.text, r"\d{1,2}" if len(p.text) == 1 else r"\d{2}")
        for p in _read_pieces(spec)
    )
    return "^" + "".join(looks)


def week_number(time: Column, starts: str) -> Column:
    """Week of the year from 0, by ``U`` (starts on Sunday) or ``W`` (on Monday)."""
    since = F.dayofweek(time) - 1 if starts == "U" else F.weekday(time)
    return F.call_function("div", F.dayofyear(time) + 6 - since, F.lit(7)).cast("int")


def week_date(year: Column, week: Column, since: Column, starts: str) -> Column:
    """The day ``since`` days after the start of a week."""
    first = F.make_date(year, F.lit(1), F.lit(1))
    offset = F.dayofweek(first) - 1 if starts == "U" else F.weekday(first)
    # days from New Year to the start of week 1, then on
    start = F.pmod(F.lit(7) - offset, F.lit(7)) + (week - 1) * 7
    return F.date_add(first, (start + since).cast("int"))


def _weekly(spec: str) -> bool:
    return any(p.text[0] == "%" and not p.literal for p in _pieces(spec))


def _read_week(spec: str, text: Column) -> Column:
    """Read a format that has weeks or numbers of weekdays: its fields are taken apart, the date is put in
    place of the week, and the rest is read by a pattern. A month or a day of the year makes the week
    redundant; a week without a weekday is its first day that lies in the year."""
    pieces = _pieces(spec)
    codes = [p.text for p in pieces if not p.literal]
    looks = {"%U": r"\d{1,2}", "%W": r"\d{1,2}", "%w": "[0-6]", "EEE": "[A-Za-z]+", "EEEE": "[A-Za-z]+", **_LOOKS}
    looks["SSS"] = r"\d{6}|\d{3}"
    regex = "^" + "".join(re.escape(p.text) if p.literal else f"({looks.get(p.text, '[0-9]{1,2}')})" for p in pieces)

    def field(code: str) -> Column:
        return F.regexp_extract(text, regex, codes.index(code) + 1)

    dated = {"MM", "MMM", "MMMM", "dd", "DDD"} & set(codes)
    starts = next((c[1] for c in codes if c in ("%U", "%W")), None)
    left_out = {"%U", "%W", "%w", "EEE", "EEEE"}
    parts, patterns = [], []
    if not dated and starts:
        year, week = field("yyyy").try_cast("int"), field(f"%{starts}").try_cast("int")
        if "%w" in codes:
            day = field("%w").try_cast("int")
        elif (name := next((c for c in codes if c.startswith("E")), None)) is not None:
            known = F.array(*(F.lit(d) for d in _WEEKDAYS))
            day = F.nullif(F.array_position(known, F.lower(F.left(field(name), F.lit(3)))), F.lit(0)).cast("int") - 1
        else:
            day = None
        if day is None:
            first = F.make_date(year, F.lit(1), F.lit(1))
            date = F.greatest(first, week_date(year, week, F.lit(0), starts))
        else:
            date = week_date(year, week, day if starts == "U" else F.pmod(day + 6, F.lit(7)), starts)
        parts.append(F.date_format(F.when(week <= 53, date), "yyyy-MM-dd"))
        patterns.append("yyyy-MM-dd")
        left_out.add("yyyy")
    for code in codes:
        if code not in left_out:
            parts.append(field(code))
            patterns.append("[SSSSSS][SSS]" if code == "SSS" else _LOOSE.get(code, code))
    return F.when(text.rlike(regex), F.try_to_timestamp(F.concat_ws(" ", *parts), F.lit(" ".join(patterns))))


def _check_weeks(spec: str) -> None:
    codes = [p.text for p in _pieces(spec) if not p.literal]
    dated = {"MM", "MMM", "MMMM", "dd", "DDD"} & set(codes)
    repeated = sorted({c for c in codes if codes.count(c) > 1})
    if repeated:
        raise ValueError(f"time format {spec!r}: a field is given twice beside a week")
    if not dated and not ({"%U", "%W"} & set(codes) and "yyyy" in codes):
        raise ValueError(f"time format {spec!r}: a weekday or week needs %Y and a week, or a month and day")


@dataclass(frozen=True)
class TimeFormat:
    """``None`` (ISO-8601 or epoch millis), an epoch unit, or a strptime format."""

    spec: str | None = None

    @staticmethod
    @lru_cache(maxsize=256)
    def of(spec: str | None) -> TimeFormat:
        fmt = TimeFormat(spec)
        if spec is not None and spec not in EPOCH_FORMATS:
            if _weekly(spec):
                _check_weeks(spec)
            else:
                print_pattern(spec)
                read_pattern(spec)
        return fmt

    def parse(self, text: Column) -> Column:
        """STRING to TIMESTAMP; NULL where the text does not fit."""
        if self.spec is None:
            return F.coalesce(text.try_cast("timestamp"), F.timestamp_millis(text.try_cast("bigint")))
        if self.spec == "posix":
            return F.timestamp_seconds(text.try_cast("bigint"))
        if self.spec == "millis":
            return F.timestamp_millis(text.try_cast("bigint"))
        if self.spec == "micros":
            return F.timestamp_micros(text.try_cast("bigint"))
        codes = [p.text for p in _pieces(self.spec) if not p.literal]
        if _weekly(self.spec):
            return self._this_century(_read_week(self.spec, text), codes)
        if any(c.startswith("E") for c in codes):
            text = F.regexp_replace(text, _DAY_NAMES, "")
        pattern = F.lit(read_pattern(self.spec))
        # text after the time is ignored; it is only cut off where the whole does not fit
        head = F.regexp_extract(text, read_regex(self.spec), 0)
        found = F.coalesce(F.try_to_timestamp(text, pattern), F.try_to_timestamp(head, pattern))
        return self._this_century(found, codes)

    def _this_century(self, found: Column, codes: list[str]) -> Column:
        if "yy" in codes and "yyyy" not in codes:
            # two-digit years lie within 80 years before and 20 years after now
            century = F.make_ym_interval(F.lit(100))
            limit = F.current_timestamp() + F.make_ym_interval(F.lit(20))
            found = F.when(found > limit, found - century).otherwise(found)
        return found

    def format(self, time: Column) -> Column:
        """DATE or TIMESTAMP to STRING."""
        time = time.cast("timestamp")
        if self.spec is None or self.spec == "millis":
            return F.unix_millis(time).cast("string")
        if self.spec == "posix":
            return F.call_function("div", F.unix_millis(time), F.lit(1000)).cast("string")
        if self.spec == "micros":
            return F.unix_micros(time).cast("string")
        if not _weekly(self.spec):
            return F.date_format(time, print_pattern(self.spec))
        shown, run = [], []
        for piece in [*_pieces(self.spec), _Piece("%end", False)]:
            if piece.literal or piece.text[0] != "%":
                run.append(piece)
                continue
            if run:
                shown.append(F.date_format(time, _assemble(run)))
                run = []
            if piece.text == "%w":
                shown.append((F.dayofweek(time) - 1).cast("string"))
            elif piece.text != "%end":
                shown.append(F.lpad(week_number(time, piece.text[1]).cast("string"), 2, "0"))
        return F.concat(*shown)

    def keeps(self, unit_millis: int) -> bool:
        """Whether a printed and re-read time stays inside its span of ``unit_millis`` after the epoch."""
        if self.spec is None or self.spec in ("millis", "micros"):
            return True
        if self.spec == "posix":
            return unit_millis % 1000 == 0
        codes = {p.text for p in _pieces(self.spec) if not p.literal}
        month = codes & {"MM", "MMM", "MMMM"}
        week = codes & {"%U", "%W"} and codes & {"%w", "EEE", "EEEE"}
        day = "yyyy" in codes and ("DDD" in codes or (month and "dd" in codes) or week)
        hour = "HH" in codes or {"hh", "a"} <= codes
        if unit_millis % 86_400_000 == 0:
            return bool(day)
        if unit_millis % 3_600_000 == 0:
            return bool(day and hour)
        if unit_millis % 60_000 == 0:
            return bool(day and hour and "mm" in codes)
        return bool(unit_millis % 1000 == 0 and day and hour and {"mm", "ss"} <= codes)

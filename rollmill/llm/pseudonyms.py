"""Format-preserving pseudonyms for personal numbers, dates and e-mail names, in SQL functions only.

A value is found by pattern and validated (check digit, octets, calendar, area codes); its digits
become a pair of numbers (a, b) with a < A and b < B, where A * B counts all valid values of the
format. A Feistel network over that pair, a += f(b) mod A and b += f(a) mod B in turn, is a
permutation of the valid values for any A and B: the result is again a valid value, different values
stay different, and equal values get equal pseudonyms in every document and every run of one key.
``f`` is SHA-256 of key, kind, round and number. ``restore=True`` walks the rounds backwards.

A text is looked through four times, and a candidate that fails validation stays in the text for the
looks after it: e-mails, dates, social numbers, addresses and phones; cards written unbroken or in
the usual groups, tried from every group on, so that numbers beside them do not matter; phones that
could have been the end of such a card; cards in other groups. Of cards that overlap, the first valid
one counts. One in ten numbers has a right check digit: where a stretch that is no card overlaps a
value (a year before a card in groups of four), it may be taken for one, here or when restoring.

The key stands in the query plan: hand it out, and plans with it, as you would the documents.

| kind | found as | permuted | kept |
| --- | --- | --- | --- |
| card | 13 to 19 digits, single spaces or hyphens between, check digit right | all but the last digit | separators; the check digit is right again |
| phone | ten digits with an area code and exchange of 200 or more, `+1` before or not | both and the last four digits | `+1`, brackets, separators |
| social | ddd-dd-dddd, valid ranges | all digits | hyphens |
| ip | four octets | all octets | dots |
| date | yyyy-mm-dd or dd/mm/yyyy, 1700 to 2099 | the day of the 400-year cycle | order and separators |
| email | name@domain | letters and digits of the name, in base 36, whatever their case | other characters, the domain; a capital where a letter stands |

Results: null stays null and empty stays empty; a text of any length is one row's work and linear in
its length; other columns are carried along; repeated rows get equal texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.llm.base import fresh

ROUNDS = 12
CENTURIES = 146_097  # days of 400 Gregorian years, 189 * 773
LONGEST_NAME = 22  # characters of an e-mail name permuted together: 36^11 fits a long

# A full stop before a value is part of it only behind a digit.
BEFORE, AFTER = r"(?<![0-9A-Za-z+])(?<!\d\.)", r"(?![0-9A-Za-z])"
PATTERNS = {
    "email": r"(?<![0-9A-Za-z._%+-])(?=[._%+-]*[0-9A-Za-z])[0-9A-Za-z._%+-]+@[0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)+",
    "date": BEFORE + r"(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4})" + AFTER,
    "social": BEFORE + r"\d{3}-\d{2}-\d{4}" + AFTER,
    "card": BEFORE + r"\d(?:[ -]?\d){12,18}" + AFTER,
    "phone": r"(?<![0-9A-Za-z])(?<!\d\.)(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-]?)\d{3}[ .-]?\d{4}" + AFTER,
    "ip": BEFORE + r"\d{1,3}(?:\.\d{1,3}){3}" + r"(?![0-9A-Za-z]|\.\d)",
}
# A phone that may be the end of a card in groups of 4-6-4, or start with a card's last group.
UNSURE = r"(?!(?<=\d{4}[ -])(?:1\d{3}|\d{6})[ .-])"
SURE = "|".join(UNSURE + p if kind == "phone" else p for kind, p in PATTERNS.items() if kind != "card")
# Digits, spaces and hyphens that may hold a card, with the word that ends them.
STRETCH = BEFORE + r"\d[\d -]{11,}+[A-Za-z]*+"
# Cards as they are usually written, from the start of a group on; the second form is tried after the first.
CARDS = (
    r"^(?:\d{13,19}|\d{4}([ -])(?:\d{4}\1\d{4}\1\d{4}|\d{6}\1\d{4,5}))(?![0-9A-Za-z])",
    r"^\d{4}([ -])(?:\d{4}\1){2,3}\d{1,3}(?![0-9A-Za-z])",
)
MOST_GROUPS = 5
# Stand in the text for the values found by each look; no characters of Unicode, and kept where met.
MARKS = ("\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3")


def long(text: Column) -> Column:
    return text.try_cast("long")


class Permuter:
    """Permutes pairs of numbers, and by them texts of each kind."""

    def __init__(self, key: str, restore: bool = False):
        self.key, self.restore = key, restore

    def pair(self, kind: str, a: Column, b: Column, size_a: Column | int, size_b: Column | int) -> Column:
        def f(number: Column, i: Column) -> Column:
            told = F.concat_ws("|", F.lit(self.key), F.lit(kind), i.cast("string"), number.cast("string"))
            value = F.conv(F.substring(F.sha2(told, 256), 1, 15), 16, 10).cast("long")
            return -value if self.restore else value

        def step(state: Column, i: Column) -> Column:
            x, y = state["a"], state["b"]
            even = i % 2 == 0
            return F.struct(
                F.when(even, F.pmod(x + f(y, i), size_a)).otherwise(x).alias("a"),
                F.when(even, y).otherwise(F.pmod(y + f(x, i), size_b)).alias("b"),
            )

        size_a, size_b = (s if isinstance(s, Column) else F.lit(s).cast("long") for s in (size_a, size_b))
        order = range(ROUNDS - 1, -1, -1) if self.restore else range(ROUNDS)
        rounds = F.array(*(F.lit(i) for i in order))
        return F.aggregate(rounds, F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)

    def bind(self, value: Column, then) -> Column:
        """``then(value)`` with the value computed once."""
        return F.transform(F.array(value), then)[0]

    def card(self, m: Column) -> Column:
        digits = F.regexp_replace(m, "[ -]", "")
        n = F.length(digits) - 1
        half = F.floor(n / 2).cast("int")
        size = lambda k: F.rpad(F.lit("1"), (k + 1).cast("int"), F.lit("0")).cast("long")
        a, b = long(F.substring(digits, F.lit(1), half)), long(F.substring(digits, half + 1, n - half))

        def shown(p: Column) -> Column:
            body = F.concat(
                F.lpad(p["a"].cast("string"), half, F.lit("0")), F.lpad(p["b"].cast("string"), n - half, F.lit("0"))
            )
            check = F.filter(
                F.sequence(F.lit(0), F.lit(9)), lambda d: F.call_function("luhn_check", F.concat(body, d.cast("string")))
            )
            return fill(m, F.concat(body, check[0].cast("string")), "0123456789")

        return self.bind(self.pair("card", a, b, size(half), size(n - half)), shown)

    def phone(self, m: Column) -> Column:
        digits = F.right(F.regexp_replace(m, "[^0-9]", ""), F.lit(10))
        a = long(F.substring(digits, 1, 3)) - 200
        b = long(F.substring(digits, 4, 7)) - 2_000_000
        lead = F.regexp_extract(m, r"^(\+?1[ .-]?)?(?=\(|\d{3}[ .-]?\d{3}[ .-]?\d{4}$)", 1)

        def shown(p: Column) -> Column:
            made = F.concat((p["a"] + 200).cast("string"), (p["b"] + 2_000_000).cast("string"))
            rest = F.substring(m, F.length(lead) + 1, F.length(m))
            return F.concat(lead, fill(rest, made, "0123456789"))

        return self.bind(self.pair("phone", a, b, 800, 8_000_000), shown)

    def social(self, m: Column) -> Column:
        """Areas 1 to 899 without 666, groups 1 to 99, serials 1 to 9999."""
        area = long(F.substring(m, 1, 3))
        a = F.when(area > 666, area - 2).otherwise(area - 1)
        b = (long(F.substring(m, 5, 2)) - 1) * 9999 + long(F.substring(m, 8, 4)) - 1

        def shown(p: Column) -> Column:
            area = F.when(p["a"] >= 665, p["a"] + 2).otherwise(p["a"] + 1)
            return F.format_string(
                "%03d-%02d-%04d", area, F.floor(p["b"] / 9999).cast("long") + 1, F.pmod(p["b"], F.lit(9999)) + 1
            )

        return self.bind(self.pair("social", a, b, 898, 99 * 9999), shown)

    def ip(self, m: Column) -> Column:
        octets = F.transform(F.split(m, r"\."), lambda o: long(o))
        low = lambda x: F.pmod(x, F.lit(256)).cast("string")
        high = lambda x: F.floor(x / 256).cast("string")
        found = self.pair("ip", octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], 65_536, 65_536)
        return self.bind(found, lambda p: F.concat_ws(".", high(p["a"]), low(p["a"]), high(p["b"]), low(p["b"])))

    def date(self, m: Column) -> Column:
        day = F.date_diff(day_of(m), F.lit("1700-01-01").cast("date")).cast("long")
        found = self.pair("date", F.floor(day / 773), F.pmod(day, F.lit(773)), 189, 773)

        def shown(p: Column) -> Column:
            date = F.date_add(F.lit("1700-01-01").cast("date"), (p["a"] * 773 + p["b"]).cast("int"))
            return F.when(m.contains("/"), F.date_format(date, "dd/MM/yyyy")).otherwise(F.date_format(date, "yyyy-MM-dd"))

        return self.bind(found, shown)

    def email(self, m: Column) -> Column:
        name = F.substring_index(m, "@", 1)
        plain = F.lower(F.regexp_replace(name, "[^0-9A-Za-z]", ""))
        starts = F.sequence(F.lit(1), F.greatest(F.length(plain), F.lit(1)), F.lit(LONGEST_NAME))

        def part(at: Column) -> Column:
            own = F.substring(plain, at, F.lit(LONGEST_NAME))
            half = F.ceil(F.length(own) / 2).cast("int")
            rest = F.length(own) - half
            number = lambda t: F.coalesce(F.conv(F.when(t != "", t).otherwise("0"), 36, 10).cast("long"), F.lit(0))
            size = lambda k: F.conv(F.rpad(F.lit("1"), k + 1, F.lit("0")), 36, 10).cast("long")
            text = lambda x, k: F.lpad(F.lower(F.conv(x.cast("string"), 10, 36)), k, F.lit("0"))
            a, b = number(F.substring(own, F.lit(1), half)), number(F.substring(own, half + 1, rest))
            found = self.pair("email", a, b, size(half), size(rest))
            return self.bind(found, lambda p: F.concat(text(p["a"], half), text(p["b"], rest)))

        made = F.array_join(F.transform(starts, part), "")
        alphabet = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
        return F.concat(fill(name, made, alphabet), F.substring(m, F.length(name) + 1, F.length(m)))


def fill(shape: Column, made: Column, alphabet: str) -> Column:
    """``shape`` with its characters of the alphabet replaced, in order, by those of ``made``; capitals
    stay capitals."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def step(state: Column, c: Column) -> Column:
        own = F.lit(alphabet).contains(c)
        new = F.substring(made, state["k"], F.lit(1))
        new = F.when(c.between("A", "Z"), F.upper(new)).otherwise(new)
        return F.struct(
            F.concat(state["out"], F.when(own, new).otherwise(c)).alias("out"),
            F.when(own, state["k"] + 1).otherwise(state["k"]).alias("k"),
        )

    return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])


def day_of(m: Column) -> Column:
    iso = F.when(
        m.contains("/"), F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2))
    ).otherwise(m)
    return F.call_function("try_to_date", iso, F.lit("yyyy-MM-dd"))


def kind_of(m: Column) -> Column:
    """The kind of a found text that is also valid, else null."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    ten = F.right(digits, F.lit(10))
    octet = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    return (
        F.when(m.contains("@"), F.when(F.substring_index(m, "@", 1).rlike("[0-9A-Za-z]"), "email"))
        .when(
            m.rlike(r"^(\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4})$"),
            F.when(day_of(m).between(F.lit("1700-01-01").cast("date"), F.lit("2099-12-31").cast("date")), "date"),
        )
        .when(
            m.rlike(r"^\d{3}-\d{2}-\d{4}$"),
            F.when(m.rlike(r"^(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}$"), "social"),
        )
        .when(m.rlike(r"^\d+\.\d+\.\d+\.\d+$"), F.when(m.rlike(rf"^{octet}(\.{octet}){{3}}$"), "ip"))
        .when((F.length(digits) >= 13) & F.call_function("luhn_check", digits), "card")
        .when(F.length(digits).isin(10, 11) & ten.rlike(r"^[2-9]\d\d[2-9]"), "phone")
    )


def right(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def refill(parts: Column, values: Column) -> Column:
    """The parts of a split text with ``values`` between them."""
    behind = lambda part, i: F.concat(part, F.coalesce(F.get(values, i), F.lit("")))
    return F.array_join(F.transform(parts, behind), "")


def cards_in(stretch: Column, mark: str, how: Permuter) -> Column:
    """``left``, the stretch with its usual cards marked, and ``held``, what takes their places."""

    def card_at(group: Column, i: Column, groups: Column) -> Column:
        """The valid card that starts with a group, and of how many groups it is."""
        ahead = F.regexp_replace(F.array_join(F.slice(groups, i + 1, MOST_GROUPS), ""), "^[ -]+", "")
        forms = F.filter(
            F.array(*(F.regexp_extract(ahead, form, 0) for form in CARDS)), lambda c: right(F.regexp_replace(c, "[ -]", ""))
        )
        card = F.when(group.rlike(r"^[ -]*(\d{4}|\d{13,19})$"), F.get(forms, F.lit(0)))
        n = F.coalesce(F.size(F.split(card, "[ -]")).cast("string"), F.lit("0"))
        return F.struct(F.when(card.isNull(), "0").otherwise(n).alias("n"), card.alias("card"), group.alias("group"))

    def chosen(found: Column) -> Column:
        """Which groups start a card, from the left; "-" for the groups in it."""
        steps = F.regexp_extract_all(F.array_join(found["n"], ""), F.lit("(5.{4}|4.{3}|3.{2}|.)"), F.lit(1))
        spread = F.transform(steps, lambda s: F.rpad(F.left(s, F.lit(1)), F.length(s), F.lit("-")))
        return F.split(F.array_join(spread, ""), "")

    def marked(found: Column, starts: Column) -> Column:
        def shown(f: Column, i: Column) -> Column:
            gap = F.regexp_extract(f["group"], "^[ -]*", 0)
            at = F.get(starts, i)
            return F.when(at == "0", f["group"]).when(at == "-", "").otherwise(F.concat(gap, F.lit(mark)))

        own = F.filter(found, lambda f, i: ~F.get(starts, i).isin("0", "-"))
        held = F.transform(own, lambda f: F.struct(F.lit("card").alias("kind"), how.card(f["card"]).alias("text")))
        return F.struct(F.array_join(F.transform(found, shown), "").alias("left"), held.alias("held"))

    groups = F.regexp_extract_all(stretch, F.lit("([ -]*[0-9A-Za-z]+|[ -]+)"), F.lit(1))
    return how.bind(
        groups,
        lambda g: how.bind(
            F.transform(g, lambda group, i: card_at(group, i, g)),
            lambda found: how.bind(chosen(found), lambda starts: marked(found, starts)),
        ),
    )


def value_in(m: Column, mark: str, how: Permuter) -> Column:
    """``left`` and ``held`` of a candidate that is one value or none."""

    def shown(kind: Column) -> Column:
        out = F.when(F.lit(False), m)
        for name in PATTERNS:
            out = out.when(kind == name, getattr(how, name)(m))
        value = F.struct(kind.alias("kind"), out.otherwise(m).alias("text"))
        held = F.filter(F.array(value), lambda v: v["kind"].isNotNull())
        return F.struct(F.when(kind.isNull(), m).otherwise(mark).alias("left"), held.alias("held"))

    return how.bind(kind_of(m), shown)


def pseudonymise(docs: DataFrame, key: str, restore: bool = False) -> DataFrame:
    """``docs`` with every valid personal value of ``text`` replaced, and how many of each kind, as
    columns ``n_<kind>``."""
    how, out = Permuter(key, restore), docs
    made = [fresh(docs, f"made_{i}") for i in range(len(MARKS))]
    looks = [(SURE, value_in), (STRETCH, cards_in), (PATTERNS["phone"], value_in), (PATTERNS["card"], value_in)]
    for name, mark, (pattern, read) in zip(made, MARKS, looks):
        either = f"{pattern}|{mark}"
        itself = F.struct(
            F.lit(mark).alias("left"),
            F.array(F.struct(F.lit(None).cast("string").alias("kind"), F.lit(mark).alias("text"))).alias("held"),
        )
        found = F.transform(
            F.regexp_extract_all("text", F.lit(f"({either})"), F.lit(1)),
            lambda m: F.when(m == mark, itself).otherwise(read(m, mark, how)),  # noqa: B023
        )
        out = out.withColumn(name, found)
        left = F.when(F.size(name) > 0, refill(F.split("text", either, -1), F.col(name)["left"])).otherwise(F.col("text"))
        out = out.withColumn("text", left).withColumn(name, F.flatten(F.col(name)["held"]))
    for name, mark in zip(made[::-1], MARKS[::-1]):
        full = refill(F.split("text", mark, -1), F.col(name)["text"])
        out = out.withColumn("text", F.when(F.size(name) > 0, full).otherwise(F.col("text")))
    names = [c for c in docs.columns if c != "text"]

    def count(kind: str) -> Column:
        own = (F.coalesce(F.size(F.filter(name, lambda hit: hit["kind"] == kind)), F.lit(0)) for name in made)
        return sum(own, F.lit(0)).cast("long").alias(fresh(docs, f"n_{kind}"))

    return out.select(*names, "text", *map(count, PATTERNS))

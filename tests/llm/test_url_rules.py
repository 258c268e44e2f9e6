"""URL rules against regular expressions and a plain look at hosts."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollmill.llm import url_rules
from rollmill.llm.queries import URL_RULES
from rollmill.llm.url_rules import Automaton, GlobRule, HostRule, judge_urls

PIECES = ["a", "b", ".", "/", "?", "*", "**", "[ab]", "[!a/]", "\\*", "\\?", "é"]
AS_REGEX = {"**": ".*", "*": "[^/?]*", "?": "[^/]", "[ab]": "[ab]", "[!a/]": "[^a/]", "\\*": r"\*", "\\?": r"\?"}


def pattern(pieces):
    return "".join(AS_REGEX.get(p, re.escape(p)) for p in pieces)


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from(PIECES), max_size=7), min_size=1, max_size=40),
    st.lists(st.text("ab./?*éx", max_size=9), min_size=1, max_size=12),
)
def test_first_glob_that_matches(globs, texts):
    # a lone star beside a double one would be read as part of it
    globs = [g for g in globs if "***" not in "".join(g)] or [["a"]]
    globs = [g for g in globs if not any(a == b == "*" for a, b in zip(g, g[1:]))] or [["a"]]
    want = [
        next((n for n, g in enumerate(globs) if re.fullmatch(pattern(g), t, re.S)), -1) for t in texts
    ]
    assert Automaton(["".join(g) for g in globs]).first_matches(texts).tolist() == want


def test_many_words_and_one_by_one():
    globs = [f"**/part{n}/**" for n in range(60)] + ["**end"]
    texts = [f"x/part{n}/y" for n in range(60)] + ["", "the end", "z" * 100_000 + "end", "z" * 50_000 + "/part7/"]
    automaton = Automaton(globs)
    assert automaton.words > 5
    assert automaton.first_matches(texts).tolist() == [*range(60), -1, 60, 60, 7]


def test_groups_are_bounded(monkeypatch):
    monkeypatch.setattr(url_rules, "GROUP_CHARACTERS", 10)
    assert Automaton(["a*"]).first_matches(["a", "b" * 30, "ab", "aaaaaaaaaaa", "c"]).tolist() == [0, -1, 0, 0, -1]


@pytest.mark.parametrize("glob", ["[ab", "x\\"])
def test_broken_globs(glob):
    with pytest.raises(ValueError):
        Automaton([glob])


RULES = [
    HostRule("block", "net", "/"),
    HostRule("allow", "example.net", "/en/"),
    HostRule("block", "Example.com", "/de/"),
    HostRule("allow", "org", "/fr/"),
    GlobRule("block", "m.*/**"),
    GlobRule("block", "**[?&]page=**"),
]
URLS = {
    "http://example.net/en/1": ("example.net", "/en/1", "example.net/en/", "allow"),
    "https://A.b.Example.NET/en/": ("a.b.example.net", "/en/", "example.net/en/", "allow"),
    "https://example.net/EN/": ("example.net", "/EN/", "net/", "block"),
    "https://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"),
    "https://net/x": ("net", "/x", "net/", "block"),
    "https://x.net": ("x.net", "", None, "allow"),
    "https://x.net?a=.net/": ("x.net", "", None, "allow"),
    "https://x?y.net/": ("x", "", None, "allow"),
    "https://x.com/.net/en/": ("x.com", "/.net/en/", None, "allow"),
    "https://x.com#://y.net/en/": ("x.com", "", None, "allow"),
    "http://m.example.com/de/4": ("m.example.com", "/de/4", "Example.com/de/", "block"),
    "http://m.example.com/es/4": ("m.example.com", "/es/4", None, "block"),
    "http://x.org/es/4?page=2#top": ("x.org", "/es/4", None, "block"),
    "http://x.org/es/4#?page=2": ("x.org", "/es/4", None, "allow"),
    "http://x.org/fr/4?page=2": ("x.org", "/fr/4", "org/fr/", "allow"),
    "a://b://c.net/": ("b:", "//c.net/", None, "allow"),
    "http:///en/": ("", "/en/", None, "allow"),
    "no address": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "http://\n.net/\n": ("\n.net", "/\n", "net/", "block"),
    "http://ÉÀ.org/fr/": ("ÉÀ.org", "/fr/", "org/fr/", "allow"),
    "http://x.org/fr/" + "y" * 200_000: ("x.org", "/fr/" + "y" * 200_000, "org/fr/", "allow"),
}


def test_urls_and_clashing_names(corpus):
    rows = [(u, "h", 1, u or "", 2.0) for u in [*URLS, "http://net/"]]
    df = corpus.createDataFrame(rows, "url string, host string, Path int, canonical string, verdict double")
    out = judge_urls(df, RULES)
    assert out.columns == ["url", "host", "Path", "canonical", "verdict", "_host", "_path", "rule", "pattern", "_verdict"]
    got = {r["url"]: (r["_host"], r["_path"], r["rule"], r["_verdict"]) for r in out.collect()}
    assert got.pop("http://net/") == ("net", "/", "net/", "block")
    assert got == URLS


def test_longest_rule_wins_and_ties_go_to_the_first(corpus):
    df = corpus.createDataFrame([("http://a.b/c/d",), ("http://a.b/c/d",)], "url string")
    rules = [HostRule("1", "b", "/c/d"), HostRule("2", "a.b", "/c"), HostRule("3", "a.b", "/c/d")]
    assert [r["verdict"] for r in judge_urls(df, rules).collect()] == ["3", "3"]
    assert judge_urls(df, rules[:2]).first()["verdict"] == "1"  # both are five characters
    assert judge_urls(df, [HostRule("x", "b", "/c/"), HostRule("y", "a.b", "/")]).first()["verdict"] == "x"
    assert judge_urls(df, [HostRule("x", "[b", "/c*")]).first()["verdict"] == "allow"


def test_no_pages_and_no_rules(corpus):
    nothing = corpus.createDataFrame([], "url string")
    assert judge_urls(nothing, URL_RULES).collect() == []
    one = corpus.createDataFrame([("http://a.net/",)], "url string")
    assert judge_urls(one, [], default="keep").first()["verdict"] == "keep"

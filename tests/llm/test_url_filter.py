"""URL filters against regular expressions and against plain rule matching."""

import random
import re

import numpy as np
import pytest

from tableload.llm.url_filter import BLOCKED, RULES, Automaton, Rule, split_glob, url_filter

SCHEMA = "page_id long, url string, html string, host string, path string, rule string, `__hit` int"


def as_regex(glob):
    parts = {"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}
    return re.compile("".join(parts.get(p, re.escape(p)) for p in split_glob(glob)))


def matches(globs, texts):
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(d) for d in data])
    return Automaton([split_glob(g) for g in globs]).matches(np.frombuffer(b"".join(data), np.uint8), offsets)


@pytest.mark.parametrize("seed", range(4))
def test_globs_equal_regular_expressions(seed):
    rng = random.Random(seed)
    letters = ["a", "b", "/", ".", "é", "日"]
    globs = ["".join(rng.choice(letters + ["*", "**", "?"]) for _ in range(rng.randrange(9))) for _ in range(60)] + ["", "*", "**"]
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(14))) for _ in range(300)] + ["", "a\nb", "a" * 5000 + "/b"]
    got = matches(globs, texts)
    for i, text in enumerate(texts):
        assert [bool(as_regex(g).fullmatch(text)) for g in globs] == got[i].tolist(), text
    assert got.any()


def plain(url, rules=RULES, blocked=BLOCKED):
    host = path = ""
    if url and "://" in url:
        host, path = re.fullmatch(r"(?s)([^/?#]*)([^?#]*).*", url.split("://", 1)[1]).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    glob = None if best else next((g for g in blocked if as_regex(g).fullmatch(("." + host if host else "") + path)), None)
    return host, path, best.text if best else None, glob, best.verdict if best else "block" if glob else "allow"


ODD = [None, "", "no scheme.net/", "http://", "://net/", "http://net", "http://net/", "HTTP://A.NET/x", "http://xnet/",
       "http://a.example.net/en/1", "http://example.net/en", "http://a.example.com/de/9?x=/fr/", "http://b.ORG/fr/", "http://b.org?/fr/",
       "http://b.org#/fr/", "http://b.com/a.net/", "http://b.com/://x.net/", "ftp://É.ÄNET/", "http://é.net/ß", "http://spam-x.com/",
       "http://www.spam-x.com/a", "http://x.com/spam-/", "http://example.net:80/en/", "http://u@net/", "a://b://c.net/", "http://.net/",
       "http://a.net/" + "x" * 300_000, "http://" + "a." * 100_000 + "org/fr/z", "http://new\nline.net/a\nb", "http://a.net/%20 b"]


def test_every_case_equals_plain_rules(spark):
    rows = [(None if i == 3 else i % 25, u, "h", "host", "path", "rule", 5) for i, u in enumerate(ODD * 2)]
    got = url_filter(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    want = sorted((repr(r[0]), repr(plain(r[1]))) for r in rows)
    assert sorted((repr(g.page_id), repr((g.host, g.path, g.rule, g.pattern, g.verdict))) for g in got) == want


def test_other_rules_ties_and_none(spark):
    df = spark.createDataFrame([(1, "http://a.b/c/d"), (2, "http://b/c"), (3, None)], "page_id long, url string")
    rules = [Rule("block", "b", "/c"), Rule("allow", "a.b", "/c"), Rule("block", "a.b", "/c/")]
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter(df, rules, ()).collect()}
    assert got == {1: ("a.b/c/", "block"), 2: ("b/c", "block"), 3: (None, "allow")}
    first = [Rule("block", "b", "/c"), Rule("allow", "b", "/c")]
    assert {r.page_id: r.verdict for r in url_filter(df, first, (), "other").collect()} == {1: "block", 2: "block", 3: "other"}
    assert {r.verdict for r in url_filter(df, (), ()).collect()} == {"allow"}
    assert {r.verdict for r in url_filter(df, (), ("**",)).collect()} == {"block"}
    assert url_filter(spark.createDataFrame([], SCHEMA)).collect() == []

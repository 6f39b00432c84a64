import random
import re

import numpy as np
import pytest

from quotefuse.llm import url_automaton as ua

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
URLS = [
    (1, "http://example.com/en/1"), (2, "https://WWW.Example.COM/en/?q=/fr/"), (3, "http://a.net/es/x#/fr/"), (4, "http://a.net/ES/x"),
    (5, "http://com"), (6, "http://com/"), (7, "http://notexample.com/en/"), (8, "http://xnet/fr/"), (9, "net/fr/"), (10, None),
    (11, ""), (12, "://"), (13, "http://a.net?x=://b.com/"), (14, "http://a.net#/fr/"), (15, "x://y://net/fr/"),
    (16, "http://é.net/fr/ü"), (17, "http://casino.org"), (18, "http://a.adult-education.org/x"), (19, "http://adult.org/x.zip"),
    (20, "http://a.org/" + "seg/" * 40_000 + "wp-login.php"), (20, "http://example.com/en/1"), (None, "http://a.org/a.exe"),
    (21, "http://a.org/u/login"), (22, "http://a.org/u/v/login"), (23, "http://net/fr/\nx"), (24, "HTTP://ads.org"), (25, "http:///en/")]


def regex(glob):
    out, at = "", 0
    while at < len(glob):
        for token, said in (("**", "[\\s\\S]*"), ("*", "[^/]*"), ("?", "[^/]")):
            if glob.startswith(token, at):
                out, at = out + said, at + len(token)
                break
        else:
            at += glob[at] == "\\" and at + 1 < len(glob)
            out, at = out + re.escape(glob[at]), at + 1
    return re.compile(out)


def brute(rows, rules=RULES, globs=ua.GLOBS):
    out = []
    for page, url in rows:
        _, found, rest = (url or "").partition("://")
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = re.sub("[A-Z]", lambda m: m[0].lower(), rest[:end]) if found else ""
        path = re.split("[?#]", rest[end:])[0] if found else ""
        fit = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
               if (host == h or host.endswith("." + h)) and (path.startswith(p) if p else path[:1] in ("", "/"))]
        own = [(len(re.sub(r"\\(.)|[*?]", r"\1", g).encode()), v == "block", g, v) for v, g in globs if regex(g).fullmatch(host + path)]
        best = max(fit)[3:] if fit else (None, max(own)[3] if own else "allow")
        out.append((page, host, path, *best, None if fit or not own else max(own)[2]))
    return out


def same(got, want):
    order = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "'y' as rule", "'z' as whole")


def test_awkward_urls(spark):
    same(ua.judge(pages(spark, URLS), RULES).collect(), brute(URLS))


def test_small_table(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/pages.parquet")
    rows = [tuple(r) for r in df.select("page_id", "url").collect()]
    got = ua.judge(df, RULES).collect()
    same(got, brute(rows))
    assert {r["verdict"] for r in got} == {"allow", "block"}


def test_empty_table_and_no_rules(spark):
    assert ua.judge(pages(spark, []), RULES).count() == 0
    same(ua.judge(pages(spark, URLS), (), ()).collect(), brute(URLS, (), ()))


def test_rules_without_path_and_ties(spark):
    rules = (("block", "a.org", ""), ("allow", "org", "/a.or"), ("block", "a*b?.org", "/x"), ("allow", "net", ""), ("block", "net", ""))
    rows = [(1, "http://a.org"), (2, "http://x.a.org/y"), (3, "http://a.orgx"), (4, "http://a*b?.org/x"), (5, "http://b.org/a.orx"),
            (6, "http://x.net/"), (7, "http://xnet/")]
    same(ua.judge(pages(spark, rows), rules, ()).collect(), brute(rows, rules, ()))


@pytest.mark.parametrize("seed", range(4))
def test_automaton_is_the_glob_language(seed):
    """Random globs over a small alphabet, many words of state, against regular expressions."""
    rng = random.Random(seed)
    tokens = ["a", "b", "/", "*", "**", "?", "é", "\\*", "."]
    globs = ["".join(rng.choice(tokens) for _ in range(rng.randrange(0, 9))) for _ in range(60)]
    auto = ua.Automaton([ua.Pattern(*map(tuple, ua.steps_of(g)), i) for i, g in enumerate(globs)])
    assert auto.words > 3
    texts = ["".join(rng.choice("ab/é*.中") for _ in range(rng.randrange(0, 12))) for _ in range(400)]
    data = [t.encode() for t in texts]
    lengths = np.array([len(d) for d in data], dtype=np.int64)
    hits = auto.run(np.frombuffer(b"".join(data), np.uint8), np.cumsum(lengths) - lengths, lengths)
    for i, g in enumerate(globs):
        want = [bool(regex(g).fullmatch(t)) for t in texts]
        assert auto.accepts(hits, i).tolist() == want, g


def test_a_long_rule_spans_words_of_state():
    long = "x" * 300
    auto = ua.Automaton([ua.Pattern(*map(tuple, ua.steps_of(g)), i) for i, g in enumerate(["a", long + "*", "b"])])
    data = [long.encode(), (long + "yy").encode(), (long[1:]).encode(), b"b", b""]
    lengths = np.array([len(d) for d in data])
    hits = auto.run(np.frombuffer(b"".join(data), np.uint8), np.cumsum(lengths) - lengths, lengths)
    assert [auto.accepts(hits, i).tolist() for i in range(3)] == [
        [False] * 5, [True, True, False, False, False], [False, False, False, True, False]]

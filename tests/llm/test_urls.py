"""URL filter: rules, parts of a URL, trees."""

from rooftally.llm.queries import URL_RULES
from rooftally.llm.urls import Rule, judge_urls

URLS = [
    ("http://a.net/x", "a.net", "/x", "net/", "block"),
    ("http://net/", "net", "/", "net/", "block"),
    ("http://a.net", "a.net", "", None, None),
    ("https://WWW.Example.NET/en/1?q=a/b#c", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("https://example.net/de/1", "example.net", "/de/1", "net/", "block"),
    ("https://notexample.net/en/1", "notexample.net", "/en/1", "net/", "block"),
    ("https://example.com/de/?x", "example.com", "/de/", "example.com/de/", "block"),
    ("https://example.com/de", "example.com", "/de", None, None),
    ("x://b.org/fr/#", "b.org", "/fr/", "org/fr/", "allow"),
    ("x://b.org?/fr/", "b.org", "", None, None),
    ("no scheme", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("a://b://c/d", "b:", "//c/d", None, None),
    ("http://ÄB.org/ü", "Äb.org", "/ü", None, None),
]


def test_rules_and_parts(rows):
    data = [(i, u[0], "clash", "clash") for i, u in enumerate(URLS)] + [(None, URLS[0][0], "clash", "clash")]
    found = {r.page_id: r for r in judge_urls(rows("page_id long, url string, host string, verdict string", data * 2), URL_RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        r = found[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[i]
        assert r.verdict == verdict or verdict is None and r.verdict in ("allow", "block")
    assert found[None].verdict == "block"


def test_trees_learn_the_rules_labels(rows):
    data = [(i, f"http://s{i % 7}.example.net/{'en' if i % 3 else 'x/y/z/w/9876543210'}/{i}") for i in range(300)]
    # decided by no rule, but lexically like the one or the other kind
    data += [(1000, "http://s1.example.net.test/en/17"), (1001, "http://s1.example.net.test/x/y/z/w/9876543210/17")]
    rules = [Rule("example.net/en/", "allow"), Rule("example.net/x/", "block")]
    found = {r.page_id: r for r in judge_urls(rows("page_id long, url string", data), rules).collect()}
    assert (found[1000].verdict, found[1001].verdict) == ("allow", "block")
    assert found[1000].rule is None and 0 <= found[1000].score < 0.5 <= found[1001].score <= 1


def test_without_labels_and_empty(rows):
    df = rows("page_id long, url string", [(1, "http://a.b/c"), (2, None)])
    assert {r.verdict for r in judge_urls(df, URL_RULES).collect()} == {"allow"}
    assert {r.verdict for r in judge_urls(df, [Rule("a.b/", "block")]).collect()} == {"block"}
    assert judge_urls(df.limit(0), URL_RULES).count() == 0

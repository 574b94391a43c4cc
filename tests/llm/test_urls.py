"""URL rules and the propagation of blocks."""

import pytest

from trailmark.llm import urls
from trailmark.llm.urls import Rule

RULES = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/")]


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows],
                                 "page_id long, url string, html string, host string, verdict string")


def _judge(spark, rows, **more):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(_pages(spark, rows), RULES, **more).collect()}


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://Example.ORG/es/1", "example.org", "/es/1", "example.org/es/", "block"),
    ("http://a.example.org/en/12?q#f", "a.example.org", "/en/12", "example.org/en/1", "block"),
    ("http://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
    ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
    ("http://x.com/de", "x.com", "/de", None, "allow"),
    ("http://x.org", "x.org", "", None, "allow"),
    ("http://x.org?p=/", "x.org", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("no scheme.com/de/", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://É.com/fr/É", "É.com", "/fr/É", "com/fr/", "allow"),
])
def test_rules(spark, url, host, path, rule, verdict):
    assert _judge(spark, [(1, url, None)]) == {1: (host, path, rule, verdict)}


def test_blocks_reach_aliases(spark):
    canonical = lambda u: f"<head><LINK href='{u}' rel=\"canonical\"/></head>"
    refresh = lambda u: f'<meta http-equiv="Refresh" content="0; url={u}">'
    rows = [
        (1, "http://x.com/de/a", "<p>canonical</p>"),                   # blocked by its rule
        (2, "http://y.net/1", canonical("https://x.com/de/a#top")),     # its alias
        (3, "http://z.net/2", refresh("http://y.net/1")),               # alias of an alias
        (4, "http://w.net/3", canonical("/4")),                         # resolved, not blocked
        (5, "https://z.net/2", None),                                   # the same resource as 3
        (6, "http://v.org/5", canonical("http://z.net/2")),             # explicit allow stays
        (7, "http://u.net/6", canonical("http://gone.com/de/b")),       # a blocked target that is no page
        (8, "http://t.net/7", '<link rel="stylesheet" href="http://x.com/de/a">'),
        (9, "http://s.net/8", canonical("mailto:x")),
        (10, "http://r.net/9", refresh("//x.com/de/a")),
        (None, "http://y.net/1", ""),
    ]
    got = {i: v[3] for i, v in _judge(spark, rows).items()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "block", 6: "allow", 7: "block", 8: "allow",
                   9: "allow", 10: "block", None: "block"}


def test_given_redirects_repeats_and_empty_tables(spark):
    redirects = spark.createDataFrame([("http://a.net/x", "http://q.com/de/"), (None, "http://q.com/de/")],
                                      "source string, target string")
    assert _judge(spark, [(1, "http://a.net/x", None)], redirects=redirects)[1][3] == "block"
    assert urls.judge(_pages(spark, [(1, "u", "h"), (1, "u", "h")]), RULES).count() == 2
    assert urls.judge(_pages(spark, []), RULES).count() == 0


def test_many_pages_of_one_target(spark):
    rows = [(i, f"http://p{i}.net/", '<link rel="canonical" href="http://x.com/de/hub">') for i in range(400)]
    assert {v[3] for v in _judge(spark, rows).values()} == {"block"}


def test_targets_are_decoded_and_resolved(spark):
    canonical = lambda u: f'<link rel="canonical" href="{u}">'
    refresh = lambda u: f'<meta http-equiv="refresh" content="0; url={u}">'
    both = lambda a, b: a + "<p>" + b
    rows = [
        (1, "http://a.net/1", canonical("http://x.com/k/a?b=1&amp;c=2")),     # entities
        (2, "http://x.com/k/a?b=1&c=2", canonical("http://x.com/de/z")),
        (3, "http://x.com/k/b", refresh("../de/new.html")),                   # relative paths
        (4, "http://x.com/de/", None),
        (5, "http://x.com/k/c/d", refresh("./e/../q.html")),
        (6, "http://x.com/k/c/q.html", canonical("/k/./../de/x")),
        (7, "http://x.com/k/f", canonical("?id=2")),                          # query only
        (8, "http://x.com/k/f?id=2", canonical("http://x.com/de/y")),
        (9, "http://a.net/9", both(canonical("http://b.net/"), canonical("http://x.com/de/a"))),  # the second tag
        (10, "http://a.net/10", both(refresh("b"), refresh("//x.com/de/a"))),
        (11, "http://a.net", refresh("eleven")),                              # no path
        (12, "http://a.net/eleven", canonical("http://x.com/de/e")),
        (13, "http://a.net/13", canonical("/go?to=http://x.com/de/a")),       # no scheme of its own
        (14, "http://a.net/14", canonical("mailto:de")),
        (15, "http://a.net/15", both(canonical("#top"), refresh(""))),
        (16, "http://a.net/16", refresh("&#39;http://x.com/de/a&#x27;")),
    ]
    got = {i: v[3] for i, v in _judge(spark, rows).items()}
    assert got == {i: "allow" if i in (13, 14, 15) else "block" for i in range(1, 17)}


def test_forms_of_tags(spark):
    to = "http://x.com/de/a"
    forms = {
        1: f"<link rel='alternate canonical' href='{to}'>", 2: f'<link rel="canonical nofollow" href={to}>',
        3: f"<link href={to} rel=canonical>", 4: f"<link rel=canonical href={to} />",
        5: f"<meta content='0;url={to}' http-equiv=refresh>", 6: f'<META HTTP-EQUIV=" Refresh " CONTENT="5; URL={to}">',
        7: f"<!-- <link rel='canonical' href='{to}'> --><p>", 8: f"<!-- open <link rel='canonical' href='{to}'>",
        9: f"<link rel='canonicals' href='{to}'>", 10: f"<link data-rel='x' title='canonical' href='{to}'>",
        11: f"<!-- a --><link rel='canonical' href='{to}'><!-- b -->",
    }
    got = _judge(spark, [(i, f"http://p{i}.net/", h) for i, h in forms.items()])
    assert {i: v[3] for i, v in got.items()} == {i: "allow" if i in (7, 8, 9, 10) else "block" for i in forms}


def test_urls_without_a_host_are_no_nodes(spark):
    blocked = '<link rel="canonical" href="http://x.com/de/a">'
    rows = [(1, "http://", blocked), (2, None, blocked), (3, "no scheme", blocked), (4, None, None), (5, "http://#a", blocked),
            (6, "http://y.net/", '<link rel="canonical" href="http://">')]
    assert {v[3] for v in _judge(spark, rows).values()} == {"allow"}

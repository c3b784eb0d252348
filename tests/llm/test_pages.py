"""Address equivalence and revisits over small made-up cases."""

import datetime as dt

from tidemark.llm import graph, urls, warc


def test_canonical_spellings(spark):
    same = ["http://www.A.org:80/x/?utm_a=1&b=2&a=1#f", "https://a.org/x?a=1&b=2", "https://A.org/x/?b=2&a=1"]
    table = spark.createDataFrame([(u,) for u in [*same, None, "a.org/x", "http://"]], "url string")
    found = [r[0] for r in table.select(urls.canonical(table.url)).collect()]
    assert found == ["a.org/x?a=1&b=2"] * 3 + [None] * 3


def test_decisions_reach_aliases(spark):
    link = '<link rel="canonical" href="{}">'
    refresh = '<meta http-equiv="refresh" content="0; url={}">'
    pages = [
        (1, "http://bad.example/de/1", ""), (2, "http://alias.net/a", link.format("http://bad.example/de/1")),
        (3, "http://alias.net/b", refresh.format("/a")), (4, "http://good.org/a", link.format("http://alias.net/b")),
        (5, "http://free.net/", None), (6, None, None), (6, None, "x"), (7, "http://moved.net/x", ""),
        (8, "http://blocked.net/y", ""), (9, "http://moved.net/x/", ""),
    ]
    rules = (
        urls.Rule("block", "bad.example", "/de/"), urls.Rule("allow", "org", "/"), urls.Rule("block", "blocked.net", "/"),
    )
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    moves = spark.createDataFrame([("http://moved.net/x", "http://blocked.net/y"), (None, "http://a/")], "f string, t string")
    found = {r.page_id: (r.rule, r.verdict) for r in urls.judge(table, rules, moves).collect()}
    # The component of 1 to 4 holds an explicit allow, which is stronger than the inherited block.
    assert found == {
        1: ("bad.example/de/", "block"), 2: (None, "allow"), 3: (None, "allow"), 4: ("org/", "allow"),
        5: (None, "allow"), 6: (None, "allow"), 7: (None, "block"), 8: ("blocked.net/", "block"), 9: (None, "block"),
    }
    without = {r.page_id: r.verdict for r in urls.judge(table.filter("page_id <> 4"), rules).collect()}
    assert without[2] == without[3] == "block" and without[7] == "allow"
    assert urls.judge(table.limit(0), rules).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(7, 200), (7, 201), (3, 7), (5, 5), (None, 9)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert {found[i] for i in range(100, 141)} == {100} and {found[i] for i in (3, 7, 200, 201)} == {3}
    assert 5 not in found and 9 not in found


def at(minutes):
    return dt.datetime(1969, 12, 31, 23, 0) + dt.timedelta(minutes=minutes)


def test_revisits_take_the_latest_earlier_response(spark):
    full = lambda i, t, **h: (i, "http://a.org/x", at(t), "response", 200, h)
    again = lambda i, t, url="http://www.a.org/x#q", **h: (i, url, at(t), "revisit", 304, h)
    captures = [
        full(1, 0, etag='"one"', server="s", expires="e1"), full(2, 50, etag='"two"', server="s"),
        full(3, 50, etag='"three"'), (4, "http://a.org/x", at(55), "response", 404, {"etag": '"x"'}),
        again(10, 30, etag='W/"one"', expires="e2", server="no"), again(11, 5000, etag='"three"'),
        again(12, 5000, etag='"two"'), again(13, 0, etag='"one"'), again(14, 50, etag='"one"'),
        again(15, 90), again(16, 90, url=None), again(17, 90, url="http://b.org/"), again(18, 60, etag='"three"'),
        (19, "http://a.org/x", None, "revisit", 304, None), again(11, 5000, etag='"three"'),
    ]
    schema = "capture_id bigint, url string, captured_at timestamp, type string, status int, headers map<string,string>"
    rows = warc.resolve_revisits(spark.createDataFrame(captures, schema)).collect()
    found = {r.capture_id: (r.refers_to, r.verdict) for r in rows}
    assert len(rows) == 11 and found == {
        10: (1, "resolved"), 11: (3, "resolved"), 12: (3, "mismatch"), 13: (None, "no_response"),
        14: (1, "resolved"), 15: (3, "unverified"), 16: (None, "no_response"), 17: (None, "no_response"),
        18: (3, "resolved"), 19: (None, "no_response"),
    }
    merged = next(r.headers for r in rows if r.capture_id == 10)
    assert merged == {"etag": 'W/"one"', "expires": "e2", "server": "s"}

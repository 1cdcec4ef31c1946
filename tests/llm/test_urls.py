import pytest

from pulse.llm import urls
from pulse.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, host string, rule string"


def judge(spark, pages, rules=URL_RULES):
    frame = spark.createDataFrame([(i, u, h, "?", "?") for i, u, h in pages], SCHEMA)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(frame, urls.rules(spark, rules)).collect()}


def test_longest_rule_wins(spark):
    got = judge(spark, [
        (1, "https://WWW.Example.NET/en/a?x#y", ""), (2, "http://example.net/fr/", ""), (3, "http://a.example.com/de/x", ""),
        (4, "http://x.org/fr/", ""), (5, "http://x.org/FR/", ""), (6, "http://notexample.com/de/", ""), (7, "http://net", ""),
        (8, "http://net/", ""), (9, "x.org/fr/", ""), (10, None, None), (11, "", ""), (12, "ÄÖ://ÄB.org/fr/é", ""), (13, "http://h.org?a/b", ""),
    ])
    assert got[1] == ("www.example.net", "/en/a", "example.net/en/", "allow")
    assert got[2] == ("example.net", "/fr/", "net/", "block")
    assert got[3][2:] == ("example.com/de/", "block")
    assert got[4][2:] == ("org/fr/", "allow")
    assert got[5][2:] == (None, "allow")
    assert got[6][2:] == (None, "allow")
    assert got[7] == ("net", "", None, "allow")
    assert got[8][2:] == ("net/", "block")
    assert got[9] == got[10] == got[11] == ("", "", None, "allow")
    assert got[12] == ("Äb.org", "/fr/é", "org/fr/", "allow")
    assert got[13] == ("h.org", "", None, "allow")


def link(to):
    return f'<html><head><LINK data-x="1" rel="canonical"\n href="{to}"></head>'


def refresh(to):
    return f"<meta http-equiv='refresh' content='0; URL={to}'>"


def test_blocks_reach_aliases_and_allows_go_first(spark):
    pages = [
        (1, "http://a.org/x", link("http://bad.net/y")),  # blocked through its target
        (2, "http://b.org/x", refresh("https://a.org/x#part")),  # through another page
        (3, "http://c.org/x", link("//d.com/q?p=1")),
        (4, "http://d.com/q?p=1", link("/elsewhere")),
        (5, "http://d.com/elsewhere", ""),
        (6, "http://e.com/x", refresh("http://x.org/fr/1")),  # an allowed and a blocked alias
        (7, "http://e.com/x", link("http://bad.net/z")),
        (8, "http://f.org/fr/x", link("http://bad.net/y")),  # its own rule allows it and all of 1 and 2
        (9, "http://g.com/dir/x", link("y")),
        (10, "http://g.com/dir/y", link("http://w.net/")),
    ]
    got = {k: v[3] for k, v in judge(spark, pages[:7] + pages[8:]).items()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 9: "block", 10: "block"}
    got = {k: v[3] for k, v in judge(spark, pages).items()}
    assert got[1] == got[2] == got[8] == "allow"


def test_long_chains_and_ties(spark):
    chain = [(i, f"http://h{i}.com/", link(f"http://h{i + 1}.com/")) for i in range(60)] + [(60, "http://h60.com/", link("http://z.net/"))]
    assert {v[3] for v in judge(spark, chain + chain[:5]).values()} == {"block"}
    assert judge(spark, [(1, "http://a.b/c", "")], (("a.b/", False), ("a.b/", True)))[1][3] == "allow"


def test_empty_tables(spark):
    assert judge(spark, []) == {}
    assert judge(spark, [(1, "http://a.net/", "")], ())[1] == ("a.net", "/", None, "allow")


@pytest.mark.parametrize("html", ["<link rel=canonical", "<link " * 3000, "<meta http-equiv=refresh content=5>", "<link rel=canonical href=mailto:x@y>", "<link rel=canonical href='#top'>"])
def test_broken_links_are_none(spark, html):
    assert judge(spark, [(1, "http://a.org/", html)])[1][3] == "allow"


def test_attributes_may_stand_anywhere_in_their_tag(spark):
    far, wide = f'data-x="{"y" * 20_000}"', " " * 500
    pages = [
        (1, "http://a.org/", f'<link {far} rel{wide}={wide}"canonical" {far} href{wide}={wide}"http://z.net/">'),
        (2, "http://b.org/", f"<link rel=stylesheet href='http://x.org/fr/'>{'<p>' * 50_000}<link href=http://z.net/ {far} rel='canonical'>"),
        (3, "http://c.org/", f"<meta {far} http-equiv={wide}'refresh' {far} content='1; url{wide}={wide}http://z.net/x'>"),
        (4, "http://d.org/", f"<link {far} rel=canonical {far}" + "<link rel=canonical" * 20_000),
    ]
    assert {k: v[3] for k, v in judge(spark, pages).items()} == {1: "block", 2: "block", 3: "block", 4: "allow"}

import urllib.parse

import pytest
from compare import compare, duck

from skylake.llm import queries
from skylake.llm import url_filter as U

SF_DIR = "/root/testdata/sf0.001"
PAGES = "page_id bigint, url string, html string"
LINK = '<head><link rel="canonical" href="{}"></head>'


def verdicts(spark, pages, redirects=None, rules=U.RULES):
    frame = spark.createDataFrame(pages, PAGES).selectExpr("*", "'a' as host", "'b' as path", "'c' as rule", "'d' as node", "'e' as verdict")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    moved = spark.createDataFrame(redirects, "source string, target string") if redirects else None
    return {r["__page"]: (r.host, r.path, r.rule, r.verdict) for r in U.judge(frame, table, redirects=moved).collect()}


def test_rules(spark):
    urls = ["https://a.example.com/en/1?q", "http://WWW.Example.COM/en/", "http://example.com/EN/x", "http://x.net/es/1#f", "http://net/fr/", "http://xnet/fr/",
            "http://y.org/en/", "http://com", "http://com/", "ftp://u@z.com:80/", None, "", "no address", "://", "http://é.net/fr/é", "a://b://c.net/es/",
            "http://x.net?/es/", "http://a.www.example.com/en/9"]
    got = verdicts(spark, [(k, u, None) for k, u in enumerate(urls)])
    assert got[0] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[1] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert got[2] == ("example.com", "/EN/x", "com/", "allow")
    assert got[3] == ("x.net", "/es/1", "net/es/", "block") and got[4][2:] == ("net/fr/", "block") and got[5][2:] == (None, "allow")
    assert got[7] == ("com", "", None, "allow") and got[8][2:] == ("com/", "allow") and got[9][:2] == ("u@z.com:80", "/")
    for k in (10, 11, 12, 13):
        assert got[k] == ("", "", None, "allow")
    assert got[14] == ("é.net", "/fr/é", "net/fr/", "block") and got[15] == ("b:", "//c.net/es/", None, "allow")
    assert got[16] == ("x.net", "", None, "allow") and got[17][2:] == ("www.example.com/en/", "allow")


def test_decisions_reach_aliases(spark):
    pages = [(1, "http://bad.net/es/1", ""), (2, "http://a.org/1", LINK.format("http://bad.net/es/1")), (3, "https://b.org/2?x=1&y=2", None),
             (4, "http://c.org/3", '<META content="0; URL=/4" http-equiv=refresh>'), (5, "http://c.org/4", LINK.format("//a.org/1#top")),
             (6, "http://d.org/", LINK.format("https://ok.com/x")), (7, "http://e.org/", LINK.format("http://d.org/")),
             (8, "http://bad.net/fr/", LINK.format("http://d.org/")), (9, "http://alone.org/", LINK.format("")), (9, "http://alone.org/", None),
             (10, "http://f.org/a/b", LINK.format("c?q=1&amp;r=2")), (11, "http://f.org/a/c?q=1&r=2", None), (None, None, LINK.format("http://bad.net/es/1"))]
    moved = [("http://b.org/2?x=1&y=2", "http://c.org/3"), ("http://gone.net/fr/9", "http://f.org/a/b"), (None, "http://e.org/"), ("http://alone.org/", None)]
    got = {k: v[3] for k, v in verdicts(spark, pages, moved).items()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "block", 9: "allow", 10: "block", 11: "block", None: "allow"}


def aliases(spark, url, html):
    frame = spark.createDataFrame([(1, url, html)], PAGES)
    return [r.v for r in U.edges(frame).collect()]


BASE = "http://g.org/a/b?x=1"


@pytest.mark.parametrize("link", [
    "c", "./c", "../c", "../../../c", "/x/./y/../z", "//H.org/p", "HTTP://h.org:80/", "https://h.org:443/q#f", "https://h.org:80/", "?y=2", "/go?u=http://b.net/es/y", "c/..", "c/../", ".", "..",
    "http://h.org", "http://h.org?q=a/../b", "x:y", "mailto:a@b.c", "#top", "/a/b?x=1"])
def test_links_resolve_as_they_do_in_a_browser(spark, link):
    whole = urllib.parse.urlsplit(urllib.parse.urljoin(BASE, link))
    host = (whole.hostname or "") + (f":{whole.port}" if whole.port and whole.port != {"http": 80, "https": 443}[whole.scheme] else "")
    want = host + (whole.path or "/") + (f"?{whole.query}" if whole.query else "")
    want = [want] if host and want != "g.org/a/b?x=1" else []
    assert aliases(spark, BASE, LINK.format(link)) == want


@pytest.mark.parametrize("html, want", [
    ("<!-- " + LINK.format("http://b.net/es/") + " -->", []), ("<script>'" + LINK.format("http://b.net/es/") + "'</script>", []),
    ("<link rel=canonical data-href='http://b.net/es/' href='http://h.org/x'>", ["h.org/x"]), ("<link data-rel=canonical href='http://b.net/es/'>", []),
    ("<!-- <p> --><link href=/c rel='canonical'>", ["g.org/c"]), ("<meta http-equiv='refresh' content='3;url= d/e'>", ["g.org/a/d/e"])])
def test_links_that_a_browser_would_not_follow(spark, html, want):
    assert aliases(spark, BASE, html) == want


def test_chains_and_hot_targets(spark):
    pages = [(k, f"http://h.org/{k}", LINK.format(f"http://h.org/{k + 1}")) for k in range(40)] + [(1000 + k, f"http://s{k}.org/", LINK.format("http://h.org/0")) for k in range(60)]
    got = verdicts(spark, [*pages, (40, "http://h.org/40", LINK.format("http://q.net/es/"))])
    assert {v[3] for v in got.values()} == {"block"} and len(got) == 101


def test_no_rules_and_no_pages(spark):
    assert verdicts(spark, [(1, "http://a.net/es/", None)], rules=[("block", None, None)])[1][2:] == (None, "allow")
    assert U.op6_url_filter(spark.createDataFrame([], PAGES)).count() == 0


def test_same_as_sql(spark):
    assert compare(spark, duck(SF_DIR), "op6", queries.QUERIES["op6_url_filter"], U.SQL, SF_DIR) is None

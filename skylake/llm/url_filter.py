"""URL filters with redirect equivalence.

A rule names a host and the start of a path; it fits the host and all its subdomains, and the longest fitting rule decides.
Pages that redirect to each other, or name each other as canonical, are one resource under several addresses: the addresses
are nodes, redirects (meta refresh, or a table of them) and canonical links are edges, and the connected components
of that graph, found by distributed star steps, carry decisions to addresses without a rule of their own. An explicit allow
comes first: in a component with an allowed address nothing is blocked but what a rule of its own blocks. An address that no decision reaches
is allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylake.llm.common import bounded
from skylake.llm.graph import components
from skylake.session import settle

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_REST = r"(?s)^.*?://([^#]*)"
_CANONICAL = r"""(?is)<link\b(?=[^>]*(?<![\w-])rel\s*=\s*["']?canonical\b)[^>]*?(?<![\w-])href\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*(?<![\w-])http-equiv\s*=\s*["']?refresh\b)[^>]*?(?<![\w-])content\s*=\s*["'][^"'>]*?url\s*=\s*([^"'\s>]+)"""

_UNSEEN = r"(?is)<!--.*?(?:-->|$)|<(script|style|noscript|template|textarea|title)\b.*?(?:</\1\s*>|$)"  # what a browser takes no link from
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"

# The rules of the registered query.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for a null or an address without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, _ADDRESS, 1), F.lit("")), _UPPER, _UPPER.lower())


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _ADDRESS, 2), F.lit(""))


def node(url: Column) -> Column:
    """What makes two addresses the same: host without the scheme's own port, path without dot segments (`/` if it is empty) and query,
    whatever the scheme and the fragment; null without a host."""
    scheme = F.lower(F.regexp_extract(url, _SCHEME, 1))
    port = F.when(scheme == "https", r":443$").otherwise(r":80$")
    query = F.regexp_extract(F.regexp_extract(url, _REST, 1), r"(?s)^[^?]*(\?.*)?$", 1)
    return F.when(host(url) != "", F.concat(F.regexp_replace(host(url), port, F.lit("")), plain_path(path(url)), query))


def plain_path(path: Column) -> Column:
    """A path from its root, dot segments resolved; they stay ends of folders (`/a/..` is `/`)."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    up = lambda held: F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0)))
    empty = F.array().cast("array<string>")
    kept = F.aggregate(parts, empty, lambda held, x: F.when(x == ".", held).when(x == "..", up(held)).otherwise(F.concat(held, F.array(x))))
    ends = F.element_at(parts, -1).isin(".", "..")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(ends & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit("")))


def _resolved(url: Column, link: Column) -> Column:
    """A link's address, seen from the page: with a scheme only if it starts with one; null for the page itself and for what has no host."""
    link = F.trim(F.replace(link, F.lit("&amp;"), F.lit("&")))
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    base = F.concat(scheme, F.lit("://"), F.regexp_extract(url, _ADDRESS, 1))
    own = F.regexp_extract(url, _ADDRESS, 2)
    folder = F.regexp_replace(own, r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (F.when((link == "") | link.startswith("#"), F.lit(None)).when(link.rlike(_SCHEME + "//"), link).when(link.rlike(_SCHEME), F.lit(None))
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link)).when(link.startswith("/"), F.concat(base, link))
            .when(link.startswith("?"), F.concat(base, own, link)).otherwise(F.concat(base, folder, link)))


@dataclass
class Match:
    """`rules`: (verdict, host, path) of all rules, a host or path that is null read as empty."""

    rules: DataFrame

    def of(self, places: DataFrame) -> DataFrame:
        """(host, path, rule, verdict) of the places (host, path) that a rule fits. A place meets rules by equality with its own
        host and the hosts above it. Of rules that are equally long, the first by name and, of one name, allow."""
        rules = self.rules.select("verdict", F.coalesce("host", F.lit("")).alias("above"), F.coalesce("path", F.lit("")).alias("start"))
        rules = bounded(rules, "rules", F.octet_length("above") + F.octet_length("start"))
        parts = F.split("host", r"\.")
        above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
        met = places.distinct().select("host", "path", F.explode(above).alias("above")).join(rules, "above")
        fit = met.where(F.startswith(F.col("path"), F.col("start"))).withColumn("rule", F.concat("above", "start"))
        best = F.struct((-F.length("rule")).alias("n"), F.col("rule"), F.col("verdict"))
        return fit.groupBy("host", "path").agg(F.min(best).alias("b")).select("host", "path", "b.rule", "b.verdict")


def edges(pages: DataFrame, url_col: str = "url", html_col: str = "html", redirects: DataFrame | None = None) -> DataFrame:
    """(u, v) of canonical links, meta refreshes and the rows (source, target) of `redirects`."""
    url, html = F.col(url_col), F.regexp_replace(F.col(html_col), _UNSEEN, " ")
    links = F.array(*(_resolved(url, F.regexp_extract(html, p, 1)) for p in (_CANONICAL, _REFRESH)))
    found = pages.where(F.col(html_col).rlike("(?i)canonical|refresh")).select(node(url).alias("u"), F.explode(links).alias("to"))
    out = found.select("u", node(F.col("to")).alias("v"))
    if redirects is not None:
        out = out.union(redirects.select(node(F.col("source")), node(F.col("target"))))
    return out.where("u is not null and v is not null and u <> v")


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          redirects: DataFrame | None = None) -> DataFrame:
    """Per page `__page` (its id), host, path, rule and verdict. Equal rows each come out; a null address has empty host and path,
    no rule, no aliases, and is allowed."""
    match = Match(rules)
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("__page"), host(url).alias("host"), path(url).alias("path"), node(url).alias("node"))
    named = settle(components(settle(edges(pages, url_col, html_col, redirects).distinct(), "alias_edges")), "aliases")
    address = F.concat(F.lit("://"), F.col("node"))
    placed = named.select("node", "component", host(address).alias("host"), path(address).alias("path"))
    places = rows.select("host", "path").union(placed.select("host", "path"))
    ruled = settle(match.of(places), "ruled")
    said = placed.join(ruled, ["host", "path"]).groupBy("component").agg(F.min("verdict").alias("alias_verdict"))  # allow before block
    alias = placed.join(said, "component").select("node", "alias_verdict")
    out = rows.join(ruled, ["host", "path"], "left").join(alias, "node", "left")
    return out.select("__page", "host", "path", "rule", F.coalesce("verdict", "alias_verdict", F.lit("allow")).alias("verdict"))


def op6_url_filter(pages: DataFrame) -> DataFrame:
    spark: SparkSession = pages.sparkSession
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return judge(pages, rules).withColumnRenamed("__page", "page_id")


SQL = r"""
with p as (
  select page_id, html, coalesce(url, '') as url,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') as path
  from pages),
r(verdict, host, path) as (
  values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m as (
  select p.page_id, p.host, p.path, r.host || r.path as rule, r.verdict,
    row_number() over (partition by p.page_id, p.host, p.path order by length(r.host || r.path) desc) as n
  from p left join r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from m where n = 1
"""

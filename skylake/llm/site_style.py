"""Main text of pages by a site style tree.

The DOMs of a host's pages are merged: elements with the same chain of tags, classes and ids (numbers in them left out) are one node of the
tree. For each node the contents and the presentations that the pages have there are counted over the host's different pages; pages with
equal blocks count once. The entropies are such as do not move with the size of the site: a content on c of the m pages with the node has
(c - 1) / (m - 1) (Tsallis entropy of order 0, by its maximum), and the content importance is one minus its mean; the presentation importance
is one minus the sum of p * p over the node's l sequences of children (order 2). The composite importance weighs presentation by 1 - GAMMA ** (l - 1)
and content by the rest. A node is as important as the greater of its content and its composite, times the share of its text that is not
inside links; inside an article links count only where contents repeat (their importance under half), so a list of sources stays. What every page of
the site repeats, and what is a list of links, is of low importance. Headings inside an article stay. A node of one page has content importance 1.

From each page the branches of low importance are removed, inside an article too. Branches that are marked as menus, headers, footers, sidebars,
notices, adverts, forms or reader comments have importance 0: by tag or role, or by a class or id whose last word says so (`site-footer`, `ad-slot`; not
`has-comments` or `social-history`), but never the page itself or main. An article (or main) element is a prior: inside it half the
importance is enough, on the rest of such a page three times as much is asked. Whole nodes go or stay, never
single contents, so a paragraph that many articles share is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylake.llm.common import bounded
from skylake.llm.url_filter import host
from skylake.session import settle

LEAST_IMPORTANCE = 0.25
GAMMA = 0.9
INSIDE, OUTSIDE = 0.5, 3.0  # times LEAST_IMPORTANCE, on a page with text inside an article
REPEATS = 0.5  # content importance below which a node repeats itself

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?][^>]*>|([^<]+)|(<)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"'>]+)""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul""".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Open elements that a start tag closes, and the elements that stop the search for them.
_CLOSES = {"li": "li", "option": "option", "tr": "tr td th", "td": "td th", "th": "td th", "dt": "dt dd", "dd": "dt dd", "tbody": "tr td th thead tbody"}
_CLOSES = {k: frozenset(v.split()) for k, v in _CLOSES.items()}
_SCOPE = frozenset("ul ol dl table select article section main body div td th aside nav form".split())
_NOISE_TAGS = frozenset("nav footer aside form head menu button select dialog svg canvas audio video object map".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_NOISE_NAMES = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner sidebar sidebars
menu menus nav navbar navigation breadcrumb breadcrumbs masthead header footer cookie cookies consent gdpr notice notices popup modal overlay
newsletter subscribe subscription share sharing social related recommended comment comments commentlist disqus respond reply replies
login signup search widget toolbar pager pagination""".split())
_MAIN_NAMES = frozenset("article post entry story content main body".split())
_STATES = frozenset("no has with without is not hide show single page layout".split())  # a name that starts so tells about its element, not what it is
_BOXES = frozenset("box bar wrap wrapper container area block section slot unit list item items row buttons button links link form inner posts signup".split())
_WHOLE_TAGS = frozenset("html body main".split())
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_NUMBER = re.compile(r"(?=[a-f]{0,7}\d)[0-9a-f]{8,}|\d+")


def _element(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """Signature of an element, and whether it is marked as noise or as the main part."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault((m[1] or m[5]).lower(), unescape(m[2] or m[3] or m[4] or ""))
    kind, role = f"{found.get('class', '')} {found.get('id', '')}".strip(), found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    main = tag in ("article", "main") or role in ("article", "main")
    noise = hidden or tag not in _WHOLE_TAGS and (tag in _NOISE_TAGS or role in _NOISE_ROLES or any(map(_says_noise, kind.split())))
    return f"{tag}.{' '.join(sorted(set(_NUMBER.sub('0', kind).split())))}" if kind else tag, noise, not noise and main


def _says_noise(name: str) -> bool:
    """Whether a class or id names noise: by its last word, boxes and numbers left out."""
    words = [w.lower() for w in _NAMES.findall(name)]
    if not words or words[0] in _STATES:
        return False
    while len(words) > 1 and words[-1] in _BOXES:
        words.pop()
    return words[-1] in _NOISE_NAMES and not (words[-1] == "header" and set(words) & _MAIN_NAMES)


class Parser:
    """Text blocks of a page in order: (node, text, characters inside links, in the main part: 0 no, 1 yes, 2 a heading there). Branches marked as noise give none.
    `children` holds the names of the elements below each node of the last page, in order, repeats left out."""

    def __init__(self):
        self.known: dict[tuple[str, str], tuple[str, bool, bool]] = {}
        self.nodes: dict[tuple[int, str], int] = {}
        self.children: dict[int, list[str]] = {}

    def _open(self, tag: str, attributes: str, above: tuple) -> tuple:
        key = (tag, attributes)
        if key not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            self.known[key] = _element(tag, attributes)
        name, noise, main = self.known[key]
        _, node, noisy, inside, linked = above
        step = (node, name)
        if step not in self.nodes:
            if len(self.nodes) > 50_000:
                self.nodes.clear()
            self.nodes[step] = xxhash.xxh64_intdigest(f"{node}/{name}") - (1 << 63)
        noise = noise or tag == "header" and not inside
        if not noisy:
            below = self.children.setdefault(node, [])
            if not below or below[-1] != name:
                below.append(name)
        return tag, self.nodes[step], noisy or noise, inside or main, linked or tag == "a"

    def blocks(self, html: str) -> list[tuple[int, str, int, int]]:
        out: list[tuple[int, str, int, int]] = []
        stack: list[tuple] = [("", 0, False, False, False)]
        text: list[str] = []
        linked = 0
        self.children = {}

        def flush() -> None:
            nonlocal linked
            if text:
                words = " ".join("".join(text).split())
                text.clear()
                if words:
                    block = next((e for e in reversed(stack) if e[0] in _BLOCK), stack[0])
                    out.append((block[1], words, min(linked, len(words)), stack[-1][3] and 1 + (block[0] in _HEADINGS)))
                linked = 0

        at, end, match = 0, len(html), _TOKEN.match
        while at < end:
            m = match(html, at)
            at = m.end()
            if m[4] is not None or m[5] is not None:
                if not stack[-1][2]:
                    said = unescape(m[4] or m[5])
                    text.append(said)
                    if stack[-1][4]:
                        linked += len(said)
                continue
            if m[2] is None:
                continue
            tag = m[2].lower()
            if tag in _BLOCK:
                flush()
            elif tag == "br":
                text.append(" ")
            if m[1]:
                depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
                if depth:
                    del stack[depth:]
                continue
            if tag in _RAW:
                close = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(html, at)
                at = close.end() if close else end
                continue
            if tag in _VOID:
                continue
            if tag in _BLOCK:
                self._close(stack, tag)
            stack.append(self._open(tag, m[3], stack[-1]))
        flush()
        return out

    @staticmethod
    def _close(stack: list[tuple], tag: str) -> None:
        """Close what a start tag ends by itself: an open paragraph, or an item of the same list or table."""
        wanted = _CLOSES.get(tag, frozenset(("p",)))
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in wanted:
                del stack[k:]
                return
            if stack[k][0] in _SCOPE:
                return


def _rows(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    html = F.coalesce(F.col(html_col), F.lit(""))
    return pages.select("*", host(F.col(url_col)).alias("__host"), html.alias("__html"), F.xxhash64(html).alias("__key"))


def _nodes(rows: DataFrame) -> DataFrame:
    """(host, key, page, node, content, shape, place, chars, linked), written: for each page a row per node with its shape (the children) and its
    place (0: no text of the page is in an article, 1: inside, 2: outside of it, 3: a heading inside), and a row per node and content. `key` is that of the html, `page` a
    hash of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for batch in batches:
            out: list[tuple] = []
            for name, key, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                seen: dict[tuple[int, int], list[int]] = {}
                place: dict[int, int] = {}
                whole = xxhash.xxh64()
                for node, text, linked, inside in parser.blocks(page.as_py()):
                    content = xxhash.xxh64_intdigest(text) - (1 << 63)
                    held = seen.setdefault((node, content), [0, 0])
                    held[0] += len(text)
                    held[1] += linked
                    place[node] = (2, 1, 3)[inside] if inside else place.get(node, 2)
                    whole.update(f"{node} {content} {linked} {inside}\n")
                if not {1, 3} & set(place.values()):
                    place = dict.fromkeys(place, 0)
                shapes = {n: xxhash.xxh64_intdigest("/".join(parser.children.get(n, ()))) - (1 << 63) for n in place}
                whole.update(str(list(shapes.values())))
                mark = whole.intdigest() - (1 << 63)
                out += [(name, key, mark, n, None, shapes[n], where, 0, 0) for n, where in place.items()]
                out += [(name, key, mark, n, c, None, None, *counts) for (n, c), counts in seen.items()]
            kinds = [pa.string(), *[pa.int64()] * 5, pa.int32(), pa.int64(), pa.int64()]
            columns = list(zip(*out)) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["host", "key", "page", "node", "content", "shape", "place", "chars", "linked"])

    found = rows.select("__host", "__key", "__html").mapInArrow(
        run, "host string, key bigint, page bigint, node bigint, content bigint, shape bigint, place int, chars bigint, linked bigint")
    return settle(found, "nodes")


def _importance(nodes: DataFrame) -> DataFrame:
    once = nodes.select("host", "page", "node", "content", "shape", "chars", "linked").distinct()
    each = once.groupBy("host", "node", "content", "shape").agg(
        F.count(F.lit(1)).cast("double").alias("c"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    held = F.col("content").isNotNull()
    c = F.col("c")
    counted = each.groupBy("host", "node").agg(
        F.sum(F.when(~held, c)).alias("m"), F.sum(F.when(~held, c * c)).alias("squares"), F.count(F.when(~held, c)).alias("l"),
        F.sum(F.when(held, c * (c - 1))).alias("repeated"), F.sum(F.when(held, c)).alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    content = F.when(F.col("m") > 1, 1 - F.col("repeated") / F.col("n") / (F.col("m") - 1)).otherwise(1.0)
    presentation = 1 - F.col("squares") / F.col("m") / F.col("m")
    weight = F.pow(F.lit(GAMMA), F.col("l") - 1)
    both = F.greatest(content, (1 - weight) * presentation + weight * content)
    unlinked = both * (1 - F.col("linked") / F.greatest("chars", F.lit(1)))
    return counted.select("host", "node", "m", unlinked.alias("importance"), F.when(content < REPEATS, unlinked).otherwise(both).alias("inside"))


def tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, node, m, importance, inside) of all nodes outside marked noise; m: the host's different pages with the node, inside: the importance of
    what is in an article. Counts run over all pages
    of the host; they are pre-aggregated in the map tasks, so a host with a third of all pages is no single task's work."""
    return _importance(_nodes(_rows(pages, url_col, html_col)))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page `__page` (its id), `__url` and `__text`: its blocks in page order, joined by line ends; empty if there is none.

    Null html is empty, a null address belongs to the host without a name. Equal rows each come out. A page is joined with its own removed
    nodes only: its nodes meet the low ones of the tree by host and node and are put together again by page.
    """
    all_rows = _rows(pages.select(F.col(id_col).alias("__page"), F.col(url_col).alias("__url"), F.col(html_col).alias("__source")), "__url", "__source")
    nodes = _nodes(all_rows)
    low = _importance(nodes).where(F.least("importance", "inside") < OUTSIDE * LEAST_IMPORTANCE)
    asked = F.when(F.col("place") == 1, INSIDE).when(F.col("place") == 0, 1.0).otherwise(OUTSIDE) * LEAST_IMPORTANCE
    places = nodes.where("place < 3").select("host", "key", "node", "place").distinct()
    gone = places.join(settle(low, "low_nodes"), ["host", "node"]).where(F.when(F.col("place") == 1, F.col("inside")).otherwise(F.col("importance")) < asked)
    listed = gone.groupBy("host", "key").agg(F.collect_list("node").alias("low")).toDF("__host", "__key", "low")
    rows = all_rows.join(bounded(listed, "removed", F.size("low") * 8), ["__host", "__key"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for batch in batches:
            texts = []
            for page, low in zip(batch.column(2), batch.column(3)):
                gone = set(low.as_py() or ())
                texts.append("\n".join(t for node, t, _, _ in parser.blocks(page.as_py()) if node not in gone))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["__page", "__url", "__text"])

    kind = pages.schema[id_col].dataType.simpleString()
    return rows.select("__page", "__url", "__html", "low").mapInArrow(run, f"__page {kind}, __url string, __text string")


def op9_main_text(pages: DataFrame) -> DataFrame:
    return main_text(pages).select(F.col("__page").alias("page_id"), F.col("__url").alias("url"), F.col("__text").alias("text"),
                                   F.length("__text").cast("bigint").alias("n_chars"))

"""Main text of web pages by consensus of their host (operator 13).

Each page's elements are scored as containers of its article: the share of the page's prose that an element holds, squared,
times how much of all text in it is prose, times what its tag and classes say. The elements that score at least half of the
page's best vote, with their scores, for their path: the tags from the root, each with its classes, digits generalised.
Spark adds the votes up per host and path, and ranks the paths that took at least ``SHARE`` of a host's votes. Then every page is
read again: its article is what lies on its host's best ranked path, if that is on the page and scores at least
``AGREES`` of the page's own best; else the next path, and in the end the page's own best container. So pages of a site
agree on where an article is, and a page of another template, or of a host seen once, goes by itself.

What is left out of the article: menus, headers, footers, sidebars, notices, adverts, forms, reader comments (by tag, role, class
and id; a list that is all links is a menu), scripts, styles and markup. Headings inside a header of the article (not of the
whole page) are its title and stay.
Character references are decoded, white space inside a block becomes one space, blocks are joined by two line feeds.

Votes are added up by map-side aggregates, so a host that holds a third of all pages is a few rows per task; the ranked
paths (at most 1 / ``SHARE`` a host) are broadcast up to a counted size and join by a shuffle beyond it.

Defined results: null html is empty and has an empty text; a page without a container gives all its text but the above; pages
whose url has no host go by themselves; repeated page ids are extracted each by its own html; an empty table gives an empty
result; other columns are ignored. Markup that breaks off, misnested or unclosed elements and nesting of any depth are read in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import batches_of_bytes, prepare, small_or_not, staged

SHARE, AGREES = 0.05, 0.1
VOTES_FOR = 0.5
BROADCAST_HOSTS = 200_000

# Elements of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split())
CONTAINERS = frozenset("article body center div html main section table tbody td tr blockquote dd dl figure ol ul li details".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
DROPPED = RAW | frozenset("""aside audio button canvas dialog footer form frameset head input menu meter nav object optgroup option progress search select
    svg video""".split())
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
             "th": {"td", "th", "tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"}}
LISTS = frozenset(("ul", "ol", "dl", "table"))

# Words in classes, ids and roles that say what an element is
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
CHROME = frozenset("""menu menus nav navbar navigation navi breadcrumb breadcrumbs pagination pager masthead topbar toolbar footer sidebar sidebars aside
    cookie cookies consent gdpr notice notices banner alert popup modal overlay newsletter subscribe subscription signup login ad ads adv advert adverts
    advertisement advertising adsense sponsor sponsored sponsors promo promotion promoted form search share sharing social related recommended recommendations
    comment comments commentlist disqus respond replies""".split())
HEADERS = frozenset(("header", "hdr", "pageheader", "siteheader"))
REMARKS = frozenset("comment comments commentlist disqus respond replies".split())
ARTICLE = frozenset("article articlebody content entry post story maincontent main text body".split())
TITLES = {"header": "heading", "outer": "title"}
NOT_THAT = frozenset(("with", "has", "no", "without", "is"))

_TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                    r"""|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class Element:
    """An element of a page. ``kind``: '' (text counts), 'drop' (nothing in it counts), 'header' (headings only, which are of kind
    'heading') or 'outer' (a header outside article and main; its headings, of kind 'title', count in a container smaller than the page)."""

    __slots__ = ("tag", "path", "step", "hint", "kind", "first", "last", "parent")

    def __init__(self, tag: str, path: int, step: str, hint: float, kind: str, first: int, parent: int):
        self.tag, self.path, self.step, self.hint, self.kind, self.first, self.last, self.parent = tag, path, step, hint, kind, first, first, parent


class Block:
    """A run of text between block boundaries: its text, how many of its characters are in links, the innermost element around it."""

    __slots__ = ("text", "linked", "inside")

    def __init__(self, text: str, linked: int, inside: int):
        self.text, self.linked, self.inside = text, linked, inside


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


def _words(names: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(names)]


def _kind(tag: str, attributes: dict[str, str], names: list[str], in_article: bool, by_class: bool) -> str:
    """Whether an element is part of an article, by its tag, role, class and id."""
    if tag in DROPPED:
        return "drop"
    if attributes.get("role", "").lower() in ROLES:
        return "header" if attributes["role"].lower() == "banner" and in_article else "drop"
    if tag in ("html", "body", "main"):
        return ""
    said = {w for before, w in zip(["", *names], names) if before not in NOT_THAT}
    if said & REMARKS:
        return "drop"
    if tag == "header" or said & HEADERS:
        return "header" if in_article else "outer"
    if tag in HEADINGS or tag == "article":
        return ""
    return "drop" if by_class and said & CHROME else ""


class Page:
    """One pass over the html: elements in document order, blocks of text, and the weight of each element."""

    def __init__(self, html: str, by_class: bool = True):
        self.by_class = by_class
        self.elements = [Element("", 0, "", 0.7, "", 0, -1)]
        self.blocks: list[Block] = []
        self._read(html)
        self._weigh()

    def _read(self, html: str) -> None:
        elements, stack = self.elements, [0]
        text: list[str] = []
        linked = links = article = 0

        def flush() -> None:
            nonlocal linked
            if text:
                joined = " ".join("".join(text).split())
                if joined:
                    self.blocks.append(Block(joined, min(linked, len(joined)), stack[-1]))
                text.clear()
            linked = 0

        def pop() -> None:
            nonlocal links, article
            e = elements[stack[-1]]
            if e.tag in BLOCKS:
                flush()
            stack.pop()
            links -= e.tag == "a"
            article -= e.tag in ("article", "main")
            e.last = len(self.blocks)

        at, end = 0, len(html)
        while at < end:
            token = _TOKEN.search(html, at)
            raw = html[at:token.start()] if token else html[at:]
            if raw:
                said = unescape(raw) if "&" in raw else raw
                text.append(said)
                if links:
                    linked += len(said.strip())
            if not token:
                break
            at = token.end()
            name = token["name"] or token["name2"]
            if not name:
                continue
            tag = name.lower()
            if token["close"] or token["close2"]:
                if tag == "br":
                    text.append(" ")
                    continue
                for depth in range(len(stack) - 1, 0, -1):
                    other = elements[stack[depth]].tag
                    if other == tag:
                        while len(stack) > depth:
                            pop()
                        break
                    # an inline end tag doesn't close blocks, nothing but its own kind closes a cell or an article
                    if (other in BLOCKS and tag not in BLOCKS) or (other in ("article", "main", "td", "th", "table") and tag in ("p", "li", "div", "section", "ul", "ol")):
                        break
                continue
            if not token["name"] and not html.endswith(">", 0, at):
                break                                    # the page breaks off inside a tag
            attrs = token["attrs"] or token["attrs2"] or ""
            if tag in VOID:
                if tag == "br":
                    text.append(" ")
                elif tag == "hr":
                    flush()
                continue
            if tag in RAW:                               # nothing in it is markup
                closing = _END[tag].search(html, at)
                at = closing.start() if closing else end
                if closing:
                    after = html.find(">", at)
                    at = after + 1 if after >= 0 else end
                continue
            if tag in BLOCKS or tag == "option":
                flush()
                while len(stack) > 1 and tag in CLOSED_BY.get(elements[stack[-1]].tag, ()):
                    pop()
                if tag in BLOCKS:                        # an open p further up ends too, with the inline elements in it
                    for depth in range(len(stack) - 1, 0, -1):
                        other = elements[stack[depth]].tag
                        if other in CLOSED_BY and tag in CLOSED_BY[other]:
                            while len(stack) > depth:
                                pop()
                            break
                        if other in BLOCKS:
                            break
            attributes = _attributes(attrs) if "=" in attrs else {}
            classes = " ".join(sorted(set(_DIGITS.sub("#", attributes.get("class", "")).split())))
            names = _words(f"{attributes.get('class', '')} {attributes.get('id', '')}") if attributes else []
            above = elements[stack[-1]]
            kind = above.kind if above.kind == "drop" else _kind(tag, attributes, names, article > 0, self.by_class) if attributes or tag in DROPPED or tag == "header" else ""
            if above.kind and kind in ("", "header", "outer"):
                kind = TITLES.get(above.kind, above.kind) if tag in HEADINGS else above.kind
            step = f"{tag}.{classes}" if classes else tag
            hint = 0.0 if tag not in CONTAINERS else 0.7 if tag in ("html", "body") else 1.0
            if tag in ("article", "main") or attributes.get("role") == "main" or attributes.get("itemprop") == "articleBody":
                hint = 1.6 if tag != "main" else 1.3
            elif hint == 1.0 and set(names) & ARTICLE:
                hint = 1.25
            elements.append(Element(tag, xxhash.xxh64_intdigest(step, seed=above.path & 0xFFFFFFFFFFFFFFFF), step, hint, kind, len(self.blocks), stack[-1]))
            stack.append(len(elements) - 1)
            links += tag == "a"
            article += tag in ("article", "main")
        flush()
        while stack:
            pop() if len(stack) > 1 else stack.pop()
        elements[0].last = len(self.blocks)

    def _weigh(self) -> None:
        """Prose and other text before every block, as running sums: an element's weight is the difference at its ends."""
        elements = self.elements
        menus = [e for e in elements if e.tag in LISTS and e.kind == "" and e.last - e.first > 2
                 and all(b.linked >= 0.8 * len(b.text) for b in self.blocks[e.first:e.last])] if any(b.linked for b in self.blocks) else []
        in_menu = [0] * (len(self.blocks) + 1)
        for e in menus:
            in_menu[e.first] += 1
            in_menu[e.last] -= 1
        self.counts = [n == 0 and elements[b.inside].kind in ("", "heading") for b, n in zip(self.blocks, accumulate(in_menu))]
        self.titles = [n == 0 and elements[b.inside].kind == "title" for b, n in zip(self.blocks, accumulate(in_menu))]
        prose = [max(len(b.text) - 2 * b.linked, 0) if counts else 0 for b, counts in zip(self.blocks, self.counts)]
        self.prose = [0, *accumulate(prose)]
        self.all = [0, *accumulate(len(b.text) for b in self.blocks)]

    def score(self, e: Element) -> float:
        whole, here = self.prose[-1], self.prose[e.last] - self.prose[e.first]
        if not here or e.kind or not e.hint or (e.hint == 1.0 and e.last - e.first == 1 and here < whole):   # a block, not a container
            return 0.0
        return (here / whole) ** 2 * here / max(self.all[e.last] - self.all[e.first], 1) * e.hint

    def containers(self) -> list[tuple[float, Element]]:
        """The best container first, then those that score at least ``VOTES_FOR`` of it; none of a page without prose."""
        scored = [(s, e) for e in self.elements for s in (self.score(e),) if s]
        best = max((s for s, _ in scored), default=0.0)
        return sorted((x for x in scored if x[0] >= VOTES_FOR * best), key=lambda x: (-x[0], x[1].first))

    def readable_path(self, e: Element, steps: int = 12) -> str:
        """The last ``steps`` steps of an element's path."""
        out: list[str] = []
        while e.parent >= 0 and len(out) < steps:
            out.append(e.step)
            e = self.elements[e.parent]
        return ("…/" if e.parent >= 0 else "") + "/".join(reversed(out))

    def text_of(self, some: list[Element]) -> str:
        out, at = [], 0
        for e in sorted(some, key=lambda x: x.first):
            for i in range(max(e.first, at), e.last):
                if self.counts[i] or (self.titles[i] and e.tag not in ("", "html", "body")):
                    out.append(self.blocks[i].text)
            at = max(at, e.last)
        return "\n\n".join(out)

    def article(self, ranked: list[int]) -> tuple[str, str, bool]:
        """(text, path, whether the host's vote chose it) by the host's ranked paths."""
        own = self.containers()
        if not own:
            return self.text_of(self.elements[:1]), "", False
        for path in ranked:
            there = [e for e in self.elements if e.path == path and e.kind == ""]
            outer = [e for i, e in enumerate(there) if not i or e.first >= there[i - 1].last]
            if sum(self.score(e) for e in outer) >= AGREES * own[0][0]:
                return self.text_of(outer), self.readable_path(outer[0]), True
        return self.text_of([own[0][1]]), self.readable_path(own[0][1]), False


def read_page(html: str) -> Page:
    """The page; where the classes of its outer elements would leave next to nothing of it, they are not asked."""
    page = Page(html)
    if 100 * page.prose[-1] < page.all[-1]:
        every = Page(html, by_class=False)
        if 100 * page.prose[-1] < every.prose[-1]:
            return every
    return page


def _signed(path: int) -> int:
    return path - (1 << 64) if path >> 63 else path


def _decoded(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, raws in batches_of_bytes(batches):
        hosts, out = part.column(part.schema.get_field_index("host")).to_pylist(), []
        for host, raw in zip(hosts, raws):
            page = read_page(_decoded(raw))
            out += [(host, _signed(e.path), page.readable_path(e), s) for s, e in page.containers()]
        if out:
            host, path, steps, score = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(path, pa.int64()), pa.array(steps, pa.string()), pa.array(score, pa.float64())],
                                             ["host", "path", "steps", "score"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, raws in batches_of_bytes(batches):
        column = {n: part.column(part.schema.get_field_index(n)) for n in ("page_id", "url", "paths")}
        found = [read_page(_decoded(raw)).article([p & 0xFFFFFFFFFFFFFFFF for p in paths or ()]) for raw, paths in zip(raws, column["paths"].to_pylist())]
        text, path, voted = zip(*found)
        yield pa.RecordBatch.from_arrays([column["page_id"], column["url"], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()),
                                          pa.array(path, pa.string()), pa.array(voted)], ["page_id", "url", "text", "n_chars", "container", "by_host"])


def _pages(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """(page_id, url, host, text); the host is null where the url has none."""
    host = F.nullif(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))
    return pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), host.alias("host"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("text"))


def host_paths(rows: DataFrame) -> DataFrame:
    """(host, paths): the paths that took at least ``SHARE`` of the host's votes, most votes first."""
    votes = rows.where("host is not null").select("host", "text").mapInArrow(_votes, "host string, path bigint, steps string, score double")
    # whole numbers, so that the sum of the votes doesn't hang on the order in which they come
    of_path = staged(votes.groupBy("host", "path").agg(F.sum(F.round(F.col("score") * 1_000_000).cast("bigint")).alias("votes"), F.min("steps").alias("steps")), "votes")
    of_host = of_path.groupBy(F.col("host").alias("of_host")).agg(F.sum("votes").alias("all_votes"))
    ranked = of_path.join(of_host, F.col("host") == F.col("of_host")).where(F.col("votes") >= SHARE * F.col("all_votes"))
    return ranked.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("less"), "steps", "path"))).alias("p")).select("host", F.col("p.path").alias("paths"))


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, container, by_host) of every row of ``pages``: the article's text, the path it was read
    from and whether the host's vote chose that path."""
    prepare(pages.sparkSession)
    rows = _pages(pages, page_id, url, html)
    ranked = staged(host_paths(rows).withColumnRenamed("host", "of_host"), "host-paths")
    known = rows.join(small_or_not(ranked, BROADCAST_HOSTS), F.col("host") == F.col("of_host"), "left")
    return known.select("page_id", "url", "text", "paths").mapInArrow(_extracted, "page_id bigint, url string, text string, n_chars bigint, container string, by_host boolean")

"""Main text of web pages by composite text density.

A page is parsed into a tree of elements. Elements that can't hold the article (menus, forms, scripts,
adverts, comments and the like, by tag, role or class name) are cut off. For every element left, the
composite density is its characters per tag, raised or lowered by the share of characters and tags that
are links. The element with the largest sum of its children's densities is the core of the article. The
smallest density on the path from the core to the body is the threshold: elements beside that path
that reach it, and aren't mostly links, belong to the article too, as do headings and what stands
beside the core in a smaller part of the page than the body. Lists and boxes of nothing but links inside it don't.
Names decide only on boxes (never on paragraphs, headings, quotes or items), and only whole names of things that aren't articles, alone or
with the name of a kind of box.

Blocks are the runs of text between starts and ends of block elements; line breaks count as white
space. Character references are decoded, white space becomes one space, blocks are joined by an
empty line. Pages may be cut off or badly nested: open elements end with the page, a new paragraph ends
the one before, end tags without a start are ignored. The tree is kept in flat lists, so depth
doesn't matter. A null or empty page has an empty text; nulls in other columns are kept.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import ship_package

# Element names of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot
    th thead tr ul""".split())
NEVER = frozenset("""aside audio button canvas datalist dialog embed footer form head iframe input menu nav noscript object script select
    style svg template textarea title video""".split())
RAW = "script|style|textarea|title|noscript|template|iframe|svg"
# what a start tag ends if open, up to the element that limits it
ENDS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
        "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# first or last parts of the class names and ids of what isn't the article
NAMES = frozenset("""ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies
    copyright disclaimer disqus footer gdpr header legal login masthead menu modal nav navbar navigation newsletter notice notices pager
    pagination popup promo promoted recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored
    subscribe toolbar widget widgets""".split())
# what such a name may be combined with
KINDS = frozenset("area bar block box container content footer form inner item list module outer panel section slot top bottom unit wrap wrapper zone site page main".split())
# elements that may be cut off by their names
BOXES = frozenset("center details div dl figure fieldset header hgroup ol section span summary table ul".split())
LINK_SHARE, LINKS = 0.8, 3   # a list or box with so many links, and such a share of its characters in them, is a list of links
LEAST_SHARE = 0.5   # of an element's characters that must not be links

_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^<>]*>.*?(?:</(?P=raw)\s*>|\Z)"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>"""
    # a tag that isn't closed, or has a lone quote, ends at the next one: no start is looked at twice
    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs2>[^<>]*+)(?:>|(?=<))|<[!?/][^<>]*+>""", re.S | re.I)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


class Page:
    """Elements in page order (0 is the root) and the events that make up the page."""

    def __init__(self, source: str):
        self.tag, self.parent, self.attrs = ["html"], [-1], [""]
        self.events: list[tuple[int, str | None]] = []   # (element, text), or a boundary of blocks (None)
        stack = [0]
        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self.events.append((stack[-1], source[at:m.start()]))
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            if m["end"] or m["end2"]:
                self._end(stack, tag)
            else:
                self._start(stack, tag, m["attrs"] or m["attrs2"] or "")
        if at < len(source):
            self.events.append((stack[-1], source[at:]))

    def _pop(self, stack: list[int], size: int) -> None:
        if any(self.tag[e] in BLOCK for e in stack[size:]):
            self.events.append((stack[size - 1], None))
        del stack[size:]

    def _end(self, stack: list[int], tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if self.tag[stack[k]] == tag:
                return self._pop(stack, k)
        return None

    def _start(self, stack: list[int], tag: str, attrs: str) -> None:
        if tag == "br":
            self.events.append((stack[-1], " "))
            return
        if tag == "html" or tag in ("body", "head") and any(self.tag[e] == tag for e in stack):
            return
        if tag == "body":  # a head that was left open ends
            self._end(stack, "head")
        if tag in ENDS:
            ended, limits = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if self.tag[stack[k]] in limits:
                    break
                if self.tag[stack[k]] in ended.split():
                    self._pop(stack, k)
                    break
        elif tag in BLOCK:
            for k in range(len(stack) - 1, 0, -1):
                if self.tag[stack[k]] == "p":
                    self._pop(stack, k)
                    break
                if self.tag[stack[k]] in BLOCK:
                    break
        if tag in BLOCK:
            self.events.append((stack[-1], None))
        if tag not in VOID:
            self.tag.append(tag)
            self.parent.append(stack[-1])
            self.attrs.append(attrs)
            stack.append(len(self.tag) - 1)


def _named_out(attrs: str) -> bool:
    """Whether class, id or role say that an element isn't part of an article."""
    for key, *values in _ATTR.findall(attrs):
        for name in "".join(values).lower().split():
            if key.lower() == "role":
                if name in ROLES:
                    return True
                continue
            parts = [p for p in re.split(r"[-_]+", name) if p]
            if any(p in NAMES for p in parts) and all(p in NAMES or p in KINDS or p.isdigit() for p in parts):
                return True
    return False


def main_text(source: str | None) -> str:
    """The article's text of a page."""
    if not source:
        return ""
    page = Page(source)
    n, tag, parent = len(page.tag), page.tag, page.parent
    holds, within = [False] * n, [False] * n       # an article or main below; an article or main above or here
    for i in range(n - 1, 0, -1):
        holds[parent[i]] |= holds[i] or tag[i] in ("article", "main")
    keep = [True] * n
    for i in range(1, n):
        within[i] = within[parent[i]] or tag[i] in ("article", "main")
        out = tag[i] in NEVER or tag[i] == "header" and not within[i]
        if not out and page.attrs[i] and tag[i] in BOXES and not holds[i]:
            out = _named_out(page.attrs[i])
        keep[i] = keep[parent[i]] and not out
    # characters and tags below each element, and those that are links
    texts = [(i, None if t is None else " ".join(html.unescape(t).split()), t) for i, t in page.events if keep[i]]
    chars, link_chars, tags, link_tags = ([0] * n for _ in range(4))
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[parent[i]] or tag[i] == "a"
    for i, text, _ in texts:
        if text:
            chars[i] += len(text)
            link_chars[i] += len(text) * in_link[i]
    for i in range(n - 1, 0, -1):
        if keep[i]:
            p = parent[i]
            chars[p] += chars[i]
            link_chars[p] += link_chars[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i] + (tag[i] == "a")
    whole = link_chars[0] / max(chars[0], 1)

    def density(i: int) -> float:
        """Characters per tag, adjusted by links; the constants keep the logarithms away from 0."""
        c, lc, t, lt = chars[i], link_chars[i], max(tags[i], 1), max(link_tags[i], 1)
        if not c:
            return 0.0
        base = math.log(c * lc / max(c - lc, 1) + whole * c + math.e + 1)
        return c / t * math.log(c / max(lc, 1) * t / lt + 1) / math.log(base)

    dense = [density(i) if keep[i] else 0.0 for i in range(n)]
    sums = [0.0] * n
    for i in range(1, n):
        if keep[i]:
            sums[parent[i]] += dense[i]
    core = max(range(n), key=lambda i: (sums[i], -i)) if any(sums) else 0
    path = [core]
    while path[-1] > 0 and tag[path[-1]] != "body":
        path.append(parent[path[-1]])
    threshold = min(dense[i] for i in path)
    chosen = [False] * n
    chosen[core] = True
    on_path = set(path)
    for i in range(1, n):
        if keep[i] and parent[i] in on_path and i not in on_path and (chars[i] - link_chars[i]) >= LEAST_SHARE * chars[i]:
            in_part = parent[i] > 0 and tag[parent[i]] != "body"
            chosen[i] = dense[i] >= threshold or in_part or tag[i] in ("h1", "h2")
    for i in range(1, n):
        if tag[i] in BOXES and i not in on_path and link_tags[i] >= LINKS and link_chars[i] >= LINK_SHARE * chars[i]:
            keep[i] = False
        keep[i] = keep[i] and (i in on_path or keep[parent[i]])
    for i in range(1, n):
        chosen[i] = keep[i] and (chosen[i] or chosen[parent[i]])
    blocks, block = [], []
    for i, _, text in texts:
        if text is None:
            blocks.append(block)
            block = []
        elif chosen[i]:
            block.append(text)
    joined = (" ".join(html.unescape("".join(b)).split()) for b in [*blocks, block])
    return "\n\n".join(b for b in joined if b)


def extracted(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for each page."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")

"""HTML extraction (operator 10): tag-path ratios choose the content node of a page.

A page is read once into text blocks, each with its root-to-leaf path of block
tags (with class names) and its link characters. Blocks inside elements that
never hold the article (navigation, page headers and footers, sidebars, forms,
adverts, notices, comments, by tag, role or class name) are set aside, however much text
they hold; of those known by a class name, wrappers of an article, main or h1 element stay, as do sections
of an article whose name may be their topic, where half of their text reaches the threshold below.

For the others, text length and punctuation are added up for each path and
divided by the path's blocks: the two tag-path ratios. Both are smoothed over the
neighbouring blocks with a Gaussian kernel, fused as a product, and blocks whose
fused value reaches ``SHARE`` of the page's mean are content. The content node is
the only article element that holds blocks whose own path reaches that, or the only such one with an h1; else it is found from the body downwards: the walk goes into a child while that child holds
``DESCEND`` of the content (by its tag), and stops at an article or where a heading would be
lost. All blocks of that node are the text, but those set aside and, outside article and main elements, lists of links.

Defined results: null and empty pages, and pages without text, give an empty
text; unclosed and stray tags are closed as browsers do it for paragraphs, list
items and cells; an unclosed comment, script, style, textarea or template runs to the end
of the page; other skipped elements (button, video) that are not closed end with their parent;
repeated rows are extracted each.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.llm.text import text_column

SHARE = 0.2
DESCEND = {"": 0.7, "article": 0.5, "main": 0.5}
SMOOTH = (0.25, 0.5, 0.25)
LINKS = 0.8

# Element names and class words.
BLOCKS = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th
thead title tr ul caption""".split())
RAW = "script style textarea template".split()  # to their end tag, or the end of the page
SKIPPED = "noscript select button iframe svg math object canvas audio video datalist".split()
ASIDE_TAGS = {"nav", "aside", "footer", "form", "menu", "dialog", "head", "title"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
ASIDE_WORDS = set("""ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner nav
navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside footer masthead topbar comment comments disqus reply
replies respond cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup
share sharing social related recommended recommendations widget pagination pager toolbar login search skip hidden""".split())
#: Words that may stand beside those in a class name; any other ('has-sidebar') says that it is something else.
BESIDE_WORDS = set("""area bar block body bottom box btn button buttons container content footer form group header icons id inner item items
left link links list main menu outer page post posts primary right row secondary section site slot thread top unit user wrap wrapper""".split())
#: Words of ASIDE_WORDS that may also name what a section or heading of an article is about.
TOPIC_WORDS = {"social", "banner"}
PAGE_HEADER = {"header"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = BLOCKS - set("p h1 h2 h3 h4 h5 h6 li dd dt td th pre figcaption legend summary caption title hr".split())
#: An opening tag of the first kind ends an open element of the second, up to the nearest of the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody"}, {"table"}), "tfoot": ({"tbody"}, {"table"}),
}

_SKIP_END = re.compile(rf"</({'|'.join(SKIPPED)})\s*>", re.I)
_START = re.compile(rf"<(?:(?P<other>!--|[!?])|(?P<raw>{'|'.join(RAW)})(?=[\s/>])|(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?=[\s/>]))", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_QUOTES = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_CLASS_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_MARKS = re.compile(r"[.,;:!?…。、，！？；：]")


@dataclass(eq=False)
class Node:
    tag: str
    path: int  # hash of the tags and class names from the root to here
    parent: Node | None
    inside: bool = False  # an article or main element, or in one
    aside: int = 0  # 1: by tag, 2: by class name, 3: by class name, unless the ratios find half of it to be content
    outer: Node | None = None  # in a skipped element: the element around that
    ended: bool = False  # a skipped element with an end tag
    in_article: bool = False  # an article element, or in one
    holds: bool = False  # an article, main or h1 element that is not set aside itself
    children: list[Node] = field(default_factory=list)
    chars: int = 0
    content: int = 0
    core: int = 0
    headings: int = 0
    h1: int = 0
    out: bool = False



@dataclass
class Block:
    node: Node
    text: str
    links: int


def _tag_ends(page: str) -> tuple[list[int], list[int]]:
    """Places of ``>`` and quotes, and where a tag ends that goes on there outside of quotes (-1: nowhere)."""
    places = [m.start() for m in _QUOTES.finditer(page)]
    ends = [-1] * (len(places) + 1)
    after: dict[str, int] = {}  # of each quote: the number of the place behind the next one
    for k in range(len(places) - 1, -1, -1):
        mark = page[places[k]]
        if mark == ">":
            ends[k] = places[k] + 1
        else:
            ends[k] = ends[after.get(mark, -1)]
            after[mark] = k + 1
    return places, ends


def read_tokens(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, tag, whether it is an end tag, what stands behind the name) of comments, raw
    elements (tag "") and tags, in time in proportion to the page whatever is left unclosed in it."""
    places, ends = _tag_ends(page)
    last = page.rfind(">")
    at = 0
    while m := _START.search(page, at):
        at = m.end()
        if m["other"] == "!--":
            end = page.find("-->", at)
            at = end + 3 if end >= 0 else len(page)
            yield m.start(), at, "", False, ""
        elif at > last:  # no tag ends behind this place
            at = m.start() + 1
        elif m["other"]:
            at = page.find(">", at) + 1
            yield m.start(), at, "", False, ""
        elif m["raw"]:
            close = page.find(">", at)
            if page[close - 1] == "/" and close > at:
                at = close + 1
            else:
                end = _RAW_END[m["raw"].lower()].search(page, close + 1)
                at = end.end() if end else len(page)
            yield m.start(), at, "", False, ""
        else:
            if page[at].isspace():
                end = ends[bisect_left(places, at)]
            else:
                end = at + 1 if page[at] == ">" else at + 2 if page[at:at + 2] == "/>" else -1
            if end > 0:
                yield m.start(), end, m["tag"].lower(), bool(m["end"]), page[at:end - 1]
                at = end


def _aside(tag: str, attributes: dict[str, str], inside: bool) -> int:
    if tag in ASIDE_TAGS or attributes.get("role", "").lower() in ASIDE_ROLES:
        return 1
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return 1
    if tag in PAGE_HEADER and not inside:
        return 1
    if tag in ("html", "body", "main"):
        return 0
    own = ASIDE_WORDS if inside else ASIDE_WORDS | PAGE_HEADER
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = {w.lower() for w in _CLASS_WORD.findall(name)}
        if words & own and words <= own | BESIDE_WORDS:
            if inside and words & own <= TOPIC_WORDS and tag in ("section", "h1", "h2", "h3", "h4", "h5", "h6"):
                return 3 if tag == "section" else 0
            return 2
    return 0


def read_blocks(page: str) -> tuple[list[Node], list[Block]]:
    """The block elements of a page, parents first, and its text blocks in order."""
    root = Node("", 0, None)
    nodes, at, blocks, parts, links, anchors = [root], root, [], [], 0, 0
    opened: Counter[str] = Counter()  # elements from the root to here, by tag

    def flush(to: Node) -> None:
        nonlocal parts, links
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                blocks.append(Block(to, text, min(links, len(text))))
            parts, links = [], 0

    def up(to: Node) -> None:
        nonlocal at
        while at is not to:
            opened[at.tag] -= 1
            at = at.parent

    def down(to: Node) -> None:
        nonlocal at
        opened[to.tag] += 1
        at = to

    def close(tags: set[str], until: set[str]) -> None:
        if not any(opened[t] for t in tags):
            return
        node = at
        while node is not root and node.tag not in until and not node.ended:
            if node.tag in tags:
                return up(node.parent)
            node = node.parent

    ends = {m[1].lower(): m.start() for m in _SKIP_END.finditer(page)}  # the last of each
    place, seen = 0, set()
    for start, end, tag, is_end, rest in read_tokens(page):
        if start > place and at.outer is None:
            piece = page[place:start]
            parts.append(piece)
            links += len(piece) if anchors else 0
        place = end
        if not tag:
            continue
        if tag == "a":
            anchors = 0 if is_end else 1
        if tag == "br" and at.outer is None:
            parts.append(" ")
        if tag in SKIPPED:  # in the line: the text around it stays one block
            if not is_end and not rest.endswith("/"):
                new = Node(tag, at.path, at, at.inside, 1, at.outer or at, ends.get(tag, -1) >= end, at.in_article)
                at.children.append(new)
                nodes.append(new)
                down(new)
            elif is_end and opened[tag]:
                node = at
                while node.tag != tag:
                    node = node.parent
                up(node.parent)
            continue
        if tag not in BLOCKS:
            continue
        around = at.outer
        if around is None:
            flush(at)
        anchors = 0
        if is_end:
            if opened[tag] and tag not in ("html", "body"):
                node = at
                while node.tag != tag:
                    node = node.parent
                up(node.parent)
            if around is not None and at.outer is None:
                flush(around)
            continue
        if tag in ("html", "body"):
            if tag in seen:
                continue
            seen.add(tag)
        if tag != "hr":
            close({"p"}, CONTAINERS | {"td", "th", "li", "dd"})
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag == "body":
            close({"head"}, {"html"})
        if around is not None and at.outer is None:
            flush(around)
        if tag == "hr":
            continue
        attributes = {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(rest)}
        inside = at.inside or tag in ("article", "main")
        path = hash((at.path, tag, *sorted(attributes.get("class", "").split())))
        new = Node(tag, path, at, inside, _aside(tag, attributes, at.inside), at.outer, in_article=at.in_article or tag == "article")
        at.children.append(new)
        nodes.append(new)
        if not rest.endswith("/"):
            down(new)
    if at.outer is None:
        parts.append(page[place:])
    flush(at.outer or at)
    return nodes, blocks


def _smooth(x: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over the neighbours; at the ends over those that are there."""
    k = np.array(SMOOTH)
    return np.convolve(x, k)[1:-1] / np.convolve(np.ones(len(x)), k)[1:-1]


def content_blocks(blocks: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """Which blocks are content: both ratios of their paths, smoothed, fused and held against ``SHARE`` of
    the page's mean; and which reach it by their own path, without the help of their neighbours."""
    paths: dict[int, list[Block]] = {}
    for b in blocks:
        paths.setdefault(b.node.path, []).append(b)
    length = {p: sum(len(b.text) - b.links for b in bs) / len(bs) for p, bs in paths.items()}
    marks = {p: sum(len(_MARKS.findall(b.text)) for b in bs) / len(bs) for p, bs in paths.items()}
    x, y = np.array([length[b.node.path] for b in blocks]), np.array([1 + marks[b.node.path] for b in blocks])
    fused = _smooth(x) * _smooth(y)
    least = SHARE * fused.mean()
    return fused >= least, x * y >= least


def extract(page: str | None) -> str:
    """Main text of a page; an empty string if there is none."""
    if not page:
        return ""
    nodes, blocks = read_blocks(page)
    for b in blocks:
        b.node.chars += len(b.text)
    for n in reversed(nodes[1:]):
        n.parent.chars += n.chars
    for n in reversed(nodes[1:]):
        n.holds = n.chars > 0 and (n.holds or n.tag in ("article", "main", "h1")) and n.aside != 1 and not (n.aside == 2 and n.tag == "article")
        n.parent.holds |= n.holds
    for n in nodes[1:]:
        n.out = n.parent.out or n.aside == 1 or (n.aside == 2 and (not n.holds or n.tag == "article"))
    blocks = [b for b in blocks if not b.node.out]
    paths: dict[int, list[Block]] = {}
    for b in blocks:
        paths.setdefault(b.node.path, []).append(b)
    linked = {p for p, bs in paths.items() if bs[0].node.tag in ("li", "div", "td", "dd", "ul") and sum(b.links for b in bs) >= LINKS * sum(len(b.text) for b in bs)}
    blocks = [b for b in blocks if b.node.inside or b.node.path not in linked]
    if not blocks:
        return ""
    for b, chosen, own in zip(blocks, *content_blocks(blocks)):
        b.node.content += len(b.text) if chosen else 0
        b.node.core += len(b.text) if own else 0
        b.node.headings += b.node.tag in ("h1", "h2")
        b.node.h1 += b.node.tag == "h1"
    for n in reversed(nodes[1:]):
        n.parent.content += n.content
        n.parent.core += n.core
        n.parent.headings += n.headings
        n.parent.h1 += n.h1
    for n in nodes[1:]:
        n.out |= n.parent.out or (n.aside == 3 and 2 * n.core < n.chars)
    # an article element in which the ratios find no content is a teaser, whatever its name says
    articles = [n for n in nodes if n.tag == "article" and not n.out and n.core and not n.parent.in_article]
    headed = [n for n in articles if n.h1]
    chosen = articles if len(articles) == 1 else headed
    node = chosen[0] if len(chosen) == 1 else nodes[0]
    while node.tag != "article":
        child = max(node.children, key=lambda n: n.content, default=None)
        if child is None or child.tag not in CONTAINERS or child.content < DESCEND.get(child.tag, DESCEND[""]) * node.content or not child.content:
            break
        if node.tag not in ("", "html", "body") and node.headings > child.headings:
            break
        node = child
    blocks = [b for b in blocks if not b.node.out]
    for n in nodes:  # from here on: not in the content node
        n.out = n is not node and (n.parent is None or n.parent.out)
    return "\n".join(b.text for b in blocks if not b.node.out)


def extract_pages(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``pages`` and struct ``_main``: ``text`` and ``n_chars`` (code points)."""
    kept = pages.columns if keep is None else keep
    own = ["__main_text", "__main_n"]
    shown = pages.select(*[F.col(f"`{c}`") for c in kept], F.lit(None).cast("string").alias(own[0]), F.lit(None).cast("long").alias(own[1])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            texts = [extract(p.as_py()) for p in text_column(cols[html])]
            cols[own[0]], cols[own[1]] = pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())
            yield pa.RecordBatch.from_arrays([cols[k] for k in shown.names], names=shown.names)

    out = pages.mapInArrow(run, shown)
    return out.select(*[F.col(f"`{c}`") for c in kept], F.struct(F.col(own[0]).alias("text"), F.col(own[1]).alias("n_chars")).alias("_main"))

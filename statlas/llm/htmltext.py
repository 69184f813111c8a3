"""Main text of web pages, by tag-path ratios.

A page is read into text nodes, each with the root-to-leaf path of its block elements (tags with their
classes). For every path the text length and the punctuation are summed, link text counting little, and set
against its number of blocks; both ratios are smoothed over the page's order, fused by their product and
compared with a threshold. Nodes of paths above it are content.

Paths below the threshold still hold headings, list items, cells and one-line paragraphs of an article. They
are content only inside the core, the article or main elements that hold most of the chosen text or else the
deepest element that does, and only as elements of text (headings, paragraphs, items, cells, captions) or with a sentence's
end. Navigation, page headers and footers, asides, forms, scripts, styles and containers whose class names
an advert, a notice or reader comments are never content.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlas.llm._util import prepare

#: Elements without an end tag, elements whose content is not markup, elements that are never content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|noscript|template|iframe|noembed|noframes|xmp|svg|math"
NEVER = frozenset("head nav footer aside form button select option label dialog menu noscript template iframe object audio video canvas".split())
#: Elements that end a run of text.
BLOCKS = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Start tags before which an open p ends.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Elements made for text, which are content in the core whatever their ratio.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 hgroup li dt dd blockquote pre figcaption caption td th summary address article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(["article", "main"])
#: Containers that a class may mark as no content, and roles that do so of any element.
CONTAINERS = frozenset("div section ul ol dl table center details".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar".split())
#: Words of a class (or a div's id) that mark a container, if all its other words only say where or of what it is one.
MARKS = frozenset("ad ads advert advertisement advertising adsbygoogle sponsor sponsors sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription share sharing social sidebar related recommended recommendations comment comments commentlist disqus respond reply replies nav navbar navigation menu breadcrumb breadcrumbs footer masthead header pagination pager widget widgets search login signup".split())
PLACES = frozenset("site page top bottom left right global primary secondary box bar block list section container wrap wrapper inner outer area slot unit zone item items link links button buttons post posts article articles story stories news thread form text content main sub google".split())
#: An id of a section that holds reader comments, class words of an article element that is one, and attributes of what is not shown.
REPLIES = frozenset("comments comment-list commentlist respond disqus_thread".split())
REPLY = frozenset("comment comments comment-body comment-item comment-content reply replies response responses".split())
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=]|$)|style\s*=\s*[\"'][^\"']*display\s*:\s*none", re.I)
SENTENCE = re.compile(r"[.!?…。！？][\"'”’)»]*\s*$")
PUNCTUATION = re.compile("[.,;:!?\"'()…。，、；：！？؟،۔।]")

TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*?(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)""", re.S | re.I)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SPACES = re.compile(r"\s+")
Path = tuple[str, ...]


class Node:
    """A run of text under one path of block elements."""

    __slots__ = ("block", "in_link", "never", "path", "text")

    def __init__(self, text: str, path: Path, never: bool, in_link: bool, block: int) -> None:
        self.text, self.path, self.never, self.in_link, self.block = text, path, never, in_link, block

    @property
    def tag(self) -> str:
        return tag_of(self.path[-1]) if self.path else ""


def tag_of(step: str) -> str:
    return step.split(".", 1)[0]


def _marked(names: str) -> bool:
    """Whether one of a class's names marks a container as no content."""
    for name in names.lower().split():
        words = re.split("[-_]+", name)
        if any(w in MARKS for w in words) and all(w in MARKS or w in PLACES for w in words):
            return True
    return False


def _is_aside(name: str, attrs: dict[str, str], tags: list[str]) -> bool:
    """Whether an element is never content."""
    if name in NEVER or attrs.get("role", "").lower() in ROLES:
        return True
    if name == "header":
        return not any(t in MAIN for t in tags)
    if name == "article":
        return not REPLY.isdisjoint(attrs.get("class", "").lower().split())
    if name == "section" and not REPLIES.isdisjoint(attrs.get("id", "").lower().split()):
        return True
    if name in CONTAINERS:
        return _marked(attrs.get("class", "")) or (name in ("div", "ul") and _marked(attrs.get("id", "")))
    return name == "p" and not {"ad", "ads", "advert", "advertisement", "sponsored"}.isdisjoint(attrs.get("class", "").lower().split())


def text_nodes(page: str) -> list[Node]:
    """All text of a page in order; a page that breaks off or leaves tags open is read to its end."""
    out: list[Node] = []
    tags: list[str] = []
    steps: list[str] = []  # a block element's tag and classes, or empty
    never: list[bool] = []
    block = last = 0

    def path() -> Path:
        return tuple(x for x in steps if x)

    def add(text: str) -> None:
        if text.strip():
            out.append(Node(entities.unescape(text), path(), any(never), "a" in tags, block))
        elif text and out and out[-1].block == block:
            out[-1].text += " "

    def close(at: int) -> None:
        del tags[at:], steps[at:], never[at:]

    for m in TOKEN.finditer(page):
        if m.start() > last:
            add(page[last : m.start()])
        last = m.end()
        name = m["name"]
        if name is None:
            if m["raw"]:
                block += m["raw"].lower() in BLOCKS
            continue
        name = name.lower()
        block += name in BLOCKS
        if m["close"]:
            if name in tags:
                at = len(tags) - 1 - tags[::-1].index(name)
                # an inline end tag does not close the blocks around it
                if name in BLOCKS or not any(t in BLOCKS for t in tags[at + 1 :]):
                    close(at)
            continue
        if name in ENDS_P and "p" in tags:
            close(tags.index("p"))
        elif name in ("li", "dt", "dd", "tr", "td", "th", "option") and tags and tags[-1] == name:
            close(len(tags) - 1)
        elif name == "body":
            close(1 if tags[:1] == ["html"] else 0)
        if name in VOID or m["attrs"].endswith("/"):
            continue
        attrs = {}
        if m["attrs"]:
            for a in ATTRIBUTE.finditer(m["attrs"]):
                attrs.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
        never.append(_is_aside(name, attrs, tags) or bool(m["attrs"] and HIDDEN.search(m["attrs"])))
        tags.append(name)
        steps.append(".".join([name, *sorted(attrs.get("class", "").split())]) if name in BLOCKS else "")
    if last < len(page):
        add(page[last:])
    return out


def smoothed(x: np.ndarray) -> np.ndarray:
    """A short Gaussian over neighbours, with the border values held."""
    if len(x) < 3:
        return x
    padded = np.r_[x[0], x, x[-1]]
    return 0.25 * padded[:-2] + 0.5 * padded[1:-1] + 0.25 * padded[2:]


def content_paths(nodes: list[Node]) -> set[Path]:
    """Paths whose fused ratio of text and punctuation to blocks is above the threshold."""
    length: dict[Path, float] = defaultdict(float)
    marks: dict[Path, float] = defaultdict(float)
    blocks: dict[Path, set[int]] = defaultdict(set)
    for n in nodes:
        weight = 0.1 if n.in_link else 1.0
        length[n.path] += weight * len(n.text)
        marks[n.path] += weight * len(PUNCTUATION.findall(n.text))
        blocks[n.path].add(n.block)
    paths = list(length)
    of = {p: i for i, p in enumerate(paths)}
    where = np.array([of[n.path] for n in nodes])
    by_text = np.array([length[p] / len(blocks[p]) for p in paths])
    by_marks = np.array([(1 + marks[p]) / len(blocks[p]) for p in paths])
    fused = smoothed(by_text[where]) * smoothed(by_marks[where])
    score = np.zeros(len(paths))
    np.maximum.at(score, where, np.sqrt(fused * by_text[where] * by_marks[where]))
    threshold = min(float(score.mean()), 0.5 * float(score.max()))
    return {p for p in paths if score[of[p]] >= threshold}


def named_part(path: Path) -> Path | None:
    """The outermost article or main element of a path."""
    return next((path[: i + 1] for i, step in enumerate(path) if tag_of(step) in MAIN), None)


def core(nodes: list[Node], chosen: set[Path]) -> list[Path]:
    """The article and main elements that hold chosen text, if together they hold most of it, or else the deepest element that does."""
    size: dict[Path, int] = defaultdict(int)
    named: dict[Path, int] = defaultdict(int)
    total = 0
    for n in nodes:
        if n.path in chosen:
            total += len(n.text)
            for i in range(len(n.path) + 1):
                size[n.path[:i]] += len(n.text)
            part = named_part(n.path)
            if part:
                named[part] += len(n.text)
    if named and sum(named.values()) >= 0.6 * total:
        return list(named)
    best = max((p for p, s in size.items() if s >= 0.6 * total), key=len)
    while best and tag_of(best[-1]) not in ("div", "section", "td", "body", "html", "center", "blockquote"):
        best = best[:-1]
    return [with_headline(nodes, best)]


def with_headline(nodes: list[Node], root: Path) -> Path:
    """root, or the ancestor that it shares with a top heading outside, if that adds little other text."""
    inside = lambda path: path[: len(root)] == root
    held = sum(len(n.text) for n in nodes if inside(n.path))
    for n in nodes:
        if any(tag_of(x) == "h1" for x in n.path):
            if inside(n.path):
                return root
            shared = next((i for i, (a, b) in enumerate(zip(root, n.path, strict=False)) if a != b), min(len(root), len(n.path)))
            wider = root[:shared]
            added = sum(len(x.text) for x in nodes if x.path[:shared] == wider) - held
            return wider if shared and added <= 0.25 * held + len(n.text) else root
    return root


def selected(nodes: list[Node]) -> list[Node]:
    """The content among nodes that may be content."""
    chosen = content_paths(nodes)
    roots = core(nodes, chosen)
    named = all(r and tag_of(r[-1]) in MAIN for r in roots)
    link: dict[Path, list[int]] = defaultdict(lambda: [0, 0])
    ends: dict[int, str] = {}
    for n in nodes:
        link[n.path][n.in_link] += len(n.text)
        ends[n.block] = n.text
    out = []
    for n in nodes:
        inside = any(n.path[: len(r)] == r for r in roots)
        if n.path in chosen:
            keep = inside or not named
        elif not inside:
            keep = False
        elif n.tag in TEXTUAL:
            free, linked = link[n.path]
            keep = named or n.tag in HEADINGS or linked < 4 * free  # outside an article a list of links is a menu
        else:
            keep = bool(SENTENCE.search(ends[n.block]))
        if keep:
            out.append(n)
    return out


def main_text(page: str) -> str:
    """The main text of a page; empty if it has none."""
    body = [n for n in text_nodes(page) if not n.never]
    if not body:
        return ""
    parts: list[list[str]] = []
    block = None
    for n in selected(body):
        if n.block != block:
            parts.append([])
            block = n.block
        parts[-1].append(n.text)
    blocks = (SPACES.sub(" ", "".join(p)).strip() for p in parts)
    return " ".join(b for b in blocks if b)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) per row of pages (page_id, url, html); other columns are not looked at.

    A null or empty html has an empty text, and so has a page of markup alone. Repeated rows give repeated results, null ids
    and urls stay null, an empty table gives an empty result.
    """
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, url string, text string")

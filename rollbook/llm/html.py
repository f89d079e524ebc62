"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each under its root-to-leaf path of block tags.  Text length and
punctuation are summed per path, divided by the path's number of blocks, smoothed along the page
and fused; paths above a share of the best are content, and so is what their containers hold beside
menus.  That a path lies in an article or main raises its ratio by the share of text that such
elements hold; the ratios of all paths still decide.  Subtrees that are page furniture by their tag,
role or class take no part, but a form, class or id does not hide a wrapper.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"']+)*)>?", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")

# Tags of HTML by what they do to text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
# Elements of formulas and drawings, whose text is read and which can close themselves.
FOREIGN = frozenset(
    "math mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable "
    "mtd mtext mtr munder munderover semantics svg circle clippath defs ellipse g line lineargradient "
    "marker mask path pattern polygon polyline radialgradient rect stop symbol text textpath tspan use".split()
)
PHRASING = INLINE | FOREIGN | frozenset("script style noscript template title annotation annotation-xml desc".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object select annotation annotation-xml desc".split())
FURNITURE = frozenset(
    "aside audio button canvas dialog footer head header label legend menu nav video".split()
) | RAW
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer header login menu modal nav navbar navigation newsletter "
    "notice notices pager pagination popup promo promotion related reply replies share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "toolbar".split()
)
# Furniture unless it wraps the text of the page.
FORMS = ("form", "fieldset")
# What a one-word class adds to a hint, as in "commentlist" or "navbox".
ENDINGS = ("area", "bar", "block", "body", "box", "container", "content", "form", "group", "items", "links", "list", "section", "thread", "wrap", "wrapper")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_ITSELF = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
HOLDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}
ROOTS = ("article", "main")
# Hints after these say what a wrapper has beside its text, not what it is.
LAYOUT = frozenset("has have hide no with without".split())
# Hints of what others wrote or what leads elsewhere, which can be longer than the article.
OTHERS = frozenset("comment comments disqus related reply replies".split())


@dataclass
class _Element:
    name: str
    path: str
    hard: bool = False  # furniture by tag or role
    soft: bool = False  # furniture by class or id, unless `_lifted` finds it to be a wrapper
    others: bool = False  # by one of OTHERS, but no article of its own
    titled: bool = False  # an h1 or main lies inside


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    link_chars: int
    in_root: bool
    pieces: list[str] = field(default_factory=list, repr=False)
    root: _Element | None = field(default=None, repr=False)  # the outermost article or main
    marks: tuple[_Element, ...] = field(default=(), repr=False)  # soft elements around


def _furniture(name: str, attributes: str) -> tuple[bool, frozenset[str], str]:
    """(by tag or role, hints of class, id or being a form, label for the path)."""
    form = frozenset({"form"} if name in FORMS else ())
    if not attributes or attributes.isspace() or attributes == "/":
        return name in FURNITURE, form, name
    got = {}
    for m in ATTRIBUTE.finditer(attributes):
        got.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    hard = (
        name in FURNITURE
        or got.get("role", "").lower() in ROLES
        or "hidden" in got
        or got.get("aria-hidden", "").lower() == "true"
    )
    marks = f"{got.get('class', '')} {got.get('id', '')}".lower()
    hints = set()
    if name not in ("html", "body", "main"):
        for mark in marks.split():
            parts = re.split(r"[^a-z0-9]+", mark)
            if LAYOUT.isdisjoint(parts):
                hints |= HINTS.intersection(parts)
                hints |= {p[: -len(e)] for p in parts for e in ENDINGS if p.endswith(e) and p[: -len(e)] in HINTS}
    if name == "article":  # others' words; an article of a banner or the like is one
        hints &= OTHERS
    classes = ".".join(sorted(got.get("class", "").split()))
    return hard, form | hints, f"{name}.{classes}" if classes else name


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, without furniture."""
    stack: list[_Element] = []
    out: list[Block] = []
    pieces: list[tuple[str, bool]] = []

    def flush() -> None:
        if not pieces:
            return
        text = " ".join("".join(p for p, _ in pieces).split())
        if text and shown():
            links = sum(len(p.strip()) for p, linked in pieces if linked)
            path = tuple(e.path for e in stack if e.name not in PHRASING)
            root = next((e for e in stack if e.name in ROOTS), None)
            marks = tuple(e for e in stack if e.soft)
            out.append(Block(path, text, links, root is not None, root=root, marks=marks))
        pieces.clear()

    def shown() -> bool:
        names = [e.name for e in stack]
        for k, e in enumerate(stack):
            if e.name == "header" and e.hard:  # an article's own heading stays
                inside = any(n in ROOTS for n in names[:k])
                if not (inside and any(n in HEADINGS for n in names[k:])):
                    return False
            elif e.hard:
                return False
        return True

    def close(names: tuple[str, ...], within: tuple[str, ...] = ()) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].name in names:
                if any(e.name not in PHRASING for e in stack[k:]):
                    flush()
                del stack[k:]
                return
            if stack[k].name in within:
                return

    at = 0
    while m := TOKEN.search(page, at):
        if m.start() > at:
            linked = any(e.name == "a" for e in stack)
            pieces.append((html.unescape(page[at : m.start()]), linked))
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name not in VOID:
                if name == "text":  # a line of a drawing
                    pieces.append((" ", False))
                close((name,))
            elif name == "br":
                pieces.append((" ", False))
            continue
        if name in VOID:
            if name in ("br", "wbr", "img"):
                pieces.append((" " if name == "br" else "", False))
            else:
                flush() if name == "hr" else None
            continue
        if name not in PHRASING:
            flush()
            close(("p",), (*HOLDS["li"], "table", "dl", "div", "section", "article", "main", "body"))
            if name in ENDS_ITSELF:
                close(ENDS_ITSELF[name], HOLDS.get(name, ()))
            if name in HEADINGS:
                close(tuple(HEADINGS), ("div", "section", "article", "main", "body"))
        if name in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            at = len(page) if end is None else page.find(">", end.start()) + 1 or len(page)
            continue
        if m[3].endswith("/") and name not in INLINE:
            continue
        hard, hints, label = _furniture(name, m[3])
        if name in ("h1", "main") and not hard and not any(e.hard for e in stack if e.name != "header"):
            for e in stack:
                e.titled = True
        alone = name == "article" and not any(e.name in ROOTS for e in stack)
        others = not alone and not OTHERS.isdisjoint(hints)
        stack.append(_Element(name, label, hard, bool(hints), others))
    if at < len(page):
        pieces.append((html.unescape(page[at:]), any(e.name == "a" for e in stack)))
    flush()
    return _lifted(out)


def _lifted(found: list[Block]) -> list[Block]:
    """Without the blocks of soft elements that are no wrappers of the page's text.

    A wrapper has the title or main in it, or most of the text where no unmarked article or main has
    any; the words of others may be most of a page, so text alone does not lift those.
    """
    total, inside = 0, defaultdict(int)
    for b in found:
        own = len(b.text) - min(b.link_chars, len(b.text))
        total += own
        for e in b.marks:
            inside[id(e)] += own
    article = any(b.in_root and not b.marks for b in found)

    def wraps(e: _Element) -> bool:
        return e.titled or (2 * inside[id(e)] > total and not e.others and not article)

    return [b for b in found if all(map(wraps, b.marks))]


def _smooth(values: np.ndarray) -> np.ndarray:
    """A narrow Gaussian along the page."""
    weights = np.exp(-0.5 * np.array([-1.0, 0.0, 1.0]) ** 2)
    padded = np.pad(values, 1, mode="edge")
    return np.convolve(padded, weights / weights.sum(), "valid")


def path_scores(found: list[Block]) -> dict[tuple[str, ...], float]:
    """The fused ratio of every path: text per block, weighted by punctuation, smoothed and less links.

    Paths in an article or main count up to 64 times as much, by the square of the share of text in
    those; ratios are not smoothed across their borders.
    """
    chars, points, links, count, rooted = (defaultdict(int) for _ in range(5))
    for b in found:
        chars[b.path] += len(b.text)
        points[b.path] += len(PUNCTUATION.findall(b.text))
        links[b.path] += min(b.link_chars, len(b.text))
        count[b.path] += 1
        rooted[b.in_root] += len(b.text) - min(b.link_chars, len(b.text))
    score: dict[tuple[str, ...], float] = defaultdict(float)
    for _, run in groupby(found, key=lambda b: id(b.root)):
        part = list(run)
        length = _smooth(np.array([chars[b.path] / count[b.path] for b in part]))
        pointed = _smooth(np.array([points[b.path] / count[b.path] for b in part]))
        for b, x in zip(part, (length * np.log2(2 + pointed)).tolist()):
            score[b.path] += x / count[b.path]
    evidence = 1 + 63 * (rooted[True] / max(1, rooted[True] + rooted[False])) ** 2
    for path in score:
        score[path] *= 1 - links[path] / chars[path]
        if _root(path) is not None:
            score[path] *= evidence
    return score


def _tag(label: str) -> str:
    return label.split(".")[0]


def _root(path: tuple[str, ...]) -> int | None:
    """Where the outermost article or main of a path is."""
    return next((k for k, label in enumerate(path) if _tag(label) in ROOTS), None)


def main_blocks(found: list[Block], share: float = 0.25) -> list[Block]:
    """Blocks whose path has at least `share` of the best ratio, and what their containers hold.

    The container of a path in an article or main is that element, which holds no menus, so its links
    are text like any other.  Elsewhere it is what the best path and the title have in common, else
    the path's parent; there, blocks that are mostly links are menus, and what follows the last
    content block directly in the body is no content.
    """
    if not found:
        return []
    score = path_scores(found)
    chars: dict[tuple[str, ...], int] = defaultdict(int)
    for b in found:
        chars[b.path] += len(b.text)
    # the best path holds the most text among those with the highest ratios
    best = max(score, key=lambda p: score[p] * chars[p])
    chosen = {p for p in score if score[p] >= share * score[best]} | {best}
    title = next((b.path for b in found if b.path and _tag(b.path[-1]) == "h1" and _root(b.path) is None), None)

    def container(path: tuple[str, ...]) -> tuple[str, ...]:
        root = _root(path)
        if root is not None:
            return path[: root + 1]
        if path != best or title is None:
            return path[:-1]
        same = next((k for k, (a, b) in enumerate(zip(path, title)) if a != b), min(len(path), len(title)))
        return path[: min(same, len(path) - 1)]

    containers = {container(p) for p in chosen}
    places = [k for k, b in enumerate(found) if b.path in chosen or b.path == title]
    first, last = places[0], places[-1]

    def content(k: int, b: Block) -> bool:
        if b.path in chosen:
            return True
        for c in containers:
            if b.path[: len(c)] != c:
                continue
            if c and _tag(c[-1]) in ROOTS:
                return True
            own = b.path[-1:] and _tag(b.path[-1]) in HEADINGS or 2 * b.link_chars <= len(b.text)
            if own and ((c and _tag(c[-1]) not in ("html", "body")) or first <= k <= last):
                return True
        return False

    return [b for k, b in enumerate(found) if content(k, b)]


def main_text(page: str | None) -> str:
    return "\n\n".join(b.text for b in main_blocks(blocks(page or "")))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(<id_col>, <url_col>, text, n_chars), one row per row of pages, from whole pages.

    Null and empty pages, and pages of furniture only, have an empty text.  Null ids and urls stay,
    repeated rows stay repeated, other columns are left out, no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["id", "url", "text", "n_chars"],
            )

    pick = pages.select(
        pages[id_col].alias("id"),
        pages[url_col].cast("string").alias("url"),
        pages[html_col].cast("string").alias("html"),
    )
    kind = pages.schema[id_col].dataType.simpleString()
    out = pick.mapInArrow(run, f"id {kind}, url string, text string, n_chars bigint")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})

"""Main text of web pages: boosted trees over features of page elements, decoded along the page's hierarchy.

Every element is scored for holding main text. The labelling of all elements with the best sum of scores is found under
one rule: what lies inside a dropped element is dropped. So no paragraph is kept inside a menu, and no menu inside an
article goes with it. The trees are fitted on generated pages of many layouts, whose labels are known by construction.
"""

from __future__ import annotations

import html as references
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxframe.llm.trees import Boosted, fit

# Fixed values of the page language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template textarea title iframe svg math object select button head".split()
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"body", "html", "tbody", "td", "tfoot", "th", "thead", "tr"}
# Words that names of classes and ids are made of.
GOOD = frozenset("article articlebody body content entry main post story text page blog hentry prose".split())
BAD = frozenset(
    "ad ads advert advertisement alert banner breadcrumb breadcrumbs byline comment comments consent cookie copyright disqus footer form gdpr header login masthead menu meta modal nav navbar navigation newsletter notice popup promo related replies reply search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget".split()
)
_NEXT = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
TAGS = "p h1 h2 h3 h4 li ul ol div section article main header footer nav aside form a span td table blockquote pre figure body html".split()


@dataclass
class Element:
    tag: str
    parent: int
    good: int = 0
    bad: int = 0
    hidden: bool = False
    parts: list = field(default_factory=list)  # texts, and numbers of child elements, in page order


def parse(page: str) -> list[Element]:
    """Elements of a page in page order, the root first. Comments and raw elements such as scripts are left out."""
    nodes = [Element("html", -1)]
    open_nodes = [0]
    at = 0
    while True:
        match = _NEXT.search(page, at)
        text = page[at : match.start() if match else len(page)]
        if text:
            nodes[open_nodes[-1]].parts.append(references.unescape(text))
        if match is None:
            return nodes
        at = match.end()
        if not match[2]:
            continue
        tag = match[2].lower()
        if match[1]:
            depth = next((i for i in range(len(open_nodes) - 1, 0, -1) if nodes[open_nodes[i]].tag == tag), 0)
            if depth and (tag in BLOCKS or not any(nodes[n].tag in BLOCKS for n in open_nodes[depth:])):
                del open_nodes[depth:]
            continue
        if tag in RAW and not match[3].rstrip().endswith("/"):
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if tag == "head" and end is None:
                continue
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            nodes[open_nodes[-1]].parts.append(" ")
        if tag in VOID or tag in ("html", "body") and len(nodes) > 1 and any(nodes[n].tag == tag for n in open_nodes):
            continue
        if tag == "html":
            continue
        if tag in CLOSES_P:
            _close(nodes, open_nodes, {"p"}, BLOCKS - {"p"})
        if tag == "li":
            _close(nodes, open_nodes, {"li"}, {"ul", "ol", "menu"})
        elif tag in ("dt", "dd"):
            _close(nodes, open_nodes, {"dt", "dd"}, {"dl"})
        elif tag in ("td", "th", "tr"):
            _close(nodes, open_nodes, {"td", "th"} | ({"tr"} if tag == "tr" else set()), {"table"})
        names = [w.lower() for m in _NAMES.finditer(match[3]) for w in _PARTS.findall(m[1] or m[2] or m[3] or "")]
        nodes.append(Element(tag, open_nodes[-1], sum(w in GOOD for w in names), sum(w in BAD for w in names), bool(_HIDDEN.search(match[3]))))
        nodes[open_nodes[-1]].parts.append(len(nodes) - 1)
        if not match[3].rstrip().endswith("/") or tag in BLOCKS:
            open_nodes.append(len(nodes) - 1)


def _close(nodes: list[Element], open_nodes: list[int], tags: set[str], within: set[str] | frozenset[str]) -> None:
    """Close the innermost open element of ``tags``, but none beyond one of ``within``."""
    for i in range(len(open_nodes) - 1, 0, -1):
        tag = nodes[open_nodes[i]].tag
        if tag in tags:
            del open_nodes[i:]
            return
        if tag in within:
            return


def features(nodes: list[Element]) -> np.ndarray:
    """A row of numbers for every element."""
    n = len(nodes)
    chars, links, marks, tags, paragraphs, bad_below = (np.zeros(n) for _ in range(6))
    depth, up_good, up_bad, place, siblings, alike = (np.zeros(n) for _ in range(6))
    for i, node in enumerate(nodes):
        own = [p for p in node.parts if isinstance(p, str)]
        chars[i] = sum(len(" ".join(p.split())) for p in own)
        marks[i] = sum(p.count(".") + p.count(",") for p in own)
        children = [p for p in node.parts if isinstance(p, int)]
        counts: dict[str, int] = {}
        for c in children:
            counts[nodes[c].tag] = counts.get(nodes[c].tag, 0) + 1
        for k, c in enumerate(children):
            place[c], siblings[c], alike[c] = (k + 0.5) / len(children), len(children), counts[nodes[c].tag]
            depth[c] = depth[i] + 1
            up_good[c], up_bad[c] = up_good[i] + _good(node), up_bad[i] + _bad(node)
    for i in range(n - 1, -1, -1):  # children come after their parents
        node = nodes[i]
        tags[i] += 1
        paragraphs[i] += node.tag in ("p", "blockquote", "pre")
        bad_below[i] += _bad(node) > 0
        if node.tag == "a":
            links[i] = chars[i]
        if node.parent >= 0:
            for total in (chars, links, marks, tags, paragraphs, bad_below):
                total[node.parent] += total[i]
    above = np.array([max(node.parent, 0) for node in nodes])
    columns = [np.log1p(chars), links / np.maximum(chars, 1), marks / np.maximum(chars, 1), chars / tags, np.log1p(tags), np.log1p(paragraphs)]
    columns += [bad_below / tags, depth, place, np.log1p(siblings), np.log1p(alike), chars / np.maximum(chars[above], 1), chars / max(chars[0], 1)]
    columns += [links[above] / np.maximum(chars[above], 1), np.log1p(paragraphs[above])]
    columns += [np.array([v(node) for node in nodes], float) for v in (_good, _bad, lambda node: node.hidden)]
    columns += [up_good, up_bad]
    index = {tag: k for k, tag in enumerate(TAGS)}
    own = np.array([index.get(node.tag, -1) for node in nodes])
    columns += [(own == k).astype(float) for k in range(len(TAGS))]
    columns += [(own[above] == index[t]).astype(float) for t in ("p", "li", "div", "section", "article")]
    return np.stack(columns, 1)


def _good(node: Element) -> int:
    return node.good + (node.tag in ("article", "main"))


def _bad(node: Element) -> int:
    return node.bad + (node.tag in ("nav", "header", "footer", "aside", "form"))


def decode(nodes: list[Element], scores: np.ndarray) -> np.ndarray:
    """Which elements are kept: the best sum of scores in which a dropped element keeps nothing inside it."""
    n = len(nodes)
    inside = np.zeros(n)  # the best an element's children add if it is kept
    dropped = -scores.copy()  # the sum if the element and all inside it are dropped
    best = np.zeros(n)
    for i in range(n - 1, -1, -1):
        best[i] = max(scores[i] + inside[i], dropped[i])
        if nodes[i].parent >= 0:
            inside[nodes[i].parent] += best[i]
            dropped[nodes[i].parent] += dropped[i]
    kept = np.zeros(n, bool)
    for i, node in enumerate(nodes):
        kept[i] = (node.parent < 0 or kept[node.parent]) and scores[i] + inside[i] > dropped[i]
    return kept


def kept_text(nodes: list[Element], kept: np.ndarray) -> str:
    """Text of the kept elements: one line per block, white space inside as one space, no empty lines."""
    blocks: list[list[str]] = [[]]
    stack: list[tuple[int, int]] = [(0, 0)] if kept[0] else []
    while stack:
        number, at = stack.pop()
        node = nodes[number]
        block = node.tag in BLOCKS
        if at == 0 and block:
            blocks.append([])
        descended = False
        for k in range(at, len(node.parts)):
            part = node.parts[k]
            if isinstance(part, str):
                blocks[-1].append(part)
            elif kept[part]:
                stack += [(number, k + 1), (part, 0)]
                descended = True
                break
            elif nodes[part].tag in BLOCKS:
                blocks.append([])
        if not descended and block:
            blocks.append([])
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def main_texts(pages: list[str | None], model: Boosted, together: int = 200) -> Iterator[str]:
    """Main text of each page; empty for null, and where no element is kept."""
    for at in range(0, len(pages), together):  # pages scored at once
        parsed = [parse(page or "") for page in pages[at : at + together]]
        tables = [features(nodes) for nodes in parsed]
        scores = model.score(np.concatenate(tables))
        scores[np.concatenate(tables)[:, 0] == 0] = 0.0  # an element without text says nothing
        cuts = np.cumsum([len(nodes) for nodes in parsed])[:-1]
        for nodes, own in zip(parsed, np.split(scores, cuts)):
            yield kept_text(nodes, decode(nodes, own))


class _Layouts:
    """Generated pages: every element is labelled by whether it holds main text."""

    def __init__(self, seed: int) -> None:
        self.random = random.Random(seed)

    def words(self, low: int, high: int, end: str = ".") -> str:
        r = self.random
        out = ["".join(r.choice("ka te ri no lu sha ble qui mo er in ad".split()) for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high))]
        for i in range(7, len(out), 9):
            out[i] += r.choice(",.")
        return " ".join(out).capitalize() + end

    def links(self, count: int) -> list[str]:
        return [f'<a href="/{i}">{self.words(1, 3, "")}</a>' for i in range(count)]

    def named(self, tag: str, *names: str) -> str:
        name = self.random.choice(names)
        return f'{tag} {self.random.choice(["class", "id"])}="{name}"' if name else tag

    def box(self, opening: str, inside: str) -> str:
        return f"<{opening}>{inside}</{opening.split()[0]}>"

    def menu(self) -> str:
        r = self.random
        items = self.links(r.randint(3, 9))
        inside = self.box("ul", "".join(self.box("li", a) for a in items)) if r.random() < 0.7 else " | ".join(items)
        return self.box(r.choice(["nav", self.named("div", "menu", "nav", "navbar", "topnav"), self.named("nav", "main-menu", "site-nav")]), inside)

    def header(self) -> str:
        inside = self.box(self.random.choice(["div", "h1", "h2", "p", "span"]), self.words(1, 4, "")) + self.random.choice(["", self.box("p", self.words(3, 8))])
        return self.box(self.random.choice(["header", self.named("div", "header", "masthead", "banner", "top-header")]), inside)

    def footer(self) -> str:
        inside = "&copy; " + self.words(2, 5, "") + " " + self.words(4, 16)
        if self.random.random() < 0.5:
            inside = self.box("p", inside)
        return self.box(self.random.choice(["footer", self.named("div", "footer", "copyright", "page-footer")]), inside + " ".join(self.links(self.random.randint(0, 3))))

    def advert(self) -> str:
        inside = self.words(3, 20)
        return self.box(self.named(self.random.choice(["div", "div", "aside", "p"]), "ad", "advert", "sponsored", "ad-banner", "promo", "ads"), self.random.choice([inside, self.box("p", inside)]))

    def notice(self) -> str:
        return self.box(self.named("div", "cookie-notice", "notice", "gdpr", "consent-banner", "alert", "popup"), self.box("p", self.words(6, 25)) + self.random.choice(["", "<button>OK</button>"]))

    def sidebar(self) -> str:
        parts = [self.box("h3", self.words(1, 3, "")), self.box("ul", "".join(self.box("li", a) for a in self.links(4))), self.box("p", self.words(5, 25)), self.box("p", self.words(5, 15))]
        return self.box(self.random.choice(["aside", self.named("div", "sidebar", "widget", "related", "sidebar-right"), self.named("aside", "sidebar", "")]), "".join(parts[: self.random.randint(1, 4)]))

    def form(self) -> str:
        return self.box(self.random.choice(["form", self.named("form", "search", "newsletter", "subscribe-form")]), f"<label>{self.words(1, 4, '')}</label><input name=q>" + self.random.choice(["", self.box("p", self.words(4, 12))]))

    def comments(self) -> str:
        one = [self.box(self.named("div", "comment", "reply"), self.box("b", self.words(1, 2, "")) + self.box("p", self.words(4, 40))) for _ in range(self.random.randint(1, 5))]
        return self.box(self.random.choice([self.named("section", "comments", "replies"), self.named("div", "comments", "comment-list", "disqus")]), self.box("h3", self.words(1, 2, "")) + "".join(one))

    def article(self) -> str:
        r = self.random
        parts = []
        if r.random() < 0.85:
            parts.append(self.box(r.choice(["h1", "h1", "h2"]), self.words(2, 12, "")))
        for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14])):
            kind = r.random()
            if kind < 0.8:
                text = self.words(r.choice([2, 5, 20]), r.choice([30, 60, 120]))
                text = text if r.random() < 0.7 else f"<b>{text}" + r.choice(["<br>", "</b>", "</b> " + self.links(1)[0] + " " + self.words(2, 9)])
                parts.append(f"<p>{text}" + r.choice(["</p>", "</p>", "</p>", ""]))
            elif kind < 0.87:
                parts.append(self.box(r.choice(["h2", "h3"]), self.words(2, 6, "")))
            elif kind < 0.94:
                parts.append(self.box(r.choice(["ul", "ol"]), "".join(self.box("li", self.words(3, 25)) for _ in range(r.randint(2, 5)))))
            else:
                parts.append(self.box("blockquote", self.box("p", self.words(8, 40))))
        if r.random() < 0.25:
            extra = r.choice([self.advert, self.comments, self.sidebar, self.form, self.notice, self.menu])()
            parts.insert(r.randint(1, len(parts)), f"\0{extra}\1")
        opening = r.choice(["article", "article", "main", self.named("div", "content", "post", "entry-content", "article-body", "main", "story", "text"), self.named("section", "content", "post"), "div"])
        out = self.box(opening, "".join(parts))
        if r.random() < 0.3:
            out = self.box(r.choice(["main", "div", self.named("div", "main", "page", "wrapper", "container")]), out)
        return out

    def page(self) -> str:
        r = self.random
        before = [f() for f in (self.header, self.menu, self.advert, self.notice, self.form, self.sidebar) if r.random() < 0.45]
        after = [f() for f in (self.comments, self.sidebar, self.advert, self.notice, self.form, self.menu) if r.random() < 0.3]
        if r.random() < 0.8:
            after.append(self.footer())
        r.shuffle(before)
        main = self.article() if r.random() < 0.97 else ""
        return "<body>" + "".join(f"\0{x}\1" for x in before) + main + "".join(f"\0{x}\1" for x in after) + "</body>"


def _labelled(page: str) -> tuple[list[Element], np.ndarray]:
    """Elements of a generated page, and which hold main text; boilerplate is bracketed by control characters."""
    nodes = parse(page)
    holds = np.zeros(len(nodes), bool)
    off = 0
    stack = [(0, 0)]
    while stack:  # page order
        number, at = stack.pop()
        for k in range(at, len(nodes[number].parts)):
            part = nodes[number].parts[k]
            if isinstance(part, int):
                stack += [(number, k + 1), (part, 0)]
                break
            for piece in re.split("([\0\1])", part):
                off += {"\0": 1, "\1": -1}.get(piece, 0)
                if not off and piece.strip("\0\1 \n"):
                    holds[number] = True
    for i in range(len(nodes) - 1, 0, -1):
        holds[nodes[i].parent] |= holds[i]
        nodes[i].parts = [p.translate({0: None, 1: None}) if isinstance(p, str) else p for p in nodes[i].parts]
    nodes[0].parts = [p.translate({0: None, 1: None}) if isinstance(p, str) else p for p in nodes[0].parts]
    return nodes, holds


@lru_cache(maxsize=2)
def fitted(pages: int = 900, seed: int = 5) -> Boosted:
    """Trees fitted on generated pages; the same for the same arguments."""
    layouts = _Layouts(seed)
    tables, labels = [], []
    for _ in range(pages):
        nodes, holds = _labelled(layouts.page())
        table = features(nodes)
        said = table[:, 0] > 0
        tables.append(table[said])
        labels.append(holds[said])
    return fit(np.concatenate(tables), np.concatenate(labels).astype(float))


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", model: Boosted | None = None) -> DataFrame:
    """``key``, ``url`` and ``text`` of every row: the main text of the whole page.

    Character references are decoded, blocks joined by line feeds in page order. A null or empty page, and one without
    main text, gives an empty text. Repeated rows are extracted each for itself; other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or fitted())  # some thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = list(main_texts(batch.column(2).to_pylist(), model))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["key", "url", "text"])

    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return rows.mapInArrow(run, f"key {kind}, url string, text string").withColumnRenamed("key", key)

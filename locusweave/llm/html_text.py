"""Main text of web pages by a tree-structured graphical model.

The block elements of a page are the nodes of a tree and are content or not.
Features of an element (tag, names, amount of text, links) give its own
potential, a table for parent and child couples them, and sum-product messages
up and down the tree give every element's marginal. Both tables are counted on
labelled pages: small pages built here, and a bounded sample of the pages whose
markup says what is content.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINING_PAGES = 2_000  # pages whose markup labels them, those with the smallest hash of their id

# Elements that do not break a block, elements whose text is not markup, and elements without an end tag.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn del em font i ins kbd mark q s samp small span strike strong sub sup "
                   "time tt u var wbr".split())
RAW = frozenset("script style textarea title iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table select body article section div main object template foreignobject".split())
P_SCOPES = frozenset("button table td th object template foreignobject".split())

# Elements that stand inside a line but are nodes, the foreign ones among them (they and what is in them may be
# self-closed), where HTML goes on inside those, the foreign elements that break a block, and the HTML elements that end foreign ones.
EMBEDDED = frozenset("svg math object noscript template".split())
FOREIGN = frozenset(("svg", "math"))
HTML_AGAIN = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
FOREIGN_BLOCKS = HTML_AGAIN | {"text", "annotation"}
ENDS_FOREIGN = frozenset((
    "article aside b big blockquote body br center code dd div dl dt em embed figure footer h1 h2 h3 h4 h5 h6 head header hr i img li main menu "
    "meta nav ol p pre s section small span strong strike sub sup table tt u ul var").split())

# What authors call parts of a page that are not, or are, its article.
OUTSIDE_TAGS = frozenset("head nav header footer aside form menu button select label dialog fieldset".split())
OUTSIDE_NAMES = frozenset((
    "nav navbar navigation menu menubar breadcrumb header masthead footer foot bottom sidebar side aside widget ad ads adv advert advertisement "
    "sponsor sponsored promo promotion banner cookie consent gdpr notice alert popup modal overlay newsletter subscribe signup login search "
    "form comment comments commentlist respond reply replies discussion disqus related recommended share sharing social follow toolbar pagination "
    "pager tags meta copyright legal disclaimer skip hidden banner complementary contentinfo dialog").split())
INSIDE_TAGS = frozenset(("article", "main"))
INSIDE_NAMES = frozenset("article articlebody main content maincontent post postbody entry entrycontent story storybody body text prose".split())

# A quote opens a value directly after "=" only, and if it is closed; any other is an ordinary character.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|["'][^\s>]*+)"""
_TAG = re.compile(rf"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE})?+)*+(?=>)|[^>]*+)>|<[!?][^>]*>""", re.S)
_ATTRIBUTE = re.compile(rf"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+({_VALUE}))?+""")
_OPEN_COMMENT = re.compile(r"<!--.*", re.S)  # all that can start behind the last ">"
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Node:
    """A block element, or an inline element that has names."""

    parent: int
    tag: str
    names: frozenset[str]
    size: int = 0
    linked: int = 0
    stops: int = 0
    wrapped: bool = False  # a plain box that is all there is in another


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    runs: list[tuple[int, str]] = field(default_factory=list)  # (node, text); node -1 marks a block's border


def _names(attributes: str) -> frozenset[str]:
    found: set[str] = set()
    for key, value in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key in ("class", "id", "role", "itemprop"):
            plain = _CAMEL.sub(" ", html.unescape(value.strip("\"'"))).lower()
            found.update(_NAME.findall(plain))
            found.update("".join(_NAME.findall(part)) for part in plain.split())
        elif key == "hidden" or key == "aria-hidden" and "true" in value or key == "style" and re.search(r"display\s*:\s*none", value):
            found.add("hidden")
    return frozenset(found)


def parse(source: str) -> Page:
    """Tree of a page and its text runs in page order; mends open and stray tags the way browsers do.

    Depths of open elements are kept by tag, so the time grows with the page and not with its depth.
    """
    page = Page([Node(-1, "#root", frozenset())])
    stack: list[tuple[str, int, bool]] = [("#root", 0, True)]  # (tag, node that text belongs to, whether it breaks a block)
    opened: dict[str, list[int]] = defaultdict(list)  # depths of the open elements of a tag, outermost first
    unended: set[tuple[str, str]] = set()  # (raw element, graphic around it) that no end follows
    links = embedded = 0

    def text(raw: str) -> None:
        if not raw:
            return
        plain = html.unescape(raw) if "&" in raw else raw
        at = stack[-1][1]
        page.runs.append((at, plain))
        node, shown = page.nodes[at], len(plain.strip())
        node.size += shown
        node.linked += shown if links else 0
        node.stops += plain.count(". ") + plain.rstrip().endswith((".", "!", "?"))

    def pop(depth: int) -> None:
        nonlocal links, embedded
        for tag, _, block in stack[depth:]:
            opened[tag].pop()
            links -= tag == "a"
            embedded -= tag in FOREIGN
            if block:
                page.runs.append((-1, ""))
        del stack[depth:]

    def innermost(tags: Iterable[str]) -> int:
        return max((opened[tag][-1] for tag in tags if tag in opened and opened[tag]), default=0)

    def nearest(tags: Iterable[str], scope: frozenset[str]) -> int | None:
        depth = innermost(tags)
        return depth if depth and depth >= innermost(scope) else None

    def foreign() -> int | None:
        """Depth of the innermost svg or math element whose rules hold here."""
        return nearest(FOREIGN, HTML_AGAIN) if embedded else None

    at, end, last = 0, len(source), source.rfind(">")
    while at < end:
        found = (_TAG if at <= last else _OPEN_COMMENT).search(source, at)
        if found is None:
            text(source[at:])
            break
        text(source[at:found.start()])
        at = found.end()
        if not found.lastindex:
            continue
        closing, tag, attributes = found[1], found[2].lower(), found[3]
        if closing:
            if depth := innermost((tag,)):
                pop(depth)
            elif tag == "p" or tag == "br":
                page.runs.append((-1, ""))
            continue
        root = foreign()
        if root is not None and tag in ENDS_FOREIGN:
            while root is not None:
                pop(root)
                root = foreign()
        if (root is not None or tag in FOREIGN) and attributes.endswith("/"):
            continue
        if tag in VOID:
            if tag not in INLINE and tag != "img" and tag != "input":
                page.runs.append((-1, ""))
            continue
        if tag in RAW:
            if root is None:
                finish = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = finish.end() if finish else end
            else:  # at most to the end of the graphic, or to the next tag if that is open
                around = stack[root][0]
                finish = None if (tag, around) in unended else re.compile(rf"(?=</{around}[\s/>])|</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
                if finish is None:
                    unended.add((tag, around))
                after = finish.end() if finish else source.find("<", at)
                at = end if after < 0 else after
            continue
        block = tag in FOREIGN_BLOCKS if root is not None else tag not in INLINE and tag not in EMBEDDED
        if block and root is None:
            if (depth := nearest(("p",), P_SCOPES)) is not None:
                pop(depth)
            if tag in CLOSES and (depth := nearest(CLOSES[tag], SCOPES)) is not None:
                pop(depth)
                while tag == "tr" and (depth := nearest(CLOSES[tag], SCOPES)) is not None:
                    pop(depth)
        if block:
            page.runs.append((-1, ""))
        names = _names(attributes) if attributes.strip(" /") else frozenset()
        opened[tag].append(len(stack))
        if tag in INLINE and not names:
            stack.append((tag, stack[-1][1], block))
        else:
            page.nodes.append(Node(stack[-1][1], tag, names))
            stack.append((tag, len(page.nodes) - 1, block))
        links += tag == "a"
        embedded += tag in FOREIGN
    plain = [node.tag == "div" and not node.names for node in page.nodes]
    children = Counter(node.parent for node in page.nodes)
    for i, node in enumerate(page.nodes):
        above = node.parent
        node.wrapped = plain[i] and above >= 0 and plain[above] and children[above] == 1 and not page.nodes[above].size
    return page


def features(node: Node) -> list[str]:
    tag = "h" if re.fullmatch("h[1-6]", node.tag) else "#text" if node.parent < 0 and node.size else node.tag
    out = [] if node.wrapped else [f"tag {tag}", *(f"name {n}" for n in node.names)]
    if not node.names and not node.wrapped:
        out.append("no name")
    if node.size:
        share = node.linked / node.size
        out.append("links " + ("none" if share == 0 else "some" if share < 0.5 else "most"))
        out.append(f"size {min(4, node.size.bit_length() // 2)}")
        out.append("stops " + ("none" if not node.stops else "some"))
    return out


def markup_labels(page: Page) -> list[int] | None:
    """Labels of the nodes where the markup names an article or main element; None where it does not."""
    labels, seen = [], False
    for node in page.nodes:
        inherited = labels[node.parent] if node.parent >= 0 else 0
        if node.tag in INSIDE_TAGS:
            seen = True
            inherited = 1
        if node.tag in OUTSIDE_TAGS or node.names & OUTSIDE_NAMES and node.tag != "article":
            inherited = 0
        labels.append(inherited)
    return labels if seen else None


def built_pages() -> Iterator[tuple[Page, list[int]]]:
    """Labelled pages around every fixed tag and name: article wrappers, parts outside and parts inside the article."""
    prose = "A sentence of the article, long enough to be read. Another follows it, and then one more. " * 3
    body = (f"<h1>Title of it</h1><p>{prose}</p><section><h2>Part</h2><p>{prose}<a href=x>link</a> goes on.</p></section><ul><li>{prose}</li><li>Short</li></ul>"
            f"<blockquote><p>{prose}</p></blockquote><table><tbody><tr><td>One</td><td>Two</td></tr></tbody></table><figure><figcaption>Shown here</figcaption></figure>"
            f"<pre>code</pre><dl><dt>Word</dt><dd>Meaning</dd></dl><ol><li>First</li></ol><div>{prose}</div><p>Short.</p>")
    boxes = ("div", "section", "div", "ul", "div", "p")
    wrappers = [f"<{t}>%s</{t}>" for t in sorted(INSIDE_TAGS)] + [f'<{t} class="{n}">%s</{t}>' for n, t in zip(sorted(INSIDE_NAMES), boxes[:2] * 40)]
    parts = [f"<{t}>%s</{t}>" for t in sorted(OUTSIDE_TAGS)] + [f'<{t} class="{n}">%s</{t}>' for n in sorted(OUTSIDE_NAMES) for t in boxes[:2]]
    parts += [f'<{t} class="{n}">%s</{t}>' for n, t in zip(sorted(OUTSIDE_NAMES), boxes * 40)]
    fillings = ("by Someone", "<p>Share</p>", "<ul><li><a href=x>One</a></li><li><a href=x>Two</a></li></ul>", "A short line.", "<div><h3>Words</h3><p>Someone wrote this here. It is not the article.</p></div>", f"<p>{prose}</p>")
    for i, part in enumerate(parts):
        for j, filling in enumerate(fillings):
            wrapper = wrappers[(i + j) % len(wrappers)]
            outside = part % filling
            inner = body + outside if j % 2 else outside + body
            before, after = (outside, "") if i % 2 else ("", outside)
            page = parse(f"<html><head><title>t</title></head><body><div>{before}{wrapper % inner}{after}</div></body></html>")
            labels: list[int] = []
            for node in page.nodes:
                label = labels[node.parent] if node.parent >= 0 else 0
                if node.tag in INSIDE_TAGS or node.names & INSIDE_NAMES and node.tag != "body":
                    label = 1
                if node.tag in OUTSIDE_TAGS or node.names & OUTSIDE_NAMES:
                    label = 0
                labels.append(label)
            yield page, labels
    for _ in range(20):  # pages that are nothing but their text
        for source in (prose, "Text alone. Short.", "<p>Text alone.</p>", f"<body>{prose}</body>", f"<html><body>{body}</body></html>", f"<body><div><div>{body}</div></div></body>"):
            page = parse(source)
            yield page, [1] * len(page.nodes)


def count_page(counts: Counter, page: Page, labels: list[int], weight: int = 1) -> None:
    """Adds each node's features under its parent's label and its own; the root counts as a child of no content."""
    for node, label in zip(page.nodes, labels):
        if node.wrapped:
            continue
        above = labels[node.parent] if node.parent >= 0 else 0
        for name in ("", *features(node)):
            counts[name, above, label] += weight


# A wrapped box has the label of the box around it, so that nesting by itself says nothing.
SAME = np.array([[0.0, -60.0], [-60.0, 0.0]])


@dataclass
class TreeModel:
    """Log potentials of an edge by labels of parent and child: ``potentials[""]`` of the edge itself, the others of a feature of the child."""

    potentials: dict[str, np.ndarray]

    @classmethod
    def from_counts(cls, counts: Counter, limit: float = 6.0) -> TreeModel:
        """Log frequencies of labels given the parent's, and of features given both, relative to all nodes."""
        edges = np.array([[counts["", a, b] for b in (0, 1)] for a in (0, 1)]) + 1.0
        potentials = {"": np.log(edges / edges.sum(axis=1, keepdims=True))}
        for name in sorted({key[0] for key in counts if key[0]}):
            held = np.array([[counts[name, a, b] for b in (0, 1)] for a in (0, 1)], dtype=float)
            usual = (held.sum() + 0.5) / (edges.sum() + 1)
            # Amounts of text vary more than the labelled pages show; tags and names mean what they say.
            most = limit if name.startswith(("tag", "name")) else 0.5
            potentials[name] = np.clip(np.log((held + 5 * usual) / (edges + 5) / usual), -most, most)
        return cls(potentials)

    def edge(self, node: Node) -> list[list[float]]:
        known = [self.potentials[name] for name in features(node) if name in self.potentials]
        table = sum(known, SAME if node.wrapped else self.potentials[""])
        return np.exp(table - table.max()).tolist()

    def marginals(self, page: Page) -> list[float]:
        """Probability of content per node: messages from the leaves to the root, then back."""
        n = len(page.nodes)
        edges = [self.edge(node) for node in page.nodes]
        below = [[1.0, 1.0] for _ in range(n)]  # product of the messages of the children
        upward: list[tuple[float, float]] = [(1.0, 1.0)] * n
        for i in range(n - 1, -1, -1):
            (c00, c01), (c10, c11) = edges[i]
            b0, b1 = below[i]
            m0, m1 = c00 * b0 + c01 * b1, c10 * b0 + c11 * b1
            upward[i] = (m0 / (m0 + m1) + 1e-200, m1 / (m0 + m1) + 1e-200)
            if i:
                parent = below[page.nodes[i].parent]
                p0, p1 = parent[0] * upward[i][0], parent[1] * upward[i][1]
                parent[0], parent[1] = p0 / (p0 + p1) + 1e-200, p1 / (p0 + p1) + 1e-200
        beliefs = [(0.0, 0.0)] * n
        for i in range(n):
            (c00, c01), (c10, c11) = edges[i]
            p0, p1 = beliefs[page.nodes[i].parent] if i else (1.0, 0.0)
            p0, p1 = p0 / upward[i][0], p1 / upward[i][1]
            b0, b1 = below[i][0] * (p0 * c00 + p1 * c10), below[i][1] * (p0 * c01 + p1 * c11)
            beliefs[i] = (b0 / (b0 + b1), b1 / (b0 + b1)) if b0 + b1 > 0 else (0.5, 0.5)
        return [b for _, b in beliefs]

    def extract(self, source: str | None) -> str:
        """Text of the content elements; blocks are joined by one space, and so is white space inside them."""
        page = parse(source or "")
        content = self.marginals(page)
        return " ".join("".join(" " if at < 0 else run if content[at] > 0.5 else "" for at, run in page.runs).split())


def fit(pages: DataFrame, rows: int = TRAINING_PAGES) -> TreeModel:
    """Fits on the built pages and at most ``rows`` pages that name an article or main element."""
    # Ids are chosen first, so that the choice moves no pages; of several pages with a chosen id the one with the smallest hash counts.
    named = pages.select("page_id", "html", F.xxhash64("html").alias("hash")).where(F.lower("html").rlike("<(article|main)[ >]") & F.col("page_id").isNotNull())
    chosen = named.groupBy("page_id").agg(F.min("hash").alias("hash")).orderBy(F.xxhash64("page_id"), "page_id").limit(rows)
    sample = named.join(F.broadcast(chosen), ["page_id", "hash"]).groupBy("page_id", "hash").agg(F.first("html").alias("html"))  # at most `rows` ids

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for source in batch["html"]:
                page = parse(source)
                labels = markup_labels(page)
                if labels is not None:
                    count_page(counts, page, labels)
        if counts:
            yield pd.DataFrame([(*key, n) for key, n in counts.items()], columns=["name", "above", "label", "n"])

    counted = sample.mapInPandas(count, "name string, above int, label int, n long").groupBy("name", "above", "label").agg(F.sum("n").alias("n"))
    counts: Counter = Counter()
    for page, labels in built_pages():
        count_page(counts, page, labels, 20)
    for row in counted.collect():  # features that occur in the sample
        counts[row["name"], row["above"], row["label"]] += row["n"]
    return TreeModel.from_counts(counts)


def main_text(source: Column, model: TreeModel) -> Column:
    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([model.extract(s) for s in batch], index=batch.index, dtype="object")

    return extract(source)


def extract_pages(pages: DataFrame, rows: int = TRAINING_PAGES) -> DataFrame:
    """``page_id, url, text`` of every row of ``pages``.

    The text is empty where nothing is content, and for null or empty html.
    Repeated rows are extracted each; other columns are left out, whatever their
    names.
    """
    return pages.select("page_id", "url", main_text(F.coalesce("html", F.lit("")), fit(pages, rows)).alias("text"))

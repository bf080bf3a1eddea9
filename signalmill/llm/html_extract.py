"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element is a node with a hidden label, content or not. What a node shows of itself
(words of class and id, share of link text, tags that name a part of the page) depends on its
label. Its tag and its amounts of text depend on its label and its parent's: they tell where
content begins, and nothing about the parts of what is content, so that a short heading, a list or
a table is left out of an article only if it shows so of itself. A label depends on the parent's.
The tables are counted on labelled pages: those that mark their article and the parts around it
with tags of that meaning. Sum-product messages, up from the leaves and down from the root, give
each node's marginal; text in nodes that are more likely content is kept. A page in which nothing
is content is taken for an article whole, without what shows that it is not.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import batches_of

# Labelled pages to train on, about, drawn by hash of the page_id.
LABELLED_PAGES = 4000
# How often a word must be seen on labelled pages to count.
LEAST_SEEN = 3

# Fixed lists of HTML's element kinds.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# Without their text. Raw ones end at their own closing tag only; the others are elements as any.
RAW = frozenset("head iframe noembed noframes noscript script style textarea title xmp".split())
DROPPED = frozenset(
    "applet audio button canvas datalist frameset math object select svg template video".split()
)
EMPTY = frozenset({"embed"})
# Dropped ones that end with the paragraph or item they are in.
PASSED = frozenset("audio canvas datalist video".split())
FOREIGN = frozenset({"math", "svg"})
# Parts of foreign elements that hold HTML; elsewhere in them a tag of BREAKOUT ends them.
HTML_IN_FOREIGN = frozenset("annotation-xml desc foreignobject mi mn mo ms mtext".split())
BREAKOUT = frozenset(
    "blockquote body center dd div dl dt h1 h2 h3 h4 h5 h6 hr li menu ol p pre table ul".split()
)
CLOSED_BY_SIBLING = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"},
}
SCOPES = frozenset("ul ol dl table menu dir".split())

# What words in class, id and role usually say; they count like so many seen examples.
OFTEN_AROUND = (
    "ad ads advert advertisement banner breadcrumb breadcrumbs byline comment comments consent "
    "cookie cookies disqus footer form header hidden login masthead menu modal nav navbar "
    "navigation newsletter notice pagination popup promo recommended related reply share sharing "
    "sidebar signup social sponsor sponsored subscribe tags teaser toolbar widget"
).split()
OFTEN_CONTENT = "article content entry main post story text".split()
AROUND_TAGS = ("aside", "footer", "form", "menu", "nav")
TELLING = frozenset({*AROUND_TAGS, "article", "main"})
PRIOR = 2000.0
# A node has its parent's label, as if seen so often against once otherwise.
KEPT_LABEL = 200.0
# Odds of the frame of a page that is taken for an article whole.
WHOLE = 1000.0
FRAME = frozenset({"#page", "html", "body"})
# Tag and amounts of text say much the same, so each counts for less than alone.
AMOUNT_WEIGHT = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>",
    re.S,
)
_UNENDED = re.compile("<[a-zA-Z/!?]")
_NAMES = re.compile(
    r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I
)
_WORD = re.compile(r"[a-z]+")
_STOP = re.compile(r"[.!?…。](?:\s|$)")


@dataclass
class Page:
    """Nodes in document order, the root first, and the text blocks with their node."""

    tag: list[str] = field(default_factory=lambda: ["#page"])
    parent: list[int] = field(default_factory=lambda: [-1])
    names: list[frozenset[str]] = field(default_factory=lambda: [frozenset()])
    blocks: list[tuple[int, str]] = field(default_factory=list)
    chars: list[int] = field(default_factory=lambda: [0])
    linked: list[int] = field(default_factory=lambda: [0])
    stops: list[int] = field(default_factory=lambda: [0])


def name_words(attributes: str) -> frozenset[str]:
    found = set()
    for name, value in _NAMES.findall(attributes):
        if name.lower() in ("hidden", "aria-hidden"):
            if value.strip("\"'").lower() != "false":
                found.add("hidden")
        else:
            spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", value)
            found.update(_WORD.findall(spaced.lower()))
    return frozenset(found)


def parse(source: str) -> Page:
    page = Page()
    open_ = [0]
    text: list[tuple[str, bool]] = []
    in_link = False
    dropped: list[str] = []  # open elements from the dropped one down

    def flush() -> None:
        if text:
            words = " ".join(html.unescape("".join(t for t, _ in text)).split())
            if words:
                node = open_[-1]
                page.blocks.append((node, words))
                page.chars[node] += len(words)
                page.stops[node] += len(_STOP.findall(words))
                if any(linked for _, linked in text):
                    inside = " ".join(html.unescape("".join(t for t, a in text if a)).split())
                    page.linked[node] += len(inside)
            text.clear()

    at, end = 0, len(source)
    while at < end:
        found = _TOKEN.search(source, at)
        if found is None:
            if not dropped:
                text.append((_UNENDED.split(source[at:], maxsplit=1)[0], in_link))
            break
        if found.start() > at and not dropped:
            text.append((source[at : found.start()], in_link))
        at = found.end()
        closing, tag, attributes = found.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if dropped and tag not in RAW:
            if closing:
                if tag in dropped:
                    del dropped[len(dropped) - 1 - dropped[::-1].index(tag) :]
                    continue
                if tag not in BLOCKS or all(page.tag[node] != tag for node in open_):
                    continue
                dropped.clear()
            else:
                while dropped and dropped[-1] in FOREIGN and tag in BREAKOUT:
                    dropped.pop()
                ends = {"p", *CLOSED_BY_SIBLING.get(tag, ())} if tag in BLOCKS else ()
                if PASSED.issuperset(dropped) and page.tag[open_[-1]] in ends:
                    dropped.clear()
            if dropped:
                if (tag in BLOCKS and tag != "hr") or tag in DROPPED or tag in HTML_IN_FOREIGN:
                    if not attributes.endswith("/"):
                        dropped.append(tag)
                continue
        if tag in EMPTY:
            text.append((" ", in_link))
        elif tag in DROPPED:
            if not closing and not attributes.endswith("/"):
                dropped.append(tag)
            text.append((" ", in_link))
        elif tag in RAW:
            if not closing and not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                body = re.compile("<body[\\s>]", re.I).search(source, at) if tag == "head" else None
                if close is None and body is not None:
                    at = body.start()
                elif tag != "head" or close is not None:
                    at = close.end() if close else end
            text.append((" ", in_link))
        elif tag == "a":
            in_link = not closing
        elif tag == "br":
            text.append((" ", in_link))
        elif tag in BLOCKS:
            flush()
            in_link = False
            if closing:
                for depth in range(len(open_) - 1, 0, -1):
                    if page.tag[open_[depth]] == tag:
                        del open_[depth:]
                        break
                continue
            if page.tag[open_[-1]] == "p":
                open_.pop()
            for depth in range(len(open_) - 1, 0, -1):
                above = page.tag[open_[depth]]
                if above in CLOSED_BY_SIBLING.get(tag, ()):
                    del open_[depth:]
                    break
                if above in SCOPES or tag not in CLOSED_BY_SIBLING:
                    break
            if tag == "hr":
                continue
            page.tag.append(tag)
            page.parent.append(open_[-1])
            page.names.append(name_words(attributes) if attributes else frozenset())
            page.chars.append(0)
            page.linked.append(0)
            page.stops.append(0)
            open_.append(len(page.tag) - 1)
    flush()
    return page


def features(page: Page) -> list[tuple[list[str], list[str]]]:
    """Of each node what it shows of itself, and its tag and amounts; amounts are of all below it."""
    chars, linked, stops = list(page.chars), list(page.linked), list(page.stops)
    for node in range(len(chars) - 1, 0, -1):
        above = page.parent[node]
        chars[above] += chars[node]
        linked[above] += linked[node]
        stops[above] += stops[node]
    out = []
    for node, tag in enumerate(page.tag):
        n = chars[node]
        shown = [f".{name}" for name in page.names[node]]
        amounts = []
        (shown if tag in TELLING else amounts).append(f"<{tag}>")
        if n:
            shown.append(f"links {min(3, 4 * linked[node] // n)}")
            amounts += [f"size {n.bit_length() // 2}", f"stops {min(2, stops[node])}"]
        out.append((shown, amounts))
    return out


def given_labels(page: Page) -> list[bool] | None:
    """Labels of the nodes of a page that marks its article; None for others.

    A node is content if it is inside of article or main, and not in a part around it nor in a
    part whose names say so.
    """
    if not {"article", "main"} & set(page.tag):
        return None
    inside, around = [False], [False]
    for tag, parent, names in list(zip(page.tag, page.parent, page.names, strict=True))[1:]:
        inside.append(inside[parent] or tag in ("article", "main"))
        around.append(
            around[parent] or tag in AROUND_TAGS or not names.isdisjoint(OFTEN_AROUND)
        )
    return [a and not b for a, b in zip(inside, around, strict=True)]


@dataclass
class TreeModel:
    """Log potentials, content against not: of what a node shows; of its tag and amounts, for a node
    whose parent is no content; and of a child's label given its parent's."""

    odds: dict[str, float]
    amounts: dict[str, float]
    root: float
    child: dict[str, tuple[tuple[float, float], tuple[float, float]]]

    def potentials(self, page: Page):
        """Of each node: what it shows, its amounts, and the table of its label by its parent's."""
        shown, amounts = [], []
        for of_node, of_amounts in features(page):
            shown.append(sum(self.odds.get(f, 0.0) for f in of_node))
            amounts.append(sum(self.amounts.get(f, 0.0) for f in of_amounts))
        common = self.child[""]
        return shown, amounts, [self.child.get(tag, common) for tag in page.tag]

    def marginals(self, page: Page, whole: bool = False) -> list[float]:
        """Probability of content of each node, by messages up the tree and down again.

        The root counts as a node whose parent is no content. ``whole`` says that the page's frame
        is content.
        """
        n = len(page.tag)
        up1, amounts, table = self.potentials(page)
        if whole:
            up1 = [x + WHOLE * (t in FRAME) for x, t in zip(up1, page.tag, strict=True)]
        up0 = [0.0] * n
        message: list[tuple[float, float]] = [(0.0, 0.0)] * n
        for node in range(n - 1, 0, -1):
            (p00, p01), (p10, p11) = table[node]
            a, b = up0[node], up1[node]
            m0 = _log_add(p00 + a, p01 + b + amounts[node])
            message[node] = m0, m1 = m0, _log_add(p10 + a, p11 + b)
            above = page.parent[node]
            up0[above] += m0
            up1[above] += m1
        out = [0.0] * n
        down0, down1 = [0.0] * n, [0.0] * n
        down1[0] = amounts[0] + self.root
        for node in range(n):
            if node:
                above = page.parent[node]
                m0, m1 = message[node]
                a = down0[above] + up0[above] - m0
                b = down1[above] + up1[above] - m1
                (p00, p01), (p10, p11) = table[node]
                down0[node] = _log_add(a + p00, b + p10)
                down1[node] = _log_add(a + p01 + amounts[node], b + p11)
            odds = down1[node] + up1[node] - down0[node] - up0[node]
            out[node] = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
        return out


def _log_add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def _odds(seen: Counter, kind: str, priors: Counter, strength) -> dict[str, float]:
    """Log odds of what was seen of a kind at least LEAST_SEEN times, within its bounds."""
    count: Counter = Counter(priors)
    nodes: Counter = Counter()
    for (of, name, label, _), n in seen.items():
        if of == kind:
            count[name, label] += n
        elif of == f"{kind} nodes":
            nodes[label] += n
    out = {}
    for name in {name for name, _ in count}:
        yes, no = count[name, True], count[name, False]
        if yes + no >= LEAST_SEEN:
            ratio = (yes + 1) / (nodes[True] + 3) / ((no + 1) / (nodes[False] + 3))
            weight, most = strength(name)
            out[name] = max(-most, min(most, weight * math.log(ratio)))
    return out


def make_model(seen: Counter) -> TreeModel:
    """The model from counts of (kind, name, label, parent's label); prior words always count."""
    priors: Counter = Counter()
    for name in OFTEN_AROUND:
        priors[f".{name}", False] += PRIOR
    for name in OFTEN_CONTENT:
        priors[f".{name}", True] += PRIOR
    for tag in AROUND_TAGS:
        priors[f"<{tag}>", False] += PRIOR
    for tag in ("article", "main"):
        priors[f"<{tag}>", True] += PRIOR
    tags = {name for kind, name, _, _ in seen if kind == "edge"} | {""}
    as_parent = (math.log(1 / (1 + KEPT_LABEL)), math.log(KEPT_LABEL / (1 + KEPT_LABEL)))

    def begins(tag: str) -> tuple[float, float]:
        """Of a tag below what is no content; of those that were not seen, of all together."""
        n = [(1.0 if y else KEPT_LABEL) + sum(
            c for (k, t, label, above), c in seen.items()
            if k == "edge" and t in (tag or t, ) and label == y and not above
        ) for y in (False, True)]
        return math.log(n[0] / sum(n)), math.log(n[1] / sum(n))

    child = {tag: (begins(tag), as_parent) for tag in tags}
    # Parts with a tag of their own stand in an article without being of it.
    child |= {tag: (begins(tag), as_parent[::-1]) for tag in AROUND_TAGS}
    return TreeModel(
        _odds(seen, "shown", priors, lambda name: (AMOUNT_WEIGHT, 2.0) if name[0] == "l" else (1.0, 8.0)),
        _odds(seen, "amount", Counter(), lambda _: (AMOUNT_WEIGHT, 2.0)),
        0.0,
        child,
    )


def count_labels(page: Page, labels: list[bool]) -> Counter:
    seen: Counter = Counter()
    for node, (shown, amounts) in enumerate(features(page)):
        label = labels[node]
        above = labels[page.parent[node]] if node else False
        seen["shown nodes", "", label, False] += 1
        for name in shown:
            seen["shown", name, label, False] += 1
        if not above:
            seen["amount nodes", "", label, False] += 1
            for name in amounts:
                seen["amount", name, label, False] += 1
        if node:
            seen["edge", page.tag[node], label, above] += 1
    return seen


def learn_pages(pages: DataFrame) -> TreeModel:
    """The model counted on the labelled ones of the pages, about LABELLED_PAGES of them at most."""

    def counted(batches):
        seen: Counter = Counter()
        for batch in batches_of(batches, text="html"):
            for source in batch.column("html").to_pylist():
                page = parse(source)
                labels = given_labels(page)
                if labels:
                    seen += count_labels(page, labels)
        rows = [(*key, n) for key, n in seen.items()]
        kinds = [pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.int64()]
        names = ["kind", "name", "label", "above", "n"]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names
        )

    total = pages.count()
    share = min(1.0, LABELLED_PAGES / max(1, total))
    drawn = F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) < share * (1 << 30)
    rows = (
        pages.where(drawn & F.col("html").isNotNull())
        .select("html")
        .mapInArrow(counted, "kind string, name string, label boolean, above boolean, n long")
        .groupBy("kind", "name", "label", "above")
        .agg(F.sum("n").alias("n"))
        .where(~F.col("kind").isin("shown", "amount") | (F.col("n") >= LEAST_SEEN))
        .collect()
    )
    return make_model(Counter({tuple(r)[:4]: r["n"] for r in rows}))


def extract(source: str | None, model: TreeModel) -> str:
    if not source:
        return ""
    page = parse(source)
    if len(page.tag) == 1:  # plain text
        return "\n\n".join(text for _, text in page.blocks)
    good = model.marginals(page)
    if not any(good[node] > 0.5 for node, _ in page.blocks):
        good = model.marginals(page, whole=True)
    return "\n\n".join(text for node, text in page.blocks if good[node] > 0.5)


def html_texts(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    Blocks are separated by an empty line, white space in a block is one space. A null, empty or
    text-free html gives an empty text; html that is plain text is one block of the root. Repeated
    rows are answered each, other columns of ``pages`` take no part. Without a model one is learned
    on ``pages``. A map over the rows with a model whose size is bounded by the labelled pages.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or learn_pages(pages))

    def extracted(batches):
        for batch in batches_of(batches, text="html"):
            texts = [extract(x, shared.value) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        extracted, "page_id long, url string, text string, n_chars long"
    )

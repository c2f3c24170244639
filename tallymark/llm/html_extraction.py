"""Main-content extraction with a tree-structured graphical model over DOM nodes.

Every block element is a node with a binary state (content or not). Unary potentials come from a
logistic model of the node's tag, names, links and text; each edge has a parent-child potential,
by kind of child. Both are trained on labelled pages. Sum-product messages run upward (children to
parent), then downward, and give each node's exact content marginal; a node's own text is kept if that is over 1/2.

Defined cases: a null or empty page gives the empty text; whatever stands in head, script, style and
the like is no text; unclosed and crossing tags are mended as they come; a comment, tag or raw element that never ends takes the
rest of the page, a quote that never ends is taken as ended by the next >, and any other opaque element without an end holds nothing; repeated
rows give a row each; very long pages are read whole, in time that grows with their length, well-formed or not;
other columns may have any name and are carried only if asked for.
"""

from __future__ import annotations

import functools
import html as entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from . import html_pages

#: A tag as far as it goes: quotes count only after an equals sign. Possessive, so that a failed match is not tried again.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+)""")
COMMENT_END = re.compile(r"--!?>")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
#: Fixed sets of element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OPAQUE = frozenset("script style title textarea noscript template iframe svg math select button head object canvas audio video noframes xmp".split())
RAW = frozenset("script style title textarea iframe xmp noframes".split())
#: Elements that a slash closes.
FOREIGN = frozenset("svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
FENCES = frozenset("ul ol dl table tbody thead tfoot tr".split())
CONTROLS = frozenset("input select textarea button label".split())
ASIDE = frozenset("nav header footer aside form ins menu".split())
NAMED = ("nav", "header", "footer", "aside", "form", "article", "main", "section", "p", "h1", "h2", "h3", "h4", "li", "ul", "ol", "td", "tr", "table", "div", "blockquote", "pre", "figure", "figcaption", "body", "html", "ins", "fieldset")
WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
KIND_OF_NAME = {w: kind for kind, names in html_pages.CLASSES.items() if kind != "plain" for name in names for w in name.split("-")}
for _w in ("site", "box", "top", "body", "bar", "list", "main", "text", "bottom", "posts", "banner", "post", "reader", "form"):
    KIND_OF_NAME.pop(_w, None)
KIND_OF_NAME |= {"post": "content", "body": "content", "text": "content", "main": "content", "banner": "advert", "hidden": "notice", "complementary": "sidebar", "navigation": "menu", "contentinfo": "footer"}
KINDS = tuple(sorted(set(KIND_OF_NAME.values())))
RAW_END = {t: re.compile(rf"</{t}[\s/>]", re.I) for t in RAW}
FEATURES = tuple(f"tag {t}" for t in NAMED) + tuple(f"name {k}" for k in KINDS) + tuple(f"above {k}" for k in KINDS) + ("other tag", "bias", "links some", "links most", "no text", "short", "long", "controls", "mark ©", "holds paragraphs", "direct paragraphs", "own text", "plain page", "leaf")
INDEX = {f: i for i, f in enumerate(FEATURES)}


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    names: str
    label: int = 0
    controls: int = 0
    text: list = field(default_factory=list)
    size: int = 0
    linked: int = 0
    paragraphs: int = 0
    direct: int = 0
    children: int = 0


def tokens(page: str) -> list:
    """Texts (str) and tags (closing, name, attributes) in page order; raw elements are start tags alone. Linear in the page: whatever fails to match is passed over whole."""
    out: list = []
    at, n = 0, len(page)
    while at < n:
        here = page.find("<", at)
        if here < 0:
            out.append(page[at:])
            break
        if here > at:
            out.append(page[at:here])
        m = TAG.match(page, here)
        if m:
            at = m.end()
            if at < n and page[at] != ">":  # an equals sign before a quote that never ends
                at = page.find(">", at)
            if not 0 <= at < n:
                break
            name = m[2].lower()
            out.append((bool(m[1]), name, page[m.start(3) : at]))
            at += 1
            if name in RAW and not m[1]:
                end = RAW_END[name].search(page, at)
                close = page.find(">", end.end() - 1) if end else -1
                at = close + 1 if close >= 0 else n
        elif page.startswith("<!--", here):
            if page.startswith((">", "->"), here + 4):
                at = page.index(">", here) + 1
            else:
                end = COMMENT_END.search(page, here + 4)
                at = end.end() if end else n
        elif page.startswith(("<!", "<?", "</"), here) and here + 2 < n:
            close = page.find(">", here)
            at = close + 1 if close >= 0 else n
        else:
            out.append("<")
            at = here + 1
    return out


class Stack:
    """Open elements, with the depths of each name and of all blocks at hand, so that no end tag searches."""

    def __init__(self) -> None:
        self.open: list[tuple[str, int, bool]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, name: str, value: int, block: bool) -> None:
        self.places.setdefault(name, []).append(len(self.open))
        if block:
            self.blocks.append(len(self.open))
        self.open.append((name, value, block))

    def pop(self) -> tuple[str, int, bool]:
        out = self.open.pop()
        self.places[out[0]].pop()
        if out[2]:
            self.blocks.pop()
        return out

    def depth(self, name: str) -> int:
        """The depth of the latest open element of that name, or -1."""
        held = self.places.get(name)
        return held[-1] if held else -1

    def ended_by(self, name: str) -> int:
        """The depth of what an end tag ends, or -1: an inline end tag does not reach over a block."""
        d = self.depth(name)
        return d if d >= 0 and (self.open[d][2] or not self.blocks or self.blocks[-1] < d) else -1


def opaque_ends(parts: list) -> dict[int, int]:
    """For each opaque element with an end tag of its own, before an element around it ends: the places of its tags."""
    out, stack = {}, Stack()
    for i, part in enumerate(parts):
        if type(part) is str:
            continue
        closing, name, attributes = part
        if closing:
            d = stack.ended_by(name)
            if d >= 0:
                if name in OPAQUE:
                    out[stack.open[d][1]] = i
                while len(stack.open) > d:
                    stack.pop()
        elif name not in VOID and name not in RAW and not (name in FOREIGN and attributes.endswith("/")):
            stack.push(name, i, name not in INLINE)
    return out


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block nodes in document order (parents first), and the text blocks in page order with their nodes."""
    parts = tokens(page)
    ends = opaque_ends(parts)
    nodes, stack = [Node("html", -1, "")], Stack()
    stack.push("html", 0, True)
    blocks: list[tuple[int, str]] = []
    held: list[str] = []
    links = 0

    def flush() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                at = stack.open[-1][1]
                blocks.append((at, text))
                nodes[at].size += len(text)

    def leave(depth: int) -> None:
        nonlocal links
        while len(stack.open) > depth:
            tag, _, block = stack.open[-1]
            if block:
                flush()
            elif tag == "a":
                links -= 1
            stack.pop()

    skip = -1
    for i, part in enumerate(parts):
        if i <= skip:
            continue
        if type(part) is str:
            held.append(part)
            if links and not part.isspace():
                nodes[stack.open[-1][1]].linked += len(part)
            continue
        closing, tag, attributes = part
        if closing:
            d = stack.ended_by(tag)
            if d > 0:
                leave(d)
            elif tag == "br":
                held.append(" ")
            elif tag == "p":  # an empty paragraph
                flush()
            continue
        if tag in OPAQUE:
            if tag in CONTROLS:
                nodes[stack.open[-1][1]].controls += 1
            skip = ends.get(i, -1)
            if tag != "noscript":
                held.append(" ")
            continue
        if tag == "html":
            nodes[0].label = int('data-y="1"' in attributes)
            continue
        if tag in VOID:
            if tag == "br" or tag == "hr":
                held.append(" ")
            if tag in CONTROLS:
                nodes[stack.open[-1][1]].controls += 1
            if tag == "hr":
                flush()
            continue
        if tag in INLINE and not (tag == "ins" and attributes.strip()):
            links += tag == "a"
            stack.push(tag, stack.open[-1][1], False)
            continue
        closes = SIBLINGS.get(tag, ())
        if closes:
            fence = max(stack.depth(t) for t in FENCES if t not in closes)
            while (d := max(map(stack.depth, closes))) > fence:
                leave(d)
        if tag in CLOSES_P and (d := stack.depth("p")) > 0 and stack.blocks[-1] == d:
            leave(d)
        flush()
        given = {a.lower(): b or c or d for a, b, c, d in reversed(ATTRIBUTE.findall(attributes))} if attributes else {}
        names = " ".join(given.get(k, "") for k in ("class", "id", "role")) + (" hidden" if "hidden" in given or given.get("aria-hidden") == "true" else "")
        parent = stack.open[-1][1]
        nodes[parent].children += 1
        nodes[parent].direct += tag == "p"
        nodes.append(Node(tag, parent, names, int(given.get("data-y") == "1")))
        stack.push(tag, len(nodes) - 1, True)
    leave(1)
    flush()
    return nodes, blocks


def features(nodes: list[Node], blocks: list[tuple[int, str]]) -> list[list[int]]:
    """The features that hold for each node."""
    total, linked, paragraphs, controls = ([getattr(x, k) for x in nodes] for k in ("size", "linked", "paragraphs", "controls"))
    marked = [False] * len(nodes)
    for i, text in blocks:
        marked[i] |= text[:3] in ("©", "(c)") or text[0] == "©"
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        total[p] += total[i]
        linked[p] += linked[i]
        controls[p] += controls[i]
        paragraphs[p] += paragraphs[i] + (nodes[i].tag == "p")
    out, above = [], []
    # nothing on the page is linked, named as anything but content, or of an element made for something else
    plain = not linked[0] and not controls[0] and not any(x.tag in ASIDE or (x.names and any(KIND_OF_NAME.get(w, "content") != "content" for w in WORDS.findall(x.names))) for x in nodes)
    for i, x in enumerate(nodes):
        own = {KIND_OF_NAME[w] for w in WORDS.findall(x.names) if w in KIND_OF_NAME} if x.names else set()
        inherited = above[x.parent] if x.parent >= 0 else frozenset()
        above.append(inherited | own)
        f = [INDEX["bias"], INDEX.get(f"tag {x.tag}", INDEX["other tag"])]
        f += [INDEX[f"name {k}"] for k in own] + [INDEX[f"above {k}"] for k in inherited]
        share = linked[i] / total[i] if total[i] else 0
        if share > 0.2:
            f.append(INDEX["links most" if share > 0.6 else "links some"])
        f.append(INDEX["no text" if not total[i] else "short" if total[i] < 60 else "long" if total[i] > 250 else "bias"])
        if controls[i]:
            f.append(INDEX["controls"])
        if marked[i]:
            f.append(INDEX["mark ©"])
        if paragraphs[i] > 1:
            f.append(INDEX["holds paragraphs"])
        if x.direct > 1:
            f.append(INDEX["direct paragraphs"])
        if x.size > 80:
            f.append(INDEX["own text"])
        if plain:
            f.append(INDEX["plain page"])
        if not x.children:
            f.append(INDEX["leaf"])
        out.append(f)
    return out


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]  # of the log odds of content, the prior taken out
    edges: dict[str, tuple[tuple[float, float], tuple[float, float]]]  # kind of child -> P(child | parent)
    root: tuple[float, float]


def edge_kind(tag: str) -> str:
    return tag if tag in ("p", "li", "div", "section", "article", "main", "aside", "nav", "form", "header", "footer", "ul", "h1", "td") else "other"


def train(pages: list[str], rounds: int = 250, rate: float = 1.5) -> Model:
    rows, labels, counts, root = [], [], {}, [1.0, 1.0]
    for page in pages:
        nodes, blocks = parse(page)
        rows += features(nodes, blocks)
        labels += [x.label for x in nodes]
        for x in nodes[1:]:
            for kind in (edge_kind(x.tag), "any"):
                counts.setdefault(kind, [[1.0, 1.0], [1.0, 1.0]])[nodes[x.parent].label][x.label] += 1
        root[nodes[0].label] += 1
    x, y = np.zeros((len(rows), len(FEATURES))), np.array(labels, float)
    for i, f in enumerate(rows):
        x[i, f] = 1
    w, m, v = np.zeros(len(FEATURES)), np.zeros(len(FEATURES)), np.zeros(len(FEATURES))
    for t in range(1, rounds + 1):
        g = x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    w[INDEX["bias"]] -= math.log(y.mean() / (1 - y.mean()))
    share = {k: tuple((a / (a + b), b / (a + b)) for a, b in c) for k, c in counts.items()}
    return Model(tuple(w), share, (root[0] / sum(root), root[1] / sum(root)))


@functools.cache
def default_model() -> Model:
    return train(html_pages.labelled_pages())


def marginals(model: Model, nodes: list[Node], rows: list[list[int]]) -> list[float]:
    """P(content) of each node: one upward and one downward sweep of messages."""
    n = len(nodes)
    unary = []
    for f in rows:
        z = max(-30.0, min(30.0, sum(model.weights[i] for i in f)))
        unary.append((1 / (1 + math.exp(z)), 1 / (1 + math.exp(-z))))
    psi = [model.edges.get(edge_kind(x.tag), model.edges["any"]) for x in nodes]
    belief = list(unary)  # unary times the messages of the children
    up = [(1.0, 1.0)] * n
    for i in range(n - 1, 0, -1):
        (a00, a01), (a10, a11) = psi[i]
        b0, b1 = belief[i]
        m0, m1 = a00 * b0 + a01 * b1, a10 * b0 + a11 * b1
        s = m0 + m1
        up[i] = m0, m1 = m0 / s, m1 / s
        p = nodes[i].parent
        c0, c1 = belief[p]
        c0, c1 = c0 * m0, c1 * m1
        s = c0 + c1
        belief[p] = (c0 / s, c1 / s)
    out = [0.0] * n
    full: list[tuple[float, float]] = [(0.0, 0.0)] * n
    b0, b1 = belief[0][0] * model.root[0], belief[0][1] * model.root[1]
    full[0] = (b0 / (b0 + b1), b1 / (b0 + b1))
    out[0] = full[0][1]
    for i in range(1, n):
        (a00, a01), (a10, a11) = psi[i]
        p0, p1 = full[nodes[i].parent]
        q0, q1 = p0 / up[i][0], p1 / up[i][1]
        d0, d1 = (a00 * q0 + a10 * q1) * belief[i][0], (a01 * q0 + a11 * q1) * belief[i][1]
        s = d0 + d1
        full[i] = (d0 / s, d1 / s)
        out[i] = full[i][1]
    return out


def main_text(page: str | None, model: Model) -> tuple[str, float]:
    """The text, and the mean confidence in the states of the nodes that own text."""
    if not page:
        return "", 1.0
    nodes, blocks = parse(page)
    if not blocks:
        return "", 1.0
    p = marginals(model, nodes, features(nodes, blocks))
    return "\n\n".join(t for i, t in blocks if p[i] > 0.5), sum(max(p[i], 1 - p[i]) for i, _ in blocks) / len(blocks)


def extract(pages: DataFrame, keep: list[str], model: Model | None = None) -> DataFrame:
    """The columns of ``keep``, text, n_chars, confidence for each page; reads the column ``html``."""
    shared = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                batch = whole.slice(i, 500)
                found = [main_text(page, shared.value) for page in batch.column("_html").to_pylist()]
                texts = [t for t, _ in found]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([c for _, c in found], pa.float64())], names=[*keep, "text", "n_chars", "confidence"])

    chosen = pages.selectExpr(*(f"`{c}`" for c in keep), "html AS _html")
    schema = StructType([chosen.schema[c] for c in keep] + [StructField("text", StringType()), StructField("n_chars", LongType()), StructField("confidence", DoubleType())])
    return chosen.mapInArrow(run, schema)

"""Main-text extraction with a tree-structured graphical model over the DOM.

Every block element with text, and every run of text between block boundaries, is a node that is either content or
not. A node has a potential from its tag, its class and id, and the amount, links and place of its text; a parent and
child have one for each pair of states. Sum-product messages go up the tree once and down once, which gives the exact
marginal of every node; text whose marginal for content is at least one half is the page's main text. Potentials are
trained by the likelihood of labelled pages, whose gradient the same messages give.
"""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.htmlpages import training_pages

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math mfrac mi mn mo mrow msqrt msub msubsup msup mtext mover munder q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style title template iframe object svg canvas audio video head select textarea annotation annotation-xml".split())
#: What a start tag closes if it is open nearer than the tags after it.
CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
TOKEN = re.compile(r"[a-z]+|[0-9]+")
EPOCHS, RATE, L2 = 6, 0.15, 1e-4


class Tree(HTMLParser):
    """Block elements and runs of text in page order; a parent always comes before its children."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.name, self.text = [-1], ["#root"], [""], [None]
        self.linked, self.truth, self.mark = [0], [None], [False]
        self.stack: list[tuple[str, int]] = [("#root", 0)]
        self.depths: dict[str, list[int]] = defaultdict(list)  # places in the stack of each open tag, so that no search walks it
        self.run: list[str] = []
        self.run_linked = self.hidden = self.links = 0

    def flush(self):
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                self.parent.append(self.stack[-1][1])
                self.tag.append("#text")
                self.name.append("")
                self.text.append(text)
                self.linked.append(self.run_linked)
                self.truth.append(self.mark[-1])
            self.run = []
        self.run_linked = 0

    def close_to(self, depth: int):
        """Pop all open elements from this depth of the stack on."""
        for tag, _ in self.stack[depth:]:
            self.depths[tag].pop()
            if tag in HIDDEN:
                self.hidden -= 1
            elif tag == "a":
                self.links -= 1
        del self.stack[depth:]

    def open(self, tag: str, node: int):
        self.depths[tag].append(len(self.stack))
        self.stack.append((tag, node))

    def nearest(self, tags: tuple[str, ...]) -> int:
        """Place of the innermost open one of these tags; 0 if none is open."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def handle_starttag(self, tag, attrs):
        if tag in ("x-on", "x-off"):
            self.flush()
            self.mark.append(tag == "x-on")
            return
        if tag in INLINE:
            if tag == "br":
                self.run.append(" ")
            elif tag == "a":
                self.links += 1
                self.open(tag, self.stack[-1][1])
            return
        if tag not in HIDDEN or tag == "head":
            self.flush()
            what, until = CLOSES.get(tag, (("p",), ("table", "button", "object")))
            while (depth := self.nearest(what)) > self.nearest(until):
                self.close_to(depth)
                if tag not in ("tr", "td", "th"):
                    break
        if tag == "body" and self.depths["head"]:  # a head left open ends here
            self.close_to(self.depths["head"][0])
        if tag in VOID:
            return
        if tag in HIDDEN:
            self.hidden += 1
            self.open(tag, self.stack[-1][1])
            return
        self.parent.append(self.stack[-1][1])
        self.tag.append(tag)
        self.name.append(" ".join(v for k, v in attrs if v and k in ("class", "id", "role")).lower())
        self.text.append(None)
        self.linked.append(0)
        self.truth.append(None)
        self.open(tag, len(self.parent) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in HIDDEN:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in ("x-on", "x-off"):
            self.flush()
            if len(self.mark) > 1:
                self.mark.pop()
            return
        if tag in INLINE and tag != "a":
            return
        if self.depths.get(tag):
            if tag != "a":
                self.flush()
            self.close_to(self.depths[tag][-1])

    def handle_data(self, data):
        if not self.hidden:
            self.run.append(data)
            if self.links:
                self.run_linked += len(data)


def parse(html: str) -> Tree:
    tree = Tree()
    tree.feed(html)
    tree.close()
    tree.flush()
    return tree


@lru_cache(maxsize=50_000)
def name_features(tag: str, name: str) -> tuple[str, ...]:
    """The tag and the words of class, id and role."""
    return (f"tag {tag}", *sorted({f"name {w}" for w in TOKEN.findall(name)})) if name else (f"tag {tag}", "no name")


class Page:
    """The nodes that hold text, with totals of their subtrees."""

    def __init__(self, tree: Tree):
        n = len(tree.parent)
        chars, linked, content = [0] * n, [0] * n, [0] * n
        for i in range(n - 1, -1, -1):
            if tree.text[i] is not None:
                chars[i], linked[i] = len(tree.text[i]), min(tree.linked[i], len(tree.text[i]))
                content[i] = chars[i] if tree.truth[i] else 0
            if i and chars[i]:
                p = tree.parent[i]
                chars[p] += chars[i]
                linked[p] += linked[i]
                content[p] += content[i]
        keep = [i for i in range(n) if chars[i]]
        at = {i: k for k, i in enumerate(keep)}
        self.parent = [at.get(tree.parent[i], -1) for i in keep]
        self.text = [tree.text[i] for i in keep]
        self.truth = [2 * content[i] >= chars[i] for i in keep]
        total = max(1, chars[0])
        self.named, self.shape = [], []
        depth, before = [0] * len(keep), 0
        for k, i in enumerate(keep):
            p = self.parent[k]
            depth[k] = depth[p] + 1 if p >= 0 else 0
            leaf = self.text[k] is not None
            # a run of text goes by the element that it is in
            tag, name = (tree.tag[tree.parent[i]], tree.name[tree.parent[i]]) if leaf else (tree.tag[i], tree.name[i])
            self.named.append((("in " if leaf else "") + tag, name))
            kind = "t" if leaf else "e"
            self.shape.append((
                f"{kind} size {chars[i].bit_length()}", f"{kind} links {5 * linked[i] // chars[i]}", f"{kind} share {4 * chars[i] // total}",
                f"{kind} depth {min(depth[k], 8)}", f"{kind} place {4 * before // total}", f"{kind} leads" if p >= 0 and chars[keep[p]] < 2 * chars[i] else f"{kind} part",
            ))
            if leaf:
                before += chars[i]


class Model:
    """Weights of features for content, and of parent-child state pairs: for text and for elements."""

    def __init__(self):
        self.w: dict[str, float] = defaultdict(float)
        self.pair = {kind: [[0.5, -0.5], [-0.5, 0.5]] for kind in ("t", "e")}
        self._named: dict = {}

    def freeze(self) -> Model:
        self.w = dict(self.w)
        return self

    def unary(self, page: Page) -> list[float]:
        w, out = self.w, []
        for named, shape in zip(page.named, page.shape):
            own = self._named.get(named)
            if own is None:
                own = sum(w.get(f, 0.0) for f in name_features(*named))
                if len(self._named) < 50_000:
                    self._named[named] = own
            for f in shape:
                own += w.get(f, 0.0)
            out.append(max(-30.0, min(30.0, own)))
        return out

    def marginals(self, page: Page) -> tuple[list[float], list]:
        """P(content) of every node, and of every node with a parent the joint table of (parent, own) state."""
        n = len(page.parent)
        up = [[1.0, math.exp(u)] for u in self.unary(page)]  # own potential times messages from children
        tables = {k: [[math.exp(v) for v in row] for row in t] for k, t in self.pair.items()}
        table = [tables["t" if t is not None else "e"] for t in page.text]
        message = [(1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):
            (a, b), t = up[i], table[i]
            m0, m1 = t[0][0] * a + t[0][1] * b, t[1][0] * a + t[1][1] * b
            s = m0 + m1
            message[i] = (m0 / s, m1 / s)
            p = up[page.parent[i]]
            p[0] *= message[i][0]
            p[1] *= message[i][1]
            s = p[0] + p[1]
            p[0] /= s
            p[1] /= s
        belief, joint = [0.0] * n, [None] * n
        state = [(0.0, 0.0)] * n
        for i in range(n):
            p = page.parent[i]
            if p < 0:
                a, b = up[i]
            else:
                # the parent's belief without what this child told it
                q0, q1 = state[p][0] / max(message[i][0], 1e-300), state[p][1] / max(message[i][1], 1e-300)
                t, (a, b) = table[i], up[i]
                j = (q0 * t[0][0] * a, q0 * t[0][1] * b, q1 * t[1][0] * a, q1 * t[1][1] * b)
                s = sum(j) or 1.0
                joint[i] = tuple(x / s for x in j)
                a, b = j[0] + j[2], j[1] + j[3]
            s = (a + b) or 1.0
            state[i] = (a / s, b / s)
            belief[i] = b / s
        return belief, joint


def train(pages: list[Page], epochs: int = EPOCHS) -> Model:
    """Stochastic gradient steps on the log-likelihood of the pages' states."""
    model, order = Model(), random.Random(7)
    seen: dict[str, float] = defaultdict(lambda: 1.0)
    for _ in range(epochs):
        for page in order.sample(pages, len(pages)):
            model._named.clear()
            belief, joint = model.marginals(page)
            for i, truth in enumerate(page.truth):
                g = float(truth) - belief[i]
                for f in (*name_features(*page.named[i]), *page.shape[i]):
                    seen[f] += g * g
                    model.w[f] += RATE * (g - L2 * model.w[f]) / math.sqrt(seen[f])
                if joint[i]:
                    table = model.pair["t" if page.text[i] is not None else "e"]
                    p = int(page.truth[page.parent[i]])
                    for a in (0, 1):
                        for b in (0, 1):
                            table[a][b] += 0.003 * (float(a == p and b == int(truth)) - joint[i][2 * a + b])
    model._named.clear()
    return model.freeze()


@lru_cache(maxsize=1)
def default_model() -> Model:
    return train([Page(parse(html)) for html in training_pages()])


def main_text(html: str | None, model: Model) -> str:
    page = Page(parse(html or ""))
    if not page.parent:
        return ""
    belief, _ = model.marginals(page)
    return "\n".join(t for t, b in zip(page.text, belief) if t is not None and b >= 0.5)


def extract(pages: DataFrame, html: str = "html", model: Model | None = None) -> DataFrame:
    """pages with text, the main text, and n_chars, its code points.

    Blocks come in page order, one to a line, with white space (also between inline elements and at <br>) as single
    spaces. Null, empty or textless HTML gives an empty text and 0. Broken markup is read as far as it goes; nothing
    is capped. Columns of pages named text or n_chars are replaced; others stay. Repeated rows give equal texts.
    """
    shipped = pages.sparkSession.sparkContext.broadcast(model or default_model())

    @F.pandas_udf("string")
    def texts(htmls: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, shipped.value) for h in htmls], dtype=object)

    keep = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("text", "n_chars")]
    out = pages.select(*keep, texts(F.col(html)).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))

"""Main text of web pages by a graphical model over the document tree.

Every block element is a binary variable: main text or not. It has a potential of its
own from what can be seen of it (tag, names in class, id and role, length, links,
punctuation, share of the page's text, length of its blocks against its neighbours')
and shares one with its parent. Sum-product messages go from the leaves
to the root and back, which is exact on a tree, and leave each element's marginal; the
text of elements that are more likely main text than not is joined in page order. The
potentials are the maximum-likelihood ones on labelled pages, whose gradient the same
messages give.

Defined results: null and empty pages and pages without main text give an empty text;
tags that are left open end with their parent, unknown and stray ones are passed over;
text after an unfinished tag is lost with it, as in a browser, and after a quote that
never ends quotes do not count; repeated rows and ties are handled row by row (a marginal
of exactly one half is not main text); an empty table gives an empty result, and kept
columns named like a new one give way to it. Pages are read whole, in time and memory in
proportion to their length whatever they hold.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spintally.llm.pages import labelled_pages
from spintally.llm.ragged import Memo
from spintally.llm.rows import map_texts

TAG = re.compile(
    r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<!--.*?(?:--!?>|\Z)|<[!?/][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>""",
    re.DOTALL,
)
#: The same where a quote has turned out to have no end, from which on quotes do not count.
UNQUOTED = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>", re.DOTALL
)
ATTRIBUTE = re.compile(
    r"""(?<![A-Za-z-])([A-Za-z-]++)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
RAW = set("script style".split())
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SAME_LEVEL = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
STOPS = {"li": {"ul", "ol", "menu"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}

#: Elements that are part of a text rather than a section of the page.
TEXT_PARTS = set("p ul ol li dl dt dd table tbody tr td th h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption".split())

#: Of these, the ones of which a long text has many, so that each has a small share of it.
PASSAGES = set("p li dt dd tr h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption".split())

TAGS = set(
    "html head title body nav header footer aside article main section div p ul ol li dl dt dd table "
    "tbody tr td th h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption form label button fieldset "
    "select option textarea noscript iframe address details summary".split()
)
CUES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar tabs toc",
    "header": "header masthead banner logo top",
    "footer": "footer foot contentinfo copyright legal bottom",
    "side": "sidebar side aside complementary widget related recommended trending",
    "ad": "ad ads advert advertisement advertising adsense sponsor sponsored promo promoted promotion",
    "notice": "cookie cookies consent notice notices alert gdpr popup modal dialog overlay warning",
    "form": "form search login signup subscribe subscription newsletter",
    "comment": "comment comments commentlist respond reply replies disqus discussion",
    "share": "share sharing social follow tags pagination pager",
    "main": "article main content post entry story body text",
}
CUE_OF = {name: cue for cue, names in CUES.items() for name in names.split()}


@dataclass
class Tree:
    """Block elements in page order, each with its parent; runs of text with their element."""

    tags: list[str]
    parents: list[int]
    attributes: list[str]
    #: (element, text, inside a link); element -1 parts two blocks.
    runs: list[tuple[int, str, bool]]


class Open:
    """Elements that are open, inline ones too, with the places of each tag among them."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = [("#root", 0)]  # inline tags with their block's element
        self.at: dict[str, list[int]] = {}
        self.blocks = [0]
        self.links = 0

    def element(self) -> int:
        return self.stack[-1][1]

    def last(self, tags) -> int:
        """Place of the innermost open element with one of the tags; 0 if there is none."""
        return max((self.at[tag][-1] for tag in tags if self.at.get(tag)), default=0)

    def push(self, tag: str, element: int, inline: bool) -> None:
        self.at.setdefault(tag, []).append(len(self.stack))
        if not inline:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, element))
        self.links += tag == "a"

    def close(self, place: int) -> None:
        """End the element at ``place`` and all inside it."""
        for tag, _ in self.stack[place:]:
            self.at[tag].pop()
            self.links -= tag == "a"
        del self.stack[place:]
        while self.blocks[-1] >= place:
            self.blocks.pop()


def parse(page: str) -> Tree:
    """The tree of a page in time proportional to its length."""
    tree = Tree(["#root"], [-1], [""], [])
    held = Open()
    at, end, last_close = 0, len(page), page.rfind(">")
    tags = TAG

    def text(begin: int, stop: int) -> None:
        if stop > begin:
            tree.runs.append((held.element(), page[begin:stop], held.links > 0))

    while at < end:
        match = tags.search(page, at) if at <= last_close else None
        if not match:
            cut = re.compile(r"<[A-Za-z/!?]").search(page, at)  # an unfinished tag or comment
            text(at, cut.start() if cut else end)
            break
        if tags is TAG and match[5]:
            tags = UNQUOTED
        text(at, match.start())
        at = match.end()
        groups = match.groups()
        closing, tag, attributes = groups[:3] if groups[1] else groups[-3:]
        if not tag:
            continue  # a comment or declaration
        tag, attributes = tag.lower(), attributes or ""
        if tag in INLINE and tag not in VOID:
            if closing:
                place = held.last((tag,))
                if place > held.blocks[-1]:
                    held.close(place)
            elif not attributes.endswith("/"):
                held.push(tag, held.element(), inline=True)
            continue
        tree.runs.append((-1, "", False))
        if tag in VOID:
            continue
        if closing:
            place = held.last((tag,))
            if place:
                held.close(place)
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag in SAME_LEVEL:
            place = held.last(SAME_LEVEL[tag])
            if place > held.last(STOPS.get(tag, ())):
                held.close(place)
        elif tag in CLOSES_P and held.stack[held.blocks[-1]][0] == "p":
            held.close(held.blocks[-1])
        tree.tags.append(tag)
        tree.parents.append(held.element())
        tree.attributes.append(attributes)
        held.push(tag, len(tree.tags) - 1, inline=False)
    return tree


def cues(attributes: str) -> set[str]:
    out = set()
    for name, value in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for part in NAME.findall(value):
                if part.lower() in CUE_OF:
                    out.add(CUE_OF[part.lower()])
    return out


def level(value: float, cuts: tuple[float, ...]) -> int:
    """How many of the cuts ``value`` exceeds."""
    return sum(value > cut for cut in cuts)


def features(tree: Tree) -> list[tuple[str, ...]]:
    """What the potential of each element depends on."""
    n = len(tree.tags)
    own, linked, whole, all_linked = [0] * n, [0] * n, [0] * n, [0] * n
    last, legal = [""] * n, [False] * n
    for element, text, link in tree.runs:
        if element >= 0:
            size = len(text.strip())
            if size:
                own[element] += size
                linked[element] += size * link
                last[element] = text
                if "&copy" in text or "©" in text:
                    legal[element] = True
    for i in range(n - 1, -1, -1):
        whole[i] += own[i]
        all_linked[i] += linked[i]
        if i:
            whole[tree.parents[i]] += whole[i]
            all_linked[tree.parents[i]] += all_linked[i]
    plain = [a - b for a, b in zip(whole, all_linked)]  # text that is no link
    blocks = [int(size > 0) for size in own]  # elements with text of their own
    direct = [a - b for a, b in zip(own, linked)]  # plain text right in it or in its passages
    for i in range(n - 1, 0, -1):
        blocks[tree.parents[i]] += blocks[i]
        if tree.tags[i] in PASSAGES:
            direct[tree.parents[i]] += plain[i]
    out = []
    for i, tag in enumerate(tree.tags):
        found = [f"tag {tag}" if tag in TAGS else "tag other"]
        if plain[0] and tag not in PASSAGES:
            # share of the page's unlinked text, and length of its blocks against the parent's
            found.append(f"share {level(plain[i] / plain[0], (0, 0.1, 0.35, 0.7))}")
            if plain[i]:
                found.append(f"direct {level(direct[i] / plain[i], (0, 0.3, 0.8))}")
                if tag == "body":  # a box of sections, or the article itself
                    found.append(f"body {level(direct[i] / plain[i], (0, 0.3, 0.8))}")
            if i and whole[i] and whole[tree.parents[i]] > whole[i]:
                mean = whole[tree.parents[i]] / blocks[tree.parents[i]]
                found.append(f"density {level(whole[i] / blocks[i] / mean, (0.4, 0.8, 1.3))}")
        if tree.attributes[i]:
            found += [f"cue {cue}" for cue in sorted(cues(tree.attributes[i]))]
        found.append(f"whole {level(whole[i], (0, 30, 120, 600))}")
        if whole[i]:
            found.append(f"links {level(all_linked[i] / whole[i], (0.1, 0.5, 0.9))}")
            if all_linked[i] > 0.5 * whole[i]:
                found.append(f"linked {tag}")
        if own[i]:
            found.append(f"own {level(own[i], (25, 100, 300))}")
            found.append("ends" if last[i].rstrip()[-1:] in ".!?:;\"”»" else "open")
            if legal[i]:
                found.append("legal")
        out.append(tuple(found))
    return out


@dataclass(frozen=True)
class Model:
    #: Log-odds of main text by feature.
    unary: dict[str, float]
    #: For parts of a text and for sections: log-potential of (parent, child) being (0, 1),
    #: (1, 0) and (1, 1), against (0, 0).
    pair: tuple[tuple[float, float, float], tuple[float, float, float]]


def message(odds: float, from_zero: float, from_one: float, both: float) -> float:
    """Log-odds that a neighbour with log-odds ``odds`` sends over a shared potential.

    ``from_zero`` weighs (receiver 0, sender 1), ``from_one`` (1, 0), ``both`` (1, 1).
    """
    high = max(0.0, odds)
    e0, e1 = exp(-high), exp(odds - high)
    return log((e0 * exp(from_one) + e1 * exp(both)) / (e0 + e1 * exp(from_zero)))


def sections(tree: Tree) -> list[int]:
    """Which of the two shared potentials ties each element to its parent."""
    return [int(tag not in TEXT_PARTS) for tag in tree.tags]


def beliefs(parents: list[int], kinds: list[int], unary: list[float], pair):
    """Three log-odds of each element: its own, without its parent, and its parent's without it."""
    up = list(unary)
    sent = [0.0] * len(parents)
    for i in range(len(parents) - 1, 0, -1):
        child_only, parent_only, both = pair[kinds[i]]
        sent[i] = message(up[i], child_only, parent_only, both)
        up[parents[i]] += sent[i]
    whole, above = list(up), [0.0] * len(parents)
    for i in range(1, len(parents)):
        child_only, parent_only, both = pair[kinds[i]]
        above[i] = whole[parents[i]] - sent[i]
        whole[i] = up[i] + message(above[i], parent_only, child_only, both)
    return whole, up, above


def unary_of(model: Model, found: tuple[str, ...]) -> float:
    return sum(model.unary.get(f, 0.0) for f in found)


def marks(tree: Tree) -> list[int]:
    """Labels of a labelled page's elements."""
    out = []
    for attributes, parent in zip(tree.attributes, tree.parents):
        own = re.search(r"data-main=(\d)", attributes)
        out.append(int(own[1]) if own else out[parent] if parent >= 0 else 0)
    return out


def train(pages: list[str], steps: int = 200, ridge: float = 0.1) -> Model:
    """The most likely potentials of labelled pages under a ridge, by gradient ascent."""
    trees = [parse(page) for page in pages]
    found = [features(tree) for tree in trees]
    labels = [marks(tree) for tree in trees]
    kinds = [sections(tree) for tree in trees]
    names = sorted({f for page in found for own in page for f in own})
    place = {name: i for i, name in enumerate(names)}
    n = len(names)
    free, scale = np.zeros(n + 6), np.full(n + 6, 1e-8)

    def model_of(free):
        pair = free[n:].tolist()
        return Model(dict(zip(names, free.tolist())), (tuple(pair[:3]), tuple(pair[3:])))

    for _ in range(steps):
        model = model_of(free)
        gradient = -ridge * free
        for tree, page, label, kind in zip(trees, found, labels, kinds):
            unary = [unary_of(model, own) for own in page]
            whole, up, above = beliefs(tree.parents, kind, unary, model.pair)
            for i, own in enumerate(page):
                surplus = label[i] - 1 / (1 + exp(-max(-30.0, min(30.0, whole[i]))))
                for f in own:
                    gradient[place[f]] += surplus
                if i:
                    shared = model.pair[kind[i]]
                    weights = [1.0, exp(shared[0] + up[i]), exp(shared[1] + above[i])]
                    weights.append(exp(shared[2] + up[i] + above[i]))
                    chances = np.array(weights[1:]) / sum(weights)
                    both = (label[tree.parents[i]], label[i])
                    seen = np.array([both == (0, 1), both == (1, 0), both == (1, 1)])
                    at = n + 3 * kind[i]
                    gradient[at : at + 3] += seen - chances
        scale += gradient**2
        free = free + 0.5 * gradient / np.sqrt(scale)
    return model_of(free)


@lru_cache(maxsize=1)
def trained() -> Model:
    return train(labelled_pages())


def main_text(page: str, model: Model, memo: dict) -> str:
    """The blocks of main text, white space within each as one space, joined by spaces."""
    tree = parse(page)
    unary = []
    for own in features(tree):
        odds = memo.get(own)
        if odds is None:
            odds = memo[own] = unary_of(model, own)
        unary.append(odds)
    whole, _, _ = beliefs(tree.parents, sections(tree), unary, model.pair)
    blocks, open_block = [], []
    for element, text, _ in tree.runs:
        if element < 0:
            if open_block:
                blocks.append("".join(open_block))
                open_block = []
        elif whole[element] > 0:
            open_block.append(text)
    blocks.append("".join(open_block))
    clean = (" ".join(unescape(block).split()) for block in blocks)
    return " ".join(block for block in clean if block)


def extract(
    pages: DataFrame,
    model: Model | None = None,
    html_col: str = "html",
    keep: tuple[str, ...] = ("page_id", "url"),
) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` (its code points), one row per page."""
    held, memo = pages.sparkSession.sparkContext.broadcast(model or trained()), Memo(50_000)

    def compute(texts):
        made = [main_text(text, held.value, memo) for text in texts]
        return [pa.array(made, pa.string()), pa.array(list(map(len, made)), pa.int64())]

    return map_texts(pages, compute, "text string, n_chars long", html_col, keep)

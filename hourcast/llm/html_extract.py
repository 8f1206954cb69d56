"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree: its block elements and, as leaves, its runs of text. Every
node is content or not; a node's potential comes from its features (tag, words of
class, id and role, share of linked text, length, closing punctuation), and every
parent-child edge has a potential for the four pairs of states. Sum-product
messages, upward then downward, give the exact marginals, and the runs of text more
likely content than not are the main text. Weights are fitted to labelled pages by
gradient ascent on the likelihood, whose gradient needs the same marginals.

``labelled_pages`` makes the default training set: pages of many layouts (with and
without semantic tags, with unclosed tags) whose main blocks are known. Any list of
(html, main blocks) can be used in its place.

Text: character references are decoded, white space in a block becomes one space,
blocks are trimmed and joined by an empty line. Scripts, styles, templates, closed media
and drawing elements and elements hidden by attribute or style have no text. Null html counts as empty and gives an empty
text; so does a page without content. Repeated rows are extracted alike.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hourcast.llm.common import pick, prepare

#: One attribute, as browsers read it: a quote opens a value only right after the equals sign; name, quoted or bare value.
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))?+)?+""")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|" + re.sub(r"\((?=[\[\"'])(?!\?)", "(?:", ATTRIBUTE.pattern) + r")*+)(?:>|\Z)", re.S)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
NAMED = frozenset({"class", "id", "role", "aria-label"})

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
SILENT = frozenset("script style title textarea iframe noscript template".split())
#: Elements left out with all they hold, if they are closed; of one that isn't, only the tag is.
SKIPPED = frozenset("svg object canvas audio video annotation annotation-xml".split())
#: Elements that end the run of text around them.
BLOCK = frozenset(
    "html body address article aside blockquote button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup label legend li main menu nav ol option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split())
#: A start tag of the first kind closes an open element of the second, unless one of the third is between them.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
          "option": ({"option"}, {"select"})}
#: A paragraph is closed by a block's start tag, looked for up to these.
HOLDS_PARAGRAPHS = frozenset("html body article aside blockquote button div dd fieldset figure figcaption footer form header "
                             "li main nav section table td th details caption center".split())


@dataclass
class Tree:
    """Nodes of one page in document order; node 0 is the page. Leaves have text."""

    parent: list[int] = field(default_factory=lambda: [-1])
    features: list[list[str]] = field(default_factory=lambda: [["page"]])
    text: list[str | None] = field(default_factory=lambda: [None])
    linked: list[int] = field(default_factory=lambda: [0])  # characters within links, of leaves

    def add(self, parent: int, features: list[str], text: str | None = None, linked: int = 0) -> int:
        self.parent.append(parent)
        self.features.append(features)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1


def _attributes(attributes: str) -> Iterator[tuple[str, str]]:
    for name, *values in ATTRIBUTE.findall(attributes):
        yield name.lower(), "".join(values)


def _names(attributes: str) -> list[str]:
    return [w.lower() for name, value in _attributes(attributes) if name in NAMED for w in NAME_PART.findall(value)]


def _is_hidden(attributes: str) -> bool:
    """Whether the element isn't shown: the attribute ``hidden``, or a style that hides it."""
    if "hidden" not in attributes.lower() and "none" not in attributes.lower():
        return False
    return any(name == "hidden" and value.lower() != "false"
               or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)
               for name, value in _attributes(attributes))


def _closes_itself(attributes: str) -> bool:
    """Whether a slash ends the tag; one at the end of a bare value belongs to the value."""
    end = 0
    for end in (m.end() for m in ATTRIBUTE.finditer(attributes)):
        pass
    return "/" in attributes[end:]


def _ends(html: str, name: str) -> dict[int, int]:
    """End of each closed element of that name, by the place of its start tag."""
    opened, out = [], {}
    for m in re.finditer(rf"<(/?){name}(?=[\s/>])[^>]*>?", html, re.I):
        if not m[1]:
            opened.append(m.start())
        elif opened:
            out[opened.pop()] = m.end()
    return out


def parse(html: str | None) -> Tree:
    """Tree of block elements and runs of text; forgiving about unclosed and stray tags."""
    tree = Tree()
    if not html:
        return tree
    open_tags: list[tuple[str, int, bool]] = [("", 0, False)]  # name, the node of the nearest block, whether hidden
    run: list[str] = []
    ends: dict[str, dict[int, int]] = {}
    links, linked, hidden, at, end = 0, 0, 0, 0, len(html)

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                tree.add(open_tags[-1][1], [], text, min(linked, len(text)))
            run.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal links, hidden
        while len(open_tags) > depth:
            name, _, unseen = open_tags[-1]
            if name in BLOCK:
                flush()
            links -= name == "a"
            hidden -= unseen
            open_tags.pop()

    def close(names, stop) -> None:
        for i in range(len(open_tags) - 1, 0, -1):
            if open_tags[i][0] in names:
                pop_to(i)
                return
            if open_tags[i][0] in stop:
                return

    while at < end:
        tag = TOKEN.search(html, at)
        piece = html[at:tag.start()] if tag else html[at:]
        if piece and not hidden:
            if "&" in piece:
                piece = html_lib.unescape(piece)
            run.append(piece)
            if links:
                linked += len(piece.strip())
        if not tag:
            break
        at = tag.end()
        if not tag[2]:
            continue
        name = tag[2].lower()
        if tag[1]:
            if name in BLOCK:
                close((name,), ("table",) if name != "table" else ())
            else:
                close((name,), BLOCK)
            continue
        if name in SILENT:
            if not _closes_itself(tag[3]):
                over = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                at = over.end() if over else end
        elif name in SKIPPED:
            if name not in ends:
                ends[name] = _ends(html, name)
            at = max(at, ends[name].get(tag.start(), at))
        elif name == "br":
            run.append(" ")
        elif name == "hr":
            close(("p",), HOLDS_PARAGRAPHS)
            flush()
        elif name in BLOCK:
            if name not in ("button", "label", "select", "option"):
                close(("p",), HOLDS_PARAGRAPHS)
            if name in CLOSES:
                close(*CLOSES[name])
            flush()
            features = [f"tag={name}", *{f"name={w}" for w in _names(tag[3])}] if tag[3] else [f"tag={name}"]
            unseen = bool(tag[3]) and _is_hidden(tag[3])
            hidden += unseen
            open_tags.append((name, tree.add(open_tags[-1][1], features), unseen))
        elif name not in VOID:
            links += name == "a"
            unseen = bool(tag[3]) and _is_hidden(tag[3])
            hidden += unseen
            open_tags.append((name, open_tags[-1][1], unseen))
    flush()
    return tree


def _describe(tree: Tree) -> list[list[str]]:
    """Features of all nodes; lengths and links are summed up from the leaves."""
    n = len(tree.parent)
    chars, linked, leaves = [0] * n, list(tree.linked), [0] * n
    for i in range(n - 1, 0, -1):
        if tree.text[i] is not None:
            chars[i], leaves[i] = len(tree.text[i]), 1
        p = tree.parent[i]
        chars[p] += chars[i]
        leaves[p] += leaves[i]
        linked[p] += linked[i]
    out = []
    for i in range(n):
        text = tree.text[i]
        size = min(12, chars[i].bit_length())
        share = 0 if not linked[i] else 1 + min(3, 4 * linked[i] // max(1, chars[i]))
        if text is None:
            mean = min(12, (chars[i] // max(1, leaves[i])).bit_length())
            out.append([*tree.features[i], f"links={share}", f"mean={mean}"])
        else:
            ends = "stop" if text[-1] in ".!?…:;\"'»”’)。" else "open"
            out.append(["leaf", f"size={size}", f"leaf links={share}", f"ends={ends}", f"ends={ends},{min(size, 8)}",
                        *(["mark=©"] if "©" in text else [])])
    return out


@dataclass
class Forest:
    """Trees as arrays; roots have parent -1, and levels hold the nodes by depth."""

    parent: np.ndarray
    levels: list[np.ndarray]
    node: np.ndarray
    feature: np.ndarray
    leaf: np.ndarray

    @classmethod
    def of(cls, trees: list[Tree], vocabulary: dict[str, int], grow: bool = False) -> "Forest":
        parent, depth, node, feature, leaf = [], [], [], [], []
        for tree in trees:
            base = len(parent)
            for i, names in enumerate(_describe(tree)):
                p = tree.parent[i]
                parent.append(p + base if p >= 0 else -1)
                depth.append(depth[p + base] + 1 if p >= 0 else 0)
                leaf.append(tree.text[i] is not None)
                for name in names:
                    k = vocabulary.setdefault(name, len(vocabulary)) if grow else vocabulary.get(name)
                    if k is not None:
                        node.append(base + i)
                        feature.append(k)
        depth = np.array(depth)
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(depth.max() + 2)) if len(depth) else [0, 0]
        return cls(np.array(parent), [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
                   np.array(node, dtype=np.int64), np.array(feature, dtype=np.int64), np.array(leaf, dtype=bool))


@dataclass
class TreeModel:
    """Log-potentials: a weight by feature (for content), and a 2 x 2 table by kind of child (element, leaf)."""

    vocabulary: dict[str, int]
    weight: np.ndarray
    pair: np.ndarray  # (kind, parent state, child state)

    def marginals(self, f: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(P(content) by node, P(parent state, child state) by node, unary potentials)."""
        n = len(f.parent)
        own = np.zeros((n, 2))
        own[:, 1] = np.bincount(f.node, weights=self.weight[f.feature], minlength=n)
        pair = self.pair[f.leaf.astype(int)]
        inside, up = own.copy(), np.zeros((n, 2))
        for level in reversed(f.levels[1:]):
            up[level] = np.logaddexp.reduce(pair[level] + inside[level][:, None, :], axis=2)
            np.add.at(inside, f.parent[level], up[level])
        down, edge = np.zeros((n, 2)), np.zeros((n, 2, 2))
        for level in f.levels[1:]:
            p = f.parent[level]
            rest = down[p] + inside[p] - up[level]  # what the parent knows without this child
            joint = rest[:, :, None] + pair[level]
            down[level] = np.logaddexp.reduce(joint, axis=1)
            edge[level] = joint + inside[level][:, None, :]
        belief = inside + down
        content = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -60, 60)))
        edge -= edge.max(axis=(1, 2), keepdims=True)
        edge = np.exp(edge)
        return content, edge / edge.sum(axis=(1, 2), keepdims=True), own


def train(pages: list[tuple[str, list[str]]], steps: int = 150, rate: float = 0.2, decay: float = 0.01) -> TreeModel:
    """Fit to (html, main blocks): a leaf is content if its text is a main block, an element if most of its text is."""
    trees = [parse(h) for h, _ in pages]
    vocabulary: dict[str, int] = {}
    f = Forest.of(trees, vocabulary, grow=True)
    truth = np.zeros(len(f.parent), dtype=bool)
    base = 0
    for tree, (_, blocks) in zip(trees, pages, strict=True):
        main, n = set(blocks), len(tree.parent)
        good, total = np.zeros(n), np.zeros(n)
        for i in range(n - 1, -1, -1):
            if tree.text[i] is not None:
                total[i], good[i] = len(tree.text[i]), len(tree.text[i]) * (tree.text[i] in main)
            truth[base + i] = 2 * good[i] > total[i]
            if tree.parent[i] >= 0:
                total[tree.parent[i]] += total[i]
                good[tree.parent[i]] += good[i]
        base += n
    model = TreeModel(vocabulary, np.zeros(len(vocabulary)), np.zeros((2, 2, 2)))
    seen = np.bincount(f.feature, weights=truth[f.node], minlength=len(vocabulary))
    kind, child = f.leaf.astype(int), f.parent >= 0
    pairs = np.zeros((2, 2, 2))
    np.add.at(pairs, (kind[child], truth[f.parent[child]].astype(int), truth[child].astype(int)), 1)
    count = np.bincount(f.feature, minlength=len(vocabulary)) + 1.0
    total = pairs.sum() + 1
    mw, sw, mp, sp = np.zeros_like(model.weight), np.zeros_like(model.weight), np.zeros_like(pairs), np.zeros_like(pairs)
    for t in range(1, steps + 1):
        content, edge, _ = model.marginals(f)
        expected = np.bincount(f.feature, weights=content[f.node], minlength=len(vocabulary))
        expected_pairs = np.stack([edge[child & (kind == k)].sum(axis=0) for k in (0, 1)])
        gw = (seen - expected) / np.sqrt(count) - decay * model.weight
        gp = (pairs - expected_pairs) / np.sqrt(total) - decay * model.pair
        for value, g, m, s in ((model.weight, gw, mw, sw), (model.pair, gp, mp, sp)):
            m *= 0.9
            m += 0.1 * g
            s *= 0.99
            s += 0.01 * g * g
            value += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-6)
    return model


def main_blocks(pages: list[str | None], model: TreeModel) -> list[list[str]]:
    """Content blocks of each page, in page order."""
    trees = [parse(h) for h in pages]
    content, _, _ = model.marginals(Forest.of(trees, model.vocabulary))
    out, base = [], 0
    for tree in trees:
        out.append([t for i, t in enumerate(tree.text) if t is not None and content[base + i] > 0.5])
        base += len(tree.parent)
    return out


def extract(df: DataFrame, model: TreeModel, id_col: str = "page_id", html_col: str = "html",
            url_col: str = "url") -> DataFrame:
    """(id, url, text, n_chars, n_blocks) for every row."""
    prepare(df.sparkSession)
    d = pick(df, id=id_col, url=url_col, html=html_col)
    id_type, url_type = (d.schema[c].dataType.simpleString() for c in ("id", "url"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            blocks = main_blocks(batch.column("html").to_pylist(), model)
            text = ["\n\n".join(b) for b in blocks]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(text, pa.string()),
                 pa.array(map(len, text), pa.int64()), pa.array(map(len, blocks), pa.int64())],
                names=["id", "url", "text", "n_chars", "n_blocks"])

    return d.mapInArrow(run, f"id {id_type}, url {url_type}, text string, n_chars long, n_blocks long")


# ---- the default training set ------------------------------------------------

#: Class and id names in common use on the web, by what they mark.
MARKS = {
    "nav": "nav menu navbar navigation topnav breadcrumbs breadcrumb pagination toc links",
    "header": "header masthead site-header topbar branding logo tagline",
    "ad": "ad ads advert advertisement banner sponsored sponsor promo promotion adsense dfp",
    "notice": "cookie cookie-banner consent notice alert gdpr popup modal newsletter-popup paywall",
    "sidebar": "sidebar side-bar widget rail aside secondary trending popular",
    "form": "search search-form newsletter subscribe signup login contact-form",
    "share": "share sharing social social-links follow",
    "related": "related related-posts recommended more-stories read-more also-like",
    "comments": "comments comment comment-list discussion replies reader-comments disqus responses",
    "footer": "footer site-footer copyright legal colophon bottom",
    "content": "content post entry entry-content article article-body story post-body main text page-content body-text blog-post",
}
MARKS = {k: v.split() for k, v in MARKS.items()}


class _Writer:
    """Writes one page and keeps its main blocks."""

    def __init__(self, r: random.Random) -> None:
        self.r, self.blocks = r, []
        self.syllables = ["".join(r.choices("bcdfghlmnprstvw", k=1) + r.choices("aeiouéüñ", k=1) + r.choices(["", "n", "r", "s"], k=1)) for _ in range(60)]

    def words(self, n: int) -> str:
        return " ".join("".join(self.r.choices(self.syllables, k=self.r.randint(1, 4))) for _ in range(n))

    def sentence(self, low: int = 4, high: int = 18) -> str:
        return self.words(self.r.randint(low, high)).capitalize() + self.r.choice("....?!")

    def text(self) -> str:
        n = self.r.choice([1, 1, 2, 3, 5, 9])
        return " ".join(self.sentence(1 if self.r.random() < 0.2 else 4) for _ in range(n))

    def link(self) -> str:
        text = self.words(self.r.randint(1, 4)) + self.r.choice(["", "", "", ".", ",", "…"])
        return f'<a href="/{self.words(1)}">{text}</a>'

    def box(self, kind: str, inner: str, tags: tuple[str, ...] = ("div",)) -> str:
        tag = self.r.choice(tags)
        plain = tag not in ("div", "section", "ul", "p", "span", "table") and self.r.random() < 0.5
        mark = "" if plain else f' {self.r.choice(["class", "class", "id"])}="{self.r.choice(MARKS[kind])}"'
        return f"<{tag}{mark}>{inner}</{tag}>"

    def list(self) -> str:
        return "<ul>" + "".join(f"<li>{self.link()}</li>" for _ in range(self.r.randint(3, 8))) + "</ul>"

    def boilerplate(self, kind: str) -> str:
        r = self.r
        if kind == "nav":
            return self.box(kind, self.list() if r.random() < 0.7 else " | ".join(self.link() for _ in range(5)), ("nav", "nav", "div"))
        if kind == "header":
            return self.box(kind, r.choice([f"<h1>{self.words(2)}</h1>", f"<a href='/'>{self.words(2)}</a>", f"<p>{self.sentence()}</p>"]) + (self.list() if r.random() < 0.4 else ""), ("header", "header", "div"))
        if kind == "sidebar":
            return self.box(kind, f"<h3>{self.words(2)}</h3>" + (self.list() if r.random() < 0.6 else f"<p>{self.text()}</p>"), ("aside", "aside", "div"))
        if kind == "form":
            return self.box(kind, f"<label>{self.words(2)}</label><input name=q><button>{self.words(1)}</button>" + (f"<p>{self.sentence()}</p>" if r.random() < 0.4 else ""), ("form", "form", "form"))
        if kind == "comments":
            tag = r.choice(["div", "div", "li", "p", "article"])
            one = lambda: f'<{tag} class="comment"><b>{self.words(2)}</b><p>{self.text()}</p></{tag}>'
            return self.box(kind, f"<h3>{self.words(1)}</h3>" * (r.random() < 0.7) + "".join(one() for _ in range(r.randint(1, 5))), ("section", "div", "div"))
        if kind == "footer":
            return self.box(kind, r.choice(["&copy; ", "", "Copyright 2020 "]) + f"{self.words(1)}.example.com &middot; {self.sentence()}" + (self.list() if r.random() < 0.3 else ""), ("footer", "footer", "div"))
        if kind in ("share", "related"):
            return self.box(kind, self.list() if r.random() < 0.6 else f"<h4>{self.words(2)}</h4>" + " ".join(self.link() for _ in range(3)), ("div", "section", "aside"))
        return self.box(kind, r.choice([self.sentence(), self.text(), f"<p>{self.text()}</p>", f"{self.sentence()} <button>{self.words(1)}</button>"]), ("div", "div", "section", "aside"))

    def keep(self, text: str) -> str:
        self.blocks.append(" ".join(text.split()))
        return text

    def content(self) -> str:
        r, parts = self.r, []
        if r.random() < 0.8:
            title = f"<h1>{self.keep(self.words(r.randint(1, 9)) + r.choice(['', '.']))}</h1>"
            parts.append(f"<header>{title}</header>" if r.random() < 0.15 else title)
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 14])):
            k = r.random()
            if k < 0.7:
                text = self.keep(self.text())
                if r.random() < 0.2 and " " in text:
                    a, b = text.split(" ", 1)
                    text = f"<{'b' if r.random() < 0.5 else 'a href=/x'}>{a}</{'b' if r.random() < 0.5 else 'a'}> {b}"
                parts.append(r.choice([f"<p>{text}</p>"] * 4 + [f"<p>{text}", f"<p><b>{text}<br>", f"<div>{text}</div>"]))
            elif k < 0.78:
                parts.append(f"<h2>{self.keep(self.words(r.randint(1, 5)))}</h2>")
            elif k < 0.86:
                parts.append("<ul>" + "".join(f"<li>{self.keep(self.sentence(1))}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif k < 0.91:
                parts.append(f"<blockquote><p>{self.keep(self.text())}</p></blockquote>")
            elif k < 0.95:
                parts.append(f"<figure><img src=x><figcaption>{self.keep(self.sentence())}</figcaption></figure>")
            else:
                parts.append("<table>" + "".join(f"<tr><td>{self.keep(self.words(2))}</td><td>{self.keep(self.words(1))}</td></tr>" for _ in range(3)) + "</table>")
            if r.random() < 0.08:
                parts.append(self.boilerplate(r.choice(["ad", "ad", "share", "related", "sidebar", "form", "notice"])))
        if r.random() < 0.12:
            parts.append(self.boilerplate(r.choice(["comments", "share", "related"])))
        inner = "".join(parts)
        k = r.random()
        if k < 0.45:
            return f"<article>{inner}</article>"
        if k < 0.6:
            return f"<main>{inner}</main>" if r.random() < 0.5 else f"<main><article>{inner}</article></main>"
        if k < 0.66:
            return f"<table><tr><td>{self.boilerplate('nav')}</td><td>{inner}</td></tr></table>"
        return self.box("content", inner, ("div", "div", "section"))

    def page(self) -> str:
        r = self.r
        some = lambda kinds, p: "".join(self.boilerplate(k) for k in kinds if r.random() < p)
        before = some(["notice", "header", "nav", "ad", "form", "sidebar"], 0.45)
        middle = self.content()
        after = some(["share", "related", "comments", "sidebar", "ad", "form", "notice", "footer", "footer"], 0.4)
        body = before + middle + after
        if r.random() < 0.5:
            body = f'<div class="{r.choice(["wrapper", "container", "page", "row", "layout"])}">{body}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.words(4)}</title><style>p{{}}</style></head><body>{body}</body></html>"


def labelled_pages(n: int = 600, seed: int = 11) -> list[tuple[str, list[str]]]:
    """``n`` made-up pages of mixed layouts with their main blocks."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        w = _Writer(r)
        out.append((w.page(), w.blocks))
    return out

"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page becomes a list of leaf blocks, each with its text, the tags and class words of its ancestors, and the share of its
text inside links. The field labels the blocks of a page together: block features decide with transitions between neighbours.
It is trained on pages whose markup names its parts (an article or main element beside navigation, footers and the like),
also with these names replaced by others in use and with some left out, so that text and position count as well.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from pairwright.llm.common import labelled_samples, result_name

# Element names of HTML.
RAW = frozenset(("script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "canvas", "select"))
VOID = frozenset(
    ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
)
BLOCK = frozenset(
    (
        "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
        "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup",
        "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td",
        "tfoot", "th", "thead", "tr", "ul",
    )
)
#: What an opening tag ends if it is open, up to the nearest of the second names.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}

# A quote delimits a value only after an equals sign; a tag that never ends takes the rest of the page.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME_WORD = re.compile(r"[a-z]{2,}")
BUCKETS = 1 << 13
WHOLE_PATH = 64  # ancestors of a training block that are kept one by one
DEEP_PAGE = 200_000  # ancestors of all blocks together from which on a page does not teach
OUTSIDE, MAIN, AFTER_MAIN = 0, 1, 2


class Node:
    """An element that blocks lie in: its tag and class words, its parent, and what it adds to its ancestors.

    ``fresh`` are the feature names that no ancestor has, ``state`` what the markup says of the text inside (see
    :func:`named_labels`). Blocks share their nodes, so a page costs time in proportion to its length at any depth.
    """

    __slots__ = ("tag", "words", "parent", "depth", "fresh", "state")

    def __init__(self, tag: str, words: tuple[str, ...], parent: Node | None, fresh: tuple[str, ...]) -> None:
        self.tag, self.words, self.parent, self.fresh = tag, words, parent, fresh
        self.depth = parent.depth + 1 if parent else 1
        before = parent.state if parent else OUTSIDE
        if before == AFTER_MAIN:
            self.state = AFTER_MAIN
        elif tag in _MAIN_TAGS:
            self.state = MAIN
        elif before == MAIN and is_other(tag, words):
            self.state = AFTER_MAIN
        else:
            self.state = before


def _names(tag: str, words: tuple[str, ...]) -> list[str]:
    return [f"tag {tag}", *(f"word {w}" for w in dict.fromkeys(words))]


@dataclass(frozen=True)
class Block:
    """A leaf block: its text, the innermost element it lies in, and the characters inside links."""

    text: str
    node: Node | None
    link_chars: int

    @property
    def path(self) -> tuple[tuple[str, tuple[str, ...]], ...]:
        """Ancestors from the outermost. Of more than ``WHOLE_PATH``, those between are left out that add no name."""
        found, node = [], self.node
        whole = node is None or node.depth <= WHOLE_PATH
        while node:
            if whole or node.fresh or node is self.node:
                found.append((node.tag, node.words))
            node = node.parent
        return tuple(found[::-1])

    @classmethod
    def under(cls, text: str, path: tuple[tuple[str, tuple[str, ...]], ...], link_chars: int) -> Block:
        """A block below the elements of a path."""
        node, known = None, set()
        for tag, words in path:
            names = _names(tag, words)
            node = Node(tag, words, node, tuple(n for n in names if n not in known))
            known.update(names)
        return cls(text, node, link_chars)


def leaf_blocks(source: str) -> list[Block]:
    """Blocks of a page in page order. Character references are decoded, and white space is one space; none are empty.

    Unclosed, crossed and unknown tags are read as browsers mostly do. Contents of scripts, styles and other elements
    that hold no text of the page are left out.
    """
    blocks: list[Block] = []
    stack: list[tuple[str, Node | None, list[str]]] = []  # tag, innermost element for text, its names
    open_at: dict[str, list[int]] = {}  # places of open tags in the stack
    named: dict[str, int] = {}  # names of open elements
    parts: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, stack[-1][1] if stack else None, min(links, len(text))))
            parts.clear()
        links = 0

    def take(text: str) -> None:
        nonlocal links
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if open_at.get("a"):
                links += len(text)

    def push(tag: str, words: tuple[str, ...]) -> None:
        open_at.setdefault(tag, []).append(len(stack))
        node, names = stack[-1][1] if stack else None, []
        if tag in BLOCK or tag == "a":
            names = _names(tag, words)
            node = Node(tag, words, node, tuple(n for n in names if not named.get(n)))
            for n in names:
                named[n] = named.get(n, 0) + 1
        stack.append((tag, node, names))

    def pop_to(place: int) -> None:
        while len(stack) > place:
            tag, _, names = stack.pop()
            open_at[tag].pop()
            for n in names:
                named[n] -= 1

    def end_open(tags: tuple[str, ...], scope: tuple[str, ...]) -> None:
        last = lambda names: max((open_at[n][-1] for n in names if open_at.get(n)), default=-1)
        if (place := last(tags)) > last(scope):
            pop_to(place)

    at = 0
    while match := _MARKUP.search(source, at):
        take(source[at : match.start()])
        at = match.end()
        name = match[2]
        if not name:
            continue
        name = name.lower()
        if match[1]:
            if name in BLOCK:
                flush()
            if open_at.get(name):
                pop_to(open_at[name][-1])
            continue
        if name in RAW:
            if not match[3].endswith("/"):
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = close.end() if close else len(source)
            continue
        if name in BLOCK:
            flush()
            end_open(("p",), ("td", "th", "table", "button"))
            if name in ENDS:
                end_open(*ENDS[name])
        elif name == "br":
            parts.append(" ")
        if name in VOID or match[3].endswith("/"):
            continue
        words: tuple[str, ...] = ()
        if "=" in match[3]:
            words = tuple(w for found in _NAMES.findall(match[3]) for w in _NAME_WORD.findall("".join(found).lower()))
        push(name, words)
    take(source[at:])
    flush()
    return blocks


def _bucket(n: float) -> int:
    return int(math.log2(n + 1))


@lru_cache(1 << 16)
def _hash(name: str) -> int:
    return zlib.crc32(name.encode()) % BUCKETS


def text_features(blocks: list[Block]) -> list[list[int]]:
    """Hashed features of each block but those of its ancestors' names."""
    rows = []
    for i, block in enumerate(blocks):
        text = block.text
        density = block.link_chars / len(text)
        ended = text[-1] in ".!?:;\"»”…"
        features = [
            "bias",
            f"own {block.node.tag if block.node else ''}",
            f"length {_bucket(len(text))}",
            f"words {_bucket(text.count(' '))} links {int(density * 4)}",
            f"links {int(density * 4)}",
            f"ended {ended}",
            f"commas {_bucket(text.count(','))} ended {ended}",
            f"sign {'©' in text}",
            f"place {4 * i // len(blocks)}",
            f"first {i == 0} last {i == len(blocks) - 1}",
        ]
        rows.append([_hash(f) for f in features])
    return rows


def block_features(blocks: list[Block], drop: frozenset[str] = frozenset()) -> list[list[int]]:
    """Hashed features of each block; names in ``drop`` count as unknown."""
    rows = text_features(blocks)
    for row, block in zip(rows, blocks):
        names = dict.fromkeys(n for tag, words in block.path for n in _names(tag, words))
        row += [_hash(n) for n in names if n.split(" ", 1)[1] not in drop]
    return rows


@dataclass(frozen=True)
class BlockField:
    """Feature weights for both labels (0: boilerplate, 1: main text), transition scores and start scores."""

    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def scores(self, features: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[f].sum(0) for f in features])

    def page_scores(self, blocks: list[Block]) -> np.ndarray:
        """Scores of a page's blocks. What its ancestors' names add is kept for each element and used by all inside."""
        found = self.scores(text_features(blocks)).astype(np.float64)
        known: dict[Node | None, np.ndarray] = {None: np.zeros(2)}
        for i, block in enumerate(blocks):
            chain, node = [], block.node
            while node not in known:
                chain.append(node)
                node = node.parent
            for node in reversed(chain):
                above = known[node.parent]
                known[node] = above + self.weights[[_hash(n) for n in node.fresh]].sum(0) if node.fresh else above
            found[i] += known[block.node]
        return found

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most likely labels of a page, by Viterbi."""
        if not blocks:
            return []
        scores = self.page_scores(blocks).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = self.start[0] + scores[0][0], self.start[1] + scores[0][1]
        back = []
        for s0, s1 in scores[1:]:
            to0, to1 = (a + m00 >= b + m10), (a + m01 >= b + m11)
            back.append((0 if to0 else 1, 0 if to1 else 1))
            a, b = max(a + m00, b + m10) + s0, max(a + m01, b + m11) + s1
        labels = [0 if a >= b else 1]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def train_blocks(pages: list[tuple[list[list[int]], list[int]]], epochs: int = 6, rate: float = 0.3) -> BlockField:
    """Conditional likelihood by adaptive gradient steps; pages are features of their blocks and labels."""
    weights, moves, start = np.zeros((BUCKETS, 2)), np.zeros((2, 2)), np.zeros(2)
    seen_w, seen_m, seen_s = np.full((BUCKETS, 2), 1e-2), np.full((2, 2), 1e-2), np.full(2, 1e-2)
    field, order = BlockField(weights, moves, start), np.random.default_rng(0)
    for _ in range(epochs):
        for at in order.permutation(len(pages)):
            features, labels = pages[at]
            scores = field.scores(features)
            n = len(labels)
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = start + scores[0]
            for t in range(1, n):
                ahead[t] = scores[t] + np.logaddexp.reduce(ahead[t - 1][:, None] + moves, axis=0)
            for t in range(n - 2, -1, -1):
                behind[t] = np.logaddexp.reduce(moves + scores[t + 1] + behind[t + 1], axis=1)
            whole = np.logaddexp(*ahead[-1])
            off = -np.exp(ahead + behind - whole)
            off[np.arange(n), labels] += 1
            turn = np.zeros((2, 2))
            for t in range(1, n):
                turn -= np.exp(ahead[t - 1][:, None] + moves + scores[t] + behind[t] - whole)
                turn[labels[t - 1], labels[t]] += 1
            for values, seen, gradient in ((moves, seen_m, turn), (start, seen_s, off[0])):
                seen += gradient**2
                values += rate * gradient / np.sqrt(seen)
            rows = np.concatenate([np.array(f) for f in features])
            step = np.zeros((BUCKETS, 2))
            np.add.at(step, rows, np.repeat(off, [len(f) for f in features], axis=0))
            touched = np.unique(rows)
            gradient = step[touched] - 1e-3 * weights[touched]
            seen_w[touched] += gradient**2
            weights[touched] += rate * gradient / np.sqrt(seen_w[touched])
    return field


# Names that markup in use gives to the parts of a page.
MAIN_NAMES = (
    ("article", ()), ("main", ()), ("div", ("content",)), ("div", ("post", "body")), ("div", ("entry", "content")),
    ("section", ("article",)), ("div", ("story",)), ("div", ("main",)), ("div", ("article", "body")), ("div", ("text",)),
)
OTHER_NAMES = (
    ("nav", ()), ("header", ()), ("footer", ()), ("aside", ()), ("form", ()), ("div", ("menu",)), ("div", ("navbar",)),
    ("div", ("breadcrumb",)), ("div", ("header",)), ("div", ("footer",)), ("div", ("sidebar",)), ("aside", ("sidebar",)),
    ("div", ("ad",)), ("div", ("ads",)), ("div", ("advert",)), ("div", ("banner",)), ("div", ("promo",)), ("div", ("sponsored",)),
    ("div", ("cookie", "notice")), ("div", ("notice",)), ("div", ("popup",)), ("div", ("newsletter",)), ("div", ("subscribe",)),
    ("section", ("comments",)), ("div", ("comment",)), ("div", ("comments",)), ("li", ("comment",)), ("div", ("related",)),
    ("div", ("share",)), ("div", ("social",)), ("div", ("login",)), ("div", ("search",)), ("div", ("widget",)), ("div", ("copyright",)),
)
INNER_NAMES = (("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("h2",), ("h3",), ("table", "tr", "td"), ("pre",), ("div",), ("figure", "figcaption"))
_MAIN_TAGS = frozenset(("article", "main"))
_OTHER_TAGS = frozenset(("nav", "header", "footer", "aside", "form"))
_OTHER_WORDS = frozenset(w for _, words in OTHER_NAMES for w in words)


def is_other(tag: str, words: tuple[str, ...]) -> bool:
    """Whether an element is named as something beside the main text."""
    return tag in _OTHER_TAGS or not _OTHER_WORDS.isdisjoint(words)


def named_labels(blocks: list[Block]) -> list[int] | None:
    """Labels that the markup itself gives; None for a page that does not name its main part and another one.

    A block is main text in a main element, unless an element named as something else lies between.
    """
    labels = [int(block.node is not None and block.node.state == MAIN) for block in blocks]
    return labels if 0 < sum(labels) < len(labels) else None


def _renamed(block: Block, label: int, main: tuple, other: tuple) -> Block:
    """The block under other names: main names for its main ancestor, or one for what holds it outside."""
    path, done = [], False
    for tag, words in block.path:
        if label and tag in _MAIN_TAGS and not done:
            path.append(main)
            done = True
        elif not label and not done and is_other(tag, words):
            path.append(other)
            done = True
        else:
            path.append((tag, words))
    return Block.under(block.text, tuple(path), block.link_chars)


def page_examples(source: str, versions: int = 3) -> list[tuple[list[list[int]], list[int]]]:
    """Training pages from one page: as it is, and renamed with an inserted block of another part, some names dropped."""
    blocks = leaf_blocks(source)
    labels = named_labels(blocks)
    if labels is None or sum(b.node.depth if b.node else 0 for b in blocks) > DEEP_PAGE:
        return []
    found = [(block_features(blocks), labels)]
    draw = np.random.default_rng(zlib.crc32(source.encode("utf-8", "replace")))
    others = [b for b, x in zip(blocks, labels) if not x]
    mains = [b for b, x in zip(blocks, labels) if x]
    for _ in range(versions):
        main = MAIN_NAMES[draw.integers(len(MAIN_NAMES))]
        changed = [_renamed(b, x, main, OTHER_NAMES[draw.integers(len(OTHER_NAMES))]) for b, x in zip(blocks, labels)]
        for i, x in enumerate(labels):  # lists, quotes, tables and headings are parts of main texts too
            if x and draw.random() < 0.3:
                inner = INNER_NAMES[draw.integers(len(INNER_NAMES))]
                changed[i] = Block.under(changed[i].text, (*changed[i].path[:-1], *((tag, ()) for tag in inner)), changed[i].link_chars)
        marks = list(labels)
        for _ in range(3):  # parts that read like the main text but are named as something else, inside it or beside
            name = OTHER_NAMES[draw.integers(len(OTHER_NAMES))]
            kind = (mains if draw.random() < 0.7 else others)[0 if draw.random() < 0.2 else -1]
            inside = draw.random() < 0.5
            path = (("html", ()), ("body", ()), *((main,) if inside else ()), name, ("p", ()))
            place = int(draw.integers(len(changed) + 1))
            changed.insert(place, Block.under(kind.text, path, kind.link_chars))
            marks.insert(place, 0)
        drop = frozenset(w for w in (main[0], *main[1]) if draw.random() < 0.3)
        found.append((block_features(changed, drop), marks))
    return found


# Pages that name their parts, for tables with next to none: training takes them beside what the table has.
FEW_PAGES = 20
BUILT_IN_VERSIONS = 12
BUILT_IN_PAGES = (
    """<html><body><header><a href=/>Daily Paper</a></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>Sports</a><li>
    <a href=/c>Contact us</a></ul></nav><article><h1>River path opens again</h1><p>After two years of work, the path along
    the river is open to walkers again, the town said on Monday.</p><p>Some benches are new, and old trees were kept where
    that was possible. The work cost less than planned.</p><p>A bridge follows in spring.</p></article><aside class=sidebar>
    <h3>Related</h3><ul><li><a href=/d>Bridge plans shown</a><li><a href=/e>Town budget</a></ul></aside><footer>&copy; 2021
    Daily Paper. All rights reserved.</footer></body></html>""",
    """<html><body><div class="cookie-notice">We use cookies to improve this site. Accept</div><div class=menu><a href=/>Start
    </a> <a href=/x>Recipes</a></div><main><h1>Bread in one evening</h1><p>Mix flour, water, salt and yeast, and let the
    dough rest for an hour.</p><h2>Baking</h2><ul><li>Heat the oven until it is really hot.</li><li>Bake for forty minutes,
    then let it cool.</li></ul><p>It keeps for three days.</p></main><section class=comments><div class=comment><p>Worked
    well for me, thank you!</p></div></section><form><p>Subscribe to our newsletter</p></form><footer><a href=/i>Imprint</a>
    <a href=/p>Privacy</a></footer></body></html>""",
    """<html><body><div class=navbar><ul><li><a href=/>Docs</a><li><a href=/s>Search</a></ul></div><div class=breadcrumb><a
    href=/>Docs</a> / <a href=/g>Guide</a></div><article><h1>Installing</h1><p>Download the archive and unpack it in a folder
    of your choice.</p><pre>tar -xf archive.tar</pre><p>Then start the program once, so that it writes its settings.</p>
    <blockquote><p>Older versions kept settings elsewhere, as the last chapter says.</p></blockquote></article><div class=share>
    <a href=/t>Share</a> <a href=/m>Mail</a></div><div class=footer>Copyright 2020, the authors</div></body></html>""",
    """<html><body><header><h1>Travel notes</h1></header><div class=ads><p>Cheap flights, book today!</p></div><main><p>We left
    early, while the harbour was still dark, and reached the island before noon.</p><p>The second day was quiet; we read,
    swam, and walked to the lighthouse.</p><table><tr><td>Ferry</td><td>two hours</td></tr></table></main><div class=related>
    <p><a href=/o>Another island, another story</a></p></div><aside><p>About me: I write about places.</p></aside><footer>
    <p>Terms of use</p></footer></body></html>""",
)


def learn_blocks(pages: DataFrame, source: str = "html", sample_pages: int = 200) -> BlockField:
    """Train on at most ``sample_pages`` pages, chosen by hash from all of the table whose markup names its parts.

    Where fewer than ``FEW_PAGES`` do, built-in example pages stand beside them.
    """

    def named(value: str, wanted: Callable[[bool, str], bool]) -> Iterator[tuple[bool, str]]:
        if wanted(True, value) and named_labels(leaf_blocks(value)) is not None:
            yield True, value

    found = labelled_samples(pages, source, named, sample_pages)[True]
    chosen = [x for page in found for x in page_examples(page)]
    if len(found) < FEW_PAGES:
        chosen += [x for page in BUILT_IN_PAGES for x in page_examples(page, BUILT_IN_VERSIONS)]
    return train_blocks(chosen)


_FOUND = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_blocks", T.LongType()), T.StructField("n_main", T.LongType())])


def extract_pages(pages: DataFrame, field: BlockField, source: str = "html", result: str = "main") -> DataFrame:
    """Add a struct (text, n_blocks, n_main): the main blocks of each whole page, joined by one line feed.

    A null or empty page, and one without main blocks, has an empty text.
    """
    weights, moves, start = field.weights.astype("float32"), field.moves, field.start

    @pandas_udf(_FOUND)
    def extract(sources: pd.Series) -> pd.DataFrame:
        model = BlockField(weights, moves, start)
        rows = []
        for value in sources:
            blocks = leaf_blocks(value) if value else []
            kept = [b.text for b, label in zip(blocks, model.decode(blocks)) if label]
            rows.append(("\n".join(kept), len(blocks), len(kept)))
        return pd.DataFrame(rows, columns=["text", "n_blocks", "n_main"])

    return pages.withColumn(result_name(pages, result), extract(F.col(f"`{source}`")))

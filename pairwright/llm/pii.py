"""Personal data: fixed patterns, and a semi-Markov conditional random field for forms that the patterns miss.

The field scores whole candidate spans: their shape, digits, marks, check sums and neighbours. Spans of bounded length and
single outside tokens share a lattice; a dynamic program over it chooses boundaries and kinds together. It is trained by
conditional likelihood on windows around spans that the patterns mark, and on the same windows with these spans rewritten
the way people write around patterns ("name at host dot com", numbers without plus sign, other separators).
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from pairwright.llm.common import SPANS, Span, labelled_samples, result_name, span_check, span_rows

# Kinds in their order, patterns and limits of the base scan.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match can only start where a number does
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS, IP_PART = (13, 19), (9, 15), 255

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.S)
_TRIGGER = re.compile(r"[0-9@]|\b(?i:dot)\b")
_DIGIT = re.compile(r"[0-9]")
BEHIND = 3  # tokens before a span that its candidates and features look at, at most
SPAN_TOKENS = 40  # the longest entity: a name of four parts at a host of four labels, all marks in brackets
_WORDS_INSIDE = ("at", "dot")
VERSIONS = 4  # rewritten versions of each training window
BUCKETS = 1 << 12  # feature hashes


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def base_pii(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and not overlapping within a kind; matches that fail their check are dropped."""
    found: list[Span] = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append(("email", start, match.end()))
            last = match.end()
        at = text.find("@", max(at + 1, last))
    if not _DIGIT.search(text):
        return found
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= IP_PART for p in m[0].split(".")):
                found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = _digits(m[0])
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]:
                found.append(("phone", m.start(), m.end()))
    return found


# --- the lattice --------------------------------------------------------------------------------------------------------


Token = tuple[str, int, int]  # text, start, end
#: What tells spans apart: shape, digits, longest run, runs, whether four small numbers, check sum, neighbours.
Look = tuple[str, int, int, int, bool, bool, str, str]
LOOKS = 1 << 17  # scored looks that a scan remembers
FLUSH = 4_096  # tokens from which on a segmentation is settled where no span crosses


def _windows(text: str) -> Iterator[Iterator[Token]]:
    """Tokens around the triggers of a whole text, window by window; near windows are one."""
    reach = 48  # characters that hold the tokens of a window's margin
    low = high = -1
    for m in _TRIGGER.finditer(text):
        if m.start() - reach <= high:
            high = max(high, min(len(text), m.end() + reach))
            continue
        if high >= 0:
            while high < len(text) and text[high].isalnum():
                high += 1
            if m.start() - reach <= high:
                high = max(high, min(len(text), m.end() + reach))
                continue
            yield _tokens(text, low, high)
        before, low, high = high, max(0, m.start() - reach), min(len(text), m.end() + reach)
        while low > max(before, 0) and text[low - 1].isalnum():
            low -= 1
    if high >= 0:
        while high < len(text) and text[high].isalnum():
            high += 1
        yield _tokens(text, low, high)


def _tokens(text: str, low: int, high: int) -> Iterator[Token]:
    for m in _TOKEN.finditer(text, low, high):
        yield m[0], m.start(), m.end()


def _token_kind(t: str) -> str:
    if t[0].isdigit() and t[0].isascii():
        return "9"
    if t.isspace():
        return "n" if "\n" in t else " "
    if t.isalpha():
        return "k" if t.lower() in _WORDS_INSIDE else "a"
    return t


def _joins(kinds: Sequence[str], at: int) -> bool:
    """Whether the token is an at sign, "at" or "dot", or the bracket that closes one of these words."""
    if at < 0:
        return False
    return kinds[at] in "k@" or (at > 1 and kinds[at - 1] == "k" and kinds[at - 2] + kinds[at] in ("()", "[]"))


def _edge(t: str) -> str:
    return " " if t.isspace() or t in "^$" else "9" if t[0].isdigit() else "a" if t.isalpha() else t[0]


def _spans_from(tokens: Sequence[Token], kinds: Sequence[str], i: int) -> Iterator[tuple[int, Look]]:
    """Ends and looks of the spans from a token on that may be entities.

    They hold a digit, an at sign or "dot", and no run of plain words. The look of a longer span is made from the shorter one.
    """
    if kinds[i] in " n" or kinds[i] in ".,;:!?)|#*$%&":
        return
    before = _edge(tokens[i - 1][0] if i else "^")
    anchored, quads = False, True
    shape, digits, runs, longest = "", "", 0, 0
    for j in range(i, min(len(kinds), i + SPAN_TOKENS)):
        kind, token = kinds[j], tokens[j][0]
        if kind in "n#*$%&|!?;\"":
            return
        if kind == "a" and j > i and kinds[j - 1] == " " and not _joins(kinds, j - 2):
            return  # a plain word after a space, but for one that follows "at", "(at)", "[at]", "@" or the like for "dot"
        if j > i and kinds[j - 1] == "k" and (kind == "9" or token == "_"):
            shape = shape[:-1] + "a"  # part of a longer name, so no "at" or "dot"
        if kind == "9":
            anchored, shape, digits, runs = True, shape + "9", digits + token, runs + 1
            longest = max(longest, len(token))
            quads = quads and int(token[:4]) <= IP_PART
        elif kind == "k":
            dot = token.lower() == "dot"
            named = j > i and (kinds[j - 1] == "9" or tokens[j - 1][0] == "_")
            anchored, shape = anchored or dot, shape + ("a" if named else "." if dot else "@")
        else:
            anchored, shape = anchored or kind == "@", shape + (kind if kind in " a" else token)
        if anchored and kind in "9ak" and j > i:
            after = _edge(tokens[j + 1][0] if j + 1 < len(tokens) else "$")
            n = len(digits)
            check = CARD_DIGITS[0] <= n <= CARD_DIGITS[1] and luhn(digits)
            yield j + 1, (shape, n, longest, runs, quads and runs == 4, check, before, after)


def _look_features(look: Look) -> list[int]:
    """Hashed features of a whole span and its neighbours."""
    shape, digits, longest, runs, quads, check, before, after = look
    features = [
        f"shape {shape[:24]}",
        f"bare {re.sub(r'[^9a@]', '', shape)[:16]}",
        f"marks {''.join(sorted(set(re.sub(r'[9a ]', '', shape))))}",
        f"digits {min(digits, 20)}",
        f"runs {min(runs, 6)}",
        f"longest {min(longest, 20)}",
        f"quads {quads}",
        f"luhn {check} {digits > 12}",
        f"at {'@' in shape} dots {min(shape.count('.'), 4)}",
        f"first {shape[:1]} digits {digits // 4}",
        f"before {before}",
        f"after {after}",
        f"around {before}{after} {digits // 4}",
        "span",
    ]
    return [zlib.crc32(f.encode("utf-8", "replace")) % BUCKETS for f in features]


def _token_look(token: str) -> str:
    kind = "9" if token[0].isdigit() else " " if token.isspace() else "a" if token.isalpha() else token[0]
    return f"{kind}{min(len(token), 20) if kind == '9' else ''}"


def _token_features(look: str) -> list[int]:
    return [zlib.crc32(f"token {f}".encode("utf-8", "replace")) % BUCKETS for f in (look[0], look)]


@dataclass
class Lattice:
    """A training window: its tokens, candidate spans as token ranges, and features of both."""

    tokens: list[Token]
    spans: list[tuple[int, int]]
    span_features: np.ndarray
    token_features: np.ndarray

    @classmethod
    def of(cls, window: Iterator[Token]) -> Lattice:
        tokens = list(window)
        kinds = [_token_kind(t) for t, _, _ in tokens]
        found = [(i, j, look) for i in range(len(tokens)) for j, look in _spans_from(tokens, kinds, i)]
        features = np.array([_look_features(look) for _, _, look in found], int)
        outside = np.array([_token_features(_token_look(t)) for t, _, _ in tokens], int)
        return cls(tokens, [(i, j) for i, j, _ in found], features, outside)


class _Path:
    """The best segmentation of a window so far, as flat arrays: a few bytes a token, whatever the window's length."""

    def __init__(self) -> None:
        self.restart()

    def restart(self) -> None:
        self.best, self.total = array("d", [0.0]), array("d", [0.0])  # of segmentations up to a token; of tokens outside
        self.top, self.start, self.kind = array("d", [-math.inf]), array("q", [-1]), array("b", [0])  # best span to a token
        self.places = array("q")

    def grow(self, size: int) -> None:
        while len(self.top) <= size:
            self.top.append(-math.inf)
            self.start.append(-1)
            self.kind.append(0)


@dataclass(frozen=True)
class SegmentField:
    """Weights by feature: a column for each kind of span, and one for outside tokens."""

    weights: np.ndarray
    looks: dict = field(default_factory=dict, compare=False, repr=False)

    def scores(self, spans: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = len(KINDS)
        inside = self.weights[spans, :k].sum(1) if len(spans) else np.zeros((0, k))
        return inside, self.weights[tokens, k].sum(1)

    def _inside(self, look: Look) -> tuple[int, float]:
        """The best kind of a span and its score; spans of one look share it."""
        if (known := self.looks.get(look)) is None:
            if len(self.looks) >= LOOKS:
                self.looks.clear()
            values = self.weights[_look_features(look), : len(KINDS)].sum(0)
            known = self.looks[look] = (int(values.argmax()), float(values.max()))
        return known

    def _outside(self, token: str) -> float:
        look = _token_look(token)
        if (known := self.looks.get(look)) is None:
            known = self.looks[look] = float(self.weights[_token_features(look), len(KINDS)].sum())
        return known

    def decode(self, window: Iterator[Token], min_margin: float) -> Iterator[tuple[str, int, int]]:
        """The best segmentation. Spans that beat their tokens outside by less than the margin are left out.

        Tokens are read once. A span has at most ``SPAN_TOKENS`` tokens, so no more are looked at together, and where no
        span crosses a token's start what lies before is settled.
        """
        path = _Path()
        ahead: deque[Token] = deque()  # a few tokens before the current one, that one, and those its spans may reach
        kinds: deque[str] = deque()
        window = iter(window)
        at, reach, done = 0, 0, False

        def settle() -> list[tuple[str, int, int]]:
            found, j = [], len(path.best) - 1
            while j > 0:
                i = path.start[j]
                if i < 0:
                    j -= 1
                    continue
                if path.top[j] - (path.total[j] - path.total[i]) >= min_margin:
                    found.append((KINDS[path.kind[j]], path.places[2 * i], path.places[2 * j - 1]))
                j = i
            return found[::-1]

        behind = 0  # tokens before the current one in ``ahead``
        while True:
            while not done and len(ahead) < behind + SPAN_TOKENS + 1:
                token = next(window, None)
                if token is None:
                    done = True
                else:
                    ahead.append(token)
                    kinds.append(_token_kind(token[0]))
            if len(ahead) <= behind:
                break
            if at >= FLUSH and reach <= at:
                yield from settle()
                path.restart()
                at = reach = 0
            near, known = list(ahead), list(kinds)
            for end, look in _spans_from(near, known, behind):
                kind, value = self._inside(look)
                j = at + end - behind
                reach = max(reach, j)
                path.grow(j)
                if (value := path.best[at] + value) > path.top[j]:
                    path.top[j], path.start[j], path.kind[j] = value, at, kind
            text, start, stop = near[behind]
            path.places.extend((start, stop))
            outside = self._outside(text)
            path.total.append(path.total[at] + outside)
            path.grow(at + 1)
            apart = path.best[at] + outside
            if path.top[at + 1] > apart:
                path.best.append(path.top[at + 1])
                path.top[at + 1] -= path.best[path.start[at + 1]]  # from now on the span's own score
            else:
                path.best.append(apart)
                path.start[at + 1] = -1
            at += 1
            if behind == BEHIND:
                ahead.popleft()
                kinds.popleft()
            else:
                behind += 1
        yield from settle()

    def added(self, text: str, base: list[Span], min_margin: float = 2.0) -> list[Span]:
        """Spans of the field that overlap no base span."""
        found, in_base = [], span_check(base)
        for window in _windows(text):
            found += [span for span in self.decode(window, min_margin) if not in_base(span[1], span[2])]
        return found


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _posteriors(window: Lattice, inside: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward sums over all segmentations: probability of each span and kind, and of each outside token."""
    n = len(window.tokens)
    ends: list[list[int]] = [[] for _ in range(n + 1)]
    starts: list[list[int]] = [[] for _ in range(n + 1)]
    sums = np.logaddexp.reduce(inside, axis=1)
    for s, (i, j) in enumerate(window.spans):
        ends[j].append(s)
        starts[i].append(s)
    ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        ahead[j] = _log_sum([ahead[j - 1] + outside[j - 1], *(ahead[window.spans[s][0]] + sums[s] for s in ends[j])])
    for i in range(n - 1, -1, -1):
        behind[i] = _log_sum([behind[i + 1] + outside[i], *(behind[window.spans[s][1]] + sums[s] for s in starts[i])])
    whole = ahead[n]
    edges = np.array([ahead[i] + behind[j] - whole for i, j in window.spans])
    tokens = np.array([ahead[t] + outside[t] + behind[t + 1] - whole for t in range(n)])
    return np.exp(edges[:, None] + inside), np.exp(tokens)


def train_field(
    examples: list[tuple[str, list[Span]]], epochs: int = 8, rate: float = 0.3, strict: bool = False
) -> SegmentField:
    """Conditional likelihood by adaptive gradient steps; examples are texts with their spans. None: a field of zeros.

    A window that holds a span outside its lattice teaches nothing, since it would teach the span as outside; ``strict``
    raises instead.
    """
    k = len(KINDS)
    weights = np.zeros((BUCKETS, k + 1))
    scale = np.full((BUCKETS, k + 1), 1e-2)
    data = []
    for text, spans in examples:
        known: set[tuple[int, int]] = set()
        for window in map(Lattice.of, _windows(text)):
            places = {(window.tokens[i][1], window.tokens[j - 1][2]): s for s, (i, j) in enumerate(window.spans)}
            known |= places.keys()
            first, last = (window.tokens[0][1], window.tokens[-1][2]) if window.tokens else (0, 0)
            lost = any(start < last and first < end and (start, end) not in places for _, start, end in spans)
            if lost or not window.spans:
                continue
            features = window.span_features, window.token_features
            gold = np.zeros((len(window.spans), k))
            out = np.ones(len(window.tokens))
            for kind, start, end in spans:
                if (s := places.get((start, end))) is not None:
                    gold[s, KINDS.index(kind)] = 1
                    out[window.spans[s][0] : window.spans[s][1]] = 0
            data.append((window, features, gold, out))
        if strict and (lost_spans := [text[start:end] for _, start, end in spans if (start, end) not in known]):
            raise ValueError(f"not in the lattice: {lost_spans}")
    field = SegmentField(weights)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for at in order.permutation(len(data)):
            window, (spans, tokens), gold, out = data[at]
            inside, outside = _posteriors(window, *field.scores(spans, tokens))
            step = np.zeros_like(weights)
            np.add.at(step[:, :k], spans.ravel(), np.repeat(gold - inside, spans.shape[1], axis=0))
            np.add.at(step[:, k], tokens.ravel(), np.repeat(out - outside, tokens.shape[1]))
            touched = np.unique(np.concatenate([spans.ravel(), tokens.ravel()]))
            gradient = step[touched] - 1e-3 * weights[touched]
            scale[touched] += gradient**2
            weights[touched] += rate * gradient / np.sqrt(scale[touched])
    return field


def rewrite(kind: str, text: str, choice: int) -> str:
    """Another way to write an entity; ``choice`` picks one."""
    if kind == "email":
        if choice % 2:  # names and hosts without their numbers
            text = re.sub(r"[._%+-]?[0-9]+(?=[@.])", "", text) if text[0].isalpha() else text
        if choice % 3 == 1:  # a host of two labels
            text = re.sub(r"@[^.]+\.(?=.*\.)", "@", text)
        name, _, host = text.partition("@")
        choice //= 2
        at, dot = ((" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" @ ", "."))[choice % 5]
        return name + at + host.replace(".", dot)
    if kind == "ip":
        return text.replace(".", ("[.]", "(.)", " . ")[choice % 3])
    if kind == "card":
        digits = _digits(text)
        return (".", "/", "  ", " - ")[choice % 4].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    bare = text.lstrip("+")
    digits = _digits(text)
    plain = (bare, f"00{bare}", f"00 {bare}", bare.replace(" ", "-"), bare.replace(" ", "."), f"({digits[:3]}) {digits[3:6]} {digits[6:]}")
    return plain[choice % len(plain)]


def training_examples(text: str, spans: list[Span], choice: int) -> list[tuple[str, list[Span]]]:
    """A window of text as it is and with its spans rewritten; overlapping spans keep the first."""
    kept, last = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= last:
            kept.append((kind, start, end))
            last = end
    found = [(text, kept)]
    for time in range(VERSIONS if kept else 0):
        changed, moved, last = "", [], 0
        for n, (kind, start, end) in enumerate(kept):
            changed += text[last:start]
            new = rewrite(kind, text[start:end], choice + n + time)
            moved.append((kind, len(changed), len(changed) + len(new)))
            changed, last = changed + new, end
        found.append((changed + text[last:], moved))
    return found


def learn_field(
    docs: DataFrame, text: str = "text", sample_windows: int = 250
) -> SegmentField:
    """Train on at most ``sample_windows`` windows with and without base spans each, chosen by hash from all documents."""
    margin = 60

    def cut(value: str, wanted: Callable[[bool, str], bool]) -> Iterator[tuple[bool, str]]:
        spans = base_pii(value)
        for _, start, end in spans:
            if end - start <= 80:
                yield True, value[max(0, start - margin) : end + margin]
        near = span_check(spans, margin)
        for m in _TRIGGER.finditer(value):
            if not near(m.start(), m.end()):
                yield False, value[max(0, m.start() - margin) : m.end() + margin]

    chosen = labelled_samples(docs, text, cut, sample_windows)
    examples = []
    for marked in (True, False):
        for part in chosen[marked]:
            examples += training_examples(part, base_pii(part), zlib.crc32(part.encode()))
    return train_field(examples)


def scan_pii(docs: DataFrame, field: SegmentField, text: str = "text", result: str = "spans") -> DataFrame:
    """Add an array of spans (kind, start, end, base) of each whole text, in code points, by kind and start.

    A null or empty text has none. Base spans stay as they are; the field adds spans that overlap none of them.
    """
    weights = field.weights.astype("float32")

    @pandas_udf(SPANS)
    def scan(texts: pd.Series) -> pd.Series:
        model = SegmentField(weights)
        found = []
        for value in texts:
            base = base_pii(value) if value else []
            added = model.added(value, base) if value and (_TRIGGER.search(value)) else []
            found.append(span_rows(base, added, lambda s: (KINDS.index(s[0]), s[1])))
        return pd.Series(found)

    return docs.withColumn(result_name(docs, result), scan(F.col(f"`{text}`")))

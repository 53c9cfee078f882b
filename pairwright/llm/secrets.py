"""Secret scans: fixed patterns, and strings that look random to character Markov models.

Two second-order character models are trained from labelled samples: values that the fixed patterns mark as secrets, and
ordinary words and identifiers of the same documents. A candidate is a long run of key characters with letters and digits.
It is reported if its log-likelihood ratio a character is above zero by a margin. Strings that look random without a label
do not count as ordinary.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from pairwright.llm.common import SPANS, Span, labelled_samples, result_name, span_check, span_rows

# Kinds, patterns and lengths of the base scan.
KINDS = ("assign", "access", "hex", "markov")
_ASSIGN = re.compile(
    r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs of 24 or more
ASSIGN_VALUE, ACCESS_CHARS, HEX_CHARS = 6, 20, 24

_KEYWORDS = ("passw", "secret", "token", "api")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{20,}")
_ORDINARY = re.compile(r"(?<![A-Za-z0-9_])(?=[0-9_]*[A-Za-z])[A-Za-z0-9_]{4,}")  # numbers alone are neither of the labels
_DIGIT, _LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
FOLDS = 5  # parts of the ordinary strings, each held out once
_TELLABLE_CHARS = 8  # letters alone of fewer characters tell too little to be called random


def base_secrets(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and not overlapping within a kind; matches that are too short are dropped."""
    found: list[Span] = []
    folded = text.lower()
    if any(k in folded for k in _KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    if max(map(len, text.split()), default=0) >= HEX_CHARS:  # a run holds no white space
        found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def _trigrams(word: str) -> Iterator[tuple[str, str]]:
    """Contexts of two characters and the next one; other characters than letters and digits part a string."""
    for part in re.split(r"[^A-Za-z0-9]+", word):
        padded = f"^^{part}"
        for i in range(len(part)):
            yield padded[i : i + 2], padded[i + 2]


@dataclass(frozen=True)
class CharModel:
    """Second-order character model, backed off to single characters and to a uniform choice."""

    pairs: dict[tuple[str, str], int]
    contexts: dict[str, int]
    singles: dict[str, int]
    total: int

    @classmethod
    def train(cls, words: list[str]) -> CharModel:
        pairs = Counter(x for w in words for x in _trigrams(w))
        contexts, singles = Counter(), Counter()
        for (context, char), n in pairs.items():
            contexts[context] += n
            singles[char] += n
        return cls(dict(pairs), dict(contexts), dict(singles), sum(singles.values()))

    def log_probability(self, context: str, char: str, weight: float = 4.0) -> float:
        single = (self.singles.get(char, 0) + 62 * 0.05 / 62) / (self.total + 62 * 0.05)
        single = 0.97 * single + 0.03 / 62
        return math.log((self.pairs.get((context, char), 0) + weight * single) / (self.contexts.get(context, 0) + weight))


@dataclass(frozen=True)
class RandomnessTest:
    """The ratio of both models for each trigram seen in training or not, and the bound on its mean over a string."""

    random: CharModel
    ordinary: CharModel
    bound: float
    known: dict[tuple[str, str], float] = field(default_factory=dict, compare=False, repr=False)

    def step(self, trigram: tuple[str, str]) -> float:
        """Log-likelihood ratio of a character after its context; there are few, so each is kept."""
        if (value := self.known.get(trigram)) is None:
            value = self.random.log_probability(*trigram) - self.ordinary.log_probability(*trigram)
            self.known[trigram] = value
        return value

    def ratio(self, word: str) -> float:
        """Mean log-likelihood ratio of a string: positive if it is more like a random one."""
        total, count = 0.0, 0
        for trigram in _trigrams(word):
            total, count = total + self.step(trigram), count + 1
        return total / count if count else -math.inf

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Further spans of a text that overlap no base span."""
        if not _DIGIT.search(text):
            return []
        found, in_base = [], span_check(base)
        for m in _CANDIDATE.finditer(text):
            word = m[0]
            if in_base(m.start(), m.end()) or not (_DIGIT.search(word) and _LETTER.search(word)):
                continue
            if self.ratio(word) > self.bound:
                found.append(("markov", m.start(), m.end()))
        return found


def _tellable(word: str) -> bool:
    return len(word) >= _TELLABLE_CHARS or (_DIGIT.search(word) is not None and _LETTER.search(word) is not None)


def fit_randomness(random: list[str], ordinary: list[str], margin: float = 0.5, rounds: int = 3) -> RandomnessTest:
    """Train both models. The bound is zero, where both are as likely, plus ``margin`` for each character.

    Ordinary strings are all that no fixed pattern marks, so secrets without a label are among them. In each round a string
    is held against a model of the other folds, and one that looks random leaves the ordinary ones. No single string moves
    the bound. Random characters of a uniform alphabet stand beside the labelled secrets in equal number, since secrets of
    a corpus may all be of one alphabet. Without samples the uniform parts decide.
    """
    random, ordinary = sorted(set(random)), sorted(set(ordinary))
    base = CharModel.train(random)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    singles = Counter(base.singles) + Counter({c: max(1, base.total // 62) for c in alphabet})
    mixed = CharModel({}, {}, dict(singles), sum(singles.values()))
    folds = [ordinary[i::FOLDS] for i in range(FOLDS)]
    kept = folds
    for _ in range(rounds):
        left = []
        for i, fold in enumerate(folds):
            test = RandomnessTest(mixed, CharModel.train([w for j, x in enumerate(kept) if j != i for w in x]), 0.0)
            left.append([w for w in fold if not (_tellable(w) and test.ratio(w) > test.bound)])
        if left == kept:
            break
        kept = left
    return RandomnessTest(mixed, CharModel.train([w for x in kept for w in x]), margin)


def learn_randomness(
    docs: DataFrame, text: str = "text", sample_strings: int = 20_000
) -> RandomnessTest:
    """Fit the test on at most ``sample_strings`` strings of each label, chosen by hash from those of all documents."""

    def label(value: str, wanted: Callable[[bool, str], bool]) -> Iterator[tuple[bool, str]]:
        spans = base_secrets(value)
        for kind, start, end in spans:
            match = _ASSIGN.match(value, start) if kind == "assign" else None
            yield True, match[2] if match else value[start:end]
        if spans:
            near = span_check(spans)
            words = {m[0] for m in _ORDINARY.finditer(value) if not near(m.start(), m.end())}
        else:
            words = set(_ORDINARY.findall(value))
        for word in words:
            yield False, word[:64]

    chosen = labelled_samples(docs, text, label, sample_strings)
    return fit_randomness(chosen[True], chosen[False])


def scan_secrets(docs: DataFrame, test: RandomnessTest, text: str = "text", result: str = "spans") -> DataFrame:
    """Add an array of spans (kind, start, end, base) of each whole text, in code points, by start and kind.

    A null or empty text has none. Equal texts have equal spans; a text of any length is scanned in one pass.
    """

    @pandas_udf(SPANS)
    def scan(texts: pd.Series) -> pd.Series:
        found = []
        for value in texts:
            base = base_secrets(value) if value else []
            added = test.added(value, base) if value else []
            found.append(span_rows(base, added, lambda s: (s[1], KINDS.index(s[0]))))
        return pd.Series(found)

    return docs.withColumn(result_name(docs, result), scan(F.col(f"`{text}`")))

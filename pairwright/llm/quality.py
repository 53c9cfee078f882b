"""Quality rules: decision lists of threshold conditions, learned from labelled documents.

Text statistics are one vectorised function of the text. The rules are learned by sequential covering on the statistics of
a bounded sample of labelled documents: a rule is grown condition by condition on one part of the sample, pruned on the
other, kept if it is precise enough there, and the documents that it covers leave the sample. The result is an ordered list
that becomes one conditional Spark expression, so deciding is a plain projection over all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from pairwright.llm.common import SPACES, ascii_words, columns_of, free_name

SYMBOLS = "#*$%&|<>"
WINDOW = 5
COUNTS = (
    "n_chars", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_distinct_words", "n_upper", "n_digits", "n_marks", "n_top_word",
)
COUNTS_TYPE = T.StructType([T.StructField(name, T.LongType()) for name in COUNTS])


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that the text has at least twice, the first occurrence included."""
    if len(words) <= window:
        return 0
    grams = list(zip(*(words[i:] for i in range(window))))
    if len(set(grams)) == len(grams):
        return 0
    counts = Counter(grams)
    covered, end = 0, 0
    for start, gram in enumerate(grams):
        if counts[gram] > 1:
            covered += start + window - max(start, end)
            end = start + window
    return covered


def text_counts(text: str | None) -> tuple[int, ...]:
    """The statistics named in ``COUNTS`` of one whole text; null counts as empty."""
    if not text:
        return (0,) * len(COUNTS)
    words = ascii_words(text)
    seen: set[str] = set()
    duplicates = 0
    lines = text.split("\n")
    for line in lines:
        if line in seen and line.strip(SPACES):
            duplicates += 1
        seen.add(line)
    encoded = text.encode("utf-8", "replace")
    letters = np.frombuffer(encoded, np.uint8)
    tally = np.bincount(letters, minlength=256)
    top = max(Counter(words).values(), default=0)
    return (
        len(text),
        len(words),
        len(text) - sum(int(tally[ord(c)]) for c in SPACES),
        sum(int(tally[ord(c)]) for c in SYMBOLS),
        len(lines),
        duplicates,
        repeated_words(words),
        len(set(words)),
        int(tally[65:91].sum()),
        int(tally[48:58].sum()),
        sum(int(tally[ord(c)]) for c in "!?;:"),
        top,
    )


@pandas_udf(COUNTS_TYPE)
def _text_counts(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_counts(t) for t in text], columns=list(COUNTS), dtype="int64")


def with_counts(df: DataFrame, name: str, text: str = "text") -> DataFrame:
    """Add a struct of the statistics of each whole text."""
    return df.withColumn(name, _text_counts(F.col(f"`{text}`")))


def ratios(counts: Column) -> dict[str, Column]:
    """Features the rules test, from the statistics. All are defined for empty texts."""
    per_word = F.greatest(counts["n_words"], F.lit(1))
    per_char = F.greatest(counts["word_chars"], F.lit(1))
    per_line = F.greatest(counts["n_lines"], F.lit(1))
    return {
        "words": counts["n_words"].cast("double"),
        "word_length": counts["word_chars"] / per_word,
        "symbol_share": counts["n_symbols"] / per_char,
        "symbols_per_word": counts["n_symbols"] / per_word,
        "duplicate_line_share": counts["n_dup_lines"] / per_line,
        "repeat_share": counts["n_repeat_words"] / per_word,
        "distinct_share": counts["n_distinct_words"] / per_word,
        "upper_share": counts["n_upper"] / per_char,
        "digit_share": counts["n_digits"] / per_char,
        "mark_share": counts["n_marks"] / per_char,
        "top_word_share": counts["n_top_word"] / per_word,
        "words_per_line": counts["n_words"] / per_line,
    }


@dataclass(frozen=True)
class Condition:
    """``feature >= value`` when ``above``, otherwise ``feature <= value``."""

    feature: str
    above: bool
    value: float

    def mask(self, columns: dict[str, np.ndarray]) -> np.ndarray:
        values = columns[self.feature]
        return values >= self.value if self.above else values <= self.value

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.value:.6g}"


@dataclass(frozen=True)
class Rule:
    """Conjunction of conditions; documents that meet all of them are rejected."""

    conditions: tuple[Condition, ...]

    def mask(self, columns: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([c.mask(columns) for c in self.conditions])

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules. The first that holds decides; documents that meet none are kept."""

    rules: tuple[Rule, ...] = field(default_factory=tuple)

    def keeps(self, features: dict[str, Column]) -> Column:
        """The list as one ordered conditional expression: true for documents to keep."""
        verdict = None
        for rule in self.rules:
            holds = F.lit(True)
            for c in rule.conditions:
                column = features[c.feature]
                holds = holds & ((column >= F.lit(c.value)) if c.above else (column <= F.lit(c.value)))
            verdict = F.when(holds, False) if verdict is None else verdict.when(holds, False)
        return F.lit(True) if verdict is None else verdict.otherwise(True)

    def __str__(self) -> str:
        return "\n".join([*(f"reject if {rule}" for rule in self.rules), "else keep"])


def _gain(p: np.ndarray, n: np.ndarray, p0: int, n0: int) -> np.ndarray:
    """Information gain of a condition that leaves p and n of p0 bad and n0 good documents."""
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = p * (np.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
    return np.where(p > 0, gain, -np.inf)


def _best_condition(columns: dict[str, np.ndarray], bad: np.ndarray, cuts: int) -> tuple[float, Condition | None]:
    p0, n0 = int(bad.sum()), int((~bad).sum())
    best: tuple[float, Condition | None] = (1e-9, None)
    for name in sorted(columns):
        values = columns[name]
        edges = np.unique(np.quantile(values, np.linspace(0, 1, cuts)))
        order = np.argsort(values, kind="stable")
        ranked, totals = values[order], np.concatenate([[0], np.cumsum(bad[order])])
        lower, upper = np.searchsorted(ranked, edges, "left"), np.searchsorted(ranked, edges, "right")
        for above, p, size in ((True, p0 - totals[lower], len(values) - lower), (False, totals[upper], upper)):
            gain = _gain(p, size - p, p0, n0)
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (float(gain[i]), Condition(name, above, float(edges[i])))
    return best


def learn_rules(
    columns: dict[str, np.ndarray],
    bad: np.ndarray,
    min_precision: float = 0.95,
    min_support: int = 3,
    max_conditions: int = 5,
    max_rules: int = 24,
    cuts: int = 128,
) -> DecisionList:
    """Sequential covering. Two thirds of the rows grow rules, every third prunes and judges them.

    No rows, or rows of one class only, give the empty list, which keeps everything.
    """
    bad = np.asarray(bad, bool)
    if not bad.any() or bad.all():
        return DecisionList()
    judges = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        grow, judge = left & ~judges, left & judges
        conditions: list[Condition] = []
        while len(conditions) < max_conditions and bad[grow].any() and (~bad[grow]).any():
            gain, condition = _best_condition({k: v[grow] for k, v in columns.items()}, bad[grow], cuts)
            if condition is None or gain <= 0:
                break
            conditions.append(condition)
            grow &= condition.mask(columns)
        if not conditions:
            break
        best, worth = None, -math.inf
        for k in range(1, len(conditions) + 1):
            covered = Rule(tuple(conditions[:k])).mask(columns) & judge
            p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
            if p + n and (p - n) / (p + n) > worth:
                best, worth = Rule(tuple(conditions[:k])), (p - n) / (p + n)
        if best is None:
            break
        covered = best.mask(columns) & left
        p, n = int((covered & judge & bad).sum()), int((covered & judge & ~bad).sum())
        whole = int((covered & bad).sum()) / max(1, int(covered.sum()))
        if p < min_support or p / (p + n) < min_precision or whole < min_precision:
            break
        rules.append(best)
        left &= ~covered
    return DecisionList(tuple(rules))


def fit_quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_labelled: int = 20_000,
    **options: float,
) -> DecisionList:
    """Learn a decision list from labelled documents (label 1: good, 0: bad).

    At most ``max_labelled`` labels are used, those with the smallest hash of key and label; only statistics of those
    documents, at most two rows a key, come to the driver. Labels or keys that are null don't count.
    """
    sample = (
        labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
        .where(F.col("_key").isNotNull() & F.col("_label").isNotNull())
        .distinct()
        .orderBy(F.xxhash64("_key", "_label"), "_key", "_label")
        .limit(max_labelled)
    )
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    marked = with_counts(texts.join(F.broadcast(sample), "_key"), "_counts", "_text")  # at most max_labelled rows are sent
    rows = (
        marked.groupBy("_key", "_label")
        .agg(F.min("_counts").alias("_counts"))
        .select("_key", "_label", *[c.alias(name) for name, c in ratios(F.col("_counts")).items()])
        .toPandas()
    )
    if rows.empty:
        return DecisionList()
    rows["_order"] = pd.util.hash_pandas_object(rows[["_key", "_label"]], index=False)
    rows = rows.sort_values(["_order", "_key", "_label"])
    names = [c for c in rows.columns if not c.startswith("_")]
    return learn_rules(
        {name: rows[name].to_numpy(float) for name in names}, (rows["_label"] == 0).to_numpy(), **options
    )


def base_failed(counts: Column) -> Column:
    """Too few words, or more than a fifth of the words inside repeated windows."""
    return (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])


def quality_verdicts(docs: DataFrame, rules: DecisionList, text: str = "text", result: str = "quality") -> DataFrame:
    """Add a struct of the statistics, ``base_failed`` and ``kept`` to every document, as the last column.

    Null and empty texts have no words and fail the base rule. Repeated rows get equal verdicts; other columns stay as they
    are, also those named like the result, which then has underscores before its name.
    """
    result, counts, failed = free_name(docs, result, "counts", "failed")
    counted = with_counts(docs, counts, text).withColumn(failed, base_failed(F.col(counts)))
    kept = ~F.col(failed) & rules.keeps(ratios(F.col(counts)))
    fields = [F.col(counts)[name].alias(name) for name in COUNTS]
    judged = F.struct(*fields, F.col(failed).alias("base_failed"), kept.alias("kept"))
    return counted.withColumn(result, judged).select(*columns_of(docs), result)

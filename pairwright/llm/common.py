"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairwright.session import materialize

SPACES = " \t\n\r\x0b\x0c"  # \x20 and \x09-\x0D, what bytes.split() without arguments splits at


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8, split at ASCII white space. A lone surrogate becomes a question mark."""
    return text.encode("utf-8", "replace").split() if text else []


def text_key(column: str = "text") -> list[Column]:
    """Two independent 64-bit hashes of a text; null and empty differ."""
    text = F.col(f"`{column}`")
    missing = text.isNull()
    return [F.xxhash64(text, missing), F.xxhash64(F.lit(1), text, missing)]


def free_name(df: DataFrame, *names: str) -> list[str]:
    """Column names that the frame does not have yet, for working columns."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def result_name(df: DataFrame, name: str) -> str:
    """Name of a result column: as asked for, with underscores before it where the frame has one of that name."""
    return free_name(df, name)[0]


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of a frame, whatever characters their names have."""
    return [F.col(f"`{name.replace('`', '``')}`") for name in df.columns]


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("base", T.BooleanType()),
        ]
    )
)

Span = tuple[str, int, int]


def span_rows(base: list[Span], added: list[Span], order: Callable[[Span], tuple]) -> list[dict]:
    """Spans as rows of the ``SPANS`` type, in the given order."""
    marked = [(s, True) for s in base] + [(s, False) for s in added]
    return [
        {"kind": kind, "start": start, "end": end, "base": is_base}
        for (kind, start, end), is_base in sorted(marked, key=lambda x: order(x[0]))
    ]


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_digest(spans: Column) -> Column:
    return F.sha2(joined_spans(F.filter(spans, lambda s: s["base"])), 256)


def base_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")


class HashSample:
    """The ``limit`` distinct values of the smallest hashes among all that are added."""

    def __init__(self, limit: int) -> None:
        self.limit, self.top = limit, 1 << 63
        self.kept: dict[str, int] = {}

    def wanted(self, value: str) -> bool:
        """Whether the value would be new in the sample."""
        return value not in self.kept and text_hash(value) < self.top

    def add(self, value: str) -> None:
        if value in self.kept or (place := text_hash(value)) >= self.top:
            return
        self.kept[value] = place
        if len(self.kept) > self.limit + self.limit // 4 + 8:
            self.cut()

    def cut(self) -> None:
        self.kept = dict(sorted(self.kept.items(), key=lambda x: (x[1], x[0]))[: self.limit])
        if len(self.kept) == self.limit:
            self.top = max(self.kept.values(), default=-1) + 1


def text_hash(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode("utf-8", "replace")) >> 1


Label = Callable[[str, Callable[[bool, str], bool]], Iterable[tuple[bool, str]]]


def labelled_samples(rows: DataFrame, text: str, label: Label, limit: int) -> dict[bool, list[str]]:
    """For each label at most ``limit`` distinct values, chosen by hash from those that ``label`` finds in all texts.

    ``label`` gets a text, and a function that tells whether a value of a label could still be chosen; it may leave out
    values that could not. Each task keeps its own samples, so what leaves it is bounded whatever the number of labels.
    """

    def pick(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = {mark: HashSample(limit) for mark in (True, False)}
        for part in parts:
            for value in part.column(0).to_pylist():
                if value:
                    for mark, found in label(value, lambda m, v: samples[m].wanted(v)):
                        samples[mark].add(found)
        for mark, sample in samples.items():
            sample.cut()
            values = [pa.array([mark] * len(sample.kept), pa.bool_()), pa.array(sample.kept.keys(), pa.string())]
            yield pa.RecordBatch.from_arrays([*values, pa.array(sample.kept.values(), pa.int64())], ["mark", "value", "place"])

    found = rows.select(F.col(f"`{text}`").alias("text")).mapInArrow(pick, "mark boolean, value string, place long")
    found = materialize(found, "labelled")
    chosen = {}
    for mark in (True, False):
        kept = found.where(F.col("mark") == mark).select("place", "value").distinct()
        near = least_places(kept, F.col("place"), limit)
        chosen[mark] = [r.value for r in near.orderBy("place", "value").limit(limit).collect()]  # at most limit rows
    return chosen


def least_places(rows: DataFrame, place: Column, limit: int) -> DataFrame:
    """The rows that can be among the ``limit`` of the smallest places, a hash of at least 0: about twice as many at most.

    Rows are counted by the binary length of their place, so the driver gets 64 counts, and no task sorts or sends more than
    its part of the rows that are left. Rows of equal place stay or go together.
    """
    length = F.length(F.bin(place))
    counts = {r.length: r.n for r in rows.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, last = 0, 0
    for last in sorted(k for k in counts if k is not None):
        before += counts[last]
        if before >= limit:
            break
    return rows.where(length <= last)


def batched(lists: pa.Array, dims: int) -> np.ndarray:
    """An Arrow array of integer lists of one length as a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def span_check(spans: list[Span], margin: int = 0) -> Callable[[int, int], bool]:
    """A function that tells whether a range is within ``margin`` of a span; it is asked for ranges in text order."""
    ordered = sorted((start, end) for _, start, end in spans)
    at, reach = 0, -margin - 1

    def near(start: int, end: int) -> bool:
        nonlocal at, reach
        while at < len(ordered) and ordered[at][0] - margin < end:
            reach = max(reach, ordered[at][1])
            at += 1
        return start < reach + margin

    return near

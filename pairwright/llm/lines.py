"""Line dedup: levelled sorted runs of line hashes.

Each batch of documents is reduced to one row per line key with the number of documents that hold it. A batch first
anti-joins the runs of keys already known to be frequent, which need no more counting, and what is left becomes a sorted
run of level 0. When a level has ``fanout`` runs they are merged into one run of the next level; keys that reach the
threshold in a merge move to a run of frequent keys. So a row is rewritten at most once a level, and the number of runs
grows with the logarithm of the number of batches.

Runs hold only 16-byte hashes and counts. The lines of very common keys are counted before any shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from pairwright.llm.common import SPACES, columns_of, free_name, result_name, text_key
from pairwright.session import materialize, remove, scratch_path

RUN_SCHEMA = "k1 long, k2 long, n long"
BROADCAST_KEYS = 200_000  # keys sent to every task at most: 16 bytes each, some 30 MB as a set
_SIGN = 1 << 63

Key = tuple[int, int]


def line_key(line: str, min_chars: int = 1) -> Key | None:
    """128-bit hash of a line without white space at its ends and with A-Z in lower case. None: shorter than allowed."""
    line = line.strip(SPACES)
    if len(line) < min_chars:
        return None
    h = xxhash.xxh128_intdigest(line.encode("utf-8", "replace").lower())
    return ((h >> 64) - _SIGN, (h & (2 * _SIGN - 1)) - _SIGN)


def line_keys(text: str | None, min_chars: int = 1) -> list[Key | None]:
    return [line_key(line, min_chars) for line in (text or "").split("\n")]


def batch_counts(docs: DataFrame, key: str, text: str, batches: int, min_chars: int) -> DataFrame:
    """Rows (batch, k1, k2, n): documents of a batch that hold a key. Documents are dealt to batches by their id."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found: Counter[tuple[int, int, int]] = Counter()
            for batch, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                found.update((batch, *k) for k in set(line_keys(value, min_chars)) if k)
            rows = list(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in ((0, pa.int32()), (1, pa.int64()), (2, pa.int64()))]
                + [pa.array(list(found.values()), pa.int64())],
                ["batch", "k1", "k2", "n"],
            )

    batch = F.pmod(F.xxhash64(F.col(key)), F.lit(batches)).cast("int")
    rows = docs.select(batch.alias("batch"), F.col(text).alias("text")).mapInArrow(count, f"batch int, {RUN_SCHEMA}")
    return rows.groupBy("batch", "k1", "k2").agg(F.sum("n").alias("n"))


class LineRuns:
    """The runs of one store: levels of counted keys, and runs of keys that are in at least ``min_docs`` documents."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2) -> None:
        if min_docs < 1 or fanout < 2:
            raise ValueError("min_docs must be 1 or more and fanout 2 or more")
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[str]] = []
        self.frequent: list[str] = []

    def _write(self, rows: DataFrame, name: str) -> str:
        path = scratch_path(self.spark, name)
        rows.sortWithinPartitions("k1", "k2").write.parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).parquet(*paths)

    def add(self, batch: DataFrame) -> None:
        """Count one batch: rows (k1, k2, n) with distinct keys."""
        fresh = batch.select("k1", "k2", "n")
        if self.frequent:
            fresh = fresh.join(self._read(self.frequent), ["k1", "k2"], "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(fresh, "line-run"))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._merge(level)
            level += 1

    def _merge(self, level: int) -> None:
        """Merge the runs of a level into one of the next."""
        old = self.levels[level]
        merged = self._read(old).groupBy("k1", "k2").agg(F.sum("n").alias("n"))
        path = self._write(merged, "line-merge")
        rows = self._read([path])
        self.frequent.append(self._write(rows.where(F.col("n") >= self.min_docs), "line-frequent"))
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.levels[level + 1].append(self._write(rows.where(F.col("n") < self.min_docs), "line-run"))
        self.levels[level] = []
        for path in [*old, path]:
            remove(self.spark, path)

    def frequent_keys(self) -> DataFrame:
        """Keys (k1, k2) in at least ``min_docs`` documents of all batches; what the levels hold is merged for it."""
        rest = [path for level in self.levels for path in level]
        merged = self._read(rest).groupBy("k1", "k2").agg(F.sum("n").alias("n")).where(F.col("n") >= self.min_docs)
        return self._read(self.frequent).select("k1", "k2").unionByName(merged.select("k1", "k2"))


_DROPPED = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
)


def _drop(text: str | None, keys: set[Key], min_chars: int) -> tuple[str | None, int, int]:
    if text is None:
        return None, 1, 0
    lines = text.split("\n")
    kept = [line for line in lines if line_key(line, min_chars) not in keys]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def _with_known(keys: set[Key], min_chars: int) -> Callable[[Column], Column]:
    """A column function that drops the lines of a bounded set of keys, which goes with the task."""
    sent = SparkSession.active().sparkContext.broadcast(keys)

    @pandas_udf(_DROPPED)
    def drop(text: pd.Series) -> pd.DataFrame:
        known = sent.value
        return pd.DataFrame([_drop(t, known, min_chars) for t in text], columns=["text", "n_lines", "n_dropped"])

    return drop


def _with_hits(min_chars: int) -> Callable[[Column, Column], Column]:
    @pandas_udf(_DROPPED)
    def drop(text: pd.Series, hits: pd.Series) -> pd.DataFrame:
        rows = [
            _drop(t, {(int(k["k1"]), int(k["k2"])) for k in h} if h is not None else set(), min_chars)
            for t, h in zip(text, hits)
        ]
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    return drop


def _text_lines(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """Rows (t1, t2, k1, k2): the distinct keys of each text."""

    def split(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [
                (a, b, *k)
                for a, b, value in zip(*(part.column(i).to_pylist() for i in range(3)))
                for k in set(line_keys(value, min_chars))
                if k
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], ["t1", "t2", "k1", "k2"]
            )

    t1, t2 = text_key(text)
    rows = docs.select(t1.alias("t1"), t2.alias("t2"), F.col(text).alias("text"))
    return rows.mapInArrow(split, "t1 long, t2 long, k1 long, k2 long")


def drop_frequent_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = 4,
    fanout: int = 2,
    broadcast_keys: int = BROADCAST_KEYS,
    result: str = "lines",
) -> DataFrame:
    """Add a struct (text, n_lines, n_dropped): each text without the lines whose key is in ``min_docs`` documents.

    A document counts once for a key, each row is a document (repeated rows count), and empty keys are never dropped. A
    null text is one empty line and stays null; a text that loses all its lines becomes empty. The struct is the last column; a
    name in use gets underscores before it. Frequent keys are sent to
    the tasks when there are at most ``broadcast_keys`` of them. Otherwise texts join the keys that hit them, by text.
    """
    result = result_name(docs, result)
    spark = docs.sparkSession
    path = scratch_path(spark, "line-batches")
    batch_counts(docs, key, text, batches, min_chars).write.partitionBy("batch").parquet(path)
    counts = spark.read.schema(f"{RUN_SCHEMA}, batch int").parquet(path)
    runs = LineRuns(spark, min_docs, fanout)
    for batch in range(batches):
        runs.add(counts.where(F.col("batch") == batch))
    keys = materialize(runs.frequent_keys(), "line-keys")
    remove(spark, path)
    if keys.count() <= broadcast_keys:
        known = {(row.k1, row.k2) for row in keys.collect()}  # at most broadcast_keys rows
        return docs.withColumn(result, _with_known(known, min_chars)(F.col(f"`{text}`")))
    hits = (
        _text_lines(docs, text, min_chars)
        .join(keys, ["k1", "k2"], "left_semi")
        .groupBy("t1", "t2")
        .agg(F.collect_set(F.struct("k1", "k2")).alias("hits"))
    )
    a, b, c = free_name(docs, "_t1", "_t2", "_hits")
    t1, t2 = text_key(text)
    hits = hits.select(F.col("t1").alias(a), F.col("t2").alias(b), F.col("hits").alias(c))
    joined = docs.withColumn(a, t1).withColumn(b, t2).join(hits, [a, b], "left")
    return joined.withColumn(result, _with_hits(min_chars)(F.col(f"`{text}`"), F.col(c))).select(*columns_of(docs), result)

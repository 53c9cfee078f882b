"""Tokenizers inside tasks, and token counts of huge documents by overlap resynchronisation.

A huge document is cut into chunks that overlap. Chunks are encoded on their own, by any task, with the place of each token.
Neighbours are spliced in the overlap at a boundary that both have and that is proven stable: a token ends and the next one
begins where an ASCII space follows a character that is not white space. The supported pre-tokenizers take white space only
at the start of a piece and look at nothing before a piece, so such a place is a boundary in every encoding of the
text, and what follows it does not depend on what comes before. Where an overlap holds none, the overlap is doubled,
until it does or the chunks are one.

The same proof lets ordinary texts be encoded segment by segment, with the segments seen before taken from a table.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from pairwright.llm.common import text_key
from pairwright.session import materialize

KNOWN_SEGMENTS = 150_000  # entries that a task remembers at most, some 200 bytes each. No result depends on it.
CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 256
_UNPROVEN = re.compile(r"\s ")  # a space after white space: a boundary that the proof does not cover


@lru_cache(maxsize=4)
def load_tokenizer(path: str) -> object:
    """The tokenizer of a .json file as the library gives it, one thread, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class SegmentCounts:
    """Token counts of texts by segments that begin with an ASCII space after other characters."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.first: dict[str, int] = {}  # what a text begins with
        self.later: dict[str, int] = {}  # what follows a space

    def _learn(self, known: dict[str, int], wanted: set[str], space: str) -> None:
        if len(known) > KNOWN_SEGMENTS:
            known.clear()
        missing = [w for w in wanted if w not in known]
        for at in range(0, len(missing), 4096):
            part = missing[at : at + 4096]
            encoded = load_tokenizer(self.path).encode_batch_fast([space + w for w in part], add_special_tokens=False)
            known.update(zip(part, map(len, encoded)))

    def __call__(self, texts: list[str]) -> list[int]:
        cut = [None if _UNPROVEN.search(t) else t.split(" ") for t in texts]
        self._learn(self.first, {c[0] for c in cut if c}, "")
        self._learn(self.later, {w for c in cut if c for w in c[1:]}, " ")
        later = self.later.__getitem__
        return [
            self.first[c[0]] + sum(map(later, c[1:])) if c else len(load_tokenizer(self.path).encode(t, add_special_tokens=False))
            for t, c in zip(texts, cut)
        ]


@lru_cache(maxsize=4)
def segment_counts(path: str) -> SegmentCounts:
    """One table of segments a process, kept between tasks."""
    return SegmentCounts(path)


def chunk_places(length: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Start and end of the chunks of a text; each but the last runs ``overlap`` into the next."""
    return [(at, min(length, at + chunk + overlap)) for at in range(0, max(length, 1), chunk)]


def stable_counts(text: str, starts: list[int], begin: int, end: int) -> list[dict[str, int]]:
    """Proven boundaries of an encoded chunk between two places: place and the number of tokens before it."""
    index: dict[int, int] = {}
    for i, start in enumerate(starts):
        index.setdefault(start, i)
    found, at = [], text.find(" ", max(begin, 1), end)
    while at >= 0:
        if not text[at - 1].isspace() and at in index:
            found.append({"p": at, "c": index[at]})
        at = text.find(" ", at + 1, end)
    return found


_EDGE = "array<struct<p:long,c:long>>"


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Rows (t1, t2, k, start, part) of each distinct text, dealt out by chunk."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for a, b, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows = [(k, s, text[s:e]) for k, (s, e) in enumerate(chunk_places(len(text), chunk, overlap))]
                for at in range(0, len(rows), 64):
                    part = rows[at : at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([a] * len(part), pa.int64()), pa.array([b] * len(part), pa.int64())]
                        + [pa.array([r[i] for r in part], t) for i, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.string()))],
                        ["t1", "t2", "k", "start", "part"],
                    )

    cut_rows = texts.mapInArrow(cut, "t1 long, t2 long, k long, start long, part string")
    return cut_rows.dropDuplicates(["t1", "t2", "k"])


def _encode_chunks(chunks: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Rows (t1, t2, k, n, head, tail): tokens of a chunk, and its boundaries in the overlap before and after it."""

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)
        for batch in parts:
            rows = batch.to_pydict()
            counts, heads, tails = [], [], []
            for k, start, text in zip(rows["k"], rows["start"], rows["part"]):
                starts = [s for s, _ in tokenizer.encode(text, add_special_tokens=False).offsets]
                counts.append(len(starts))
                head = stable_counts(text, starts, 0, min(overlap, len(text))) if k else []
                tail = stable_counts(text, starts, chunk, len(text))
                heads.append([{"p": x["p"] + start, "c": x["c"]} for x in head])
                tails.append([{"p": x["p"] + start, "c": x["c"]} for x in tail])
            edge = pa.list_(pa.struct([("p", pa.int64()), ("c", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(3)] + [pa.array(counts, pa.int64()), pa.array(heads, edge), pa.array(tails, edge)],
                ["t1", "t2", "k", "n", "head", "tail"],
            )

    return chunks.mapInArrow(encode, f"t1 long, t2 long, k long, n long, head {_EDGE}, tail {_EDGE}")


def _splice(encoded: DataFrame) -> DataFrame:
    """Rows (t1, t2, n_tokens): tokens of each text, null where two neighbours share no proven boundary."""
    along = Window.partitionBy("t1", "t2").orderBy("k")
    both = F.filter("tail", lambda x: F.exists("next_head", lambda y: x["p"] == y["p"]))
    joint = F.try_element_at("both", F.lit(1))
    begins = F.try_element_at(F.filter("next_head", lambda y: y["p"] == F.col("joint.p")), F.lit(1))["c"]
    ended = (
        encoded.withColumn("next_head", F.lead("head").over(along))
        .withColumn("both", both)
        .withColumn("joint", joint)
        .withColumn("ends", F.when(F.col("next_head").isNull(), F.col("n")).otherwise(F.col("joint.c")))
        .withColumn("next_begins", F.when(F.col("next_head").isNotNull(), begins).otherwise(0))
    )
    lost = F.max(F.col("ends").isNull().cast("int")) == 1
    # what the next chunk holds before the joint is counted by this chunk
    total = F.sum("ends") - F.sum("next_begins")
    return ended.groupBy("t1", "t2").agg(F.when(~lost, total).alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """Rows (key, n_bytes, n_tokens), one for each document; a null text counts as empty.

    Texts of at most ``chunk`` characters are counted in place. Longer ones are cut, and each distinct text is encoded
    once: copies share its count. A splice that fails widens the overlap eightfold for that text alone.
    """
    if not 0 < overlap <= chunk:
        raise ValueError("overlap must be positive and at most chunk")

    @pandas_udf(T.LongType())
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series(segment_counts(path)(texts.tolist()), dtype="int64")

    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), whole.alias("text"))
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    short = rows.where(F.length("text") <= chunk).select("key", n_bytes, counted("text").alias("n_tokens"))
    t1, t2 = text_key()
    huge = rows.where(F.length("text") > chunk).select("key", "text", t1.alias("t1"), t2.alias("t2"))
    found, open_texts = None, huge.select("t1", "t2", "text")
    while True:
        spliced = _splice(_encode_chunks(_chunks(open_texts, chunk, overlap), path, chunk, overlap))
        spliced = materialize(spliced, "token-splices")
        done = spliced.where("n_tokens IS NOT NULL")
        found = done if found is None else found.unionByName(done)
        lost = spliced.where("n_tokens IS NULL").select("t1", "t2")
        if lost.isEmpty():
            break
        overlap *= 8
        chunk = max(chunk, overlap)
        open_texts = huge.select("t1", "t2", "text").join(lost, ["t1", "t2"], "left_semi")
    long = huge.select("key", n_bytes, "t1", "t2").join(found, ["t1", "t2"]).select("key", "n_bytes", "n_tokens")
    return short.unionByName(long)

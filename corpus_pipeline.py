"""From raw documents to packed training sequences, as stages that each write their result before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.llm.common import columns_of, free_name, table
from pairwright.llm.lines import drop_frequent_lines
from pairwright.llm.mixing import mix_sources
from pairwright.llm.packing import pack
from pairwright.llm.quality import fit_quality_rules, quality_verdicts
from pairwright.llm.simhash import keep_one
from pairwright.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Bytes of text that a Python worker is given at a time. Sets memory alone: no result depends on it.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what workers hold by bytes, not by the number of documents, for this and the later stages of the session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or the learned rules go."""
    small_batches(spark)
    rules = fit_quality_rules(docs, table(spark, sf_dir, "labels"))
    judged = quality_verdicts(docs, rules)
    return judged.where(F.col(judged.columns[-1])["kept"]).select(*columns_of(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from every document; ``n_chars`` follows the text."""
    small_batches(spark)
    dropped = drop_frequent_lines(docs)
    text = F.col(dropped.columns[-1])["text"]
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return dropped.withColumns({c: x for c, x in changed.items() if c in docs.columns}).select(*columns_of(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose fingerprints link, the one with the smallest id stays."""
    small_batches(spark)
    return keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it, up to three; one that it does not take goes."""
    small_batches(spark)
    mixed = mix_sources(docs)
    copies = F.col(mixed.columns[-1])["copies"]
    [time] = free_name(mixed, "time")
    times = F.explode(F.array_repeat(F.lit(0), copies.cast("int")))
    return mixed.where(copies > 0).withColumn(time, times).select(*columns_of(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and copies, in sequences of at most 4096 tokens."""
    small_batches(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("key", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the learned rules, the fingerprints or the tokenizer; tests compare run() with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs

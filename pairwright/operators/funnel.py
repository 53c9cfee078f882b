"""Counts of outcomes by score bucket.

All reports come from one aggregation: rows collapse to (bucket, dimensions) before the shuffle, so what moves is as
small as the report.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.functions import ratio

# Lower bounds of the score buckets, upper bound (included) of the last, and the report codes.
LOWER_BOUNDS = (0.00, 0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60)
UPPER_BOUND = 1.00
CATEGORY_CODES = ("01", "02", "03", "04", "05", "06", "07", "08", "09", "10", "11", "12", "13", "14", "15")
AREA_CODES = ("2", "3", "4", "5", "6", "7", "8", "0")
REQUIREMENT_CODES = ("present", "absent")

BUCKETS = tuple(f"{lo:.2f} - {up:.2f}" for lo, up in zip(LOWER_BOUNDS, (*LOWER_BOUNDS[1:], UPPER_BOUND)))
COUNTS = ("all_rows", "mailed", "mailed_applied", "mailed_passed", "unmailed_applied", "unmailed_passed")
DIMENSION_MEASURES = (
    "mailed_applied", "mailed_passed", "mailed_ratio", "unmailed_applied", "unmailed_passed", "unmailed_ratio",
)


@dataclass(frozen=True)
class Flags:
    """Names of the '1'/'0' outcome columns."""

    mailed: str = "mailed"
    applied: str = "applied"
    passed: str = "passed"


def score_bucket(score: Column) -> Column:
    """Bucket label of a score. A missing score counts as 0; a score outside [0, 1] has no bucket."""
    score = F.coalesce(score.cast("double"), F.lit(0.0))
    label = F.when(score < F.lit(LOWER_BOUNDS[0]), F.lit(None).cast("string"))
    for upper, name in zip(LOWER_BOUNDS[1:], BUCKETS):
        label = label.when(score < F.lit(upper), F.lit(name))
    return label.when(score <= F.lit(UPPER_BOUND), F.lit(BUCKETS[-1]))


def _zero_rows(like: DataFrame, dimension: str | None, codes: tuple[str, ...]) -> DataFrame:
    """A row of zero counts for every bucket (and code), so that empty ones show in the report."""
    spine = like.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, BUCKETS))).alias("bucket"))
    if dimension is not None:
        spine = spine.select("bucket", F.explode(F.array(*map(F.lit, codes))).alias(dimension))
    return spine


def score_buckets(df: DataFrame, score: str) -> DataFrame:
    """Number of rows per score bucket, empty buckets included."""
    rows = df.select(score_bucket(F.col(score)).alias("bucket"), F.lit(1).alias("_n")).where("bucket IS NOT NULL")
    zeros = _zero_rows(df, None, ()).select("bucket", F.lit(0).alias("_n"))
    return rows.unionByName(zeros).groupBy("bucket").agg(F.sum("_n").alias("n")).orderBy("bucket")


def funnel_counts(
    df: DataFrame, score: str, flags: Flags, dimensions: list[str], copies: str | None = None
) -> DataFrame:
    """The six outcome counts per bucket and combination of dimensions. ``copies`` holds the weight of a row."""
    weight = F.lit(1).cast("long") if copies is None else F.col(copies).cast("long")
    mailed = F.col(flags.mailed) == "1"
    unmailed = F.col(flags.mailed) != "1"
    applied, passed = F.col(flags.applied) == "1", F.col(flags.passed) == "1"
    conditions = (F.lit(True), mailed, mailed & applied, mailed & passed, unmailed & applied, unmailed & passed)
    return (
        df.withColumn("bucket", score_bucket(F.col(score)))
        .where("bucket IS NOT NULL")
        .groupBy("bucket", *dimensions)
        .agg(*[F.sum(F.when(c, weight).otherwise(F.lit(0))).alias(n) for n, c in zip(COUNTS, conditions)])
    )


def _with_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "mailed_ratio": ratio(F.col("mailed_passed"), F.col("mailed_applied")),
            "unmailed_ratio": ratio(F.col("unmailed_passed"), F.col("unmailed_applied")),
        }
    )


def funnel_all(counts: DataFrame) -> DataFrame:
    """Report over all rows, from :func:`funnel_counts` with any dimensions."""
    zeros = _zero_rows(counts, None, ()).select("bucket", *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    total = counts.select("bucket", *COUNTS).unionByName(zeros).groupBy("bucket").agg(
        *[F.sum(c).alias(c) for c in COUNTS]
    )
    return (
        _with_ratios(total)
        .select("bucket", *COUNTS[:4], "mailed_ratio", *COUNTS[4:], "unmailed_ratio")
        .orderBy("bucket")
    )


def funnel_by(counts: DataFrame, dimension: str, codes: tuple[str, ...]) -> DataFrame:
    """Report per bucket and code of one dimension, one row each; other codes are left out."""
    measures = COUNTS[2:]
    zeros = _zero_rows(counts, dimension, codes).select(
        "bucket", dimension, *[F.lit(0).cast("long").alias(c) for c in measures]
    )
    total = (
        counts.where(F.col(dimension).isin(*codes))
        .select("bucket", dimension, *measures)
        .unionByName(zeros)
        .groupBy("bucket", dimension)
        .agg(*[F.sum(c).alias(c) for c in measures])
    )
    return _with_ratios(total).select("bucket", dimension, *DIMENSION_MEASURES).orderBy("bucket", dimension)


def funnel_wide(report: DataFrame, dimension: str, codes: tuple[str, ...]) -> DataFrame:
    """A report of :func:`funnel_by` with the codes side by side: columns ``<code>_<measure>``."""
    return (
        report.groupBy("bucket")
        .pivot(dimension, list(codes))
        .agg(*[F.first(m).alias(m) for m in DIMENSION_MEASURES])
        .orderBy("bucket")
    )


def requirement_code(column: Column) -> Column:
    """Whether an item asks for experience."""
    return F.when(column.isNotNull(), F.lit("present")).otherwise(F.lit("absent"))

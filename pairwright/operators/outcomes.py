"""What really happened to scored pairs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 4096


@dataclass(frozen=True)
class Fact:
    """A table of events. ``keys`` maps columns of the pair table to the key columns of ``frame``."""

    flag: str
    frame: DataFrame
    keys: tuple[tuple[str, str], ...]


def _fact_counts(facts: list[Fact], on: list[str]) -> DataFrame:
    """One row per key with the number of events of each fact: copies collapse before the shuffle."""
    tagged = [
        fact.frame.select(
            *[F.col(theirs).alias(ours) for ours, theirs in fact.keys],
            *[F.lit(1 if fact.flag == other.flag else 0).alias(f"_n_{other.flag}") for other in facts],
        ).dropna(subset=on)
        for fact in facts
    ]
    events = reduce(DataFrame.unionByName, tagged)
    return events.groupBy(*on).agg(*[F.sum(f"_n_{f.flag}").alias(f"_n_{f.flag}") for f in facts])


def outcome_flags(
    pairs: DataFrame,
    facts: list[Fact],
    copies: str = "copies",
    distinct: bool = False,
) -> DataFrame:
    """Add a '1'/'0' flag per fact, and the number of rows that left joins to the fact tables would have made.

    Facts with the same pair columns share one join. Repeated events multiply rows in a plain left join; here the
    factor is a number in ``copies`` (see :func:`repeat_rows`). ``distinct`` counts each event key once.
    """
    groups: dict[tuple[str, ...], list[Fact]] = {}
    for fact in facts:
        groups.setdefault(tuple(sorted(ours for ours, _ in fact.keys)), []).append(fact)
    joined = pairs
    for on, members in groups.items():
        joined = joined.join(_fact_counts(members, list(on)), list(on), "left")
    factor = F.lit(1).cast("long")
    if not distinct:
        for fact in facts:
            factor = factor * F.greatest(F.coalesce(f"_n_{fact.flag}", F.lit(1)), F.lit(1))
    flags = [
        F.when(F.col(f"_n_{fact.flag}") > 0, F.lit("1")).otherwise(F.lit("0")).alias(fact.flag) for fact in facts
    ]
    return joined.select(*pairs.columns, *flags, factor.alias(copies))


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Each row as often as its count says, in chunks so that no large array is built."""
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / CHUNK)))
    rows = F.explode(
        F.sequence(F.lit(1).cast("long"), F.least(F.lit(CHUNK).cast("long"), F.col(copies) - F.col("_chunk") * CHUNK))
    )
    repeated = df.where(F.col(copies) > 0).withColumn("_chunk", chunks).withColumn("_copy", rows)
    return repeated.drop("_chunk", "_copy", copies)

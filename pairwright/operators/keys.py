"""Distinct keys, one row per key, dense integer ids and ranks that need no single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairwright.operators.joins import _spread, lookup_join
from pairwright.session import materialize

POSITION_BITS = 33  # monotonically_increasing_id() keeps the position within its partition in the low 33 bits


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(key).distinct()


def distinct_pairs(df: DataFrame, key: str, other: str) -> DataFrame:
    """Distinct pairs of two columns."""
    return df.select(key, other).distinct()


def dedupe_by_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``; remaining columns break ties, so the survivor never varies."""
    rest = [c for c in df.columns if c != key]
    ranked = order + [c for c in rest if c not in order]
    kept = df.groupBy(key).agg(F.min(F.struct(*ranked)).alias("_row"))  # partial minimum before the shuffle
    return kept.select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def _offsets(counts: DataFrame, part: str, size: str) -> DataFrame:
    """Number of rows before each part. The parts are few by construction (buckets or write tasks)."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(part, F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long").alias("_before"))


def dense_ids(df: DataFrame, key: str, id_col: str, digits: int = 3) -> DataFrame:
    """Ids 0..n-1 for the distinct non-null values of a column.

    Keys are ordered by a prefix of their MD5 and then by value. The prefix cuts them into 16**digits even buckets, so
    an id is the rank in its bucket plus the sizes of the buckets before. Nothing is sampled or stored: evaluating the
    plan again, on any number of partitions, gives the same ids.
    """
    # Never null, so that no null filter is added to one use of the keys and both read the same exchange.
    bucket = F.coalesce(F.substring(F.md5(F.col(key).cast("string")), 1, digits), F.lit(""))
    keys = df.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_bucket", bucket)
    before = _offsets(keys.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")), "_bucket", "_n")
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        keys.withColumn("_place", place)
        .join(F.broadcast(before), "_bucket")  # at most 16**digits rows
        .select(key, (F.col("_before") + F.col("_place") - 1).alias(id_col))
    )


def attach_ids(df: DataFrame, ids: dict[str, DataFrame]) -> DataFrame:
    """Inner joins that add the ids of key columns; rows with a null or unknown key are dropped.

    Id tables grow with the data, so nothing is broadcast by hand; adaptive skew handling cuts hot keys of the log.
    """
    for key, table in ids.items():
        df = df.join(table, key)
    return df


def _stamp(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Store a frame with each row's partition and position, and the number of rows before each partition."""
    number = F.monotonically_increasing_id()
    stored = materialize(
        df.withColumn("_number", number)
        .withColumns(
            {
                "_part": F.shiftright("_number", POSITION_BITS).cast("int"),
                "_position": F.col("_number").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)),
            }
        )
        .drop("_number"),
        name,
    )
    sizes = stored.groupBy("_part").agg((F.max("_position") + 1).alias("_n"))
    return stored, _offsets(sizes, "_part", "_n")


def _in_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """Range-partitioned and sorted. Equal rows may be cut over partitions, so a hot value is no hot task."""
    tie = df.withColumns({"_tie": _spread(df)})
    by = [*order, F.col("_tie")]
    return tie.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")


def row_ids(df: DataFrame, id_col: str, order: list[Column] | None = None) -> DataFrame:
    """Ids 0..n-1 for the rows of a frame: in frame order without a shuffle, or in the given order.

    Row positions are stored with the rows before they are turned into ids, so a task that runs again cannot move an
    id to another row.
    """
    stored, before = _stamp(df if order is None else _in_order(df, order), "row-ids")
    return (
        stored.join(F.broadcast(before), "_part")  # one row per write task
        .withColumn(id_col, F.col("_before") + F.col("_position"))
        .select(id_col, *df.columns)
    )


def rank_within(df: DataFrame, key: str, order: list[Column], rank_col: str) -> DataFrame:
    """Rank 1..n of each row within its key. A hot key is sorted by many tasks, not by one."""
    placed = row_ids(df, "_id", [F.col(key), *order])
    first = placed.groupBy(key).agg(F.min("_id").alias("_first"))
    named = lookup_join(placed.where(F.col(key).isNotNull()), first, [key], "inner")
    ranked = named.select(*df.columns, (F.col("_id") - F.col("_first") + 1).alias(rank_col))
    nulls = placed.where(F.col(key).isNull())  # sorted first, so their ids start at 0
    return ranked.unionByName(nulls.select(*df.columns, (F.col("_id") + 1).alias(rank_col)))

"""Equi-joins that choose their plan from measured sizes.

Hot keys of joins onto one row per key are left to Spark's adaptive skew handling, which cuts every partition that turns
out too large, with no search beforehand. Keys that repeat on both sides are cut into a grid of cells, all that need it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairwright.session import materialize

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
BLOCKED_ROWS = 4_000_000  # bound of a side that is broadcast in blocks: these are hashed, not their rows
BLOCK_ROWS = 1024  # rows of one key that are sent as one array
CELL_ROWS = 4096  # rows per side of one cell of a split many-to-many key
PAIRS_PER_TASK = 4_000_000
TASKS_PER_CORE = 2  # of a join that sends its right side to all tasks


def _row_bytes(df: DataFrame) -> Column:
    """Size of one row in bytes, variable-length columns measured."""
    fixed, varying = 16, []
    for field in df.schema.fields:
        name = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            varying.append(F.coalesce(F.octet_length(name), F.lit(0)))
            fixed += 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            varying.append(F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)))
            fixed += 16
        else:
            fixed += 8
    return sum(varying, F.lit(fixed)).cast("long")


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a frame is small enough to send to every executor.

    Rows are counted first, which reads few or no columns; bytes are measured only when the count is within bounds.
    """
    return df.count() <= max_rows and _bytes_fit(df, max_bytes)


def _bytes_fit(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return (df.agg(F.sum(_row_bytes(df))).first()[0] or 0) <= max_bytes


def _spread(df: DataFrame, by: list[str] | None = None) -> Column:
    """Number that varies over rows and copies of a row, and is the same when a task is run again.

    ``by`` names columns that tell rows apart well enough; all columns otherwise.
    """
    if by is not None:
        return F.xxhash64(*by, F.spark_partition_id())
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*[F.col(f"`{c}`") for c in hashable], F.spark_partition_id())


def _blocks(df: DataFrame, on: list[str], columns: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of each key as arrays of at most ``block_rows`` structs, column ``_block``."""
    rows = df.groupBy(*on).agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("_block"))
    last = F.floor((F.size("_block") - 1) / block_rows).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), last), lambda n: F.slice("_block", n * block_rows + 1, F.lit(block_rows))
    )
    return rows.withColumn("_block", F.explode(parts))


def pair_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    cell_rows: int = CELL_ROWS,
    pairs_per_task: int = PAIRS_PER_TASK,
    max_rows: int = BLOCKED_ROWS,
    left_by: list[str] | None = None,
    right_by: list[str] | None = None,
) -> DataFrame:
    """Inner many-to-many join. ``left_by`` and ``right_by`` are columns to spread rows by.

    The right side is measured in one pass. If it is small it is broadcast, and the left rows are spread evenly over
    tasks, so that each makes about as many pairs as any other, whatever keys are hot; pairs stream through, so their number
    is no matter of memory. It is sent as arrays of the rows of a key: a left row reads each from end to end, while the
    matches of a hash table lie scattered, which is slow once the table is larger than a processor's cache. Otherwise both sides are counted per key once, pre-aggregated, and the counts are stored: they
    give the exact number of result rows, hence of tasks, and the grid. Every key with many pairs becomes a grid: its left
    rows are hashed to grid rows and its right rows to grid columns, each is repeated along the other axis, and every pair
    meets in exactly one cell.
    """
    spark = left.sparkSession
    carried = right.drop(*on)
    size = right.agg(F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(carried)).alias("bytes")).first()
    if size["rows"] <= max_rows and (size["bytes"] or 0) <= BROADCAST_BYTES:
        spread = left.withColumn("_spread", _spread(left, left_by and [*on, *left_by]))
        tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
        spread = spread.repartition(tasks, "_spread").drop("_spread")
        if not carried.columns:
            return spread.join(F.broadcast(right), on)
        met = spread.join(F.broadcast(_blocks(right, on, carried.columns)), on)
        return met.select("*", F.inline("_block")).drop("_block")
    one, none = F.lit(1), F.lit(0)
    sides = left.select(*on, one.alias("l"), none.alias("r")).unionByName(right.select(*on, none.alias("l"), one.alias("r")))
    counted = sides.groupBy(*on).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    counts = materialize(counted, "pair-counts")
    pairs = F.col("l").cast("double") * F.col("r")
    axes = {"_rows": F.ceil(F.col("l") / cell_rows), "_cols": F.ceil(F.col("r") / cell_rows)}
    cut = (axes["_rows"] * axes["_cols"] > 1) & (pairs > pairs_per_task)
    totals = counts.agg(F.sum(pairs).alias("pairs"), F.sum(cut.cast("long")).alias("cut")).first()
    tasks = max(math.ceil((totals["pairs"] or 0.0) / pairs_per_task), spark.sparkContext.defaultParallelism)
    if not totals["cut"]:
        return left.repartition(tasks, *on).join(right.repartition(tasks, *on), on)
    grid = counts.where(cut).select(*on, *[n.cast("int").alias(a) for a, n in axes.items()])
    if totals["cut"] <= BROADCAST_ROWS:
        grid = F.broadcast(grid)
    cells = [*on, "_row", "_col"]

    def to_cells(df: DataFrame, own: str, other: str, by: list[str] | None) -> DataFrame:
        return (
            df.withColumn("_spread", _spread(df, by and [*on, *by]))
            .join(grid, on, "left")
            .withColumn(own, F.pmod("_spread", F.coalesce(f"{own}s", F.lit(1))).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(f"{other}s", F.lit(1)) - 1)))
            .drop("_spread", "_rows", "_cols")
            .repartition(tasks, *cells)
        )

    return to_cells(left, "_row", "_col", left_by).join(to_cells(right, "_col", "_row", right_by), cells).drop("_row", "_col")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    measure: DataFrame | None = None,
) -> DataFrame:
    """Attach a lookup table: broadcast when it is measured to be small, otherwise a join that adaptive skew handling cuts.

    ``measure`` is a frame that ``right`` cannot exceed and that is cheaper to measure, such as its input.
    """
    if fits_broadcast(right if measure is None else measure, max_rows):
        right = F.broadcast(right)
    return left.join(right, on, how)


def all_pairs(
    left: DataFrame, right: DataFrame, left_cell: int = CELL_ROWS, right_cell: int = CELL_ROWS
) -> DataFrame:
    """Every left row with every right row, as an equi-join on a grid of cells.

    The result is the product of the sides by definition, so reduce both to the rows that matter first. Each side is
    hashed along its own axis and repeated along the other: shuffled rows are |left|*cols + |right|*rows, each task
    holds one bounded cell, and neither side is broadcast.
    """
    rows = max(1, math.ceil(left.count() / left_cell))
    cols = max(1, math.ceil(right.count() / right_cell))
    tasks = rows * cols

    def to_cells(df: DataFrame, own: str, own_size: int, other: str, other_size: int) -> DataFrame:
        return (
            df.withColumn(own, F.pmod(_spread(df), F.lit(own_size)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_size - 1))))
            .repartition(tasks, own, other)
        )

    return (
        to_cells(left, "_row", rows, "_col", cols)
        .join(to_cells(right, "_col", cols, "_row", rows), ["_row", "_col"])
        .drop("_row", "_col")
    )

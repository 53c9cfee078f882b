"""Proof that a top-N of factor products is complete, by a scan that a norm bound prunes.

The returned rows of a user give a floor: the lowest of ``limit`` distinct scores, or zero where there are fewer. By the
Cauchy-Schwarz inequality an item can only be above it if its norm times the user's is, so items are put into classes of
similar norm, and a user meets only the classes whose largest norm is large enough. Within a class the same inequality holds
for leaves of near items: no score is above that of the centre by more than the radius times the user's norm. This bound is
another one than that of the scoring, whose work it proves. What is counted there is compared with
what was returned: a row that should have been returned shows as ``missed``, whatever was returned in its place.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.ml.leaves import leaf_cutter
from pairwright.session import materialize

CLASSES_PER_DOUBLING = 4
BLOCK_ROWS = 65_536  # users or items of one block
STEP_USERS = 4_096  # users whose bounds are held at a time
CLEAR = 1e-6  # relative distance from the floor from which on a score is above it, whatever the order of additions
WRONG = 1e-5  # difference from which on a returned score is wrong


def _norm(factors: str) -> Column:
    return F.sqrt(F.aggregate(factors, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def _product(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def _floors(best: DataFrame, users: DataFrame, items: DataFrame, limit: int) -> DataFrame:
    """Rows (user_id, _u, norm, n_scores, floor, wrong, kept): each user with the floor of its rows and the rows above it."""
    left = users.select("user_id", F.col("_factors").alias("_u"))
    right = items.select("item_id", F.col("_factors").alias("_i"))
    scored = best.join(left, "user_id", "left").join(right, "item_id", "left")
    off = F.coalesce(F.abs(_product("_u", "_i") - F.col("prediction")) > WRONG * F.greatest(F.abs("prediction"), F.lit(1.0)), F.lit(True))
    rows = materialize(scored.select("user_id", "prediction", off.cast("long").alias("off")), "returned")
    sums = rows.groupBy("user_id").agg(
        F.countDistinct("prediction").alias("n_scores"), F.min("prediction").cast("double").alias("low"), F.sum("off").alias("wrong")
    )
    known = left.withColumn("norm", _norm("_u")).join(sums, "user_id", "left").na.fill(0, ["n_scores", "wrong"])
    floor = F.when(F.col("n_scores") >= limit, F.col("low") * (1 + CLEAR)).otherwise(F.col("norm") * CLEAR**2)
    known = known.withColumn("floor", floor).drop("low")
    above = rows.join(known.select("user_id", "floor"), "user_id").where("prediction > floor")
    return known.join(above.groupBy("user_id").agg(F.count(F.lit(1)).alias("kept")), "user_id", "left").na.fill(0, ["kept"])


def _counter() -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The count of one cell. It goes to the workers by value, so they need not have this package."""
    cut_leaves = leaf_cutter()

    def count_above(users: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        """Rows (user_id, found, compared) of one block of users and one of items."""
        if not len(users) or not len(items):
            return pd.DataFrame({"user_id": users["user_id"].iloc[:0], "found": np.zeros(0, int), "compared": np.zeros(0, int)})
        left, right = np.stack(users["_u"].to_numpy()).astype(np.float64), np.stack(items["_i"].to_numpy()).astype(np.float64)
        floors = users["floor"].to_numpy()
        order, starts = cut_leaves(right)
        right, sizes = right[order], np.diff(starts)
        found, compared = np.zeros(len(users), int), np.zeros(len(users), int)
        with np.errstate(invalid="ignore", over="ignore"):  # a bound that is no number spares nothing
            centre = np.add.reduceat(right, starts[:-1]) / sizes[:, None]
            away = np.sqrt(((right - np.repeat(centre, sizes, axis=0)) ** 2).sum(axis=1))
            radius = np.maximum.reduceat(away, starts[:-1])
            radius = radius + CLEAR * (np.sqrt((centre**2).sum(axis=1)) + radius)
            for at in range(0, len(users), STEP_USERS):
                part, floor = left[at : at + STEP_USERS], floors[at : at + STEP_USERS]
                bound = centre @ part.T + radius[:, None] * np.sqrt((part**2).sum(axis=1))
                for leaf in range(len(sizes)):
                    some = np.flatnonzero(~(bound[leaf] < floor))
                    if len(some):
                        scores = (part[some] @ right[starts[leaf] : starts[leaf + 1]].T).astype(np.float32)
                        found[at + some] += (scores > floor[some][:, None]).sum(axis=1)
                        compared[at + some] += sizes[leaf]
        return pd.DataFrame({"user_id": users["user_id"], "found": found, "compared": compared})

    return count_above


def top_certificate(
    best: DataFrame, users: DataFrame, items: DataFrame, limit: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Rows (user_id, n_scores, wrong, missed, compared), one for each user of ``users``.

    ``best`` holds (user_id, item_id, prediction), ``users`` and ``items`` distinct ids with ``_factors``. ``n_scores`` are
    distinct returned scores, ``wrong`` returned rows whose score is not the product of the factors or whose id is unknown,
    ``missed`` rows clearly above the floor that were not returned, and ``compared`` the items that a user was held against.
    Rows that tie with the floor are not counted. A user without rows has floor zero.
    """
    if limit < 1:
        raise ValueError("limit must be positive")
    known = materialize(_floors(best, users, items, limit), "floors")
    normed = items.select("item_id", F.col("_factors").alias("_i"), _norm("_factors").alias("norm")).where("norm > 0")
    step = F.floor(F.log2("norm") * CLASSES_PER_DOUBLING).cast("int")
    normed = materialize(normed.withColumn("class", step), "item-classes")
    # doubles have 2 100 powers of two at most, so the classes are few for any number of items
    classes = [
        (r["class"], r.top, -(-r.n // block_rows)) for r in normed.groupBy("class").agg(F.max("norm").alias("top"), F.count(F.lit(1)).alias("n")).collect()
    ]
    user_blocks = max(1, -(-known.count() // block_rows))
    listed = F.array(*[F.struct(F.lit(c).alias("class"), F.lit(top).alias("top"), F.lit(n).alias("parts")) for c, top, n in classes])
    if not classes:
        listed = F.array().cast("array<struct<class: int, top: double, parts: int>>")
    reached = F.filter(listed, lambda c: c["top"] * F.col("norm") * (1 + CLEAR) > F.col("floor"))
    block = F.pmod(F.xxhash64("user_id"), F.lit(user_blocks)).cast("int")
    left = known.withColumn("block", block).withColumn("c", F.explode(reached))
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("c.parts") - 1))).select(
        "block", F.col("c.class").alias("class"), "part", "user_id", "_u", "floor"
    )
    sizes = F.create_map(*[F.lit(x) for c, _, n in classes for x in (c, n)]) if classes else F.lit(None).cast("map<int,int>")
    right = normed.withColumn("part", F.pmod(F.xxhash64("item_id"), sizes[F.col("class")]).cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1)))).select("block", "class", "part", "item_id", "_i")
    cell = ["block", "class", "part"]
    schema = f"user_id {known.schema['user_id'].dataType.simpleString()}, found long, compared long"
    counted = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(_counter(), schema)
    sums = counted.groupBy("user_id").agg(F.sum("found").alias("found"), F.sum("compared").alias("compared"))
    whole = known.join(sums, "user_id", "left").na.fill(0, ["found", "compared"])
    return whole.select("user_id", "n_scores", "wrong", (F.col("found") - F.col("kept")).alias("missed"), "compared")

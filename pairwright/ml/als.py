"""ALS recommender: integer ids, fit, and scores of listed users and items in matrix blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairwright.ml.leaves import leaf_cutter
from pairwright.operators.keys import attach_ids, dense_ids
from pairwright.operators.ranking import ranked_top
from pairwright.session import materialize

MAX_ID = 2**31 - 1  # ALS ids are 32-bit
USER_ID, ITEM_ID = "unique_user_id", "unique_item_id"
ALL_CELL = (1024, 2048)  # users and items of one block when every positive score is kept
TOP_CELL = (65_536, 262_144)  # the same when only the top scores leave the block
FEWEST_USERS = 4096  # users of such a block are no fewer, however many tasks run at a time
CELLS_PER_CORE = 4  # blocks that are wanted when users are many
CHUNK_ITEMS = 4096  # items of a block that are scored at a time
STEP_USERS = 4096  # users whose bounds are held at a time
STEP_ROWS = 1 << 20  # kept rows of these after which those below the limit are dropped
MARGIN = 1e-6  # by which a bound is widened: floats are rounded by less


def index_log(
    log: DataFrame, user: str, item: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Action log with dense user and item ids, and the two id tables. Rows with a null key are dropped."""
    user_ids, item_ids = dense_ids(log, user, USER_ID), dense_ids(log, item, ITEM_ID)
    indexed = attach_ids(log, {user: user_ids, item: item_ids})
    return indexed.select(*log.columns, USER_ID, ITEM_ID), user_ids, item_ids


def fit_als(
    indexed: DataFrame,
    rating: str = "rating",
    rank: int = 10,
    max_iter: int = 10,
    implicit_prefs: bool = True,
    alpha: float = 1.0,
    user_blocks: int | None = None,
    item_blocks: int | None = None,
    seed: int = 42,
    combine: str | None = None,
) -> ALSModel:
    """Fit ALS on an indexed log. Ids beyond 32 bits are refused, not wrapped.

    Repeated (user, item) rows count one by one. ``combine`` ('sum', 'max', 'min' or 'avg') makes them one rating first:
    ALS keeps all ratings of a user in one block, so use it where a user repeats the same items very often. Blocks are as
    many as the cluster runs tasks at a time unless given.
    """
    parallel = indexed.sparkSession.sparkContext.defaultParallelism
    user_blocks, item_blocks = user_blocks or parallel, item_blocks or parallel
    for name, value in {"rank": rank, "max_iter": max_iter, "user_blocks": user_blocks, "item_blocks": item_blocks}.items():
        if isinstance(value, bool) or not isinstance(value, int) or value < 1:
            raise ValueError(f"{name} must be a positive integer, not {value!r}")
    if not isinstance(implicit_prefs, bool):
        raise ValueError(f"implicit_prefs must be True or False, not {implicit_prefs!r}")
    top = indexed.agg(F.max(USER_ID), F.max(ITEM_ID)).first()
    if any(value is not None and value > MAX_ID for value in top):
        raise ValueError(f"ids {tuple(top)} do not fit in 32 bits")
    if combine not in (None, "sum", "max", "min", "avg"):
        raise ValueError(f"combine must be None, 'sum', 'max', 'min' or 'avg', not {combine!r}")
    ratings = indexed.where(F.col(rating).isNotNull())
    if combine is not None:
        ratings = ratings.groupBy(USER_ID, ITEM_ID).agg(F.expr(f"{combine}(`{rating}`)").alias(rating))
    als = ALS(
        rank=rank,
        maxIter=max_iter,
        implicitPrefs=implicit_prefs,
        alpha=float(alpha),
        numUserBlocks=user_blocks,
        numItemBlocks=item_blocks,
        userCol=USER_ID,
        itemCol=ITEM_ID,
        ratingCol=rating,
        seed=seed,
        coldStartStrategy="drop",
    )
    return als.fit(
        ratings.select(F.col(USER_ID).cast("int"), F.col(ITEM_ID).cast("int"), F.col(rating).cast("float"))
    )


def _top_finder(limit: int) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """A function from factors of users and items to (user row, item row, score, products made) of each user's top.

    A user is held against a leaf of items only if its box may hold a score that reaches the user's ``limit`` highest
    distinct scores so far: the factors times the near corner of the box, and a margin for rounding, are above all scores
    inside. Products are summed in double one coordinate after the other and rounded to float, so equal factors give equal
    scores wherever they stand. The function goes to the workers by value.
    """
    cut_leaves = leaf_cutter()

    def products(users, items):
        scores = users[:, :1] * items[:1]
        for n in range(1, len(items)):
            scores += users[:, n : n + 1] * items[n : n + 1]
        scores = scores.astype(np.float32)
        scores[~(scores > 0)] = -np.inf
        return scores

    def highest(scores):
        """Per row the highest distinct scores from high to low, filled up with -inf."""

        def from_some(some):
            ordered = -np.sort(-some, axis=1)
            new = np.ones(ordered.shape, dtype=bool)
            new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
            place = np.cumsum(new, axis=1) - 1
            row, col = np.nonzero(new & (place < limit))
            found = np.full((len(some), limit), -np.inf, np.float32)
            found[row, place[row, col]] = ordered[row, col]
            return found

        width = scores.shape[1]
        top = min(width, 4 * limit)
        found = from_some(np.partition(scores, width - top, axis=1)[:, width - top :])
        short = np.isneginf(found[:, -1])
        if top < width and short.any():
            found[short] = from_some(scores[short])
        return found

    def top_of_step(users, leaves, middle, reach):
        """The top of some users: rows of the leaves, with their scores."""
        bound = middle @ users.T + reach @ np.abs(users).T + np.finfo(np.float32).tiny
        best = np.full((len(users), limit), -np.inf, np.float32)
        rows, cols, kept, made, pending, room = [], [], [], 0, 0, STEP_ROWS

        def floor(some):
            return np.maximum(best[some, -1], 0)

        def cut_back():
            """Drop what other items have put out of the top since it was kept."""
            row, col, score = (np.concatenate(x) for x in (rows, cols, kept))
            still = score >= best[row, -1]
            rows[:], cols[:], kept[:] = [row[still]], [col[still]], [score[still]]
            return int(still.sum())

        nearest = bound.argmax(axis=0)
        by_leaf = np.argsort(nearest, kind="stable")
        for some in np.split(by_leaf, np.flatnonzero(np.diff(nearest[by_leaf])) + 1):
            _, items = leaves[nearest[some[0]]]
            best[some] = highest(products(users[some], items))
            made += len(some) * items.shape[1]
        reached = (~(bound < floor(slice(None)))).sum(axis=1)
        for leaf in np.argsort(-reached, kind="stable"):
            some = np.flatnonzero(~(bound[leaf] < floor(slice(None))))
            if not len(some):
                continue
            first, items = leaves[leaf]
            scores = products(users[some], items)
            made += scores.size
            keep = (scores > 0) & (scores >= best[some, -1:])
            hit = keep.any(axis=1)
            if not hit.any():
                continue
            row, col = np.nonzero(keep)
            rows.append(some[row])
            cols.append(first + col)
            kept.append(scores[row, col])
            some, scores = some[hit], scores[hit]
            best[some] = highest(np.concatenate([best[some], scores], axis=1))
            pending += len(row)
            if pending > room:
                pending = cut_back()
                room = max(STEP_ROWS, 2 * pending)  # ties at the limit stay, however many there are
        if rows:
            cut_back()
        return rows, cols, kept, made

    def top(users, items):
        rows, cols, kept, made = [np.empty(0, int)], [np.empty(0, int)], [np.empty(0, np.float32)], 0
        if len(users) and len(items):
            order, starts = cut_leaves(items)
            items = items[order]
            with np.errstate(invalid="ignore", over="ignore"):  # what is no number is above every bound, and no score
                low, high = (f.reduceat(items, starts[:-1]) for f in (np.minimum, np.maximum))
                middle = (high + low) / 2
                reach = (high - low) / 2
                reach = reach + MARGIN * (np.abs(middle) + reach)
                leaves = [(a, np.ascontiguousarray(items[a:b].T)) for a, b in zip(starts[:-1], starts[1:])]
                for start in range(0, len(users), STEP_USERS):
                    row, col, score, more = top_of_step(users[start : start + STEP_USERS], leaves, middle, reach)
                    rows += [start + r for r in row]
                    cols += [order[c] for c in col]
                    kept += score
                    made += more
        return np.concatenate(rows), np.concatenate(cols), np.concatenate(kept), made

    return top


def _block_scorer(user: str, item: str, score: str, limit: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Scores of one block of users and items. With a limit, rows beyond it within the block are left out.

    A row in the user's overall top is in the top of its block too, so the block cut loses nothing. Products are summed
    in double and rounded to float: equal factors give equal scores.
    """
    top = _top_finder(limit) if limit > 0 else None

    def positive(left, right):
        rows, cols, kept = [np.empty(0, int)], [np.empty(0, int)], [np.empty(0, np.float32)]
        for start in range(0, len(left), 256):
            for first in range(0, len(right), CHUNK_ITEMS):
                scores = (left[start : start + 256] @ right[first : first + CHUNK_ITEMS].T).astype(np.float32)
                row, col = np.nonzero(scores > 0)
                rows.append(start + row)
                cols.append(first + col)
                kept.append(scores[row, col])
        return np.concatenate(rows), np.concatenate(cols), np.concatenate(kept)

    def score_block(users: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        user_names, item_names = users[user].to_numpy(), items[item].to_numpy()
        rows, cols, kept = np.empty(0, int), np.empty(0, int), np.empty(0, np.float32)
        if len(users) and len(items):
            left, right = (np.stack(side["_factors"].to_numpy()).astype(np.float64) for side in (users, items))
            rows, cols, kept = top(left, right)[:3] if limit > 0 else positive(left, right)
        columns = {user: user_names[rows], item: item_names[cols], score: kept}
        return pd.DataFrame({name: pd.Series(column, dtype=column.dtype) for name, column in columns.items()})

    return score_block


def score_lists(
    model: ALSModel,
    users: DataFrame,
    items: DataFrame,
    user_ids: DataFrame,
    item_ids: DataFrame,
    limit: int = 0,
    cell: tuple[int, int] | None = None,
) -> DataFrame:
    """Positive scores of listed users and items known to training: ``user_id, item_id, prediction``.

    ``users`` and ``items`` are one-column lists (a repeated id counts once); ``user_ids`` and ``item_ids`` hold the key
    and its dense id. With a positive ``limit``, only rows within each user's ``limit`` highest distinct scores.

    The factors of the listed known ids are stored and counted, and cut into blocks by a hash, about as large as ``cell``
    says. Each block of users meets each block of items in one task as a matrix product; with a limit, leaves of items whose
    bound is below what a user already has are left out. The rows that move are factors, never scored pairs, and their copies
    follow the lists, not all ids.
    """
    left, right = listed_factors(model, users, items, user_ids, item_ids)
    return score_factors(left, right, limit, cell)


def listed_factors(
    model: ALSModel, users: DataFrame, items: DataFrame, user_ids: DataFrame, item_ids: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Rows (user_id, id, _factors) and (item_id, id, _factors) of the listed users and items known to training."""

    def factors(names: DataFrame, ids: DataFrame, id_col: str, table: DataFrame, name: str) -> DataFrame:
        key = next(c for c in ids.columns if c != id_col)
        return (
            names.select(F.col(names.columns[0]).alias(name))
            .distinct()
            .join(ids.select(F.col(key).alias(name), F.col(id_col).cast("int").alias("id")), name)
            .join(table, "id")
            .select(name, "id", F.col("features").alias("_factors"))
        )

    left = factors(users, user_ids, USER_ID, model.userFactors, "user_id")
    return left, factors(items, item_ids, ITEM_ID, model.itemFactors, "item_id")


def score_factors(left: DataFrame, right: DataFrame, limit: int = 0, cell: tuple[int, int] | None = None) -> DataFrame:
    """Positive products of users (user_id, id, _factors) and items (item_id, id, _factors), ids distinct.

    With a positive ``limit``, only rows within each user's ``limit`` highest distinct scores.
    """
    user_cell, item_cell = cell or (TOP_CELL if limit > 0 else ALL_CELL)
    left, right = materialize(left, "user-factors"), materialize(right, "item-factors")
    users, cols = left.count(), -(-right.count() // item_cell)
    if cell is None and limit > 0:  # wide blocks copy items less often; narrower ones keep all cores busy
        cells = CELLS_PER_CORE * left.sparkSession.sparkContext.defaultParallelism
        user_cell = min(user_cell, max(FEWEST_USERS, -(-users * cols // cells)))
    rows = -(-users // user_cell)
    schema = T.StructType(
        [
            T.StructField("user_id", left.schema["user_id"].dataType),
            T.StructField("item_id", right.schema["item_id"].dataType),
            T.StructField("prediction", T.FloatType()),
        ]
    )
    if not rows or not cols:
        return left.sparkSession.createDataFrame([], schema)

    def blocks(frame: DataFrame, own: str, count: int, other: str, others: int) -> DataFrame:
        placed = frame.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")).drop("id")
        repeated = placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        return repeated.repartition(rows * cols, "_row", "_col")

    scored = (
        blocks(left, "_row", rows, "_col", cols)
        .groupBy("_row", "_col")
        .cogroup(blocks(right, "_col", cols, "_row", rows).groupBy("_row", "_col"))
        .applyInPandas(_block_scorer("user_id", "item_id", "prediction", limit), schema)
    )
    return ranked_top(scored, "user_id", "prediction", limit) if limit > 0 else scored

"""Centroid clustering of integer vectors with scalar lookup tables.

A vector's components are integers (of real vectors: ``floor(scale * x)``), and so are the centroids'. In each round a batch
of vectors makes, for each dimension, a table of the squared differences between the values that occur there and every
centroid. Distances are then gathered from the tables by value and added up, in exact integers, without a product for each
vector, dimension and centroid. A table is never longer than its batch, whatever values occur.

Only centroids come to the driver: sums and counts of each cluster, made in tasks and added up by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.llm.common import batched, columns_of, free_name, least_places
from pairwright.session import materialize

#: Integers beyond this are held at it, so that a squared distance over 64 dimensions fits 64 bits.
BOUND = 1 << 27


def integer_vectors(rows: DataFrame, vector: str, dims: int, scale: int, result: str) -> DataFrame:
    """The rows whose vector has exactly ``dims`` components, none null or not finite, with ``floor(scale * x)`` of each."""
    v = F.col(f"`{vector}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.least(F.greatest(F.floor(x.cast("double") * scale), F.lit(-BOUND)), F.lit(BOUND)))
    return rows.where((F.size(v) == dims) & ~bad).withColumn(result, whole.cast("array<bigint>"))


def table_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of integer rows to integer centroids, gathered from one table for each dimension."""
    found = np.zeros((len(x), len(centroids)), np.int64)
    for d in range(x.shape[1]):
        values, place = np.unique(x[:, d], return_inverse=True)
        table = (values[:, None] - centroids[:, d]) ** 2
        found += table[place]
    return found


def first_centroids(vectors: DataFrame, place: Column, x: str, k: int) -> np.ndarray:
    """The vectors of the ``k`` smallest places (a hex digest), ties by components; in this order."""
    ranked = vectors.select(place.alias("place"), F.col(x).alias("x"))
    near = least_places(ranked, F.conv(F.substring("place", 1, 15), 16, 10).cast("long"), k)
    rows = near.orderBy("place", "x").limit(k).collect()  # at most k rows
    return np.array([r.x for r in rows], np.int64)


def _round(vectors: DataFrame, x: str, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round of assignment and averaging, rounded down; empty clusters keep theirs."""
    k, dims = centroids.shape

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for part in parts:
            rows = batched(part.column(0), dims)
            nearest = table_distances(rows, centroids).argmin(1)
            counts += np.bincount(nearest, minlength=k)
            for number in np.unique(nearest):
                sums[number] += rows[nearest == number].sum(0)
        met = np.flatnonzero(counts)
        columns = [pa.array(met, pa.int32()), pa.array(counts[met]), pa.array(sums[met].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    found = vectors.select(x).mapInArrow(add, "cluster int, n long, sums array<bigint>")
    totals = [F.sum(F.col("sums")[d].cast("decimal(38,0)")) for d in range(dims)]
    moved = centroids.copy()
    for r in found.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*totals).alias("sums")).collect():  # k rows at most
        moved[r.cluster] = [int(s) // int(r.n) for s in r.sums]
    return moved


def cluster(
    vectors: DataFrame, x: str, place: Column, k: int = 16, rounds: int = 3, result: str = "cluster"
) -> tuple[DataFrame, np.ndarray]:
    """The rows with a struct (number, distance), and the final centroids.

    ``x`` holds integer vectors of one length; ``place`` is a hex digest that orders the rows, of which the first ``k`` are
    the first centroids. Each round assigns all rows to the nearest centroid (ties: the smaller number) and moves non-empty
    centroids to the floor of the mean; the rows come back assigned to the last centroids. With fewer than ``k`` rows there
    are as many centroids; without rows, none. Repeated rows may give equal centroids, the later of which stay empty.
    """
    centroids = first_centroids(vectors, place, x, k)
    if not len(centroids):
        return vectors.withColumn(result, F.lit(None).cast("struct<number: int, distance: bigint>")), centroids
    dims = centroids.shape[1]
    for _ in range(rounds):
        centroids = _round(vectors, x, centroids)

    @F.pandas_udf("number int, distance bigint")
    def nearest(lists):
        import pandas as pd

        rows = np.array(lists.tolist(), np.int64).reshape(-1, dims)
        found = table_distances(rows, centroids)
        number = found.argmin(1)
        return pd.DataFrame({"number": number.astype(np.int32), "distance": found[np.arange(len(rows)), number]})

    return vectors.withColumn(result, nearest(F.col(x))), centroids


def embedding_clusters(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 64, k: int = 16,
    rounds: int = 3, result: str = "found",
) -> DataFrame:
    """The usable rows with a struct (cluster, distance, cluster_inertia, inertia, centroid).

    A row is usable if its vector has ``dims`` components, none null or not finite; others are left out. Rows are ordered by
    the SHA-256 of ``1:<key>`` (a null key: ``1:``). Inertia is the sum of squared distances, null beyond 64 bits.
    ``centroid`` is the array of the final centroid's components. The struct is the last column; a name in use gets
    underscores before it.
    """
    result, x, name = free_name(rows, result, "x", "assigned")
    usable = materialize(integer_vectors(rows, vector, dims, scale, x), "integer-vectors")
    place = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)
    found, centroids = cluster(usable, x, place, k, rounds, name)
    found = materialize(found.drop(x), "assigned")
    sums = found.groupBy(F.col(name)["number"].alias("number")).agg(F.sum(F.col(name)["distance"].cast("decimal(38,0)")).alias("s"))
    each = {r.number: int(r.s) for r in sums.collect()}  # one row a cluster
    fitting = lambda n: n if n < 1 << 63 else None
    facts = [
        F.struct(
            F.lit(fitting(each.get(i, 0))).cast("long").alias("inertia"),
            F.array(*[F.lit(int(c)).cast("long") for c in centroids[i]]).alias("centroid"),
        )
        for i in range(len(centroids))
    ]
    if not facts:
        fields = "cluster: int, distance: bigint, cluster_inertia: bigint, inertia: bigint, centroid: array<bigint>"
        return found.drop(name).withColumn(result, F.lit(None).cast(f"struct<{fields}>"))
    own = F.array(*facts)[F.col(name)["number"]]
    return found.withColumn(
        result,
        F.struct(
            F.col(name)["number"].alias("cluster"),
            F.col(name)["distance"].alias("distance"),
            own["inertia"].alias("cluster_inertia"),
            F.lit(fitting(sum(each.values()))).cast("long").alias("inertia"),
            own["centroid"].alias("centroid"),
        ),
    ).select(*columns_of(rows), result)

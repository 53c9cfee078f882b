"""Embedding near-dedup: a subspace pigeonhole join.

Unit vectors are rotated, which spreads their energy evenly, and split into blocks. Two vectors of cosine ``c`` are at squared
distance ``2 - 2c``, so in some block their squared distance is at most an equal share of that. Each block is joined as a
range join over several of its coordinates: these are cut at their medians, a vector is at home in the cell that holds it, and
a guest in every later cell whose lowest distance from it is within the share. The rotation within a block puts coordinates
that vary most first; it and the medians are fitted on a bounded sample, and results do not depend on them.

In a cell, the distance over the first half of a block's coordinates, in single precision with room for its rounding, picks
candidates, and whole vectors decide in double precision. A pair counts in the first block that keeps within its share, so
the union of all blocks is counted without listing it. Equal vectors are one row from the start. Cells are cut into parts of
bounded size on both sides, so no cell is one task. A part reports the number of links of each vector and a forest that
connects what it links, both no longer than the part.

Of evenly spread vectors a cell prunes next to nothing: the share's radius is wide against the spread of one coordinate, and
narrow only over many coordinates together. So work grows with the square of the distinct vectors there; it is less where
vectors cluster. More blocks prune no better: their cells are finer, but each block goes over the pairs again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.llm.common import least_places
from pairwright.llm.components import component_roots
from pairwright.session import materialize

BLOCKS = 2
PART_ROWS = 32_768  # vectors on one side of a part
SAMPLE = 4_096  # vectors that cells are fitted on
TILE = (256, 4_096)  # rows of both sides that are compared at a time
SLACK = 1e-9  # added to shares and left around exact bounds: rounding may add candidates, never lose one
DENSE = 0.02  # share of candidates in a tile from which on whole products are cheaper than single ones


def rotation(dims: int, seed: int = 11) -> np.ndarray:
    """A random rotation, the same for each number of dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def block_bounds(dims: int, blocks: int) -> list[tuple[int, int]]:
    """First and last coordinate of each block; no block is empty."""
    edges = np.linspace(0, dims, min(blocks, dims) + 1).round().astype(int)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def block_shares(dims: int, blocks: int, min_cosine: float) -> list[float]:
    """Squared distance that each block may hold, in proportion to its coordinates."""
    whole = 2 - 2 * min_cosine
    return [whole * (b - a) / dims + SLACK for a, b in block_bounds(dims, blocks)]


def distinct_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows (node, v, n, least): the distinct usable vectors, how many rows have each, and the smallest key; stored.

    Null, empty and zero vectors, and vectors with null or non-finite components, are not usable.
    """
    v = F.col(f"`{vector}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    found = rows.where(usable).groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("least"))
    return materialize(found.withColumn("node", F.monotonically_increasing_id()), "vectors")


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(1, keepdims=True)  # so that no square overflows or vanishes
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


@dataclass(frozen=True)
class Cells:
    """How vectors of one length are turned, split into blocks, and dealt to cells."""

    turn: np.ndarray
    bounds: list[tuple[int, int]]
    shares: list[float]
    medians: list[np.ndarray]  # of each block's first coordinates

    def places(self, unit: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home cells of unit rows, and rows and cells of their guest places: later cells within the share."""
        first = self.bounds[block][0]
        cuts = self.medians[block]
        coords = unit @ self.turn[:, first : first + len(cuts)]
        home = ((coords > cuts) << np.arange(len(cuts))).sum(1).astype(np.int64)
        row, cell, gap = np.arange(len(unit)), home, np.zeros(len(unit))
        for j in range(len(cuts)):
            further = gap + (coords[row, j] - cuts[j]) ** 2
            near = further <= self.shares[block]
            row, cell, gap = np.append(row, row[near]), np.append(cell, cell[near] ^ (1 << j)), np.append(gap, further[near])
        later = cell > home[row]
        return home, row[later], cell[later]


def fit_cells(dims: int, count: int, sample: np.ndarray, blocks: int, min_cosine: float, part_rows: int) -> Cells:
    """Cells for ``count`` vectors of a length, so many that an even one is no larger than a part."""
    bounds, shares = block_bounds(dims, blocks), block_shares(dims, blocks, min_cosine)
    turn, medians = rotation(dims), []
    cuts = math.ceil(math.log2(max(1.0, count / part_rows)))
    for first, last in bounds:
        if cuts and len(sample):
            coords = sample @ turn[:, first:last]
            turn[:, first:last] = turn[:, first:last] @ np.linalg.eigh(np.cov(coords.T).reshape(last - first, -1))[1][:, ::-1]
            medians.append(np.median(sample @ turn[:, first : min(last, first + cuts)], axis=0))
        else:
            medians.append(np.zeros(0))
    return Cells(turn, bounds, shares, medians)


def _vector_cells(vectors: DataFrame, blocks: int, min_cosine: float, part_rows: int) -> dict[int, Cells]:
    """Cells by length, fitted on at most ``SAMPLE`` vectors of each length, chosen by hash from all."""
    found = {}
    for r in vectors.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).collect():
        sample = np.zeros((0, r.dims))
        if r.n > part_rows:
            same = vectors.where(F.size("v") == r.dims).select("v", F.shiftrightunsigned(F.xxhash64("v"), 1).alias("place"))
            rows = least_places(same, F.col("place"), SAMPLE).orderBy("place", "v").limit(SAMPLE).select("v").collect()
            sample = _unit(np.array([x.v for x in rows]))
        found[r.dims] = fit_cells(r.dims, r.n, sample, blocks, min_cosine, part_rows)
    return found


def _by_length(part: pa.RecordBatch, column: int) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """The rows of a batch by the length of their vectors, with the vectors as a matrix."""
    lengths = np.diff(part.column(column).offsets.to_numpy())
    for dims in np.unique(lengths).tolist():
        chosen = part.take(pa.array(np.flatnonzero(lengths == dims)))
        yield dims, chosen, chosen.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _cell_sizes(vectors: DataFrame, cells: dict[int, Cells]) -> dict[tuple[int, int, int], tuple[int, int]]:
    """Number of homes and guests of each (length, block, cell): a few cells for each part of vectors."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: dict[tuple[int, int, int], list[int]] = {}
        for part in parts:
            for dims, _, data in _by_length(part, 0):
                unit = _unit(data)
                for block in range(len(cells[dims].bounds)):
                    home, _, guest = cells[dims].places(unit, block)
                    for side, found in enumerate((home, guest)):
                        for cell, n in zip(*np.unique(found, return_counts=True)):
                            sizes.setdefault((dims, block, int(cell)), [0, 0])[side] += int(n)
        rows = [{"dims": d, "block": b, "cell": c, "homes": h, "guests": g} for (d, b, c), (h, g) in sizes.items()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows)

    found = vectors.select("v").mapInArrow(count, "dims long, block long, cell long, homes long, guests long")
    totals = found.groupBy("dims", "block", "cell").agg(F.sum("homes").alias("homes"), F.sum("guests").alias("guests"))
    return {(r.dims, r.block, r.cell): (r.homes, r.guests) for r in totals.collect()}


def _chunk(nodes: np.ndarray, count: int) -> np.ndarray:
    mixed = nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(count)).astype(np.int64)


def _deal(
    node: np.ndarray, cell: np.ndarray, home: bool, key: tuple[int, int], sizes: dict, part_rows: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, cell, a, b and side of every part that rows of cells go to.

    Part (a, a) compares home chunk a with itself, (a, b) two home chunks, and (homes + g, b) guest chunk g with home chunk b.
    Where one part holds all homes and guests, guests go to it as the other side.
    """
    out: list[list[np.ndarray]] = [[], [], [], [], []]

    def send(rows: np.ndarray, c: int, a: np.ndarray | int, b: np.ndarray | int, side: int) -> None:
        for values, x in zip(out, (rows, c, a, b, side)):
            values.append(np.broadcast_to(np.asarray(x, np.int64), rows.shape))

    for c in np.unique(cell).tolist():
        rows = np.flatnonzero(cell == c)
        homes, guests = sizes[(*key, c)]
        h, g = -(-homes // part_rows), -(-guests // part_rows)
        if not h:
            continue  # guests of a cell without homes
        if home:
            mine = _chunk(node[rows], h)
            for other in range(h):
                low, high = np.minimum(mine, other), np.maximum(mine, other)
                for side in (0, 1):  # the lower chunk is the left side, the higher the right one; itself is both
                    chosen = (mine <= other) if side == 0 else (mine > other)
                    send(rows[chosen], c, low[chosen], high[chosen], side)
            if not (h == 1 and g == 1):
                for other in range(g):
                    send(rows, c, h + other, mine, 1)
        elif h == 1 and g == 1:
            send(rows, c, 0, 0, 1)
        else:
            mine = h + _chunk(node[rows], g)
            for other in range(h):
                send(rows, c, mine, other, 0)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def _parts(vectors: DataFrame, cells: dict[int, Cells], sizes: dict, part_rows: int) -> DataFrame:
    """Rows (dims, block, cell, a, b, side, node, n, data): every vector in every part that compares it."""
    single = vectors.schema["v"].dataType.elementType.typeName() == "float"

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for dims, chosen, data in _by_length(part, 2):
                unit, node = _unit(data), chosen.column(0).to_numpy()
                packed = pa.array([row.tobytes() for row in data.astype("<f4" if single else "<f8")], pa.binary())
                for block in range(len(cells[dims].bounds)):
                    own, guest, cell = cells[dims].places(unit, block)
                    for rows, places, home in ((np.arange(len(own)), own, True), (guest, cell, False)):
                        dealt, at, a, b, side = _deal(node[rows], places, home, (dims, block), sizes, part_rows)
                        taken = pa.array(rows[dealt])
                        same = np.ones(len(dealt), np.int32)
                        columns = [pa.array(same * dims), pa.array(same * block), pa.array(at), pa.array(a), pa.array(b)]
                        columns += [pa.array(side.astype(np.int32)), *(chosen.column(i).take(taken) for i in (0, 1)), packed.take(taken)]
                        yield pa.RecordBatch.from_arrays(columns, ["dims", "block", "cell", "a", "b", "side", "node", "n", "data"])

    schema = "dims int, block int, cell long, a long, b long, side int, node long, n long, data binary"
    return vectors.select("node", "n", "v").mapInArrow(place, schema)


def _lifted(coords: np.ndarray, left: bool) -> np.ndarray:
    """Single-precision rows whose products are minus half the squared distance."""
    half, one = -0.5 * (coords * coords).sum(1, keepdims=True), np.ones((len(coords), 1))
    return np.hstack([coords, *((half, one) if left else (one, half))]).astype(np.float32)


def compare_part(
    left: np.ndarray, right: np.ndarray, same: bool, block: int, cells: Cells, min_cosine: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a part: places in ``left`` and in ``right``, in bounded lists. ``same``: both sides are one list.

    The first test is over half of the block's coordinates: ``k`` products of unit vectors in single precision err by less
    than ``8 * (k + 4) * 2**-24``, which is added to the share.
    """
    x, y = _unit(left), _unit(right)
    rx, ry = x @ cells.turn, y @ cells.turn
    first, last = cells.bounds[block]
    half = (last - first + 1) // 2
    lx, ly = _lifted(rx[:, first : first + half], True), _lifted(ry[:, first : first + half], False).T.copy()
    bound = np.float32(-0.5 * (cells.shares[block] + 8 * (half + 4) * 2.0**-24))

    def decide(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        good = (x[i] * y[j]).sum(1) >= min_cosine
        for b in range(block + 1):
            low, high = cells.bounds[b]
            gap = ((rx[i, low:high] - ry[j, low:high]) ** 2).sum(1)
            good &= (gap <= cells.shares[b]) if b == block else (gap > cells.shares[b])
        return good

    def dense(rows: slice, columns: slice) -> tuple[np.ndarray, np.ndarray]:
        """Links of a tile by whole products; what is near a bound is decided by itself."""
        cosine = x[rows] @ y[columns].T
        good, unsure = cosine >= min_cosine, np.abs(cosine - min_cosine) < SLACK
        for b in range(block + 1):
            low, high = cells.bounds[b]
            p, q = rx[rows, low:high], ry[columns, low:high]
            gap = (p * p).sum(1)[:, None] + (q * q).sum(1) - 2 * (p @ q.T) - cells.shares[b]
            good &= (gap <= 0) if b == block else (gap > 0)
            unsure |= np.abs(gap) < SLACK / 2
        i, j = np.nonzero(unsure)
        good[i, j] = decide(rows.start + i, columns.start + j)
        return np.nonzero(good)

    for top in range(0, len(x), TILE[0]):
        for at in range(top - top % TILE[1] if same else 0, len(y), TILE[1]):
            rows, columns = slice(top, top + TILE[0]), slice(at, at + TILE[1])
            near = lx[rows] @ ly[:, columns] >= bound
            count = np.count_nonzero(near)
            if not count:
                continue
            i, j = dense(rows, columns) if count > DENSE * near.size else np.nonzero(near)
            if same:  # each pair once
                chosen = top + i < at + j
                i, j = i[chosen], j[chosen]
            i, j = top + i, at + j
            if count <= DENSE * near.size:
                good = decide(i, j)
                i, j = i[good], j[good]
            if len(i):
                yield i, j


def _joined(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join linked places in an array of group labels: the smallest label moves along links until none changes."""
    while True:
        a, b = labels[i], labels[j]
        if np.array_equal(a, b):
            return
        low = np.minimum(a, b)
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        while not np.array_equal(turned := labels[labels], labels):
            labels[:] = turned


def _part_links(part: pd.DataFrame, cells: Cells, block: int, single: bool, min_cosine: float) -> pd.DataFrame:
    """Rows (node, links, to): links counted with copies, and a forest over what is linked."""
    part = part.sort_values(["side", "node"])  # rows of a group come in any order
    data = np.frombuffer(b"".join(part["data"]), "<f4" if single else "<f8").reshape(len(part), -1)
    nodes, n = part["node"].to_numpy(), part["n"].to_numpy()
    links, labels = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    split = int((part["side"] == 0).sum())
    own = part["a"].iloc[0] == part["b"].iloc[0]
    for same, start in ((True, 0), (False, split)):
        if same and not own:
            continue
        for i, j in compare_part(data[:split], data[start:] if not same else data[:split], same, block, cells, min_cosine):
            j = j + start
            links += np.bincount(i, n[j], len(nodes)).astype(np.int64) + np.bincount(j, n[i], len(nodes)).astype(np.int64)
            _joined(labels, i, j)
    met = np.flatnonzero(links)
    return pd.DataFrame({"node": nodes[met], "links": links[met], "to": nodes[labels[met]]})


def vector_links(
    vectors: DataFrame, min_cosine: float = 0.9, blocks: int = BLOCKS, part_rows: int = PART_ROWS
) -> DataFrame:
    """Rows (node, links, to), stored: partial counts of linked rows and links that connect every class."""
    cells = _vector_cells(vectors, blocks, min_cosine, part_rows)
    sizes = _cell_sizes(vectors, cells)
    single = vectors.schema["v"].dataType.elementType.typeName() == "float"

    def link(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return _part_links(part, cells[int(key[0])], int(key[1]), single, min_cosine)

    tasks = sum(h * (h + 1) // 2 + g * h for h, g in ((-(-x // part_rows), -(-y // part_rows)) for x, y in sizes.values()))
    part = ["dims", "block", "cell", "a", "b"]
    found = _parts(vectors, cells, sizes, part_rows).repartition(max(1, tasks), *part).groupBy(*part)  # parts are not merged
    return materialize(found.applyInPandas(link, "node long, links long, to long"), "vector-links")


def near_vectors(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    min_cosine: float = 0.9,
    blocks: int = BLOCKS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Rows (key, n_links, component), one for each row.

    Copies of a vector link with each other. A vector that is null, empty, zero or not finite links with nothing and is a
    component of its own; so is one of another length than all others. Null keys are no component's name unless alone.
    """
    if not 0 < min_cosine <= 1:
        raise ValueError("min_cosine must be above 0 and at most 1")
    vectors = distinct_vectors(rows, key, vector)
    links = vector_links(vectors, min_cosine, blocks, part_rows)
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    roots = component_roots(links.where("node != to").select("node", "to")).withColumnRenamed("node", "member")
    rooted = vectors.join(roots, F.col("node") == F.col("member"), "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    known = (
        rooted.join(least, "root")
        .join(counts, "node", "left")
        .select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component")
    )
    keyed = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("v"))
    joined = keyed.join(known, "v", "left")
    return joined.select("key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "key").alias("component"))

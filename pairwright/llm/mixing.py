"""Mixing sources to target weights by minimum-cost flow over membership patterns.

Documents with the same set of sources are one node, so the network has a node for each pattern and each source, whatever
the number of documents. Capacity runs from a pattern to each of its sources; a second and a third pass over a pattern's
words cost more than the pass before, so words are repeated only where quotas cannot be met otherwise. The flow gives each
pattern a number of whole passes and a rest. Documents are drawn for the rest in the order of a seeded hash, up to a
threshold that is found from sums of hash ranges.
"""

from __future__ import annotations

import heapq
import math
from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf
from pyspark.sql.window import Window

from pairwright.llm.common import ascii_words, columns_of, free_name, result_name
from pairwright.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
MAX_PATTERNS = 500_000  # patterns whose sums come to the driver; more are refused
DOCS_PER_RANGE = 5_000
_HASH_DIGITS = 15  # hex digits of the seeded hash that order documents


@pandas_udf(T.LongType())
def word_count(text: pd.Series) -> pd.Series:
    """Words of each whole text, split at ASCII white space; null has none."""
    return pd.Series([len(ascii_words(t)) for t in text], dtype="int64")


def source_targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, most: float = MAX_REPEATS) -> dict[str | None, float]:
    """Words wanted of each source: the sum of all sizes shared by weight, at most ``most`` times a source's size.

    Sources are in code point order, null last, and take the weights in turn. What a source cannot take is shared anew
    among the others, until none is above its bound.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, found, open_ = float(sum(sizes.values())), {}, list(order)
    while open_:
        level = max(0.0, total - sum(found.values())) / sum(weight[s] for s in open_)
        above = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not above:
            found |= {s: level * weight[s] for s in open_}
            break
        found |= {s: float(most * sizes[s]) for s in above}
        open_ = [s for s in open_ if s not in found]
    return {s: found[s] for s in order}


def pattern_flow(
    patterns: dict[frozenset, float], targets: dict[str | None, float], most: int = MAX_REPEATS
) -> dict[frozenset, float]:
    """Words to take of each pattern: minimum-cost flow from patterns to source quotas with convex repetition costs.

    Pass k over a pattern costs more a word than pass k - 1 over any, and words cost nothing else. So shortest paths use
    all first passes that still reach an open quota, by rerouting what has been placed where needed, before any second.

    Paths are sought over sources alone: source s leads to t if a pattern that feeds s could feed t, and of these patterns a
    heap has the one that feeds s most. Sources from which no open quota can be reached never open again, so no pattern
    searches them twice.
    """
    order = sorted(targets, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(order)}
    members = [tuple(sorted(place[s] for s in p if s in place)) for p in patterns]
    left = [float(targets[s]) for s in order]
    taken = [0.0] * len(members)
    flow: dict[tuple[int, int], float] = {}
    heaps: dict[tuple[int, int], list[tuple[float, int]]] = {}
    leads: list[set[int]] = [set() for _ in order]
    closed = [False] * len(order)
    scale = max([1.0, *left]) * 1e-12

    def feed(pattern: int, s: int, amount: float) -> None:
        flow[pattern, s] = held = flow.get((pattern, s), 0.0) + amount
        if held > scale and amount > 0:
            for t in members[pattern]:
                if t != s:
                    heapq.heappush(heaps.setdefault((s, t), []), (-held, pattern))
                    leads[s].add(t)

    def feeder(s: int, t: int) -> int | None:
        """The pattern that feeds s most of those that could feed t."""
        heap = heaps[s, t]
        while heap:
            known, pattern = heap[0]
            held = flow[pattern, s]
            if held <= scale or held > -known:  # gone, or listed again since
                heapq.heappop(heap)
            elif held < -known:
                heapq.heapreplace(heap, (-held, pattern))
            else:
                return pattern
        leads[s].discard(t)
        return None

    def path_from(starts: list[int]) -> list[int] | None:
        """Sources from one of the starts to an open quota; None if there is none, and what was reached is closed."""
        came: dict[int, int | None] = dict.fromkeys(starts)
        queue = deque(starts)
        while queue:
            s = queue.popleft()
            if left[s] > scale:
                path = [s]
                while (s := came[s]) is not None:
                    path.append(s)
                return path[::-1]
            for t in sorted(leads[s]):
                if t not in came and not closed[t] and feeder(s, t) is not None:
                    came[t] = s
                    queue.append(t)
        for s in came:
            closed[s] = True
        return None

    for _ in range(most):
        for start, size in enumerate(patterns.values()):
            spare = float(size)
            while spare > scale:
                starts = [s for s in members[start] if not closed[s]]
                near = next((s for s in starts if left[s] > scale), None)
                path = [near] if near is not None else path_from(starts) if starts else None
                if path is None:
                    break
                moved = [(feeder(s, t), s, t) for s, t in zip(path, path[1:])]
                amount = min([spare, left[path[-1]], *(flow[q, s] for q, s, _ in moved)])
                feed(start, path[0], amount)
                for q, s, t in moved:
                    feed(q, s, -amount)
                    feed(q, t, amount)
                left[path[-1]] -= amount
                spare -= amount
                taken[start] += amount
    return dict(zip(patterns, taken))


def seeded_order(key: str, seed: int) -> Column:
    """A number of 60 bits from the document's key and the seed; documents are drawn in its order."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, _HASH_DIGITS), 16, 10).cast("long")


def _thresholds(rows: DataFrame, rests: list[tuple[str, float, int]]) -> dict[str, int]:
    """The place in the seeded order at which the sum of sizes comes nearest to each pattern's rest; -1: none is drawn.

    Sums of hash ranges find the range that the rest ends in, and only that range is summed document by document.
    """
    spark = rows.sparkSession
    wanted = spark.createDataFrame(rests, "pattern string, rest double, ranges long")  # one row for each pattern
    width = F.lit(float(1 << (4 * _HASH_DIGITS)))
    dealt = rows.join(F.broadcast(wanted), "pattern").withColumn(
        "range", F.least(F.floor(F.col("place") / width * F.col("ranges")), F.col("ranges") - 1).cast("long")
    )
    along = Window.partitionBy("pattern").orderBy("range")
    sums = dealt.groupBy("pattern", "range", "rest").agg(F.sum("size").alias("size"))
    sums = sums.withColumn("upto", F.sum("size").over(along))
    ends = sums.where("upto >= rest").groupBy("pattern").agg(F.min(F.struct("range", F.expr("upto - size").alias("before"))).alias("end"))
    ends = ends.select("pattern", "end.range", "end.before")
    by_place = dealt.join(F.broadcast(ends), ["pattern", "range"])
    by_place = by_place.groupBy("pattern", "range", "rest", "before", "place").agg(F.sum("size").alias("size"))
    upto = F.col("before") + F.sum("size").over(Window.partitionBy("pattern", "range").orderBy("place"))
    near = by_place.withColumn("upto", upto).where(F.col("upto") - F.col("size") / 2 <= F.col("rest"))
    found = {r.pattern: r.place for r in near.groupBy("pattern").agg(F.max("place").alias("place")).collect()}
    # a range of which no document is drawn: the order stops before it
    starts = {r.pattern: (r.range, r.ranges) for r in ends.join(wanted, "pattern").select("pattern", "range", "ranges").collect()}
    for pattern, (at, ranges) in starts.items():
        if pattern not in found:
            found[pattern] = math.ceil(at / ranges * float(1 << (4 * _HASH_DIGITS))) - 1
    return found


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sources: Column | None = None,
    seed: int = 7,
    weights: tuple[float, ...] = WEIGHTS,
    result: str = "mix",
) -> DataFrame:
    """Add a struct (size, source_size, target, copies): how often the mix takes each document, 0 to 3 times.

    ``sources`` is an array of the sources a document belongs to; by default the column ``source`` alone. Null is a source
    of its own. Of a document in several sources, ``source_size`` and ``target`` are sums over these. Texts without words
    have size 0. Equal keys have equal places in the seeded order, so repeated rows are drawn together. The struct is the last
    column; a name in use gets underscores before it.
    """
    result = result_name(docs, result)
    sources = F.array(F.col("source")) if sources is None else F.coalesce(sources, F.array(F.lit(None).cast("string")))
    pattern = F.to_json(F.array_sort(F.array_distinct(sources)))
    size, place = word_count(F.col(f"`{text}`")), seeded_order(key, seed)
    members = F.array_distinct(sources)
    rows = docs.select(pattern.alias("pattern"), members.alias("members"), size.alias("size"), place.alias("place"))
    rows = materialize(rows, "mix-sizes")
    sums = rows.groupBy("pattern").agg(F.min("members").alias("members"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    found = sorted(sums.limit(MAX_PATTERNS + 1).collect(), key=lambda r: r.pattern)  # reruns take patterns in one order
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} combinations of sources")
    sizes: dict[str | None, int] = {}
    for row in found:
        for s in row.members:
            sizes[s] = sizes.get(s, 0) + row.size
    targets = source_targets(sizes, weights)
    amounts = pattern_flow({frozenset(r.members): float(r.size) for r in found}, targets)
    passes = {r.pattern: min(MAX_REPEATS, int(amounts[frozenset(r.members)] // r.size)) if r.size else 0 for r in found}
    rests = [
        (r.pattern, amounts[frozenset(r.members)] - passes[r.pattern] * r.size, -(-r.n // DOCS_PER_RANGE))
        for r in found
        if r.size and passes[r.pattern] < MAX_REPEATS
    ]
    last = _thresholds(rows, [r for r in rests if r[1] > 0]) if rests else {}
    shares = docs.sparkSession.createDataFrame(
        [
            (r.pattern, sum(sizes[s] for s in r.members), float(sum(targets[s] for s in r.members)), passes[r.pattern], last.get(r.pattern, -1))
            for r in found
        ],
        "pattern string, source_size long, target double, passes long, last long",
    )  # one row for each pattern, at most MAX_PATTERNS
    p, s, o = free_name(docs, "_pattern", "_size", "_place")
    share = F.struct("source_size", "target", "passes", "last").alias(result)
    sent = shares.select(F.col("pattern").alias(p), share)
    if len(found) <= 20_000:
        sent = F.broadcast(sent)
    joined = docs.withColumn(p, pattern).withColumn(s, size).withColumn(o, place).join(sent, p)
    copies = (F.col(f"{result}.passes") + (F.col(o) <= F.col(f"{result}.last")).cast("long")).alias("copies")
    mixed = F.struct(F.col(s).alias("size"), F.col(f"{result}.source_size"), F.col(f"{result}.target"), copies)
    return joined.withColumn(result, mixed).select(*columns_of(docs), result)

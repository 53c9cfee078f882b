"""Packing into sequences by cutting-stock column generation.

Documents are tokenized once and cut into pieces of at most one sequence. The lengths of the pieces, rounded up to classes,
make a histogram, which is all that the planning needs: a linear program over patterns (how many pieces of each class one
sequence takes) is solved by column generation, where a knapsack dynamic program prices new patterns. Patterns are used as
often as their rounded share says; the few pieces left are filled in by best fit or by exact subset sums. The plan gives each rank
within a class its sequence and slot, so ranked pieces find their places by a lookup, whatever their number.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairwright.llm.common import ascii_words
from pairwright.llm.tokens import load_tokenizer
from pairwright.session import materialize

FEW_PIECES = 20_000  # up to so many, the plan is held against best fit alone
RANKS_PER_TASK = 20_000  # pieces of one class that are numbered together


_LETTERS = re.compile(r"[a-zß-öø-ÿ]*")  # letters that are in composed form
_MARKS = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
# Entries that a task remembers at most, some 150 bytes each. No result depends on them. Words are many, as each comes with
# marks and capitals of its own; their parts are fewer, cost more to find, and a word is soon put together from them.
KNOWN_WORDS, KNOWN_PARTS = 80_000, 220_000
_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The printable character that stands for each byte in byte-level vocabularies: the byte's own, or the next free one.
_AS_CHAR = {
    **{b: b for b in _BYTES},
    **{b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _BYTES)},
}


def _trim(known: dict, size: int) -> None:
    """Make room in a table that is full. What came first, and so comes often, stays."""
    if len(known) > size:
        kept = list(islice(known.items(), size // 2))
        known.clear()
        known.update(kept)


class WordIds:
    """Token ids of texts, as little-endian bytes, for a tokenizer that drops white space and reads words on their own.

    The tokenizer must put text into composed form and lower case and part letters from marks before its model sees it, as
    :func:`check_tokenizer` tests. Words of plain letters and marks then go to its model in these two parts; all others
    go through the whole tokenizer.
    """

    def __init__(self, path: str, words: int = KNOWN_WORDS, parts: int = KNOWN_PARTS) -> None:
        self.path = path
        self.sizes = words, parts
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {b"": b""}  # runs of lower-case letters, runs of marks

    def _part(self, part: bytes) -> bytes:
        tokens = load_tokenizer(self.path).model.tokenize(part.decode("latin-1").translate(_AS_CHAR))
        ids = self.parts[part] = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        return ids

    def _word(self, word: bytes) -> bytes:
        lower = word.lower()
        letters = lower.rstrip(_MARKS)
        ids = self.parts.get(letters)
        if ids is None and not _LETTERS.fullmatch(letters.decode()):
            tokens = load_tokenizer(self.path).encode(word.decode(), add_special_tokens=False).ids
            ids = struct.pack(f"<{len(tokens)}I", *tokens)
        else:
            if ids is None:
                ids = self._part(letters)
            if marks := lower[len(letters) :]:
                more = self.parts.get(marks)
                ids += self._part(marks) if more is None else more
        self.known[word] = ids
        return ids

    def __call__(self, text: str | None) -> bytes:
        _trim(self.known, self.sizes[0])
        _trim(self.parts, self.sizes[1])
        words = ascii_words(text)
        found = list(map(self.known.get, words))
        if None in found:
            known = self.known
            for i, ids in enumerate(found):
                if ids is None:  # or known by now, if it comes twice
                    word = words[i]
                    found[i] = known[word] if word in known else self._word(word)
        return b"".join(found)


def check_tokenizer(path: str) -> None:
    """Refuse a tokenizer that does not read words as :class:`WordIds` takes it to."""
    tokenizer = load_tokenizer(path)
    ids = WordIds(path)
    for text in ("Plain words, and (some) marks!!", "\u00c4rger \u00fcber d\u00e9j\u00e0-vu...", "it's 3.5% don't", "e\u0301t\u00e9 \u4e2d\u6587", "a\tb\n\nc"):
        whole = tokenizer.encode(text, add_special_tokens=False).ids
        if ids(text) != struct.pack(f"<{len(whole)}I", *whole):
            raise ValueError(f"{path} does not read words on their own")


@lru_cache(maxsize=4)
def word_ids(path: str, parts: int) -> WordIds:
    return WordIds(path, parts=parts)


def token_pieces(
    docs: DataFrame, path: str, key: str, text: str, capacity: int, end_id: int, known_parts: int = KNOWN_PARTS
) -> DataFrame:
    """Rows (key, start, length, ids_crc32, doc_tokens): each document's ids and the end id in runs of ``capacity``."""
    end = struct.pack("<I", end_id)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            source, starts, lengths, sums, totals = [], [], [], [], []
            for row in range(batch.num_rows):
                ids = word_ids(path, known_parts)(batch.column(1)[row].as_py()) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    source.append(row)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(total)
            keys = batch.column(0).take(pa.array(source, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [keys, *[pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]],
                ["key", "start", "length", "ids_crc32", "doc_tokens"],
            )

    key_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, f"key {key_type}, start long, length long, ids_crc32 long, doc_tokens long")


# --- planning over the histogram ----------------------------------------------------------------------------------------


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack dynamic program: the most valuable multiset of sizes within the capacity, and its counts."""
    order = np.argsort(sizes, kind="stable")
    order = order[values[order] > 1e-12]
    ranked, worth = sizes[order], values[order]
    limits = np.searchsorted(ranked, np.arange(capacity + 1), "right")
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if n := limits[room]:
            gains = best[room - ranked[:n]] + worth[:n]
            i = int(gains.argmax())
            if gains[i] > best[room] + 1e-12:
                best[room], choice[room] = gains[i], i
    counts = np.zeros(len(sizes), int)
    room = capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[order[choice[room]]] += 1
            room -= int(ranked[choice[room]])
    return float(best[capacity]), counts


def fractional_patterns(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 2e-3, rounds: int = 3000
) -> list[tuple[np.ndarray, float]]:
    """Linear program over patterns by column generation: patterns and how often each is used, not rounded.

    Stops when the bound from the last pricing shows the value to be within ``gap`` of the best. The basis has one pattern
    a size, and its inverse is updated with each column that enters. Rounding errors can only make the plan less tight:
    uses are cut to what is left of each size.
    """
    m = len(sizes)
    columns = [np.zeros(m, int) for _ in range(m)]
    for i in range(m):
        columns[i][i] = capacity // sizes[i]
    inverse = np.diag([1.0 / columns[i][i] for i in range(m)])
    costs = np.ones(m)
    wanted = demand + np.linspace(0.01, 0.02, m)  # tells equal ratios apart, so that no turn stands still
    used = (inverse * wanted).sum(1)
    for _ in range(rounds):
        duals = (inverse * costs[:, None]).sum(0)
        if duals[least := int(duals.argmin())] < -1e-9:
            pattern, cost = np.zeros(m, int), 0.0  # a surplus: more of this size may be held than there is
            pattern[least] = -1
        else:
            value, pattern = best_pattern(sizes, duals, capacity)
            cost = 1.0
            if value <= 1 + gap:
                break
        held = np.flatnonzero(pattern)
        step = (inverse[:, held] * pattern[held]).sum(1)  # a pattern holds few sizes
        ratio = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        row = int(ratio.argmin())
        if not np.isfinite(ratio[row]):
            break
        columns[row], costs[row] = pattern, cost
        pivot = inverse[row] / step[row]
        inverse -= step[:, None] * pivot
        inverse[row] = pivot
        used = np.maximum((inverse * wanted).sum(1), 0)
    return [(c, float(x)) for c, x, cost in zip(columns, used, costs) if x > 1e-9 and cost]


def fill_exactly(rest: Counter[int], capacity: int) -> list[Counter[int]]:
    """Sequences for a bounded number of pieces: the largest left and the subset of the others that fills best."""
    rest, filled = Counter(rest), []
    while rest := +rest:
        largest = max(rest)
        chosen = Counter({largest: 1})
        rest[largest] -= 1
        room = capacity - largest
        items = [s for s in sorted(rest, reverse=True) if s <= room for _ in range(min(rest[s], room // s))]
        reach, steps, mask = 1, [], (1 << (room + 1)) - 1
        for s in items:
            steps.append(reach)
            reach |= (reach << s) & mask
            if reach >> room & 1:
                break
        at = reach.bit_length() - 1
        for s, before in zip(reversed(items[: len(steps)]), reversed(steps)):
            if not before >> at & 1:
                chosen[s] += 1
                at -= s
        rest.subtract(chosen - Counter({largest: 1}))
        filled.append(chosen)
    return filled


def fill_best_fit(rest: Counter[int], capacity: int) -> list[Counter[int]]:
    """Sequences for a bounded number of pieces: from the largest on, each goes where the least room is left."""
    rooms: list[list[Counter[int]]] = [[] for _ in range(capacity + 1)]
    for size in sorted(rest.elements(), reverse=True):
        room = next((r for r in range(size, capacity) if rooms[r]), None)
        held = Counter() if room is None else rooms[room].pop()
        held[size] += 1
        rooms[(capacity if room is None else room) - size].append(held)
    return [held for some in rooms for held in some]


@dataclass(frozen=True)
class Place:
    """Ranks ``low`` to ``high`` of a class go to sequences from ``sequence`` on, ``each`` to one, at slots from ``slot``."""

    size: int
    low: int
    high: int
    each: int
    sequence: int
    slot: int


def plan_sequences(histogram: dict[int, int], capacity: int) -> list[Place]:
    """Places for all pieces of a histogram of class sizes; each sequence holds at most the capacity."""
    sizes = np.array(sorted((s for s, n in histogram.items() if n > 0), reverse=True), int)
    if not len(sizes):
        return []
    if sizes[0] > capacity or sizes[-1] < 1:
        raise ValueError("sizes must be 1 to the capacity")
    demand = np.array([histogram[int(s)] for s in sizes])
    left = demand.copy()
    uses: Counter[tuple[tuple[int, int], ...]] = Counter()
    parts = fractional_patterns(sizes, demand, capacity)
    # whole shares first, then one more of each pattern that still finds its pieces, by the fraction that is left
    for pattern, times in [(p, int(x + 1e-6)) for p, x in parts] + [(p, 1) for p, x in sorted(parts, key=lambda x: -(x[1] % 1))]:
        held = pattern > 0
        whole = min(times, int((left[held] // pattern[held]).min()))
        if whole > 0:
            left -= whole * pattern
            uses[tuple((int(s), int(n)) for s, n in zip(sizes, pattern) if n)] += whole
    rest = Counter({int(s): int(n) for s, n in zip(sizes, left) if n})
    fills = min(fill_best_fit(rest, capacity), fill_exactly(rest, capacity), key=len)
    uses += Counter(tuple(sorted(c.items())) for c in fills)
    if demand.sum() <= FEW_PIECES:  # so few that rounding may cost more than planning gains
        direct = Counter(tuple(sorted(c.items())) for c in fill_best_fit(Counter(dict(zip(sizes.tolist(), demand.tolist()))), capacity))
        uses = min(uses, direct, key=Counter.total)
    places, ranks, sequence = [], Counter(), 0
    for pattern, times in uses.items():
        slot = 0
        for size, each in sorted(pattern, reverse=True):
            places.append(Place(size, ranks[size], ranks[size] + each * times, each, sequence, slot))
            ranks[size] += each * times
            slot += each
        sequence += times
    return places


# --- ranks and places ---------------------------------------------------------------------------------------------------


def pack(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 4096,
    end_id: int = 2,
    step: int = 8,
    known_parts: int = KNOWN_PARTS,
) -> DataFrame:
    """Rows (key, start, length, ids_crc32, doc_tokens, sequence_id, offset), one for each piece.

    A null or empty text is the end id alone. Only a document longer than the capacity is cut. Classes are multiples of
    ``step``, so planning sees ``capacity / step`` numbers, and a piece wastes less than ``step`` tokens beside what its
    pattern leaves. Ranks within a class are numbered in parts, so a class with a third of all pieces is no bottleneck;
    repeated rows are ranked side by side, and which of them is where makes no difference to the result. ``known_parts`` are
    the parts of words whose ids a task remembers, some 150 bytes each: more cost memory, fewer cost time.
    """
    if capacity % step:
        raise ValueError("step must divide capacity")
    check_tokenizer(path)
    pieces = token_pieces(docs, path, key, text, capacity, end_id, known_parts)
    pieces = materialize(pieces.withColumn("at", F.monotonically_increasing_id()), "pieces")  # tells repeated rows apart
    size = (F.ceil(F.col("length") / step) * step).cast("long")
    histogram = {r.size: r.n for r in pieces.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}
    units = plan_sequences({s // step: n for s, n in histogram.items()}, capacity // step)
    spark = docs.sparkSession
    plan = spark.createDataFrame(
        [(p.size * step, p.low, p.high, p.each, p.sequence, p.slot) for p in units],
        "size long, low long, high long, each long, first long, slot long",
    )  # a few rows for each of capacity / step patterns
    parts = spark.createDataFrame(
        [(s, -(-n // RANKS_PER_TASK)) for s, n in histogram.items()], "size long, parts long"
    )  # capacity / step rows at most
    mark = F.xxhash64("key", "start", "ids_crc32", "doc_tokens")
    dealt = (
        pieces.withColumn("size", size)
        .withColumn("mark", mark)
        .join(F.broadcast(parts), "size")
        .withColumn("part", F.pmod(F.xxhash64("mark", "at"), F.col("parts")))
        .drop("parts")
    )
    before = F.sum("n").over(Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums = dealt.groupBy("size", "part").agg(F.count(F.lit(1)).alias("n"))
    sums = sums.select("size", "part", F.coalesce(before, F.lit(0)).alias("before"))
    order = Window.partitionBy("size", "part").orderBy("mark", "key", "start", "length", "ids_crc32", "doc_tokens")
    ranked = dealt.withColumn("nth", F.row_number().over(order)).join(sums, ["size", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("nth") - 1)
    within = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = ranked.join(F.broadcast(plan), "size").where(within)
    placed = placed.withColumn("turn", F.col("rank") - F.col("low")).withColumns(
        {
            "sequence_id": F.col("first") + F.floor(F.col("turn") / F.col("each")).cast("long"),
            "slot": F.col("slot") + F.pmod("turn", "each"),
        }
    )
    offset = F.sum("length").over(
        Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.select(
        "key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(offset, F.lit(0)).alias("offset")
    )

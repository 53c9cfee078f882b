"""SimHash near-dedup with pigeonring filtering.

Fingerprints are split into segments on a ring. If two differ in at most ``max_bits`` bits, some segment starts a chain:
the first 1, 2, ... consecutive segments together differ in at most 1, 2, ... shares of ``max_bits / segments`` bits. The
first two links of the chain are an equi-join key: one side gives its two segments as they are, the other with every
change that the first two budgets allow. Longer chains and the full distance are checked on the joined pairs. With 64 bits,
4 segments and 3 bits a key has 32 bits, of which the first 16 must be equal and the next 16 may differ in one.

Equal fingerprints are one row before anything is joined, so copies meet in no join.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from pairwright.llm.common import ascii_words, columns_of, free_name, text_key
from pairwright.llm.components import component_roots
from pairwright.session import materialize

BITS = 64


def shingles(text: str | None, size: int = 3) -> list[bytes]:
    """Word shingles of a text with A-Z in lower case, repeats included; a shorter text is one shingle, none without words."""
    words = [w.lower() for w in ascii_words(text)] if text else []
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])
    return [joined[s:e] for s, e in zip(starts[:-size].tolist(), (starts[size:] - 1).tolist())]


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """64-bit SimHash over shingle hashes, signed. A bit is set if over half of the hashes have it; no words: zero."""
    parts = shingles(text, size)
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(parts), 1 << 16):
        hashes = np.array([digest(p, seed) for p in parts[at : at + (1 << 16)]], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(parts)).view(">u8")[0].astype(np.uint64).view(np.int64))


@pandas_udf(T.LongType())
def _fingerprint3(text: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in text], dtype="int64")


def fingerprint_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, t1, t2, fp), stored: the fingerprint of each whole text beside the hash of the text."""
    t1, t2 = text_key(text)
    rows = docs.select(F.col(key).alias("key"), t1.alias("t1"), t2.alias("t2"), _fingerprint3(F.col(text)).alias("fp"))
    return materialize(rows, "fingerprints")


def chain_budgets(max_bits: int, segments: int) -> list[int]:
    """Bits that the first 1, 2, ... segments of a chain may differ in together."""
    return [(n * max_bits) // segments for n in range(1, segments + 1)]


def _key_changes(width: int, budgets: list[int]) -> list[int]:
    """All changes of two consecutive segments that keep within the first two budgets."""
    found = []
    for first in range(budgets[0] + 1):
        for a in combinations(range(width, 2 * width), first):
            for second in range(budgets[1] - first + 1):
                found += [sum(1 << x for x in (*a, *b)) for b in combinations(range(width), second)]
    return found


def _segment(fp: Column, i: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1))


def _chain_key(fp: Column, i: int, width: int, segments: int) -> Column:
    first, second = _segment(fp, i, width), _segment(fp, (i + 1) % segments, width)
    return F.shiftleft(F.lit(i).cast("long"), 2 * width).bitwiseOR(F.shiftleft(first, width)).bitwiseOR(second)


def fingerprint_links(prints: DataFrame, max_bits: int = 3, segments: int = 4) -> DataFrame:
    """Every pair (a, b) of distinct fingerprints that differ in at most ``max_bits`` bits, once. ``prints``: column fp."""
    if BITS % segments or not 3 <= segments <= 16 or max_bits >= BITS:
        raise ValueError("segments must divide 64 and be 3 to 16")
    width, budgets = BITS // segments, chain_budgets(max_bits, segments)
    if 2 * width + 4 > BITS - 1:
        raise ValueError("segments are too wide for one key")
    changes = F.array(*[F.lit(x).cast("long") for x in _key_changes(width, budgets)])
    fp = F.col("fp")
    keys = F.explode(F.array(*[_chain_key(fp, i, width, segments) for i in range(segments)]))
    left = prints.select(fp.alias("a"), keys.alias("key")).select("a", F.explode(changes).alias("change"), "key")
    left = left.select("a", F.col("key").bitwiseXOR(F.col("change")).alias("key"))
    right = prints.select(fp.alias("b"), keys.alias("key"))
    # sizes are estimated from before the rows are multiplied, so neither side may be broadcast on such an estimate
    met = left.hint("merge").join(right.hint("merge"), "key").where("a < b")
    xor = F.col("a").bitwiseXOR(F.col("b"))
    differ = [F.bit_count(_segment(xor, i, width)) for i in range(segments)]

    def viable(i: int) -> Column:
        """Whether the chain that starts at segment i keeps all its budgets; the last is the full distance."""
        total, within = F.lit(0), F.lit(True)
        for n, budget in enumerate(budgets):
            total = total + differ[(i + n) % segments]
            within = within & (total <= budget)
        return within

    start = F.shiftrightunsigned("key", 2 * width).cast("int")
    first = F.coalesce(*[F.when(viable(i), F.lit(i)) for i in range(segments)])
    return met.where(start == first).select("a", "b")


def fingerprint_groups(prints: DataFrame, key: str = "key", max_bits: int = 3) -> DataFrame:
    """Rows (fp, root, component) for each distinct fingerprint: the smallest fingerprint and the smallest key that links
    reach. Null keys don't count; a component without any other key has a null one.
    """
    distinct = materialize(prints.groupBy("fp").agg(F.min(key).alias("least")), "distinct-fingerprints")
    roots = component_roots(fingerprint_links(distinct, max_bits))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return rooted.join(least, "root").select("fp", "root", "component")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = 3) -> DataFrame:
    """Rows (key, fp, component), one for each document.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows are in one component.
    """
    prints = fingerprint_rows(docs, key, text)
    return prints.join(fingerprint_groups(prints, max_bits=max_bits), "fp").select("key", "fp", "component")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = 3) -> DataFrame:
    """One document of each group of near duplicates: the smallest key, of equal keys the smallest text hash.

    Null keys come last. The document that stays is sought in each fingerprint, then in each component, so no copy and no
    member of a large component goes to another's task: both are minima that tasks take before the shuffle. Documents are
    joined with the key and text hash of what stays. Rows that repeat a document that stays are reduced to one, which
    shuffles only such rows.
    """
    prints = fingerprint_rows(docs, key, text)
    rows = prints.groupBy("fp", "key", "t1", "t2").agg(F.count(F.lit(1)).alias("n"))
    place = F.struct(F.col("key").isNull().alias("last"), "key", "t1", "t2", "n")
    first = rows.groupBy("fp").agg(F.min(place).alias("first"))
    groups = fingerprint_groups(prints, max_bits=max_bits).select("fp", "root")
    best = first.join(groups, "fp").groupBy("root").agg(F.min("first").alias("first"))
    names = k, a, b, times = free_name(docs, "_key", "_t1", "_t2", "_n")
    stays = best.select(*[F.col("first")[x].alias(y) for x, y in zip(("key", "t1", "t2", "n"), names)])
    stays = materialize(stays, "staying")
    t1, t2 = text_key(text)
    here = (F.col(key).eqNullSafe(stays[k])) & (t1 == stays[a]) & (t2 == stays[b])
    # the same plan at every size: what stays grows with the documents
    joined = docs.hint("merge").join(stays.hint("merge"), here)
    single = joined.where(F.col(times) == 1).select(*columns_of(docs))
    if stays.where(F.col(times) > 1).isEmpty():
        return single
    return single.unionByName(joined.where(F.col(times) > 1).dropDuplicates([k, a, b]).select(*columns_of(docs)))

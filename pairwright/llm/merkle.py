"""Document fingerprints: a Merkle tree over paragraphs and sections, in native expressions only.

A paragraph is a line of the text, and its node the SHA-256 of the line. Sections are runs of paragraphs whose ends follow
from the content: a section ends after a paragraph whose digest begins with 0 to 3, about one in four, so a new paragraph
moves no other section's end. A section's node is the SHA-256 of its paragraphs' digests, the root that of its sections'
digests. Two texts are equal if their roots are; otherwise equal nodes at the front and at the back leave the branches that
differ, and with them the range of code points that holds the edits (:func:`edit_range`).

Below the paragraphs are segments of 16 to 65 code points, cut at white space, of which short digests are kept in order of
their values. Likeness is twice the number of common segments, repeats counted, over the number of both (Dice), and 1 for
equal roots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.operators.keys import row_ids
from pairwright.session import materialize

SEGMENT = r"[^\n]{16,64}?[\x20\t]|[^\n]{1,64}"
NODE_DIGITS = 16  # of a section's or paragraph's digest in a written fingerprint; the nodes themselves are whole
SEGMENT_DIGITS = 8
RUN = f"([0-9a-f]{{{SEGMENT_DIGITS}}})\\1*"  # equal digests next to each other in sorted ones
REPEATS = 10_000  # rows of one key and text from which on the results of their copies are dealt over tasks


def merkle_tree(text: Column) -> Column:
    """Struct (root, sections, paragraphs, lengths, segments) of a text; null counts as empty.

    The empty text is one empty paragraph without segments. ``lengths`` are the code points of the paragraphs, ``segments``
    the sorted digests in one string.
    """
    whole = F.coalesce(text, F.lit(""))
    lines = F.split(whole, "\n")
    paragraphs = F.transform(lines, lambda line: F.sha2(line, 256))
    ended = F.transform(paragraphs, lambda d: F.concat(d, F.when(F.substring(d, 1, 1) < "4", ";").otherwise(",")))
    runs = F.filter(F.split(F.array_join(ended, ""), ";"), lambda run: run != "")
    segments = F.regexp_extract_all(whole, F.lit(SEGMENT), F.lit(0))
    digests = F.transform(segments, lambda s: F.substring(F.sha2(s, 256), 1, SEGMENT_DIGITS))
    below = F.struct(
        F.transform(runs, lambda run: F.sha2(run, 256)).alias("sections"),
        paragraphs.alias("paragraphs"),
        F.transform(lines, F.length).alias("lengths"),
        F.array_join(F.array_sort(digests), "").alias("segments"),
    )
    # the one pass of a transform names the lower levels once, so the root does not compute them again
    rooted = F.transform(
        F.array(below),
        lambda t: F.struct(
            F.sha2(F.array_join(t["sections"], ""), 256).alias("root"),
            t["sections"].alias("sections"),
            t["paragraphs"].alias("paragraphs"),
            t["lengths"].alias("lengths"),
            t["segments"].alias("segments"),
        ),
    )
    return rooted[0]


def written(tree: Column) -> Column:
    """A tree as text: root, sections, paragraphs and segments, with digests of fixed lengths."""
    short = lambda nodes: F.array_join(F.transform(nodes, lambda d: F.substring(d, 1, NODE_DIGITS)), "")
    return F.concat_ws("/", tree["root"], short(tree["sections"]), short(tree["paragraphs"]), tree["segments"])


def _numbered(segments: Column) -> Column:
    """Sorted digests d, d, d as an array of d, d*2, d*3, so that a set of numbered digests is a multiset of digests."""

    def number(run: Column) -> Column:
        digest = F.substring(run, 1, SEGMENT_DIGITS)
        times = F.sequence(F.lit(1), (F.length(run) / SEGMENT_DIGITS).cast("int"))
        return F.transform(times, lambda k: F.when(k == 1, digest).otherwise(F.concat_ws("*", digest, k)))

    return F.flatten(F.transform(F.regexp_extract_all(segments, F.lit(RUN), F.lit(0)), number))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: 1 for equal roots, otherwise the Dice coefficient of the segments."""
    common = F.size(F.array_intersect(_numbered(a["segments"]), _numbered(b["segments"]))).cast("double")
    both = (F.length(a["segments"]) + F.length(b["segments"])) / SEGMENT_DIGITS
    return F.when(a["root"] == b["root"], 1.0).when(both == 0, 0.0).otherwise(2 * common / both)


def _leading(a: Column, b: Column) -> Column:
    """How many entries at the front of two arrays are equal."""
    shorter = F.least(F.size(a), F.size(b))
    differ = F.array_position(F.zip_with(F.slice(a, F.lit(1), shorter), F.slice(b, F.lit(1), shorter), lambda x, y: x == y), False)
    return F.when(differ > 0, differ.cast("int") - 1).otherwise(shorter)


def _length(lengths: Column) -> Column:
    """Code points of paragraphs and of a line break after each."""
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda sum_, n: sum_ + n + 1)


def edit_range(a: Column, b: Column) -> Column:
    """Struct (start, end): code points of the first text, end exclusive, outside which the paragraphs of both agree.

    Null for equal texts. The range is whole paragraphs of the first text; it is empty where the second text only has
    paragraphs more. Paragraphs are compared only in what the equal sections at both ends leave.
    """
    paragraphs = F.size(a["paragraphs"])
    front = _leading(a["paragraphs"], b["paragraphs"])
    back = F.least(
        _leading(F.reverse(a["paragraphs"]), F.reverse(b["paragraphs"])),
        paragraphs - front,
        F.size(b["paragraphs"]) - front,
    )
    whole = _length(a["lengths"]) - 1
    start = F.least(_length(F.slice(a["lengths"], F.lit(1), front)), whole)
    end = F.greatest(start, whole - _length(F.slice(F.reverse(a["lengths"]), F.lit(1), back)))
    return F.when(a["root"] != b["root"], F.struct(start.alias("start"), end.alias("end")))


def _chain(docs: DataFrame) -> DataFrame:
    """Rows (g1, g2, key, copies, asked, p1, p2): each distinct row, what the row before asks of its text, and that row's name."""
    groups = docs.groupBy("g1", "g2").agg(
        F.first("key").alias("key"), F.max("h1").alias("h1"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n")
    )
    groups = materialize(groups, "distinct-rows")
    order = [F.col("key").asc_nulls_last(), F.col("h1"), F.col("g1"), F.col("g2")]
    placed = materialize(row_ids(groups, "at", order), "row-order")
    count = placed.count()
    before = placed.select(
        F.pmod(F.col("at") + 1, F.lit(count)).alias("at"),
        F.floor(F.col("n") / 4).cast("int").alias("asked"),
        F.col("g1").alias("p1"),
        F.col("g2").alias("p2"),
    )
    return placed.join(before.hint("merge"), "at").select("g1", "g2", "key", "copies", "asked", "p1", "p2")


def fingerprint_edits(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_chars, tree, edited, edited_tree, near_edited, near_next), one for each row.

    The edited text has its last quarter of code points (rounded down) replaced by as many from the front of the next row's
    text, or all of it if that is shorter. Rows are ordered by key, nulls last, and rows of one key by a hash of their text;
    after the last comes the first, and a single row is followed by itself. Null texts count as empty. Rows of equal key and
    text follow each other: all but one of them are edited with their own text.

    Whole texts are shuffled once, by a hash of key and text; what moves to the row before is the front that it asks for
    and the tree. Order is found over keys and hashes alone.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    named = F.col(f"`{key}`")
    docs = rows.select(
        named.alias("key"),
        whole.alias("text"),
        F.length(whole).alias("n"),
        F.xxhash64(whole).alias("h1"),
        F.xxhash64(named, named.isNull(), whole).alias("g1"),
        F.xxhash64(F.lit(1), named, named.isNull(), whole).alias("g2"),
    )
    chain = materialize(_chain(docs), "row-chain")
    texts = docs.groupBy("g1", "g2").agg(F.first("text").alias("text"))  # both uses below read one exchange

    def own(chain: DataFrame) -> DataFrame:
        return texts.join(chain.hint("merge"), ["g1", "g2"]).withColumn("tree", merkle_tree(F.col("text")))

    def edited(met: DataFrame) -> DataFrame:
        n = F.length("text")
        kept = n - F.floor(n / 4).cast("int")
        changed = F.concat(F.substring(F.col("text"), F.lit(1), kept), F.col("front"))
        found = met.withColumn("edited", changed).withColumn("edited_tree", merkle_tree(F.col("edited")))
        near_edited = likeness(F.col("tree"), F.col("edited_tree"))
        near_next = likeness(F.col("tree"), F.col("next"))
        return found.select(
            "g1",
            "copies",
            "key",
            n.cast("long").alias("n_chars"),
            "tree",
            "edited",
            "edited_tree",
            near_edited.alias("near_edited"),
            near_next.alias("near_next"),
        )

    front = F.substring(F.col("text"), F.lit(1), F.col("asked"))
    after = own(chain).select(
        F.col("p1").alias("g1"),
        F.col("p2").alias("g2"),
        front.alias("front"),
        F.col("tree.root").alias("next_root"),
        F.unhex("tree.segments").alias("next_segments"),  # half as long as text
    )
    met = own(chain).join(after.hint("merge"), ["g1", "g2"])
    nodes = F.struct(F.col("next_root").alias("root"), F.lower(F.hex("next_segments")).alias("segments"))
    results = edited(met.withColumn("next", nodes))
    most = chain.agg(F.max("copies")).first()[0] or 1
    if most > 1:  # all but one row of equal key and text are followed by themselves
        quarter = F.substring(F.col("text"), F.lit(1), F.floor(F.length("text") / 4).cast("int"))
        alike = edited(own(chain.where("copies > 1")).withColumns({"front": quarter, "next": F.col("tree")}))
        alike = alike.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("copies") - 1, F.lit(REPEATS))))
        if most > REPEATS:
            alike = alike.repartition("g1", "first")
        last = F.least(F.col("first") + REPEATS, F.col("copies")) - 1
        results = results.unionByName(alike.withColumn("first", F.explode(F.sequence("first", last))).drop("first"))
    return results.drop("g1", "copies")

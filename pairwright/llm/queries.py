"""The corpus operators over the given tables: thin queries that derive the digest columns from each operator's results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.llm.common import base_count, base_digest, joined_spans, table
from pairwright.llm.embeddings import near_vectors
from pairwright.llm.lines import drop_frequent_lines
from pairwright.llm.lookup_clusters import embedding_clusters
from pairwright.llm.merkle import edit_range, fingerprint_edits, written
from pairwright.llm.mixing import mix_sources
from pairwright.llm.packing import pack
from pairwright.llm.pages import extract_pages, learn_blocks
from pairwright.llm.pii import learn_field, scan_pii
from pairwright.llm.quality import fit_quality_rules, quality_verdicts
from pairwright.llm.secrets import learn_randomness, scan_secrets
from pairwright.llm.simhash import near_duplicates
from pairwright.llm.tokens import count_tokens
from pairwright.llm.whitening import whiten_vectors

Query = Callable[[SparkSession, str], DataFrame]


def op1_semi_markov(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    spans = F.col("spans")
    counts = [base_count(spans, kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")]
    return scan_pii(docs, learn_field(docs)).select(
        "doc_id", *counts, base_digest(spans).alias("base_sha256"), joined_spans(spans).alias("spans")
    )


def op2_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = drop_frequent_lines(table(spark, folder, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce(F.col("lines.text"), F.lit("")), 256)
    return docs.select("doc_id", "lines.n_lines", "lines.n_dropped", kept.alias("kept_sha256"))


def op3_flow(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix_sources(table(spark, folder, "documents").select("doc_id", "text", "source"))
    taken = F.col("mix.size") * F.col("mix.copies")
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", taken.alias("taken"))


def op4_resynchronised(spark: SparkSession, folder: str) -> DataFrame:
    counted = count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select(F.col("key").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op5_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rules = fit_quality_rules(docs, table(spark, folder, "labels"))
    judged = quality_verdicts(docs, rules)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *[f"quality.{c}" for c in (*counts, "base_failed", "kept")])


def op6_pigeonring(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select(F.col("key").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op7_pigeonhole(spark: SparkSession, folder: str) -> DataFrame:
    found = near_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    kept = F.col("key").eqNullSafe(F.col("component"))
    return found.select(F.col("key").alias("vec_id"), "n_links", F.col("component").alias("component_id"), kept.alias("kept"))


def op8_markov(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    spans = F.col("spans")
    counts = [base_count(spans, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return scan_secrets(docs, learn_randomness(docs)).select(
        "doc_id", *counts, base_digest(spans).alias("base_sha256"), joined_spans(spans).alias("spans")
    )


def op9_cutting_stock(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    packed = pack(table(spark, folder, "documents"), path, known_parts=600_000)  # about 100 MB a task
    return packed.withColumnRenamed("key", "doc_id")


def op10_block_field(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = extract_pages(pages, learn_blocks(pages))
    return found.select("page_id", "url", "main.text", F.length("main.text").cast("long").alias("n_chars"))


def op11_lookup_tables(spark: SparkSession, folder: str) -> DataFrame:
    found = embedding_clusters(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    centroid = F.sha2(F.array_join(F.col("found.centroid").cast("array<string>"), ","), 256)
    numbers = ["found.cluster", "found.distance", "found.cluster_inertia", "found.inertia"]
    return found.select("vec_id", *numbers, centroid.alias("centroid_sha256"))


def op12_jacobi_davidson(spark: SparkSession, folder: str) -> DataFrame:
    return whiten_vectors(table(spark, folder, "embeddings")).withColumnRenamed("key", "vec_id")


def op13_merkle_tree(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprint_edits(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        F.col("key").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("tree")).alias("fingerprint"),
        written(F.col("edited_tree")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        edit_range(F.col("tree"), F.col("edited_tree"))["start"].alias("edit_start"),
    )


QUERIES: dict[str, Query] = {
    "op1_semi_markov": op1_semi_markov,
    "op2_line_runs": op2_line_runs,
    "op3_flow": op3_flow,
    "op4_resynchronised": op4_resynchronised,
    "op5_decision_list": op5_decision_list,
    "op6_pigeonring": op6_pigeonring,
    "op7_pigeonhole": op7_pigeonhole,
    "op8_markov": op8_markov,
    "op9_cutting_stock": op9_cutting_stock,
    "op10_block_field": op10_block_field,
    "op11_lookup_tables": op11_lookup_tables,
    "op12_jacobi_davidson": op12_jacobi_davidson,
    "op13_merkle_tree": op13_merkle_tree,
}
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SEGMENT = r"[^\n]{16,64}?[\x20\t]|[^\n]{1,64}"


def _likeness(a: str, b: str) -> str:
    both = f"len({a}.g) + len({b}.g)"
    return f"""CASE WHEN {a}.root = {b}.root THEN 1.0::DOUBLE WHEN {both} = 0 THEN 0.0
               ELSE 2.0::DOUBLE * len(list_intersect({a}.g, {b}.g)) / ({both}) END"""


def _lookup_assignment(i: int) -> str:
    """Table a<i>: every kept vector with the number and distance of the nearest centroid of table c<i-1>."""
    return f"""
        a{i} AS (
            SELECT vec_id, x, unnest(best, recursive := true) FROM (
                SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, min({{'d': d, 'c': c}}) AS best FROM (
                    SELECT r, vec_id, x, c, list_sum([(x[j] - y[j]) * (x[j] - y[j]) FOR j IN range(1, 65)])::BIGINT AS d
                    FROM kept, c{i - 1}
                ) GROUP BY r
            )
        )"""


def _lookup_round(i: int) -> str:
    """Tables a<i>, and c<i>: the centroids after a further round."""
    return _lookup_assignment(i) + f""",
        s{i} AS (
            SELECT c, list(m ORDER BY j) AS y FROM (
                SELECT c, j, ((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
                FROM (SELECT c, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM a{i}) GROUP BY c, j
            ) GROUP BY c
        ),
        c{i} AS (SELECT c{i - 1}.c, coalesce(s{i}.y, c{i - 1}.y) AS y FROM c{i - 1} LEFT JOIN s{i} ON c{i - 1}.c = s{i}.c)"""


ORACLE: dict[str, str] = {
    "op2_line_runs": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        lines AS (
            SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
            FROM docs
        ),
        keyed AS (SELECT *, translate(trim(line, {_SPACES}), '{_UPPER}', '{_LOWER}') AS k FROM lines),
        frequent AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10)
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN frequent f ON keyed.k = f.k GROUP BY r
    """,
    "op3_flow": r"""
        WITH docs AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
            FROM documents
        ),
        sums AS (SELECT source, sum(size)::BIGINT AS s FROM docs GROUP BY source),
        weighed AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS w FROM sums),
        ranked AS (SELECT *, row_number() OVER (ORDER BY 3 * s / w, w, source NULLS LAST) AS r FROM weighed),
        levels AS (
            SELECT *, (sum(s) OVER () - coalesce(sum(3 * s) OVER before, 0))::DOUBLE / sum(w) OVER rest AS level
            FROM ranked
            WINDOW before AS (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   rest AS (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        ),
        final AS (SELECT coalesce(arg_min(level, r) FILTER (WHERE level * w <= 3 * s), 0) AS level FROM levels),
        targets AS (SELECT source, s, least(3.0 * s, final.level * w) AS target FROM ranked, final),
        shares AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s)::BIGINT ELSE 0 END AS passes FROM targets),
        drawn AS (
            SELECT d.doc_id, d.size, t.s, t.target, t.passes,
                   sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place) AS upto,
                   sum(d.size) OVER (PARTITION BY d.source, d.place) AS here
            FROM docs d JOIN shares t ON d.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, s AS source_size, target,
               size * (passes + CASE WHEN target > passes * s AND passes < 3 AND upto - here / 2.0 <= target - passes * s
                                     THEN 1 ELSE 0 END)::BIGINT AS taken
        FROM drawn
    """,
    "op7_pigeonhole": """
        WITH RECURSIVE rows_ AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        usable AS (
            SELECT r, e, sqrt(list_inner_product(e, e)) AS norm FROM rows_
            WHERE len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0
        ),
        links AS (
            SELECT a.r AS x, b.r AS y FROM usable a JOIN usable b ON len(a.e) = len(b.e) AND a.r <> b.r
            WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
        ),
        reached AS (SELECT r, r AS t FROM rows_ UNION SELECT reached.r, y FROM reached JOIN links ON reached.t = links.x),
        counted AS (SELECT x AS r, count(*) AS n FROM links GROUP BY x)
        SELECT a.vec_id, any_value(coalesce(c.n, 0)) AS n_links, min(b.vec_id) AS component_id, a.vec_id = min(b.vec_id) AS kept
        FROM rows_ a JOIN reached ON a.r = reached.r JOIN rows_ b ON b.r = reached.t LEFT JOIN counted c ON c.r = a.r
        GROUP BY a.r, a.vec_id
    """,
    "op11_lookup_tables": f"""
        WITH
        kept AS (
            SELECT row_number() OVER () AS r, vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS x,
                   sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS place
            FROM embeddings
            WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
        ),
        c0 AS (SELECT row_number() OVER (ORDER BY place, x) - 1 AS c, x AS y FROM kept QUALIFY c < 16),
        {_lookup_round(1)}, {_lookup_round(2)}, {_lookup_round(3)}, {_lookup_assignment(4)},
        totals AS (SELECT c, sum(d)::BIGINT AS s FROM a4 GROUP BY c)
        SELECT vec_id, a4.c::INTEGER AS cluster, d AS distance, s AS cluster_inertia,
               (SELECT sum(s) FROM totals)::BIGINT AS inertia, sha256(array_to_string(y, ',')) AS centroid_sha256
        FROM a4 JOIN totals ON a4.c = totals.c JOIN c3 ON a4.c = c3.c
    """,
    "op13_merkle_tree": f"""
        WITH RECURSIVE docs AS (
            SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS r, doc_id, coalesce(text, '') AS t, len(t)::BIGINT AS n
            FROM documents
        ),
        pairs AS (
            SELECT a.r, a.doc_id, a.n, a.t, left(a.t, (a.n - a.n // 4)::BIGINT) || left(b.t, (a.n // 4)::BIGINT) AS e, b.r AS next
            FROM docs a JOIN docs b ON b.r = a.r % (SELECT count(*) FROM docs) + 1
        ),
        texts AS (SELECT r, 0 AS side, t FROM pairs UNION ALL SELECT r, 1, e FROM pairs),
        lines AS (
            SELECT r, side, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM texts
        ),
        hashed AS (SELECT r, side, list(sha256(line) ORDER BY i) AS paragraphs, list(len(line) ORDER BY i) AS lengths FROM lines GROUP BY r, side),
        runs AS (
            SELECT *, [x FOR x IN string_split(array_to_string([d || CASE WHEN left(d, 1) < '4' THEN ';' ELSE ',' END
                                                                FOR d IN paragraphs], ''), ';') IF x <> ''] AS sections
            FROM hashed
        ),
        cuts AS (
            SELECT r, side, left(sha256(s), 8) AS d
            FROM (SELECT r, side, unnest(regexp_extract_all(t, '{_SEGMENT}')) AS s FROM texts)
        ),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY r, side, d) AS k FROM cuts),
        segments AS (
            SELECT r, side, list(d || '*' || k ORDER BY d, k) AS g, string_agg(d, '' ORDER BY d) AS written FROM numbered GROUP BY r, side
        ),
        trees AS (
            SELECT runs.r, runs.side, paragraphs, lengths, coalesce(g, []) AS g,
                   sha256(array_to_string([sha256(s) FOR s IN sections], '')) AS root,
                   concat_ws('/', root, array_to_string([left(sha256(s), 16) FOR s IN sections], ''),
                             array_to_string([left(p, 16) FOR p IN paragraphs], ''), coalesce(segments.written, '')) AS written
            FROM runs LEFT JOIN segments ON runs.r = segments.r AND runs.side = segments.side
        ),
        compared AS (
            SELECT p.doc_id, p.n, p.e, a, b, c
            FROM pairs p JOIN trees a ON a.r = p.r AND a.side = 0 JOIN trees b ON b.r = p.r AND b.side = 1
                 JOIN trees c ON c.r = p.next AND c.side = 0
        )
        SELECT doc_id, n AS n_chars, sha256(e) AS edited_sha256, a.written AS fingerprint, b.written AS edited_fingerprint,
               {_likeness("a", "b")} AS near_edited, {_likeness("a", "c")} AS near_next,
               CASE WHEN a.root <> b.root THEN least(
                   n, coalesce(list_sum([a.lengths[i] + 1 FOR i IN range(1, len(a.lengths) + 1)
                                IF a.paragraphs[:i] = b.paragraphs[:i]]), 0))::BIGINT END AS edit_start
        FROM compared
    """,
}

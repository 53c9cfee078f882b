"""Merkle fingerprints, clusters by lookup tables, and whitening."""

import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairwright.llm import merkle
from pairwright.llm.lookup_clusters import BOUND, embedding_clusters, table_distances
from pairwright.llm.queries import ORACLE, QUERIES
from pairwright.llm.whitening import Centre, jacobi_davidson, whiten_vectors
from tests.llm.conftest import by_text

FOLDER = "/root/testdata/sf0.001"


def ordered(rows):
    """Rows (key, text) in the order in which each is followed by the next one."""
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_edits_on_edge_rows(spark, edge_docs, edge_rows, no_docs):
    keys = [(r[0], r[1] or "") for r in edge_rows]
    got = [
        (r.key, r.n_chars, r.edited, r.near_edited, r.near_next)
        for r in merkle.fingerprint_edits(edge_docs).collect()
    ]
    assert len(got) == len(keys)
    assert sorted((k is None, k or 0, n) for k, n, *_ in got) == sorted((k is None, k or 0, len(t)) for k, t in keys)
    starts = {t[: len(t) - len(t) // 4] for _, t in keys}
    assert all(any(e.startswith(s) for s in starts) and 0 <= a <= 1 and 0 <= b <= 1 for _, _, e, a, b in got)
    single = [k for k, _ in keys if [x for x, _ in keys].count(k) == 1]  # rows whose place in the order is their key's
    line = ordered(keys)
    for at, (key, text) in enumerate(line):
        after = line[(at + 1) % len(line)]
        if key in single and after[0] in single:
            quarter = len(text) // 4
            assert [e for k, _, e, *_ in got if k == key] == [text[: len(text) - quarter] + after[1][:quarter]]
    assert merkle.fingerprint_edits(no_docs).count() == 0


def test_many_rows_of_equal_key_and_text(spark, monkeypatch):
    monkeypatch.setattr(merkle, "REPEATS", 7)
    rows = [(1, "abcdefgh")] * 30 + [(2, "ijklmnop"), (3, None), (None, "x")]
    got = merkle.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    edits = sorted((r.key or 0, r.edited) for r in got)
    assert edits == sorted([(1, "abcdefgh")] * 0 + [(1, "abcdefab")] * 29 + [(1, "abcdefij"), (2, "ijklmn"), (3, ""), (0, "x")])


def test_trees_tell_texts_apart(spark):
    paragraphs = [f"paragraph number {i} says a few words about item {i * 7} of the list" for i in range(40)]
    base = "\n".join(paragraphs)
    changed = paragraphs.copy()
    changed[17] += " and more"
    longer = paragraphs[:5] + ["a new one"] + paragraphs[5:]
    texts = {"base": base, "same": base, "changed": "\n".join(changed), "longer": "\n".join(longer), "none": None, "empty": "", "swapped": "\n".join(paragraphs[::-1])}
    frame = spark.createDataFrame(list(texts.items()), "name string, text string").withColumn("tree", merkle.merkle_tree(F.col("text")))
    assert [r[0] for r in frame.where("name = 'base'").select(F.size("tree.sections")).collect()][0] > 4
    a, b = frame.where("name = 'base'").select(F.col("tree").alias("a")), frame.select("name", F.col("tree").alias("b"))
    met = b.crossJoin(a).select("name", merkle.likeness(F.col("a"), F.col("b")).alias("near"), merkle.edit_range(F.col("a"), F.col("b")).alias("e"), (F.col("a.root") == F.col("b.root")).alias("equal"))
    found = {r.name: r for r in met.collect()}
    assert found["same"].equal and found["same"].near == 1 and found["same"].e is None
    assert not found["changed"].equal and 0.95 < found["changed"].near < 1
    assert base[found["changed"].e.start : found["changed"].e.end].strip("\n") == paragraphs[17]
    assert found["longer"].e.start == found["longer"].e.end == len("\n".join(paragraphs[:5])) + 1
    assert not found["swapped"].equal and found["swapped"].near > 0.9
    assert found["empty"].near == 0 and (found["empty"].e.start, found["empty"].e.end) == (0, len(base))
    prints = {r.name: r.fp for r in frame.select("name", merkle.written(F.col("tree")).alias("fp")).collect()}
    assert prints["base"] == prints["same"] and prints["none"] == prints["empty"] and len(set(prints.values())) == 5


def test_repeats_count(spark):
    texts = [("a", "the same long line of words\n" * 30), ("b", "the same long line of words\n" * 15 + "quite another line here now\n" * 15)]
    rows = spark.createDataFrame(texts, "k string, t string").select(F.collect_list(merkle.merkle_tree(F.col("t"))).alias("t"))
    near = rows.select(merkle.likeness(F.col("t")[0], F.col("t")[1])).first()[0]
    assert 0.4 < near < 0.6


def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if v and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for i, members in groups.items():
            centroids[i] = [sum(column) // len(members) for column in zip(*members)]
    return [(i, *nearest(v)) for i, v in kept], centroids


def vector_rows():
    draw = np.random.default_rng(8)
    centres = draw.standard_normal((5, 64))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 5] + 0.2 * draw.standard_normal(64)]) for i in range(90)]
    rows += [(500, None), (501, []), (502, [1.0] * 63), (503, [float("nan")] + [1.0] * 63), (504, [None] + [1.0] * 63)]
    return rows + [(505, [float("inf")] * 64), rows[3], rows[3], (None, rows[4][1]), (None, rows[5][1]), (7, rows[6][1])]


def test_clusters_equal_plain_ones(spark):
    rows = vector_rows()
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, x string, found string").repartition(3)
    got = embedding_clusters(frame, result="result")
    assert got.columns == [*frame.columns, "result"]
    want, centroids = plain_clusters(rows)
    made = got.collect()
    assert by_text((r.vec_id, r.result.distance, r.result.cluster) for r in made) == by_text(want)
    assert all(r.result.centroid == centroids[r.result.cluster] and r.x == "x" for r in made)
    assert {r.result.inertia for r in made} == {sum(d for _, d, _ in want)}
    assert embedding_clusters(frame.where("vec_id between 500 and 505"), result="result").count() == 0
    few = embedding_clusters(frame.where("vec_id < 3"), result="result").collect()
    assert [r.result.distance for r in few] == [0, 0, 0]


def test_clusters_of_huge_components(spark):
    rows = [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)]
    got = embedding_clusters(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=2).collect()
    assert len(got) == 3 and all(r.found.distance >= 0 for r in got)
    x = np.array([[BOUND] * 64])
    assert table_distances(x, -x)[0, 0] == 64 * (2 * BOUND) ** 2


@pytest.mark.parametrize("dims,k", [(200, 12), (40, 32), (8, 32), (1, 3)])
def test_leading_pairs_of_a_matrix(dims, k):
    draw = np.random.default_rng(dims)
    q = np.linalg.qr(draw.standard_normal((dims, dims)))[0]
    want = np.sort(draw.gamma(1.0, 1.0, dims))[::-1]
    matrix = (q * want) @ q.T
    products = []

    def product(block):
        products.append(block.shape[1])
        return matrix @ block

    values, vectors = jacobi_davidson(product, dims, k)
    k = min(k, dims)
    assert np.abs(values - want[:k]).max() < 1e-12 * want[0]
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-12 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert max(products) <= k + 8 and len(products) < 120


def test_leading_pairs_of_equal_values():
    values, vectors = jacobi_davidson(lambda block: block * 2.0, 50, 5)
    assert np.allclose(values, 2) and np.allclose(vectors.T @ vectors, np.eye(5))
    values, _ = jacobi_davidson(lambda block: block * 0.0, 50, 5)
    assert np.array_equal(values, np.zeros(5))


def check_whitening(got, rows, dims, k):
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(0)
    scaled = n * x - sums
    z = scaled.astype(float) / n
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    assert {r.n for r in got} == {n} and len(got) == n * min(k, dims)
    assert by_text({(r.key, r.deviation) for r in got}) == by_text({(key, int((s**2).sum())) for (key, _), s in zip(rows, scaled)})
    want = np.abs(z @ u / np.sqrt(e))
    for c in range(min(k, dims)):
        mine = sorted(abs(r.whitened) for r in got if r.component == c + 1)
        assert np.allclose(mine, sorted(want[:, c]), atol=1e-9)
        assert {r.explained for r in got if r.component == c + 1}.pop() == pytest.approx(e[c] / (z**2).sum() * n, rel=1e-9)
    assert all(r.identity_error < 1e-9 for r in got)


def test_whitening_equals_plain_one(spark):
    rows = [r for r in vector_rows() if r[0] is None or not 500 <= r[0] <= 505] + [(900 + i, [float(np.float32(x)) for x in np.random.default_rng(i).standard_normal(64)]) for i in range(60)]
    odd = [(500, None), (501, []), (503, [float("nan")] + [1.0] * 63), (504, [None] + [1.0] * 63), (505, [float("inf")] * 64)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows + odd], "vec_id long, embedding array<float>, n long, component int").repartition(3)
    check_whitening(whiten_vectors(frame).collect(), rows, 64, 32)
    assert whiten_vectors(frame.where("vec_id in (500, 501, 503, 504, 505)")).count() == 0


def test_whitening_of_each_length_and_of_equal_vectors(spark):
    draw = np.random.default_rng(4)
    short = [(i, draw.standard_normal(3).tolist()) for i in range(20)]
    equal = [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(5)]
    got = whiten_vectors(spark.createDataFrame(short + equal, "vec_id long, embedding array<double>")).collect()
    check_whitening([r for r in got if r.key < 100], short, 3, 3)
    rest = [r for r in got if r.key >= 100]
    assert len(rest) == 20 and {(r.whitened, r.explained, r.deviation) for r in rest} == {(None, 0.0, 0)}


def test_deviations_beyond_64_bits_are_null():
    x = np.array([[1 << 27, 0], [0, 0]])
    assert Centre(1 << 40, [0, 0]).deviations(x) == [None, 0]
    assert Centre(4, [0, 0]).deviations(x) == [(4 << 27) ** 2, 0]


def test_fingerprint_query_needs_no_python(spark):
    plan = QUERIES["op13_merkle_tree"](spark, FOLDER)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    assert "op13_merkle_tree" in ORACLE and json.dumps(ORACLE["op13_merkle_tree"])

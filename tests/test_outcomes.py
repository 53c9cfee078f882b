import pytest
from pyspark.sql import functions as F

from pairwright.operators.funnel import (
    BUCKETS,
    CATEGORY_CODES,
    Flags,
    funnel_all,
    funnel_by,
    funnel_counts,
    funnel_wide,
    score_bucket,
    score_buckets,
)
from pairwright.operators.outcomes import CHUNK, Fact, outcome_flags, repeat_rows
from tests.conftest import values


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [("u1", "i1", 0.1), ("u1", "i2", 0.2), ("u2", "i1", 0.3), (None, "i1", 0.4), ("u3", None, 0.5)]
    return spark.createDataFrame(rows + [("u1", "i1", 0.9)] * 20, "u string, i string, s double")


@pytest.fixture(scope="module")
def events(spark):
    passed = [("u1", "i1")] * 3 + [("u2", "i1"), (None, "i1"), ("u9", "i9")]
    mailed = [("i1", "u1"), ("i1", "u1"), ("i2", "u1"), (None, None)]
    return (
        spark.createDataFrame(passed, "pu string, pi string"),
        spark.createDataFrame(mailed, "mi string, mu string"),
    )


def facts(events):
    passed, mailed = events
    return [
        Fact("passed", passed, (("u", "pu"), ("i", "pi"))),
        Fact("mailed", mailed, (("i", "mi"), ("u", "mu"))),
    ]


def test_flags_and_copies_equal_left_joins(pairs, events):
    passed, mailed = events
    flat = pairs.join(passed, (F.col("u") == F.col("pu")) & (F.col("i") == F.col("pi")), "left").join(
        mailed, (F.col("u") == F.col("mu")) & (F.col("i") == F.col("mi")), "left"
    )
    expected = flat.select(
        "u", "i", "s",
        F.when(F.col("pu").isNotNull(), "1").otherwise("0"),
        F.when(F.col("mu").isNotNull(), "1").otherwise("0"),
    )
    found = outcome_flags(pairs, facts(events))
    assert values(repeat_rows(found, "copies")) == values(expected)


def test_distinct_facts_do_not_multiply(pairs, events):
    found = outcome_flags(pairs, facts(events), distinct=True)
    assert found.count() == pairs.count()
    assert {r["copies"] for r in found.collect()} == {1}


def test_repeat_rows_over_chunk_borders(spark):
    counts = [0, 1, 2, CHUNK - 1, CHUNK, CHUNK + 1, 2 * CHUNK, 3 * CHUNK + 5]
    df = spark.createDataFrame([(n, c) for n, c in enumerate(counts)], "n int, c bigint")
    found = {r["n"]: r["count"] for r in repeat_rows(df, "c").groupBy("n").count().collect()}
    assert found == {n: c for n, c in enumerate(counts) if c}


EDGES = {
    0.0: "0.00 - 0.05", 0.05: "0.05 - 0.10", 0.1: "0.10 - 0.15", 0.15: "0.15 - 0.20", 0.2: "0.20 - 0.25",
    0.25: "0.25 - 0.30", 0.3: "0.30 - 0.35", 0.35: "0.35 - 0.40", 0.4: "0.40 - 0.45", 0.45: "0.45 - 0.50",
    0.5: "0.50 - 0.55", 0.55: "0.55 - 0.60", 0.6: "0.60 - 1.00", 0.0499: "0.00 - 0.05", 0.5999: "0.55 - 0.60",
    1.0: "0.60 - 1.00", 1.01: None, -0.01: None, float("nan"): None, None: "0.00 - 0.05",
}


def test_score_bucket_edges(spark):
    df = spark.createDataFrame([(n, s) for n, s in enumerate(EDGES)], "n int, s double")
    found = df.select("n", score_bucket(F.col("s")).alias("b")).orderBy("n").collect()
    assert [r["b"] for r in found] == list(EDGES.values())


def test_empty_buckets_are_counted_zero(spark):
    found = score_buckets(spark.createDataFrame([(0.12,), (7.0,)], "s double"), "s").collect()
    assert [(r["bucket"], r["n"]) for r in found] == [(b, int(b == "0.10 - 0.15")) for b in BUCKETS]


@pytest.fixture(scope="module")
def flagged(spark):
    rows = [
        (n % 21 / 20.0, str(n % 2), str(n // 2 % 2), str(n // 4 % 2), f"{n % 17:02d}", 1 + n % 3) for n in range(800)
    ]
    return spark.createDataFrame(rows, "s double, mailed string, applied string, passed string, cat string, copies bigint")


def by_hand(rows, bucket, keep):
    lo, up = map(float, bucket.split(" - "))
    last = bucket == BUCKETS[-1]
    chosen = [r for r in rows if lo <= r["s"] and (r["s"] <= up if last else r["s"] < up) and keep(r)]

    def total(**flags):
        return sum(r["copies"] for r in chosen if all(r[k] == v for k, v in flags.items()))

    n = [
        total(), total(mailed="1"), total(mailed="1", applied="1"), total(mailed="1", passed="1"),
        total(mailed="0", applied="1"), total(mailed="0", passed="1"),
    ]
    ratios = [n[3] / n[2] if n[2] else 0.0, n[5] / n[4] if n[4] else 0.0]
    return n, ratios


def test_funnel_equals_filtered_counts(flagged):
    rows = flagged.collect()
    counts = funnel_counts(flagged, "s", Flags(), ["cat"], "copies")
    for report in (funnel_all(counts), funnel_all(funnel_counts(flagged, "s", Flags(), [], "copies"))):
        found = report.collect()
        assert [r["bucket"] for r in found] == list(BUCKETS)
        for r in found:
            n, ratios = by_hand(rows, r["bucket"], lambda _: True)
            assert list(r)[1:] == [*n[:4], ratios[0], *n[4:], ratios[1]]
    found = funnel_by(counts, "cat", CATEGORY_CODES).collect()
    assert len(found) == len(BUCKETS) * len(CATEGORY_CODES)
    for r in found:
        n, ratios = by_hand(rows, r["bucket"], lambda row, code=r["cat"]: row["cat"] == code)
        assert list(r)[2:] == [n[2], n[3], ratios[0], n[4], n[5], ratios[1]]


def test_wide_report_holds_the_long_one(flagged):
    long = funnel_by(funnel_counts(flagged, "s", Flags(), ["cat"]), "cat", CATEGORY_CODES)
    wide = {r["bucket"]: r.asDict() for r in funnel_wide(long, "cat", CATEGORY_CODES).collect()}
    assert len(wide) == len(BUCKETS)
    for r in long.collect():
        for measure in long.columns[2:]:
            assert wide[r["bucket"]][f"{r['cat']}_{measure}"] == r[measure]


def test_report_moves_only_counts(flagged):
    plan = funnel_all(funnel_counts(flagged, "s", Flags(), [], "copies"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan and "Window" not in plan

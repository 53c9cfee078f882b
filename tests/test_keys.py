import hashlib

import pytest
from pyspark.sql import functions as F

from pairwright.operators.keys import (
    attach_ids,
    dedupe_by_key,
    dense_ids,
    distinct_keys,
    distinct_pairs,
    rank_within,
    row_ids,
)
from tests.conftest import values


@pytest.fixture(scope="module")
def log(spark):
    rows = [("a", "x", 1.0), ("a", "x", 1.0), ("b", "y", 2.0), (None, "x", 3.0), ("c", None, 4.0), ("a", "z", None)]
    return spark.createDataFrame(rows * 3, "user string, item string, rating double")


def test_distinct(log):
    assert values(distinct_keys(log, "user")) == [("a",), ("b",), ("c",), (None,)]
    assert len(values(distinct_pairs(log, "user", "item"))) == 5


def test_dense_ids_are_the_hash_order(spark):
    keys = [f"key{n}" for n in range(500)]
    df = spark.createDataFrame([(k,) for k in keys * 2 + [None]], "k string")
    expected = sorted(keys, key=lambda k: (hashlib.md5(k.encode()).hexdigest()[:3], k))
    for parts in (1, 5, 9):
        ids = {r["k"]: r["id"] for r in dense_ids(df.repartition(parts), "k", "id").collect()}
        assert ids == {k: n for n, k in enumerate(expected)}


def test_dense_ids_other_bucket_count_and_no_rows(spark):
    df = spark.range(100)
    ids = dense_ids(df, "id", "dense", digits=1).collect()
    assert sorted(r["dense"] for r in ids) == list(range(100)) and len({r["id"] for r in ids}) == 100
    assert dense_ids(df.limit(0), "id", "dense").count() == 0


def test_attach_ids_drops_null_keys_and_keeps_copies(log):
    ids = {"user": dense_ids(log, "user", "uid"), "item": dense_ids(log, "item", "iid")}
    found = values(attach_ids(log, ids).select("user", "item", "rating"))
    assert found == values(log.where("user IS NOT NULL AND item IS NOT NULL"))


def test_row_ids_in_frame_order(spark):
    df = spark.range(0, 1000, numPartitions=7).where("id % 3 <> 1")
    found = row_ids(df, "n").orderBy("id").collect()
    assert [r["n"] for r in found] == list(range(df.count()))


def test_row_ids_in_given_order_with_a_heavy_value(spark):
    df = spark.range(0, 2000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 50).alias("k"))
    found = row_ids(df, "n", [F.col("k").desc()]).orderBy("n").collect()
    assert [r["n"] for r in found] == list(range(2000))
    assert [r["k"] for r in found] == sorted((r["k"] for r in df.collect()), reverse=True)


def test_rank_within(spark):
    rows = [("a", 1.0, 1), ("a", 3.0, 2), ("a", 3.0, 1), ("b", 0.5, 9), (None, 2.0, 4), (None, 7.0, 5)]
    df = spark.createDataFrame(rows, "k string, s double, t int")
    found = values(rank_within(df, "k", [F.desc("s"), F.col("t")], "rank"))
    assert found == [
        ("a", 1.0, 1, 3), ("a", 3.0, 1, 1), ("a", 3.0, 2, 2), ("b", 0.5, 9, 1), (None, 2.0, 4, 2), (None, 7.0, 5, 1)
    ]


def test_dedupe_by_key_never_varies(spark):
    rows = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "n"), (None, 4, "m")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    for parts in (1, 3):
        assert values(dedupe_by_key(df.repartition(parts), "k", ["o"])) == [("a", 1, "y"), (None, 4, "m")]

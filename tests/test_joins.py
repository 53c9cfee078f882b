"""Spread joins give exactly the rows of plain joins, whatever the skew."""

import pytest
from pyspark.sql import functions as F

from pairwright.operators import joins
from pairwright.operators.joins import all_pairs, fits_broadcast, lookup_join, pair_join
from tests.conftest import values


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have one key, copies included; some keys are null."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"),
        (F.col("id") % 5).alias("v"),
    )


@pytest.fixture(scope="module")
def other(spark):
    return spark.range(120).select((F.col("id") % 45).alias("k"), F.col("id").alias("w"))


@pytest.fixture
def small_thresholds(spark):
    names = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256b",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_many_hot_keys_are_all_cut(spark, small_thresholds, how):
    """A dozen hot keys among 2 000: adaptive handling cuts what is large, whatever their number; rows equal a plain join."""
    left = spark.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") < 120_000, F.col("id") % 12).otherwise(F.col("id") % 2000).alias("k"), F.col("id").alias("v")
    )
    right = spark.range(1500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    joined = lookup_join(left, right, ["k"], how, max_rows=0)
    found = joined.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*joined.columns).cast("decimal(38,0)")))
    tasks = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k")).collect()
    plain = left.join(F.broadcast(right), "k", how)
    assert found.first() == plain.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*joined.columns).cast("decimal(38,0)"))).first()
    if how != "left_anti":
        assert max(t.n for t in tasks) < 10_000  # a hot key alone has 10 000 rows


def test_two_thousand_hot_keys(spark, small_thresholds):
    """Every key of 2 000 is hot: many rows a key, and none of them alone in a task that is much larger than the others."""
    left = spark.range(0, 600_000, numPartitions=8).select((F.col("id") % 2000).alias("k"), F.col("id").alias("v"))
    right = spark.range(2500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    joined = lookup_join(left, right, ["k"], "inner", max_rows=0)
    total = joined.agg(F.count(F.lit(1)), F.sum(F.col("w") - 2 * F.col("k")), F.sum("v")).first()
    assert tuple(total) == (600_000, 0, sum(range(600_000)))
    tasks = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(tasks) < 4 * sum(tasks) / len(tasks)
    other = spark.range(0, 40_000).select((F.col("id") % 2000).alias("k"), F.col("id").alias("w"))
    few = left.where("v < 60000")
    met = pair_join(few, other, ["k"], cell_rows=8, pairs_per_task=100, max_rows=0)
    assert met.count() == 2000 * 30 * 20


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_lookup_join_both_plans(skewed, other, max_rows):
    found = lookup_join(skewed, other, ["k"], "left", max_rows)
    assert values(found) == values(skewed.join(other, ["k"], "left"))


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_pair_join_grid_and_broadcast(skewed, other, max_rows):
    found = pair_join(skewed, other, ["k"], cell_rows=16, pairs_per_task=100, max_rows=max_rows)
    assert values(found) == values(skewed.join(other, ["k"]))


def test_pair_join_with_nothing_in_common(spark, skewed, other):
    none = other.where("k > 1000")
    assert pair_join(skewed, none, ["k"]).count() == 0


def test_all_pairs(spark):
    left, right = spark.range(30).toDF("a"), spark.range(17).toDF("b")
    found = values(all_pairs(left, right, left_cell=7, right_cell=4))
    assert found == values(spark.createDataFrame([(a, b) for a in range(30) for b in range(17)], "a long, b long"))
    assert all_pairs(left.limit(0), right).count() == 0


def test_fits_broadcast_counts_rows_and_bytes(spark):
    assert fits_broadcast(spark.range(10), max_rows=10)
    assert not fits_broadcast(spark.range(11), max_rows=10)
    wide = spark.range(4).select(F.repeat(F.lit("x"), 1000).alias("t"), F.array(F.lit(1.0)).alias("a"))
    assert not fits_broadcast(wide, max_bytes=3000)
    assert fits_broadcast(wide, max_bytes=8000)
    assert fits_broadcast(spark.range(0))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_with_a_heavy_value_on_both_sides(spark, skewed, how):
    heavy = spark.range(300).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 20).alias("k"), F.col("id").alias("w"))
    found = lookup_join(skewed, heavy, ["k"], how, max_rows=0)
    assert values(found.select("k", "v", "w")) == values(skewed.join(heavy, ["k"], how).select("k", "v", "w"))


def test_spread_is_the_same_when_computed_again(spark):
    df = spark.range(0, 1000, numPartitions=5).select((F.col("id") % 3).alias("k"))
    tagged = df.withColumn("s", joins._spread(df))
    assert tagged.collect() == tagged.collect()
    assert tagged.distinct().count() == 15


def test_blocks_keep_every_row(spark, other):
    """Keys with more rows than a block, copies, null keys and null values."""
    right = other.select(F.when(F.col("w") % 7 != 0, F.col("k") % 4).alias("k"), F.nullif(F.col("w") % 50, F.lit(3)).alias("w"))
    right = right.unionByName(right)
    blocks = joins._blocks(right, ["k"], ["w"], block_rows=8)
    assert blocks.agg(F.max(F.size("_block"))).first()[0] == 8
    assert values(blocks.select("k", F.inline("_block"))) == values(right)


def test_pair_join_sends_a_side_of_many_rows_as_blocks(spark):
    """More rows of a key than one block holds; the joined table has a row for each block, and other rows than 500 000 in all."""
    right = spark.range(600_000).select((F.col("id") % 300).alias("k"), F.col("id").alias("w"))
    left = spark.range(0, 900, 3).select("id", F.col("id").alias("k"))
    met = pair_join(left, right, ["k"])
    assert "BroadcastHashJoin" in met._jdf.queryExecution().executedPlan().toString()
    assert met.columns == ["k", "id", "w"]
    total = met.agg(F.count(F.lit(1)), F.sum("w"), F.sum((F.col("w") % 300 != F.col("k")).cast("int"))).first()
    assert tuple(total) == (100 * 2000, sum(w for w in range(600_000) if w % 300 % 3 == 0), 0)


def test_pair_join_of_keys_alone(spark, skewed, other):
    keys = other.select("k")
    assert values(pair_join(skewed, keys, ["k"])) == values(skewed.join(keys, ["k"]))


def test_pair_join_with_a_name_on_both_sides(spark, skewed, other):
    right = other.withColumnRenamed("w", "v")
    found = pair_join(skewed, right, ["k"])
    assert found.columns == ["k", "v", "v"]
    assert values(found.toDF("k", "v", "w")) == values(skewed.join(other, ["k"]))

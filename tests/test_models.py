import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from pairwright.ml.als import ITEM_ID, USER_ID, _top_finder, fit_als, index_log, listed_factors, score_factors, score_lists
from pairwright.ml.certificate import top_certificate
from pairwright.ml.forest import FULL_GRID, fit_forest, match_scores, param_grid
from pairwright.session import materialize

SMALL = {"numTrees": (5,), "maxDepth": (4,)}


def planted(spark, positive_when):
    """The label is decided by one feature."""
    return spark.range(600).select(
        "id",
        (F.col("id") * 37 % 10).cast("double").alias("rule"),
        (F.col("id") * 13 % 7).cast("double").alias("noise"),
        F.expr(positive_when.replace("x", "(id * 37 % 10)")).cast("int").alias("passed"),
    )


@pytest.mark.parametrize("positive_when", ["x >= 7", "x >= 2"])
def test_forest_finds_the_rule_for_minority_and_majority_label(spark, tmp_path, positive_when):
    rows = planted(spark, positive_when)
    fitted = fit_forest(rows, "passed", ["rule", "noise"], "id", grid=SMALL)
    assert fitted.precision > 0.95 and fitted.error == 1.0 - fitted.precision
    weights = fitted.importances.collect()
    assert weights[0]["feature"] == "rule" and sum(r["importance"] for r in weights) == pytest.approx(1.0)
    scored = match_scores(fitted.model, rows, "score", 1)
    assert scored.columns == [*rows.columns, "score"]
    agree = scored.where((F.col("score") >= 0.5) == (F.col("passed") == 1)).count()
    assert agree / rows.count() > 0.95
    fitted.model.write().overwrite().save(str(tmp_path / "model"))
    loaded = match_scores(PipelineModel.load(str(tmp_path / "model")), rows.drop("passed"), "score", 1)
    assert loaded.orderBy("id").select("score").collect() == scored.orderBy("id").select("score").collect()


def test_forest_is_repeatable_on_other_partitions(spark):
    rows = planted(spark, "x >= 7")
    first = fit_forest(rows, "passed", ["rule", "noise"], "id", grid=SMALL).precision
    assert fit_forest(rows, "passed", ["rule", "noise"], "id", grid=SMALL).precision == first


def test_unknown_label_is_refused(spark):
    fitted = fit_forest(planted(spark, "x >= 7"), "passed", ["rule"], "id", grid=SMALL)
    with pytest.raises(ValueError):
        match_scores(fitted.model, planted(spark, "x >= 7"), positive_label=2)


def test_full_grid_has_72_settings(spark):
    from pyspark.ml.classification import RandomForestClassifier

    assert len(param_grid(RandomForestClassifier(), FULL_GRID)) == 72


@pytest.fixture(scope="module")
def recommender(spark):
    """Ratings of a rank-2 matrix with held-out cells, and a fitted model."""
    random = np.random.default_rng(1)
    left, right = random.uniform(0.2, 1.0, (40, 2)), random.uniform(0.2, 1.0, (30, 2))
    truth = {(f"u{u}", f"i{i}"): float(left[u] @ right[i]) for u in range(40) for i in range(30)}
    held = {pair for n, pair in enumerate(truth) if n % 9 == 4}
    rows = [(u, i, r) for (u, i), r in truth.items() if (u, i) not in held]
    log = spark.createDataFrame([*rows, (None, "i1", 1.0), ("u1", None, 1.0)], "user string, item string, rating double")
    indexed, user_ids, item_ids = (materialize(df, "als-test") for df in index_log(log, "user", "item"))
    model = fit_als(indexed, rank=2, max_iter=15, implicit_prefs=False)
    return truth, held, indexed, user_ids, item_ids, model


def lists(spark, users, items):
    return spark.createDataFrame([(u,) for u in users], "u string"), spark.createDataFrame([(i,) for i in items], "i string")


def test_ids_of_the_log(recommender):
    _, _, indexed, user_ids, item_ids, _ = recommender
    assert sorted(r[USER_ID] for r in user_ids.collect()) == list(range(40))
    assert sorted(r[ITEM_ID] for r in item_ids.collect()) == list(range(30))
    assert indexed.count() == 1200 - 133


def test_held_out_cells_are_recovered(spark, recommender):
    truth, held, _, user_ids, item_ids, model = recommender
    users, items = lists(spark, [f"u{n}" for n in range(40)], [f"i{n}" for n in range(30)])
    found = {(r["user_id"], r["item_id"]): r["prediction"] for r in score_lists(model, users, items, user_ids, item_ids).collect()}
    assert len(found) == 1200
    assert np.mean([abs(found[pair] - truth[pair]) for pair in held]) < 0.12


@pytest.mark.parametrize("cell", [None, (7, 11), (1, 1)])
def test_scores_equal_the_model_on_every_listed_pair(spark, recommender, cell):
    _, _, _, user_ids, item_ids, model = recommender
    names = [f"u{n}" for n in range(0, 40, 3)] + ["stranger", "u3"]
    users, items = lists(spark, names, [f"i{n}" for n in range(0, 30, 4)] + ["stranger"])
    pairs = (
        users.distinct().crossJoin(items)
        .join(user_ids.withColumnRenamed("user", "u"), "u").join(item_ids.withColumnRenamed("item", "i"), "i")
    )
    expected = {(r["u"], r["i"]): r["prediction"] for r in model.transform(pairs).where("prediction > 0").collect()}
    found = {(r["user_id"], r["item_id"]): r["prediction"] for r in score_lists(model, users, items, user_ids, item_ids, cell=cell).collect()}
    assert found.keys() == expected.keys() and len(found) == 14 * 8
    assert all(found[k] == pytest.approx(expected[k], rel=1e-5) for k in expected)


@pytest.mark.parametrize("limit", [1, 3, 29, 100])
def test_top_scores_equal_a_rank_over_all_scores(spark, recommender, limit):
    _, _, _, user_ids, item_ids, model = recommender
    users, items = lists(spark, [f"u{n}" for n in range(40)], [f"i{n}" for n in range(30)])
    everything = score_lists(model, users, items, user_ids, item_ids)
    rank = F.dense_rank().over(Window.partitionBy("user_id").orderBy(F.desc("prediction")))
    expected = {(r[0], r[1]) for r in everything.withColumn("rank", rank).where(F.col("rank") <= limit).collect()}
    found = {(r[0], r[1]) for r in score_lists(model, users, items, user_ids, item_ids, limit, cell=(16, 9)).collect()}
    assert found == expected


def test_equal_factors_tie(spark, recommender, tmp_path):
    """Items with the same factors share a rank, so all of them are in the result."""
    _, _, indexed, user_ids, item_ids, model = recommender
    same = model.itemFactors.where("id = 0").select("features").first()["features"]

    class Tied:
        userFactors = model.userFactors
        itemFactors = model.itemFactors.withColumn("features", F.array(*[F.lit(x).cast("float") for x in same]))

    users, items = lists(spark, ["u1", "u2"], [f"i{n}" for n in range(30)])
    assert score_lists(Tied, users, items, user_ids, item_ids, limit=1, cell=(8, 7)).count() == 60


def test_save_and_load_give_equal_scores(spark, recommender, tmp_path):
    _, _, _, user_ids, item_ids, model = recommender
    model.write().overwrite().save(str(tmp_path / "als"))
    users, items = lists(spark, ["u1"], [f"i{n}" for n in range(30)])
    first = score_lists(model, users, items, user_ids, item_ids).orderBy("item_id").collect()
    assert score_lists(ALSModel.load(str(tmp_path / "als")), users, items, user_ids, item_ids).orderBy("item_id").collect() == first


def test_bad_arguments(spark, recommender):
    indexed = recommender[2]
    for bad in ({"rank": 0}, {"rank": "8"}, {"implicit_prefs": "False"}, {"max_iter": True}, {"combine": "first"}):
        with pytest.raises(ValueError):
            fit_als(indexed, **bad)
    with pytest.raises(ValueError):
        fit_als(indexed.withColumn(USER_ID, F.col(USER_ID) + 2**31))


def test_combined_ratings(spark, recommender):
    """Copies made one by averaging give the model of the log without copies."""
    _, _, indexed, user_ids, item_ids, model = recommender
    twice = fit_als(indexed.union(indexed), rank=2, max_iter=15, implicit_prefs=False, combine="avg")
    users, items = lists(spark, ["u1", "u2"], [f"i{n}" for n in range(30)])
    first, second = (score_lists(m, users, items, user_ids, item_ids).orderBy("user_id", "item_id").collect() for m in (model, twice))
    assert [r["prediction"] for r in first] == pytest.approx([r["prediction"] for r in second], rel=1e-2)


def test_one_listed_user_makes_one_block(spark):
    """Factors are copied for the blocks of the lists, not for those of all known ids."""
    log = spark.range(6000).select((F.col("id") % 900).alias("user"), (F.col("id") % 60).alias("item"), F.lit(1.0).alias("rating"))
    indexed, user_ids, item_ids = (materialize(x, "ids") for x in index_log(log, "user", "item"))
    model = fit_als(indexed, rank=2, max_iter=2, user_blocks=2, item_blocks=2)
    one = user_ids.select("user").limit(1)
    scored = score_lists(model, one, item_ids.select("item"), user_ids, item_ids, limit=3, cell=(50, 1000))
    assert scored.select("user_id").distinct().count() == 1
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "1) as int) AS _row" in plan and "1) as int) AS _col" in plan  # one block on each side: nothing is repeated


@pytest.mark.parametrize("cell", [(7, 5), (4096, 262_144)])
def test_top_scores_are_those_of_all_scores(spark, cell, monkeypatch):
    monkeypatch.setattr("pairwright.ml.als.CHUNK_ITEMS", 4)
    log = spark.range(3000).select((F.col("id") % 40).alias("user"), (F.col("id") * 7 % 33).alias("item"), (F.col("id") % 5 + 1.0).alias("rating"))
    indexed, user_ids, item_ids = (materialize(x, "ids") for x in index_log(log, "user", "item"))
    model = fit_als(indexed, rank=3, max_iter=3, user_blocks=2, item_blocks=2)
    lists = (user_ids.select("user"), item_ids.select("item"), user_ids, item_ids)
    rank = F.dense_rank().over(Window.partitionBy("user_id").orderBy(F.desc("prediction")))
    everything = score_lists(model, *lists).withColumn("r", rank).where("r <= 4").drop("r")
    best = score_lists(model, *lists, limit=4, cell=cell)
    assert sorted(map(tuple, best.collect())) == sorted(map(tuple, everything.collect()))


@pytest.mark.parametrize("block_rows", [7, 8192])
def test_certificate_of_a_complete_top(spark, recommender, block_rows):
    _, _, _, user_ids, item_ids, model = recommender
    users, items = lists(spark, [f"u{n}" for n in range(40)], [f"i{n}" for n in range(30)])
    left, right = (materialize(x, "factors") for x in listed_factors(model, users, items, user_ids, item_ids))
    best = materialize(score_factors(left, right, 4), "best")
    rows = top_certificate(best, left, right, 4, block_rows).collect()
    assert len(rows) == 40 and {(r.n_scores, r.wrong, r.missed) for r in rows} == {(4, 0, 0)}
    # planted faults: a lower row in the place of the best one, a score that is not the product, no rows at all
    every = materialize(score_factors(left, right), "all")
    top = best.where("user_id = 'u3'").orderBy(F.desc("prediction")).first()
    fifth = every.where("user_id = 'u3'").join(best, ["user_id", "item_id"], "left_anti").orderBy(F.desc("prediction")).limit(1)
    swapped = best.where(f"NOT (user_id = 'u3' AND item_id = '{top.item_id}')").unionByName(fifth)
    spoiled = swapped.withColumn("prediction", F.when(F.col("user_id") == "u5", F.col("prediction") * 1.5).otherwise(F.col("prediction")).cast("float"))
    spoiled = spoiled.where("user_id <> 'u8'")
    found = {r.user_id: r for r in top_certificate(spoiled, left, right, 4, block_rows).collect()}
    assert found["u3"].missed == 1 and found["u3"].wrong == 0
    assert found["u5"].wrong == 4
    assert found["u8"].n_scores == 0 and found["u8"].missed == 30
    assert all((r.wrong, r.missed) == (0, 0) for u, r in found.items() if u not in ("u3", "u5", "u8"))


def test_certificate_prunes_by_norm(spark):
    draw = np.random.default_rng(2)
    items = [(i, (draw.uniform(0.1, 1.0, 4) * (10.0 if i < 40 else 0.01)).tolist()) for i in range(2000)]
    users = [(u, draw.uniform(0.1, 1.0, 4).tolist()) for u in range(20)] + [(99, [0.0] * 4)]
    left = spark.createDataFrame([(u, u, f) for u, f in users], "user_id long, id long, _factors array<float>")
    right = spark.createDataFrame([(i, i, f) for i, f in items], "item_id long, id long, _factors array<float>")
    rows = top_certificate(score_factors(left, right, 3), left, right, 3).collect()
    assert all((r.wrong, r.missed) == (0, 0) for r in rows) and len(rows) == 21
    assert all(r.compared <= 40 for r in rows)  # of 2 000
    assert top_certificate(score_factors(left, right.limit(0), 3), left, right.limit(0), 3).count() == 21


@pytest.mark.parametrize("limit", [1, 5])
@pytest.mark.parametrize("kind", ["plain", "ties", "no numbers", "tiny"])
def test_leaves_give_the_top_of_all_products(kind, limit):
    draw = np.random.default_rng(4)
    users, items = draw.normal(size=(90, 3)), draw.normal(size=(1500, 3))
    if kind == "ties":
        users, items = np.round(users), np.round(items)
    if kind == "no numbers":
        items[[3, 700]], items[9], users[0] = np.nan, np.inf, np.nan
    if kind == "tiny":
        users, items = users * 1e-20, items * draw.choice([1e-20, 1.0], size=(1500, 1))
    with np.errstate(all="ignore"):
        scores = sum(users[:, n : n + 1] * items[:, n] for n in range(3)).astype(np.float32)
        expected = set()
        for user, row in enumerate(scores):
            for least in np.unique(row[row > 0])[-limit:][:1]:
                expected |= {(user, item, row[item]) for item in np.flatnonzero(row >= least)}
        rows, cols, kept, _ = _top_finder(limit)(users, items)
    assert len(rows) == len(expected) and {*zip(rows, cols, kept)} == expected


def test_the_top_is_found_without_most_products():
    """Items of equal norm, so that norms prune nothing; before, every item was scored for every user."""
    draw = np.random.default_rng(5)
    users, items = draw.normal(size=(200, 4)), draw.normal(size=(40_000, 4))
    items /= np.sqrt((items**2).sum(axis=1, keepdims=True))
    rows, _, _, made = _top_finder(5)(users, items)
    assert len(rows) == 1000 and made < 0.2 * 200 * 40_000


def test_certificate_prunes_items_of_equal_norm(spark):
    draw = np.random.default_rng(6)
    items = draw.normal(size=(20_000, 3))
    items /= np.sqrt((items**2).sum(axis=1, keepdims=True))
    left = spark.createDataFrame([(n, n, f.tolist()) for n, f in enumerate(draw.normal(size=(50, 3)))], "user_id long, id long, _factors array<float>")
    right = spark.createDataFrame([(n, n, f.tolist()) for n, f in enumerate(items)], "item_id long, id long, _factors array<float>")
    rows = top_certificate(score_factors(left, right, 3), left, right, 3).collect()
    assert len(rows) == 50 and {(r.n_scores, r.wrong, r.missed) for r in rows} == {(3, 0, 0)}
    assert max(r.compared for r in rows) < 4_000  # of 20 000, all of which were compared before


def test_users_are_cut_so_that_all_cores_have_blocks(spark):
    left, right = (spark.range(9000).select(F.col("id").alias(n), "id", F.array(F.lit(1.0)).alias("_factors")) for n in ("user_id", "item_id"))
    plan = score_factors(left, right.limit(5), 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "3) as int) AS _row" in plan and "1) as int) AS _col" in plan

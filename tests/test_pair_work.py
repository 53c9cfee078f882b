"""What is computed once a pair: nothing that one side decides."""

from pairwright import schemas as s
from pairwright.functions import gap_band
from pairwright.operators.features import Feature, plan_sides
from pairwright.plans.jobs import candidate_features
from pairwright.workload import frames as f
from pairwright.workload.queries import QUERIES
from pyspark.sql import functions as F

SMOKE = "/root/testdata/sf0.001"


def above_join(df):
    """The part of the optimized plan above the join of the sides."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan[: plan.index("Join Inner")]


def test_match_levels_parse_no_text_on_pairs(spark):
    assert "RLIKE" not in above_join(QUERIES["match_levels"](spark, SMOKE))


def test_equal_columns_move_features_to_users():
    features = [Feature("m", "match", ("i_cat", "u_wish")), Feature("n", "match", ("i_other", "u_wish"))]
    plan = plan_sides(features, ["u_exp", "u_wish"], ["i_cat", "i_other"], {"i_cat": "u_exp"})
    assert plan.users == [Feature("m", "match", ("u_exp", "u_wish"))]
    assert [x.name for x in plan.pairs] == ["n"]


def test_an_overwritten_column_is_no_longer_equal():
    features = [Feature("i_cat", "region", ("i_cat",)), Feature("m", "match", ("i_cat", "u_wish"))]
    plan = plan_sides(features, ["u_exp", "u_wish"], ["i_cat"], {"i_cat": "u_exp"})
    assert [x.name for x in plan.items] == ["i_cat"]
    assert plan.pairs == [Feature("m", "match", ("i_cat", "u_wish"))]


def test_candidates_are_filled_before_sides_meet(spark):
    pairs = QUERIES["candidate_features"](spark, SMOKE)
    assert "coalesce" not in above_join(pairs)
    assert pairs.columns == [*s.ID_COLUMNS, *s.FEATURE_COLUMNS]
    assert pairs.where(" OR ".join(f"{c} IS NULL" for c in s.RAW_FEATURES)).count() == 0


def test_candidates_are_the_same_on_a_grid(spark):
    sides = [f.bind(f.table(spark, SMOKE, name), columns) for name, columns in (
        ("customer", f.CANDIDATE_USERS), ("supplier", f.CANDIDATE_ITEMS), ("supplier", f.SCHOOLS)
    )]
    whole, cut = candidate_features(*sides), candidate_features(*sides, max_rows=0, cell_rows=2, pairs_per_task=4)
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))


def test_gap_bands_at_their_bounds(spark):
    gaps = [-1e6, -999999.5, -5e5, 0.0, 0.5, 5e5, 500000.5, 1e6, 1000000.5, float("nan"), float("inf"), float("-inf"), None]
    rows = spark.createDataFrame([(n, g) for n, g in enumerate(gaps)], "n int, g double")
    banded = rows.select("n", gap_band(F.col("g"), F.lit(0.0), parse=False)).collect()
    assert [b for _, b in sorted(banded)] == [*"1223445560610"]


def test_items_are_met_in_blocks_of_a_key(spark):
    """A user meets an array of a key's items, and no hash table has a row for each item, however many there are."""
    pairs = QUERIES["eligible_pairs"](spark, SMOKE)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "inline(" in plan[: plan.index("Join Inner")]
    assert "collect_list" in plan[plan.index("Join Inner") :]
    assert "offer" not in plan  # what pairs do not need is not sent

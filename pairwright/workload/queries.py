"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairwright.functions import age_years, area_code, date_serial, gap_band, match_level, present, region_group
from pairwright.ml.als import USER_ID, fit_als, index_log, listed_factors, score_factors, score_lists
from pairwright.ml.certificate import top_certificate
from pairwright.ml.forest import fit_forest, match_scores
from pairwright.operators.eligibility import eligible_filter, eligible_pairs
from pairwright.operators.features import fill_missing, fill_numeric
from pairwright.operators.funnel import (
    AREA_CODES,
    CATEGORY_CODES,
    REQUIREMENT_CODES,
    Flags,
    funnel_all,
    funnel_by,
    funnel_counts,
    funnel_wide,
    score_buckets,
)
from pairwright.operators.joins import all_pairs
from pairwright.operators.keys import dense_ids, distinct_keys, distinct_pairs, rank_within, row_ids
from pairwright.operators.lookup import dim_lookup, extract_mapping, facts_for_keys
from pairwright.operators.outcomes import Fact, outcome_flags, repeat_rows
from pairwright.operators.ranking import at_least, positive, score_export, top_n
from pairwright.operators.split import hash_share, label_index, weighted_precision
from pairwright.plans.jobs import candidate_features as build_candidates
from pairwright.plans.jobs import scored_outcomes
from pairwright.session import materialize, scratch_path
from pairwright.sources.export import export_by_key
from pairwright.workload import frames as f
from pairwright.workload.frames import bind, table
from pairwright.workload.job_queries import JOB_QUERIES

Query = Callable[[SparkSession, str], DataFrame]

ALS_LIMIT = 5

DATE_TEXT = (
    "CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'yyyy/M/d') "
    "WHEN 1 THEN date_format(o_orderdate, 'yyyy/MM/dd HH:mm:ss') "
    "WHEN 2 THEN date_format(o_orderdate, 'yyyy-MM-dd') "
    "ELSE date_format(o_orderdate, 'yyyy/MM/dd') END"
)


def _eligible(spark: SparkSession, folder: str, item_columns: list[str]) -> DataFrame:
    users, items = f.users(spark, folder), f.items(spark, folder)
    return eligible_pairs(users, items, f.RULE, item_columns, left_by=["u_id"], right_by=["i_id"])


def q_eligible_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return _eligible(spark, folder, ["i_id", "i_cat", "i_place"]).select("u_id", "i_id", "i_cat", "i_place")


def q_eligible_filter(spark: SparkSession, folder: str) -> DataFrame:
    known = f.scored_pairs(spark, folder).select(F.col("o_custkey").alias("u_id"), F.col("l_suppkey").alias("i_id"))
    flat = known.join(f.users(spark, folder), "u_id").join(f.items(spark, folder), "i_id")
    return eligible_filter(flat, f.RULE).select("u_id", "i_id")


def q_cross_pairs(spark: SparkSession, folder: str) -> DataFrame:
    left = table(spark, folder, "customer").select("c_custkey")
    return all_pairs(left, table(spark, folder, "nation").select("n_nationkey"))


def q_region_group(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("p_size").cast("string")
    return table(spark, folder, "part").select("p_partkey", region_group(code).alias("region"))


def q_area_code(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("p_size").cast("string")
    return table(spark, folder, "part").select("p_partkey", area_code(code).alias("area"))


def q_date_serial(spark: SparkSession, folder: str) -> DataFrame:
    dates = table(spark, folder, "orders").selectExpr("o_orderkey", f"{DATE_TEXT} AS text")
    return dates.select("o_orderkey", date_serial(F.col("text")).alias("serial"))


def q_age_years(spark: SparkSession, folder: str) -> DataFrame:
    dates = table(spark, folder, "orders").selectExpr("o_orderkey", f"{DATE_TEXT} AS text")
    now = F.lit("2002-02-28 00:00:00")
    return dates.select("o_orderkey", age_years(F.col("text"), now).alias("years"))


def q_match_levels(spark: SparkSession, folder: str) -> DataFrame:
    """What users alone decide is computed before the sides meet: pairs grow as the product of the tables.

    The category of an eligible item is the user's experience, so users hold both texts of a match with it.
    """
    users = f.users(spark, folder).withColumns(
        {
            "place": F.nullif(F.col("p1"), F.lit("4")),
            "wanted_match": match_level(F.col("u_exp"), F.col("d2")),
            "area_match": match_level(F.nullif(F.col("a1"), F.lit("0")), F.col("a2")),
            "wanted_match_no_zero": match_level(F.col("u_exp"), F.col("d2"), zero_is_missing=True),
        }
    )
    items = f.items(spark, folder)
    pairs = eligible_pairs(users, items, f.RULE, ["i_id", "i_place"], left_by=["u_id"], right_by=["i_id"])
    place_match = match_level(F.col("i_place"), F.col("place")).alias("place_match")
    return pairs.select("u_id", "i_id", "wanted_match", place_match, "area_match", "wanted_match_no_zero")


def q_gap_bands(spark: SparkSession, folder: str) -> DataFrame:
    return _eligible(spark, folder, ["i_id", "offer"]).select(
        "u_id", "i_id", gap_band(F.col("income"), F.col("offer"), parse=False).alias("gap")
    )


def q_fill_missing_strings(spark: SparkSession, folder: str) -> DataFrame:
    holes = table(spark, folder, "customer").selectExpr(
        "c_custkey", "NULLIF(c_mktsegment, 'BUILDING') AS segment", "NULLIF(c_name, 'Customer#000000007') AS name"
    )
    return fill_missing(holes, ["segment", "name"])


def q_na_fill_numeric(spark: SparkSession, folder: str) -> DataFrame:
    holes = table(spark, folder, "customer").selectExpr(
        "c_custkey",
        "NULLIF(c_nationkey, 3) AS nation",
        "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS balance",
        "NULLIF(c_mktsegment, 'BUILDING') AS segment",
    )
    return fill_numeric(holes)


def q_dim_lookup_dedup(spark: SparkSession, folder: str) -> DataFrame:
    dim = table(spark, folder, "supplier").select("s_nationkey", "s_suppkey", "s_name")
    left = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return dim_lookup(left, dim, "c_nationkey", "s_nationkey", ["s_suppkey"])


def q_distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_keys(f.action_log(spark, folder), "user")


def q_distinct_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_pairs(f.action_log(spark, folder), "user", "item")


def q_dense_user_ids(spark: SparkSession, folder: str) -> DataFrame:
    return dense_ids(f.action_log(spark, folder), "user", USER_ID)


def q_attach_dense_ids(spark: SparkSession, folder: str) -> DataFrame:
    return index_log(f.action_log(spark, folder), "user", "item")[0]


def q_row_ids(spark: SparkSession, folder: str) -> DataFrame:
    return row_ids(table(spark, folder, "events").select("event_id", "user_id"), "row_id", [F.col("event_id")])


def q_mapping_extract(spark: SparkSession, folder: str) -> DataFrame:
    columns = {"aodrno": "s_suppkey", "aodrid": "s_name", "wjoid": "s_nationkey"}
    return extract_mapping(table(spark, folder, "supplier"), columns)


def q_target_items_semi(spark: SparkSession, folder: str) -> DataFrame:
    targets = table(spark, folder, "lineitem").where("l_quantity = 50").select("l_partkey")
    items = table(spark, folder, "part").select("p_partkey", "p_brand")
    return facts_for_keys(items, "p_partkey", targets, "l_partkey")


def q_target_facts_semi(spark: SparkSession, folder: str) -> DataFrame:
    targets = table(spark, folder, "supplier").selectExpr(
        "CASE s_nationkey WHEN 0 THEN '' WHEN 1 THEN 'nan' WHEN 2 THEN NULL ELSE CAST(s_suppkey AS STRING) END AS target"
    )
    facts = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "CAST(l_suppkey AS STRING) AS supplier"
    )
    return facts_for_keys(facts, "supplier", targets, "target")


def _outcomes(spark: SparkSession, folder: str) -> DataFrame:
    events = f.facts(spark, folder)
    suppliers = table(spark, folder, "supplier")
    predictions = bind(f.scored_pairs(spark, folder), f.PREDICTIONS)
    return scored_outcomes(
        materialize(predictions, "predictions"),  # a stored table in the report job, and read more than once
        bind(suppliers, f.MAPPING),
        events["passed"],
        events["mailed"],
        events["applied"],
        bind(suppliers, f.REPORT_ITEMS),
    )


def q_outcome_flags(spark: SparkSession, folder: str) -> DataFrame:
    events = f.facts(spark, folder)
    pairs = f.scored_pairs(spark, folder).selectExpr(
        "CAST(o_custkey AS STRING) AS u", "CAST(l_suppkey + 100000 AS STRING) AS i", "score"
    )
    flagged = outcome_flags(
        materialize(pairs, "pairs"),
        [
            Fact("passed", events["passed"], (("i", "passed_aodrid"), ("u", "passed_astfid"))),
            Fact("applied", events["applied"], (("i", "applied_aodrid"), ("u", "applied_astfid"))),
        ],
    )
    return repeat_rows(flagged, "copies")


def q_score_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return score_buckets(f.scored_pairs(spark, folder), "score")


def _counts(spark: SparkSession, folder: str, dimensions: list[str]) -> DataFrame:
    return funnel_counts(_outcomes(spark, folder), "predicted_score", Flags(), dimensions, "copies")


def q_funnel_all(spark: SparkSession, folder: str) -> DataFrame:
    return funnel_all(_counts(spark, folder, []))


def q_funnel_by(dimension: str, codes: tuple[str, ...], spark: SparkSession, folder: str) -> DataFrame:
    return funnel_by(_counts(spark, folder, [dimension]), dimension, codes)


def q_funnel_by_category_wide(spark: SparkSession, folder: str) -> DataFrame:
    return funnel_wide(q_funnel_by("category", CATEGORY_CODES, spark, folder), "category", CATEGORY_CODES)


def q_score_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return at_least(f.scored_pairs(spark, folder), "score", 0.3)


def q_positive_scores(spark: SparkSession, folder: str) -> DataFrame:
    shifted = f.scored_pairs(spark, folder).selectExpr(
        "o_custkey",
        "l_suppkey",
        "CASE WHEN o_custkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE score - CAST(0.5 AS DOUBLE) END AS prediction",
    )
    return positive(shifted, "prediction")


def q_score_export(spark: SparkSession, folder: str) -> DataFrame:
    scores = at_least(f.scored_pairs(spark, folder), "score", 0.3)
    mapping = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    columns = {"wjoid": "s_name", "wsfid": "o_custkey", "score": "score", "aodrno": "l_suppkey"}
    return score_export(scores, mapping, "l_suppkey", columns, ["aodrno", "-score", "wsfid"])


def q_topn_dense_rank(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", F.floor("value").alias("score"))
    return top_n(events, "user_id", "score", f.EVENT_TOP)


def q_export_by_key_ranked(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_brand", "p_partkey", "p_retailprice")
    return rank_within(parts, "p_brand", [F.desc("p_retailprice"), F.col("p_partkey")], "export_rank")


def q_label_index(spark: SparkSession, folder: str) -> DataFrame:
    return label_index(table(spark, folder, "labels"), "quality")


def q_weighted_precision(spark: SparkSession, folder: str) -> DataFrame:
    judged = table(spark, folder, "labels").select("quality", (1 - F.col("toxic")).alias("guess"))
    return weighted_precision(judged, "quality", "guess")


def q_train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey")
    return customers.withColumn("is_train", hash_share(F.col("c_custkey"), 42) < 80)


def q_candidate_features(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier")
    return build_candidates(
        bind(table(spark, folder, "customer"), f.CANDIDATE_USERS),
        bind(suppliers, f.CANDIDATE_ITEMS),
        bind(suppliers, f.SCHOOLS),
    )


def q_forest_scores(spark: SparkSession, folder: str) -> DataFrame:
    """A forest learns a label that one column of the customers decides, beside columns that say nothing about it."""
    nation = F.col("c_nationkey").cast("double")
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        (F.col("c_nationkey") >= 12).cast("int").alias("label"),
        nation.alias("nation"),
        (F.lit(25.0) - nation).alias("opposite"),
        F.coalesce(F.col("c_acctbal").cast("double"), F.lit(0.0)).alias("balance"),
    ).where("nation IS NOT NULL")
    features = ["nation", "opposite", "balance"]
    fitted = fit_forest(rows, "label", features, "c_custkey", grid={"numTrees": (20,), "maxDepth": (4, 6)})
    scored = match_scores(fitted.model, rows, "score", 1)
    return scored.select("c_custkey", "label", (F.col("score") > 0.5).cast("int").alias("guess"))


def q_als_topn(spark: SparkSession, folder: str) -> DataFrame:
    indexed, user_ids, item_ids = index_log(f.action_log(spark, folder), "user", "item")
    indexed, user_ids, item_ids = (
        materialize(df, name)
        for df, name in ((indexed, "log"), (user_ids, "user-ids"), (item_ids, "item-ids"))
    )
    model = fit_als(indexed, rank=8, max_iter=5)
    users, items = user_ids.select("user"), item_ids.select("item")
    best = materialize(score_lists(model, users, items, user_ids, item_ids, limit=ALS_LIMIT), "best")
    # every returned score again from the factors, and a scan for rows that should have been returned
    left, right = (materialize(x, "factors") for x in listed_factors(model, users, items, user_ids, item_ids))
    return top_certificate(best, left, right, ALS_LIMIT).select("user_id", "n_scores", "wrong", "missed")


def q_factor_topn(spark: SparkSession, folder: str) -> DataFrame:
    """The best items of given factors: the same scoring with whole numbers, whose products SQL gives exactly."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("float"))
    vectors = table(spark, folder, "embeddings").select("vec_id", "label", whole.alias("_factors"))
    users = vectors.where("label < 3").select(F.col("vec_id").alias("user_id"), F.col("vec_id").alias("id"), "_factors")
    items = vectors.select(F.col("vec_id").alias("item_id"), F.col("vec_id").alias("id"), "_factors")
    return score_factors(users, items, ALS_LIMIT)


def q_present_flag(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    segment, name = F.expr("NULLIF(c_mktsegment, 'BUILDING')"), F.expr("NULLIF(c_nationkey, 3)")
    return customers.select("c_custkey", present(segment, name).alias("both_given"))


def q_export_by_key_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files that the per-key export writes, read back."""
    parts = table(spark, folder, "part").select("p_brand", "p_partkey", "p_retailprice")
    path = scratch_path(spark, "export")
    export_by_key(parts, path, "p_brand", "p_retailprice", "20200131", then=["p_partkey"])
    schema = "p_partkey long, p_retailprice double, run_date string, p_brand string"
    rows = spark.read.schema(schema).csv(path, header=True).withColumn("file", F.col("_metadata.file_name"))
    # where a row stands: files of a key by name, rows of a file as they were written
    stands = F.row_number().over(Window.partitionBy("p_brand").orderBy("file", "at"))
    placed = rows.withColumn("at", F.monotonically_increasing_id()).withColumn("place", stands)
    return placed.select("run_date", "p_brand", "p_partkey", "p_retailprice", "place")


QUERIES: dict[str, Query] = {
    "eligible_pairs": q_eligible_pairs,
    "eligible_filter": q_eligible_filter,
    "cross_pairs": q_cross_pairs,
    "region_group": q_region_group,
    "area_code": q_area_code,
    "date_serial": q_date_serial,
    "age_years": q_age_years,
    "match_levels": q_match_levels,
    "gap_bands": q_gap_bands,
    "fill_missing_strings": q_fill_missing_strings,
    "na_fill_numeric": q_na_fill_numeric,
    "dim_lookup_dedup": q_dim_lookup_dedup,
    "distinct_keys": q_distinct_keys,
    "distinct_pairs": q_distinct_pairs,
    "dense_user_ids": q_dense_user_ids,
    "attach_dense_ids": q_attach_dense_ids,
    "row_ids": q_row_ids,
    "mapping_extract": q_mapping_extract,
    "target_items_semi": q_target_items_semi,
    "target_facts_semi": q_target_facts_semi,
    "outcome_flags": q_outcome_flags,
    "score_buckets": q_score_buckets,
    "funnel_all": q_funnel_all,
    "funnel_by_category": partial(q_funnel_by, "category", CATEGORY_CODES),
    "funnel_by_area": partial(q_funnel_by, "area", AREA_CODES),
    "funnel_by_requirement": partial(q_funnel_by, "requirement", REQUIREMENT_CODES),
    "funnel_by_category_wide": q_funnel_by_category_wide,
    "score_threshold": q_score_threshold,
    "positive_scores": q_positive_scores,
    "score_export": q_score_export,
    "topn_dense_rank": q_topn_dense_rank,
    "export_by_key_ranked": q_export_by_key_ranked,
    "label_index": q_label_index,
    "weighted_precision": q_weighted_precision,
    "train_test_split": q_train_test_split,
    "candidate_features": q_candidate_features,
    "forest_scores": q_forest_scores,
    "als_topn": q_als_topn,
    "factor_topn": q_factor_topn,
    "present_flag": q_present_flag,
    "export_by_key_files": q_export_by_key_files,
    **JOB_QUERIES,
}

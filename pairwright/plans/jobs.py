"""The ten batch jobs. Paths that end in '.csv' are CSV folders or files, all others Parquet folders."""

from __future__ import annotations

from collections.abc import Sequence

import re

from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright import schemas as s
from pairwright.functions import area_code, or_zero
from pairwright.ml.als import ITEM_ID, USER_ID, fit_als, index_log, score_lists
from pairwright.ml.forest import ForestFit, fit_forest, match_scores
from pairwright.operators.eligibility import eligible_filter, eligible_pairs
from pairwright.operators.features import derive, fill_missing, fill_numeric, plan_sides
from pairwright.operators.funnel import (
    AREA_CODES,
    CATEGORY_CODES,
    REQUIREMENT_CODES,
    Flags,
    funnel_all,
    funnel_by,
    funnel_counts,
    requirement_code,
)
from pairwright.operators.keys import row_ids
from pairwright.operators.lookup import dim_lookup, extract_mapping, facts_for_keys
from pairwright.operators.outcomes import Fact, outcome_flags
from pairwright.operators.ranking import at_least, score_export
from pairwright.session import materialize, temporary_tables
from pairwright.sources.export import export_by_key
from pairwright.sources.tables import (
    dated,
    publish,
    read_id_list,
    read_strings,
    read_table,
    write_table,
)


def _run_date(run_date: str) -> str:
    if not re.fullmatch(r"\d{8}", run_date):
        raise ValueError(f"run_date must be YYYYMMDD, not {run_date!r}")
    return run_date


def _schools(users: DataFrame, schools: DataFrame) -> DataFrame:
    """Add the school value to users (or pairs); of repeated school rows the lowest value counts."""
    master = schools.select(s.SCHOOL_KEY, s.SCHOOL_VALUE)
    return dim_lookup(users, master, s.SCHOOL, s.SCHOOL_KEY, [s.SCHOOL_VALUE])


def training_features(pairs: DataFrame, schools: DataFrame) -> DataFrame:
    """Features and label of the eligible rows of a pair table."""
    chosen = derive(_schools(eligible_filter(pairs, s.RULE), schools), s.FEATURES)
    return chosen.select(*s.ID_COLUMNS, s.LABEL, *s.FEATURE_COLUMNS)


def candidate_features(users: DataFrame, items: DataFrame, schools: DataFrame, **sizing: object) -> DataFrame:
    """Features of every eligible pair. What depends on one side only is computed before the sides meet.

    That includes '0' for missing values, and only columns that pairs need go into the join.
    """
    with_school = _schools(users, schools)
    plan = plan_sides(s.FEATURES, with_school.columns, items.columns, {s.RULE.item_category: s.RULE.experience})
    on_pairs = {feature.name for feature in plan.pairs}
    filled = {c: f"_filled_{c}" for c in s.RAW_FEATURES if c not in on_pairs}
    needed = {*s.ID_COLUMNS, *s.FEATURE_COLUMNS, *filled.values(), *[c for x in plan.pairs for c in x.inputs], *s.RULE.columns()}
    needed -= filled.keys() - {c for x in plan.pairs for c in x.inputs} - {*s.RULE.columns()}

    def side(df: DataFrame) -> DataFrame:
        whole = df.withColumns({ours: or_zero(F.col(c)) for c, ours in filled.items() if c in df.columns})
        return whole.select(*[c for c in whole.columns if c in needed])

    sizing = {"left_by": ["u_wsfid", "u_wsfno"], "right_by": ["i_aodrid", "i_aodrno"], **sizing}
    pairs = eligible_pairs(side(derive(with_school, plan.users)), side(derive(items, plan.items)), s.RULE, **sizing)
    chosen = derive(pairs, plan.pairs)
    chosen = chosen.select(*s.ID_COLUMNS, *[F.col(filled.get(c, c)).alias(c) for c in s.FEATURE_COLUMNS])
    return fill_missing(chosen, [c for c in s.RAW_FEATURES if c not in filled])


def build_training_features(spark: SparkSession, pairs_path: str, schools_path: str, out_path: str) -> None:
    """Pair table with labels to training matrix."""
    features = training_features(read_table(spark, pairs_path), read_table(spark, schools_path))
    with temporary_tables(spark):
        # ids follow the pair, not the order of the input, so a repeated run gives the same ones
        order = [F.col(c).asc_nulls_first() for c in [*s.ID_COLUMNS, *s.FEATURE_COLUMNS, s.LABEL]]
        stored = materialize(features, "features")  # the sort samples its input: without this, all pairs are parsed twice
        write_table(row_ids(stored, "id", order), out_path)


def fit_match_model(spark: SparkSession, training_path: str, model_path: str, **options: object) -> ForestFit:
    """Training matrix to saved forest pipeline. ``options`` go to :func:`pairwright.ml.forest.fit_forest`."""
    rows = fill_numeric(read_table(spark, training_path, s.feature_matrix(with_label=True)))
    with temporary_tables(spark):
        # split and folds follow the pair, not a row number, so a repeated run makes the same ones
        pair = F.xxhash64(F.col("i_aodrid").cast("string"), F.col("u_wsfid").cast("string"))
        stored = materialize(rows.withColumn("pair_key", pair), "training")  # read many times: parse the text once
        fitted = fit_forest(stored, s.LABEL, s.FEATURE_COLUMNS, "pair_key", **options)
        fitted.model.write().overwrite().save(model_path)
    return fitted


def build_candidate_features(
    spark: SparkSession,
    users_path: str,
    items_path: str,
    schools_path: str,
    out_path: str,
    id_by: Sequence[str] | None = None,
) -> None:
    """Users and items to the feature matrix of all eligible pairs.

    With ``id_by``, columns that name a pair, ids are 0..n-1 in their order (ties by all columns), the same in every run; the
    matrix is then sorted and stored once more. Without, ids are unique and follow the order of the write.
    """
    features = candidate_features(
        read_table(spark, users_path), read_table(spark, items_path), read_table(spark, schools_path)
    )
    with temporary_tables(spark):
        if id_by is not None:
            order = [F.col(c).asc_nulls_first() for c in [*id_by, *features.columns]]
            write_table(row_ids(features, "id", order), out_path)
        else:  # unique ids in the order of the one write: the largest table is not stored first
            write_table(features.select(F.monotonically_increasing_id().alias("id"), *features.columns), out_path)


def score_candidates(
    spark: SparkSession,
    model_path: str,
    candidates_path: str,
    mapping_path: str,
    out_path: str,
    threshold: float = 0.3,
    positive_label: object = 1,
) -> None:
    """Candidate matrix to score export: probable matches with external ids, by item and score."""
    rows = fill_numeric(read_table(spark, candidates_path, s.feature_matrix(with_label=False)))
    scores = at_least(
        match_scores(PipelineModel.load(model_path), rows, "score", positive_label), "score", threshold
    ).select("i_aodrid", "u_wsfid", "score", "i_aodrno", "u_wsfno")
    mapping = read_table(spark, mapping_path, s.MAPPING).withColumnRenamed("mapping_aodrid", "i_aodrid")
    with temporary_tables(spark):
        stored = materialize(scores, "scores")  # the sort samples its input: without this, rows are scored twice
        write_table(score_export(stored, mapping, "i_aodrid", s.EXPORT_COLUMNS, s.EXPORT_ORDER), out_path)


def scored_outcomes(
    predictions: DataFrame,
    mapping: DataFrame,
    passed: DataFrame,
    mailed: DataFrame,
    applied: DataFrame,
    items: DataFrame,
    distinct_facts: bool = False,
) -> DataFrame:
    """Predictions with outcome flags and the item's category, area and requirement."""
    item_user = ("mapping_aodrid", "predicted_wsfid")
    facts = [
        Fact("passed", passed, tuple(zip(item_user, ("passed_aodrid", "passed_astfid")))),
        Fact("mailed", mailed, (("mapping_wjoid", "scout_mail_wjoid"), ("predicted_wsfid", "scout_mail_wsfid"))),
        Fact("applied", applied, tuple(zip(item_user, ("applied_aodrid", "applied_astfid")))),
    ]
    attributes = items.select(
        F.col("i_aodrno").alias("predicted_aodrno"),
        F.col("i_assyulid").alias("category"),
        area_code(F.col("i_atdfkid")).alias("area"),
        requirement_code(F.col("i_must_assyulid")).alias("requirement"),
    )
    # Mapping and attributes have the same key: the two small tables meet first, so predictions join once and are read once.
    named = mapping.withColumnRenamed("mapping_aodrno", "predicted_aodrno").join(attributes, "predicted_aodrno", "full")
    mapped = fill_numeric(predictions).join(named, "predicted_aodrno", "left")
    flagged = outcome_flags(mapped, facts, distinct=distinct_facts)
    # Without an item row the place is unknown and no requirement is known.
    return flagged.na.fill({"area": "0", "requirement": "absent"})


def funnel_report(
    spark: SparkSession,
    predictions_path: str,
    mapping_path: str,
    passed_path: str,
    mailed_path: str,
    applied_path: str,
    items_path: str,
    out_path: str | None = None,
    distinct_facts: bool = False,
) -> dict[str, DataFrame]:
    """The four outcome reports. Data is aggregated once; the reports read the stored counts."""
    rows = scored_outcomes(
        read_table(spark, predictions_path, s.PREDICTIONS),
        read_table(spark, mapping_path, s.MAPPING),
        read_table(spark, passed_path, s.PASSED),
        read_table(spark, mailed_path, s.MAILED),
        read_table(spark, applied_path, s.APPLIED),
        read_table(spark, items_path),
        distinct_facts,
    )
    counts = materialize(
        funnel_counts(rows, "predicted_score", Flags(), ["category", "area", "requirement"], "copies"), "funnel"
    )
    reports = {
        "all": funnel_all(counts),
        "category": funnel_by(counts, "category", CATEGORY_CODES),
        "area": funnel_by(counts, "area", AREA_CODES),
        "requirement": funnel_by(counts, "requirement", REQUIREMENT_CODES),
    }
    if out_path is not None:
        for name, report in reports.items():
            write_table(report, f"{out_path}/{name}.csv")
    return reports


def extract_targets(
    spark: SparkSession,
    targets_path: str,
    columns: dict[str, str],
    facts: dict[str, tuple[str, str, str]],
    out_path: str,
) -> None:
    """Id mapping of the target items, and the rows of fact tables that belong to them.

    ``columns`` maps the names aodrno, aodrid, wjoid to columns of the target list. ``facts`` maps an output name to
    (path, key column, name of the target column that lists the wanted keys).
    """
    targets = extract_mapping(read_table(spark, targets_path), columns)
    write_table(targets, f"{out_path}/aodrid_to_wjoid.csv")
    for name, (path, key, target_key) in facts.items():
        write_table(facts_for_keys(read_table(spark, path), key, targets, target_key), f"{out_path}/{name}.csv")


def export_scores_by_key(spark: SparkSession, scores_path: str, out_path: str, key: str, run_date: str) -> None:
    """One folder per key value with rows by score."""
    export_by_key(read_table(spark, scores_path), out_path, key, "score", _run_date(run_date))


def index_interactions(spark: SparkSession, log_path: str, out_path: str, run_date: str) -> None:
    """Action log (user, item, rating by position) to the log with dense ids, as dated and latest copy."""
    if log_path.rstrip("/").endswith(".csv"):
        log = read_strings(spark, log_path, ["user", "item", "rating"])
    else:
        log = spark.read.parquet(log_path).toDF("user", "item", "rating")
    with temporary_tables(spark):
        stored = materialize(log, "log")  # both id sets and the joins read it: parse the text once
        indexed, _, _ = index_log(stored, "user", "item")
        publish(indexed, out_path, _run_date(run_date))


def fit_recommender(
    spark: SparkSession, indexed_path: str, model_path: str, run_date: str, **options: object
) -> ALSModel:
    """Indexed log to saved ALS model, as dated and latest copy. ``options`` go to ``fit_als``."""
    model = fit_als(read_table(spark, indexed_path, s.INDEXED_LOG), **options)
    for path in (dated(model_path, _run_date(run_date)), model_path):
        model.write().overwrite().save(path)
    return model


def recommend(
    spark: SparkSession,
    model_path: str,
    users_path: str,
    items_path: str,
    indexed_path: str,
    out_path: str,
    run_date: str,
    limit: int = -1,
    all_pairs: bool | None = None,
) -> None:
    """Scores of listed users and items as dated and latest copies: each user's best with a ``limit``, all positive ones
    without. ``all_pairs`` writes all positive ones beside the best too; their number is that of users times items.
    """
    log = read_table(spark, indexed_path, s.INDEXED_LOG)
    users, items = read_id_list(spark, users_path, "user_id"), read_id_list(spark, items_path, "item_id")
    model = ALSModel.load(model_path)
    all_path, best_path = (f"{out_path}/als_predict_data_{kind}.csv" for kind in ("all", "limit"))
    _run_date(run_date)
    with temporary_tables(spark):
        user_ids = materialize(log.select("user", USER_ID).distinct(), "user-ids")
        item_ids = materialize(log.select("item", ITEM_ID).distinct(), "item-ids")
        if limit <= 0 or all_pairs:
            scores = score_lists(model, users, items, user_ids, item_ids)
            publish(scores, all_path, run_date)
        if limit > 0:
            best = score_lists(model, users, items, user_ids, item_ids, limit)
        else:
            best = read_table(spark, dated(all_path, run_date), scores.schema)
        publish(best, best_path, run_date)

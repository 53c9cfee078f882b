"""The jobs from files to files, on small CSV tables."""

import csv
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pairwright import schemas as s
from pairwright.operators.features import derive, fill_missing
from pairwright.operators.funnel import BUCKETS
from pairwright.plans import jobs
from pairwright.sources.tables import read_strings, read_table, write_csv
from pairwright.workload import frames as f
from tests.conftest import values

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """User, item, school, pair, mapping and event files."""
    folder = str(tmp_path_factory.mktemp("files"))
    users = f.bind(f.table(spark, TABLES, "customer"), f.CANDIDATE_USERS)
    items = f.bind(f.table(spark, TABLES, "supplier"), f.CANDIDATE_ITEMS).withColumn(
        "i_must_assyulid", F.when(F.col("i_assyulid").isin("1", "3"), F.col("i_assyulid"))
    )
    schools = f.bind(f.table(spark, TABLES, "supplier"), f.SCHOOLS)
    write_csv(users, f"{folder}/users.csv")
    write_csv(items, f"{folder}/items.csv")
    write_csv(schools, f"{folder}/schools.csv")
    users, items = read_strings(spark, f"{folder}/users.csv"), read_strings(spark, f"{folder}/items.csv")
    flat = users.join(items, F.col("i_assyulid") == F.col("u_experience_assyulid"))
    label = (F.col("u_woclk1").eqNullSafe(F.col("i_assyulid")) | F.col("u_wlaid").isin("1", "2")).cast("int")
    write_csv(flat.withColumn("tsuka", label), f"{folder}/pairs.csv")
    mapping = items.select("i_aodrno", "i_aodrid", F.concat(F.lit("w"), "i_aodrno").alias("wjoid"))
    write_csv(mapping, f"{folder}/mapping.csv")
    key = flat.select("u_wsfid", "i_aodrid", F.concat(F.lit("w"), "i_aodrno").alias("wjoid"), "i_aodrno")
    number = F.col("u_wsfid").cast("int")
    write_csv(key.where(number % 2 == 0).select("u_wsfid", "i_aodrid"), f"{folder}/applied.csv")
    write_csv(key.where(number % 4 == 0).select("u_wsfid", "i_aodrid"), f"{folder}/passed.csv")
    write_csv(key.where(number % 3 == 0).select("u_wsfid", "wjoid"), f"{folder}/mailed.csv")
    return folder


@pytest.fixture(scope="module")
def matched(spark, files):
    """Training, candidates and scores."""
    jobs.build_training_features(spark, f"{files}/pairs.csv", f"{files}/schools.csv", f"{files}/training.csv")
    fitted = jobs.fit_match_model(
        spark, f"{files}/training.csv", f"{files}/model", grid={"numTrees": (8,), "maxDepth": (5,)}, seed=3
    )
    jobs.build_candidate_features(
        spark, f"{files}/users.csv", f"{files}/items.csv", f"{files}/schools.csv", f"{files}/candidates.csv"
    )
    jobs.score_candidates(
        spark, f"{files}/model", f"{files}/candidates.csv", f"{files}/mapping.csv", f"{files}/scores.csv", threshold=0.0
    )
    return fitted


def test_training_matrix(spark, files, matched):
    rows = read_strings(spark, f"{files}/training.csv")
    assert rows.columns == s.feature_matrix(with_label=True).names
    assert sorted(int(r["id"]) for r in rows.collect()) == list(range(rows.count()))
    assert rows.count() > 50 and matched.precision > 0.6


def test_candidates_equal_features_of_the_flat_pairs(spark, files, matched):
    """Features computed before the sides meet are those computed on pairs one by one."""
    flat = jobs.eligible_filter(read_strings(spark, f"{files}/pairs.csv"), s.RULE)
    schools = read_strings(spark, f"{files}/schools.csv")
    expected = fill_missing(derive(jobs._schools(flat, schools), s.FEATURES).select(*s.ID_COLUMNS, *s.FEATURE_COLUMNS), s.RAW_FEATURES)
    candidates = read_strings(spark, f"{files}/candidates.csv")
    assert candidates.columns == s.feature_matrix(with_label=False).names
    assert values(candidates.drop("id")) == values(expected)
    assert candidates.select("id").distinct().count() == expected.count()


def test_ids_are_the_same_in_every_run(spark, files, matched):
    """Ids from a declared key do not follow the order in which rows are read."""
    users, items = (read_strings(spark, f"{files}/{n}.csv") for n in ("users", "items"))
    found = []
    for seed in (1, 2):
        for name, frame in (("users", users), ("items", items)):
            frame.orderBy(F.rand(seed)).repartition(3).write.mode("overwrite").parquet(f"{files}/mixed-{name}")
        jobs.build_candidate_features(
            spark, f"{files}/mixed-users", f"{files}/mixed-items", f"{files}/schools.csv", f"{files}/named", id_by=s.ID_COLUMNS
        )
        found.append(values(spark.read.parquet(f"{files}/named")))
    assert found[0] == found[1] and sorted(int(r[0]) for r in found[0]) == list(range(len(found[0])))
    pairs = read_strings(spark, f"{files}/pairs.csv")
    for n in (1, 2):
        pairs.orderBy(F.rand(n)).write.mode("overwrite").parquet(f"{files}/mixed-pairs")
        jobs.build_training_features(spark, f"{files}/mixed-pairs", f"{files}/schools.csv", f"{files}/training-{n}")
    assert values(spark.read.parquet(f"{files}/training-1")) == values(spark.read.parquet(f"{files}/training-2"))


def test_scores_are_mapped_and_ordered(spark, files, matched):
    rows = [r for p in sorted(Path(f"{files}/scores.csv").glob("part-*.csv")) for r in csv.DictReader(p.open())]
    assert len(rows) == read_strings(spark, f"{files}/candidates.csv").count()
    assert list(rows[0]) == ["wjoid", "wsfid", "score", "aodrno", "wsfno"]
    assert all(r["wjoid"] == "w" + r["aodrno"] for r in rows)
    assert rows == sorted(rows, key=lambda r: (r["aodrno"], -float(r["score"]), r["wsfid"]))
    jobs.score_candidates(
        spark, f"{files}/model", f"{files}/candidates.csv", f"{files}/mapping.csv", f"{files}/high.csv", threshold=0.5
    )
    high = read_table(spark, f"{files}/high.csv", s.PREDICTIONS)
    assert high.count() == sum(float(r["score"]) >= 0.5 for r in rows)


def test_funnel_report(spark, files, matched):
    reports = jobs.funnel_report(
        spark, f"{files}/scores.csv", f"{files}/mapping.csv", f"{files}/passed.csv", f"{files}/mailed.csv",
        f"{files}/applied.csv", f"{files}/items.csv", f"{files}/report",
    )
    scores = read_table(spark, f"{files}/scores.csv", s.PREDICTIONS).collect()
    total = reports["all"].agg(*[F.sum(c).alias(c) for c in ("all_rows", "mailed", "mailed_applied", "unmailed_passed")]).first()
    user = [int(r["predicted_wsfid"]) for r in scores]
    assert total["all_rows"] == len(scores)
    assert total["mailed"] == sum(u % 3 == 0 for u in user)
    assert total["mailed_applied"] == sum(u % 6 == 0 for u in user)
    assert total["unmailed_passed"] == sum(u % 4 == 0 and u % 3 != 0 for u in user)
    assert reports["all"].count() == len(BUCKETS)
    assert reports["category"].count() == 15 * 13 and reports["area"].count() == 8 * 13
    for name in ("area", "requirement"):
        part = reports[name].agg(F.sum("mailed_applied"), F.sum("unmailed_passed")).first()
        assert tuple(part) == (total["mailed_applied"], total["unmailed_passed"])
    assert read_strings(spark, f"{files}/report/all.csv").count() == len(BUCKETS)


def test_extract_targets(spark, files, tmp_path):
    (tmp_path / "targets.csv").write_text("No,ID,work\n0,100000,w0\n,nan,w1\n3,100003,\n3,100003,\n")
    jobs.extract_targets(
        spark, str(tmp_path / "targets.csv"), {"aodrno": "No", "aodrid": "ID", "wjoid": "work"},
        {
            "target_items": (f"{files}/items.csv", "i_aodrno", "aodrno"),
            "applied": (f"{files}/applied.csv", "i_aodrid", "aodrid"),
            "mailed": (f"{files}/mailed.csv", "wjoid", "wjoid"),
        },
        str(tmp_path / "out"),
    )
    assert read_strings(spark, str(tmp_path / "out/aodrid_to_wjoid.csv")).columns == ["aodrno", "aodrid", "wjoid"]
    items = read_strings(spark, str(tmp_path / "out/target_items.csv"))
    assert sorted(r["i_aodrno"] for r in items.collect()) == ["0", "3"]
    applied = read_strings(spark, str(tmp_path / "out/applied.csv"))
    expected = read_strings(spark, f"{files}/applied.csv").where(F.col("i_aodrid").isin("100000", "100003"))
    assert values(applied.select("u_wsfid", "i_aodrid")) == values(expected)


def test_export_scores_by_key(spark, files, matched, tmp_path):
    jobs.export_scores_by_key(spark, f"{files}/scores.csv", str(tmp_path / "by"), "aodrno", "20200131")
    exported = spark.read.csv(str(tmp_path / "by"), header=True)
    assert exported.count() == read_strings(spark, f"{files}/scores.csv").count()
    with pytest.raises(ValueError):
        jobs.export_scores_by_key(spark, f"{files}/scores.csv", str(tmp_path / "by"), "aodrno", "today")


def test_recommendation(spark, tmp_path):
    rows = [f"u{u},i{i},{1 + (u * i) % 5}" for u in range(12) for i in range(10) if (u + i) % 3]
    (tmp_path / "log.csv").write_text("\n".join(["who,what,stars", *rows, ",i1,1", "u1,,1", "u1,i2,bad"]) + "\n")
    (tmp_path / "users.csv").write_text("u1\nu2\nstranger\n")
    (tmp_path / "items.csv").write_text("\n".join(f"i{i}" for i in range(10)) + "\n")
    base = str(tmp_path)
    jobs.index_interactions(spark, f"{base}/log.csv", f"{base}/indexed.csv", "20200131")
    indexed = read_table(spark, f"{base}/indexed.csv", s.INDEXED_LOG)
    assert indexed.count() == len(rows) + 1
    assert values(indexed) == values(read_table(spark, f"{base}/indexed_20200131.csv", s.INDEXED_LOG))
    jobs.fit_recommender(spark, f"{base}/indexed.csv", f"{base}/als", "20200131", rank=3, max_iter=5)
    assert Path(f"{base}/als_20200131").is_dir()
    for limit in (2, -1):
        jobs.recommend(
            spark, f"{base}/als", f"{base}/users.csv", f"{base}/items.csv", f"{base}/indexed.csv", f"{base}/out", "20200131", limit, all_pairs=True
        )
        everything = read_strings(spark, f"{base}/out/als_predict_data_all.csv")
        best = read_strings(spark, f"{base}/out/als_predict_data_limit.csv")
        assert {r["user_id"] for r in everything.collect()} == {"u1", "u2"}
        assert all(float(r["prediction"]) > 0 for r in everything.collect())
        if limit == 2:
            assert best.count() >= 4 and best.count() < everything.count()
        else:
            assert values(best) == values(everything)
        assert values(best) == values(read_strings(spark, f"{base}/out/als_predict_data_limit_20200131.csv"))


def test_parquet_between_jobs(spark, files, matched, tmp_path):
    """Paths without '.csv' are Parquet folders."""
    out = str(tmp_path / "candidates")
    jobs.build_candidate_features(spark, f"{files}/users.csv", f"{files}/items.csv", f"{files}/schools.csv", out)
    assert spark.read.parquet(out).columns == s.feature_matrix(with_label=False).names
    jobs.score_candidates(spark, f"{files}/model", out, f"{files}/mapping.csv", str(tmp_path / "scores"), threshold=0.0)
    first = read_table(spark, f"{files}/scores.csv", s.PREDICTIONS).select("predicted_aodrno", "predicted_wsfid", "predicted_score")
    assert values(read_table(spark, str(tmp_path / "scores"), s.PREDICTIONS).select(*first.columns)) == values(first)
    with pytest.raises(ValueError):
        read_table(spark, out, s.MAPPING)

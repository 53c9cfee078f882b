"""SQL of each query for an independent engine: plain joins, filters and windows, without the rewrites of the library."""

from __future__ import annotations

from pairwright.operators.funnel import AREA_CODES, BUCKETS, CATEGORY_CODES, LOWER_BOUNDS, REQUIREMENT_CODES
from pairwright.schemas import DERIVED_FEATURES, FEATURE_COLUMNS, FEATURES, ID_COLUMNS, LABEL, RAW_FEATURES, feature_matrix
from pairwright.schemas import RULE as FILE_RULE
from pairwright.workload import frames as f


def _bound(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{text} AS {name}" for name, text in columns.items()) + f" FROM {source}"


LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
PAIRS = f"SELECT DISTINCT o_custkey, l_suppkey, {f.SCORE} AS score FROM {LINES}"


def _area(code: str) -> str:
    n = f"TRY_CAST({code} AS INTEGER)"
    return (
        f"CASE WHEN {n} BETWEEN 1 AND 7 THEN '2' WHEN {n} BETWEEN 8 AND 14 THEN '3' WHEN {n} BETWEEN 21 AND 24 THEN '4' "
        f"WHEN {n} BETWEEN 15 AND 20 THEN '5' WHEN {n} BETWEEN 25 AND 30 THEN '6' WHEN {n} BETWEEN 31 AND 39 THEN '7' "
        f"WHEN {n} BETWEEN 40 AND 47 THEN '8' ELSE '0' END"
    )


def _region(code: str) -> str:
    n = f"TRY_CAST({code} AS INTEGER)"
    return (
        f"CASE WHEN {n} BETWEEN 1 AND 7 THEN '1' WHEN {n} BETWEEN 8 AND 10 THEN '2' WHEN {n} BETWEEN 15 AND 20 THEN '3' "
        f"WHEN {n} BETWEEN 31 AND 39 THEN '5' WHEN {n} BETWEEN 41 AND 47 THEN '6' WHEN {n} IN (24, 25, 29, 30) THEN '4' "
        f"WHEN {n} IN (11, 12, 13, 14, 21, 22, 23, 26, 27, 28, 40, 99) THEN CAST({n} AS VARCHAR) ELSE '0' END"
    )


def _match(a: str, b: str) -> str:
    return f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN '0' WHEN {a} = {b} THEN '2' ELSE '1' END"


def _gap(a: str, b: str) -> str:
    d = f"(TRY_CAST({a} AS DOUBLE) - TRY_CAST({b} AS DOUBLE))"
    return (
        f"CASE WHEN {d} IS NULL THEN '0' WHEN {d} <= -1000000 THEN '1' WHEN {d} <= -500000 THEN '2' WHEN {d} <= 0 THEN '3' "
        f"WHEN {d} <= 500000 THEN '4' WHEN {d} <= 1000000 THEN '5' ELSE '6' END"
    )


def _serial(text: str) -> str:
    day = f"CAST(TRY_STRPTIME({text}, '%Y/%m/%d') AS DATE)"
    return f"COALESCE(CAST(DATE_DIFF('day', DATE '1899-12-31', {day}) + 1 AS VARCHAR), '0')"


def _rule(rule) -> str:
    anywhere = " OR ".join(f"{a} = '1'" for a in rule.wanted_areas)
    area = " OR ".join(f"{_area(rule.item_place)} = {a}" for a in rule.wanted_areas)
    place = " OR ".join(f"{rule.item_place} = {p}" for p in rule.wanted_places)
    wants = " OR ".join(f"{rule.item_category} = {d}" for d in rule.wanted_categories)
    return (
        f"{rule.item_category} = {rule.experience} AND ({wants}) AND {rule.item_place} IS NOT NULL "
        f"AND ({place} OR {anywhere} OR {area})"
    )


SIDES = f"u AS ({_bound(f.USERS, 'customer')}), i AS ({_bound(f.ITEMS, 'supplier')})"
ELIGIBLE = f"WITH {SIDES}, e AS (SELECT * FROM u, i WHERE {_rule(f.RULE)})"


def _outcomes() -> str:
    facts = ", ".join(
        f"{name} AS ({_bound(columns, LINES + ' WHERE ' + kept)})" for name, (kept, columns) in f.FACTS.items()
    )
    bucket = " ".join(
        f"WHEN score < CAST({upper} AS DOUBLE) THEN '{name}'" for upper, name in zip(LOWER_BOUNDS[1:], BUCKETS)
    )
    return f"""
WITH pred AS ({_bound(f.PREDICTIONS, f"({PAIRS}) AS pairs")}),
mapping AS ({_bound(f.MAPPING, "supplier")}), item AS ({_bound(f.REPORT_ITEMS, "supplier")}), {facts},
flat AS (
  SELECT predicted_score AS score, i_assyulid AS category, {_area("i_atdfkid")} AS area,
    CASE WHEN i_must_assyulid IS NULL THEN 'absent' ELSE 'present' END AS requirement,
    passed_astfid IS NOT NULL AS p, scout_mail_wsfid IS NOT NULL AS m, applied_astfid IS NOT NULL AS a
  FROM pred LEFT JOIN mapping ON predicted_aodrno = mapping_aodrno
  LEFT JOIN passed ON mapping_aodrid = passed_aodrid AND predicted_wsfid = passed_astfid
  LEFT JOIN mailed ON mapping_wjoid = scout_mail_wjoid AND predicted_wsfid = scout_mail_wsfid
  LEFT JOIN applied ON mapping_aodrid = applied_aodrid AND predicted_wsfid = applied_astfid
  LEFT JOIN item ON predicted_aodrno = i_aodrno),
bucketed AS (
  SELECT *, CASE WHEN score < 0 OR score > 1 THEN NULL {bucket} ELSE '{BUCKETS[-1]}' END AS bucket FROM flat)"""


BUCKET_SPINE = "SELECT UNNEST([" + ", ".join(f"'{b}'" for b in BUCKETS) + "]) AS bucket"
SPLIT_COUNTS = {
    "mailed_applied": "m AND a",
    "mailed_passed": "m AND p",
    "unmailed_applied": "NOT m AND a",
    "unmailed_passed": "NOT m AND p",
}


def _counted(conditions: dict[str, str]) -> str:
    return ", ".join(f"COUNT(*) FILTER (WHERE {c}) AS {name}" for name, c in conditions.items())


def _ratio(kind: str) -> str:
    applied, passed = f"COALESCE({kind}_applied, 0)", f"COALESCE({kind}_passed, 0)"
    return (
        f"CASE WHEN {applied} = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({passed} AS DOUBLE) / CAST({applied} AS DOUBLE) END "
        f"AS {kind}_ratio"
    )


def _zero(*names: str) -> str:
    return ", ".join(f"CAST(COALESCE({n}, 0) AS BIGINT) AS {n}" for n in names)


def _funnel_all() -> str:
    conditions = {"all_rows": "TRUE", "mailed": "m", **SPLIT_COUNTS}
    return f"""{_outcomes()},
n AS (SELECT bucket, {_counted(conditions)} FROM bucketed GROUP BY bucket)
SELECT s.bucket, {_zero(*conditions)}, {_ratio("mailed")}, {_ratio("unmailed")}
FROM ({BUCKET_SPINE}) AS s LEFT JOIN n ON s.bucket = n.bucket"""


def _funnel_by(dimension: str, codes: tuple[str, ...]) -> str:
    code_spine = "SELECT UNNEST([" + ", ".join(f"'{c}'" for c in codes) + f"]) AS {dimension}"
    return f"""{_outcomes()},
n AS (SELECT bucket, {dimension}, {_counted(SPLIT_COUNTS)} FROM bucketed GROUP BY bucket, {dimension})
SELECT s.bucket, c.{dimension}, {_zero(*SPLIT_COUNTS)}, {_ratio("mailed")}, {_ratio("unmailed")}
FROM ({BUCKET_SPINE}) AS s CROSS JOIN ({code_spine}) AS c
LEFT JOIN n ON s.bucket = n.bucket AND c.{dimension} = n.{dimension}"""


def _funnel_wide(dimension: str, codes: tuple[str, ...]) -> str:
    measures = (*SPLIT_COUNTS, "mailed_ratio", "unmailed_ratio")
    columns = ", ".join(
        f"MAX(CASE WHEN {dimension} = '{c}' THEN {m} END) AS \"{c}_{m}\"" for c in codes for m in measures
    )
    return f"SELECT bucket, {columns} FROM ({_funnel_by(dimension, codes)}) AS report GROUP BY bucket"


def _feature_values() -> dict[str, str]:
    """SQL text of each column of the user and item files, and of each derived feature."""
    user_names, item_names = list(f.CANDIDATE_USERS), list(f.CANDIDATE_ITEMS)
    value = {name: f'"{name}"' for name in user_names + item_names}
    value["hensachi"] = "hensachi"
    for feature in FEATURES:
        inputs = [value[name] for name in feature.inputs]
        value[feature.name] = {
            "region": lambda a: _region(a),
            "serial": lambda a: _serial(a),
            "fill": lambda a: f"COALESCE({a}, '0')",
            "match": _match,
            "gap": _gap,
        }[feature.kind](*inputs)
    return value


FILES = f"""u AS ({_bound(f.CANDIDATE_USERS, "customer")}), i AS ({_bound(f.CANDIDATE_ITEMS, "supplier")}),
school AS (SELECT wscnm, MIN(hensachi) AS hensachi FROM ({_bound(f.SCHOOLS, "supplier")}) AS s GROUP BY wscnm)"""


def _candidates() -> str:
    value = _feature_values()
    columns = [f"{value[c]} AS {c}" for c in [*ID_COLUMNS, *DERIVED_FEATURES]]
    columns += [f"COALESCE({value[c]}, '0') AS {c}" for c in RAW_FEATURES]
    assert len(columns) == len(ID_COLUMNS) + len(FEATURE_COLUMNS)
    return f"""
WITH {FILES},
e AS (SELECT * FROM u JOIN i ON {_rule(FILE_RULE)} LEFT JOIN school ON u_wscnm = wscnm)
SELECT {", ".join(columns)} FROM e"""


def _job_training() -> str:
    value, kind = _feature_values(), {x.name: x.dataType.typeName() for x in feature_matrix(with_label=True)}
    numbers = ", ".join(f"TRY_CAST({value[c]} AS {kind[c].upper()}) AS {c}" for c in FEATURE_COLUMNS)
    ids = ", ".join(f'"{c}"' for c in ID_COLUMNS)
    return f"""
WITH {FILES}, known AS (SELECT DISTINCT o_custkey, l_suppkey FROM {LINES}),
e AS (SELECT * FROM known JOIN u ON u_wsfid = CAST(o_custkey AS VARCHAR) JOIN i ON i_aodrno = CAST(l_suppkey AS VARCHAR)
  LEFT JOIN school ON u_wscnm = wscnm WHERE {_rule(FILE_RULE)})
SELECT ROW_NUMBER() OVER (ORDER BY {ids}) - 1 AS id, {ids},
  CAST(COALESCE(u_wlaid, '0') >= '{f.LABEL_FROM}' AS INTEGER) AS {LABEL}, {numbers} FROM e"""


def _job_scores() -> str:
    return f"""
WITH {FILES}, mapping AS ({_bound(f.MAPPING, "supplier")})
SELECT mapping_wjoid AS predicted_wjoid, u_wsfid AS predicted_wsfid, i_aodrno AS predicted_aodrno,
  u_wsfno AS predicted_wsfno, 'u_wlaid' AS decides
FROM u JOIN i ON {_rule(FILE_RULE)} JOIN mapping ON mapping_aodrid = i_aodrid
WHERE COALESCE(u_wlaid, '0') >= '{f.LABEL_FROM}'"""


def _job_targets() -> str:
    def events(name: str) -> str:
        kept, columns = f.FACTS[name]
        return f"({_bound(columns, LINES + ' WHERE ' + kept)})"

    def named(column: str) -> str:
        return f"(SELECT {column} FROM t WHERE {column} NOT IN ('', 'nan'))"

    return f"""
WITH t AS ({_bound(f.TARGETS, "supplier WHERE " + f.TARGETED)})
SELECT 'aodrid_to_wjoid' AS kind, number AS c1, id AS c2, "work" AS c3 FROM t
UNION ALL SELECT 'target_items', i_aodrno, i_assyulid, i_must_assyulid FROM ({_bound(f.REPORT_ITEMS, "supplier")}) AS i
  WHERE i_aodrno IN {named("number")}
UNION ALL SELECT 'target_passed', passed_aodrid, passed_astfid, NULL FROM {events("passed")} AS p
  WHERE passed_aodrid IN {named("id")}
UNION ALL SELECT 'target_mailed', scout_mail_wjoid, scout_mail_wsfid, NULL FROM {events("mailed")} AS m
  WHERE scout_mail_wjoid IN {named('"work"')}
UNION ALL SELECT 'target_applied', applied_aodrid, applied_astfid, NULL FROM {events("applied")} AS a
  WHERE applied_aodrid IN {named("id")}"""


def _job_index() -> str:
    log = (
        '(SELECT CAST(o_custkey AS VARCHAR) AS "user", CAST(l_partkey AS VARCHAR) AS item, '
        f"CAST(l_quantity AS DOUBLE) AS rating FROM {LINES}) AS log"
    )
    return (
        f"""SELECT copy, log."user", log.item, rating, du.dense AS unique_user_id, di.dense AS unique_item_id FROM {log} """
        f"""JOIN ({_dense('"user"', log)}) AS du ON log."user" = du."user" """
        f"""JOIN ({_dense("item", log)}) AS di ON log.item = di.item """
        "CROSS JOIN (SELECT UNNEST(['latest', 'dated']) AS copy) AS copies"
    )


def _dense(key: str, source: str) -> str:
    return (
        f"SELECT {key}, ROW_NUMBER() OVER (ORDER BY SUBSTR(MD5(CAST({key} AS VARCHAR)), 1, 3), {key}) - 1 AS dense "
        f"FROM (SELECT DISTINCT {key} FROM {source}) AS k"
    )


LOG = f'(SELECT o_custkey AS "user", l_partkey AS item, l_quantity AS rating FROM {LINES})'
# The texts of the date queries: form 2 of the four is not a date.
ORDER_DAY = "CASE WHEN o_orderkey % 4 = 2 THEN NULL ELSE CAST(o_orderdate AS DATE) END"
NOW = "DATE '2002-02-28'"

ORACLE: dict[str, str] = {
    "eligible_pairs": f"{ELIGIBLE} SELECT u_id, i_id, i_cat, i_place FROM e",
    "eligible_filter": (
        f"WITH {SIDES}, known AS ({PAIRS}) SELECT u_id, i_id FROM known JOIN u ON o_custkey = u_id "
        f"JOIN i ON l_suppkey = i_id WHERE {_rule(f.RULE)}"
    ),
    "cross_pairs": "SELECT c_custkey, n_nationkey FROM customer CROSS JOIN nation",
    "region_group": f"SELECT p_partkey, {_region('p_size')} AS region FROM part",
    "area_code": f"SELECT p_partkey, {_area('p_size')} AS area FROM part",
    "date_serial": (
        f"SELECT o_orderkey, COALESCE(CAST(DATE_DIFF('day', DATE '1899-12-31', {ORDER_DAY}) + 1 AS VARCHAR), '0') "
        "AS serial FROM orders"
    ),
    "age_years": (
        f"WITH d AS (SELECT o_orderkey, {ORDER_DAY} AS day FROM orders), "
        f"k AS (SELECT o_orderkey, day, CAST(YEAR({NOW}) - YEAR(day) AS INTEGER) AS k FROM d) "
        "SELECT o_orderkey, CAST(CASE WHEN day IS NULL THEN 0 "
        f"WHEN day <= {NOW} THEN k - CAST(day + TO_YEARS(k) > {NOW} AS INTEGER) "
        f"ELSE k + CAST(day + TO_YEARS(k) < {NOW} AS INTEGER) END AS INTEGER) AS years FROM k"
    ),
    "match_levels": (
        f"{ELIGIBLE} SELECT u_id, i_id, {_match('i_cat', 'd2')} AS wanted_match, "
        f"""{_match("i_place", "NULLIF(p1, '4')")} AS place_match, {_match("NULLIF(a1, '0')", "a2")} AS area_match, """
        f"""{_match("NULLIF(i_cat, '0')", "NULLIF(d2, '0')")} AS wanted_match_no_zero FROM e"""
    ),
    "gap_bands": f"{ELIGIBLE} SELECT u_id, i_id, {_gap('income', 'offer')} AS gap FROM e",
    "fill_missing_strings": (
        "SELECT c_custkey, COALESCE(NULLIF(c_mktsegment, 'BUILDING'), '0') AS segment, "
        "COALESCE(NULLIF(c_name, 'Customer#000000007'), '0') AS name FROM customer"
    ),
    "na_fill_numeric": (
        "SELECT c_custkey, COALESCE(NULLIF(c_nationkey, 3), 0) AS nation, "
        "CASE WHEN c_acctbal < 0 THEN CAST(0 AS DOUBLE) ELSE c_acctbal END AS balance, "
        "NULLIF(c_mktsegment, 'BUILDING') AS segment FROM customer"
    ),
    "dim_lookup_dedup": (
        "WITH d AS (SELECT s_nationkey, s_suppkey, s_name, "
        "ROW_NUMBER() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn FROM supplier) "
        "SELECT c_nationkey, c_custkey, s_suppkey, s_name FROM customer "
        "LEFT JOIN d ON c_nationkey = s_nationkey AND rn = 1"
    ),
    "distinct_keys": f'SELECT DISTINCT "user" FROM {LOG} AS log',
    "distinct_pairs": f'SELECT DISTINCT "user", item FROM {LOG} AS log',
    "dense_user_ids": f"""SELECT "user", dense AS unique_user_id FROM ({_dense('"user"', LOG + " AS log")}) AS d""",
    "attach_dense_ids": (
        f"""SELECT log."user", log.item, rating, du.dense AS unique_user_id, di.dense AS unique_item_id FROM {LOG} AS log """
        f"""JOIN ({_dense('"user"', LOG + " AS x")}) AS du ON log."user" = du."user" """
        f"""JOIN ({_dense("item", LOG + " AS y")}) AS di ON log.item = di.item"""
    ),
    "row_ids": "SELECT ROW_NUMBER() OVER (ORDER BY event_id) - 1 AS row_id, event_id, user_id FROM events",
    "mapping_extract": "SELECT s_suppkey AS aodrno, s_name AS aodrid, s_nationkey AS wjoid FROM supplier",
    "target_items_semi": (
        "SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)"
    ),
    "target_facts_semi": (
        "SELECT CAST(l_suppkey AS VARCHAR) AS supplier, l_orderkey, l_linenumber, l_partkey FROM lineitem "
        "WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey NOT IN (0, 1, 2))"
    ),
    "outcome_flags": (
        f"WITH pairs AS ({PAIRS}), p AS (SELECT o_custkey, l_suppkey FROM {LINES} WHERE l_linestatus = 'F'), "
        f"a AS (SELECT o_custkey, l_suppkey FROM {LINES} WHERE o_orderstatus = 'F') "
        "SELECT CAST(pairs.o_custkey AS VARCHAR) AS u, CAST(pairs.l_suppkey + 100000 AS VARCHAR) AS i, score, "
        "CASE WHEN p.o_custkey IS NULL THEN '0' ELSE '1' END AS passed, "
        "CASE WHEN a.o_custkey IS NULL THEN '0' ELSE '1' END AS applied FROM pairs "
        "LEFT JOIN p ON pairs.o_custkey = p.o_custkey AND pairs.l_suppkey = p.l_suppkey "
        "LEFT JOIN a ON pairs.o_custkey = a.o_custkey AND pairs.l_suppkey = a.l_suppkey"
    ),
    "score_buckets": (
        f"WITH edge AS (SELECT UNNEST([{', '.join(f'CAST({b} AS DOUBLE)' for b in LOWER_BOUNDS)}]) AS lo, "
        f"UNNEST([{', '.join(f'CAST({b} AS DOUBLE)' for b in (*LOWER_BOUNDS[1:], 1.0))}]) AS up, "
        f"UNNEST([{', '.join(repr(b) for b in BUCKETS)}]) AS bucket) "
        f"SELECT bucket, COUNT(score) AS n FROM edge LEFT JOIN ({PAIRS}) AS pairs "
        "ON score >= lo AND (score < up OR (up = 1 AND score <= 1)) GROUP BY bucket"
    ),
    "funnel_all": _funnel_all(),
    "funnel_by_category": _funnel_by("category", CATEGORY_CODES),
    "funnel_by_area": _funnel_by("area", AREA_CODES),
    "funnel_by_requirement": _funnel_by("requirement", REQUIREMENT_CODES),
    "funnel_by_category_wide": _funnel_wide("category", CATEGORY_CODES),
    "score_threshold": f"SELECT * FROM ({PAIRS}) AS pairs WHERE score >= CAST(0.3 AS DOUBLE)",
    "positive_scores": (
        f"SELECT o_custkey, l_suppkey, score - CAST(0.5 AS DOUBLE) AS prediction FROM ({PAIRS}) AS pairs "
        "WHERE o_custkey % 7 <> 0 AND score - CAST(0.5 AS DOUBLE) > 0"
    ),
    "score_export": (
        f"SELECT s_name AS wjoid, o_custkey AS wsfid, score, l_suppkey AS aodrno FROM ({PAIRS}) AS pairs "
        "JOIN supplier ON l_suppkey = s_suppkey WHERE score >= CAST(0.3 AS DOUBLE)"
    ),
    "topn_dense_rank": (
        "SELECT event_id, user_id, score FROM (SELECT event_id, user_id, score, DENSE_RANK() OVER "
        "(PARTITION BY user_id ORDER BY score DESC) AS rank FROM "
        "(SELECT event_id, user_id, CAST(FLOOR(value) AS BIGINT) AS score FROM events) AS e) AS r "
        f"WHERE rank <= {f.EVENT_TOP}"
    ),
    "export_by_key_ranked": (
        "SELECT p_brand, p_partkey, p_retailprice, ROW_NUMBER() OVER "
        "(PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS export_rank FROM part"
    ),
    "export_by_key_files": (
        "SELECT '20200131' AS run_date, p_brand, p_partkey, CAST(p_retailprice AS DOUBLE) AS p_retailprice, ROW_NUMBER() OVER "
        "(PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS place FROM part"
    ),
    "present_flag": (
        "SELECT c_custkey, CASE WHEN NULLIF(c_mktsegment, 'BUILDING') IS NOT NULL AND NULLIF(c_nationkey, 3) IS NOT NULL "
        "THEN '1' ELSE '0' END AS both_given FROM customer"
    ),
    "forest_scores": (
        "SELECT c_custkey, CAST(c_nationkey >= 12 AS INTEGER) AS label, CAST(c_nationkey >= 12 AS INTEGER) AS guess "
        "FROM customer WHERE c_nationkey IS NOT NULL"
    ),
    "als_topn": f"""SELECT DISTINCT "user" AS user_id, 5 AS n_scores, 0 AS wrong, 0 AS missed FROM {LOG} AS log WHERE "user" IS NOT NULL""",
    "factor_topn": (
        "WITH v AS (SELECT vec_id, label, [floor(64 * x::DOUBLE) FOR x IN embedding] AS f FROM embeddings), "
        "s AS (SELECT u.vec_id AS user_id, i.vec_id AS item_id, CAST(list_inner_product(u.f, i.f) AS FLOAT) AS prediction "
        "FROM v u, v i WHERE u.label < 3) "
        "SELECT user_id, item_id, prediction FROM (SELECT *, DENSE_RANK() OVER (PARTITION BY user_id ORDER BY prediction DESC) AS r "
        "FROM s WHERE prediction > 0) WHERE r <= 5"
    ),
    "label_index": (
        "SELECT CAST(quality AS VARCHAR) AS label, COUNT(*) AS n, "
        "ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, CAST(quality AS VARCHAR)) - 1 AS label_index FROM labels GROUP BY quality"
    ),
    "weighted_precision": (
        "WITH c AS (SELECT DISTINCT quality AS class FROM labels UNION SELECT DISTINCT 1 - toxic FROM labels), "
        "m AS (SELECT class, (SELECT COUNT(*) FROM labels WHERE quality = class) AS t, "
        "(SELECT COUNT(*) FROM labels WHERE 1 - toxic = class) AS g, "
        "(SELECT COUNT(*) FROM labels WHERE quality = class AND 1 - toxic = class) AS h FROM c) "
        "SELECT SUM(t * CASE WHEN g = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(h AS DOUBLE) / g END) / SUM(t) "
        "AS weighted_precision FROM m"
    ),
    "train_test_split": (
        "SELECT c_custkey, CAST('0x' || SUBSTR(MD5(CAST(c_custkey AS VARCHAR) || ':42'), 1, 7) AS BIGINT) % 100 < 80 "
        "AS is_train FROM customer"
    ),
    "candidate_features": _candidates(),
    "job_training": _job_training(),
    "job_scores": _job_scores(),
    "job_targets": _job_targets(),
    "job_index": _job_index(),
    "job_recommend": (
        "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id, 5 AS n_scores, 0 AS wrong, 0 AS missed "
        f"FROM {LINES} JOIN customer ON c_custkey = o_custkey"
    ),
}

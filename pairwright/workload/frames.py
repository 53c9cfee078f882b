"""Test tables seen as users, items, scored pairs, facts and an action log.

Column expressions are text that Spark and ANSI SQL engines read alike, so a query and its SQL share one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.operators.eligibility import Rule

CENTURY = "CAST((c_custkey - c_custkey % 9) / 9 AS BIGINT)"

USERS = {
    "u_id": "c_custkey",
    "u_exp": "CAST(c_custkey % 6 AS STRING)",
    "d1": "CAST(c_custkey % 6 AS STRING)",
    "d2": "CAST((c_custkey + 1) % 6 AS STRING)",
    "d3": "CAST(CAST((c_custkey - c_custkey % 2) / 2 AS BIGINT) % 6 AS STRING)",
    "p1": "CAST(2 * c_nationkey AS STRING)",
    "p2": "CAST((c_custkey * 7) % 50 AS STRING)",
    "p3": "CAST((c_custkey * 11) % 50 AS STRING)",
    "a1": "CAST(c_custkey % 9 AS STRING)",
    "a2": f"CAST({CENTURY} % 9 AS STRING)",
    "a3": "CAST(CAST((c_custkey - c_custkey % 81) / 81 AS BIGINT) % 9 AS STRING)",
    "income": "c_acctbal * CAST(500 AS DOUBLE)",
}
ITEMS = {
    "i_id": "s_suppkey",
    "i_cat": "CAST(s_suppkey % 6 AS STRING)",
    "i_place": "CAST(2 * s_nationkey + s_suppkey % 2 AS STRING)",
    "offer": "s_acctbal * CAST(500 AS DOUBLE)",
}
RULE = Rule("i_cat", "i_place", "u_exp", ("d1", "d2", "d3"), ("p1", "p2", "p3"), ("a1", "a2", "a3"))

SCORE = "CAST((o_custkey * 31 + l_suppkey * 17) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE)"

# The prediction file, id mapping, event files and item file of the outcome report.
PREDICTIONS = {
    "predicted_wjoid": "CAST(l_suppkey + 200000 AS STRING)",
    "predicted_wsfid": "CAST(o_custkey AS STRING)",
    "predicted_score": "score",
    "predicted_aodrno": "CAST(l_suppkey AS STRING)",
}
MAPPING = {
    "mapping_aodrno": "CAST(s_suppkey AS STRING)",
    "mapping_aodrid": "CAST(s_suppkey + 100000 AS STRING)",
    "mapping_wjoid": "CAST(s_suppkey + 200000 AS STRING)",
}
BY_ID = ("CAST(l_suppkey + 100000 AS STRING)", "CAST(o_custkey AS STRING)")
FACTS = {
    "passed": ("l_linestatus = 'F'", {"passed_aodrid": BY_ID[0], "passed_astfid": BY_ID[1]}),
    "mailed": (
        "l_returnflag = 'N'",
        {"scout_mail_wjoid": "CAST(l_suppkey + 200000 AS STRING)", "scout_mail_wsfid": BY_ID[1]},
    ),
    "applied": ("o_orderstatus = 'F'", {"applied_aodrid": BY_ID[0], "applied_astfid": BY_ID[1]}),
}
REPORT_ITEMS = {
    "i_aodrno": "CAST(s_suppkey AS STRING)",
    "i_assyulid": "LPAD(CAST(s_suppkey % 17 AS STRING), 2, '0')",
    "i_atdfkid": ITEMS["i_place"],
    "i_must_assyulid": "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'needed' END",
}

EVENT_TOP = 3

# The target list of the extraction job: some items without an id or with the text 'nan'.
TARGETED = "s_nationkey < 12"
TARGETS = {
    "number": "CAST(s_suppkey AS STRING)",
    "id": "CASE s_nationkey WHEN 0 THEN 'nan' WHEN 1 THEN NULL ELSE CAST(s_suppkey + 100000 AS STRING) END",
    "work": "CASE s_nationkey WHEN 2 THEN 'nan' ELSE CAST(s_suppkey + 200000 AS STRING) END",
}
LABEL_FROM = 2  # the training label is 1 from this value of u_wlaid on


def _money(column: str, factor: int, shift: int) -> str:
    return f"CAST(CAST(FLOOR({column} * {factor}) AS BIGINT) + {shift} AS STRING)"


def _code(key: str, factor: int, size: int) -> str:
    return f"NULLIF(CAST(({key} * {factor}) % {size} AS STRING), '0')"


# All columns of the user and item files, with nulls, unknown places and text that is no date or number.
CANDIDATE_USERS = {
    "u_wsfno": "CONCAT('N', CAST(c_custkey AS STRING))",
    "u_wsfid": "CAST(c_custkey AS STRING)",
    "u_experience_assyulid": "NULLIF(CAST(c_custkey % 6 AS STRING), '5')",
    "u_desired_assyulid1": USERS["d2"],
    "u_desired_assyulid2": USERS["d3"],
    "u_desired_assyulid3": "NULLIF(CAST(c_custkey % 6 AS STRING), '4')",
    "u_atdfkid1": USERS["p1"],
    "u_atdfkid2": "NULLIF(CAST((c_custkey * 7) % 50 AS STRING), '14')",
    "u_atdfkid3": USERS["p3"],
    "u_aaraid1": "NULLIF(CAST(c_custkey % 9 AS STRING), '7')",
    "u_aaraid2": USERS["a2"],
    "u_aaraid3": "NULLIF(CAST((c_custkey * 5) % 9 AS STRING), '1')",
    "u_wbrdt": (
        "CASE WHEN c_custkey % 13 = 0 THEN 'unknown' ELSE CONCAT(CAST(1950 + c_custkey % 50 AS STRING), '/', "
        "CAST(1 + c_custkey % 12 AS STRING), '/', CAST(1 + c_custkey % 31 AS STRING)) END"
    ),
    "u_wpfid": "CAST((c_custkey * 3) % 55 AS STRING)",
    "u_wlaid": _code("c_custkey", 1, 4),
    "u_wbrfl": _code("c_custkey", 1, 2),
    "u_wjobc": _code("c_custkey", 1, 5),
    "u_wlmpdt": (
        "CONCAT(CAST(2010 + c_custkey % 8 AS STRING), '/', CAST(1 + c_custkey % 14 AS STRING), '/', "
        "CAST(1 + c_custkey % 28 AS STRING))"
    ),
    "u_widlk": _code("c_custkey", 1, 7),
    "u_widlk1": _code("c_custkey", 2, 7),
    "u_widsk": _code("c_custkey", 1, 3),
    "u_widsk1": _code("c_custkey", 2, 3),
    "u_woclk": _code("c_custkey", 5, 6),
    "u_woclk1": _code("c_custkey", 1, 6),
    "u_woclk2": _code("c_custkey", 3, 6),
    "u_woclk3": _code("c_custkey", 7, 6),
    "u_wocmk": _code("c_custkey", 3, 8),
    "u_wocmk1": _code("c_custkey", 1, 8),
    "u_wocmk2": _code("c_custkey", 5, 8),
    "u_wocmk3": _code("c_custkey", 7, 8),
    "u_wocsk": _code("c_custkey", 1, 4),
    "u_wocsk1": _code("c_custkey", 3, 4),
    "u_wocsk2": _code("c_custkey", 5, 4),
    "u_wocsk3": _code("c_custkey", 7, 4),
    "u_whpai": f"CASE WHEN c_custkey % 11 = 0 THEN 'none' ELSE {_money('c_acctbal', 500, 0)} END",
    "u_wmiai": f"CASE WHEN c_custkey % 11 = 1 THEN NULL ELSE {_money('c_acctbal', 400, 10)} END",
    "u_wincm": _money("c_acctbal", 450, 0),
    "u_wecnt": _code("c_custkey", 1, 10),
    "u_wmkid": _code("c_custkey", 1, 2),
    "u_wscnm": "CONCAT('S', CAST(c_nationkey AS STRING))",
}
CANDIDATE_ITEMS = {
    "i_acrid": "CONCAT('C', CAST(s_nationkey AS STRING))",
    "i_aodrid": "CAST(s_suppkey + 100000 AS STRING)",
    "i_aodrno": "CAST(s_suppkey AS STRING)",
    "i_assyulid": ITEMS["i_cat"],
    "i_assyumid": _code("s_suppkey", 1, 8),
    "i_assyusid": _code("s_suppkey", 1, 4),
    "i_atdfkid": f"NULLIF({ITEMS['i_place']}, '20')",
    "i_ayticmfr": _money("s_acctbal", 300, 0),
    "i_ayticmto": f"CASE WHEN s_suppkey % 10 = 0 THEN 'open' ELSE {_money('s_acctbal', 700, 0)} END",
    "i_aebdy": "CONCAT(CAST(1960 + s_suppkey % 60 AS STRING), '/', CAST(1 + s_suppkey % 12 AS STRING), '/1')",
    **{
        name: _code("s_suppkey", 1, size)
        for name, size in (
            ("i_abestagefr", 30),
            ("i_abestageto", 40),
            ("i_ayticmirfr", 9),
            ("i_ayticmirto", 10),
            ("i_aysbf", 3),
            ("i_ayhoc", 4),
            ("i_aavgothrfl", 5),
            ("i_asihon", 6),
            ("i_asl1", 7),
            ("i_akjorv1", 8),
            ("i_aempcnt", 99),
            ("i_aaveage", 20),
            ("i_amrate", 11),
            ("i_asijoid", 12),
            ("i_amusagefr", 13),
            ("i_amusageto", 14),
            ("i_amustsykcnt", 5),
        )
    },
}
SCHOOLS = {"wscnm": "CONCAT('S', CAST(s_nationkey AS STRING))", "hensachi": "CAST(30 + s_suppkey % 45 AS STRING)"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bind(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def users(spark: SparkSession, folder: str) -> DataFrame:
    return bind(table(spark, folder, "customer"), USERS)


def items(spark: SparkSession, folder: str) -> DataFrame:
    return bind(table(spark, folder, "supplier"), ITEMS)


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"
    )
    return lines.join(orders, "l_orderkey")


def scored_pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = order_lines(spark, folder).select("o_custkey", "l_suppkey").distinct()
    return pairs.selectExpr("o_custkey", "l_suppkey", f"{SCORE} AS score")


def facts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Event tables; a pair may have several events of a kind."""
    lines = order_lines(spark, folder)
    return {name: bind(lines.where(kept), columns) for name, (kept, columns) in FACTS.items()}


def action_log(spark: SparkSession, folder: str) -> DataFrame:
    return order_lines(spark, folder).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"), F.col("l_quantity").alias("rating")
    )

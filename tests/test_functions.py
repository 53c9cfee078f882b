"""Truth tables, expected values written by hand."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pairwright import functions as fn


def apply(spark, rows, types, column):
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate(types))
    df = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], f"n int, {schema}")
    found = df.select("n", column(*[F.col(f"c{i}") for i in range(len(types))]).alias("v")).orderBy("n").collect()
    return [r["v"] for r in found]


CODES = {
    "0": ("0", "0"), "1": ("1", "2"), "7": ("1", "2"), "8": ("2", "3"), "10": ("2", "3"), "11": ("11", "3"),
    "14": ("14", "3"), "15": ("3", "5"), "20": ("3", "5"), "21": ("21", "4"), "22": ("22", "4"), "23": ("23", "4"),
    "24": ("4", "4"), "25": ("4", "6"), "26": ("26", "6"), "28": ("28", "6"), "29": ("4", "6"), "30": ("4", "6"),
    "31": ("5", "7"), "39": ("5", "7"), "40": ("40", "8"), "41": ("6", "8"), "47": ("6", "8"), "48": ("0", "0"),
    "99": ("99", "0"), "100": ("0", "0"), "-1": ("0", "0"), "": ("0", "0"), None: ("0", "0"), " 05 ": ("1", "2"),
    "5.0": ("0", "0"), "x": ("0", "0"), "+5": ("1", "2"), "1_0": ("2", "3"), "_5": ("0", "0"),
    "99999999999": ("0", "0"),
}


def test_codes(spark):
    rows = [(c,) for c in CODES]
    assert apply(spark, rows, ["string"], fn.region_group) == [v[0] for v in CODES.values()]
    assert apply(spark, rows, ["string"], fn.area_code) == [v[1] for v in CODES.values()]


DATES = {
    "2017/1/5": "42740", "2017/01/05": "42740", "2017/01/05 10:00:00": "42740", "2017/1/5 1:2:3": "42740",
    "2017/01/05  23:59:59": "42740", "2017-01-05": "0", "2017/02/29": "0", "2016/02/29": "42429", "2017/13/05": "0",
    "2017/00/05": "0", "1899/12/31": "1", "1899/12/30": "0", "1899/12/29": "-1", "1900/1/1": "2", "": "0", None: "0",
    " 2017/1/5": "0", "2017/1/5 ": "0", "17/1/5": "0", "2017/001/05": "0", "2017/1/5 24:00:00": "0",
    "2017/1/5 10:00": "0", "0000/01/01": "0", "2017/1/ 5": "42740", "2017/1/5\n": "0",
}


def test_date_serial(spark):
    assert apply(spark, [(d,) for d in DATES], ["string"], fn.date_serial) == list(DATES.values())


@pytest.mark.parametrize("now", [datetime(2001, 2, 28), datetime(2004, 2, 29), datetime(2020, 6, 15, 12)])
def test_age_against_calendar_rule(spark, now):
    births = [
        datetime(2000, 2, 29), datetime(2000, 2, 28), datetime(2000, 3, 1), datetime(1980, 6, 15, 11, 59, 59),
        datetime(1980, 6, 15, 12, 0, 1), datetime(1980, 6, 14), datetime(1980, 6, 16), datetime(2004, 2, 29),
        datetime(2030, 1, 1), datetime(2024, 2, 29), datetime(2023, 6, 15, 12, 0, 0),
    ]

    def years(born):
        def anniversary(year):
            try:
                return born.replace(year=year)
            except ValueError:
                return born.replace(year=year, day=28)

        whole = now.year - born.year
        if born <= now:
            return whole - (anniversary(now.year) > now)
        return whole + (anniversary(now.year) < now)

    found = apply(
        spark,
        [(b.strftime("%Y/%m/%d %H:%M:%S"),) for b in births],
        ["string"],
        lambda c: fn.age_years(c, F.lit(now.strftime("%Y-%m-%d %H:%M:%S"))),
    )
    assert found == [years(b) for b in births]


def test_age_of_no_date_is_zero(spark):
    assert apply(spark, [("x",), (None,), ("",)], ["string"], lambda c: fn.age_years(c, F.lit("2020-01-01"))) == [0] * 3


MATCHES = {
    ("0", "0"): ("2", "0"), ("01", "1"): ("1", "1"), ("0.0", "0"): ("1", "0"), ("01", "01"): ("2", "2"),
    (None, "1"): ("0", "0"), (None, None): ("0", "0"), ("a", "a"): ("2", "2"), ("", ""): ("2", "2"),
}


def test_match_level(spark):
    rows = list(MATCHES)
    assert apply(spark, rows, ["string"] * 2, fn.match_level) == [v[0] for v in MATCHES.values()]
    strict = apply(spark, rows, ["string"] * 2, lambda a, b: fn.match_level(a, b, zero_is_missing=True))
    assert strict == [v[1] for v in MATCHES.values()]


GAPS = {
    "-1000001": "1", "-1000000": "1", "-999999": "2", "-500000": "2", "-499999": "3", "0": "3", "1": "4",
    "500000": "4", "500001": "5", "1000000": "5", "1000001": "6", "nan": "0", "inf": "6", "-inf": "1", "": "0",
    None: "0", "5d": "0", "5f": "0", "0x1p3": "0", "1e3": "4", "1_0": "4", "1__0": "0", " 7 ": "4", ".5": "4",
    "5.": "4", "1e": "0", "Infinity": "6", "x": "0",
}


def test_gap_band(spark):
    assert apply(spark, [(g, "0") for g in GAPS], ["string"] * 2, fn.gap_band) == list(GAPS.values())
    assert apply(spark, [("inf", "inf")], ["string"] * 2, fn.gap_band) == ["0"]
    assert apply(spark, [(None, "1"), ("1", None)], ["string"] * 2, fn.gap_band) == ["0", "0"]


def test_gap_band_on_numbers(spark):
    rows = [(float("nan"), 0.0), (1.0, 0.0), (None, 0.0)]
    assert apply(spark, rows, ["double"] * 2, lambda a, b: fn.gap_band(a, b, parse=False)) == ["0", "4", "0"]


def test_present_fill_ratio(spark):
    assert apply(spark, [("a", "b"), (None, "b"), ("a", None)], ["string"] * 2, fn.present) == ["1", "0", "0"]
    assert apply(spark, [(None,), ("",), ("a",)], ["string"], fn.or_zero) == ["0", "", "a"]
    assert apply(spark, [(1, 0), (1, 4)], ["bigint"] * 2, fn.ratio) == [0.0, 0.25]


def test_functions_run_without_ansi_mode(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert apply(spark, [("5.0",), ("x",), ("5",)], ["string"], fn.area_code) == ["0", "0", "2"]
        assert apply(spark, [("2017/02/29",), ("2017/1/5",)], ["string"], fn.date_serial) == ["0", "42740"]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_functions_run_on_a_stream(spark, tmp_path):
    spark.createDataFrame([("5", "2017/1/5")], "code string, day string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("code string, day string").parquet(str(tmp_path / "in"))
    query = (
        stream.select(fn.area_code(F.col("code")).alias("area"), fn.date_serial(F.col("day")).alias("serial"))
        .writeStream.format("memory").queryName("coded").option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(60)
    assert [tuple(r) for r in spark.table("coded").collect()] == [("2", "42740")]

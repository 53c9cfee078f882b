import csv
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairwright.session import materialize, scratch_folder, temporary_tables
from pairwright.sources.export import export_by_key
from pairwright.sources.tables import (
    dated,
    publish,
    read_id_list,
    read_strings,
    read_table,
    read_typed,
    write_csv,
    write_table,
)
from tests.conftest import values


def test_read_strings_infers_nothing(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n01,"x, y"\n,2\n')
    df = read_strings(spark, str(tmp_path / "t.csv"))
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert values(df) == [("01", "x, y"), (None, "2")]
    assert read_strings(spark, str(tmp_path / "t.csv"), ["p", "q"]).columns == ["p", "q"]


def test_read_id_list_takes_the_first_column(spark, tmp_path):
    (tmp_path / "ids.csv").write_text("7,x\n08,y\n")
    assert values(read_id_list(spark, str(tmp_path / "ids.csv"), "user_id")) == [("08",), ("7",)]


def test_read_typed_by_position(spark, tmp_path):
    (tmp_path / "t.csv").write_text("wjoid,score\nw1,0.5\nw2,bad\n,\n")
    schema = T.StructType([T.StructField("predicted_wjoid", T.StringType()), T.StructField("s", T.DoubleType())])
    assert values(read_typed(spark, str(tmp_path / "t.csv"), schema)) == [("w1", 0.5), ("w2", None), (None, None)]


def test_csv_round_trip_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    write_csv(spark.range(5), path)
    df = spark.createDataFrame([("a,b", None), ('q"q', "2")], "x string, y string")
    write_csv(df, path)
    assert values(read_strings(spark, path)) == values(df)


def test_parquet_table(spark, tmp_path):
    write_table(spark.range(3), str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t")).count() == 3


def test_publish_writes_equal_copies(spark, tmp_path):
    path = str(tmp_path / "log.csv")
    publish(spark.range(50).select("id", F.rand().alias("r")), path, "20200131")
    assert dated(path, "20200131") == str(tmp_path / "log_20200131.csv")
    assert values(read_strings(spark, path)) == values(read_strings(spark, str(tmp_path / "log_20200131.csv")))
    assert dated("model", "20200131") == "model_20200131"


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_export_by_key(spark, tmp_path, coalesce):
    rows = [("hot", str(n / 1000), n) for n in range(900)] + [("b", "9.5E-4", 1), ("b", "0.9", 2), (None, "1", 3), ("", "2", 4)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        export_by_key(spark.createDataFrame(rows, "k string, score string, n int"), str(tmp_path), "k", "score", "20200131")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    folder = Path(tmp_path) / "run_date=20200131"
    found, files = {}, {}
    for key in folder.glob("k=*"):
        parts = sorted(key.glob("part-*.csv"))
        files[key.name[2:]] = len(parts)
        found[key.name[2:]] = [float(r["score"]) for p in parts for r in csv.DictReader(p.open())]
    assert set(found) == {"hot", "b", "__HIVE_DEFAULT_PARTITION__"}
    assert all(scores == sorted(scores, reverse=True) for scores in found.values())
    assert {k: len(v) for k, v in found.items()} == {"hot": 900, "b": 2, "__HIVE_DEFAULT_PARTITION__": 2}
    if coalesce == "false":
        assert files["hot"] > 1


def test_materialize_uses_the_named_folder(spark):
    stored = materialize(spark.range(4), "four")
    assert stored.count() == 4
    assert all(f.removeprefix("file://").removeprefix("file:").startswith(scratch_folder(spark).removeprefix("file:")) for f in stored.inputFiles())


def test_temporary_tables_are_removed(spark):
    with temporary_tables(spark):
        stored = materialize(spark.range(4), "four")
        path = Path(stored.inputFiles()[0].removeprefix("file://").removeprefix("file:")).parent
        assert path.is_dir()
    assert not path.exists()

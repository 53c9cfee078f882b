"""Scratch folders without a scheme on masters whose executors are elsewhere: taken if tasks share them."""

import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from pairwright.ml.als import _block_scorer
from pairwright.ml.certificate import _counter
from pairwright.session import _shared, materialize, scratch_folder
from pairwright.workload.queries import QUERIES

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture
def elsewhere(spark, monkeypatch):
    """A session that says its executors are on other machines, and a folder that its tasks do share."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    _shared.clear()
    yield spark, lambda folder: monkeypatch.setattr(type(spark.conf), "get", given(type(spark.conf).get, folder))
    _shared.clear()


def given(get, folder):
    """``spark.conf.get`` with another checkpoint folder: it is static, so a running session cannot set it."""
    return lambda conf, name, *default: folder if name == "spark.checkpoint.dir" else get(conf, name, *default)


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_a_folder_that_tasks_share_is_taken(elsewhere, tmp_path, scheme):
    spark, name = elsewhere
    name(f"{scheme}{tmp_path}/")
    assert scratch_folder(spark) == f"{scheme}{tmp_path}"
    assert not list(tmp_path.glob("probe-*"))
    stored = materialize(spark.range(5), "numbers")
    assert stored.count() == 5
    assert all(str(tmp_path) in file for file in stored.inputFiles())


def test_a_folder_that_tasks_cannot_write_is_refused(elsewhere, tmp_path):
    spark, name = elsewhere
    (tmp_path / "file").write_text("no folder")
    name(f"file://{tmp_path}/file/below")
    with pytest.raises(ValueError, match="share"):
        scratch_folder(spark)


def test_rows_that_are_not_read_back_refuse_the_folder(elsewhere, tmp_path, monkeypatch):
    """Tasks that write to disks of their own leave the driver's folder without their rows."""
    spark, name = elsewhere
    name(str(tmp_path))
    whole = type(spark).range
    monkeypatch.setattr(type(spark), "range", lambda self, *args: whole(self, *args).where("id > 0"))
    with pytest.raises(ValueError, match="share"):
        scratch_folder(spark)


def test_stored_tables_serve_queries_elsewhere(elsewhere, tmp_path):
    spark, name = elsewhere
    name(f"file://{tmp_path}")
    rows = QUERIES["row_ids"](spark, SMOKE)
    assert rows.count() == spark.read.parquet(f"{SMOKE}/events.parquet").count()


def test_workers_need_not_have_the_package():
    """What goes to Python workers is pickled by value: a worker that cannot import the package can load it."""
    code = "import pickle, sys; f = pickle.loads(sys.stdin.buffer.read()); print(f.__name__, 'pairwright' in sys.modules)"
    for sent in (_counter(), _block_scorer("user", "item", "score", 1)):
        done = subprocess.run(
            [sys.executable, "-c", code], input=cloudpickle.dumps(sent), capture_output=True, timeout=60, cwd="/",
            env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
        )
        assert done.stdout.decode().split() == [sent.__name__, "False"], done.stderr.decode()[-500:]

"""The scratch folder on a Spark without site defaults, and on masters whose executors are elsewhere."""

import os
import subprocess
import sys
import time
from pathlib import Path
from types import SimpleNamespace

import pytest

from pairwright.session import scratch_folder

SCRIPT = """
import sys
from pyspark.sql import SparkSession
from pairwright.session import materialize, scratch_path
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
frame = materialize(spark.range(5), "numbers")
assert frame.count() == 5
print("FOLDER", scratch_path(spark, "x").rsplit("/", 1)[0])
print("TABLE", frame.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0])
spark.stop()
"""


def test_tables_without_site_defaults_go_with_the_session(tmp_path):
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    found = dict(line.split(" ", 1) for line in done.stdout.splitlines() if line.startswith(("FOLDER", "TABLE")))
    assert found["TABLE"].startswith(found["FOLDER"])
    for _ in range(100):  # the session's JVM ends after the process
        if not Path(found["TABLE"]).exists():
            break
        time.sleep(0.2)
    assert not Path(found["TABLE"]).exists()


def fake(master, folder):
    context = SimpleNamespace(master=master, applicationId="app")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: folder), sparkContext=context)


@pytest.mark.parametrize("folder", ["/tmp/x", "file:///tmp/x", None])
def test_folders_of_one_machine_are_refused_on_a_cluster(folder):
    with pytest.raises(ValueError, match="share"):
        scratch_folder(fake("yarn", folder))


def test_shared_folders_are_taken(tmp_path):
    assert scratch_folder(fake("yarn", "hdfs://name/scratch/")) == "hdfs://name/scratch"
    assert scratch_folder(fake("local[2]", str(tmp_path))) == str(tmp_path)

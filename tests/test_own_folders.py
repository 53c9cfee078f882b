"""Executors with temporary folders of their own: what they write must not be looked for on the driver."""

import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pyspark
import pytest

from pairwright.session import _shared, scratch_folder

SMOKE = "/root/testdata/sf0.001"
REPO = str(Path(__file__).resolve().parents[1])
# The driver and each executor see another folder under this name.
OWN = "/proc/self/cwd/own"

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from pairwright.workload.queries import QUERIES
conf = {"spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "700m", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.host": "127.0.0.1", "spark.sql.warehouse.dir": sys.argv[2],
        "spark.sql.shuffle.partitions": "2"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
if sys.argv[3]:
    spark.sparkContext.setCheckpointDir(sys.argv[3])
for name in ("row_ids", "export_by_key_files"):
    print("ROWS", name, QUERIES[name](spark, sys.argv[4]).count())
spark.stop()
"""


@pytest.mark.parametrize("given", [False, True])
def test_stored_rows_survive_executors_with_folders_of_their_own(spark, tmp_path, given):
    """Without a folder in the settings: the warehouse, or what was given to the context, not the driver's temporary folder."""
    home = tmp_path / "home"
    home.mkdir()
    for part in Path(pyspark.__file__).parent.iterdir():
        if part.name not in ("work", "conf"):
            (home / part.name).symlink_to(part)
    (tmp_path / "driver/own").mkdir(parents=True)
    env = {
        **os.environ, "SPARK_HOME": str(home), "SPARK_CONF_DIR": str(tmp_path), "SPARK_LOCAL_IP": "127.0.0.1", "TMPDIR": OWN,
        "SPARK_LOCAL_DIRS": str(tmp_path / "local"), "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable,
    }
    shared = f"file://{tmp_path}/shared" if given else ""
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, REPO, f"{tmp_path}/warehouse", shared, SMOKE],
        env=env, cwd=tmp_path / "driver", capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    rows = dict(line.split()[1:] for line in done.stdout.splitlines() if line.startswith("ROWS"))
    tables = {"row_ids": "events", "export_by_key_files": "part"}
    assert rows == {name: str(spark.read.parquet(f"{SMOKE}/{table}.parquet").count()) for name, table in tables.items()}


def fake(master, given, warehouse):
    """A session without a folder in its settings; no tasks can be run on it, so a folder of one machine is refused."""
    context = SimpleNamespace(master=master, applicationId="app", getCheckpointDir=lambda: given)
    get = lambda name, default: warehouse if name == "spark.sql.warehouse.dir" else default
    return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=context)


def test_where_tables_go_without_a_folder_in_the_settings():
    given, warehouse = "hdfs://name/given", "hdfs://name/warehouse"
    for master in ("local-cluster[2,1,1024]", "spark://name:7077"):
        assert scratch_folder(fake(master, given, warehouse)) == given
        assert scratch_folder(fake(master, None, warehouse)) == warehouse
        _shared.clear()
        with pytest.raises(ValueError, match="share"):
            scratch_folder(fake(master, None, "file:///tmp/warehouse"))
    for master in ("local", "local[2]", "local[*, 3]"):
        assert scratch_folder(fake(master, given, warehouse)) == given
        assert scratch_folder(fake(master, None, warehouse)).startswith("/")  # a temporary folder

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import urlparse
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",  # hot keys are cut even where that costs a shuffle
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # The JVM leaves larger generated methods uncompiled; wide feature projections are split into small ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str, **conf: str) -> SparkSession:
    """Session with the settings the jobs are written for; ``conf`` uses '__' for '.' in names.

    Shuffle partition count, memory and the shared ``spark.checkpoint.dir`` are the cluster's to set.
    """
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_own_folders: dict[str, str] = {}  # application id to the temporary folder of a local session


_shared: set[tuple[str, str]] = set()  # application id and folder that tasks of that application have been seen to share


def _check_shared(spark: SparkSession, folder: str) -> None:
    """Refuse a folder unless what the tasks write there is read back whole.

    Whether a path of one machine's kind is a mount that all machines have cannot be told from its name, so a small table
    of more tasks than run at a time is written and read once a session.
    """
    place = (spark.sparkContext.applicationId, folder)
    if place in _shared:
        return
    path = f"{folder}/probe-{uuid.uuid4().hex}"
    refused = ValueError(f"spark.checkpoint.dir is {folder!r}: name a folder that all executors share")
    try:
        rows = 2 * spark.sparkContext.defaultParallelism
        spark.range(0, rows, 1, rows).write.parquet(path)
        found = spark.read.schema("id long").parquet(path).count()
        remove(spark, path)
    except Exception as error:  # whatever keeps tasks from a folder, they do not share it
        raise refused from error
    if found != rows:
        raise refused
    _shared.add(place)


def _one_process(master: str) -> bool:
    """Whether tasks run in the driver's own process. The executors of ``local-cluster`` are processes with folders of their own."""
    return master == "local" or master.startswith("local[")


def _named_folder(spark: SparkSession) -> str | None:
    """The checkpoint folder of the settings, or the one that was given to the context in code, which settings do not show."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and hasattr(spark.sparkContext, "getCheckpointDir"):  # not in older releases
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def scratch_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``. Local sessions without one get a temporary folder.

    Executors outside the driver's process need a folder that all of them share. A path without a scheme or on ``file:``
    may be one: it is taken if a table that tasks write there is read back whole, and refused otherwise. Without a
    checkpoint folder the same holds for the warehouse folder.
    """
    folder, one_process = _named_folder(spark), _one_process(spark.sparkContext.master)
    if not folder and not one_process:
        folder = spark.conf.get("spark.sql.warehouse.dir", None)
        if not folder:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if folder:
        folder = folder.rstrip("/")
        if urlparse(folder).scheme in ("", "file") and not one_process:
            _check_shared(spark, folder)
        return folder
    name = spark.sparkContext.applicationId
    if name not in _own_folders:
        _own_folders[name] = tempfile.mkdtemp(prefix="pairwright-")
    return _own_folders[name]


_temporary: ContextVar[list[str] | None] = ContextVar("temporary", default=None)


def _hadoop(spark: SparkSession, path: str) -> tuple[object, object]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


_session_folders: dict[tuple[str, str], str] = {}  # application id and scratch folder to the folder of its tables


def _session_folder(spark: SparkSession) -> str:
    """A folder of this application in the scratch folder, which is removed when the application's JVM ends."""
    place = (spark.sparkContext.applicationId, scratch_folder(spark))
    if place not in _session_folders:
        path = f"{place[1]}/tables-{uuid.uuid4().hex}"
        files, folder = _hadoop(spark, path)
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _session_folders[place] = path
    return _session_folders[place]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the scratch folder. What is written there goes with the block or with the session."""
    path = f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (paths := _temporary.get()) is not None:
        paths.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table written to the scratch folder."""
    files, folder = _hadoop(spark, path)
    files.delete(folder, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the scratch folder and read it back: cuts lineage, survives executor loss.

    The table is removed when the enclosing :func:`temporary_tables` block ends, otherwise when the session ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that :func:`materialize` writes in this block when the block ends."""
    token = _temporary.set([])
    try:
        yield
    finally:
        paths = _temporary.get() or []
        _temporary.reset(token)
        for path in paths:
            remove(spark, path)

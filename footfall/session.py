"""Session settings the operators rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # Hour stamps and day boundaries follow the session zone, so it is pinned.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A day is re-written as a whole; other days stay untouched.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "footfall", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings above; ``conf`` entries win."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


_own_root: dict[str, str] = {}


def _shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; on a local master without it one temporary folder per session.

    The temporary folder goes when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_root:
        _own_root[app] = tempfile.mkdtemp(prefix="footfall-")
        atexit.register(shutil.rmtree, _own_root[app], ignore_errors=True)
    return _own_root[app]


def cut_lineage(df):
    """Reliable checkpoint: the rows survive the loss of any executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_shared_root(spark))
    return df.checkpoint()


def stored(df, name: str):
    """Write ``df`` to the shared folder and read it back: nothing before it is ever recomputed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the shared folder."""
    return f"{_shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

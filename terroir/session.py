"""Session settings and shared scratch space."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are designed for. AQE splits the hot partitions of
# sort-merge joins, so joins on a key that holds a third of the rows still spread.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "terroir", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a fresh temporary folder that lives as
    long as the process. A cluster raises: its executors share no local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("terroir.local.scratch", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="terroir-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("terroir.local.scratch", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_WRITTEN: list[str] = []


def materialize(df: DataFrame, name: str, into: str | None = None, by: str | None = None) -> DataFrame:
    """Cut the lineage by writing a table to the shared folder and reading it back.

    ``into`` is a new path to write to, in a folder from ``scratch_path``; ``by`` is a column whose values get a folder each.
    The table stays until ``release``: whatever is read from it is read when an action runs.
    """
    path = into or scratch_path(df.sparkSession, name)
    _WRITTEN.append(path)
    df.write.parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the tables that ``materialize`` has written so far in this process; call it when a run's results are stored."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    count = 0
    while _WRITTEN:
        path = hadoop.Path(_WRITTEN.pop())
        count += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set those of the recommended settings that may change in a running session."""
    for key, value in RECOMMENDED_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)

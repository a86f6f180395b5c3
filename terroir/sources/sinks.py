"""File sinks. Nothing is ever overwritten while it is being read."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import merge_keyed
from ..operators.similarity import similar_lists


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = ("level", "year")) -> None:
    """Full rewrite partitioned by columns; rows are grouped first so each partition gets few files.

    Partition values may be badly skewed (most rows are cities): the rebalance is one that adaptive execution splits
    where a partition is too large for one task and joins where many are small.
    """
    lacking = [c for c in partition_by if c not in df.columns]
    if lacking:
        raise ValueError(f"missing partition columns: {lacking}")
    df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def _current(spark: SparkSession, root: str) -> str | None:
    """Newest complete version of a versioned table."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = hadoop.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return None
    done = [
        s.getPath().getName() for s in fs.listStatus(base)
        if s.isDirectory() and fs.exists(hadoop.Path(s.getPath(), "_SUCCESS"))
    ]
    return f"{root}/{max(done)}" if done else None


def read_versioned(spark: SparkSession, root: str) -> DataFrame | None:
    path = _current(spark, root)
    return None if path is None else spark.read.parquet(path)


class ConcurrentWrite(RuntimeError):
    """Another writer has claimed the next version."""


def claim_version(spark: SparkSession, root: str, after: str | None, take_over: bool = False) -> str:
    """The folder of the version after ``after``, for this writer alone.

    A claim is a file that is created only if it is not there. Whoever finds it taken must not write: its changes rest
    on a version that is about to be replaced. ``take_over`` is for the claim of a writer that is known to be dead.
    """
    number = 0 if after is None else int(after.rsplit("/v", 1)[1].split("-")[0]) + 1
    claim = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_claim-{number:010d}")
    fs = claim.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.createNewFile(claim) and not take_over:
        raise ConcurrentWrite(f"version {number} of {root} is being written")
    return f"{root}/v{number:010d}-{uuid.uuid4().hex[:8]}"


def upsert_keyed(new: DataFrame, root: str, keys: Sequence[str], keep_versions: int = 3, take_over: bool = False) -> DataFrame:
    """Merge rows into a versioned table by key and return the table after the merge.

    The next version is claimed before the current one is read, so of two writers one raises ``ConcurrentWrite`` and
    can try again. Readers switch when the new version is complete; a lost driver leaves an incomplete folder that no
    reader looks at. The newest ``keep_versions`` stay for readers that still use them, older ones are deleted.
    """
    spark = new.sparkSession
    current = _current(spark, root)
    path = claim_version(spark, root, current, take_over)
    old = None if current is None else spark.read.parquet(current)
    (new if old is None else merge_keyed(old, new, keys)).write.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    versions = sorted(s.getPath().getName() for s in fs.listStatus(hadoop.Path(root)) if s.isDirectory())
    for name in versions[: max(0, len(versions) - keep_versions)]:
        fs.delete(hadoop.Path(root, name), True)
    return spark.read.parquet(path)


def write_similar_index(ranked: DataFrame, listings: DataFrame, path: str) -> None:
    """One JSON line per base: its ordered similar ids, the listing count and the time of the run."""
    total = listings.agg(F.count(F.lit(1))).scalar()
    index = similar_lists(ranked).withColumn("listingCount", total)
    index.withColumn("generatedAt", F.current_timestamp()).write.mode("overwrite").json(path)


def read_similar_index(spark: SparkSession, path: str) -> DataFrame:
    """(base_id, rank, similar_id) rows of a written index."""
    schema = "base_id string, similar array<string>, listingCount bigint, generatedAt timestamp"
    index = spark.read.schema(schema).json(path)
    return index.select("base_id", F.posexplode("similar").alias("pos", "similar_id")).select(
        "base_id", (F.col("pos") + 1).alias("rank"), "similar_id"
    )


def write_snapshot(listings: DataFrame, path: str) -> None:
    """The full listing table as JSON lines."""
    listings.write.mode("overwrite").json(path)

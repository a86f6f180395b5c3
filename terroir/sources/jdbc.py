"""Facts in a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str) -> None:
    """Append, or overwrite by truncating (which keeps the table's definition and grants)."""
    writer = df.write.option("truncate", mode == "overwrite").option("batchsize", 10_000)
    writer.jdbc(url=url, table=table, mode=mode, properties=dict(properties))


def decimals_to_double(df: DataFrame) -> DataFrame:
    decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in decimals}) if decimals else df


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
) -> DataFrame:
    """A table or parenthesised query, decimals as doubles.

    Filters and aggregates on the result are pushed to the database. With a split
    column the read runs in parallel ranges instead of through one connection.
    """
    reader = spark.read.format("jdbc").options(**properties).option("url", url).option("dbtable", table)
    reader = reader.option("pushDownAggregate", True).option("fetchsize", 10_000)
    if split_column is not None and bounds is not None:
        reader = reader.options(
            partitionColumn=split_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions)
        )
    return decimals_to_double(reader.load())

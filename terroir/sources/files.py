"""File scans with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.codes import display_code
from ..operators.reviews import pick_columns

# Candidate delimiters in order of preference, and the sample size in characters.
DELIMITERS = (",", ";", "\t", "|")
SAMPLE_CHARS = 20_000


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """Most frequent candidate among the first characters of the file; a comma when none occurs.

    Of a folder the first file is looked at. Every line takes a character at least, its end, so the sample never
    needs more lines than characters.
    """
    first = min(spark.read.text(path).inputFiles())
    head = spark.read.text(first).select(F.substring("value", 1, SAMPLE_CHARS).alias("value")).limit(SAMPLE_CHARS)
    lines = [r.value for r in head.collect()]
    sample = "\n".join(lines)[:SAMPLE_CHARS]
    best = max(DELIMITERS, key=sample.count)
    return best if sample.count(best) else ","


def csv_header(spark: SparkSession, path: str, delimiter: str) -> list[str]:
    return spark.read.option("header", True).option("sep", delimiter).csv(path).columns


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, delimiter: str | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header. Without a schema every column of the header is text; only used columns are parsed.

    Files of a folder must have the header of the first; one that orders or names columns otherwise stops the read.
    ``multi_line`` reads line breaks inside quotes, at the price of one task per file.
    """
    sep = delimiter or sniff_delimiter(spark, path)
    names = csv_header(spark, path, sep)
    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = (
        spark.read.schema(texts).option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
        .option("encoding", "UTF-8").option("enforceSchema", False).option("multiLine", multi_line).csv(path)
    )
    if schema is None:
        return df
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ])


def read_json_listings(
    spark: SparkSession, path: str, schema: T.StructType = schemas.LISTING, lines: bool = False
) -> DataFrame:
    """Listings from JSON array documents, or from JSON lines (splittable, for large tables)."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_facts(spark: SparkSession, path: str, schema: T.StructType, level: str | None = None) -> DataFrame:
    """Partitioned fact table; a level prunes its partitions."""
    df = spark.read.schema(schema).parquet(path)
    return df if level is None else df.where(F.col("level") == level)


def read_codes(spark: SparkSession, path: str, schema: T.StructType, level: str, code: str = "insee_code") -> DataFrame:
    """Distinct codes of a level; only the code column of its partitions is read."""
    return read_facts(spark, path, schema, level).select(code).where(F.col(code).isNotNull()).distinct()


def read_reviews(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Review CSV files, gzipped or not, with ``review_text`` and the raw date as ``review_date``.

    A file with quoted line breaks is read by one task whatever its size. Many files spread by themselves; for few
    large ones ``partitions`` deals the rows out right after the scan. Convert them to Parquet once to read them often.
    """
    df = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("quote", '"')
        .option("encoding", "UTF-8").csv(path)
    )
    text, date = pick_columns(df.columns)
    chosen = df.select(
        F.col(text).alias("review_text"),
        (F.col(date) if date else F.lit(None).cast("string")).alias("review_date"),
    )
    return chosen.repartition(partitions) if partitions else chosen


# Properties that may hold a territory code.
CODE_PROPERTIES = ("code_insee", "insee", "cog")


def code_property(properties: Sequence[str]) -> str | None:
    """The property that holds the code: a known name, else one that looks like it, else the first."""
    for name in CODE_PROPERTIES:
        if name in properties:
            return name
    named = [p for p in properties if "insee" in p.lower() or "code" in p.lower()]
    return (named or list(properties) or [None])[0]


def read_boundaries(
    spark: SparkSession, path: str, properties: T.StructType, lines: bool = False
) -> DataFrame:
    """Features (type, properties, geometry) of GeoJSON collections, or of one feature per line."""
    collection = schemas.boundary_schema(properties)
    if lines:
        feature = collection["features"].dataType.elementType
        return spark.read.schema(feature).json(path)
    docs = spark.read.schema(collection).option("multiLine", True).json(path)
    return docs.select(F.explode("features").alias("f")).select("f.*")


def boundaries_of(features: DataFrame, codes: DataFrame, level: str, key: str | None = None) -> DataFrame:
    """Features whose code, as written or normalised, is among the codes."""
    names = features.schema["properties"].dataType.names
    raw = F.trim(F.col(f"properties.{key or code_property(names)}"))
    wanted = codes.select(display_code(F.col("insee_code"), level).alias("_code")).distinct()
    return features.withColumn("_code", display_code(raw, level)).join(wanted, "_code", "left_semi").drop("_code")


def round_coordinates(coordinates: Column, digits: int = 4) -> Column:
    """Every coordinate of a multi-polygon rounded."""
    point = lambda xy: F.transform(xy, lambda v: F.round(v, digits))
    ring = lambda points: F.transform(points, point)
    polygon = lambda rings: F.transform(rings, ring)
    return F.transform(coordinates, polygon)


def compact_boundaries(features: DataFrame, digits: int = 4) -> DataFrame:
    geometry = F.struct(
        F.col("geometry.type").alias("type"), round_coordinates(F.col("geometry.coordinates"), digits).alias("coordinates")
    )
    return features.withColumn("geometry", geometry)

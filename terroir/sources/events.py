"""Event topics: JSON values keyed by event name, on Kafka or in files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions.numbers import parse_number_fr

_CORRUPT = "_corrupt"


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", max_per_trigger: int | None = None
) -> DataFrame:
    """Kafka topic as a stream with ``value`` as text. Needs the Kafka connector on the classpath."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", starting)
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "partition", "offset"
    )


def read_topic_files(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: str | None = None) -> DataFrame:
    """The same topic as text files with one JSON value per line; a batch is bounded by files or by bytes (like "10g")."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def _loose(kind: T.DataType) -> T.DataType:
    """The same structure with every value as text, so that no value is of a wrong type."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in kind])
    return T.StringType()


def _strict(value: Column, kind: T.DataType) -> Column:
    """Texts as the declared types; what cannot be read as its type is null."""
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[_strict(value[f.name], f.dataType).alias(f.name) for f in kind]))
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, T.DoubleType):
        return F.coalesce(value.try_cast("double"), F.when(~value.rlike(r"^\s*[\[{]"), parse_number_fr(value)))
    if isinstance(kind, T.ArrayType):
        return F.from_json(value, kind.simpleString())
    return value.try_cast(kind)


def parse_events(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Messages with the parsed ``body``; the text itself stays in ``_corrupt`` when it is not a JSON object.

    Fields are read as text and converted one by one, so a field of an odd type is null and the rest of its message stays.
    """
    loose = F.from_json("value", _loose(schema))
    whole = F.startswith(F.trim(F.get_json_object("value", "$")), F.lit("{"))
    parsed = messages.withColumn("_body", loose)
    return parsed.withColumn("body", _strict(F.col("_body"), schema)).drop("_body").withColumn(
        _CORRUPT, F.when(~F.coalesce(whole, F.lit(False)), F.col("value")))


def of_type(parsed: DataFrame, *names: str) -> DataFrame:
    """Valid events with one of the names; all others are ignored."""
    return parsed.where(F.col(_CORRUPT).isNull() & F.col("body.event").isin(*names))


def bad_records(parsed: DataFrame) -> DataFrame:
    """Messages that are not JSON, for the quarantine."""
    return parsed.where(F.col(_CORRUPT).isNotNull()).select("value", F.lit("invalid JSON").alias("reason"))


def _now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def raw_events(raw: DataFrame, source: str = "scrape") -> DataFrame:
    """Raw listings as (key, value) messages."""
    payload = F.struct(*[F.col(c) for c in raw.columns])
    return _messages(raw, K.EVENT_RAW, F.lit(source).alias("source"), payload.alias("payload"))


def created_events(listings: DataFrame, service: str) -> DataFrame:
    listing = F.struct(*[F.col(c) for c in listings.columns])
    return _messages(listings, K.EVENT_CREATED, F.lit(service).alias("source"), listing.alias("listing"))


def bootstrapped_event(listings: DataFrame, service: str) -> DataFrame:
    counted = listings.agg(F.count(F.lit(1)).alias("count"))
    return _messages(counted, K.EVENT_BOOTSTRAPPED, F.lit(service).alias("source"), F.col("count"))


def crawl_messages(links: DataFrame) -> DataFrame:
    return _messages(
        links, K.EVENT_CRAWL, F.col("url").alias("searchUrl"), F.col("listing_url").alias("listingUrl")
    )


def _messages(df: DataFrame, event: str, *fields: Column) -> DataFrame:
    value = F.to_json(F.struct(F.lit(event).alias("event"), _now().alias("timestamp"), *fields))
    return df.select(F.lit(event).alias("key"), value.alias("value"))


def ingestion_event(
    prices: DataFrame, population: DataFrame, project: str, sample_cities: int, paths: tuple[str, str]
) -> DataFrame:
    """The completed-ingestion message with row counts and scale label."""
    rows = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    one = prices.sparkSession.range(1)
    value = F.to_json(F.struct(
        F.lit(K.EVENT_INGESTION).alias("event"), F.lit(project).alias("project"), _now().alias("timestamp_utc"),
        F.lit(sample_cities).cast("bigint").alias("dvf_sample_cities"),
        F.lit("national" if sample_cities == 0 else "sample").alias("scale"),
        F.struct(F.lit(paths[0]).alias("dvf_parquet"), F.lit(paths[1]).alias("insee_parquet")).alias("paths"),
        F.struct(rows(prices).alias("dvf_rows"), rows(population).alias("insee_rows")).alias("metrics"),
    ))
    return one.select(F.lit(K.EVENT_INGESTION).alias("key"), value.alias("value"))


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish (key, value) messages of a batch to Kafka."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_topic_files(messages: DataFrame, path: str) -> None:
    messages.select("value").write.mode("append").text(path)

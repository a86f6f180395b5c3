"""Streaming jobs over the event topics.

Every job can be restarted: its progress is in the checkpoint, and every
``foreachBatch`` write goes to a folder named by the batch, so a batch that runs
again replaces its own output. Tables built from batches are read with
``newest_per_key`` over the batch number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions import constants as K
from ..functions.listing import city_from_address
from ..operators.keyed import newest_per_key, upsert_listings
from ..operators.listings import complete_raw, normalize_listings
from ..operators.pages import discover_links, page_listings
from ..operators.reviews import min_text, with_score
from ..operators.similarity import topk_similar
from ..operators.territory import rollup_hierarchy
from ..sources import events as E


@dataclass(frozen=True)
class JobPaths:
    """Where a job keeps its tables and its checkpoint: one root in shared storage."""

    root: str

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"


def run_bounded(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    paths: JobPaths,
    mode: str = "append",
    timeout: int | None = None,
) -> StreamingQuery:
    """Process what is available now, in batches bounded by the source options, then stop.

    With a ``timeout`` in seconds the query is stopped when it is still running then.
    """
    writer = stream.writeStream.foreachBatch(each).outputMode(mode)
    query = writer.option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start()
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
    return query


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], paths: JobPaths) -> StreamingQuery:
    """Process batches until the source offers nothing more, its own bounds included, then stop.

    For sources that bound batches themselves (messages per batch and per run) and so cannot be planned at once
    as ``availableNow`` does.
    """
    return run_consumers([(stream, each, paths)])[0]


def run_consumers(consumers: Sequence[tuple[DataFrame, Callable[[DataFrame, int], None], JobPaths]]) -> list[StreamingQuery]:
    """``run_available`` of several streams side by side: a batch has a fixed cost, which the streams pay together."""
    queries: list[StreamingQuery] = []
    try:
        for stream, each, paths in consumers:
            writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", paths.checkpoint)
            queries.append(writer.trigger(processingTime="0 seconds").start())
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    return queries


def write_batch(df: DataFrame, table: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")


def read_batches(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(table)


# --- raw topic -> listings, created events, quarantine ---------------------

_QUARANTINE = T.StructType([T.StructField("value", T.StringType()), T.StructField("reason", T.StringType())])
_MESSAGE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
_CHANGE = T.StructType([*schemas.LISTING.fields, T.StructField("event_time", T.StringType())])


def preprocess(messages: DataFrame, paths: JobPaths, service: str = "terroir", timeout: int | None = None) -> StreamingQuery:
    """Raw listing events to a log of normalised listings, created events and a quarantine of the messages as they came."""

    def each(batch: DataFrame, batch_id: int) -> None:
        parsed = E.parse_events(batch, schemas.RAW_EVENT)
        raw = E.of_type(parsed, K.EVENT_RAW).select("body.payload.*", F.col("body.timestamp").alias("event_time"), F.col("value").alias("message"))
        done = normalize_listings(raw, keep=("event_time", "message")).persist()
        valid = done.where(F.col("reject_reason").isNull()).drop("reject_reason", "message")
        rejected = done.where(F.col("reject_reason").isNotNull())
        write_batch(valid, paths.table("listings"), batch_id)
        write_batch(E.created_events(valid.drop("event_time"), service), paths.table("created"), batch_id)
        quarantine = E.bad_records(parsed).unionByName(rejected.select(F.col("message").alias("value"), F.col("reject_reason").alias("reason")))
        write_batch(quarantine, paths.table("quarantine"), batch_id)
        done.unpersist()

    return run_bounded(messages, each, paths, timeout=timeout)


def current_listings(spark: SparkSession, paths: JobPaths) -> DataFrame:
    """Last write per listing over all batches."""
    changes = read_batches(spark, paths.table("listings"), _CHANGE)
    return upsert_listings(changes, ["batch", "event_time"]).select(*schemas.LISTING.names)


def quarantined(spark: SparkSession, paths: JobPaths) -> DataFrame:
    return read_batches(spark, paths.table("quarantine"), _QUARANTINE)


def created_messages(spark: SparkSession, paths: JobPaths) -> DataFrame:
    return read_batches(spark, paths.table("created"), _MESSAGE)


# --- stored pages -> crawl and raw events ----------------------------------

def links_from_pages(pages: DataFrame, per_page: int | None = K.CRAWL_LINKS_PER_PAGE, **options) -> DataFrame:
    """Stream of crawl messages from a stream of search pages (no state, no shuffle): the first ``per_page`` links of
    each page, all with None."""
    return E.crawl_messages(discover_links(pages.select("url", "html"), per_page=per_page, **options))


def raw_from_pages(pages: DataFrame) -> DataFrame:
    """Stream of raw listing messages from a stream of listing pages (no state, no shuffle)."""
    return E.raw_events(complete_raw(page_listings(pages.select("url", "html"))), "batch")


def append_messages(messages: DataFrame, paths: JobPaths, table: str) -> StreamingQuery:
    query = (
        messages.writeStream.format("parquet").option("path", paths.table(table))
        .option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


# --- listing events -> similarity table, ingestion events -> rollup --------

_RANKED = T.StructType([
    T.StructField("city", T.StringType()), T.StructField("base_id", T.StringType()), T.StructField("rank", T.IntegerType()),
    T.StructField("similar_id", T.StringType()), T.StructField("score", T.DoubleType()),
])
_CITY = T.StructType([T.StructField("city", T.StringType())])


def refresh_index(
    messages: DataFrame, listings: Callable[[], DataFrame], paths: JobPaths, timeout: int | None = None
) -> StreamingQuery:
    """Recompute the similarity of the cities that a batch of listing events touches.

    ``listings`` gives the listing table as it is when a batch runs. A bootstrap
    event touches every city. The current index is the newest refresh per city.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        events = E.of_type(E.parse_events(batch, schemas.LISTING_EVENT), K.EVENT_CREATED, K.EVENT_BOOTSTRAPPED)
        table = listings().withColumn("city", city_from_address(F.col("address")))
        cities = events.select(city_from_address(F.col("body.listing.address")).alias("city")).where("city IS NOT NULL")
        if events.where(F.col("body.event") == K.EVENT_BOOTSTRAPPED).limit(1).count():
            cities = cities.union(table.select("city"))
        write_batch(cities.distinct(), paths.table("touched"), batch_id)
        cities = batch.sparkSession.read.schema(_CITY).parquet(f"{paths.table('touched')}/batch={batch_id}")
        affected = table.join(cities, "city", "left_semi")
        ranked = topk_similar(affected)
        with_city = ranked.join(affected.select(F.col("id").alias("base_id"), "city"), "base_id")
        write_batch(with_city.select(*_RANKED.names), paths.table("index"), batch_id)
        # The mark that readers go by comes last: until then they see the index of the batch before.
        write_batch(cities, paths.table("refreshed"), batch_id)

    return run_bounded(messages, each, paths, timeout=timeout)


def current_index(spark: SparkSession, paths: JobPaths) -> DataFrame:
    newest = read_batches(spark, paths.table("refreshed"), _CITY).groupBy("city").agg(F.max("batch").alias("batch"))
    return read_batches(spark, paths.table("index"), _RANKED).join(newest, ["city", "batch"]).select(*_RANKED.names)


def refresh_rollup(messages: DataFrame, paths: JobPaths, timeout: int | None = None, **options) -> StreamingQuery:
    """Recompute the price rollup when a batch holds a completed-ingestion event (the newest one counts)."""

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = E.of_type(E.parse_events(batch, schemas.INGESTION_EVENT), K.EVENT_INGESTION)
        newest = done.agg(F.max_by("body.paths", "body.timestamp_utc").alias("paths")).first()
        if newest is None or newest.paths is None:
            return
        prices = spark.read.schema(schemas.PRICE_FACT).parquet(newest.paths.dvf_parquet)
        population = spark.read.schema(schemas.DEMOGRAPHIC_FACT).parquet(newest.paths.insee_parquet)
        write_batch(rollup_hierarchy(prices, population, **options), paths.table("prices"), batch_id)

    return run_bounded(messages, each, paths, timeout=timeout)


def current_rollup(spark: SparkSession, paths: JobPaths) -> DataFrame:
    """The newest rollup."""
    fact = T.StructType([
        T.StructField(f.name, T.DoubleType() if f.name == "mutation_count" else f.dataType) for f in schemas.PRICE_FACT
    ])
    every = read_batches(spark, paths.table("prices"), fact)
    return every.where(F.col("batch") == every.agg(F.max("batch")).scalar()).drop("batch")


# --- running state ---------------------------------------------------------

def sentiment_state(reviews: DataFrame, keys: Sequence[str] = ("year",)) -> DataFrame:
    """Running sum and count of scores per key over a stream with ``review_text``."""
    scored = with_score(min_text(reviews))
    return scored.groupBy(*keys).agg(F.sum("score").alias("score_sum"), F.count("score").alias("score_count"))


def term_state(reviews: DataFrame, keys: Sequence[str] = ("year",)) -> DataFrame:
    """Running term counts per key over a stream with ``review_text``."""
    words = F.explode(F.regexp_extract_all(F.lower("review_text"), F.lit(K.TOKEN_PATTERN), 0))
    terms = min_text(reviews).select(*keys, words.alias("term")).where(~F.col("term").isin(*K.STOPWORDS))
    return terms.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("freq"))


def keep_state(state: DataFrame, paths: JobPaths, table: str, timeout: int | None = None) -> StreamingQuery:
    """Write the changed rows of a running aggregate, batch by batch."""
    return run_bounded(state, lambda df, n: write_batch(df, paths.table(table), n), paths, "update", timeout)


def current_state(spark: SparkSession, paths: JobPaths, table: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    return newest_per_key(read_batches(spark, paths.table(table), schema), keys, [F.col("batch").desc()]).drop("batch")


def dedupe(events: DataFrame, keys: Sequence[str], time: str | None = None, delay: str | None = None) -> DataFrame:
    """Drop events whose keys were seen before; a watermark bounds what has to be remembered."""
    if time is None or delay is None:
        return events.dropDuplicates(list(keys))
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))

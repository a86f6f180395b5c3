"""Scan and sink queries. Files are written to the shared folder from the given tables, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir import schemas
from terroir.functions import constants as K
from terroir.operators import reviews as R
from terroir.session import scratch_path
from terroir.sources import events as E
from terroir.sources import files, sinks

from .base import case, raw_listings, table, view



@case("scan_csv_sniff", "SELECT code_geo, libelle_geo, echelle_geo, TRY_CAST(moy_prix_m2_whole_maison AS DOUBLE) AS price FROM wide_prices")
def _(spark, sf):
    path = scratch_path(spark, "wide-csv")
    wide = view(spark, sf, "wide_prices")
    wide.write.option("header", True).option("sep", ";").option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    df = files.read_csv(spark, path, schemas.wide_price_schema())
    return df.select("code_geo", "libelle_geo", "echelle_geo", F.col("moy_prix_m2_whole_maison").try_cast("double").alias("price"))


@case("scan_json_array", "SELECT id, title, price, rooms, lat, 'a,b' AS tags FROM listings")
def _(spark, sf):
    path = scratch_path(spark, "listing-arrays")
    listings = view(spark, sf, "listings").withColumn("tags", F.array(F.lit("a"), F.lit("b")))
    # Documents with one JSON array each: at most a hundred neighbouring ids per array.
    docs = listings.groupBy(F.substring("id", 1, 8).alias("bucket")).agg(F.to_json(F.collect_list(F.struct(*listings.columns))).alias("value"))
    docs.select("value").write.option("maxRecordsPerFile", 1).text(path)
    df = files.read_json_listings(spark, path)
    return df.select("id", "title", "price", "rooms", "lat", F.concat_ws(",", "tags").alias("tags"))


_CODES = "SELECT DISTINCT insee_code FROM prices WHERE level = 'city'"


def _stored_prices(spark, sf):
    path = scratch_path(spark, "prices")
    sinks.write_partitioned(view(spark, sf, "prices").withColumn("source", F.lit(K.PRICE_SOURCE)), path)
    return path


@case("scan_parquet_partitioned", _CODES)
def _(spark, sf):
    return files.read_codes(spark, _stored_prices(spark, sf), schemas.PRICE_FACT, "city")


@case("sink_parquet_partitioned", """SELECT year, level, count(*) AS n, count(DISTINCT insee_code) AS codes, max(price_m2_avg) AS highest
 FROM prices GROUP BY year, level""")
def _(spark, sf):
    df = files.read_facts(spark, _stored_prices(spark, sf), schemas.PRICE_FACT)
    return df.groupBy("year", "level").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("insee_code").alias("codes"), F.max("price_m2_avg").alias("highest")
    )


@case("scan_reviews_gz", """SELECT md5(review_text) AS text_md5, CAST(CASE WHEN doc_id % 7 = 0 THEN 0 ELSE 2009 + doc_id % 5 END AS INT) AS year FROM reviews""")
def _(spark, sf):
    path = scratch_path(spark, "reviews-gz")
    date = F.expr("CASE WHEN doc_id % 7 = 0 THEN 'not a date' ELSE concat(CAST(year AS STRING), '-03-04') END").alias("date")
    reviews = view(spark, sf, "reviews").select(F.col("review_text").alias("comments"), date)
    reviews.write.option("header", True).option("compression", "gzip").option("escape", '"').option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    df = R.with_review_columns(files.read_reviews(spark, path).select(F.col("review_text").alias("comments"), F.col("review_date").alias("date")))
    return df.select(F.md5(F.col("review_text").cast("binary")).alias("text_md5"), "year")


_PROPERTIES = T.StructType([T.StructField("nom_officiel", T.StringType()), T.StructField("code_insee", T.StringType())])


def _boundaries(spark, sf):
    """One square per commune of the census, as feature collections."""
    path = scratch_path(spark, "boundaries")
    lon, lat = F.col("insee_code").cast("int") % 997 / 97.0, F.col("insee_code").cast("int") % 89 / 7.0
    corner = lambda dx, dy: F.array(lon + dx, lat + dy)
    ring = F.array(corner(0, 0), corner(0.1, 0), corner(0.1, 0.1), corner(0, 0))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.concat(F.lit("Commune "), "insee_code").alias("nom_officiel"), F.col("insee_code").alias("code_insee")).alias("properties"),
        F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(ring)).alias("coordinates")).alias("geometry"),
    )
    codes = view(spark, sf, "census").select("insee_code").distinct()
    docs = codes.groupBy(F.substring("insee_code", 1, 2).alias("dep")).agg(F.collect_list(feature).alias("features"))
    docs.select(F.lit("FeatureCollection").alias("type"), "features").write.option("maxRecordsPerFile", 1).json(path)
    return files.read_boundaries(spark, path, _PROPERTIES)


_SQUARE = "(SELECT insee_code, CAST(insee_code AS INT) % 997 / 97.0 AS lon, CAST(insee_code AS INT) % 89 / 7.0 AS lat FROM (SELECT DISTINCT insee_code FROM census))"


@case("scan_geojson", """SELECT DISTINCT insee_code, concat('Commune ', insee_code) AS name, CAST(4 AS INT) AS points FROM census
 WHERE insee_code IN (SELECT insee_code FROM prices WHERE year = 1998)""")
def _(spark, sf):
    codes = view(spark, sf, "prices").where("year = 1998").select("insee_code")
    kept = files.boundaries_of(_boundaries(spark, sf), codes, "city")
    return kept.select(
        F.col("properties.code_insee").alias("insee_code"), F.col("properties.nom_officiel").alias("name"),
        F.size(F.col("geometry.coordinates")[0][0]).alias("points"),
    )


@case("coord_round", f"SELECT insee_code, round(lon, 4) AS lon, round(lat, 4) AS lat, round(lon + 0.1, 4) AS lon2 FROM {_SQUARE}")
def _(spark, sf):
    df = files.compact_boundaries(_boundaries(spark, sf))
    ring = F.col("geometry.coordinates")[0][0]
    return df.select(
        F.col("properties.code_insee").alias("insee_code"), ring[0][0].alias("lon"), ring[0][1].alias("lat"), ring[1][0].alias("lon2")
    )


@case("sink_upsert_keyed", """WITH writes AS (SELECT user_id, event_type, value, event_id, event_id % 2 AS wave FROM events)
 SELECT user_id, event_type, value, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY wave DESC, event_id DESC) AS rn
 FROM writes) WHERE rn = 1""")
def _(spark, sf):
    from terroir.operators.keyed import newest_per_key

    root = scratch_path(spark, "documents")
    keys = ["user_id", "event_type"]
    for wave in (0, 1):
        new = table(spark, sf, "events").where(F.col("event_id") % 2 == wave).select(*keys, "value", "event_id")
        out = sinks.upsert_keyed(newest_per_key(new, keys, [F.col("event_id").desc()]), root, keys)
    return out


@case("sink_listing_snapshot", "SELECT id, title, price, rooms, surface, lat, lon, source, url FROM listings")
def _(spark, sf):
    path = scratch_path(spark, "snapshot")
    sinks.write_snapshot(view(spark, sf, "listings"), path)
    df = files.read_json_listings(spark, path, lines=True)
    return df.select("id", "title", "price", "rooms", "surface", "lat", "lon", "source", "url")


@case("sink_kafka_json", """SELECT url, price, rooms, source, furnished, 'listing.raw' AS event, 'batch' AS origin FROM raw_listings""")
def _(spark, sf):
    path = scratch_path(spark, "topic")
    E.write_topic_files(E.raw_events(raw_listings(spark, sf), "batch"), path)
    parsed = E.of_type(E.parse_events(spark.read.text(path), schemas.RAW_EVENT), K.EVENT_RAW)
    return parsed.select(
        "body.payload.url", "body.payload.price", "body.payload.rooms", "body.payload.source", "body.payload.furnished",
        "body.event", F.col("body.source").alias("origin"),
    )


_NAMES = {"signup": K.EVENT_RAW, "click": K.EVENT_CREATED, "view": K.EVENT_CRAWL}


@case("filter_event_type", """SELECT event_id, CASE event_type WHEN 'signup' THEN 'listing.raw' ELSE 'listing.created' END AS event FROM events
 WHERE event_type IN ('signup', 'click') AND event_id % 10 <> 3""")
def _(spark, sf):
    name = F.col("event_type")
    for key, event in _NAMES.items():
        name = F.when(F.col("event_type") == key, event).otherwise(name)
    body = F.to_json(F.struct(name.alias("event"), F.col("event_id").cast("string").alias("timestamp")))
    value = F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("{oops "), body)).otherwise(body)
    messages = table(spark, sf, "events").select(value.alias("value"))
    kept = E.of_type(E.parse_events(messages, schemas.LISTING_EVENT), K.EVENT_RAW, K.EVENT_CREATED)
    return kept.select(F.col("body.timestamp").cast("bigint").alias("event_id"), "body.event")

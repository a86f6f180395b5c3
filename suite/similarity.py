"""Similarity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from terroir.operators import keyed
from terroir.operators import similarity as S
from terroir.session import scratch_path
from terroir.sources import sinks

from .base import case, view
from .listings import LISTED

RANKED = f"""{LISTED}, scored AS (SELECT a.id AS base_id, b.id AS similar_id,
  2 * abs(b.price - a.price) / greatest(a.price, 1.0) + abs(b.surface - a.surface) / greatest(a.surface, 1.0)
   + 0.05 * sqrt(((b.lat - a.lat) * 111) * ((b.lat - a.lat) * 111) + ((b.lon - a.lon) * 85) * ((b.lon - a.lon) * 85)) AS score
  FROM listed a JOIN listed b ON a.city = b.city AND a.id <> b.id),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY base_id ORDER BY score, similar_id) AS rank
  FROM scored WHERE score < 1.2) WHERE rank <= 6)"""


def ranked(spark, sf):
    return S.topk_similar(view(spark, sf, "listings"))


@case("topk_similar", f"WITH {RANKED} SELECT base_id, CAST(rank AS INT) AS rank, similar_id, round(score, 6) AS score FROM ranked")
def _(spark, sf):
    return ranked(spark, sf).withColumn("score", F.round("score", 6))


@case("self_join_similar", f"""WITH {LISTED} SELECT id, city, CAST(n - 1 AS BIGINT) AS candidates FROM listed
 JOIN (SELECT city, count(*) AS n FROM listed GROUP BY city) USING (city)""")
def _(spark, sf):
    return S.candidate_counts(view(spark, sf, "listings"))


@case("sink_similar_index", f"""WITH {RANKED} SELECT base_id, string_agg(similar_id, ',' ORDER BY rank) AS similar,
 (SELECT count(*) FROM listings) AS listing_count FROM ranked GROUP BY base_id""")
def _(spark, sf):
    path = scratch_path(spark, "similar-index")
    sinks.write_similar_index(ranked(spark, sf), view(spark, sf, "listings"), path)
    index = spark.read.schema("base_id string, similar array<string>, listingCount bigint").json(path)
    return index.select("base_id", F.concat_ws(",", "similar").alias("similar"), F.col("listingCount").alias("listing_count"))


# An index that is out of date: every base points at the next two parts, ids above the table's end do not resolve.
_STALE = """stale AS (SELECT lpad(CAST(p_partkey AS STRING), 10, '0') AS base_id, CAST(1 AS INT) AS rank,
   lpad(CAST(p_partkey * 2 AS STRING), 10, '0') AS similar_id FROM part
 UNION ALL SELECT lpad(CAST(p_partkey AS STRING), 10, '0'), CAST(2 AS INT), lpad(CAST(p_partkey * 3 AS STRING), 10, '0') FROM part)"""


def _stale(spark, sf):
    from .base import table

    part = table(spark, sf, "part")
    entry = lambda n: part.select(
        F.lpad(F.col("p_partkey").cast("string"), 10, "0").alias("base_id"), F.lit(n - 1).alias("rank"),
        F.lpad((F.col("p_partkey") * n).cast("string"), 10, "0").alias("similar_id"),
    )
    return entry(2).union(entry(3))


@case("resolve_similar", f"""WITH {_STALE} SELECT base_id, rank, similar_id, l.title, l.price FROM stale JOIN listings l ON l.id = similar_id""")
def _(spark, sf):
    listings = view(spark, sf, "listings").select("id", "title", "price")
    return S.resolve_similar(_stale(spark, sf), listings).select("base_id", "rank", "similar_id", "title", "price")


@case("similar_with_fallback", f"""WITH {_STALE}, {RANKED}, known AS (SELECT s.* FROM stale s JOIN listings l ON l.id = s.similar_id)
 SELECT base_id, rank, similar_id FROM known UNION ALL
 SELECT base_id, CAST(rank AS INT), similar_id FROM ranked WHERE base_id NOT IN (SELECT base_id FROM known)""")
def _(spark, sf):
    return S.similar_with_fallback(_stale(spark, sf), view(spark, sf, "listings")).select("base_id", "rank", "similar_id")


@case("anti_join_similar", f"""WITH {_STALE} SELECT id, price FROM listings WHERE id NOT IN (SELECT similar_id FROM stale)""")
def _(spark, sf):
    return keyed.anti_join_ids(view(spark, sf, "listings").select("id", "price"), _stale(spark, sf))

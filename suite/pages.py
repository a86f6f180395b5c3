"""Page queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from terroir.operators import pages as P

from .base import case, table

# Host parts and path patterns of the given pages.
PATTERNS = {"blog": ("^/[a-z]+$",), "example": ("^/[A-Za-z]+$", "%C3")}

# The given pages link with absolute paths of one segment. Path escaping in SQL: every byte that is not printable ASCII.
_ESCAPED = """list_aggregate(list_transform(string_split(href, ''), lambda c: CASE WHEN regexp_matches(c, '[^!-~]|["<>`{}^]')
 THEN regexp_replace(hex(encode(c)), '(..)', '%\\1', 'g') ELSE c END), 'string_agg', '')"""
_BODY = "regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g')"
LINKS = f"""hosts AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS origin,
   regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract_all({_BODY}, '(?is)<a\\s[^>]*?href="([^"]*)"', 1) AS hrefs FROM pages),
 each AS (SELECT page_id, url, origin, host, i AS pos, {_ESCAPED} AS path FROM
   (SELECT *, unnest(hrefs) AS href, unnest(range(1, len(hrefs) + 1)) AS i FROM hosts)),
 firsts AS (SELECT page_id, url, origin || path AS listing_url, min(pos) AS pos FROM each
   WHERE regexp_matches(path, CASE WHEN contains(host, 'blog') THEN '(?i)^/[a-z]+$' ELSE '(?i)^/[A-Za-z]+$|%C3' END)
   GROUP BY page_id, url, origin || path),
 links AS (SELECT page_id, url, listing_url, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS position FROM firsts)"""


@case("discover_links", f"WITH {LINKS} SELECT page_id, url, CAST(position AS INT) AS position, listing_url FROM links")
def _(spark, sf):
    return P.discover_links(table(spark, sf, "pages"), patterns=PATTERNS)


# Every part becomes a page that carries its fields in one of the layers, chosen by its size.
_JSON_LISTING = """'"title":"', p_name, '","price":', CAST(p_partkey AS STRING), ',"surface":"', CAST(p_size AS STRING), ',5 m²","rooms":', CAST(p_size % 5 AS STRING),
 ',"city":" Lyon ","elevator":', CASE WHEN p_size % 2 = 0 THEN 'true' ELSE '"yes"' END, ',"dpe":"', substr('abcXdef', CAST(1 + p_partkey % 7 AS INT), 1), '"'"""
MADE_PAGES = f"""SELECT p_partkey, concat('https://www.', CASE p_size % 5 WHEN 0 THEN 'bienici.com' WHEN 1 THEN 'leboncoin.fr' ELSE 'example.org' END,
   '/annonce/', CAST(p_partkey AS STRING)) AS url,
 concat('<html><head><title>', CASE WHEN p_size % 5 = 3 THEN concat('Maison T', CAST(p_size % 9 AS STRING), ' ', CAST(p_size AS STRING), ' m² 1 ',
   CAST(100 + p_partkey % 900 AS STRING), ' € Lyon (69001)') ELSE '' END, '</title>',
  CASE p_size % 5
   WHEN 0 THEN concat('<script id="__NEXT_DATA__" type="application/json">{{"props":{{"pageProps":{{"propertyAd":{{"title":"', p_name,
     '","monthlyPrice":"', CAST(p_partkey AS STRING), ',50 €","surfaceArea":', CAST(p_size AS STRING), ',"roomsCount":3,"hasElevator":false,"city":"Nantes","photos":[{{"url":"https://i.example/',
     CAST(p_partkey AS STRING), '"}},"ftp://x"]}}}}}}}}</script>')
   WHEN 1 THEN concat('<script>window.__INITIAL_STATE__ = {{"props":{{"pageProps":{{"ad":{{"subject":"', p_name, '","price":[', CAST(p_partkey AS STRING),
     '],"attributes":[{{"key":"square","value":"', CAST(p_size AS STRING), '"}},{{"key":"rooms","values":["4"]}},{{"key":"furnished","value":"1"}}],"location":{{"city":"Lille","zipcode":"59000","lat":50.6}}}}}}}}}};</script>')
   WHEN 2 THEN concat('<script type="application/ld+json">[{{"@type":"WebSite","name":"no"}},{{"@type":"Apartment","name":"', p_name, '","offers":{{"price":"',
     CAST(p_partkey AS STRING), ' €"}},"floorSize":{{"value":', CAST(p_size AS STRING), '}},"address":{{"addressLocality":"Lyon","postalCode":"69003"}},"numberOfRooms":2}}]</script>')
   WHEN 3 THEN '<meta name="description" content="Bel &amp; calme"><meta property="og:image" content="https://i.example/x.jpg">'
   ELSE concat('<script id="__NEXT_DATA__" type="application/json">{{"props":{{"pageProps":{{"listing":{{', {_JSON_LISTING}, '}}}}}}}}</script>') END,
  '</head><body></body></html>') AS html FROM part"""

EXTRACTED = """SELECT p_partkey,
 CASE WHEN p_size % 5 = 3 THEN concat('Maison T', CAST(p_size % 9 AS STRING), ' ', CAST(p_size AS STRING), ' m² 1 ', CAST(100 + p_partkey % 900 AS STRING), ' € Lyon (69001)') ELSE p_name END AS title,
 CASE p_size % 5 WHEN 0 THEN p_partkey + 0.5e0 WHEN 3 THEN CAST(1000 + 100 + p_partkey % 900 AS DOUBLE) ELSE CAST(p_partkey AS DOUBLE) END AS price,
 CASE p_size % 5 WHEN 4 THEN p_size + 0.5e0 ELSE CAST(p_size AS DOUBLE) END AS surface,
 CASE p_size % 5 WHEN 0 THEN 3e0 WHEN 1 THEN 4e0 WHEN 2 THEN 2e0 WHEN 3 THEN CAST(p_size % 9 AS DOUBLE) ELSE CAST(p_size % 5 AS DOUBLE) END AS rooms,
 CASE p_size % 5 WHEN 0 THEN 'Nantes' WHEN 1 THEN 'Lille' ELSE 'Lyon' END AS city,
 CASE p_size % 5 WHEN 1 THEN '59000' WHEN 2 THEN '69003' WHEN 3 THEN '69001' END AS postalCode,
 CASE p_size % 5 WHEN 0 THEN false WHEN 4 THEN CASE WHEN p_size % 2 = 0 THEN true END END AS elevator,
 CASE p_size % 5 WHEN 1 THEN true END AS furnished,
 CASE WHEN p_size % 5 = 4 AND p_partkey % 7 <> 3 THEN substr('ABCXDEF', CAST(1 + p_partkey % 7 AS INT), 1) END AS dpe,
 CASE p_size % 5 WHEN 0 THEN concat('https://i.example/', CAST(p_partkey AS STRING)) WHEN 3 THEN 'https://i.example/x.jpg' ELSE '' END AS photos,
 CASE p_size % 5 WHEN 3 THEN 'Bel & calme' END AS description FROM part"""
_COLUMNS = ("p_partkey", "title", "price", "surface", "rooms", "city", "postalCode", "elevator", "furnished", "dpe", "photos", "description")


def made_pages(spark, parts):
    parts.createOrReplaceTempView("part")
    return spark.sql(MADE_PAGES)


def _layers_seen(pages):
    return P.extract_layers(pages).select(
        "page_id", F.col("og.title").alias("title"), F.col("state").isNotNull().alias("has_state"),
        F.coalesce(F.col("jsonld.title").isNotNull(), F.lit(False)).alias("has_jsonld"),
    )


@case("merge_first_non_null", EXTRACTED)
def _(spark, sf):
    df = P.merge_first_non_null(P.extract_layers(made_pages(spark, table(spark, sf, "part"))))
    return df.withColumn("photos", F.concat_ws(",", "photos")).select(*_COLUMNS)


@case("page_extract_layers_made", r"""SELECT CAST(p_partkey AS BIGINT) + 1000000000 AS page_id, nullif(CASE WHEN p_size % 5 = 3 THEN concat('Maison T', CAST(p_size % 9 AS STRING), ' ',
  CAST(p_size AS STRING), ' m² 1 ', CAST(100 + p_partkey % 900 AS STRING), ' € Lyon (69001)') ELSE '' END, '') AS title,
  p_size % 5 IN (0, 4) AS has_state, p_size % 5 = 2 AS has_jsonld FROM part""")
def _(spark, sf):
    made = made_pages(spark, table(spark, sf, "part")).select((F.col("p_partkey").cast("bigint") + 1000000000).alias("page_id"), "url", "html")
    return _layers_seen(made)


# The given pages hold neither state nor schema blocks; the made ones above do.
@case("page_extract_layers", r"""SELECT page_id, nullif(trim(replace(replace(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')), '') AS title, false AS has_state, false AS has_jsonld FROM pages""")
def _(spark, sf):
    return _layers_seen(table(spark, sf, "pages"))



# Pages with several hundred links: one per part of its brand, in order, some twice.
@case("discover_links_long_pages", """SELECT p_brand AS brand, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS INT) AS position,
 concat('https://www.bienici.com/annonce/location/', CAST(p_partkey AS STRING)) AS listing_url FROM part""")
def _(spark, sf):
    anchor = F.concat(F.lit('<a href="/annonce/location/'), F.col("p_partkey").cast("string"), F.lit('">x</a>'))
    pages = table(spark, sf, "part").groupBy(F.col("p_brand").alias("brand")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", F.repeat(anchor, 2).alias("a")))), lambda x: x["a"]), "").alias("html"))
    links = P.discover_links(pages.withColumn("url", F.lit("https://www.bienici.com/recherche")))
    return links.select("brand", F.col("position").cast("int").alias("position"), "listing_url")


# The other site readers: a state with another ad before the listing, and a state held as a text inside a text.
SITE_PAGES = """SELECT p_partkey, CASE p_size % 3 WHEN 2 THEN 'https://www.logic-immo.com/a' ELSE 'https://www.seloger.com/a' END AS url,
 CASE p_size % 3
  WHEN 0 THEN concat('<script id="__NEXT_DATA__">{"props":{"pageProps":{"others":[{"displayedPrice":"999","surface":1,"price":998}],"listingData":{"listing":{"title":"', p_name,
    '","extra":{"displayedPrice":"', CAST(1000 + p_partkey AS STRING), ' &euro;"},"characteristics":{"rooms":3},"details":{"surface":10,"rooms":9},"surface":', CAST(p_size AS STRING),
    ',"location":{"city":"Lyon"},"address":{"city":"Paris","zipCode":"75001"}}}}}}</script>')
  WHEN 1 THEN concat('<script>window["SELOGER_DATA"] = {"props":{"pageProps":{"ad":{"publicationTitle":"', p_name, '","price":"', CAST(p_partkey AS STRING),
    ',50","features":{"area":"', CAST(p_size AS STRING), '"},"perimeter":{"locality":"Lille"}}}}};</script>')
  ELSE concat('<script id="__UFRN_LIFECYCLE_SERVERREQUEST__">window.x=JSON.parse("{', chr(92), '"app_cldp', chr(92), '":{', chr(92), '"data', chr(92), '":{', chr(92), '"classified', chr(92), '":{', chr(92), '"sections', chr(92), '":{',
    chr(92), '"hardFacts', chr(92), '":{', chr(92), '"title', chr(92), '":', chr(92), '"Studio ', p_name, ' ', chr(92), chr(92), chr(92), chr(92), chr(92), '",', chr(92), '"price', chr(92), '":{', chr(92), '"ariaLabel', chr(92), '":', chr(92), '"1 ',
    CAST(100 + p_partkey % 900 AS STRING), chr(92), '"}},', chr(92), '"energy', chr(92), '":{', chr(92), '"certificates', chr(92), '":[{', chr(92), '"scales', chr(92), '":[{', chr(92), '"name', chr(92), '":', chr(92), '"Performance GES', chr(92), '",',
    chr(92), '"efficiencyClass', chr(92), '":{', chr(92), '"rating', chr(92), '":', chr(92), '"', substr('ABCDEFG', CAST(1 + p_partkey % 7 AS INT), 1), chr(92), '"}}]}]}}}}}}")</script>') END AS html FROM part"""


@case("page_site_readers", """SELECT p_partkey, CASE p_size % 3 WHEN 2 THEN concat('Studio ', p_name, ' ', chr(92)) ELSE p_name END AS title,
 CASE p_size % 3 WHEN 0 THEN 1000e0 + p_partkey WHEN 1 THEN p_partkey + 0.5e0 ELSE 1100e0 + p_partkey % 900 END AS price,
 CASE p_size % 3 WHEN 2 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS surface, CASE p_size % 3 WHEN 0 THEN 3e0 END AS rooms,
 CASE p_size % 3 WHEN 0 THEN 'Lyon' WHEN 1 THEN 'Lille' END AS city, CASE p_size % 3 WHEN 2 THEN 'studio' END AS type,
 CASE p_size % 3 WHEN 2 THEN substr('ABCDEFG', CAST(1 + p_partkey % 7 AS INT), 1) END AS dpe, CAST(NULL AS VARCHAR) AS ges, CAST(NULL AS VARCHAR) AS postalCode FROM part""")
def _(spark, sf):
    table(spark, sf, "part").createOrReplaceTempView("part")
    df = P.merge_first_non_null(P.extract_layers(spark.sql(SITE_PAGES.replace("chr(92)", "char(92)"))))
    return df.select("p_partkey", "title", "price", "surface", "rooms", "city", "type", "dpe", "ges", "postalCode")

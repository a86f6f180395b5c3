"""Listing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from terroir.functions import codes, listing, numbers, text
from terroir.functions import constants as K
from terroir.operators import keyed
from terroir.operators import listings as L

from .base import case, raw_listings, view

CITY_SQL = """CASE WHEN contains(tail, 'paris') THEN 'paris' WHEN contains(tail, 'lyon') THEN 'lyon'
 WHEN contains(tail, 'bordeaux') OR contains(tail, 'mérignac') OR contains(tail, 'merignac') THEN 'bordeaux'
 WHEN contains(tail, 'marseille') THEN 'marseille' WHEN contains(tail, 'nantes') THEN 'nantes'
 WHEN contains(tail, 'lille') THEN 'lille' WHEN contains(tail, 'toulouse') THEN 'toulouse'
 WHEN contains(tail, 'saint-malo') THEN 'saint-malo' WHEN contains(tail, 'strasbourg') THEN 'strasbourg' ELSE tail END"""
LISTED = f"""listed AS (SELECT *, {CITY_SQL} AS city FROM
 (SELECT *, lower(trim(regexp_extract(address, '[^,]*$'))) AS tail FROM listings))"""


@case("city_from_address", f"WITH {LISTED} SELECT id, city FROM listed")
def _(spark, sf):
    return view(spark, sf, "listings").select("id", listing.city_from_address(F.col("address")).alias("city"))


@case("fold_accents", "SELECT doc_id, trim(lower(strip_accents(substr(review_text, 1)))) AS folded FROM reviews")
def _(spark, sf):
    return view(spark, sf, "reviews").select("doc_id", text.fold_accents(F.col("review_text")).alias("folded"))


@case("stable_id", "SELECT url, substr(sha256(url), 1, 16) AS id FROM raw_listings")
def _(spark, sf):
    return view(spark, sf, "raw_listings").select("url", listing.stable_id(F.col("url")).alias("id"))


# The rolling hash in SQL: fold over the code units with wrap-around at 32 bits.
def hash_sql(seed: str) -> str:
    units = f"list_transform(string_split({seed}, ''), lambda c: CAST(unicode(c) AS BIGINT))"
    return f"list_reduce(list_prepend(CAST(0 AS BIGINT), {units}), lambda h, c: ((h * 31 + c + 2147483648) & 4294967295) - 2147483648)"


def jitter_sql(h: str) -> tuple[str, str]:
    return f"(({h}) % 1000 - 500) / 50000.0", f"((({h}) >> 10) % 1000 - 500) / 50000.0"


@case("hash_jitter", f"""SELECT url, h, round(43 + {jitter_sql('h')[0]}, 9) AS lat, round(2 + {jitter_sql('h')[1]}, 9) AS lon
 FROM (SELECT url, {hash_sql('url')} AS h FROM raw_listings)""")
def _(spark, sf):
    df = view(spark, sf, "raw_listings").select("url", numbers.rolling_hash(F.col("url")).alias("h"))
    dx, dy = numbers.jitter_offsets(F.col("h"))
    return df.select("url", "h", F.round(43 + dx, 9).alias("lat"), F.round(2 + dy, 9).alias("lon"))


_CENTROIDS = ", ".join(f"({i}, '{k}', {lat}, {lon})" for i, (k, lat, lon, _) in enumerate(K.CENTROIDS))
_INSEE_DEPT = "CASE WHEN regexp_matches(insee, '^(97[1-8]|98[47])[0-9]{2}$') THEN substr(insee, 1, 3) ELSE substr(insee, 1, 2) END"
_IJ = jitter_sql("ih")
_UJ = jitter_sql("uh")
GEO = f"""places(ord, key, plat, plon) AS (VALUES {_CENTROIDS}),
keyed AS (SELECT *, trim(lower(strip_accents(city))) AS ckey,
   CASE WHEN regexp_matches(postalCode, '^[0-9]{{5}}$') THEN postalCode END AS insee FROM raw_listings),
hashed AS (SELECT *, {hash_sql('insee')} AS ih, {hash_sql('url')} AS uh, {_INSEE_DEPT} AS idep FROM keyed),
hits AS (SELECT url AS hurl, arg_min(plat, CASE WHEN key = ckey THEN -1 ELSE ord END) AS clat,
   arg_min(plon, CASE WHEN key = ckey THEN -1 ELSE ord END) AS clon
   FROM hashed JOIN places ON city <> '' AND (key = ckey OR (key NOT LIKE 'dept-%' AND (contains(ckey, key) OR contains(key, ckey))))
   GROUP BY url),
placed AS (SELECT h.*, clat, clon,
   CASE WHEN insee IS NOT NULL THEN coalesce(d.plat, 42.2 + abs(ih) % 850 / 100.0) + {_IJ[0]} END AS ilat,
   CASE WHEN insee IS NOT NULL THEN coalesce(d.plon, -4.8 + abs(ih >> 8) % 1000 / 100.0) + {_IJ[1]} END AS ilon,
   CASE WHEN length(postalCode) >= 2 THEN p.plat END AS dlat, CASE WHEN length(postalCode) >= 2 THEN p.plon END AS dlon
   FROM hashed h LEFT JOIN hits ON url = hurl LEFT JOIN places d ON d.key = 'dept-' || idep
   LEFT JOIN places p ON p.key = 'dept-' || substr(postalCode, 1, 2)),
geo AS (SELECT * EXCLUDE (lat, lon),
   CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lat ELSE coalesce(coalesce(clat, ilat, dlat) + {_UJ[0]}, lat) END AS lat,
   CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN lon ELSE coalesce(coalesce(clon, ilon, dlon) + {_UJ[1]}, lon) END AS lon
   FROM placed)"""


@case("geocode_fallback", f"WITH {GEO} SELECT url, round(lat, 6) AS lat, round(lon, 6) AS lon FROM geo")
def _(spark, sf):
    df = L.geocode_fallback(raw_listings(spark, sf))
    return df.select("url", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


_SOURCE_SQL = """CASE WHEN contains(s, 'seloger') THEN 'seloger' WHEN contains(s, 'leboncoin') OR contains(s, 'lbc') THEN 'leboncoin'
 WHEN contains(s, 'bienici') OR contains(s, 'bien''ici') THEN 'bienici'
 ELSE coalesce(nullif(substr(regexp_replace(s, '[^a-z0-9]', '', 'g'), 1, 32), ''), 'unknown') END"""
_TAGS_SQL = """concat_ws(',', CASE WHEN furnished THEN 'Meublé' END, CASE WHEN balcony THEN 'Balcon' END,
 CASE WHEN terrace THEN 'Terrasse' END, CASE WHEN parking THEN 'Parking' END, CASE WHEN elevator THEN 'Ascenseur' END, 'DPE ' || dpe)"""
_ROOMS = "coalesce(rooms, bedrooms)"
_REASON = f"""CASE WHEN price IS NULL OR price <= 0 THEN 'Prix manquant ou invalide'
 WHEN {_ROOMS} IS NULL OR {_ROOMS} <= 0 THEN 'Nombre de pièces manquant ou invalide'
 WHEN surface IS NULL OR surface <= 0 THEN 'Surface manquante ou invalide'
 WHEN lat IS NULL OR lon IS NULL THEN 'Coordonnées lat/lon manquantes — géocodage requis' END"""
NORMALIZED = f"""{GEO}, normalized AS (SELECT substr(sha256(url), 1, 16) AS id,
  coalesce(nullif(trim(title), ''), 'Annonce sans titre') AS title,
  coalesce(nullif(trim(address), ''), nullif(concat_ws(' · ', nullif(postalCode, ''), nullif(city, '')), ''),
    'Adresse non renseignée') AS address,
  price, CAST(trunc({_ROOMS}) AS INT) AS rooms, surface, coalesce(nullif(trim(floor), ''), '—') AS floor, {_TAGS_SQL} AS tags,
  75.0 AS score, coalesce(photo, 'https://picsum.photos/seed/' || substr(sha256(url), 1, 16) || '/800/600') AS imageUrl,
  round(lat, 6) AS lat, round(lon, 6) AS lon,
  (SELECT {_SOURCE_SQL} FROM (SELECT lower(coalesce(nullif(source, ''), url)) AS s)) AS source, url, {_REASON} AS reject_reason FROM geo)"""
_FIELDS = "id, title, address, price, rooms, surface, floor, tags, CAST(score AS DOUBLE) AS score, imageUrl, lat, lon, source, url"


def _flat(df):
    return df.withColumns({
        "tags": F.concat_ws(",", "tags"), "lat": F.round("lat", 6), "lon": F.round("lon", 6),
    })


@case("geocode_by_table", f"WITH {GEO} SELECT url, round(lat, 6) AS lat, round(lon, 6) AS lon FROM geo")
def _(spark, sf):
    from terroir.functions import constants as K

    rows = [(key, lat, lon, place) for place, (key, lat, lon, _) in enumerate(K.CENTROIDS)]
    df = L.geocode_by_table(raw_listings(spark, sf), spark.createDataFrame(rows, "key string, lat double, lon double, place int"))
    return df.select("url", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@case("listing_normalize", f"WITH {NORMALIZED} SELECT {_FIELDS} FROM normalized WHERE reject_reason IS NULL")
def _(spark, sf):
    valid, _ = L.split_rejects(L.normalize_listings(raw_listings(spark, sf)))
    return _flat(valid)


@case("listing_reject_split", f"WITH {NORMALIZED} SELECT url, coalesce(reject_reason, 'valid') AS verdict FROM normalized")
def _(spark, sf):
    valid, rejected = L.split_rejects(L.normalize_listings(raw_listings(spark, sf)))
    accepted = valid.select("url", F.lit("valid").alias("verdict"))
    return accepted.unionByName(rejected.select("url", F.col("reject_reason").alias("verdict")))


_ROWS = "CASE WHEN p_size % 4 = 0 THEN concat('1 ', CAST(100 + p_partkey % 900 AS STRING), ',', CAST(p_size AS STRING), ' €/mois') WHEN p_size % 4 = 1 THEN CAST(p_retailprice AS STRING) WHEN p_size % 4 = 2 THEN 'sur demande' END"


@case("raw_field_normalize", f"""SELECT p_partkey,
  TRY_CAST(nullif(regexp_extract(replace(regexp_replace(coalesce({_ROWS}, CAST(p_retailprice AS STRING)), '[^0-9,.-]', '', 'g'), ',', '.'),
    '^[+-]?[0-9]+\\.?[0-9]*'), '') AS DOUBLE) AS price,
  CAST(p_size AS DOUBLE) AS surface, trim(p_name) AS title,
  CASE p_size % 6 WHEN 0 THEN 'appartement' WHEN 1 THEN 'maison' WHEN 2 THEN 'studio' WHEN 3 THEN 'maison' WHEN 4 THEN 'autre' END AS type,
  CASE WHEN upper(trim(substr('abcXdefgH', CAST(1 + p_partkey % 9 AS INT), 1))) IN ('A', 'B', 'C', 'D', 'E', 'F', 'G')
       THEN upper(substr('abcXdefgH', CAST(1 + p_partkey % 9 AS INT), 1)) END AS dpe FROM part""")
def _(spark, sf):
    from .base import table

    df = table(spark, sf, "part")
    raw = df.select(
        "p_partkey", F.expr(_ROWS).alias("prix"), F.col("p_retailprice").alias("loyer"), F.col("p_size").alias("superficie"),
        F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("title"),
        F.expr("""CASE p_size % 6 WHEN 0 THEN concat('Bel APPARTEMENT ', p_name) WHEN 1 THEN 'maison de ville' WHEN 2 THEN 'Studio meublé'
          WHEN 3 THEN 'Villa' WHEN 4 THEN p_name END""").alias("bien_type"),
        F.expr("concat(' ', substr('abcXdefgH', CAST(1 + p_partkey % 9 AS INT), 1))").alias("energyClassification"),
    )
    return L.normalize_raw_fields(raw, keep=["p_partkey"]).select("p_partkey", "price", "surface", "title", "type", "dpe")


_COMMUNES = """communes AS (SELECT insee_code AS code, concat('Commune ', insee_code) AS label,
  round(max(price_m2_median), 2) - 1100 AS price_m2 FROM prices WHERE property_type = 'apartments' GROUP BY insee_code)"""
_VARIANTS = "variants(rooms, surface, suffix, name) AS (VALUES (1, 28.0, 'studio', 'Studio'), (2, 48.0, 't2', 'T2'), (3, 68.0, 't3', 'T3'))"


def _communes(spark, sf):
    prices = view(spark, sf, "prices").where("property_type = 'apartments'")
    return prices.groupBy(F.col("insee_code").alias("code")).agg(
        (F.round(F.max("price_m2_median"), 2) - 1100).alias("price_m2")
    ).withColumn("label", F.concat(F.lit("Commune "), "code"))


@case("market_to_listings", f"""WITH {_COMMUNES}, {_VARIANTS}
SELECT substr(sha256('https://dvf.data.gouv.fr/commune/' || code || '/' || suffix), 1, 16) AS id,
  name || ' — ' || label AS title, greatest(400.0, floor(price_m2 * CAST(surface AS DOUBLE) / 180 + 0.5)) AS price, rooms,
  CAST(surface AS DOUBLE) AS surface, code || ' · ' || label AS address, 'DVF,Marché local' AS tags, 'dvf' AS source
FROM communes CROSS JOIN variants WHERE price_m2 > 0""")
def _(spark, sf):
    df = L.market_records(_communes(spark, sf))
    return df.select("id", "title", "price", "rooms", "surface", "address", F.concat_ws(",", "tags").alias("tags"), "source")


@case("filter_listings", f"""WITH {LISTED} SELECT id, price, rooms FROM listed
 WHERE city = 'paris' AND lower(source) = 'seloger' AND price >= 900 AND price <= 2000 AND rooms >= 2""")
def _(spark, sf):
    f = L.ListingFilter.parse({"city": " Paris ", "source": "SeLoger", "minPrice": "900", "maxPrice": 2000, "minRooms": "2"})
    return L.filter_listings(view(spark, sf, "listings"), f).select("id", "price", "rooms")


@case("text_search", f"""WITH {LISTED} SELECT id, title FROM listed
 WHERE contains(lower(concat_ws(' ', title, address, city)), 'ring')""")
def _(spark, sf):
    return L.text_search(view(spark, sf, "listings"), "RING").select("id", "title")


@case("paginate", """SELECT id, price, (SELECT count(*) FROM listings WHERE price >= 900) AS total FROM listings
 WHERE price >= 900 ORDER BY price, id LIMIT 200 OFFSET 40""")
def _(spark, sf):
    limit, offset = L.parse_pagination({"limit": "500", "offset": 40})
    chosen = L.filter_listings(view(spark, sf, "listings"), L.ListingFilter(min_price=900))
    return L.paginate(chosen, ["price", "id"], limit, offset).select("id", "price", "total")


# Walks four pages by the last row of each: together they are the first rows in order.
@case("paginate_after", "SELECT id, price FROM listings WHERE price >= 900 ORDER BY price, id LIMIT 200")
def _(spark, sf):
    chosen = L.filter_listings(view(spark, sf, "listings"), L.ListingFilter(min_price=900)).select("id", "price")
    pages, last = [], None
    for _ in range(4):
        pages.append(L.page_after(chosen, ["price", "id"], last, 50))
        end = pages[-1].agg(F.max(F.struct("price", "id")).alias("end")).first()["end"]
        last = [end["price"], end["id"]] if end else last
    out = pages[0]
    for page in pages[1:]:
        out = out.union(page)
    return out


@case("price_per_m2", """SELECT url, CASE WHEN surface > 0 THEN round(price / surface, 6) END AS price_m2,
 CASE WHEN surface > 0 THEN CAST(floor(price / surface + 0.5) AS BIGINT) END AS price_m2_display FROM raw_listings""")
def _(spark, sf):
    df = L.with_price_per_m2(raw_listings(spark, sf))
    return df.select("url", F.round("price_m2", 6).alias("price_m2"), "price_m2_display")


def _winner(a: str, b: str, higher: bool) -> str:
    test = f"{a} > {b}" if higher else f"{a} < {b}"
    return f"CASE WHEN {a} IS NULL OR {b} IS NULL OR {a} = {b} THEN 'equal' WHEN {test} THEN 'a' ELSE 'b' END"


_RATIO = "CASE WHEN {0}.surface > 0 THEN {0}.price / {0}.surface END"


@case("compare_pairs", f"""WITH numbered AS (SELECT r.*, p_partkey AS k FROM part JOIN raw_listings r
   ON r.url = concat('https://www.example.com/annonces/', CAST(p_partkey AS STRING), '?é=', p_name)),
 won AS (SELECT a.url AS a_key, b.url AS b_key,
  {_winner('a.price', 'b.price', False)} AS prix, {_winner('a.surface', 'b.surface', True)} AS surface,
  {_winner('a.rooms', 'b.rooms', True)} AS pieces, {_winner('a.bedrooms', 'b.bedrooms', True)} AS chambres,
  {_winner(_RATIO.format('a'), _RATIO.format('b'), False)} AS prix_m2, {_winner('a.charges', 'b.charges', False)} AS charges,
  {_winner('a.dpe', 'b.dpe', False)} AS dpe, {_winner('a.ges', 'b.ges', False)} AS ges
  FROM numbered a JOIN numbered b ON b.k = a.k + 1)
SELECT a_key, b_key, criterion, winner FROM (
  SELECT a_key, b_key, unnest(['Prix', 'Surface', 'Pièces', 'Chambres', 'Prix/m²', 'Étage', 'Charges', 'Dépôt de garantie', 'DPE', 'GES',
    'Ascenseur', 'Parking', 'Cave', 'Balcon', 'Terrasse', 'Meublé']) AS criterion,
   unnest([prix, surface, pieces, chambres, prix_m2, 'none', charges, 'equal', dpe, ges,
    'none', 'none', 'none', 'none', 'none', 'none']) AS winner FROM won)""")
def _(spark, sf):
    from .base import table

    raw = raw_listings(spark, sf)
    keys = table(spark, sf, "part").select(
        "p_partkey", F.expr("concat('https://www.example.com/annonces/', CAST(p_partkey AS STRING), '?é=', p_name)").alias("url")
    )
    pairs = keys.select("p_partkey", F.col("url").alias("a_key")).join(
        keys.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("url").alias("b_key")), "p_partkey"
    ).drop("p_partkey")
    return L.compare_pairs(pairs, raw).select("a_key", "b_key", "criterion", "winner")




# Writes with an id alone, a url alone, both, and an id that changes under one url: all of a user are one listing.
_WRITES = """SELECT user_id, CASE event_id % 4 WHEN 1 THEN NULL WHEN 3 THEN concat('v', CAST(user_id AS STRING)) ELSE concat('u', CAST(user_id AS STRING)) END AS id,
 CASE WHEN event_id % 4 > 0 THEN concat('https://x.example/', CAST(user_id AS STRING)) END AS url, value AS price, event_id AS seq FROM events
 UNION ALL SELECT user_id, concat('u', CAST(user_id AS STRING)), concat('https://x.example/', CAST(user_id AS STRING)), 0e0, -1 FROM events WHERE event_id % 5 = 0"""


# The writes replayed in order per user (a user's ids and urls are never shared with another): a write replaces the
# first listing in the store that holds its id or url at that moment, or is appended.
@case("upsert_listings", f"""WITH RECURSIVE w AS (SELECT user_id, nullif(id, '') AS id, nullif(url, '') AS url, price, seq,
   row_number() OVER (PARTITION BY user_id ORDER BY seq, hash(id, url, price, seq)) AS step FROM ({_WRITES})),
 state(user_id, step, store) AS (SELECT user_id, 0, list_filter([{{'id': any_value(id), 'url': any_value(url), 'price': any_value(price),
   'seq': any_value(seq)}}], lambda x: false) FROM w GROUP BY user_id
  UNION ALL SELECT s.user_id, s.step + 1, CASE WHEN m.at IS NULL THEN list_append(s.store, {{'id': w.id, 'url': w.url, 'price': w.price, 'seq': w.seq}})
    ELSE list_transform(s.store, lambda e, i: CASE WHEN i = m.at THEN {{'id': w.id, 'url': w.url, 'price': w.price, 'seq': w.seq}} ELSE e END) END
  FROM state s JOIN w ON w.user_id = s.user_id AND w.step = s.step + 1,
  LATERAL (SELECT list_filter(list_transform(s.store, lambda e, i: CASE WHEN e.id = w.id OR e.url = w.url THEN i END), lambda x: x IS NOT NULL)[1] AS at) m),
 final AS (SELECT unnest(store) AS l FROM state s WHERE step = (SELECT max(step) FROM w WHERE w.user_id = s.user_id))
 SELECT l.id AS id, l.url AS url, l.price AS price, l.seq AS seq FROM final WHERE l.seq >= 0""")
def _(spark, sf):
    from .base import table

    table(spark, sf, "events").createOrReplaceTempView("events")
    return keyed.upsert_listings(spark.sql(_WRITES).drop("user_id"), ["seq"]).where("seq >= 0")


@case("insert_if_absent", """SELECT id, price, source FROM (SELECT id, price, source, row_number() OVER (PARTITION BY id ORDER BY price DESC) AS rn FROM (
 SELECT id, price, source FROM listings UNION ALL SELECT id, price + 1, 'again' FROM listings WHERE rooms > 2))
 WHERE rn = 1 AND id NOT IN (SELECT lpad(CAST(o_custkey AS STRING), 10, '0') FROM orders)""")
def _(spark, sf):
    from .base import table

    taken = table(spark, sf, "orders").select(F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("id"))
    listings = view(spark, sf, "listings").select("id", "price", "source")
    repeated = listings.join(view(spark, sf, "listings").where("rooms > 2").select("id"), "id", "left_semi")
    new = listings.union(repeated.select("id", F.col("price") + 1, F.lit("again"))).withColumn("order", -F.col("price"))
    return keyed.insert_if_absent(taken, new, order=["order"]).select("id", "price", "source")


@case("latest_per_key", """SELECT insee_code, year, population FROM (
  SELECT *, row_number() OVER (PARTITION BY insee_code ORDER BY year DESC) AS rn FROM census) WHERE rn = 1""")
def _(spark, sf):
    return keyed.latest_per_key(view(spark, sf, "census"), ["insee_code"]).select("insee_code", "year", "population")


@case("department_from_insee", """SELECT DISTINCT postalCode,
  CASE WHEN regexp_matches(postalCode, '^(97[1-8]|98[47])[0-9]{2}$') THEN substr(postalCode, 1, 3) ELSE substr(postalCode, 1, 2) END AS department
 FROM raw_listings""")
def _(spark, sf):
    df = view(spark, sf, "raw_listings").select("postalCode").distinct()
    return df.withColumn("department", codes.department_from_insee(F.col("postalCode")))


@case("title_parse", """WITH titled AS (SELECT p_partkey, concat(CASE WHEN p_size % 4 = 0 THEN 'Appartement' WHEN p_size % 4 = 1 THEN 'Maison'
   WHEN p_size % 4 = 2 THEN 'Studio' ELSE 'Local' END, ' à louer ', CASE WHEN p_size % 3 = 0 THEN concat('T', CAST(p_size % 9 AS STRING))
   WHEN p_size % 3 = 1 THEN concat(CAST(p_size % 9 AS STRING), ' pièces') ELSE '' END, ' ', CAST(p_size AS STRING), ',5 m² 1 ',
   CAST(100 + p_partkey % 900 AS STRING), ' € ', p_name, ' Lyon (', lpad(CAST(69000 + p_partkey % 9 AS STRING), 5, '0'), ')') AS title FROM part)
 SELECT p_partkey, TRY_CAST(replace(regexp_extract(title, '([0-9]+(?:[,.][0-9]+)?)\\s*m[²2]', 1), ',', '.') AS DOUBLE) AS surface,
  TRY_CAST(replace(regexp_extract(title, '([0-9][0-9 ]*)\\s*€', 1), ' ', '') AS DOUBLE) AS price,
  TRY_CAST(coalesce(nullif(regexp_extract(title, '\\b[TF]([0-9])\\b', 1), ''), nullif(regexp_extract(title, '([0-9]+)\\s*pièces?', 1), '')) AS DOUBLE) AS rooms,
  CASE WHEN contains(title, 'Studio') THEN 'studio' WHEN contains(title, 'Appartement') THEN 'appartement' WHEN contains(title, 'Maison') THEN 'maison' END AS type,
  concat(p_name, ' Lyon') AS city, regexp_extract(title, '\\(([0-9]{5})\\)', 1) AS postalCode FROM titled JOIN part USING (p_partkey)""")
def _(spark, sf):
    from terroir.operators.pages import parse_titles

    from .base import table

    title = F.expr("""concat(CASE WHEN p_size % 4 = 0 THEN 'Appartement' WHEN p_size % 4 = 1 THEN 'Maison'
   WHEN p_size % 4 = 2 THEN 'Studio' ELSE 'Local' END, ' à louer ', CASE WHEN p_size % 3 = 0 THEN concat('T', CAST(p_size % 9 AS STRING))
   WHEN p_size % 3 = 1 THEN concat(CAST(p_size % 9 AS STRING), ' pièces') ELSE '' END, ' ', CAST(p_size AS STRING), ',5 m² 1 ',
   CAST(100 + p_partkey % 900 AS STRING), ' € ', p_name, ' Lyon (', lpad(CAST(69000 + p_partkey % 9 AS STRING), 5, '0'), ')')""")
    df = parse_titles(table(spark, sf, "part").select("p_partkey", title.alias("title")))
    return df.select("p_partkey", "surface", "price", "rooms", "type", "city", "postalCode")


_DESCRIPTIONS = """concat(CASE p_partkey % 3 WHEN 0 THEN 'Sans ASCENSEUR, ' WHEN 1 THEN 'ascenseur ' ELSE '' END, CASE p_partkey % 4 WHEN 0 THEN 'Parking ' WHEN 1 THEN 'garage ' ELSE p_name END,
 CASE WHEN p_partkey % 5 < 2 THEN ' Cave' ELSE ' ' END, CASE WHEN p_size % 2 = 0 THEN ' balcon' ELSE '' END, CASE WHEN p_size % 3 = 0 THEN ' Terrasse ' ELSE ' ' END,
 CASE p_size % 5 WHEN 0 THEN 'non meublé' WHEN 1 THEN 'Meublé' ELSE '' END, CASE p_partkey % 7 WHEN 0 THEN ' au 3e étage' WHEN 1 THEN ' rez-de-chaussée' WHEN 2 THEN ' 12 étage' ELSE '' END)"""


@case("amenity_flags_from_text", f"""WITH d AS (SELECT p_partkey AS doc_id, lower({_DESCRIPTIONS}) AS t FROM part)
 SELECT doc_id, CASE WHEN contains(t, 'sans ascenseur') THEN false WHEN contains(t, 'ascenseur') THEN true END AS elevator,
  CASE WHEN contains(t, 'parking') OR contains(t, 'garage') THEN true END AS parking,
  CASE WHEN contains(t, 'cave') THEN true END AS cellar, CASE WHEN contains(t, 'balcon') THEN true END AS balcony,
  CASE WHEN contains(t, 'terrasse') THEN true END AS terrace,
  CASE WHEN contains(t, 'non meublé') THEN false WHEN contains(t, 'meublé') THEN true END AS furnished,
  nullif(trim(regexp_extract(t, '\\b[0-9]+(?:er|ème|e)?\\s*étage\\b|rez[- ]de[- ]chaussée')), '') AS floor FROM d""")
def _(spark, sf):
    from .base import table

    df = table(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), F.expr(_DESCRIPTIONS).alias("description"))
    return df.select("doc_id", *[c.alias(n) for n, c in text.amenity_flags(F.col("description")).items()])



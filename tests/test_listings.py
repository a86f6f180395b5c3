import math

import pytest
from pyspark.sql import functions as F

from terroir import schemas
from terroir.functions import constants as K
from terroir.functions import listing, numbers, text
from terroir.operators import keyed
from terroir.operators import listings as L

LISTINGS = [
    ("a", "Paris A", "75008 · Champs-Élysées, Paris", 2000.0, 2, 50.0, 48.87, 2.31, "seloger"),
    ("b", "Paris B", "75008 · Champs-Élysées, Paris", 2100.0, 2, 52.0, 48.86, 2.32, "seloger"),
    ("c", "Lyon", "69001 · Lyon", 1200.0, 2, 50.0, 45.76, 4.84, "seloger"),
]
SCHEMA = "id string, title string, address string, price double, rooms int, surface double, lat double, lon double, source string"
RAW = {
    "url": "https://www.seloger.com/annonces/123", "source": "seloger", "scrapedAt": "2026-01-01T00:00:00Z", "title": "T3 lumineux",
    "price": 1200.0, "rooms": 3.0, "surface": 65.0, "city": "Lyon", "postalCode": "69003", "lat": 45.75, "lon": 4.85,
    "floor": "3e ét.", "furnished": True, "balcony": True, "dpe": "C", "photos": ["https://cdn.example.com/photo1.jpg"],
}


@pytest.fixture
def listings(spark):
    return spark.createDataFrame(LISTINGS, SCHEMA)


def raw(spark, *changes):
    rows = [tuple({**RAW, **c}.get(n) for n in schemas.RAW_LISTING.names) for c in (changes or ({},))]
    return spark.createDataFrame(rows, schemas.RAW_LISTING)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_city_from_address(spark):
    df = spark.createDataFrame([("75008 · Champs-Élysées, Paris",), ("33700 · Mérignac",), ("x, Foo ",), (None,)], "a string")
    assert [r.c for r in df.select(listing.city_from_address(F.col("a")).alias("c")).collect()] == ["paris", "bordeaux", "foo", None]


def test_filter_parse_ignores_blank_and_text_numbers():
    assert L.ListingFilter.parse({"city": " Paris ", "source": "SeLoger"}) == L.ListingFilter(city="paris", source="seloger")
    assert L.ListingFilter.parse({"q": "  ", "minPrice": "abc"}) == L.ListingFilter()


def test_filters(listings):
    assert ids(L.filter_listings(listings, L.ListingFilter(city="paris"))) == ["a", "b"]
    assert ids(L.filter_listings(listings, L.ListingFilter(min_price=2000, max_price=2100))) == ["a", "b"]
    assert ids(L.filter_listings(listings, L.ListingFilter(q="LYON"))) == ["c"]
    assert ids(L.filter_listings(listings, L.ListingFilter(q="[l]yon"))) == []


def test_pagination(listings):
    assert L.parse_pagination({"limit": "500"}) == (200, 0)
    assert L.parse_pagination({"limit": "0", "offset": "-3"}) == (None, 0)
    page = L.paginate(listings, ["id"], 2, 1).collect()
    assert [(r.id, r.total) for r in page] == [("b", 3), ("c", 3)]
    assert L.paginate(listings, ["id"], None, 2).count() == 3


def test_pages_by_order_statistics(spark):
    import random

    rng = random.Random(3)
    rows = [(f"i{k:05d}", rng.choice([None, *range(40)]) if k % 3 else 7, rng.random()) for k in range(20_000)]
    df = spark.createDataFrame(rows, "id string, price int, x double")
    full = sorted(rows, key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[0]))
    for offset, limit in ((0, 10), (6_000, 50), (13_333, 200), (19_990, 50), (25_000, 5)):
        page = L.paginate(df, ["price", "id"], limit, offset).collect()
        assert [(r.id, r.price) for r in page] == [(r[0], r[1]) for r in full[offset : offset + limit]]
        assert all(r.total == 20_000 for r in page)
    # A deep page sorts its slices only: rows of values spread evenly, 256 slices.
    even = spark.range(100_000).select(F.col("id").cast("string").alias("id"), F.col("id").alias("price"))
    ranged = L.page_slices(even, "price")
    sizes = {r["_slice"]: r["count"] for r in ranged.groupBy("_slice").count().collect()}
    assert max(sizes.values()) < 2_000 and len(sizes) > 100
    assert [r.price for r in L.paginate(even, ["price", "id"], 20, 77_000).collect()] == list(range(77_000, 77_020))


def test_normalize(spark):
    row = L.split_rejects(L.normalize_listings(raw(spark)))[0].first()
    assert (row.title, row.price, row.rooms, row.surface, row.source, row.lat) == ("T3 lumineux", 1200.0, 3, 65.0, "seloger", 45.75)
    assert row.tags == ["Meublé", "Balcon", "DPE C"] and len(row.id) == 16
    assert row.imageUrl == "https://cdn.example.com/photo1.jpg"


def test_rejects_in_order(spark):
    changes = [
        {"price": None, "rooms": None}, {"rooms": None, "bedrooms": 0.0}, {"surface": 0.0},
        {"lat": None, "lon": None, "city": "VilleInconnueXYZ", "postalCode": None}, {"rooms": None, "bedrooms": 2.0},
    ]
    rows = L.normalize_listings(raw(spark, *changes)).select("reject_reason").collect()
    want = [K.REJECT_REASONS[n] for n in ("price", "rooms", "surface", "coordinates")] + [None]
    assert [r.reject_reason for r in rows] == want


def test_geocode_city_and_code(spark):
    df = raw(spark, {"lat": None, "lon": None}, {"lat": None, "lon": None, "city": None, "postalCode": "28185"})
    lyon, code = L.geocode_fallback(df).select("lat", "lon").collect()
    assert abs(lyon.lat - 45.76) < 0.05 and abs(lyon.lon - 4.84) < 0.05
    assert 41 < code.lat < 52 and -6 < code.lon < 10


def python_hash(text):
    value, units = 0, text.encode("utf-16-be")
    for i in range(0, len(units), 2):
        value = (value * 31 + int.from_bytes(units[i:i + 2], "big") + 2**31) % 2**32 - 2**31
    return value


def test_rolling_hash_wraps_like_32_bits(spark):
    texts = ["28185", "https://www.example.com/annonces/1?é=à", "h😀x", "", "z" * 300]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.h for r in df.select(numbers.rolling_hash(F.col("t")).alias("h")).collect()] == [python_hash(t) for t in texts]


def test_jitter_sign_of_remainder(spark):
    h = python_hash("z" * 300)
    df = spark.createDataFrame([(h,), (-1234567,)], "h bigint")
    dx, dy = numbers.jitter_offsets(F.col("h"))
    rows = df.select(dx.alias("dx"), dy.alias("dy")).collect()
    assert rows[1].dx == pytest.approx((math.fmod(-1234567, 1000) - 500) / 50000)
    assert rows[1].dy == pytest.approx((math.fmod(-1234567 >> 10, 1000) - 500) / 50000)


def test_french_numbers(spark):
    df = spark.createDataFrame([("1 550,50 €",), ("abc",), ("-3.",), ("12.5.6",), (None,)], "s string")
    values = [r.n for r in df.select(numbers.parse_number_fr(F.col("s")).alias("n")).collect()]
    assert values == [1550.5, None, -3.0, 12.5, None]


def test_market_listings(spark):
    communes = spark.createDataFrame([("01004", "Ambérieu", 2500.0), ("01005", "Zéro", 0.0), ("1", None, 10.0)],
                                     "code string, label string, price_m2 double")
    rows = {r.url.split("/commune/")[1]: r for r in L.market_listings(communes).collect()}
    assert set(rows) == {f"{c}/{v}" for c in ("01004", "1") for v in ("studio", "t2", "t3")}
    assert rows["01004/t2"].price == 667.0 and rows["1/t3"].price == 400.0
    assert rows["01004/studio"].title == "Studio — Ambérieu" and rows["1/t2"].postalCode is None
    assert L.market_records(communes, limit=1).select("source").distinct().collect()[0].source == "dvf"


def test_upsert_last_write_wins(spark):
    writes = spark.createDataFrame([("a", "u1", 1.0, 1), ("b", "u1", 2.0, 3), ("c", None, 3.0, 2), ("c", "", 4.0, 4)],
                                   "id string, url string, price double, seq int")
    assert sorted(r.price for r in keyed.upsert_listings(writes, ["seq"]).collect()) == [2.0, 4.0]


def test_compare_pairs(spark):
    df = raw(spark, {"url": "x", "price": 900.0, "dpe": "B", "charges": None}, {"url": "y", "dpe": "D", "surface": 65.0})
    pairs = spark.createDataFrame([("x", "y")], "a_key string, b_key string")
    won = {r.criterion: r.winner for r in L.compare_pairs(pairs, df).collect()}
    assert len(won) == 16
    assert (won["Prix"], won["Surface"], won["DPE"], won["Charges"], won["Étage"], won["Prix/m²"]) == ("a", "equal", "a", "equal", "none", "a")


def test_amenities_three_valued(spark):
    df = spark.createDataFrame([("3ème étage sans ascenseur, cave, non meublé",), ("Rez-de-chaussée meublé, garage",), (None,)], "d string")
    rows = df.select(*[c.alias(n) for n, c in text.amenity_flags(F.col("d")).items()]).collect()
    assert (rows[0].elevator, rows[0].cellar, rows[0].furnished, rows[0].parking, rows[0].floor) == (False, True, False, None, "3ème étage")
    assert (rows[1].furnished, rows[1].parking, rows[1].floor) == (True, True, "rez-de-chaussée")
    assert all(v is None for v in rows[2])

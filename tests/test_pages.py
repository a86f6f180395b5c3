import json

from terroir.functions import html as H
from terroir.operators import pages as P
from pyspark.sql import functions as F


def pages(spark, *rows):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id int, url string, html string")


def links(spark, url, html, **options):
    return [r.listing_url for r in P.discover_links(pages(spark, (url, html)), **options).orderBy("position").collect()]


def test_site_links(spark):
    html = '<a href="/annonces/locations/appartement-paris-18eme-75/123456789.htm">A</a><a href="/recherche">Search</a>'
    assert links(spark, "https://www.seloger.com/list.htm?projects=1", html) == [
        "https://www.seloger.com/annonces/locations/appartement-paris-18eme-75/123456789.htm"]
    html = '<a href="https://www.leboncoin.fr/ad/locations/1234567890">A</a>'
    assert links(spark, "https://www.leboncoin.fr/recherche", html) == ["https://www.leboncoin.fr/ad/locations/1234567890"]
    assert links(spark, "https://other.example/", html) == []


def test_link_rules(spark):
    html = """<!-- <a href="/ad/9">x</a> --><script>"<a href='/ad/8'>"</script><a class=b href='../ad/1?x=1&amp;y=2#f'>1</a><a href=/ad/2>2</a>
      <a href="#/ad/3">3</a><a href="javascript:/ad/4">4</a><a href="//pro.leboncoin.fr/ad/5">5</a><a href="https://evil.example/ad/6">6</a>
      <a href="?p=/ad/7">7</a><a href="/ad/2#again">2</a><a href="/ad/10/é">10</a>"""
    got = links(spark, "https://www.leboncoin.fr/a/b", html)
    assert got == ["https://www.leboncoin.fr/ad/1?x=1&y=2", "https://www.leboncoin.fr/ad/2", "https://pro.leboncoin.fr/ad/5",
                   "https://www.leboncoin.fr/ad/10/%C3%A9"]
    assert links(spark, "https://www.leboncoin.fr/a/b", html, per_page=2) == got[:2]


def test_titles(spark):
    df = spark.createDataFrame([
        ("Appartement à louer T2/F2 44 m² 1550 € Georges Brassens Paris (75015)",),
        ("Maison à vendre 5 pièces 120 m² 350 000 € Lyon (69001)",), ("Studio 18,5m2 Saint-Malo (35400)",), (None,)], "title string")
    rows = P.parse_titles(df).collect()
    assert (rows[0].surface, rows[0].price, rows[0].rooms, rows[0].type, rows[0].city, rows[0].postalCode) == (
        44.0, 1550.0, 2.0, "appartement", "Georges Brassens Paris", "75015")
    assert (rows[1].surface, rows[1].price, rows[1].rooms, rows[1].type, rows[1].city) == (120.0, 350000.0, 5.0, "maison", "Lyon")
    assert (rows[2].surface, rows[2].rooms, rows[2].type, rows[2].city) == (18.5, None, "studio", "Saint-Malo")


def test_entities(spark):
    df = spark.createDataFrame([("a &amp;lt; b &eacute;&#233;&#x20AC;&bogus;",)], "t string")
    assert df.select(H.unescape(F.col("t")).alias("u")).first().u == "a &lt; b éé€&bogus;"


SECTIONS = {
    "hardFacts": {"title": "Appartement T3", "price": {"ariaLabel": "1 415 €"}, "facts": [
        {"type": "numberOfRooms", "splitValue": "3", "value": "3 pièces"}, {"type": "livingSpace", "splitValue": "76,23", "value": ""},
        {"type": "numberOfFloors", "splitValue": "", "value": "Étage 3/3"}]},
    "price": {"additional": [{"label": "Dépôt de garantie", "text": "1200,5"}], "components": [{"units": [{"details": [
        {"prices": [{"label": {"main": "Charges forfaitaires"}, "value": {"main": {"ariaLabel": "85 €"}}}]}]}]}]},
    "energy": {"certificates": [{"scales": [{"name": "DPE", "efficiencyClass": {"rating": "D"}}, {"name": "GES", "efficiencyClass": {"rating": "b"}}]}]},
    "features": {"preview": [{"icon": "balcony", "value": "Balcon"}, {"icon": "elevator", "value": "Pas d'ascenseur"},
                             {"icon": "cellar", "value": "Pas de cave"}, {"icon": "furnished", "value": "Non meublé"}]},
    "location": {"address": {"city": "Lyon", "zipCode": "69003"}, "geometry": {"coordinates": [4.85, 45.75]}},
    "gallery": {"images": [{"url": "https://i.example/1.jpg"}, {"url": "data:x"}]},
    "mainDescription": {"description": " Bel \"appartement\" "},
}


def test_double_encoded_state(spark):
    text = json.dumps(json.dumps({"app_cldp": {"data": {"classified": {"sections": SECTIONS}}}}))
    html = f'<script id="__UFRN_LIFECYCLE_SERVERREQUEST__">window["x"]=JSON.parse({text});</script>'
    row = P.page_listings(pages(spark, ("https://www.seloger.com/annonces/1", html))).first()
    assert (row.title, row.type, row.price, row.rooms, row.surface, row.charges, row.deposit) == (
        "Appartement T3", "appartement", 1415.0, 3.0, 76.23, 85.0, 1200.5)
    assert (row.dpe, row.ges, row.balcony, row.cellar, row.furnished, row.elevator) == ("D", "B", True, False, False, True)
    assert (row.city, row.postalCode, row.lat, row.lon, row.floor) == ("Lyon", "69003", 45.75, 4.85, "Étage 3/3")
    assert row.photos == ["https://i.example/1.jpg"] and row.description == 'Bel "appartement"' and row.source == "seloger.com"


def test_layer_order_and_empty_pages(spark):
    state = {"props": {"pageProps": {"ad": {"title": "T", "prices": {}, "characteristics": {"surface": "30"}, "deepest": {"price": "1 200 €"},
                                           "location": {"city": "Nice"}}}}}
    html = f"""<title>Maison T5 99 m² 9 € Lyon (69001)</title><script id="__NEXT_DATA__">{json.dumps(state)}</script>
      <script type="application/ld+json">{{"@type":"House","name":"L","offers":{{"lowPrice":"7"}},"numberOfBedrooms":2,"image":"https://i.example/l"}}</script>
      <script type="application/ld+json">not json</script>"""
    rows = P.page_listings(pages(spark, ("https://www.seloger.com/a", html), ("https://x.example/", "<p>nothing</p>"))).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.title, row.surface, row.city, row.price) == ("T", 30.0, "Nice", 1200.0)
    assert (row.bedrooms, row.rooms, row.postalCode, row.photos) == (2.0, 5.0, "69001", ["https://i.example/l"])


def test_fill_amenities_keeps_known_values(spark):
    df = P.page_listings(pages(spark, ("https://x.example/", '<title>t</title><meta name="description" content="avec ascenseur et cave">')))
    row = P.fill_amenities(df.withColumn("elevator", F.lit(False))).first()
    assert (row.elevator, row.cellar, row.balcony) == (False, True, None)

"""Keyed writes, the shared folder, odd events and what filters reach."""

import json

import pytest
from pyspark.sql import functions as F

from terroir import schemas, session
from terroir.operators import keyed, pages, scoring
from terroir.operators.territory import rollup_prices_unweighted
from terroir.sources import events, sinks


def test_upsert_meets_by_id_or_url(spark):
    writes = [("a", None, 1.0, 1), ("a", "u1", 2.0, 2), ("b", "u1", 3.0, 3), (None, "u2", 4.0, 4), ("c", "u2", 5.0, 5), ("d", None, 6.0, 6), ("e", "", 7.0, 7)]
    df = spark.createDataFrame(writes, "id string, url string, price double, seq int")
    assert sorted(r.price for r in keyed.upsert_listings(df, ["seq"]).collect()) == [3.0, 5.0, 6.0, 7.0]


def walk(writes):
    """The store of the contract: a write replaces the first listing that holds its id or url now, or is appended."""
    store = []
    for w in sorted(writes, key=lambda w: w[3]):
        at = next((k for k, l in enumerate(store) if (w[0] and l[0] == w[0]) or (w[1] and l[1] == w[1])), None)
        if at is None:
            store.append(w)
        else:
            store[at] = w
    return sorted(store, key=lambda w: w[3])


def test_moved_listing_keeps_both(spark):
    rows = [("1", "u1", 1.0, 1), ("1", "u2", 2.0, 2), ("2", "u1", 3.0, 3)]
    got = keyed.upsert_listings(spark.createDataFrame(rows, "id string, url string, price double, seq int"), ["seq"]).collect()
    assert sorted(tuple(r) for r in got) == [("1", "u2", 2.0, 2), ("2", "u1", 3.0, 3)]


def test_replay_equals_walk(spark):
    import random

    rng = random.Random(4)
    pool = lambda p, n: rng.choice([None, "", *[f"{p}{k}" for k in range(n)]])
    writes = [(pool("i", 40), pool("u", 40), float(k), k) for k in range(3000)]
    writes += [("hot", "h", float(k), 3000 + k) for k in range(500)] + [("hot", "h2", 1.0, 3500), ("x", "h", 2.0, 3501)]
    rng.shuffle(writes)
    got = keyed.upsert_listings(spark.createDataFrame(writes, "id string, url string, price double, seq int"), ["seq"]).collect()
    assert sorted((tuple(r) for r in got), key=lambda w: w[3]) == walk(writes)


def test_long_chain_is_one_listing(spark):
    rows = [(f"i{k // 2}", f"u{(k + 1) // 2}", k) for k in range(60)]
    assert keyed.upsert_listings(spark.createDataFrame(rows, "id string, url string, seq int"), ["seq"]).collect() == [("i29", "u30", 59)]


def test_insert_takes_one_row_per_new_id(spark):
    old = spark.createDataFrame([("a", 1)], "id string, x int")
    new = spark.createDataFrame([("a", 2), ("b", 4), ("b", 3), ("c", 5), ("c", 5)], "id string, x int")
    assert sorted(keyed.insert_if_absent(old, new).collect()) == [("b", 3), ("c", 5)]
    assert sorted(keyed.insert_if_absent(old, new.withColumn("o", -F.col("x")), order=["o"]).drop("o").collect()) == [("b", 4), ("c", 5)]


def test_second_writer_of_a_version_raises(spark, tmp_path):
    root = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    assert sinks.upsert_keyed(one, root, ["k"]).count() == 1
    sinks.claim_version(spark, root, sinks._current(spark, root))
    with pytest.raises(sinks.ConcurrentWrite):
        sinks.upsert_keyed(one, root, ["k"])
    for k in range(5):
        out = sinks.upsert_keyed(spark.createDataFrame([(k, "b")], "k int, v string"), root, ["k"], take_over=True)
    assert sorted(r.k for r in out.collect()) == [0, 1, 2, 3, 4]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v")]) == 3


class _Cluster:
    """A session whose master is no local one and that names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(_Cluster)


def test_release_deletes_stored_tables(spark, tmp_path):
    held, session._WRITTEN[:] = list(session._WRITTEN), []
    df = session.materialize(spark.range(3), "kept")
    path = session._WRITTEN[0]
    assert df.count() == 3 and session.release(spark) == 1
    with pytest.raises(Exception):
        spark.read.parquet(path)
    session._WRITTEN[:] = held


def test_odd_fields_keep_their_message(spark):
    payload = {"url": "https://x/1", "price": "1 300,50", "rooms": 2, "fees": "n/a", "photos": "none", "furnished": "true", "lat": {"a": 1}}
    rows = [(json.dumps({"event": "listing.raw", "timestamp": "t", "payload": payload}),), ("{oops",), ("[1]",), (None,), ('{"event": "listing.raw", "payload": 5}',)]
    parsed = events.parse_events(spark.createDataFrame(rows, "value string"), schemas.RAW_EVENT)
    good = events.of_type(parsed, "listing.raw").select("body.payload.*").collect()
    assert [(r.url, r.price, r.rooms, r.fees, r.photos, r.furnished, r.lat) for r in good] == [
        ("https://x/1", 1300.5, 2.0, None, None, True, None), (None,) * 7]
    assert sorted(r.value for r in events.bad_records(parsed).collect()) == ["[1]", "{oops"]


def test_page_filter_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "pages")
    spark.createDataFrame([(i, f"https://www.leboncoin.fr/{i}", "<title>Studio 20 m² 500 €</title>") for i in range(9)], "page_id long, url string, html string").write.parquet(path)
    one = pages.page_listings(spark.read.parquet(path)).where("page_id = 3")
    one.explain()
    assert "EqualTo(page_id,3)" in capsys.readouterr().out.replace(" ", "")
    assert [(r.page_id, r.price) for r in one.collect()] == [(3, 500.0)]


def test_weight_names(spark):
    assert scoring.live_weights({"prix": 1, "marche": 0}) == {**scoring.K.LIVE_WEIGHTS, "price": 1.0, "market": 0.0}
    with pytest.raises(ValueError, match="loyer"):
        scoring.live_weights({"loyer": 1})


def test_null_property_type_keeps_its_median(spark):
    rows = [(2020, "city", f"0100{i}", None, 10.0, float(i), 1) for i in range(1, 6)]
    facts = spark.createDataFrame(rows, "year int, level string, insee_code string, property_type string, price_m2_avg double, price_m2_median double, mutation_count long")
    assert [r.price_m2_median for r in rollup_prices_unweighted(facts, "department").collect()] == [3.0]

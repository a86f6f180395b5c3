import json

import pytest
from pyspark.sql import functions as F

from terroir import schemas
from terroir.functions import constants as K
from terroir.sources import events as E
from terroir.streaming import jobs as J

from test_listings import RAW


def message(when, **change):
    return json.dumps({"event": "listing.raw", "timestamp": when, "source": "scrape", "payload": {**RAW, **change}})


@pytest.fixture
def topic(tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()

    def add(name, *lines):
        (folder / name).write_text("\n".join(lines) + "\n")

    add.path = str(folder)
    return add


def test_preprocess_restart_and_quarantine(spark, tmp_path, topic):
    paths = J.JobPaths(str(tmp_path / "job"))
    run = lambda: J.preprocess(E.read_topic_files(spark, topic.path, 1), paths)
    topic("1.txt", message("2026-01-01T00:00:02Z", price=1300.0), message("2026-01-01T00:00:01Z"), "{broken", '{"event":"other"}')
    run()
    first = J.current_listings(spark, paths).collect()
    assert [(r.price, r.source) for r in first] == [(1300.0, "seloger")]
    topic("2.txt", message("2026-01-02T00:00:00Z", price=1500.0), message("2026-01-02T00:00:00Z", url="https://x.example/2", price=None))
    run()
    run()
    assert [r.price for r in J.current_listings(spark, paths).collect()] == [1500.0]
    reasons = sorted(r.reason for r in J.quarantined(spark, paths).collect())
    assert reasons == sorted(["invalid JSON", K.REJECT_REASONS["price"]])
    created = J.created_messages(spark, paths)
    assert created.count() == 3
    body = E.of_type(E.parse_events(created, schemas.LISTING_EVENT), K.EVENT_CREATED).select("body.listing.*")
    assert body.schema == schemas.LISTING and body.where("price = 1500").count() == 1


def test_refresh_touches_only_named_cities(spark, tmp_path, topic):
    rows = [("a", "x, Paris"), ("b", "y, Paris"), ("c", "z, Lyon"), ("d", "z, Lyon")]
    listings = spark.createDataFrame(rows, "id string, address string").withColumns(
        {"price": F.lit(1000.0), "surface": F.lit(50.0), "lat": F.lit(48.0), "lon": F.lit(2.0)})
    paths = J.JobPaths(str(tmp_path / "index"))
    run = lambda: J.refresh_index(E.read_topic_files(spark, topic.path), lambda: listings, paths)
    topic("1.txt", json.dumps({"event": "listing.created", "listing": {"id": "a", "address": "x, Paris"}}), '{"event":"listing.url"}')
    run()
    assert {(r.base_id, r.similar_id) for r in J.current_index(spark, paths).collect()} == {("a", "b"), ("b", "a")}
    topic("2.txt", json.dumps({"event": "listings.bootstrapped", "count": 4}))
    run()
    assert J.current_index(spark, paths).count() == 4


def test_running_state_equals_batch(spark, tmp_path):
    long = " logement avec vue sur le port" * 5
    source = tmp_path / "reviews"
    for year, text in ((2020, "calme"), (2020, "sale"), (2021, "super")):
        spark.createDataFrame([(year, text + long)], "year int, review_text string").write.mode("append").parquet(str(source))
    stream = spark.readStream.schema("year int, review_text string").option("maxFilesPerTrigger", 1).parquet(str(source))
    paths = J.JobPaths(str(tmp_path / "state"))
    state = J.sentiment_state(stream)
    J.keep_state(state, paths, "scores")
    got = J.current_state(spark, paths, "scores", state.schema, ["year"]).collect()
    assert {(r.year, r.score_sum, r.score_count) for r in got} == {(2020, 0.0, 2), (2021, 1.0, 1)}


def test_ingestion_event(spark):
    body = E.parse_events(E.ingestion_event(spark.range(3), spark.range(2), "p", 50, ("a", "b")), schemas.INGESTION_EVENT).select("body.*").first()
    assert (body.event, body.scale, body.metrics.dvf_rows, body.metrics.insee_rows, body.paths.dvf_parquet) == (
        "ingestion_completed", "sample", 3, 2, "a")


def test_messages_bounded_by_batch_and_run(spark, tmp_path):
    from terroir.sources.topic_lines import count_lines, read_topic_lines

    topic = tmp_path / "topic"
    topic.mkdir()
    lines = [json.dumps({"k": k}) for k in range(10_000)]
    (topic / "a-000").write_text("\n".join(lines[:6000]) + "\n")
    (topic / "a-001").write_text("\n".join(lines[6000:]))  # no line break at the end
    assert count_lines(str(topic / "a-001"))[0] == 4000
    paths = J.JobPaths(str(tmp_path / "job"))
    each = lambda df, n: J.write_batch(df.select("offset", "value"), paths.table("seen"), n)
    J.run_available(read_topic_lines(spark, str(topic), paths.table("progress"), 700, 2500), each, paths)
    first = spark.read.parquet(paths.table("seen")).collect()
    assert sorted(r.offset for r in first) == list(range(2500))
    J.run_available(read_topic_lines(spark, str(topic), paths.table("progress"), 700), each, paths)
    seen = spark.read.parquet(paths.table("seen"))
    assert sorted(r.offset for r in seen.collect()) == list(range(10_000))
    assert all(json.loads(r.value)["k"] == r.offset for r in seen.collect())
    assert max(r["count"] for r in seen.groupBy("batch").count().collect()) <= 700


def test_consumers_share_a_topic(spark, tmp_path):
    from terroir.sources.topic_lines import read_topic_lines

    topic = tmp_path / "topic"
    topic.mkdir()
    for n in range(5):
        (topic / f"part-{n}").write_text("".join(f"m{n}-{k}\n" for k in range(n * 10)))

    def run(messages=None):
        J.run_consumers([
            (read_topic_lines(spark, str(topic), f"{tmp_path}/{i}/progress", 7, messages, i, 3),
             lambda df, n, i=i: J.write_batch(df.select("offset", "value"), f"{tmp_path}/seen/consumer={i}", n), J.JobPaths(f"{tmp_path}/{i}"))
            for i in range(3)])
        return spark.read.parquet(f"{tmp_path}/seen").collect()

    # Consumer 0 has files 0 and 3, consumer 1 files 1 and 4, consumer 2 file 2: each stops after 9 messages of its own.
    first = run(9)
    assert sorted(r["value"] for r in first) == sorted(f"m{n}-{k}" for n in (1, 2, 3) for k in range(9))
    every = run()
    assert sorted(r["value"] for r in every) == sorted(f"m{n}-{k}" for n in range(5) for k in range(n * 10))
    sizes = {}
    for r in every:
        sizes[r["consumer"], r["batch"]] = sizes.get((r["consumer"], r["batch"]), 0) + 1
    assert max(sizes.values()) <= 7

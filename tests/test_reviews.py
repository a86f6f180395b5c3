import pytest
from pyspark.sql import functions as F

from terroir.functions import text as T
from terroir.operators import reviews as R

LONG = " logement avec vue sur la mer et le port de la ville" * 3


def reviews(spark, *texts, year=2020):
    rows = [(i, "75056", "paris", year, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id int, insee_code string, city_name string, year int, review_text string")


def test_light_sentiment(spark):
    df = reviews(spark, "rien à dire", "calme mais bruyant", "super calme, sale", "agréable", None, "calmement")
    score = lambda fold: [round(r.s, 3) for r in df.select(T.sentiment_light(F.col("review_text"), fold).alias("s")).collect()]
    assert score(False) == [0.0, 0.0, 0.333, 0.0, 0.0, 0.0]
    assert score(True)[3] == 1.0


def test_tokens(spark):
    df = reviews(spark, "L'été, c'est À l'eau! de la x 12")
    assert df.select(T.tokenize_fr(F.col("review_text")).alias("t")).first().t == ["l'été", "c'est", "l'eau"]


def test_documents_with_short_texts_left_out(spark):
    docs = R.sentiment_documents(reviews(spark, "super" + LONG, "sale" + LONG, "super"), n=3).collect()
    assert len(docs) == 1 and docs[0].sentiment_count == 2 and docs[0].sentiment_avg == 0.0
    assert [(t.term, t.freq) for t in docs[0].top_terms] == [("logement", 6), ("mer", 6), ("port", 6)]


def test_review_columns(spark):
    df = spark.createDataFrame([("a", "2020-03-04"), ("b", "bad"), ("c", None)], "comments string, date string")
    assert [r.year for r in R.with_review_columns(df).collect()] == [2020, 0, 0]
    with pytest.raises(ValueError):
        R.pick_columns(["note"])


def test_cap_is_exact(spark):
    df = reviews(spark, *["x"] * 50)
    assert R.cap_texts(df, "id", 20).count() == 20 and R.cap_texts(df, "id", 0).count() == 50


def test_scorer_sees_every_text_in_batches(spark):
    def lengths(texts):
        assert len(texts) <= 2
        return [float(len(t)) for t in texts]

    df = R.with_score(reviews(spark, "a", "bb", "ccc", "dddd", "eeeee"), score=R.scorer(lengths, batch_size=2))
    assert [r.score for r in df.orderBy("id").collect()] == [1.0, 2.0, 3.0, 4.0, 5.0]


def test_hits_of_latest_document(spark):
    docs = R.sentiment_documents(reviews(spark, "calme tramway tranquille" + LONG)).unionByName(
        R.sentiment_documents(reviews(spark, "bruit" + LONG, year=2010)))
    row = R.term_hits(docs, territories=spark.createDataFrame([("75056",), ("1",)], "insee_code string")).orderBy("insee_code").collect()
    assert (row[0].has_nlp, row[0].calm_hits) == (False, 0)
    assert (row[1].has_nlp, row[1].calm_hits, row[1].transport_hits, row[1].activity_hits) == (True, 2, 1, 3)


def test_commune_stands_for_department(spark):
    docs = R.sentiment_documents(reviews(spark, "calme" + LONG))
    table = R.latest_sentiment_table(docs)
    places = spark.createDataFrame([("75",), ("1",)], "insee_code string")
    assert {r.insee_code: r.commune for r in R.sentiment_commune(places, table, "department").collect()} == {"75": "75056", "1": None}
    assert R.sentiment_commune(places, table, "region").where("commune IS NOT NULL").count() == 0

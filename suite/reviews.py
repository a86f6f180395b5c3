"""Review queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from terroir.functions import constants as K
from terroir.functions import text as T
from terroir.operators import reviews as R

from .base import case, near, near_sql, quoted, table, view

TOKENS = f"""list_filter(regexp_extract_all(lower(review_text), '[a-zA-ZÀ-ÖØ-öø-ÿ'']{{2,}}'), lambda w: w NOT IN ({quoted(K.STOPWORDS)}))"""


def _score_sql(positive, negative) -> str:
    pos = f"len(list_filter(tokens, lambda w: w IN ({quoted(positive)})))"
    neg = f"len(list_filter(tokens, lambda w: w IN ({quoted(negative)})))"
    return f"CASE WHEN {pos} + {neg} = 0 THEN 0.0 ELSE CAST({pos} - {neg} AS DOUBLE) / ({pos} + {neg}) END"


SCORE = _score_sql(K.POSITIVE_WORDS, K.NEGATIVE_WORDS)
SCORED = f"""scored AS (SELECT *, {SCORE} AS score FROM (SELECT *, {TOKENS} AS tokens FROM reviews WHERE length(review_text) >= 120))"""
RANKED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY insee_code, city_name, year ORDER BY freq DESC, term) AS rank FROM (
  SELECT insee_code, city_name, year, term, count(*) AS freq FROM (SELECT insee_code, city_name, year, unnest(tokens) AS term FROM scored)
  GROUP BY insee_code, city_name, year, term)),
terms AS (SELECT insee_code, city_name, year, list(term ORDER BY rank) AS words, list(freq ORDER BY rank) AS freqs FROM ranked WHERE rank <= 30
  GROUP BY insee_code, city_name, year),
sentiments AS (SELECT insee_code, city_name, year, avg(score) AS sentiment_avg, count(*) AS sentiment_count FROM scored
  GROUP BY insee_code, city_name, year),
docs AS (SELECT s.*, 'city' AS level, words, freqs FROM sentiments s LEFT JOIN terms t USING (insee_code, city_name, year))"""
DOCS = f"{SCORED}, {RANKED}"


def documents(spark, sf):
    return R.sentiment_documents(view(spark, sf, "reviews"))


@case("filter_min_text", "SELECT doc_id FROM reviews WHERE length(review_text) >= 120")
def _(spark, sf):
    return R.min_text(view(spark, sf, "reviews")).select("doc_id")


@case("tokenize_fr", f"""SELECT doc_id, CAST(len(tokens) AS BIGINT) AS n, array_to_string(tokens, ' ') AS tokens FROM
 (SELECT doc_id, {TOKENS} AS tokens FROM reviews)""")
def _(spark, sf):
    df = view(spark, sf, "reviews").select("doc_id", T.tokenize_fr(F.col("review_text")).alias("t"))
    return df.select("doc_id", F.size("t").cast("bigint").alias("n"), F.array_join("t", " ").alias("tokens"))


# Frequent short words of the table's languages stand in for the lexicon, so that scores differ from zero.
_COMMON_POS, _COMMON_NEG = ("the", "and", "der", "die", "los", "eau"), ("of", "und", "el", "ment", "is", "on")

# Lexicon words put before the texts, by id, as the table's words are invented.
_OPINIONS = f"CASE doc_id % 5 WHEN 0 THEN '{K.POSITIVE_WORDS[0]} {K.NEGATIVE_WORDS[0]} ' WHEN 1 THEN '{K.POSITIVE_WORDS[1].upper()}, ' WHEN 2 THEN '{K.NEGATIVE_WORDS[1]}. {K.POSITIVE_WORDS[2]} {K.NEGATIVE_WORDS[2]} ' WHEN 3 THEN '{K.NEGATIVE_WORDS[3]} ' ELSE '' END"


@case("sentiment_light", f"""SELECT doc_id, round({SCORE}, 6) AS score FROM (SELECT doc_id, {TOKENS} AS tokens FROM
 (SELECT doc_id, concat({_OPINIONS}, review_text) AS review_text FROM reviews))""")
def _(spark, sf):
    texts = view(spark, sf, "reviews").select("doc_id", F.concat(F.expr(_OPINIONS), "review_text").alias("t"))
    return texts.select("doc_id", F.round(T.sentiment_light(F.col("t")), 6).alias("score"))


@case("label_score", """SELECT doc_id, CASE WHEN contains(lower(label), 'pos') THEN score WHEN contains(lower(label), 'neg') THEN -score ELSE 0.0 END AS score
 FROM (SELECT doc_id, CASE quality % 2 WHEN 0 THEN 'NEGATIVE' ELSE CASE WHEN toxic = 1 THEN 'neutral' ELSE 'Positive' END END AS label,
  doc_id % 100 / 100 AS score FROM labels)""")
def _(spark, sf):
    label = F.when(F.col("quality") % 2 == 0, "NEGATIVE").when(F.col("toxic") == 1, "neutral").otherwise("Positive")
    return table(spark, sf, "labels").select("doc_id", T.label_score(label, F.col("doc_id") % 100 / 100).alias("score"))


def _common_scorer():
    positive, negative = _COMMON_POS, _COMMON_NEG

    def score(texts: list[str]) -> list[float]:
        out = []
        for text in texts:
            words = text.lower().split(" ")
            pos = sum(w in positive for w in words)
            neg = sum(w in negative for w in words)
            out.append((pos - neg) / (pos + neg) if pos + neg else 0.0)
        return out

    return score


@case("score_fn_hook", f"""SELECT doc_id, round({_score_sql(_COMMON_POS, _COMMON_NEG)}, 6) AS score FROM
 (SELECT doc_id, string_split(lower(review_text), ' ') AS tokens FROM reviews)""")
def _(spark, sf):
    df = R.with_score(view(spark, sf, "reviews"), score=R.scorer(_common_scorer(), batch_size=64))
    return df.select("doc_id", F.round("score", 6).alias("score"))


@case("sentiment_by_year", f"WITH {SCORED} SELECT year, {near_sql('avg(score)', 6)} AS sentiment_avg, count(*) AS sentiment_count FROM scored GROUP BY year")
def _(spark, sf):
    df = R.sentiment_by_year(R.with_score(R.min_text(view(spark, sf, "reviews"))))
    return df.withColumn("sentiment_avg", near("sentiment_avg", 6))


@case("top_terms", f"WITH {DOCS} SELECT insee_code, city_name, year, term, freq, CAST(rank AS INT) AS rank FROM ranked WHERE rank <= 30")
def _(spark, sf):
    return R.ranked_terms(R.min_text(view(spark, sf, "reviews")), ["insee_code", "city_name", "year"])


@case("sentiment_doc", f"""WITH {DOCS} SELECT level, insee_code, city_name, year, 'fr' AS language, {near_sql('sentiment_avg', 6)} AS sentiment_avg,
 sentiment_count, array_to_string(words, ' ') AS terms, array_to_string(freqs, ' ') AS freqs, 'Inside Airbnb (POC)' AS source, 'light' AS nlp_mode FROM docs""")
def _(spark, sf):
    return documents(spark, sf).select(
        "level", "insee_code", "city_name", "year", "language", near("sentiment_avg", 6).alias("sentiment_avg"), "sentiment_count",
        F.array_join("top_terms.term", " ").alias("terms"),
        F.array_join(F.col("top_terms.freq").cast("array<string>"), " ").alias("freqs"), "source", "nlp_mode",
    )


@case("aggregate_sentiment", f"WITH {SCORED} SELECT {near_sql('coalesce(avg(score), 0)', 6)} AS sentiment_avg, count(*) AS sentiment_count FROM scored")
def _(spark, sf):
    df = R.aggregate_sentiment(R.with_score(R.min_text(view(spark, sf, "reviews"))))
    return df.withColumn("sentiment_avg", near("sentiment_avg", 6))


@case("cap_texts", """SELECT doc_id, length(review_text) AS chars FROM reviews
 ORDER BY md5(concat('42:', CAST(doc_id AS STRING))) LIMIT 500""")
def _(spark, sf):
    kept = R.cap_texts(view(spark, sf, "reviews"), "doc_id", 500)
    return kept.select("doc_id", F.length("review_text").cast("bigint").alias("chars"))


_CITIES = {f"src{i}": f"{1000 * (1 + i):05d}" for i in (0, 3, 9, 12, 17)}
_LISTED = f"""latest AS (SELECT *, row_number() OVER (PARTITION BY insee_code ORDER BY year DESC) AS rn FROM docs),
listed AS (SELECT insee_code AS insee_code_city, substr(insee_code, 1, 2) AS insee_code_department, city_name, sentiment_avg, sentiment_count,
  year AS nlp_year FROM latest WHERE rn = 1 AND insee_code IN ({quoted(_CITIES.values())}))"""
LATEST = f"{DOCS}, {_LISTED}"


def latest_table(spark, sf):
    return R.latest_sentiment_table(documents(spark, sf), _CITIES)


@case("sentiment_latest_table", f"""WITH {LATEST} SELECT t.insee_code, l.insee_code_city AS commune, city_name, {near_sql('sentiment_avg', 6)} AS sentiment_avg,
 sentiment_count, nlp_year FROM (SELECT DISTINCT substr(insee_code, 1, 2) AS insee_code FROM census) t LEFT JOIN listed l ON t.insee_code = insee_code_department""")
def _(spark, sf):
    latest = latest_table(spark, sf)
    departments = view(spark, sf, "census").select(F.substring("insee_code", 1, 2).alias("insee_code")).distinct()
    proxied = R.sentiment_commune(departments, latest, "department")
    df = proxied.join(latest.withColumnRenamed("insee_code_city", "commune"), "commune", "left")
    return df.select("insee_code", "commune", "city_name", near("sentiment_avg", 6).alias("sentiment_avg"), "sentiment_count", "nlp_year")


@case("sentiment_by_department", f"""WITH {DOCS} SELECT substr(insee_code, 1, 2) AS insee_code, {near_sql('avg(sentiment_avg)', 6)} AS sentiment_avg FROM
 (SELECT *, row_number() OVER (PARTITION BY insee_code ORDER BY year DESC) AS rn FROM docs) WHERE rn = 1 GROUP BY substr(insee_code, 1, 2)""")
def _(spark, sf):
    latest = R.latest_documents(documents(spark, sf)).withColumn("insee_code_department", F.substring("insee_code", 1, 2))
    df = R.sentiment_by_department(latest)
    return df.withColumn("sentiment_avg", near("sentiment_avg", 6))


@case("sentiment_catalog", f"WITH {DOCS} SELECT DISTINCT city_name, (SELECT count(*) FROM docs) AS documents FROM docs WHERE city_name <> ''")
def _(spark, sf):
    return R.sentiment_catalog(documents(spark, sf))


# Keyword list made of common syllables, so that hits occur in every language of the table.
CALM = ("the", "eau", "der", "ción", "Is")


def _hits_sql(words) -> str:
    test = " OR ".join(f"contains(t, '{w.lower()}')" for w in words)
    return f"""CAST(coalesce(list_sum(list_transform(range(1, len(words) + 1), lambda i:
 CASE WHEN len(list_filter([lower(words[i])], lambda t: {test})) > 0 THEN freqs[i] ELSE 0 END)), 0) AS BIGINT)"""


HITS = f"""latest AS (SELECT *, row_number() OVER (PARTITION BY insee_code ORDER BY year DESC) AS rn FROM docs),
hits AS (SELECT insee_code, sentiment_avg, {_hits_sql(CALM)} AS calm_hits, {_hits_sql(K.TRANSPORT_KEYWORDS)} AS transport_hits,
 {_hits_sql(K.ACTIVITY_KEYWORDS)} AS activity_hits FROM latest WHERE rn = 1)"""


_TRANSPORT, _ACTIVITY = ("and", "une", "mit", "los"), ("of", "que", "und", "les")
_ALL_HITS = HITS.replace(_hits_sql(K.TRANSPORT_KEYWORDS), _hits_sql(_TRANSPORT)).replace(_hits_sql(K.ACTIVITY_KEYWORDS), _hits_sql(_ACTIVITY))


@case("nlp_term_hits", f"""WITH {DOCS}, {_ALL_HITS} SELECT c.insee_code, {near_sql('sentiment_avg', 6)} AS sentiment_avg, coalesce(calm_hits, 0) AS calm_hits,
 coalesce(transport_hits, 0) AS transport_hits, coalesce(activity_hits, 0) AS activity_hits, h.insee_code IS NOT NULL AS has_nlp
 FROM (SELECT DISTINCT insee_code FROM census) c LEFT JOIN hits h ON c.insee_code = h.insee_code""")
def _(spark, sf):
    df = R.term_hits(documents(spark, sf), CALM, view(spark, sf, "census"), _TRANSPORT, _ACTIVITY)
    return df.withColumn("sentiment_avg", near("sentiment_avg", 6))

"""Reviews: scoring, yearly sentiment, top terms and sentiment documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import constants as K
from ..functions import text as T
from .keyed import newest_per_key
from .ranking import smallest_by_hash


def pick_columns(columns: Sequence[str]) -> tuple[str, str | None]:
    """Text and date column by preference; a review table must have a text column."""
    text = next((c for c in K.REVIEW_TEXT_COLUMNS if c in columns), None)
    date = next((c for c in K.REVIEW_DATE_COLUMNS if c in columns), None)
    if text is None:
        raise ValueError(f"no review text column among {list(columns)[:40]}")
    return text, date


def with_review_columns(df: DataFrame) -> DataFrame:
    """Add ``review_text`` and ``year`` (0 when the date is missing or bad)."""
    text, date = pick_columns(df.columns)
    year = F.lit(0) if date is None else F.coalesce(F.year(F.col(date).cast("string").try_cast("timestamp")), F.lit(0))
    return df.withColumn("review_text", F.col(text)).withColumn("year", year)


def min_text(df: DataFrame, text: str = "review_text", chars: int = K.MIN_REVIEW_CHARS) -> DataFrame:
    return df.where(F.length(text) >= chars)


def cap_texts(df: DataFrame, id_col: str, maximum: int, seed: int = 42) -> DataFrame:
    """At most ``maximum`` texts, chosen by seeded hash; 0 keeps all."""
    return df if maximum <= 0 else smallest_by_hash(df, id_col, maximum, seed)


def scorer(score_batch: Callable[[list[str]], list[float]], batch_size: int = 256) -> Callable[[str | Column], Column]:
    """Column function from a batch scorer, called with Arrow batches cut to ``batch_size``."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out: list[float] = []
            values = texts.tolist()
            for start in range(0, len(values), batch_size):
                out.extend(score_batch(values[start:start + batch_size]))
            yield pd.Series(out, dtype="float64")

    return score


def with_score(df: DataFrame, text: str = "review_text", score: Callable[[Column], Column] = T.sentiment_light) -> DataFrame:
    return df.withColumn("score", score(F.col(text)))


def sentiment_by_year(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*keys, "year").agg(
        F.avg("score").alias("sentiment_avg"), F.count("score").alias("sentiment_count")
    )


def aggregate_sentiment(scored: DataFrame) -> DataFrame:
    """Mean and count over all texts; 0 and 0 for none."""
    return scored.agg(F.coalesce(F.avg("score"), F.lit(0.0)).alias("sentiment_avg"),
                      F.count("score").alias("sentiment_count"))


def ranked_terms(df: DataFrame, keys: Sequence[str], text: str = "review_text", n: int = K.TOP_TERMS) -> DataFrame:
    """(keys, term, freq, rank): the ``n`` most frequent terms per group, ties by term.

    Counts are combined before the shuffle and the rank limit is applied before
    it too, so a group with a third of all texts sends ``n`` rows per task.
    """
    words = F.explode(F.regexp_extract_all(F.lower(text), F.lit(K.TOKEN_PATTERN), 0))
    counts = (
        df.select(*keys, words.alias("term"))
        .where(~F.col("term").isin(*K.STOPWORDS))
        .groupBy(*keys, "term")
        .agg(F.count(F.lit(1)).alias("freq"))
    )
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("freq").desc(), "term"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n)


def top_terms(df: DataFrame, keys: Sequence[str], text: str = "review_text", n: int = K.TOP_TERMS) -> DataFrame:
    """Top terms per group as an array of (term, freq), at most ``n`` entries."""
    entries = F.sort_array(F.collect_list(F.struct("rank", "term", "freq")))
    terms = F.transform(entries, lambda e: F.struct(e["term"].alias("term"), e["freq"].alias("freq")))
    return ranked_terms(df, keys, text, n).groupBy(*keys).agg(terms.alias("top_terms"))


def sentiment_documents(
    reviews: DataFrame,
    score: Callable[[Column], Column] = T.sentiment_light,
    mode: str = "light",
    language: str = "fr",
    chars: int = K.MIN_REVIEW_CHARS,
    n: int = K.TOP_TERMS,
) -> DataFrame:
    """One document per (insee_code, city_name, year) from rows with ``review_text``.

    The texts are read once: every row gives its terms and, as a row without term, its score. A group's scores and
    the counts of each of its terms are combined before the shuffle; then its ``n`` most frequent terms stay.
    """
    keys = ["insee_code", "city_name", "year"]
    kept = with_score(min_text(reviews, chars=chars), score=score)
    words = F.filter(F.regexp_extract_all(F.lower("review_text"), F.lit(K.TOKEN_PATTERN), 0), lambda w: ~w.isin(*K.STOPWORDS))
    each = F.explode(F.concat(
        F.array(F.struct(F.lit(None).cast("string").alias("term"), F.col("score").alias("score"))),
        F.transform(words, lambda w: F.struct(w.alias("term"), F.lit(None).cast("double").alias("score"))),
    ))
    counts = kept.select(*keys, each.alias("e")).groupBy(*keys, F.col("e.term").alias("term")).agg(
        F.count(F.lit(1)).alias("freq"), F.avg("e.score").alias("sentiment_avg"), F.count("e.score").alias("sentiment_count"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("term").isNull().desc(), F.col("freq").desc(), "term"))
    ranked = counts.withColumn("rank", rank).where(F.col("rank") <= n + 1)  # the row without term is the first
    entries = F.sort_array(F.collect_list(F.when(F.col("term").isNotNull(), F.struct("rank", "term", "freq"))))
    documents = ranked.groupBy(*keys).agg(
        F.max("sentiment_avg").alias("sentiment_avg"), F.max("sentiment_count").alias("sentiment_count"),
        F.transform(entries, lambda e: F.struct(e["term"].alias("term"), e["freq"].alias("freq"))).alias("top_terms"))
    return documents.select(
        F.lit("city").alias("level"), *keys, F.lit(language).alias("language"), "sentiment_avg", "sentiment_count", "top_terms",
        F.lit(K.REVIEW_SOURCE).alias("source"), F.lit(mode).alias("nlp_mode"),
        F.current_timestamp().alias("updated_at"),
    )


# --- documents joined to territories ---------------------------------------

def latest_documents(docs: DataFrame, keys: Sequence[str] = ("insee_code",)) -> DataFrame:
    return newest_per_key(docs, keys, [F.col("year").desc_nulls_last()])


def latest_sentiment_table(docs: DataFrame, cities: dict[str, str] | None = None) -> DataFrame:
    """Latest document of the listed cities, with commune and department code."""
    names = C.literal_map({code: name for name, code in (cities or K.REVIEW_CITIES).items()})
    listed = docs.where((F.col("level") == "city") & F.col("insee_code").isin(*(cities or K.REVIEW_CITIES).values()))
    latest = latest_documents(listed)
    department = C.department_from_commune(F.col("insee_code"))
    return latest.select(
        F.col("insee_code").alias("insee_code_city"),
        F.when(department.rlike("^[0-9]{1,2}$"), C.zfill(department, 2)).otherwise(department).alias("insee_code_department"),
        F.try_element_at(names, F.col("insee_code")).alias("city_name"),
        F.coalesce("sentiment_avg", F.lit(0.0)).alias("sentiment_avg"),
        F.coalesce("sentiment_count", F.lit(0)).cast("bigint").alias("sentiment_count"),
        F.coalesce("year", F.lit(0)).alias("nlp_year"),
    )


def sentiment_commune(territories: DataFrame, table: DataFrame, level: str) -> DataFrame:
    """The commune whose reviews stand for each territory: itself, or the first of its department."""
    code = C.display_code(F.col("insee_code"), level)
    keyed = territories.withColumn("_code", code)
    if level == "city":
        proxy = table.select(F.col("insee_code_city").alias("_code"), F.col("insee_code_city").alias("commune"))
    elif level == "department":
        proxy = table.groupBy(F.col("insee_code_department").alias("_code")).agg(F.min("insee_code_city").alias("commune"))
    else:
        return territories.withColumn("commune", F.lit(None).cast("string"))
    return keyed.join(proxy, "_code", "left").drop("_code")


def sentiment_by_department(table: DataFrame) -> DataFrame:
    return table.groupBy(F.col("insee_code_department").alias("insee_code")).agg(
        F.avg("sentiment_avg").alias("sentiment_avg")
    )


def sentiment_catalog(docs: DataFrame, source: str = K.REVIEW_SOURCE) -> DataFrame:
    """Distinct cities of a source in order, each row with the source's number of documents."""
    chosen = docs.where(F.col("source") == source)
    total = chosen.agg(F.count(F.lit(1))).scalar()
    cities = chosen.where(F.col("city_name") != "").select("city_name").distinct()
    return cities.withColumn("documents", total).orderBy("city_name")


def _hits(terms: Column, keywords: Sequence[str]) -> Column:
    words = [w.lower() for w in keywords]
    hit = F.filter(terms, lambda t: T.contains_any(F.lower(t["term"]), words))
    return F.coalesce(F.aggregate(hit, F.lit(0).cast("bigint"), lambda acc, t: acc + F.coalesce(t["freq"], F.lit(1))), F.lit(0))


def term_hits(
    docs: DataFrame, calm: Sequence[str] = K.CALM_KEYWORDS, territories: DataFrame | None = None,
    transport: Sequence[str] = K.TRANSPORT_KEYWORDS, activity: Sequence[str] = K.ACTIVITY_KEYWORDS,
) -> DataFrame:
    """Keyword hits in the latest document per territory.

    ``territories`` (insee_code) adds those without any document, with zero hits.
    """
    latest = latest_documents(docs)
    metrics = latest.select(
        "insee_code", "sentiment_avg",
        _hits(F.col("top_terms"), calm).alias("calm_hits"),
        _hits(F.col("top_terms"), transport).alias("transport_hits"),
        _hits(F.col("top_terms"), activity).alias("activity_hits"),
        F.lit(True).alias("has_nlp"),
    )
    if territories is None:
        return metrics
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("calm_hits", "transport_hits", "activity_hits")}
    return territories.select("insee_code").distinct().join(metrics, "insee_code", "left").withColumns(
        {**counts, "has_nlp": F.coalesce("has_nlp", F.lit(False))}
    )

"""Score and exploration queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from terroir.operators import reviews as R
from terroir.operators import scoring as S
from terroir.operators.ranking import percentile_score
from terroir.plans.exploration import exploration_frame

from .base import case, near, near_sql, stored, view
from .reviews import CALM, DOCS, HITS, documents, latest_table
from .territory import stored_facts

# One row per commune: the territories that are scored.
FRAME = """frame AS (SELECT p.insee_code, p.price_m2_avg, p.price_m2_median, CAST(p.mutation_count AS DOUBLE) AS mutation_count, c.population
 FROM (SELECT * FROM prices WHERE year = 1998 AND property_type = 'apartments') p
 LEFT JOIN (SELECT * FROM census WHERE year = 1998) c ON p.insee_code = c.insee_code)"""


def frame(spark, sf):
    prices = view(spark, sf, "prices").where("year = 1998 AND property_type = 'apartments'")
    people = view(spark, sf, "census").where("year = 1998").select("insee_code", "population")
    return prices.select(
        "insee_code", "price_m2_avg", "price_m2_median", F.col("mutation_count").cast("double").alias("mutation_count")
    ).join(people, "insee_code", "left")


def _share(value: str, higher: bool) -> str:
    order = "ASC" if higher else "DESC"
    return f"""CASE WHEN {value} IS NULL THEN 50.0 ELSE 100.0 * cume_dist() OVER (PARTITION BY {value} IS NULL ORDER BY {value} {order}) END"""


@case("percentile_score", f"""SELECT insee_code, year, property_type, {near_sql(_share('mutation_count', True), 6)} AS busy,
 {near_sql(_share('price_m2_avg', False), 6)} AS cheap FROM prices""")
def _(spark, sf):
    df = stored(spark, sf, "prices")
    df = percentile_score(df, "mutation_count", "busy", True, 50.0)
    df = percentile_score(df, "price_m2_avg", "cheap", False, 50.0)
    return df.select("insee_code", "year", "property_type", near("busy", 6).alias("busy"), near("cheap", 6).alias("cheap"))


@case("liquidity_index", """SELECT insee_code, year, property_type,
  round_even(mutation_count / max(mutation_count) OVER () * 100.0, 1) AS indice_liquidite,
  round_even((price_m2_median / median(price_m2_median) OVER () - 1.0) * 100.0, 1) AS prix_vs_mediane_nationale FROM prices""")
def _(spark, sf):
    df = S.add_liquidity(view(spark, sf, "prices"))
    return df.select("insee_code", "year", "property_type", "indice_liquidite", "prix_vs_mediane_nationale")


@case("proxy_minmax", f"""WITH {DOCS}, {HITS} SELECT insee_code, round_even(calm_hits / greatest(max(calm_hits) OVER (), 1) * 100.0, 0) AS proxy FROM hits""")
def _(spark, sf):
    hits = R.term_hits(documents(spark, sf), CALM)
    return S.proxy_minmax(hits, "calm_hits", "proxy").select("insee_code", "proxy")


@case("join_left_nlp_metrics", f"""WITH {DOCS}, {HITS}, {FRAME} SELECT insee_code, coalesce(calm_hits, 0) AS calm_hits,
 {near_sql('sentiment_avg', 6)} AS sentiment_avg FROM frame LEFT JOIN hits USING (insee_code)""")
def _(spark, sf):
    hits = R.term_hits(documents(spark, sf), CALM)
    df = S.join_metrics(frame(spark, sf), hits, ["calm_hits", "sentiment_avg"])
    return df.select("insee_code", "calm_hits", near("sentiment_avg", 6).alias("sentiment_avg"))


_POINTS = "CASE WHEN sentiment_avg IS NULL THEN 50.0 ELSE greatest(0.0, least(100.0, (sentiment_avg + 1.0) * 50.0)) END"


@case("score_where_to_live", f"""WITH {DOCS}, {HITS}, {FRAME}, parts AS (SELECT insee_code, {_share('price_m2_avg', False)} AS score_prix,
   {_share('population', True)} AS score_dynamisme, {_share('mutation_count', True)} AS score_marche, {_POINTS} AS score_ressenti
   FROM frame LEFT JOIN hits USING (insee_code))
 SELECT insee_code, {near_sql('score_prix')} AS score_prix, {near_sql('score_dynamisme')} AS score_dynamisme, {near_sql('score_marche')} AS score_marche,
  {near_sql('score_ressenti')} AS score_ressenti,
  {near_sql('score_prix * 0.35 + score_dynamisme * 0.20 + score_ressenti * 0.30 + score_marche * 0.15')} AS score_global FROM parts""")
def _(spark, sf):
    df = S.where_to_live(frame(spark, sf), R.term_hits(documents(spark, sf), CALM))
    scores = ("score_prix", "score_dynamisme", "score_marche", "score_ressenti", "score_global")
    return df.select("insee_code", *[near(c).alias(c) for c in scores])


@case("score_quiet_family", f"""WITH {DOCS}, {HITS}, {FRAME}, parts AS (SELECT insee_code, least(100.0, coalesce(calm_hits, 0) * 12.0) AS score_calme_nlp,
   {_share('mutation_count', False)} AS score_marche_discret, {_share('price_m2_avg', False)} AS score_prix_maison
   FROM frame LEFT JOIN hits USING (insee_code))
 SELECT insee_code, CAST(score_calme_nlp AS DOUBLE) AS score_calme_nlp, {near_sql('score_marche_discret')} AS score_marche_discret,
  {near_sql('score_prix_maison')} AS score_prix_maison,
  round_even(CAST(score_calme_nlp AS DOUBLE) * 0.45 + score_marche_discret * 0.35 + score_prix_maison * 0.20, 1) AS score_famille_calme FROM parts""")
def _(spark, sf):
    df = S.quiet_family(frame(spark, sf), R.term_hits(documents(spark, sf), CALM))
    return df.select(
        "insee_code", "score_calme_nlp", near("score_marche_discret").alias("score_marche_discret"),
        near("score_prix_maison").alias("score_prix_maison"), "score_famille_calme",
    )


@case("topn_by_indicator", f"""WITH {FRAME} SELECT insee_code AS "Code INSEE", price_m2_avg AS "Prix moyen (€/m²)", price_m2_median AS "Prix médian (€/m²)",
 mutation_count AS "Mutations", population AS "Population" FROM frame ORDER BY price_m2_avg DESC NULLS LAST, insee_code LIMIT 100""")
def _(spark, sf):
    return S.top_by_indicator(frame(spark, sf), "price_m2_avg", 100, display=True)


_DEPARTMENT_FRAME = f"""{{docs}}, direct AS (SELECT substr(insee_code, 1, 2) AS insee_code, avg(price_m2_avg) AS price_m2_avg,
   quantile_cont(price_m2_median, 0.5) AS price_m2_median, CAST(sum(mutation_count) AS DOUBLE) AS mutation_count
   FROM prices WHERE year = {{year}} AND property_type = 'apartments' GROUP BY substr(insee_code, 1, 2)),
 people AS (SELECT substr(insee_code, 1, 2) AS insee_code, sum(population) AS population, avg(median_age) AS median_age FROM census
   WHERE year = {{year}} GROUP BY substr(insee_code, 1, 2)),
 sent AS (SELECT substr(insee_code, 1, 2) AS insee_code, avg(sentiment_avg) AS sentiment_avg FROM
   (SELECT *, row_number() OVER (PARTITION BY insee_code ORDER BY year DESC) AS rn FROM docs) WHERE rn = 1
   AND insee_code IN ('01000', '04000', '10000', '13000', '18000') GROUP BY substr(insee_code, 1, 2)),
 shown AS (SELECT d.*, population, median_age FROM direct d LEFT JOIN people USING (insee_code) WHERE insee_code LIKE '0%' OR insee_code LIKE '1%')"""


@case("exploration_frame", f"""WITH {_DEPARTMENT_FRAME.format(docs=DOCS, year=2001)}
 SELECT insee_code, {near_sql('price_m2_avg')} AS price_m2_avg, {near_sql('price_m2_median')} AS price_m2_median, mutation_count, population,
  {near_sql('median_age')} AS median_age, round_even(mutation_count / max(mutation_count) OVER () * 100.0, 1) AS indice_liquidite,
  round_even((price_m2_median / median(price_m2_median) OVER () - 1.0) * 100.0, 1) AS prix_vs_mediane_nationale,
  {near_sql('sentiment_avg', 6)} AS sentiment_avg FROM shown LEFT JOIN sent USING (insee_code)""")
def _(spark, sf):
    docs = documents(spark, sf)
    cities = {f"c{c}": c for c in ("01000", "04000", "10000", "13000", "18000")}
    df = exploration_frame(
        stored_facts(spark, sf), view(spark, sf, "census"), docs, "department", 2001, "apartments", "price_m2_avg", "0, 1", cities=cities
    )
    return df.select(
        "insee_code", near("price_m2_avg").alias("price_m2_avg"), near("price_m2_median").alias("price_m2_median"), "mutation_count",
        "population", near("median_age").alias("median_age"), "indice_liquidite", "prix_vs_mediane_nationale",
        near("sentiment_avg", 6).alias("sentiment_avg"),
    )


@case("exploration_frame_city", f"""WITH {DOCS}, docs_latest AS (SELECT *, row_number() OVER (PARTITION BY insee_code ORDER BY year DESC) AS rn FROM docs)
 SELECT c.insee_code, population, median_age, {near_sql('sentiment_avg', 6)} AS sentiment_avg FROM census c
 LEFT JOIN (SELECT * FROM docs_latest WHERE rn = 1 AND insee_code IN ('01000', '04000', '10000')) d ON c.insee_code = d.insee_code
 WHERE c.year = 1998 AND median_age IS NOT NULL""")
def _(spark, sf):
    cities = {f"c{c}": c for c in ("01000", "04000", "10000")}
    df = exploration_frame(
        view(spark, sf, "prices"), view(spark, sf, "census"), documents(spark, sf), "city", 1998, "apartments", "median_age", cities=cities
    )
    return df.select("insee_code", "population", "median_age", near("sentiment_avg", 6).alias("sentiment_avg"))


@case("join_left_sentiment", f"""WITH {DOCS}, {FRAME}, docs_latest AS (SELECT *, row_number() OVER (PARTITION BY insee_code ORDER BY year DESC) AS rn FROM docs)
 SELECT f.insee_code, price_m2_avg, {near_sql('sentiment_avg', 6)} AS sentiment_avg FROM frame f
 LEFT JOIN (SELECT * FROM docs_latest WHERE rn = 1 AND insee_code IN ('01000', '04000', '10000', '13000', '18000')) d ON f.insee_code = d.insee_code""")
def _(spark, sf):
    df = S.join_sentiment(frame(spark, sf), latest_table(spark, sf), "city")
    return df.select("insee_code", "price_m2_avg", near("sentiment_avg", 6).alias("sentiment_avg"))

"""Territory scores: liquidity, relative price, where-to-live and quiet-family."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..session import materialize
from .ranking import median_by, percentile_score
from .reviews import sentiment_by_department


def add_liquidity(df: DataFrame) -> DataFrame:
    """Mutations relative to the busiest territory and median price relative to the frame's median.

    The frame is read several times, so it is written to the shared folder once.
    """
    df = materialize(df, "liquidity-frame")
    busiest = df.agg(F.max("mutation_count")).scalar()
    middle = median_by(df, [], "price_m2_median", "m").scalar()
    index = F.bround(F.col("mutation_count") / busiest * 100.0, 1)
    relative = F.bround((F.col("price_m2_median") / middle - 1.0) * 100.0, 1)
    return df.withColumn("indice_liquidite", F.when(busiest > 0, index).otherwise(F.lit(0.0))).withColumn(
        "prix_vs_mediane_nationale", F.when(middle > 0, relative)
    )


def proxy_minmax(df: DataFrame, hits: str, out: str) -> DataFrame:
    """Hits relative to the largest (at least 1), in whole percent, half to even."""
    largest = F.greatest(F.coalesce(df.agg(F.max(hits)).scalar().cast("double"), F.lit(0.0)), F.lit(1.0))
    return df.withColumn(out, F.bround(F.col(hits) / largest * 100.0, 0))


def join_metrics(df: DataFrame, metrics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Left join of review metrics; missing calm hits count as none."""
    out = df.join(metrics.select("insee_code", *columns), "insee_code", "left")
    return out.withColumn("calm_hits", F.coalesce("calm_hits", F.lit(0))) if "calm_hits" in columns else out


def _score_or_neutral(df: DataFrame, value: str, out: str, higher_is_better: bool) -> DataFrame:
    if value not in df.columns:
        return df.withColumn(out, F.lit(K.NEUTRAL_SCORE))
    return percentile_score(df, value, out, higher_is_better, K.NEUTRAL_SCORE)


def sentiment_points(sentiment: Column) -> Column:
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(100.0), (sentiment + 1.0) * 50.0))
    return F.when(sentiment.isNotNull(), clamped).otherwise(F.lit(K.NEUTRAL_SCORE))


# The other names of the weights.
WEIGHT_NAMES = {"prix": "price", "marche": "market"}


def live_weights(weights: Mapping[str, float] | None) -> dict[str, float]:
    """The weights by their names here, defaults for those not given; a name that nothing is weighed by is an error."""
    given = {WEIGHT_NAMES.get(name, name): float(value) for name, value in (weights or {}).items()}
    unknown = sorted(set(given) - set(K.LIVE_WEIGHTS))
    if unknown:
        raise ValueError(f"unknown weights {unknown}; there are {sorted(K.LIVE_WEIGHTS)} and {sorted(WEIGHT_NAMES)}")
    return {**K.LIVE_WEIGHTS, **given}


def join_demographics(df: DataFrame, people: DataFrame, columns: Sequence[str] = ("population", "median_age")) -> DataFrame:
    """Left join of population figures by code."""
    return df.join(people.select("insee_code", *columns), "insee_code", "left")


def join_sentiment(df: DataFrame, table: DataFrame, level: str) -> DataFrame:
    """Left join of the newest review sentiment: of the commune, or the mean of a department; other levels have none."""
    if level == "city":
        side = table.select(F.col("insee_code_city").alias("insee_code"), "sentiment_avg", "city_name")
        return df.join(side, "insee_code", "left")
    return df.join(sentiment_by_department(table), "insee_code", "left") if level == "department" else df


def with_indicator(df: DataFrame, indicator: str) -> DataFrame:
    """Rows whose indicator is known; none if the frame has no such column."""
    return df.where(F.col(indicator).isNotNull()) if indicator in df.columns else df.limit(0)


def where_to_live(df: DataFrame, metrics: DataFrame | None = None, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Weighted mean of affordable price, population, sentiment and market activity."""
    w = live_weights(weights)
    total = sum(w.values()) if sum(w.values()) > 0 else 1.0
    out = df
    if metrics is not None:
        out = join_metrics(out, metrics, [c for c in metrics.columns if c != "insee_code"])
    out = materialize(out, "where-to-live-frame")
    out = _score_or_neutral(out, "price_m2_avg", "score_prix", higher_is_better=False)
    out = _score_or_neutral(out, "population", "score_dynamisme", higher_is_better=True)
    out = _score_or_neutral(out, "mutation_count", "score_marche", higher_is_better=True)
    sentiment = F.col("sentiment_avg") if "sentiment_avg" in out.columns else F.lit(None).cast("double")
    out = out.withColumn("score_ressenti", sentiment_points(sentiment)).withColumn(
        "score_global",
        (
            F.col("score_prix") * w["price"] + F.col("score_dynamisme") * w["population"]
            + F.col("score_ressenti") * w["sentiment"] + F.col("score_marche") * w["market"]
        ) / total,
    )
    if {"transport_hits", "activity_hits"} <= set(out.columns):
        out = proxy_minmax(out, "transport_hits", "proxy_transport")
        out = proxy_minmax(out, "activity_hits", "proxy_activites")
    return out.orderBy(F.col("score_global").desc(), "insee_code")


def quiet_family(df: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """Calm reviews, quiet market and affordable price."""
    out = df.withColumn("calm_hits", F.lit(0)) if metrics is None else join_metrics(df, metrics, ["calm_hits", "sentiment_avg"])
    out = materialize(out, "quiet-family-frame")
    out = out.withColumn("score_calme_nlp", F.least(F.lit(100.0), F.col("calm_hits") * K.CALM_HIT_POINTS))
    out = _score_or_neutral(out, "mutation_count", "score_marche_discret", higher_is_better=False)
    out = _score_or_neutral(out, "price_m2_avg", "score_prix_maison", higher_is_better=False)
    w = K.QUIET_WEIGHTS
    total = (
        F.col("score_calme_nlp") * w["calm"] + F.col("score_marche_discret") * w["quiet"]
        + F.col("score_prix_maison") * w["affordable"]
    )
    return out.withColumn("score_famille_calme", F.bround(total, 1)).orderBy(F.col("score_famille_calme").desc(), "insee_code")


# Display names of the territory table.
DISPLAY_NAMES = {
    "insee_code": "Code INSEE",
    "price_m2_avg": "Prix moyen (€/m²)",
    "price_m2_median": "Prix médian (€/m²)",
    "mutation_count": "Mutations",
    "population": "Population",
    "median_age": "Âge médian",
    "indice_liquidite": "Indice liquidité (0–100)",
    "sentiment_avg": "Ressenti Airbnb (POC)",
}


def top_by_indicator(
    df: DataFrame, indicator: str, n: int, codes: Sequence[str] | None = None, display: bool = False
) -> DataFrame:
    """First ``n`` territories by indicator, optionally among chosen codes, optionally as display table."""
    chosen = df if codes is None else df.where(F.col("insee_code").isin(list(codes)))
    out = chosen.orderBy(F.col(indicator).desc_nulls_last(), "insee_code").limit(n)
    if not display:
        return out
    return out.select(*[F.col(c).alias(label) for c, label in DISPLAY_NAMES.items() if c in out.columns])

"""The exploration frame: everything known about the territories of one slice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import reviews as R
from ..operators import scoring as S
from ..operators import territory as T

INDICATORS = ("price_m2_avg", "price_m2_median", "mutation_count", "population", "median_age", "sentiment_avg")


def exploration_frame(
    prices: DataFrame,
    demographics: DataFrame,
    docs: DataFrame | None,
    level: str,
    year: int,
    property_type: str,
    indicator: str,
    prefixes: str = "",
    region_rule: str = "lookup",
    cities: dict[str, str] | None = None,
) -> DataFrame:
    """Prices (or their rollup) with population, liquidity and sentiment, where the indicator is known."""
    sliced = prices.where((F.col("year") == year) & (F.col("property_type") == property_type))
    frame = T.prices_or_rollup(sliced, level, region_rule)
    people = T.demographics_or_rollup(demographics.where(F.col("year") == year), level, region_rule)
    if level == "city":
        frame, people = T.commune_codes_only(frame), T.commune_codes_only(people)
    if indicator in ("population", "median_age"):
        # No territories without prices: the slice decides whether there is anything to show.
        frame = people.where(frame.limit(1).agg(F.count(F.lit(1))).scalar() > 0)
    else:
        frame = S.join_demographics(frame, people)
    frame = T.code_prefixes(frame, T.parse_prefixes(prefixes))
    if level == "department" and "mutation_count" in frame.columns:
        frame = S.add_liquidity(frame)
    if docs is not None:
        frame = S.join_sentiment(frame, R.latest_sentiment_table(docs, cities), level)
    return S.with_indicator(frame, indicator)

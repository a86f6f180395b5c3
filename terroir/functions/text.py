"""Text: accents, tokens, lexicon sentiment and amenity mentions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


@lru_cache(maxsize=1)
def _accent_pairs() -> tuple[str, str]:
    """Letters that canonical decomposition turns into one base letter plus marks."""
    accented, base = [], []
    for point in range(0xC0, 0x2000):
        letter = chr(point)
        plain = "".join(c for c in unicodedata.normalize("NFD", letter) if not unicodedata.category(c).startswith("M"))
        if len(plain) == 1 and plain != letter:
            accented.append(letter)
            base.append(plain)
    return "".join(accented), "".join(base)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def strip_accents(text: Column) -> Column:
    accented, base = _accent_pairs()
    return F.regexp_replace(F.translate(text, accented, base), r"\p{M}+", "")


def fold_accents(text: Column) -> Column:
    """Accent-free, lower-case, trimmed key."""
    return F.trim(F.lower(strip_accents(text)))


def _words(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def tokenize_fr(text: Column, fold: bool = False) -> Column:
    """Lower-case words of two or more letters without the stop words."""
    lowered = F.lower(text)
    tokens = F.regexp_extract_all(strip_accents(lowered) if fold else lowered, F.lit(K.TOKEN_PATTERN), 0)
    return F.filter(tokens, lambda w: ~w.isin(*K.STOPWORDS))


def sentiment_light(text: Column, fold: bool = False) -> Column:
    """(positive - negative) / (positive + negative) lexicon words, 0 when none occurs.

    Words are cut once, and only the few that are in the lexicon are kept for
    counting (no lexicon word is a stop word).
    """
    lowered = F.lower(text)
    words = F.regexp_extract_all(strip_accents(lowered) if fold else lowered, F.lit(K.TOKEN_PATTERN), 0)
    known = F.filter(words, lambda w: w.isin(*K.POSITIVE_WORDS, *K.NEGATIVE_WORDS))

    def score(hits: Column) -> Column:
        positive = F.size(F.filter(hits, lambda w: w.isin(*K.POSITIVE_WORDS)))
        return F.when(F.size(hits) > 0, (positive * 2 - F.size(hits)) / F.size(hits))

    return F.coalesce(let(known, score), F.lit(0.0))


def label_score(label: Column, score: Column) -> Column:
    """Signed score of a classifier label."""
    low = F.lower(F.coalesce(label, F.lit("")))
    value = F.coalesce(score, F.lit(0.0))
    return F.when(low.contains("pos"), value).when(low.contains("neg"), -value).otherwise(F.lit(0.0))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(text, F.lit(word))
    return hit


def _flag(false_if: Column | None, true_if: Column) -> Column:
    if false_if is None:
        return F.when(true_if, F.lit(True))
    return F.when(false_if, F.lit(False)).when(true_if, F.lit(True))


def amenity_flags(description: Column) -> dict[str, Column]:
    """Three-valued amenity flags and the floor mentioned in a description."""
    low = F.lower(description)
    has = lambda word: F.contains(low, F.lit(word))
    floor = F.regexp_extract(low, r"((?<![A-Za-z0-9_])[0-9]+(?:er|ème|e)?\s*étage(?![A-Za-z0-9_])|rez[- ]de[- ]chaussée)", 1)
    return {
        "elevator": _flag(has("sans ascenseur"), has("ascenseur")),
        "parking": _flag(None, contains_any(low, ("parking", "garage"))),
        "cellar": _flag(None, has("cave")),
        "balcony": _flag(None, has("balcon")),
        "terrace": _flag(None, has("terrasse")),
        "furnished": _flag(has("non meublé"), has("meublé")),
        "floor": F.nullif(F.trim(floor), F.lit("")),
    }

"""The registered queries: each operator on the given tables, with its SQL where SQL can say it."""

from .base import CASES, Case


def all_cases() -> dict[str, Case]:
    """Every registered query by name."""
    from . import listings, pages, reviews, scoring, similarity, sources, streams, territory  # noqa: F401

    return dict(CASES)

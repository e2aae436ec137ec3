"""Registered queries and the SQL each one is checked against."""

from shelfspan.queries import (  # noqa: F401
    aggregates,
    evaluation,
    features,
    joins,
    models,
    quality,
    scalars,
    sources,
    training,
    windows,
)
from shelfspan.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

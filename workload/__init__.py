"""Checked queries: every operator on the given tables, with its SQL twin."""

from . import bins, cleaning, labels, lookups, models, samples, sequences, whole  # noqa: F401
from .registry import oracle_sql, queries  # noqa: F401

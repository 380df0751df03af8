"""Helpers of the base tests."""

from __future__ import annotations


def rows(df, *columns):
    """The rows as tuples; ``None`` sorts first."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))

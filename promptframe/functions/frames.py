"""Helpers on whole frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns that cost much and are used more than once.

    The optimizer moves a filter below the projection that makes its column by
    repeating the column's expression, once per use. It does not move a filter
    below a generator, so the columns come out of a one-row ``inline``.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    made = F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    out = df.select(*kept, made)
    return out.select(*[f"`{c}`" for c in [*df.columns, *[n for n in columns if n not in df.columns]]])

"""Deterministic "one row per key".

``dropDuplicates(subset)`` keeps an arbitrary row, so two actions over the
same input can keep different rows.  Here the kept row is the one with the
smallest ``order`` value, via ``min_by`` of a struct: the aggregation is
split into a map-side partial step and a final step, so a hot key holding a
third of all rows is reduced to one row per input partition before the
shuffle (no global sort, no per-key row list).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: Sequence[str], order: str | Column,
           keep_order: bool = False) -> DataFrame:
    order_col = F.col(order) if isinstance(order, str) else order
    order_name = order if isinstance(order, str) else None
    values = [c for c in df.columns if c not in keys and (keep_order or c != order_name)]
    # A struct is never null, so rows without an order are kept where a key
    # has no others (they come last).
    picked = F.min_by(F.struct(*values), F.struct(order_col.isNull(), order_col)).alias("_kept")
    return df.groupBy(*keys).agg(picked).select(*keys, "_kept.*")

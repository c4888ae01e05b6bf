"""Shared building blocks for keyed operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pick_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                 latest: bool = True) -> DataFrame:
    """One whole row per key: the one with the largest (or smallest) ``order_cols``.

    Expressed as ``groupBy(keys).agg(max(struct(order_cols..., rest...)))``
    rather than ``row_number()`` over a window: the aggregate runs a partial
    step before the shuffle, so a key that holds a third of all rows is
    reduced to one row per map task instead of being sorted in one task.
    Ties on ``order_cols`` fall to the remaining columns, so the pick is
    deterministic.
    """
    keys = list(keys)
    order_cols = list(order_cols)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + rest])
    pick = F.max(packed) if latest else F.min(packed)
    out = df.groupBy(*keys).agg(pick.alias("_pick"))
    return out.select(*[F.col(k) for k in keys],
                      *[F.col(f"_pick.{c}").alias(c) for c in order_cols + rest]
                      ).select(*df.columns)

"""First row per group.

``row_number() = 1`` lets Spark keep one row per group and map task before the
shuffle, so a hot group never reaches one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def top_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    )
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the first in ``order_by``, nulls last.

    Without ``order_by`` all other columns decide, so the result does not
    depend on row order.
    """
    if order_by is None:
        order_by = [c for c in df.columns if c not in keys]
    if not order_by:
        return df.dropDuplicates(list(keys))
    return top_per_group(df, keys, [F.col(c).asc_nulls_last() for c in order_by])

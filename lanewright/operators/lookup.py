"""Left joins that attach dimension attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "left",
    one_row: bool = False,
) -> DataFrame:
    """Join ``dimension`` and add its columns under new names.

    on     column of ``df`` -> column of ``dimension``
    take   new name -> column of ``dimension``

    Only the named columns travel. Null keys match nothing. With ``one_row`` a
    repeated key counts once, with its smallest row, so ``df`` keeps its rows.
    """
    narrow = dimension.select(
        *[F.col(d).alias(f"__l_{i}") for i, d in enumerate(on.values())],
        *[F.col(c).alias(new) for new, c in take.items()],
    ).dropna(subset=[f"__l_{i}" for i in range(len(on))])
    if one_row:
        keys = [f"__l_{i}" for i in range(len(on))]
        least = F.min(F.struct(*take)).alias("__row")
        narrow = narrow.groupBy(*keys).agg(least).select(*keys, "__row.*")
    condition = None
    for i, left in enumerate(on):
        equal = F.col(left) == F.col(f"__l_{i}")
        condition = equal if condition is None else condition & equal
    return df.join(narrow, condition, how).drop(*[f"__l_{i}" for i in range(len(on))])


@dataclass(frozen=True)
class Lookup:
    """One lookup, not yet made. The fields are those of ``lookup``."""

    dimension: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str]
    one_row: bool = False

    def made(self, df: DataFrame) -> DataFrame:
        return lookup(df, self.dimension, self.on, self.take, one_row=self.one_row)


def lookup_all(df: DataFrame, lookups: Sequence[Lookup], by: Sequence[str] = ()) -> DataFrame:
    """Make lookups, those that go by the same columns one after the other, so that rows are
    exchanged once for them.

    With ``by``, columns that all of them go by, they are made on a narrow row for each of
    the values of these, and ``df`` is exchanged once to meet it. It is then read twice, so
    it should be a stored table. Nulls in ``by`` meet each other.
    """
    if not by:
        places = [tuple(x.on) for x in lookups]
        for one in sorted(lookups, key=lambda x: places.index(tuple(x.on))):
            df = one.made(df)
        return df
    key = F.struct(*by).alias("__by")
    # What goes by all of the columns is next to their grouping.
    first = sorted(lookups, key=lambda x: set(x.on) != set(by))
    known = lookup_all(df.select(*by).distinct(), first)
    new = [c for c in known.columns if c not in by]
    rows = df.select(key, *[c for c in df.columns if c not in by])
    met = rows.join(known.select(key, *new), "__by", "left")
    own = [F.col("__by")[c].alias(c) if c in by else F.col(c) for c in df.columns]
    return met.select(*own, *new)


def with_prefix_role(facilities: DataFrame, prefix: str) -> DataFrame:
    return facilities.filter(F.col("facilityname").startswith(prefix))


def suffix_columns(df: DataFrame, suffix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}{suffix}") for c in df.columns])


def exists_flag(
    df: DataFrame, listed: DataFrame, on: Mapping[str, str], flag: str
) -> DataFrame:
    """Add a boolean column: is the key of this row in ``listed``?"""
    marked = exists_lookup(listed, on, flag).made(df)
    return marked.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def exists_lookup(listed: DataFrame, on: Mapping[str, str], flag: str) -> Lookup:
    """True for a key that is in ``listed``, else null."""
    keys = listed.select(*[F.col(c) for c in on.values()]).dropna().distinct()
    return Lookup(keys.withColumn("__one", F.lit(True)), on, {flag: "__one"})


def symmetric_pairs(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct pairs in both directions."""
    swapped = pairs.select(F.col(b).alias(a), F.col(a).alias(b))
    return pairs.select(a, b).unionByName(swapped).distinct()

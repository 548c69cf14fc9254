"""Keyed update of one table by another, and what belongs to it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.operators.rank import first_per_key

_HIT = "__hit"


def duplicate_source_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        source.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def require_unique(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Same rows, but the query fails if a key occurs twice.

    The check rides in the plan: one aggregation with map-side combine and no
    extra job.
    """
    others = [c for c in source.columns if c not in keys]
    if not others:
        others_struct = F.struct(F.lit(1).alias("one"))
    else:
        others_struct = F.struct(*others)
    grouped = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.first(others_struct).alias("__row")
    )
    message = F.concat(
        F.lit(f"update source repeats a key of ({', '.join(keys)}): "),
        F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]),
    )
    guarded = F.when(F.col("__n") > 1, F.raise_error(message)).otherwise(F.col("__row"))
    checked = grouped.select(*keys, guarded.alias("__row"))
    return checked.select(*keys, *[F.col("__row")[c].alias(c) for c in others])


def update_by_key(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    columns: Sequence[str],
    *,
    null_policy: str = "keep",
    on_duplicate: str = "error",
    order_by: Sequence[str] | None = None,
    defaults: Mapping[str, Any] | None = None,
    null_safe_keys: bool = False,
    source_is_unique: bool = False,
) -> DataFrame:
    """Write ``columns`` of matching source rows over those of the target.

    Rows, row count, column order and types of the target stay as they are.

    keys            names shared by both, or target name -> source name
    null_policy     "keep": a null source cell leaves the target cell;
                    "overwrite": a matched row takes the source cell, null or not
    on_duplicate    "error" fails the query, "first" keeps the first row per key
                    in ``order_by``
    defaults        column -> value that replaces every target cell before the
                    update (literal or Column); done in the same pass
    source_is_unique  the source was just aggregated by these keys, so neither a
                    check nor a dedup is planned
    """
    update = Update(
        source,
        keys,
        columns,
        null_policy=null_policy,
        on_duplicate=on_duplicate,
        order_by=order_by,
        defaults=defaults or {},
        null_safe_keys=null_safe_keys,
        source_is_unique=source_is_unique,
    )
    return update_all(target, [update])


@dataclass(frozen=True)
class Update:
    """One keyed update, not yet applied. The fields are those of ``update_by_key``."""

    source: DataFrame
    keys: Sequence[str] | Mapping[str, str]
    columns: Sequence[str]
    null_policy: str = "keep"
    on_duplicate: str = "error"
    order_by: Sequence[str] | None = None
    defaults: Mapping[str, Any] = field(default_factory=dict)
    null_safe_keys: bool = False
    source_is_unique: bool = False

    @property
    def key_map(self) -> dict[str, str]:
        return dict(self.keys) if isinstance(self.keys, Mapping) else {k: k for k in self.keys}

    @property
    def written(self) -> set[str]:
        return {*self.columns, *self.defaults}

    def check(self, target: DataFrame) -> None:
        if self.null_policy not in ("keep", "overwrite"):
            raise ValueError(f"unknown null_policy {self.null_policy!r}")
        if self.on_duplicate not in ("error", "first"):
            raise ValueError(f"unknown on_duplicate {self.on_duplicate!r}")
        missing = [c for c in self.columns if c not in self.source.columns]
        absent = [c for c in [*self.columns, *self.defaults] if c not in target.columns]
        if missing or absent:
            raise ValueError(f"columns missing in source {missing}, in target {absent}")

    def rows(self) -> DataFrame:
        """Keys and columns of the source; one row a key where the first is kept."""
        keys = list(self.key_map.values())
        narrow = self.source.select(*keys, *[c for c in self.columns if c not in keys])
        if not self.null_safe_keys:
            narrow = narrow.dropna(subset=keys)
        if self.source_is_unique or self.on_duplicate != "first":
            return narrow
        needed = [c for c in (self.order_by or []) if c not in narrow.columns]
        wide = self.source.select(*narrow.columns, *needed)
        if not self.null_safe_keys:
            wide = wide.dropna(subset=keys)
        return first_per_key(wide, keys, self.order_by).select(*narrow.columns)

    @property
    def must_be_unique(self) -> bool:
        return not self.source_is_unique and self.on_duplicate == "error"


def update_all(target: DataFrame, updates: Iterable[Update]) -> DataFrame:
    """Apply updates one after the other.

    Consecutive updates by the same key are fused: their sources are united and
    grouped by key, and the target is joined, and so exchanged, once for all of
    them. Defaults and null rules still act in the order of the updates. An
    update of a key column ends a run, since later updates must find it.
    """
    run: list[Update] = []
    for update in updates:
        update.check(target)
        if run and not _same_keys(target, run, update):
            target, run = _apply(target, run), []
        run.append(update)
    return _apply(target, run) if run else target


def _key_types(update: Update) -> list:
    return [update.source.schema[k].dataType for k in update.key_map.values()]


def _same_keys(target: DataFrame, run: Sequence[Update], update: Update) -> bool:
    keys = list(run[0].key_map)
    return (
        keys == list(update.key_map)
        and run[0].null_safe_keys == update.null_safe_keys
        and _key_types(run[0]) == _key_types(update)
        and not any(u.written & set(keys) for u in run)
    )


def _apply(target: DataFrame, run: Sequence[Update]) -> DataFrame:
    if len(run) == 1:
        only = run[0]
        rows = only.rows()
        if only.must_be_unique:
            rows = require_unique(rows, list(only.key_map.values()))
        source = rows.select(
            *[F.col(s).alias(f"__k_{i}") for i, s in enumerate(only.key_map.values())],
            F.struct(F.lit(True).alias(_HIT), *only.columns).alias("__s_0"),
        )
    else:
        source = _united(run)
    condition = None
    for i, target_key in enumerate(run[0].key_map):
        left, right = F.col(target_key), F.col(f"__k_{i}")
        equal = left.eqNullSafe(right) if run[0].null_safe_keys else left == right
        condition = equal if condition is None else condition & equal
    joined = target.join(source, condition, "left")
    hits = [f"__s_{k}" for k in range(len(run))]
    types = {f.name: f.dataType for f in target.schema.fields}
    for k, update in enumerate(run):
        joined = joined.select(
            *[_cell(c, types[c], update, f"__s_{k}").alias(c) for c in target.columns], *hits
        )
    return joined.select(*target.columns)


def _united(run: Sequence[Update]) -> DataFrame:
    """``__k_...`` and a struct of cells an update, of every key that a source has."""
    keys = [f"__k_{i}" for i in range(len(run[0].key_map))]
    parts = []
    for k, update in enumerate(run):
        own = update.rows().select(
            *[F.col(s).alias(n) for s, n in zip(update.key_map.values(), keys)],
            F.struct(F.lit(True).alias(_HIT), *update.columns).alias(f"__s_{k}"),
        )
        parts.append(own)
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    hits = [F.col(f"__s_{k}") for k in range(len(run))]
    grouped = united.groupBy(*keys).agg(
        *[F.first(h, ignorenulls=True).alias(f"__s_{k}") for k, h in enumerate(hits)],
        *[F.count(h).alias(f"__n_{k}") for k, h in enumerate(hits)],
    )

    def guarded(k: int, update: Update) -> Column:
        if not update.must_be_unique:
            return F.col(f"__s_{k}")
        message = F.concat(
            F.lit(f"update source repeats a key of ({', '.join(update.key_map.values())}): "),
            F.concat_ws(", ", *[F.col(c).cast("string") for c in keys]),
        )
        repeated = F.col(f"__n_{k}") > 1
        return F.when(repeated, F.raise_error(message)).otherwise(F.col(f"__s_{k}"))

    return grouped.select(*keys, *[guarded(k, u).alias(f"__s_{k}") for k, u in enumerate(run)])


def _cell(name: str, kind, update: Update, hit: str) -> Column:
    old = F.col(name)
    if name in update.defaults:
        value = update.defaults[name]
        old = (value if isinstance(value, Column) else F.lit(value)).cast(kind)
    if name not in update.columns:
        return old
    new = F.col(hit)[name].cast(kind)
    if update.null_policy == "keep":
        return F.coalesce(new, old)
    return F.when(F.col(hit)[_HIT], new).otherwise(old)


def replace_groups(
    table: DataFrame, replacement: DataFrame, column: str, names: Sequence[str]
) -> DataFrame:
    """Drop the rows of the named groups and add the replacement rows."""
    kept = table.filter(~F.coalesce(F.col(column).isin(list(names)), F.lit(False)))
    return replacement.unionByName(kept, allowMissingColumns=True).select(*table.columns)

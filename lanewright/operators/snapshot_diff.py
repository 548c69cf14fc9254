"""Differences between two published versions, reading only the buckets that differ."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.operators.buckets import BUCKET, differing_buckets
from lanewright.operators.profile import Profile, read_profiles
from lanewright.operators.reconcile import (
    _changed_cells,
    changed_rows,
    pair_keys,
    same_forms,
    shared_cells,
)
from lanewright.sources import staging
from lanewright.sources.versions import Version
from lanewright.specs import TableSpec

_SCHEMA = (
    "table_name string, kind string, key string, column_name string, old_value string, "
    "new_value string"
)


def changed_buckets(
    spark: SparkSession, root: str, old: Version, new: Version
) -> dict[str, list[int]]:
    """Buckets to read, by table: at most as many rows as there are buckets in all tables."""
    a, b = (staging.read_run(spark, root, v, "__buckets") for v in (old, new))
    found: dict[str, list[int]] = {}
    for row in differing_buckets(a, b).collect():
        found.setdefault(row["table_name"], []).append(row["bucket"])
    return found


def _profiles(spark: SparkSession, root: str, *sides: Version) -> dict[str, dict[str, Profile]]:
    """Profiles of whole tables, as they were counted when each version was published."""
    found: dict[str, dict[str, Profile]] = {}
    for version in sides:
        rows = staging.read_run(spark, root, version, "__profiles").collect()
        for table in {r["table_name"] for r in rows}:
            of = found.setdefault(table, {})
            for name, p in read_profiles(r for r in rows if r["table_name"] == table).items():
                of[name] = of.get(name, Profile()) + p
    return found


def diff_versions(
    spark: SparkSession,
    root: str,
    specs: Mapping[str, TableSpec],
    old: Version,
    new: Version,
    stage: staging.Stage | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """``table_name, kind, key, column_name, old_value, new_value`` of all differences.

    ``kind`` is ``left_only`` or ``right_only`` for a key that is unique on that side
    alone, and ``cell`` for a cell of a key unique on both. Both versions must
    have been published with specs. If their numbers of buckets differ, every
    bucket is read.
    """
    stage = stage or staging.Stage(spark)
    if not old.buckets or not new.buckets:
        raise ValueError("publish both versions with specs to compare them by bucket")
    listed = changed_buckets(spark, root, old, new) if old.buckets == new.buckets else None
    profiles = _profiles(spark, root, old, new)
    parts = []
    for name in old.n_rows:
        spec = specs.get(name)
        wanted = names is None or name in names
        if not wanted or name not in new.n_rows or spec is None or not spec.primary_key:
            continue
        if listed is not None and name not in listed:
            continue
        sides = []
        for version in (old, new):
            df = staging.read_run(spark, root, version, name)
            if listed is not None:
                df = df.filter(F.col(BUCKET).isin(listed[name]))
            sides.append(df.drop(BUCKET))
        keys = list(spec.primary_key)
        a, b = same_forms(*sides, keys, spec.numeric, profiles=profiles.get(name, {}))
        pairs = stage.cut(pair_keys(a, b, keys), f"pairs_{name}")
        shown, table = F.to_json(F.struct(*keys)).alias("key"), F.lit(name).alias("table_name")
        one_sided = pairs.filter((F.col("n_old") == 1) != (F.col("n_new") == 1))
        side = F.when(F.col("n_old") == 1, "left_only").otherwise("right_only")
        none = [F.lit(None).cast("string").alias(c) for c in ("column_name", "old_value", "new_value")]
        parts.append(one_sided.select(table, side.alias("kind"), shown, *none))
        cells = _changed_cells(changed_rows(a, b, pairs, keys), keys, shared_cells(a, b, keys))
        parts.append(
            cells.select(
                table, F.lit("cell").alias("kind"), shown, "column_name", "old_value", "new_value"
            )
        )
    if not parts:
        return spark.createDataFrame([], _SCHEMA)
    return reduce(DataFrame.unionByName, parts)

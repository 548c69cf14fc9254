"""The keyed update and its null rules."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lanewright.operators.rank import first_per_key
from lanewright.operators.update import (
    Update,
    duplicate_source_keys,
    replace_groups,
    require_unique,
    update_all,
    update_by_key,
)

T = "k string, a double, b string"


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [("x", 1.0, "old"), ("x", 2.0, "old"), ("y", 3.0, None), (None, 4.0, "old")], T
    )


def test_keep_writes_non_null_cells_only(spark, target, rows):
    source = spark.createDataFrame([("x", None, "new"), ("z", 9.0, "new")], T)
    out = update_by_key(target, source, ["k"], ["a", "b"])
    assert rows(out) == rows(
        spark.createDataFrame(
            [("x", 1.0, "new"), ("x", 2.0, "new"), ("y", 3.0, None), (None, 4.0, "old")], T
        )
    )
    assert out.columns == target.columns


def test_overwrite_writes_nulls_of_matched_rows(spark, target, rows):
    source = spark.createDataFrame([("x", None, "new")], T)
    out = update_by_key(target, source, ["k"], ["a", "b"], null_policy="overwrite")
    assert rows(out).count(("x", None, "new")) == 2
    assert ("y", 3.0, None) in rows(out)


def test_null_keys_match_only_on_request(spark, target, rows):
    source = spark.createDataFrame([(None, 9.0, "new")], T)
    assert rows(update_by_key(target, source, ["k"], ["a"])) == rows(target)
    out = update_by_key(target, source, ["k"], ["a"], null_safe_keys=True)
    assert (None, 9.0, "old") in rows(out)


def test_repeated_source_key_fails_or_keeps_first(spark, target, rows):
    source = spark.createDataFrame([("x", 7.0, "q"), ("x", 5.0, "p")], T)
    with pytest.raises(PySparkException, match="repeats a key"):
        update_by_key(target, source, ["k"], ["a"]).collect()
    out = update_by_key(target, source, ["k"], ["a"], on_duplicate="first", order_by=["b"])
    assert rows(out).count(("x", 5.0, "old")) == 2
    assert rows(duplicate_source_keys(source, ["k"])) == [("x", 2)]


def test_defaults_reset_rows_without_match(spark, target, rows):
    source = spark.createDataFrame([("x", 7.0, None)], T)
    out = update_by_key(target, source, ["k"], ["a", "b"], defaults={"a": 0, "b": "N"})
    assert rows(out) == rows(
        spark.createDataFrame(
            [("x", 7.0, "N"), ("x", 7.0, "N"), ("y", 0.0, "N"), (None, 0.0, "N")], T
        )
    )


def test_default_may_depend_on_the_row(spark, target, rows):
    source = spark.createDataFrame([("q", 7.0, None)], T)
    reset = F.when(F.col("k") == "x", "N").otherwise(F.col("b"))
    out = update_by_key(target, source, ["k"], ["b"], defaults={"b": reset})
    assert rows(out).count(("x", 1.0, "N")) == 1 and (None, 4.0, "old") in rows(out)


def test_unknown_columns_are_refused(spark, target):
    source = spark.createDataFrame([("x", 1.0)], "k string, c double")
    with pytest.raises(ValueError, match="in target"):
        update_by_key(target, source, ["k"], ["c"])
    with pytest.raises(ValueError, match="in source"):
        update_by_key(target, source, ["k"], ["a"])


def test_require_unique_passes_unique_rows(spark, rows):
    df = spark.createDataFrame([("x", 1.0, "p"), ("y", None, "q")], T)
    assert rows(require_unique(df, ["k"])) == rows(df)


def test_first_per_key_puts_nulls_last(spark, rows):
    df = spark.createDataFrame([("x", None, "p"), ("x", 2.0, "q"), ("y", None, "r")], T)
    assert rows(first_per_key(df, ["k"], ["a"])) == [("x", 2.0, "q"), ("y", None, "r")]


def test_replace_groups_keeps_other_and_null_groups(spark, rows):
    schema = "g string, m string"
    table = spark.createDataFrame([("A", "1"), ("B", "2"), (None, "3")], schema)
    new = spark.createDataFrame([("9", "A")], "m string, g string")
    assert rows(replace_groups(table, new, "g", ["A"])) == [("A", "9"), ("B", "2"), (None, "3")]


_KEY = st.sampled_from(["a", "b", "c", None])
_CELL = st.one_of(st.none(), st.integers(-3, 3))


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    target=st.lists(st.tuples(_KEY, _CELL, _CELL), min_size=1, max_size=8),
    source=st.dictionaries(st.sampled_from("abcd"), st.tuples(_CELL, _CELL), max_size=4),
    overwrite=st.booleans(),
)
def test_update_agrees_with_row_by_row(spark, rows, target, source, overwrite):
    schema = "k string, v int, w int"
    t = spark.createDataFrame(target, schema)
    s = spark.createDataFrame([(k, *v) for k, v in source.items()], schema)
    out = update_by_key(
        t, s, ["k"], ["v"], null_policy="overwrite" if overwrite else "keep"
    )
    expected = []
    for k, v, w in target:
        if k in source and (overwrite or source[k][0] is not None):
            v = source[k][0]
        expected.append((k, v, w))
    assert rows(out) == sorted(expected, key=repr)


_SOURCE = st.lists(
    st.tuples(st.sampled_from(["x", "y", "z", None]), st.sampled_from([None, 1.0, 2.0]), st.sampled_from([None, "p", "q"])),
    max_size=4, unique_by=lambda r: r[0],
)
_STEP = st.tuples(
    _SOURCE,
    st.sampled_from([["a"], ["b"], ["a", "b"]]),
    st.sampled_from(["keep", "overwrite"]),
    st.sampled_from(["none", "literal", "column"]),
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(steps=st.lists(_STEP, min_size=2, max_size=4), null_safe=st.booleans())
def test_fused_updates_equal_the_chain(spark, target, rows, steps, null_safe):
    updates = []
    for source, columns, policy, default in steps:
        defaults = {"none": {}, "literal": {"b": "reset"}, "column": {"a": F.col("a") + 1, "b": F.upper("b")}}
        updates.append(
            Update(
                spark.createDataFrame(source, T.replace("k ", "key ")), {"k": "key"}, columns,
                null_policy=policy, defaults=defaults[default], null_safe_keys=null_safe,
            )
        )
    chain = target
    for u in updates:
        chain = update_by_key(
            chain, u.source, u.keys, u.columns, null_policy=u.null_policy, defaults=u.defaults,
            null_safe_keys=null_safe,
        )
    fused = update_all(target, updates)
    assert fused.dtypes == target.dtypes
    assert rows(fused) == rows(chain)


def test_fused_updates_check_each_source(spark, target, rows):
    once = spark.createDataFrame([("x", 7.0, "q")], T)
    twice = spark.createDataFrame([("x", 7.0, "q"), ("x", 5.0, "p")], T)
    with pytest.raises(PySparkException, match=r"repeats a key of \(k\): x"):
        update_all(target, [Update(once, ["k"], ["a"]), Update(twice, ["k"], ["b"])]).collect()
    kept = Update(twice, ["k"], ["b"], on_duplicate="first", order_by=["b"])
    assert rows(update_all(target, [Update(once, ["k"], ["a"]), kept])).count(("x", 7.0, "p")) == 2
    with pytest.raises(ValueError, match="missing in source"):
        update_all(target, [Update(once, ["k"], ["a"]), Update(once, ["k"], ["c"])])


def test_an_update_of_a_key_ends_the_run(spark, target, rows):
    rename = spark.createDataFrame([("x", "y")], "old string, k string")
    write = spark.createDataFrame([("y", 9.0)], "k string, a double")
    updates = [Update(rename, {"k": "old"}, ["k"]), Update(write, ["k"], ["a"]), Update(write, {"b": "k"}, ["a"])]
    assert rows(update_all(target, updates), "k", "a") == sorted(
        [("y", 9.0), ("y", 9.0), ("y", 9.0), (None, 4.0)], key=repr
    )


def test_fused_updates_move_the_target_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(100).selectExpr("id as k", "id as a", "id as b", "'wide' as note")
        source = spark.range(50).selectExpr("id as k", "-id as a", "id + 1 as b")
        updates = [Update(source, ["k"], [c]) for c in ("a", "b", "a")]

        def moves(df):
            plan = df._jdf.queryExecution().executedPlan().toString()
            return plan.count("SortMergeJoin"), plan.count("Exchange hashpartitioning")

        chain = target
        for u in updates:
            chain = update_by_key(chain, u.source, u.keys, u.columns)
        assert moves(update_all(target, updates)) == (1, 2)
        assert moves(chain)[0] == 3 and moves(chain)[1] > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")

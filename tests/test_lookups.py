"""Lookups made once for a lane, against those made one after the other on whole rows."""

from __future__ import annotations

import re

import pytest

from lanewright.catalog.queries import QUERIES
from lanewright.operators.lookup import Lookup, lookup, lookup_all


@pytest.fixture
def given(spark):
    lanes = [("a", "x"), ("a", "y"), ("b", "x"), ("b", None), (None, "x"), (None, None), ("c", "z")]
    rows = [(a, b, p, i) for i, (a, b) in enumerate(lanes * 2) for p in ("p", "q")]
    df = spark.createDataFrame(rows, "o string, d string, p string, old int")
    ends = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 9)], "k string, v int")
    far = spark.createDataFrame([("x", 7), ("x", 8), ("z", None)], "k string, w int")
    pairs = spark.createDataFrame([("a", "x", "s"), ("b", "x", "t"), (None, "x", "u")], "o string, d string, s string")
    return df, [
        Lookup(ends, {"o": "k"}, {"v": "v"}),
        Lookup(pairs, {"d": "d", "o": "o"}, {"s": "s"}),
        Lookup(far, {"d": "k"}, {"w": "w"}, one_row=True),
        Lookup(ends, {"o": "k"}, {"again": "v"}, one_row=True),
    ]


def test_equal_to_lookups_one_by_one(given, rows):
    df, lookups = given
    plain = df
    for x in lookups:
        plain = lookup(plain, x.dimension, x.on, x.take, one_row=x.one_row)
    names = ["o", "d", "p", "old", "v", "s", "w", "again"]
    expected = rows(plain, *names)
    assert len(expected) > df.count()
    for ours in (lookup_all(df, lookups), lookup_all(df, lookups, by=["o", "d"])):
        assert ours.columns[:4] == df.columns
        assert dict(ours.dtypes) == dict(plain.dtypes)
        assert rows(ours, *names) == expected


def test_whole_rows_are_exchanged_once(spark, given):
    df, lookups = given
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lookup_all(df, lookups, by=["o", "d"])._jdf.queryExecution().executedPlan().toString()
        chain = lookup_all(df, lookups)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The one of whole rows goes by the struct of both ends.
    assert len(re.findall(r"Exchange hashpartitioning\(__by#", plan)) == 2
    # Both lookups by the same end stand together: an exchange for each of three keys.
    wide = [x for x in chain.splitlines() if re.search(r"Exchange hashpartitioning\((o|d)#", x)]
    assert sum(x.startswith((" ", "+", ":")) for x in wide) >= 3


@pytest.mark.parametrize("name, keys", [("refresh_fulfillment", 2), ("refresh_replenishment", 2)])
def test_policies_move_once_for_all_flags(spark, sf_dir, name, keys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        final = QUERIES[name](spark, sf_dir)
        plan = final._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning\(__by#", plan)) == keys

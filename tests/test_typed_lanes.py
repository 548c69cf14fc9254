"""Loads and costs of lanes summed in one pass, against those summed apart."""

from __future__ import annotations

import pytest
from test_lane_carrier_loads import AS_OF, DASHED, PLAIN, REPEATED, TWINS, _shipments

from lanewright.catalog.queries import QUERIES
from lanewright.plans import history

MANY = [(i, None if i == 5 else f"L{i}", "Depot") for i in range(1, 12)]


@pytest.mark.parametrize("places", [PLAIN, MANY, TWINS, REPEATED, DASHED])
@pytest.mark.parametrize("windows", [(60, 3), (13, None), (13, -1)])
@pytest.mark.parametrize("least", [(100.0, 0), (30.0, 2)])
def test_equal_to_lanes_of_two_passes(spark, rows, places, windows, least):
    shipments = _shipments(spark)
    locations = spark.createDataFrame(
        [(i, c, None if i == 7 else f"name {i}", t) for i, c, t in places],
        "iid bigint, code string, name string, nav_type string",
    )
    carriers = spark.createDataFrame(
        [("c1", "CPU"), ("c2", "Dedicated")], "scac string, carrier_type string"
    )
    given, (days, months) = (shipments, locations, carriers, AS_OF), windows
    ours = history.typed_lanes(*given, days, months, *least)
    cost = history.cost_per_load(history.lane_costs(*given, months), *least)
    theirs = history.lane_types(history.lane_loads(*given, days), cost)
    assert dict(ours.dtypes) == dict(theirs.dtypes)
    found = rows(ours, *theirs.columns)
    assert found and found == rows(theirs)
    if least == (100.0, 0) and places in (MANY, TWINS):
        apart = history.typed_lanes(*given, days, months, *least, apart=True)
        assert found == rows(apart, *theirs.columns)


def test_shipments_are_read_once(spark, sf_dir):
    for name in ("hist_lane_type", "hist_lane_model_ids"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        lines = [x for x in plan.splitlines() if "Relation" in x and "l_orderkey" in x]
        assert len(lines) == 1, name

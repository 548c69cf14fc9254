"""Loads by lane and carrier, with locations looked up last, against those of the cost rows."""

from __future__ import annotations

import datetime as dt

import pytest

from lanewright.catalog.queries import QUERIES
from lanewright.plans import history

AS_OF = dt.date(2024, 5, 15)
_DATES = (
    "creation_date delivery_date planned_to planned_from date_from date_to actual_ship "
    "actual_delivery"
).split()
_SCHEMA = (
    "tnumber string, location_from bigint, location_to bigint, qty_from double, status int, "
    "scac string, distance double, charge double, norm_charge double, inv_linehaul double, "
    "inv_fuel double, inv_other double, inv_detention double, inv_tax double, "
) + ", ".join(f"{c} timestamp_ntz" for c in _DATES)

PLAIN = [(1, "A", "Depot"), (2, "B", "Depot"), (3, "C", "Shop"), (4, None, "Shop"), (5, None, None)]
TWINS = [*PLAIN, (6, "A", "Depot"), (7, "A", "Yard"), (8, "C", "Shop"), (9, "C", None)]
REPEATED = [*TWINS, (2, "B", "Depot"), (3, "D", "Shop")]
DASHED = [*TWINS, (10, "A-B", "Depot"), (11, "B-C", "Depot")]


def _shipments(spark):
    ends = [None, *range(1, 13)]
    made = []
    for k in range(900):
        # Many rows a shipment id, whose line haul passes the bound only together.
        number = ("IS", "R", "TOR", "X", "DDT")[k % 5] + f"-{k % 45}"
        start, stop = ends[k * 7 % len(ends)], ends[k * k % len(ends)]
        scac = ("c1", "c2", "c3", None)[k % 4 if k % 9 else 3]
        day = dt.datetime(2024, 5, 1 + k % 2)
        made.append(
            (number, start, stop, None if k % 11 == 0 else -2.0, 5 if k % 31 == 0 else 1, scac,
             None if k % 29 == 0 else 7.0, 3.0, 2.0, None if k % 13 == 0 else float(k % 80),
             1.0, 1.0, 1.0, 1.0, *[day] * 8)
        )
    return spark.createDataFrame(made, _SCHEMA)


@pytest.mark.parametrize("places", [PLAIN, TWINS, REPEATED, DASHED])
@pytest.mark.parametrize("least", [(100.0, 0), (30.0, 2)])
def test_equal_to_those_of_the_cost_rows(spark, rows, places, least):
    shipments = _shipments(spark)
    locations = spark.createDataFrame(
        [(i, c, f"name {i}", t) for i, c, t in places],
        "iid bigint, code string, name string, nav_type string",
    )
    carriers = spark.createDataFrame(
        [("c1", "CPU"), ("c2", "Dedicated")], "scac string, carrier_type string"
    )
    given = (shipments, locations, carriers, AS_OF, 3)
    ours = history.lane_carrier_loads(*given, *least)
    theirs = history.carrier_loads(history.lane_costs(*given), *least)
    assert ours.dtypes == theirs.dtypes
    found = rows(ours)
    assert found and found == rows(theirs)
    twins = history.location_twins(locations, history.Stage(spark))
    assert (twins is None) == (places in (REPEATED, DASHED))
    if twins is not None:
        assert rows(twins) == ([] if places is PLAIN else [(6, 1, 1), (7, 7, 1), (8, 3, 3), (9, 9, 3)])


def test_shipments_meet_locations_as_sums(spark, sf_dir):
    """Codes are no keys of the grouping of shipments, so they are not shuffled with them."""
    plan = QUERIES["agg_having"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    by_shipment = [line for line in plan.splitlines() if "Aggregate [tnumber" in line]
    assert by_shipment and not any("origin_code" in line for line in by_shipment)

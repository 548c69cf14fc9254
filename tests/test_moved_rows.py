"""What moves between tasks on the way to loads by lane and carrier, and that results stay."""

from __future__ import annotations

import pytest
from test_lane_carrier_loads import AS_OF, DASHED, PLAIN, REPEATED, TWINS, _shipments

from lanewright.catalog.queries import QUERIES
from lanewright.catalog.views import VIEWS, raw, view, with_clause
from lanewright.plans import history


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("places", [PLAIN, TWINS, REPEATED, DASHED])
@pytest.mark.parametrize("least", [(100.0, 0), (30.0, 2)])
def test_top_carriers_equal_those_of_the_cost_rows(spark, rows, places, least):
    """A lane is a pair of ids where ids stand for codes; elsewhere codes are ranked."""
    locations = spark.createDataFrame(
        [(i, c, f"name {i}", t) for i, c, t in places],
        "iid bigint, code string, name string, nav_type string",
    )
    carriers = spark.createDataFrame(
        [("c1", "CPU"), ("c2", "Dedicated")], "scac string, carrier_type string"
    )
    given = (_shipments(spark), locations, carriers, AS_OF, 3)
    ours = history.lane_top_carriers(*given, *least)
    theirs = history.top_carriers(history.carrier_loads(history.lane_costs(*given), *least))
    assert ours.dtypes == theirs.dtypes
    found = rows(ours)
    assert found and found == rows(theirs)


def test_carriers_are_ranked_before_locations_are_looked_up(spark, sf_dir):
    plan = _physical(QUERIES["rnk_top_carrier"](spark, sf_dir))
    ranked = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert ranked and all("location_from" in line for line in ranked)
    above = plan[: plan.index("WindowGroupLimit")]
    assert above.count("LeftOuter") == 2


@pytest.mark.parametrize("name", ["hist_cost_per_load", "rnk_top_carrier"])
def test_lines_meet_orders_and_parts_without_prices(spark, sf_dir, name):
    """The net amount stands for price and discount, and the second depot is worked out last."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    lines = [x for x in plan.splitlines() if "Project [" in x and "l_partkey" in x]
    with_orders = [x for x in lines if "custkey" in x]
    assert with_orders and all("l_net" in x for x in lines)
    for column in ("l_extendedprice", "l_discount", "suppkey2"):
        assert not any(column in x for x in with_orders)


def test_narrow_shipments_are_those_of_the_sql(spark, sf_dir):
    tables = {t: raw(spark, sf_dir, t) for t in ("lineitem", "orders", "part")}
    text = with_clause("SELECT * FROM shipments", VIEWS)
    for table in tables:
        text = text.replace(f"FROM {table}", f"FROM {{{table}}}")
        text = text.replace(f"JOIN {table}", f"JOIN {{{table}}}")
    plain, ours = spark.sql(text, **tables), view(spark, sf_dir, "shipments")
    assert ours.dtypes == plain.dtypes
    assert ours.count() == plain.count() > 0
    assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()


def test_moments_of_a_shipment_are_grouped_by_once_and_lie_beside_their_likes(spark):
    dates = [k for k in history._SHIPMENT_KEYS[2:] if not k.startswith(("origin", "destination"))]
    assert sorted(history._SHIPMENT_DATES) == sorted(dates)
    ends = [c in ("delivery_date", "planned_to", "date_to", "actual_delivery") for c in history._SHIPMENT_DATES]
    assert ends == sorted(ends)


def test_sums_of_shipments_over_the_bound_and_under_it_are_apart(spark):
    """A missing sum takes no room; all loads are those of both."""
    rows = [("a", 3, 150.0), ("a", 2, 50.0), ("b", 4, 200.0), ("c", 5, 10.0)]
    sums = spark.createDataFrame(rows, "k string, n bigint, lh double").groupBy("k").agg(
        *history._sums_enough(100.0)
    )
    found = sums.withColumns({"n": history._all_of("n"), "lh": history._all_of("lh")}).orderBy("k")
    assert dict(found.dtypes)["n"] == "bigint"
    assert [tuple(r) for r in found.collect()] == [
        ("a", 3, 150.0, 2, 50.0, 5, 200.0),
        ("b", 4, 200.0, None, None, 4, 200.0),
        ("c", None, None, 5, 10.0, 5, 10.0),
    ]

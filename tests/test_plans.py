"""Business rules on small tables written out by hand."""

from __future__ import annotations

import random
import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lanewright.plans import (
    depots,
    flags,
    history,
    lanes,
    multisource,
    penalties,
    places,
    rates,
    sizes,
    transfers,
)
from lanewright.specs import Params

AS_OF = dt.date(2024, 5, 15)
SHIPMENT = (
    "tnumber string, location_from int, location_to int, qty_from double, qty_to double, "
    "date_to timestamp, status int, scac string, distance double, charge double, "
    "norm_charge double, inv_linehaul double, inv_fuel double, inv_other double, "
    "inv_detention double, inv_tax double, creation_date timestamp, delivery_date timestamp, "
    "planned_to timestamp, planned_from timestamp, date_from timestamp, actual_ship timestamp, "
    "actual_delivery timestamp"
)


def shipment(tnumber, a, b, age=5, status=1, scac="CPU1", qty=10.0, lh=500.0, charge=4.0):
    moment = dt.datetime.combine(AS_OF - dt.timedelta(days=age), dt.time(12))
    cost = (100.0, charge, 8.0, lh, 20.0, None, 0.0, 1.0)
    return (tnumber, a, b, -qty, qty, moment, status, scac, *cost) + (moment,) * 7


@pytest.fixture
def locations(spark):
    return spark.createDataFrame(
        [
            (1, "DEP01", "Depot one", "Depot", "Depot", "K1", "Corp one"),
            (2, "DEP02", "Depot two", "Depot", "Depot", "K1", "Corp one"),
            (3, "CUS03", "Customer three", "C", "Renter", "K3", "Corp three"),
            (4, "CUS04", "Site four", "C", "Recovery", None, "Corp four"),
        ],
        "iid int, code string, name string, nav_type string, rl_type string, corp_code string, "
        "corp_name string",
    )


@pytest.fixture
def carriers(spark):
    return spark.createDataFrame(
        [("CPU1", "a", "CPU"), ("DED1", "b", "Dedicated"), ("DED2", "c", "Dedicated")],
        "scac string, carrier_name string, carrier_type string",
    )


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [("I_CUS03", "CUS03", "old", "old", "old", "old", -1.0, -1.0, -1.0)],
        "customername string, loccode string, status string, inplan string, corpcode string, "
        "corpname string, planquantity double, issueqty double, avgloadsz double",
    )


@pytest.fixture
def facilities(spark):
    return spark.createDataFrame(
        [
            ("D_DEP01", "DEP01", "Full Service", "Include"),
            ("D_DEP02", "DEP02", "Sort Only", "Include"),
            ("R_CUS04", "CUS04", None, "Include"),
            ("R_DEP01", "DEP01", None, "Include"),
        ],
        "facilityname string, loccode string, depottype string, status string",
    )


def ships(spark, *rows_):
    return spark.createDataFrame(list(rows_), SHIPMENT)


def test_depots_per_customer(spark, rows, locations, customers, facilities):
    df = ships(
        spark,
        shipment("IS1", 1, 3),
        shipment("IS2", 2, 3, age=90),
        shipment("IS3", 1, 3, age=91),
        shipment("IS4", 99, 3),
        shipment("R1", 4, 1, age=-3),
        shipment("TOR1", 1, 2),
    )
    found = history.depots_per_customer(df, locations, AS_OF)
    assert rows(found) == [("", "", 1), ("Issue", "CUS03", 2), ("Return", "CUS04", 1)]
    named = history.depots_by_model_id(found, customers, facilities)
    assert rows(named, "model_id", "number_of_depots") == [("I_CUS03", 2), ("R_CUS04", 1)]


def test_load_sizes(spark, rows, locations, customers, facilities):
    df = ships(
        spark,
        shipment("IS1", 1, 3, qty=10.0),
        shipment("IS2", 2, 3, qty=20.0, age=60),
        shipment("IS3", 1, 3, age=61),
        shipment("IS4", 1, 3, status=5),
        shipment("IS5", 1, 3, status=None),
        shipment("IS6", 1, 3, scac=None),
        shipment("DDT1", 1, 3),
        shipment("TOR1", 1, 2),
        shipment("R1", 4, 1, qty=8.0),
    )
    found = history.load_sizes(df, locations, AS_OF)
    assert rows(found) == [
        ("Issue", "CUS03", "Customer three", 2, 15.0),
        ("Return", "CUS04", "Site four", 1, 8.0),
    ]
    named = history.load_sizes_by_model_id(found, customers, facilities)
    assert rows(named, "model_id", "originname", "destinationname") == [
        ("I_CUS03", None, "I_CUS03"),
        ("R_CUS04", "R_CUS04", None),
    ]


def test_lane_history_to_rates(spark, rows, locations, carriers, customers, facilities):
    issue = [shipment(f"IS{k}", 1, 3, scac="DED1", lh=200.0) for k in range(6)]
    issue += [shipment(f"IS9{k}", 1, 3, scac="DED2", lh=400.0) for k in range(6)]
    back = [shipment(f"R{k}", 4, 1, scac="CPU1", lh=0.0) for k in range(3)]
    move = [shipment("TOR1", 1, 2, scac="OTHR"), shipment("TOR2", 1, 2, scac="DED1")]
    df = ships(spark, *issue, *back, *move, shipment("IS77", 1, 99))
    costs = history.lane_costs(df, locations, carriers, AS_OF)
    assert rows(costs.filter("tnumber = 'IS0'"), "lane_id", "ttl_cost", "ttl_fuel_cost") == [
        ("DEP01-CUS03", 442.0, 20.0)
    ]
    cost = history.cost_per_load(costs)
    assert rows(cost) == [("Issue", "DEP01-CUS03", "DED1", "Dedicated", 300.0)]
    loads = history.lane_loads(df, locations, carriers, AS_OF)
    shown = rows(loads, "lane_id", "cpu_loads", "dedicated_loads", "other_loads", "split_flag")
    assert ("DEP01-DEP02", 0, 1, 1, "Split") in shown and (None, 1, 0, 0, "") in shown
    typed = history.lane_types(loads, cost)
    named = history.lane_model_ids(typed, customers, facilities)
    assert rows(named, "originname", "destinationname", "lane_type", "histrate") == [
        ("D_DEP01", "D_DEP02", "Contract Carrier", None),
        ("D_DEP01", "I_CUS03", "Dedicated", 300.0),
        ("R_CUS04", "D_DEP01", "CPU", None),
    ]


def transport(spark, *lanes_):
    schema = (
        "originname string, destinationname string, productname string, modename string, "
        "ocountry string, dcountry string, histrate double, marketrate double, rateused string, "
        "fixedcost double, scac string, scaccarriertype string, cpu string, unitcost double, "
        "dutyrate double, averageshipmentsize double"
    )
    tail = (9.0, 700.0, "old", 9.0, "old", "old", "old", 9.0, 9.0, 9.0)
    return spark.createDataFrame([(o, d, "P", "TL", a, b, *tail) for o, d, a, b in lanes_], schema)


def history_rows(spark, *rows_):
    schema = (
        "originname string, destinationname string, movetype string, lane_id string, "
        "origin_name string, destination_name string, histrate double, scac string, "
        "lane_type string"
    )
    return spark.createDataFrame(
        [(o, d, "Issue", "L", "a", "b", rate, "S", kind) for o, d, rate, kind in rows_], schema
    )


def test_rate_priority_resets_every_row(spark, rows):
    tps = transport(
        spark,
        ("D_AAAAA", "I_CCCCC", "USA", "CAN"),
        ("D_AAAAA", "I_QQQQQ", "CAN", "USA"),
        ("D_AAAAA", "I_HHHHH", "USA", "USA"),
        ("D_AAAAA", "I_MMMMM", None, "USA"),
    )
    past = history_rows(
        spark,
        ("D_AAAAA", "I_CCCCC", 50.0, "CPU"),
        ("D_AAAAA", "I_QQQQQ", 60.0, "Dedicated"),
        ("D_AAAAA", "I_HHHHH", 70.0, "Contract Carrier"),
    )
    rfq = spark.createDataFrame(
        [("AAAAA to CCCCC", 10.0), ("AAAAA to QQQQQ", 20.0)], "lane_name string, rfqrate double"
    )
    out = rates.select_rates(tps, past, rfq)
    cols = ["destinationname", "rateused", "fixedcost", "cpu", "unitcost", "dutyrate", "rfqrate"]
    assert rows(out, *cols) == [
        ("I_CCCCC", "CPU", 0.0, "C", None, 5.0, 10.0),
        ("I_HHHHH", "HistRate", 70.0, None, 0.55, None, None),
        ("I_MMMMM", "MarketRate", 700.0, None, 0.55, None, None),
        ("I_QQQQQ", "rfqrate", 20.0, "D", 0.55, 5.6, 20.0),
    ]
    assert rows(out.filter("destinationname = 'I_MMMMM'"), "histrate", "scac") == [(None, None)]


def test_carrier_flags(spark, rows):
    tps = transport(spark, ("D_1", "I_1", "x", "x"), ("D_2", "I_1", "x", "x"), ("D_1", "I_2", "x", "x"))
    tps = tps.withColumn(
        "cpu", F.when(F.col("destinationname") == "I_2", "X").when(F.col("originname") == "D_1", "D").otherwise("C")
    )
    policies = spark.createDataFrame(
        [("I_1", "D_1", None), ("I_1", "D_2", None), ("I_1", "D_3", "D"), ("I_2", "D_1", "D"), (None, "D_1", "C")],
        "customername string, sourcename string, cpudedicated string",
    )
    assert rows(rates.fulfillment_carrier_flags(policies, tps)) == [
        ("I_1", "D_1", "D"),
        ("I_1", "D_2", "C"),
        ("I_1", "D_3", "NC"),
        ("I_2", "D_1", "D"),
        (None, "D_1", "C"),
    ]
    reset = rows(rates.fulfillment_carrier_flags(policies, tps, reset=True))
    assert ("I_2", "D_1", None) in reset and ("I_1", "D_3", "NC") in reset


def test_depot_attributes_only_for_depots(spark, rows):
    fac = spark.createDataFrame(
        [("D_1",), ("D_2",), ("D_3",), ("R_1",)], "facilityname string"
    ).selectExpr(
        "*", "'old' depottype", "'old' status", "'old' closed", "'old' heat_treatment_rqmt",
        "9D fixedstartupcost", "9D fixedclosingcost", "9D fixedoperatingcost",
    )
    sheet = spark.createDataFrame(
        [("D_1", "T", "NO", None, None), ("D_2", None, None, "Y", 3.0), ("R_1", "T", "NO", "Y", 4.0)],
        "model_id string, type string, closed string, heat_treat string, fixed_upd double",
    )
    out = depots.facility_attributes(fac, sheet)
    cols = ["facilityname", "depottype", "status", "closed", "heat_treatment_rqmt", "fixedoperatingcost"]
    assert rows(out, *cols) == [
        ("D_1", "T", "Include", "NO", "N", 0.0),
        ("D_2", "old", "Exclude", "old", "Y", 3.0),
        ("D_3", "old", "old", "old", "old", 0.0),
        ("R_1", "T", "old", "NO", "Y", 4.0),
    ]


def test_inventory_and_repair(spark, rows):
    sheet = spark.createDataFrame(
        [("D_1", None, 5.0, 2.0, None, 0.25, -4.0, 6.0, 8.0, 3.0)],
        "model_id string, minimum_inv double, storage double, yard_space double, "
        "temp_storage double, dmg_rate double, beginv_rfu double, beginv_wip double, "
        "beginv_mix double, repair_per_day double",
    )
    limits = spark.createDataFrame(
        [("D_1", "MinInventory", 9.0), ("D_1", "Depot_Capacity", 9.0), ("D_2", "MinInventory", 9.0)],
        "facilityname string, notes string, constraintvalue double",
    )
    assert rows(depots.inventory_limits(limits, sheet)) == [
        ("D_1", "Depot_Capacity", 7.0),
        ("D_1", "MinInventory", 0.0),
        ("D_2", "MinInventory", 9.0),
    ]
    note = "Beginning_Inventory"
    stock = spark.createDataFrame(
        [("D_1", "RFU", note, 9.0), ("D_1", "WIP", note, 9.0), ("D_2", "RFU", note, 9.0), ("D_1", "RFU", "x", 9.0)],
        "facilityname string, productname string, notes string, initialinventory double",
    )
    assert rows(depots.initial_inventory(stock, sheet), "facilityname", "productname", "initialinventory") == [
        ("D_1", "RFU", 6.0),
        ("D_1", "RFU", 9.0),
        ("D_1", "WIP", 8.0),
        ("D_2", "RFU", 0.0),
    ]
    periods = spark.createDataFrame([("P1", 20.0), ("P2", None)], "periodname string, workingdays double")
    repair = spark.createDataFrame(
        [("D_1", "P1"), ("D_1", "P2"), ("D_2", "P1"), ("D_1", "P3")], "facilityname string, periodname string"
    ).selectExpr("*", "'Repair_Capacity' notes", "9D constraintvalue")
    out = depots.repair_capacity(repair, sheet, periods)
    assert rows(out, "facilityname", "periodname", "constraintvalue") == [
        ("D_1", "P1", 60.0),
        ("D_1", "P2", 9.0),
        ("D_1", "P3", 9.0),
        ("D_2", "P1", 0.0),
    ]


def test_assigned_return_lanes_reset_returns_only(spark, rows):
    policies = spark.createDataFrame(
        [("R_1", "D_1"), ("R_1", "D_2"), ("D_1", "D_2")], "sourcename string, facilityname string"
    ).selectExpr("*", "'o' planflag", "'o' plan_depot_id", "'o' status", "'o' notes")
    sheet = spark.createDataFrame([("R_1", "D_1"), ("R_1", "D_1")], "oname string, revised_dname string")
    assert rows(flags.assigned_return_lanes(policies, sheet)) == [
        ("D_1", "D_2", "N", "o", "o", "o"),
        ("R_1", "D_1", "Y", "D_1", "Include", "Baseline_Returns"),
        ("R_1", "D_2", "N", "o", "Exclude", "NewAllToAll_Returns"),
    ]


def test_customer_and_return_details(spark, rows, customers, locations, facilities):
    demand = spark.createDataFrame(
        [("I_CUS03", "P01", 5.0), ("I_CUS03", "P12", None), ("I_CUS03", "P13", 7.0)],
        "customername string, periodname string, quantity double",
    )
    out = places.customer_details(customers, locations, demand)
    assert rows(out, "corpcode", "planquantity", "issueqty") == [("K3", 5.0, 5.0)]
    assert rows(flags.active_customers(customers, demand), "status", "inplan") == [("Include", "Y")]
    assert rows(flags.active_customers(customers, demand.limit(0)), "status") == [("Exclude",)]
    sites = facilities.selectExpr("*", "'old' corpcode", "'old' corpname", "-1D returnqty")
    forecast = spark.createDataFrame([], "facilityname string, periodname string, notes string, constraintvalue double")
    out = places.return_details(sites, locations, forecast)
    assert rows(out, "facilityname", "corpcode", "corpname", "returnqty") == [
        ("D_DEP01", "old", "old", -1.0),
        ("D_DEP02", "old", "old", -1.0),
        ("R_CUS04", "old", "Corp four", 0.0),
        ("R_DEP01", "old", "old", 0.0),
    ]
    twice = locations.union(locations.filter("iid = 4"))
    with pytest.raises(PySparkException, match="repeats a key"):
        places.return_details(sites, twice, forecast).collect()


def test_closest_depot_ties_and_missing_distance(spark, rows, facilities):
    policies = spark.createDataFrame(
        [("I_1", "D_DEP02", 5.0), ("I_1", "D_DEP01", 5.0), ("I_2", "D_DEP01", None), ("I_2", "D_DEP02", 900.0)],
        "customername string, sourcename string, distance double",
    )
    near = lanes.closest_depots(policies, facilities, "customername", "sourcename")
    assert rows(near) == [("I_1", "D_DEP01"), ("I_2", "D_DEP02")]
    as_zero = lanes.closest_depots(
        policies, facilities, "customername", "sourcename", Params(missing_distance=0.0)
    )
    assert rows(as_zero) == [("I_1", "D_DEP01"), ("I_2", "D_DEP01")]


@pytest.mark.parametrize(
    "change, verdict",
    [({}, "Y"), ({"planflag": "Y"}, "N"), ({"miles": 1000.1}, "N"), ({"miles": None}, "N")]
    + [({"greenfieldcandidate": None}, "N"), ({"cpudedicated": "C"}, "N")]
    + [({"monthly_avg": 3501.0}, "N"), ({"monthly_avg": 3501.0, "number_of_depots": 2}, "Y")],
)
def test_add_to_model(spark, change, verdict):
    row = {"planflag": "N", "miles": 1000.0, "greenfieldcandidate": "Y", "cpudedicated": None,
           "monthly_avg": 3500.0, "number_of_depots": None} | change
    schema = (
        "planflag string, miles double, greenfieldcandidate string, cpudedicated string, "
        "monthly_avg double, number_of_depots int"
    )
    df = spark.createDataFrame([tuple(row.values())], schema)
    assert df.select(F.when(lanes.add_to_model(), "Y").otherwise("N")).first()[0] == verdict


def test_first_product_decides_the_lane(spark, rows):
    policies = spark.createDataFrame(
        [("I_1", "B", "D_1", 10.0), ("I_1", "A", "D_1", 600.0)],
        "customername string, productname string, sourcename string, distance double",
    )
    old = [c for c in lanes.FULFILLMENT_COLUMNS if c not in ("monthly_avg", "number_of_depots_served")]
    policies = policies.selectExpr(
        "*", "'N' planflag", "'Y' greenfieldcandidate", "cast(null as string) cpudedicated",
        "0D monthly_avg", "0D number_of_depots_served", *[f"'old' {c}" for c in old],
    )
    place = "'US' country, 'G' georegion, 'T' territory, 'S' subterritory, 'Z' zone".split(", ")
    customers = spark.createDataFrame([("I_1",)], "customername string").selectExpr("*", *place)
    facilities = spark.createDataFrame([("D_1",)], "facilityname string").selectExpr(
        "*", "'Full Service' depottype", "'Include' status", *place
    )
    demand = spark.createDataFrame([("I_1", "P01", 4000.0)], "customername string, periodname string, quantity double")
    served = spark.createDataFrame([("I_1", 3)], "model_id string, number_of_depots bigint")
    out = lanes.fulfillment_attributes(policies, customers, facilities, demand, served)
    cols = ["productname", "mileageband", "monthlypalletband", "nbrdepotsband", "addtomodel", "closestdepot"]
    assert rows(out, *cols) == [
        ("A", "GT0500", "GT3500", "GT01", "Y", "Y"),
        ("B", "GT0500", "GT3500", "GT01", "Y", "Y"),
    ]


def test_pallet_penalty_on_manufacturing_lanes(spark, rows):
    policies = spark.createDataFrame(
        [("I_1", "Manufacturing", 9.0), ("I_1", "Storage", 9.0), ("I_2", "Manufacturing", 9.0), ("I_3", "Manufacturing", 9.0)],
        "customername string, depottype string, unitcost double",
    )
    renters = spark.createDataFrame([("I_1", 0.5), ("I_1", 0.5), ("I_2", None)], "model_id string, npd_share double")
    assert rows(penalties.new_pallet_penalty(policies, renters)) == [
        ("I_1", "Manufacturing", 12.5),
        ("I_1", "Storage", 9.0),
        ("I_2", "Manufacturing", 0.0),
        ("I_3", "Manufacturing", 9.0),
    ]


def test_lane_sizes(spark, rows):
    found = spark.createDataFrame(
        [("Issue", "n", 100.0, None, "I_1"), ("Return", "n", 200.0, "R_1", None)],
        "movetype string, customer_name string, average_cube double, originname string, destinationname string",
    )
    tps = transport(
        spark, ("D_1", "I_1", "", ""), ("D_1", "I_2", "", ""), ("R_1", "D_1", "", ""),
        ("R_2", "D_1", "", ""), ("D_1", "D_2", "", ""), (None, "I_1", "", ""),
    )
    assert rows(sizes.lane_sizes(tps, found), "originname", "destinationname", "averageshipmentsize") == [
        ("D_1", "D_2", 560.0),
        ("D_1", "I_1", 100.0),
        ("D_1", "I_2", 521.0),
        ("R_1", "D_1", 200.0),
        ("R_2", "D_1", 487.0),
        (None, "I_1", 9.0),
    ]


def test_multisource(spark, rows, customers, facilities):
    listed = spark.createDataFrame(
        [("Issue", "CUS03", "DEP01", "yes"), ("Issue", "CUS03", "DEP02", "N"), ("Return", "CUS04", "DEP01", " Y "),
         ("Return", "XXXXX", "DEP01", "Y"), ("Return", "CUS04", "DEP02", None)],
        "movetype string, customer_code string, depot_code string, ok_to_include string",
    )
    found = multisource.resolve(listed, customers, facilities)
    assert rows(found) == [
        ("Issue", "D_DEP01", "I_CUS03"),
        ("Return", "R_CUS04", "D_DEP01"),
        ("Return", None, "D_DEP01"),
    ]
    policies = spark.createDataFrame(
        [("I_CUS03", "D_DEP01", "o"), ("I_CUS03", "D_DEP02", "o"), ("I_X", "D_DEP01", "o")],
        "customername string, sourcename string, multi_source_option string",
    )
    assert rows(multisource.flag_fulfillment(policies, found)) == [
        ("I_CUS03", "D_DEP01", "Y"),
        ("I_CUS03", "D_DEP02", "N"),
        ("I_X", "D_DEP01", "o"),
    ]
    groups = spark.createDataFrame(
        [(multisource.KEEP_ISSUES, "Customers", "gone"), ("Mine", "Customers", "m")],
        "groupname string, grouptype string, membername string",
    )
    assert rows(multisource.rebuild_groups(groups, found, customers, facilities), "groupname", "membername") == [
        ("Mine", "m"),
        (multisource.ALLOW_RETURNS, "R_CUS04"),
        (multisource.KEEP_RETURNS, "R_DEP01"),
        (multisource.ALLOW_ISSUES, "I_CUS03"),
    ]


@pytest.mark.parametrize(
    "origin, destination, status",
    [("Manufacturing", "Storage", "Include"), ("Manufacturing", "Sort Only", "Exclude")]
    + [("Full Service", "Manufacturing", "Exclude"), ("Full Service", None, "Include")]
    + [("Sort Only", "Sort Only", "Exclude"), ("Storage", "Storage", "Exclude")]
    + [("Repair Only", "Renter Sort", "Exclude"), ("Repair Only", "Repair Only", "Include")]
    + [("DO NOT USE", None, "Exclude"), ("Renter Sort", "Full Service", "Include")]
    + [("Distributor Sort", None, "Exclude"), (None, "DO NOT USE", "Include")],
)
def test_transfer_matrix(spark, origin, destination, status):
    schema = "sourcename string, facilityname string, odepottype string, ddepottype string, status string"
    df = spark.createDataFrame([("D_1", "D_2", origin, destination, "o"), ("R_1", "D_2", origin, destination, "o")], schema)
    found = {r["sourcename"]: r["status"] for r in transfers.transfer_matrix(df).collect()}
    assert found == {"D_1": status, "R_1": "o"}


def test_preferred_pairs_run_both_ways(spark, rows, facilities):
    policies = spark.createDataFrame(
        [("D_DEP01", "D_DEP02", "o"), ("D_DEP02", "D_DEP01", "o"), ("D_DEP01", "R_CUS04", "o")],
        "facilityname string, sourcename string, rentdistsortprefassig string",
    )
    sheet = spark.createDataFrame([("DEP01", "DEP02"), ("DEP01", "NONE1")], "ocode string, dcode string")
    assert rows(transfers.preferred_pairs(policies, sheet, facilities)) == [
        ("D_DEP01", "D_DEP02", "Y"),
        ("D_DEP01", "R_CUS04", "N"),
        ("D_DEP02", "D_DEP01", "Y"),
    ]


def test_closest_flags_agree_with_the_ranking(spark):
    """Ties, missing distances, products and ends, closed and unknown depots, a hot customer."""
    pick = random.Random(5)
    types = ["Full Service", "Sort Only", "Storage", None]
    depots_ = [(f"D_{k}", pick.choice(types), pick.choice(["Include", "Include", "Exclude"])) for k in range(12)]
    wide = "country georegion territory subterritory zone".split()
    places_ = spark.createDataFrame(depots_, "facilityname string, depottype string, status string")
    places_ = places_.selectExpr("*", *[f"'x' {c}" for c in wide])
    rows_ = {
        (
            pick.choice(["I_hot", "I_hot", *[f"I_{k}" for k in range(30)], None]),
            f"D_{pick.randrange(14)}" if pick.random() < 0.95 else None,
            pick.choice(["RFU", "WIP", "MIX", None]),
        ): pick.choice([None, 5.0, 7.0, 900.0, 1500.0])
        for _ in range(800)
    }
    written = lanes.FULFILLMENT_COLUMNS
    policies = spark.createDataFrame(
        [(*k, v, "N", "Y", None) for k, v in rows_.items()],
        "customername string, sourcename string, productname string, distance double, "
        "planflag string, greenfieldcandidate string, cpudedicated string",
    ).selectExpr("*", *[f"cast(null as {'double' if c in ('monthly_avg', 'number_of_depots_served') else 'string'}) {c}" for c in written])
    customers = policies.selectExpr("customername", *[f"'y' {c}" for c in wide]).distinct()
    demand = spark.createDataFrame([("I_1", "P1", 10.0)], "customername string, periodname string, quantity double")
    served = spark.createDataFrame([("I_1", 2)], "model_id string, number_of_depots long")
    out = lanes.fulfillment_attributes(policies, customers, places_, demand, served)
    near = {tuple(r) for r in lanes.closest_depots(policies, places_, "customername", "sourcename").collect()}
    found = out.select("customername", "sourcename", "closestdepot").collect()
    assert len(found) == len(rows_) and len(near) > 20
    for customer, depot, flag in found:
        known = customer is not None and depot is not None
        assert flag == (("Y" if (customer, depot) in near else "N") if known else None)
    first = {}
    for (customer, depot, product), miles in rows_.items():
        order = (product is None, product or "")
        if customer and depot and order <= first.get((customer, depot), (order,))[0]:
            first[customer, depot] = (order, miles)
    bands = {(r.customername, r.sourcename): r.mileageband for r in out.collect()}
    for lane, (_, miles) in first.items():
        assert (bands[lane] is None) == (miles is None)

"""Column expressions at their edges."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lanewright.functions import bands, nulls
from lanewright.functions import shipments as sf

AS_OF = dt.date(2024, 5, 15)


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "miles, band",
    [(-1.0, "LT0050"), (49.99, "LT0050"), (50.0, "GT0050"), (1999.0, "GT1500")]
    + [(2000.0, "GT2000"), (None, None)],
)
def test_mileage_band_is_left_closed(spark, miles, band):
    assert one(spark, miles, "double", bands.mileage_band) == band


@pytest.mark.parametrize("v, band", [(3500.0, "LT3500"), (3500.1, "GT3500"), (None, "GT3500")])
def test_pallet_band_null_is_high(spark, v, band):
    assert one(spark, v, "double", bands.pallet_band) == band


@pytest.mark.parametrize(
    "shipment, kind, without",
    [("IS1", "Issue", "Issue"), ("R1", "Return", "Return"), ("TOR1", "Transfer", "")]
    + [("DDT1", "", ""), ("", "", ""), (None, "", "")],
)
def test_move_type(spark, shipment, kind, without):
    assert one(spark, shipment, "string", sf.move_type) == kind
    assert one(spark, shipment, "string", lambda c: sf.move_type(c, False)) == without


@pytest.mark.parametrize(
    "age, inside60, inside90",
    [(-10, True, True), (60, True, True), (61, False, True), (90, False, True)]
    + [(91, False, False)],
)
def test_trailing_days_have_no_upper_bound(spark, age, inside60, inside90):
    moment = dt.datetime.combine(AS_OF - dt.timedelta(days=age), dt.time(23, 59))
    for days, inside in ((60, inside60), (90, inside90)):
        found = one(spark, moment, "timestamp", lambda c: sf.within_days(c, AS_OF, days))
        assert found is inside


@pytest.mark.parametrize(
    "day, inside",
    [(dt.date(2024, 2, 1), True), (dt.date(2024, 1, 31), False), (dt.date(2024, 6, 30), True)],
)
def test_trailing_months_count_boundaries(spark, day, inside):
    assert one(spark, day, "date", lambda c: sf.within_months(c, AS_OF, 3)) is inside


def test_trailing_months_cross_the_year(spark):
    january = dt.date(2024, 1, 31)
    for day, inside in ((dt.date(2023, 10, 1), True), (dt.date(2023, 9, 30), False)):
        assert one(spark, day, "date", lambda c: sf.within_months(c, january, 3)) is inside


def test_numbers_from_text(spark):
    for text, value in (("560", 560.0), ("560.0", 560.0), (" 7 ", 7.0), ("", None), ("x", None)):
        assert one(spark, text, "string", nulls.to_double) == value
    for text, value in (("0.125", 0.12), ("0.375", 0.38), ("", 0.0), (None, 0.0)):
        assert one(spark, text, "string", nulls.comparable_number) == value


def test_clip_keeps_null(spark):
    assert one(spark, None, "double", nulls.floor_at) is None
    assert one(spark, -2.0, "double", nulls.floor_at) == 0.0


def test_null_logic(spark):
    assert one(spark, None, "double", lambda c: nulls.is_true(c > 0)) is False
    assert one(spark, None, "string", lambda c: nulls.differs(c, F.lit("v"))) is True
    assert one(spark, None, "string", lambda c: ~nulls.in_list(c, ["v"])) is True


def test_period_and_lane_codes(spark):
    assert one(spark, "Period_07", "string", sf.period_number) == 7
    assert one(spark, "Total", "string", sf.period_number) is None
    assert one(spark, "ABCDE to VWXYZ", "string", sf.origin_code) == "ABCDE"
    assert one(spark, "ABCDE to VWXYZ", "string", sf.destination_code) == "VWXYZ"
    assert one(spark, None, "string", lambda c: sf.lane_id(c, F.lit("B"))) is None


@pytest.mark.parametrize(
    "line_haul, norm, charge, cost",
    [(100.0, 8.0, 4.0, 220.0), (100.0, 8.0, 0.0, None), (0.0, 8.0, 0.0, 8.0)]
    + [(None, None, 4.0, 0.0), (None, 8.0, None, 8.0)],
)
def test_invoice_cost(spark, line_haul, norm, charge, cost):
    df = spark.createDataFrame(
        [(line_haul, 10.0, None, norm, charge)],
        "lh double, fuel double, tax double, norm double, charge double",
    )
    found = df.select(
        sf.invoice_cost(
            F.col("lh"), [F.col("fuel"), F.col("tax")], F.col("norm"), F.col("charge")
        )
    ).first()[0]
    assert found == cost

"""Faults found in review: lost or shifted cells, repeated dimension keys, number-like keys."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lanewright.catalog.queries import Inputs
from lanewright.catalog.views import AS_OF
from lanewright.functions.shipments import within_days, within_months
from lanewright.operators.lookup import lookup
from lanewright.operators.quality import ValidationError, gate_report, unreadable_periods
from lanewright.operators.reconcile import key_diff, normalize, report, same_forms
from lanewright.plans.depots import inventory_limits
from lanewright.plans.lanes import transport_places
from lanewright.plans.refresh import refresh
from lanewright.sources.readers import _read_csv_with_offset, read_side_input
from lanewright.sources.staging import Stage, publish
from lanewright.specs import SideInputSpec, TableSpec


def test_csv_rows_are_dropped_by_position_only(spark, tmp_path, rows):
    path = tmp_path / "sheet.csv"
    path.write_text('note,x,y,z\n\nLoc,Code,,Rate\nnote,x,y,z\nLoc,Code,,Rate\n"a\nb","say ""hi""",1,9.5\n')
    got = _read_csv_with_offset(spark, str(path), 2)
    assert got.columns == ["Loc", "Code", "Rate"]
    assert rows(got) == sorted(
        [("note", "x", "z"), ("Loc", "Code", "Rate"), ("a\nb", 'say "hi"', "9.5")], key=repr
    )


def test_csv_without_header_or_of_many_files_fails(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n")
    with pytest.raises(ValueError, match="no header"):
        _read_csv_with_offset(spark, str(tmp_path / "one.csv"), 3)
    (tmp_path / "two.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="more than one file"):
        _read_csv_with_offset(spark, str(tmp_path), 0)


def test_lookup_with_one_row_keeps_rows(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    dimension = spark.createDataFrame([("a", "y"), ("a", "x"), (None, "n")], "key string, name string")
    got = lookup(df, dimension, {"k": "key"}, {"name": "name"}, one_row=True)
    assert rows(got, "v", "name") == sorted([(1, "x"), (2, None), (3, None)], key=repr)


def test_steps_keep_rows_of_repeated_dimension_keys(spark):
    constraints = spark.createDataFrame(
        [("D_1", "n", 1.0)], "facilityname string, notes string, constraintvalue double"
    )
    depots = spark.createDataFrame(
        [("D_1", 1.0, 1.0, 1.0, 1.0)] * 2,
        "model_id string, minimum_inv double, storage double, yard_space double, temp_storage double",
    )
    assert inventory_limits(constraints, depots).count() == 1
    policies = spark.createDataFrame(
        [("D_1", "D_1", None, None, None, None)],
        "originname string, destinationname string, ocountry string, dcountry string, "
        "oloccode string, dloccode string",
    )
    facilities = spark.createDataFrame(
        [("D_1", "US", "1"), ("D_1", "US", "2")], "facilityname string, country string, loccode string"
    )
    assert transport_places(policies, facilities).count() == 1


def test_number_like_keys_and_undeclared_columns_agree(spark, rows):
    schema = "k string, extra string, code string"
    old = spark.createDataFrame([("560", "5", "01"), ("7", "1.0", "x")], schema)
    new = spark.createDataFrame([("560.0", "5.00", "01"), ("007", "1", "x")], schema)
    a, b = same_forms(old, new, ["k"])
    assert rows(a) == rows(b) == [("560", "5", "01"), ("7", "1", "x")]
    assert key_diff(a, b, ["k"]).count() == 0
    # One side alone does not tell; only blanks go.
    assert rows(normalize(new)) == rows(new)


def test_gate_reports_absent_columns_and_unreadable_numbers(spark, tmp_path, rows):
    path = tmp_path / "sheet.csv"
    path.write_text("Key,Cost,Rate\na,$5.00,1\nb,,2\nc,7,x\nd,7,x\n")
    columns = {"Key": "key", "Cost": "cost", "Rate": "rate", "Mode": "mode"}
    spec = SideInputSpec(
        "sheet", 0, columns, ("key",), numeric=("cost", "rate"), required=("mode", "rate"),
        one_to_one=(("key", "mode"),), allowed={"mode": ("x",)},
    )
    sheet = read_side_input(spark, str(path), spec, list_unreadable=True)
    got = rows(gate_report({"sheet": sheet}, {"sheet": spec}))
    assert got == sorted(
        [
            ("sheet", "absent_column", "mode", 1, 1),
            ("sheet", "missing_values", "rate", 1, 2),
            ("sheet", "unreadable_number", "cost", 1, 1),
            ("sheet", "unreadable_number", "rate", 1, 2),
        ],
        key=repr,
    )


def test_no_window_means_all_of_history(spark, rows):
    days = spark.createDataFrame([("1970-01-01",), ("2030-01-01",), (None,)], "d string")
    moment = days.select(F.to_date("d").alias("d"))
    for within in (within_days, within_months):
        assert moment.filter(within(F.col("d"), dt.date(2001, 8, 1), None)).count() == 2


def test_a_stage_deletes_its_own_tables_only(spark, tmp_path):
    with Stage(spark) as kept:
        kept.cut(spark.range(3), "a")
        with pytest.raises(RuntimeError), Stage(spark) as stage:
            assert stage.cut(spark.range(2), "b").count() == 2
            raise RuntimeError
        assert not os.path.exists(stage.root) and os.path.exists(kept.root)
    assert not os.path.exists(kept.root)


def test_report_holds_whole_rows_of_repeated_keys(spark, rows):
    schema = "k string, n double, only string"
    old = spark.createDataFrame([(None, 1.0, "x"), (None, 2.0, None), ("a", 1.0, "x")], schema)
    new = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 3.0), ("b", None)], "k string, n double")
    keys = spark.createDataFrame([("g", "m")], "g string, m string")
    specs = {"t": TableSpec("t", ("k",), ("n",)), "u": TableSpec("u", ("g", "m"))}
    details = report({"t": old, "u": keys}, {"t": new, "u": keys}, specs)
    assert rows(details["duplicates"], "table_name", "side", "row") == sorted(
        [
            ("t", "old", '{"k":null,"n":1.0,"only":"x"}'),
            ("t", "old", '{"k":null,"n":2.0,"only":null}'),
            ("t", "new", '{"k":"a","n":1.0}'),
            ("t", "new", '{"k":"a","n":3.0}'),
            ("t", "new", '{"k":"a","n":3.0}'),
        ],
        key=repr,
    )
    assert rows(details["key_diff"], "key", "side") == [
        ('{"k":"a"}', "left_only"),
        ('{"k":"b"}', "right_only"),
    ]
    assert details["cell_diff"].count() == 0


def test_unreadable_period_is_a_broken_rule(spark, rows):
    demand = spark.createDataFrame(
        [("Jan", 1.0), ("Jan", 2.0), (None, 1.0), ("P01", 1.0), ("2024-12", 1.0)],
        "periodname string, quantity double",
    )
    assert rows(unreadable_periods(demand, "demand"), "check", "value", "n_rows") == [
        ("unreadable_period", "Jan", 2),
        ("unreadable_period", None, 1),
    ]


def test_a_broken_input_stops_the_refresh_before_it_publishes(spark, sf_dir, tmp_path):
    i = Inputs(spark, sf_dir)
    root = str(tmp_path / "published")
    with Stage(spark) as stage, pytest.raises(ValidationError, match="broken rules"):
        side = {**i.side(), "rfq_rates": i.rfq_rates.union(i.rfq_rates)}
        new = refresh(i.model(), side, i.shipments, i.locations, AS_OF, stage=stage)
        publish(new, root)
    assert not os.path.exists(root)

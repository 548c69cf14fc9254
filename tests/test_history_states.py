"""Windows over monthly states against windows over the facts."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lanewright.catalog.queries import Inputs
from lanewright.catalog.views import AS_OF
from lanewright.plans import history, history_states


@pytest.fixture(scope="module")
def inputs(spark, sf_dir, tmp_path_factory):
    """The facts as a stored table, with shipments of a third of the rows on one lane."""
    i = Inputs(spark, sf_dir)
    folder = str(tmp_path_factory.mktemp("facts"))
    hot = F.col("location_from") % 3 == 0
    odd = i.shipments.withColumns(
        {
            "location_from": F.when(hot, 2).otherwise(F.col("location_from")).cast("bigint"),
            "date_to": F.when(F.col("distance") % 50 == 0, None).otherwise(F.col("date_to")),
            "tnumber": F.when(F.col("distance") % 70 == 0, None).otherwise(F.col("tnumber")),
        }
    )
    odd.write.parquet(f"{folder}/shipments")
    i.stored = spark.read.parquet(f"{folder}/shipments")
    return i


def _windows(i, root, days):
    window = history_states.read_window(i.spark, root, AS_OF, days)
    return [
        (history_states.depots_per_customer(window, i.locations),
         history.depots_per_customer(i.stored, i.locations, AS_OF, days)),
        (history_states.load_sizes(window, i.locations),
         history.load_sizes(i.stored, i.locations, AS_OF, days)),
        (history_states.lane_loads(window, i.locations, i.carrier_types),
         history.lane_loads(i.stored, i.locations, i.carrier_types, AS_OF, days)),
    ]


@pytest.mark.parametrize("days", [0, 17, 60, 91, None])
def test_windows_equal_those_over_the_facts(inputs, rows, tmp_path, days):
    root = str(tmp_path / "states")
    history_states.write_months(inputs.stored, root)
    for ours, theirs in _windows(inputs, root, days):
        assert ours.columns == theirs.columns
        assert rows(ours) == rows(theirs)


def test_changed_months_are_written_anew(inputs, rows, tmp_path):
    root = str(tmp_path / "states")
    first = dt.date(AS_OF.year, AS_OF.month, 1)
    gone = inputs.stored.filter("date_to IS NULL OR month(date_to) <> 2")
    # Before: without the newest facts, and with some that were taken back since.
    wrong = inputs.stored.filter(F.col("date_to") >= F.lit(first)).withColumn("qty_to", F.lit(1e6))
    before = gone.filter(F.col("date_to") < F.lit(first)).unionByName(wrong)
    history_states.write_months(before, root)
    history_states.write_months(inputs.stored, root, dt.date(AS_OF.year - 50, 2, 20))
    for ours, theirs in _windows(inputs, root, 91):
        assert rows(ours) == rows(theirs)
    # A month that lost all its shipments.
    history_states.write_months(inputs.stored.filter(F.col("date_to") < F.lit(first)), root, AS_OF)
    left = history_states.read_window(inputs.spark, root, AS_OF, None)
    assert left.filter(F.col("day") >= F.lit(first)).count() == 0 and left.count() > 0


def test_only_new_facts_and_months_of_the_window_are_read(inputs, tmp_path):
    root = str(tmp_path / "states")
    history_states.write_months(inputs.stored, root)
    window = history_states.read_window(inputs.spark, root, AS_OF, 60)
    frame = history_states.load_sizes(window, inputs.locations)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "shipments" not in plan and "PartitionFilters: [isnotnull(month" in plan
    read = {f.split("month=")[1][:7] for f in window.inputFiles()}
    first = (AS_OF - dt.timedelta(days=60)).strftime("%Y-%m")
    assert any(m < first for m in {d[6:] for d in os.listdir(root) if d.startswith("month=")})
    scan = window._jdf.queryExecution().executedPlan().collectLeaves().head()
    window.collect()
    wanted = {m for m in read if m >= first}
    listed = window._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan is not None and listed.metrics().apply("numPartitions").value() == len(wanted)
    changed = history_states.fold(inputs.stored.filter(F.col("date_to") >= F.lit(AS_OF)))
    assert "GreaterThanOrEqual(date_to" in changed._jdf.queryExecution().executedPlan().toString()


def test_no_facts(spark, inputs, tmp_path):
    root = str(tmp_path / "states")
    history_states.write_months(inputs.stored.limit(0), root)
    assert history_states.read_window(spark, root, AS_OF, 60).count() == 0
    history_states.write_months(inputs.stored, root, dt.date(1970, 1, 1))
    assert history_states.read_window(spark, root, AS_OF, None).agg(F.sum("n")).first()[0] == (
        inputs.stored.filter("date_to IS NOT NULL").count()
    )

"""Numbered versions, their clean-up, and comparison by bucket digests."""

from __future__ import annotations

import os
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lanewright.operators import reconcile, snapshot_diff
from lanewright.operators.buckets import BUCKET, bucket_of
from lanewright.sources import staging
from lanewright.sources.versions import PublishConflict, take_version, vacuum, versions
from lanewright.specs import TableSpec

SPECS = {"t": TableSpec("t", ("k",), ("n",)), "free": TableSpec("free", ())}


def _table(spark, rows, schema="k string, v string, n double"):
    return spark.createDataFrame(rows, schema)


def _publish(spark, root, rows, schema="k string, v string, n double", **more):
    staging.publish({"t": _table(spark, rows, schema)}, root, specs=SPECS, **more)


def _diff(spark, root):
    new, old = versions(spark, root)[:2]
    found = snapshot_diff.diff_versions(spark, root, SPECS, old, new)
    return found, sorted((r.kind, r.key, r.column_name, r.old_value, r.new_value) for r in found.collect())


def test_publishers_at_the_same_time_get_ordered_versions(spark, tmp_path):
    root = str(tmp_path / "p")
    with ThreadPoolExecutor(8) as pool:
        taken = list(pool.map(lambda k: take_version(spark, root, f"run{k}", {"t": k}), range(8)))
    assert sorted(v.number for v in taken) == list(range(1, 9))
    listed = versions(spark, root)
    assert [v.number for v in listed] == list(range(8, 0, -1))
    assert {(v.number, v.run_id) for v in listed} == {(v.number, v.run_id) for v in taken}
    assert not [f for f in os.listdir(f"{root}/versions") if f.startswith("draft")]


def test_one_of_two_based_on_the_same_version_conflicts(spark, rows, tmp_path):
    root = str(tmp_path / "p")
    _publish(spark, root, [("a", "x", 1.0)], based_on=0)
    _publish(spark, root, [("a", "y", 1.0)], based_on=1)
    with pytest.raises(PublishConflict):
        _publish(spark, root, [("a", "z", 1.0)], based_on=1)
    assert [v.number for v in versions(spark, root)] == [2, 1]
    assert rows(staging.read_published(spark, root)["t"]) == [("a", "y", 1.0)]


def test_concurrent_publishers_based_on_one_version(spark, tmp_path):
    root = str(tmp_path / "p")

    def attempt(k):
        try:
            return take_version(spark, root, f"run{k}", {}, based_on=0).number
        except PublishConflict:
            return None

    with ThreadPoolExecutor(6) as pool:
        assert sorted(map(str, pool.map(attempt, range(6)))) == ["1"] + ["None"] * 5


def test_vacuum_keeps_what_versions_and_running_publishers_need(spark, rows, tmp_path):
    root = str(tmp_path / "p")
    for k in range(4):
        staging.publish({"t": _table(spark, [("a", str(k), 1.0)])}, root, run_id=f"r{k}")
    os.makedirs(f"{root}/runs/half")  # of a run that crashed, or is under way
    assert vacuum(spark, root, keep=2) == []
    assert [v.number for v in versions(spark, root)] == [4, 3]
    assert vacuum(spark, root, keep=2, older_than_hours=0) == ["half", "r0", "r1"]
    assert rows(staging.read_published(spark, root, back=1)["t"], "v") == [("2",)]
    with pytest.raises(LookupError):
        staging.read_published(spark, root, back=2)
    with pytest.raises(ValueError):
        vacuum(spark, root, keep=0)
    staging.publish({"t": _table(spark, [("a", "9", 1.0)])}, root)
    assert versions(spark, root)[0].number == 5


def test_spellings_of_a_key_share_a_bucket(spark):
    keys = ["560", "560.0", "0560", "5.6e2", " 560", "560.001"]
    df = spark.createDataFrame([(k, None) for k in keys], "k string, l string")
    assert df.select(bucket_of(["k", "l"], 1000).alias("b")).distinct().count() == 1
    typed = spark.createDataFrame([(560, None)], "k bigint, l string").select(bucket_of(["k", "l"], 1000))
    assert typed.first()[0] == df.select(bucket_of(["k", "l"], 1000)).first()[0]


def test_only_differing_buckets_are_read(spark, tmp_path):
    root = str(tmp_path / "p")
    old = [(f"k{k}", "x", float(k)) for k in range(500)]
    new = [(k, "y" if k == "k7" else v, n) for k, v, n in old if k != "k9"] + [("added", "x", 0.0)]
    _publish(spark, root, old)
    _publish(spark, root, list(reversed(new)))
    newest, before = versions(spark, root)[:2]
    listed = snapshot_diff.changed_buckets(spark, root, before, newest)["t"]
    assert 1 <= len(listed) <= 3
    diff, found = _diff(spark, root)
    assert found == [
        ("cell", '{"k":"k7"}', "v", "x", "y"),
        ("left_only", '{"k":"k9"}', None, None, None),
        ("right_only", '{"k":"added"}', None, None, None),
    ]
    plan = diff._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any(BUCKET in s for s in scans)
    for version in (before, newest):
        part = staging.read_run(spark, root, version, "t")
        scan = part.filter(part[BUCKET].isin(listed))
        scan.collect()
        nodes = scan._jdf.queryExecution().executedPlan().collectLeaves()
        n_files = nodes.head().metrics().apply("numFiles").value()
        assert 0 < n_files <= len(listed) < len(part.inputFiles())
    _publish(spark, root, new)
    assert _diff(spark, root)[1] == [] and _diff(spark, root)[0].columns == diff.columns


def test_profiles_of_the_whole_table_hold_for_a_few_buckets(spark, tmp_path):
    root = str(tmp_path / "p")
    old = [(f"k{k}", "1.0", 0.0) for k in range(50)] + [("odd", "text", 0.0)]
    _publish(spark, root, old)
    _publish(spark, root, [(k, "1" if k == "k3" else v, n) for k, v, n in old])
    assert _diff(spark, root)[1] == [("cell", '{"k":"k3"}', "v", "1.0", "1")]
    root = str(tmp_path / "q")
    _publish(spark, root, old[:-1])
    _publish(spark, root, [(k, "1" if k == "k3" else v, n) for k, v, n in old[:-1]])
    assert _diff(spark, root)[1] == []


def test_versions_of_other_layouts(spark, tmp_path):
    root = str(tmp_path / "p")
    rows = [("a", "x", 1.0), ("b", "x", 1.0)]
    _publish(spark, root, rows, buckets=4)
    _publish(spark, root, [("a", "y", 1.0), ("b", "x", 1.0)], buckets=8)
    assert _diff(spark, root)[1] == [("cell", '{"k":"a"}', "v", "x", "y")]
    staging.publish({"t": _table(spark, rows)}, root)
    with pytest.raises(ValueError, match="with specs"):
        _diff(spark, root)


_ROWS = st.lists(
    st.tuples(
        st.sampled_from(["1", "1.0", "01", "2", "a", None, ""]),
        st.sampled_from([None, "", "x", "3", "3.0"]),
        st.sampled_from([None, 0.0, 1.5]),
    ),
    max_size=6,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=_ROWS, new=_ROWS)
def test_bucket_diff_equals_the_full_one(spark, tmp_path_factory, old, new):
    root = str(tmp_path_factory.mktemp("p"))
    for t in (old, new):
        _publish(spark, root, t, buckets=5)
    tables = [{"t": staging.read_published(spark, root, back=b)["t"]} for b in (1, 0)]
    details = reconcile.report(*tables, SPECS)
    wanted = [(r.side, r.key, None, None, None) for r in details["key_diff"].collect()]
    wanted += [("cell", r.key, r.column_name, r.old_value, r.new_value) for r in details["cell_diff"].collect()]
    found = snapshot_diff.diff_versions(spark, root, SPECS, *reversed(versions(spark, root)))
    got = [(r.kind, r.key, r.column_name, r.old_value, r.new_value) for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))

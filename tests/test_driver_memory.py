"""What the driver holds at a time is bounded, however many tables a run has."""

from __future__ import annotations

import threading
import time

from lanewright.operators.reconcile import summary
from lanewright.sources.staging import CONCURRENT_JOBS, Stage
from lanewright.specs import TableSpec


def test_few_jobs_run_at_a_time(spark, monkeypatch):
    running, most, lock = [0], [0], threading.Lock()

    def cut(self, df, name):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.02)
        with lock:
            running[0] -= 1
        return df

    monkeypatch.setattr(Stage, "cut", cut)
    tables = {f"t{k}": spark.range(k) for k in range(30)}
    assert list(Stage(spark).cut_all(tables)) == list(tables)
    assert most[0] <= CONCURRENT_JOBS


def test_no_plan_of_a_summary_holds_more_than_one_table(spark, tmp_path):
    names = [f"t{k}" for k in range(6)]
    specs = {n: TableSpec(n, ("id",), ()) for n in names}
    old = {n: spark.range(5).selectExpr("id", f"'{n}' AS v") for n in names}
    new = {n: spark.range(1, 6).selectExpr("id", f"'{n}' AS v") for n in names}
    found = summary(old, new, specs)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    keys = found.filter("check_name IN ('keys_old_only', 'keys_new_only')").collect()
    assert sorted(r["table_name"] for r in keys) == sorted(names * 2)
    assert {r["n_found"] for r in keys} == {1}

"""What a run keeps on disk: no shuffle files of tables already written."""

from __future__ import annotations

import glob
import os
import time

import pytest
from pyspark.sql import functions as F
from test_lane_carrier_loads import AS_OF, PLAIN, _shipments

from lanewright.catalog.queries import QUERIES
from lanewright.plans import history
from lanewright.sources import staging
from lanewright.sources.staging import Stage, without_shuffle_files


def _shuffle_files(spark) -> set[str]:
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    local = [f.getAbsolutePath() for f in folders.diskBlockManager().localDirs()]
    return {f for d in local for f in glob.glob(f"{d}/*/shuffle_*") if os.path.getsize(f)}


def test_a_cut_leaves_no_shuffle_files(spark):
    df = spark.range(50_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.sum("id").alias("s"))
    df = df.join(spark.range(1000).withColumnRenamed("id", "k").repartition(7), "k")
    before = _shuffle_files(spark)
    with Stage(spark) as stage:
        cuts = stage.cut_all({"a": df, "b": df.withColumn("t", F.col("s") + 1)})
        for _ in range(50):
            # Removal does not block the write.
            if not (left := _shuffle_files(spark) - before):
                break
            time.sleep(0.1)
        assert not left
        # The frame itself can still be evaluated, also twice, and so can what was cut.
        assert df.count() == df.count() == 1000
        assert cuts["b"].count() == 1000
    assert spark.conf.get(staging._CLEANUP_KEY, "false") == "false"


def test_the_setting_comes_back_after_the_last_write(spark):
    key = staging._CLEANUP_KEY
    for before in (None, "true", "false"):
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
        found = spark.conf.get(key, None)
        with without_shuffle_files(spark):
            with without_shuffle_files(spark):
                assert spark.conf.get(key) == "true"
            assert spark.conf.get(key) == "true"
        assert spark.conf.get(key, None) == found
    spark.conf.unset(key)


def test_a_stage_forgets_tables_nothing_reads(spark):
    with Stage(spark) as stage:
        cuts = stage.cut_all({"a": spark.range(3).toDF("x"), "b": spark.range(4).toDF("x")})
        stage.forget("a", "never_written")
        assert cuts["b"].count() == 4
        with pytest.raises(Exception):
            spark.read.parquet(f"{stage.root}/a").count()


@pytest.mark.parametrize("apart", [False, True])
def test_sums_of_lanes_are_cut_in_a_callers_stage(spark, rows, apart):
    locations = spark.createDataFrame(
        [(i, c, f"name {i}", t) for i, c, t in PLAIN],
        "iid bigint, code string, name string, nav_type string",
    )
    carriers = spark.createDataFrame(
        [("c1", "CPU"), ("c2", "Dedicated")], "scac string, carrier_type string"
    )
    given = (_shipments(spark), locations, carriers, AS_OF, 60, None, 100.0, 0)
    plain = history.typed_lanes(*given, None, apart)
    with Stage(spark) as stage:
        ours = history.typed_lanes(*given, stage, apart)
        found = rows(ours, *plain.columns)
        assert ours.columns == plain.columns and found and found == rows(plain)
        classes = ours.drop("scac", "histrate")._jdf.queryExecution().optimizedPlan().toString()
        assert "tnumber" not in classes and "delivery_date" not in classes


def test_rates_do_not_hold_what_lanes_shuffled(spark, sf_dir):
    """Lanes are a table by the time the policies move, and their sums are gone."""
    plan = QUERIES["rate_selection"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_net" not in plan and "l_returnflag" in plan
    stages = glob.glob(f"{staging.shared_folder(spark).removeprefix('file:')}/lanewright/*")
    newest = max(stages, key=os.path.getmtime)
    assert "lane_history" in os.listdir(newest) and "lane_sums" not in os.listdir(newest)

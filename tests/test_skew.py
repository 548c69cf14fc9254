"""A third of all rows on one key: results stay whole and the shuffle small."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from check import connect, difference, spark_rows, sql_rows
from lanewright.catalog.views import RAW_TABLES, raw

NAMES = (
    "hist_depots_per_customer",
    "hist_load_size",
    "hist_lane_loads",
    "hist_lane_costs",
    "hist_cost_per_load",
    "hist_lane_model_ids",
    "lane_attributes",
    "lane_replenishment",
    "rate_selection",
    "rate_flag_propagation",
    "upd_dedup_first",
    "dq_duplicate_keys",
    "dq_one_to_one",
    "rec_split_duplicates",
    "rec_summary",
)


@pytest.fixture(scope="module")
def skewed(spark, sf_dir, tmp_path_factory):
    """The given tables with a third of the orders on one customer, a third of the
    lines on one depot, and a third of the orders and lines on one key."""
    root = tmp_path_factory.mktemp("skewed")
    hot = {
        "orders": {"o_custkey": ("o_orderkey", 1)},
        "lineitem": {"l_suppkey": ("l_partkey", 1), "l_linenumber": ("l_partkey", 2)},
        "part": {"p_brand": ("p_partkey", "Brand#1")},
    }
    for name in RAW_TABLES:
        df = raw(spark, sf_dir, name)
        for column, (by, value) in hot.get(name, {}).items():
            third = F.col(by) % 3 == 0
            old = F.col(column)
            df = df.withColumn(
                column, F.when(third, F.lit(value)).otherwise(old).cast(df.schema[column].dataType)
            )
        if name == "lineitem":
            df = df.withColumn(
                "l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(5)).otherwise(F.col("l_orderkey")).cast("bigint")
            )
        df.toPandas().to_parquet(root / f"{name}.parquet", coerce_timestamps="us")
    return str(root)


@pytest.fixture(scope="module")
def con(skewed):
    return connect(skewed, RAW_TABLES)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_lose_nothing(spark, skewed, con, name):
    ours = spark_rows(queries()[name](spark, skewed))
    assert len(ours[1]) > 0
    assert difference(ours, sql_rows(con, oracle_sql()[name])) is None


def test_hot_group_is_reduced_before_the_shuffle(spark, tmp_path):
    """60,000 rows of one key leave each map task as one row."""
    from lanewright.operators.rank import first_per_key

    hot = spark.range(60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    top = first_per_key(hot, ["k"], ["id"])
    assert top.count() == 51
    assert written_records(spark, top) <= 6 * 51


def written_records(spark, df) -> int:
    """Shuffle records of a run, from the plan's own metrics."""
    execution = df._jdf.queryExecution()
    df._jdf.collectToPython()
    plan = execution.executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return _records(execution.executedPlan().finalPhysicalPlan())


def _records(node) -> int:
    total = 0
    if node.nodeName().startswith("ShuffleQueryStage"):
        return _records(node.plan())
    if node.nodeName() == "Exchange":
        total += node.metrics().apply("shuffleRecordsWritten").value()
    children = node.children()
    for k in range(children.size()):
        total += _records(children.apply(k))
    return total

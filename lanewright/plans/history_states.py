"""Shipment history kept as states that merge, so a trailing window need not read the facts.

A state row counts the shipments of a day between two locations, by move type,
carrier and whether they count as live. Days merge into any window by adding
up; which depots served a customer follows exactly from the pairs of locations.
States lie in one folder a month. A run reads the facts of the months that
changed, and the windows read the months they cover.

Locations, carriers and customers are looked up when a window is read, so their
tables may change without a state being wrong.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.functions.nulls import is_true, or_zero
from lanewright.functions.shipments import (
    CANCELLED_STATUS,
    DIVERTED_PREFIX,
    TRANSFER,
    move_type,
    not_prefixed,
    within_days,
)
from lanewright.plans import history

KEYS = ("day", "movetype", "live", "scac", "location_from", "location_to")


def first_of_month(day: dt.date) -> dt.date:
    return day.replace(day=1)


def fold(shipments: DataFrame) -> DataFrame:
    """``month`` and the state rows of all dated shipments; one grouping, map-side first."""
    live = is_true(
        (F.col("status") != CANCELLED_STATUS) & not_prefixed(F.col("tnumber"), DIVERTED_PREFIX)
    )
    dated = shipments.filter(F.col("date_to").isNotNull()).select(
        F.to_date("date_to").alias("day"),
        move_type(F.col("tnumber")).alias("movetype"),
        live.alias("live"),
        "scac",
        F.col("location_from").cast("bigint").alias("location_from"),
        F.col("location_to").cast("bigint").alias("location_to"),
        or_zero(F.col("qty_to")).alias("quantity"),
    )
    states = dated.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity")
    )
    return states.withColumn("month", F.date_format("day", "yyyy-MM"))


def write_months(shipments: DataFrame, root: str, since: dt.date | None = None) -> None:
    """Store the states of all months, or anew those of the month of ``since`` and later.

    The bound stands on the raw date, so only the facts of those months are
    read. A month that has no shipment any more loses its states as well.
    """
    spark = shipments.sparkSession
    if since is None:
        fold(shipments).write.mode("overwrite").partitionBy("month").parquet(root)
        return
    first = first_of_month(since)
    changed = fold(shipments.filter(F.col("date_to") >= F.lit(first)))
    # A row of no shipments stands for each month already stored, so that one which has
    # none any more is written over too; readers leave such rows out.
    known = _read(spark, root).filter(F.col("month") >= first.strftime("%Y-%m"))
    empty = known.select("month").distinct().select(
        *[F.lit(0 if c == "n" else None).cast(t).alias(c) for c, t in changed.dtypes if c != "month"],
        "month",
    )
    whole = changed.unionByName(empty)
    (
        whole.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(root)
    )


_SCHEMA = (
    "day date, movetype string, live boolean, scac string, location_from bigint, "
    "location_to bigint, n bigint, quantity double, month string"
)


def _read(spark: SparkSession, root: str) -> DataFrame:
    # Stated, so that a month is not read as a date.
    return spark.read.schema(_SCHEMA).parquet(root)


def read_window(spark: SparkSession, root: str, as_of: dt.date, days: int | None) -> DataFrame:
    """State rows of the window; months before it are not read."""
    states = _read(spark, root).filter("n > 0")
    if days is not None:
        first = as_of - dt.timedelta(days=days)
        states = states.filter(F.col("month") >= first.strftime("%Y-%m"))
    return states.filter(within_days(F.col("day"), as_of, days))


def _without_transfers():
    return F.when(F.col("movetype") == TRANSFER, "").otherwise(F.col("movetype")).alias("movetype")


def depots_per_customer(window: DataFrame, locations: DataFrame) -> DataFrame:
    lanes = window.select(_without_transfers(), "location_from", "location_to").distinct()
    return history.depots_of_lanes(lanes, locations)


def load_sizes(window: DataFrame, locations: DataFrame) -> DataFrame:
    kept = window.filter(
        F.col("live") & (F.col("movetype") != TRANSFER) & F.col("scac").isNotNull()
    )
    by_ends = kept.groupBy("movetype", "location_from", "location_to").agg(
        F.sum("n").alias("n"), F.sum("quantity").alias("quantity")
    )
    return history.load_sizes_of_ends(by_ends, locations)


def lane_loads(window: DataFrame, locations: DataFrame, carrier_types: DataFrame) -> DataFrame:
    kept = window.filter(F.col("live") & F.col("scac").isNotNull())
    by_ends = kept.groupBy("movetype", "location_from", "location_to", "scac").agg(
        F.sum("n").alias("n")
    )
    return history.lane_loads_of_ends(by_ends, locations, carrier_types)

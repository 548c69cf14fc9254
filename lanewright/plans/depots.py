"""Depot costs, attributes, inventory and repair limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.functions.nulls import floor_at, or_zero
from lanewright.operators.lookup import lookup
from lanewright.operators.update import Update, update_all, update_by_key
from lanewright.specs import Params


def fulfillment_unit_cost(policies: DataFrame, depots: DataFrame) -> DataFrame:
    """Reset unit cost to 0, then take cost and type of the source depot."""
    source = depots.select(
        F.col("model_id").alias("sourcename"),
        or_zero(F.col("paint_upd")).alias("unitcost"),
        F.col("type").alias("depottype"),
    )
    return update_by_key(
        policies, source, ["sourcename"], ["unitcost", "depottype"], defaults={"unitcost": 0.0}
    )


def facility_attributes(facilities: DataFrame, depots: DataFrame) -> DataFrame:
    return update_all(facilities, [facility_attributes_update(depots)])


def facility_attributes_update(depots: DataFrame) -> Update:
    """Costs, heat treatment, type and status. Only 'D' ids get a status."""
    status = F.when(
        F.col("model_id").startswith("D"),
        F.when(F.col("closed") == "NO", "Include").otherwise("Exclude"),
    )
    source = depots.select(
        F.col("model_id").alias("facilityname"),
        or_zero(F.col("fixed_upd")).alias("fixedoperatingcost"),
        F.coalesce("heat_treat", F.lit("N")).alias("heat_treatment_rqmt"),
        F.col("type").alias("depottype"),
        "closed",
        status.alias("status"),
    )
    columns = ["fixedoperatingcost", "heat_treatment_rqmt", "depottype", "closed", "status"]
    reset = {"fixedstartupcost": 0.0, "fixedclosingcost": 0.0, "fixedoperatingcost": 0.0}
    return Update(source, ["facilityname"], columns, defaults=reset)


def inventory_limits(
    constraints: DataFrame, depots: DataFrame, params: Params = Params()
) -> DataFrame:
    """Minimum and capacity rows. Gaps in a listed depot count 0; unlisted depots keep.

    The new value depends on the row's own key only, so it is computed in
    place and no update source is built.
    """
    limits = depots.select(
        "model_id",
        or_zero(F.col("minimum_inv")).alias("lowest"),
        (
            or_zero(F.col("storage"))
            + or_zero(F.col("yard_space"))
            + or_zero(F.col("temp_storage"))
        ).alias("highest"),
    )
    joined = lookup(
        constraints,
        limits,
        {"facilityname": "model_id"},
        {"__lowest": "lowest", "__highest": "highest"},
        one_row=True,
    )
    value = F.when(F.col("notes") == params.min_inventory_notes, F.col("__lowest")).when(
        F.col("notes") == params.max_inventory_notes, F.col("__highest")
    )
    return joined.withColumn(
        "constraintvalue", F.coalesce(value, F.col("constraintvalue"))
    ).select(*constraints.columns)


def initial_inventory(
    policies: DataFrame, depots: DataFrame, params: Params = Params()
) -> DataFrame:
    """Ready stock plus sound mixed stock, else work in progress plus damaged.

    Negative inputs count 0, and so do gaps and unlisted depots.
    """
    names = ("dmg_rate", "beginv_rfu", "beginv_wip", "beginv_mix")
    stock = depots.select("model_id", *[floor_at(F.col(c)).alias(c) for c in names])
    joined = lookup(
        policies, stock, {"facilityname": "model_id"}, {f"__{c}": c for c in names}, one_row=True
    )
    damage, ready, progress, mixed = (or_zero(F.col(f"__{c}")) for c in names)
    value = F.when(
        F.col("productname") == params.ready_product, ready + (1 - damage) * mixed
    ).otherwise(progress + damage * mixed)
    chosen = F.when(F.col("notes") == params.initial_inventory_notes, value)
    return joined.withColumn(
        "initialinventory", F.coalesce(chosen, F.col("initialinventory"))
    ).select(*policies.columns)


def repair_capacity(
    constraints: DataFrame, depots: DataFrame, periods: DataFrame, params: Params = Params()
) -> DataFrame:
    """Working days times repairs a day. Unlisted depots get 0, unknown periods keep."""
    joined = lookup(
        constraints, periods, {"periodname": "periodname"}, {"__days": "workingdays"}, one_row=True
    )
    joined = lookup(
        joined, depots, {"facilityname": "model_id"}, {"__repairs": "repair_per_day"}, one_row=True
    )
    capacity = F.col("__days").cast("double") * or_zero(F.col("__repairs"))
    chosen = F.when(F.col("notes") == params.repair_notes, capacity)
    return joined.withColumn(
        "constraintvalue", F.coalesce(chosen, F.col("constraintvalue"))
    ).select(*constraints.columns)


def repair_unit_cost(
    policies: DataFrame, depots: DataFrame, params: Params = Params()
) -> DataFrame:
    source = depots.select(
        F.col("model_id").alias("facilityname"),
        F.lit(params.repair_bom).alias("bomname"),
        or_zero(F.col("repair_upd")).alias("unitcost"),
    )
    return update_by_key(
        policies,
        source,
        ["facilityname", "bomname"],
        ["unitcost"],
        on_duplicate="first",
    )


def replenishment_depot_types(policies: DataFrame, depots: DataFrame) -> DataFrame:
    """Type of the source depot and of the destination depot."""
    origin = depots.select("model_id", F.col("type").alias("odepottype"))
    destination = depots.select("model_id", F.col("type").alias("ddepottype"))
    policies = update_by_key(policies, origin, {"sourcename": "model_id"}, ["odepottype"])
    return update_by_key(policies, destination, {"facilityname": "model_id"}, ["ddepottype"])


def handling_cost(policies: DataFrame, depots: DataFrame) -> DataFrame:
    """Inbound is handling plus sorting. Both costs reset to 0 first."""
    source = depots.select(
        F.col("model_id").alias("facilityname"),
        (or_zero(F.col("handling_in_upd")) + or_zero(F.col("sort_upd"))).alias(
            "inboundhandlingcost"
        ),
        F.col("handling_out_upd").alias("outboundhandlingcost"),
    )
    costs = ["inboundhandlingcost", "outboundhandlingcost"]
    return update_by_key(
        policies, source, ["facilityname"], costs, defaults={c: 0.0 for c in costs}
    )

"""Shipment history: depots per customer, load sizes, lane loads, lane costs.

The fact table is reduced by location id, with map-side combine, before any
location is looked up. Lookups then run over group rows only, and a location
with a third of all shipments is as cheap as any other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.functions.nulls import or_zero
from lanewright.functions.shipments import (
    CANCELLED_STATUS,
    CONTRACT,
    CPU,
    CUSTOMER_ROLE,
    DEDICATED,
    DEPOT_ROLE,
    DIVERTED_PREFIX,
    ISSUE,
    OTHER,
    RETURN,
    RETURN_ROLE,
    TRANSFER_PREFIX,
    customer_side,
    depot_side,
    destination_code,
    invoice_cost,
    lane_id,
    move_type,
    not_prefixed,
    origin_code,
    within_days,
    within_months,
)
from lanewright.operators.lookup import lookup, with_prefix_role
from lanewright.operators.rank import top_per_group
from lanewright.operators.update import require_unique
from lanewright.sources.staging import Stage


def _codes() -> tuple[Column, Column]:
    return F.col("origin_code"), F.col("destination_code")


def live_shipments(shipments: DataFrame) -> DataFrame:
    """Not cancelled, not diverted. Missing status or id is out."""
    return shipments.filter(
        (F.col("status") != CANCELLED_STATUS) & not_prefixed(F.col("tnumber"), DIVERTED_PREFIX)
    )


def _with_ends(df: DataFrame, locations: DataFrame, *extra: str) -> DataFrame:
    """Attach the code and further columns of both locations."""
    cols = ("code", *extra)
    df = lookup(df, locations, {"location_from": "iid"}, {f"origin_{c}": c for c in cols})
    return lookup(df, locations, {"location_to": "iid"}, {f"destination_{c}": c for c in cols})


def _carrier_flags(carrier_types: DataFrame) -> DataFrame:
    return (
        carrier_types.groupBy("scac")
        .agg(
            F.max(F.col("carrier_type") == CPU).alias("is_cpu"),
            F.max(F.col("carrier_type") == DEDICATED).alias("is_dedicated"),
        )
        .dropna()
    )


def _with_carrier(df: DataFrame, carrier_types: DataFrame) -> DataFrame:
    return _with_flags(df, _carrier_flags(carrier_types))


def _with_flags(df: DataFrame, flags: DataFrame) -> DataFrame:
    flagged = lookup(
        df, flags, {"scac": "scac"}, {"is_cpu": "is_cpu", "is_dedicated": "is_dedicated"}
    )
    no = F.lit(False)
    return flagged.withColumns(
        {
            "is_cpu": F.coalesce(F.col("is_cpu"), no),
            "is_dedicated": F.coalesce(F.col("is_dedicated"), no),
        }
    )


def depots_per_customer(
    shipments: DataFrame, locations: DataFrame, as_of: dt.date, days: int | None = 90
) -> DataFrame:
    """Distinct depots that served each customer: movetype, customer, number_of_depots."""
    lanes = (
        shipments.filter(within_days(F.col("date_to"), as_of, days))
        .select(
            move_type(F.col("tnumber"), transfers=False).alias("movetype"),
            "location_from",
            "location_to",
        )
        .distinct()
    )
    return depots_of_lanes(lanes, locations)


def depots_of_lanes(lanes: DataFrame, locations: DataFrame) -> DataFrame:
    """The same from the distinct ``movetype, location_from, location_to``."""
    kind = F.col("movetype")
    coded = _with_ends(lanes, locations).select(
        "movetype",
        depot_side(kind, *_codes()).alias("depot"),
        customer_side(kind, *_codes()).alias("customer"),
    )
    return coded.groupBy("movetype", "customer").agg(
        F.count_distinct("depot").alias("number_of_depots")
    )


def depots_by_model_id(
    depots: DataFrame, customers: DataFrame, facilities: DataFrame
) -> DataFrame:
    """Attach model ids: issues to customers, returns to return sites. Others drop."""
    issue = customers.select(
        F.lit(ISSUE).alias("movetype"),
        F.col("loccode").alias("customer"),
        F.col("customername").alias("model_id"),
    )
    returns = with_prefix_role(facilities, RETURN_ROLE).select(
        F.lit(RETURN).alias("movetype"),
        F.col("loccode").alias("customer"),
        F.col("facilityname").alias("model_id"),
    )
    ids = require_unique(issue.unionByName(returns).dropna(), ["movetype", "customer"])
    return depots.join(ids, ["movetype", "customer"]).dropna()


def load_sizes(
    shipments: DataFrame, locations: DataFrame, as_of: dt.date, days: int | None = 60
) -> DataFrame:
    """Loads and average quantity per movetype and customer."""
    kept = live_shipments(shipments).filter(
        within_days(F.col("date_to"), as_of, days)
        & not_prefixed(F.col("tnumber"), TRANSFER_PREFIX)
        & F.col("scac").isNotNull()
    )
    by_ends = kept.groupBy(
        move_type(F.col("tnumber"), transfers=False).alias("movetype"),
        "location_from",
        "location_to",
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(or_zero(F.col("qty_to"))).alias("quantity"))
    return load_sizes_of_ends(by_ends, locations)


def load_sizes_of_ends(by_ends: DataFrame, locations: DataFrame) -> DataFrame:
    """The same from ``n, quantity`` by move type and both locations."""
    kind = F.col("movetype")
    coded = _with_ends(by_ends, locations, "name").select(
        "movetype",
        customer_side(kind, *_codes()).alias("customer_code"),
        customer_side(kind, F.col("origin_name"), F.col("destination_name")).alias(
            "customer_name"
        ),
        "n",
        "quantity",
    )
    return coded.groupBy("movetype", "customer_code", "customer_name").agg(
        F.sum("n").alias("load_count"),
        (F.sum("quantity") / F.sum("n")).alias("average_cube"),
    )


def load_sizes_by_model_id(
    sizes: DataFrame, customers: DataFrame, facilities: DataFrame
) -> DataFrame:
    """Attach the model id, and name it origin of returns and destination of issues."""
    ids = customers.select(
        F.lit(ISSUE).alias("id_movetype"),
        F.col("loccode").alias("id_code"),
        F.col("customername").alias("id"),
    ).unionByName(
        with_prefix_role(facilities, RETURN_ROLE).select(
            F.lit(RETURN).alias("id_movetype"),
            F.col("loccode").alias("id_code"),
            F.col("facilityname").alias("id"),
        )
    )
    on = {"movetype": "id_movetype", "customer_code": "id_code"}
    named = lookup(sizes, ids, on, {"model_id": "id"})
    kind = F.col("movetype")
    return named.withColumns(
        {
            "originname": F.when(kind == RETURN, F.col("model_id")),
            "destinationname": F.when(kind == ISSUE, F.col("model_id")),
        }
    )


def lane_loads(
    shipments: DataFrame,
    locations: DataFrame,
    carrier_types: DataFrame,
    as_of: dt.date,
    days: int | None = 60,
) -> DataFrame:
    """Loads per lane and carrier class, and whether classes share the lane."""
    kept = live_shipments(shipments).filter(
        within_days(F.col("date_to"), as_of, days) & F.col("scac").isNotNull()
    )
    by_ends = kept.groupBy(
        move_type(F.col("tnumber")).alias("movetype"), "location_from", "location_to", "scac"
    ).agg(F.count(F.lit(1)).alias("n"))
    return lane_loads_of_ends(by_ends, locations, carrier_types)


def lane_loads_of_ends(
    by_ends: DataFrame, locations: DataFrame, carrier_types: DataFrame
) -> DataFrame:
    """The same from ``n`` by move type, both locations and carrier."""
    kind = F.col("movetype")
    coded = _with_ends(_with_carrier(by_ends, carrier_types), locations, "name").select(
        "movetype",
        depot_side(kind, *_codes()).alias("depot"),
        customer_side(kind, *_codes()).alias("customer"),
        lane_id(*_codes()).alias("lane_id"),
        "origin_name",
        "destination_name",
        "is_cpu",
        "is_dedicated",
        "n",
    )
    other = ~F.col("is_cpu") & ~F.col("is_dedicated")
    zero = F.lit(0).cast("bigint")
    loads = coded.groupBy(
        "movetype", "depot", "customer", "lane_id", "origin_name", "destination_name"
    ).agg(
        F.sum(F.when(F.col("is_cpu"), F.col("n")).otherwise(zero)).alias("cpu_loads"),
        F.sum(F.when(F.col("is_dedicated"), F.col("n")).otherwise(zero)).alias(
            "dedicated_loads"
        ),
        F.sum(F.when(other, F.col("n")).otherwise(zero)).alias("other_loads"),
    )
    return loads.withColumn("split_flag", _split_flag())


def _split_flag() -> Column:
    classes = sum(
        (F.col(c) > 0).cast("int") for c in ("cpu_loads", "dedicated_loads", "other_loads")
    )
    return F.when(classes >= 2, "Split").otherwise("")


# What tells shipments apart. Move type, lane, sides and carrier class follow
# from these and are derived after the grouping, which keeps the shuffle narrow.
_SHIPMENT_KEYS = (
    "tnumber",
    "scac",
    "origin_code",
    "origin_nav_type",
    "destination_code",
    "destination_nav_type",
    "creation_date",
    "delivery_date",
    "planned_to",
    "planned_from",
    "date_from",
    "date_to",
    "actual_ship",
    "actual_delivery",
)

# Moments of the start, then those of the end: neighbours are alike, so shuffled rows pack well.
_SHIPMENT_DATES = (
    "creation_date",
    "planned_from",
    "date_from",
    "actual_ship",
    "delivery_date",
    "planned_to",
    "date_to",
    "actual_delivery",
)


def _costed(shipments: DataFrame, as_of: dt.date, months: int | None) -> DataFrame:
    return live_shipments(shipments).filter(
        within_months(F.col("date_to"), as_of, months) & F.col("distance").isNotNull()
    )


def lane_costs(
    shipments: DataFrame,
    locations: DataFrame,
    carrier_types: DataFrame,
    as_of: dt.date,
    months: int | None = 3,
) -> DataFrame:
    """Cost, volume and loads per shipment, lane and carrier.

    A shipment id is a group key, so grouping does not shrink the rows and the
    locations are looked up first. Spark broadcasts them if their size allows it.
    ``lane_carrier_loads`` sums these rows by lane and carrier without that.
    """
    coded = _with_ends(_costed(shipments, as_of, months), locations, "nav_type")
    surcharges = [F.col(c) for c in ("inv_fuel", "inv_other", "inv_detention", "inv_tax")]
    cost = invoice_cost(
        F.col("inv_linehaul"), surcharges, F.col("norm_charge"), F.col("charge")
    )
    sums = coded.groupBy(*_SHIPMENT_KEYS).agg(
        F.sum(cost).alias("ttl_cost"),
        F.sum(-F.col("qty_from")).alias("volume"),
        F.count("qty_from").alias("total_loads"),
        F.sum(or_zero(F.col("inv_fuel"))).alias("ttl_fuel_cost"),
        F.sum(or_zero(F.col("inv_linehaul"))).alias("ttl_lh_cost"),
    )
    kind = F.col("movetype")
    classed = _with_carrier(sums, carrier_types).withColumn(
        "movetype", move_type(F.col("tnumber"))
    )
    return classed.withColumns(
        {
            "depot": depot_side(kind, *_codes()),
            "customer": customer_side(kind, *_codes()),
            "lane_id": lane_id(*_codes()),
            "carrier_type": F.when(F.col("is_cpu"), CPU)
            .when(F.col("is_dedicated"), DEDICATED)
            .otherwise(OTHER),
        }
    ).drop("is_cpu", "is_dedicated")


def carrier_loads(
    costs: DataFrame, min_line_haul: float = 100.0, min_loads: int = 5
) -> DataFrame:
    """Loads and line haul per lane side and carrier, thin groups left out."""
    keys = ["movetype", "lane_id", "depot", "customer", "scac", "carrier_type"]
    kept = costs.filter(
        (F.col("ttl_lh_cost") > min_line_haul) | (F.col("carrier_type") == CPU)
    ).dropna(subset=keys)
    return (
        kept.groupBy(*keys)
        .agg(
            F.sum("total_loads").alias("total_loads"), F.sum("ttl_lh_cost").alias("ttl_lh_cost")
        )
        .filter(F.col("total_loads") > min_loads)
    )


def location_twins(locations: DataFrame, stage: Stage) -> DataFrame | None:
    """``iid, same_end, same_code``: the least id that has the code and type, and the code,
    of a location, for the locations of which it is another one.

    Written, so that Spark knows how few they are. None where an id cannot stand for a
    code: an id repeats, or a code holds the dash of lane ids, so that two pairs of
    codes may be one lane.
    """
    named = locations.filter(F.col("iid").isNotNull())
    odd = named.groupBy("iid").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.contains("code", F.lit("-"))).alias("dash")
    )
    if odd.filter((F.col("n") > 1) | F.col("dash")).take(1):
        return None
    coded = named.filter(F.col("code").isNotNull()).select("iid", "code", "nav_type")
    by_end = coded.groupBy("code", "nav_type").agg(
        F.min("iid").alias("same_end"), F.count(F.lit(1)).alias("n")
    )
    shared = by_end.groupBy("code").agg(
        F.min("same_end").alias("same_code"), F.sum("n").alias("n")
    )
    shared = shared.filter(F.col("n") > 1).select("code", "same_code")
    found = coded.join(shared, "code").join(
        by_end.select(
            F.col("code").alias("__code"), F.col("nav_type").alias("__type"), "same_end"
        ),
        (F.col("code") == F.col("__code")) & F.col("nav_type").eqNullSafe(F.col("__type")),
    )
    other = (F.col("iid") != F.col("same_end")) | (F.col("iid") != F.col("same_code"))
    return stage.cut(found.filter(other).select("iid", "same_end", "same_code"), "location_twins")


def _as_twin(df: DataFrame, twins: DataFrame, which: str) -> DataFrame:
    """Both location ids, that of the twin where there is one."""
    for end in ("location_from", "location_to"):
        found = lookup(df, twins, {end: "iid"}, {"__twin": which})
        df = found.withColumn(end, F.coalesce("__twin", end)).drop("__twin")
    return df


def _sums_enough(min_line_haul: float) -> list[Column]:
    """A shipment counts by its line haul, or by its carrier, which is not known yet.

    Those that do not count by it are few, and a missing sum takes no room.
    """
    enough = F.col("lh") > min_line_haul
    return [
        F.sum(F.when(enough, F.col("n"))).alias("n_enough"),
        F.sum(F.when(enough, F.col("lh"))).alias("lh_enough"),
        F.sum(F.when(~enough, F.col("n"))).alias("n_thin"),
        F.sum(F.when(~enough, F.col("lh"))).alias("lh_thin"),
    ]


def _all_of(sums: str) -> Column:
    none = F.lit(0)
    return F.coalesce(f"{sums}_enough", none) + F.coalesce(f"{sums}_thin", none)


def _loads_by_id(
    shipments: DataFrame,
    carrier_types: DataFrame,
    twins: DataFrame,
    as_of: dt.date,
    months: int | None,
    min_line_haul: float,
    min_loads: int,
) -> DataFrame:
    """Loads and line haul by move type, both ids and carrier, where ids stand for codes."""
    ends = ["location_from", "location_to"]
    kept = _costed(shipments, as_of, months).dropna(subset=["scac", *ends])
    sums = _as_twin(kept, twins, "same_end").groupBy("tnumber", "scac", *ends, *_SHIPMENT_DATES).agg(
        F.count("qty_from").alias("n"), F.sum(or_zero(F.col("inv_linehaul"))).alias("lh")
    )
    typed = sums.select(move_type(F.col("tnumber")).alias("movetype"), "scac", *ends, "n", "lh")
    by_ends = _as_twin(typed, twins, "same_code").groupBy("movetype", *ends, "scac").agg(
        *_sums_enough(min_line_haul)
    )
    classed = _with_carrier(by_ends.filter(_all_of("n") > min_loads), carrier_types)
    cpu = F.col("is_cpu")
    return classed.select(
        "movetype",
        *ends,
        "scac",
        F.when(cpu, CPU)
        .when(F.col("is_dedicated"), DEDICATED)
        .otherwise(OTHER)
        .alias("carrier_type"),
        F.when(cpu, _all_of("n")).otherwise(F.col("n_enough")).alias("total_loads"),
        F.when(cpu, _all_of("lh")).otherwise(F.col("lh_enough")).alias("ttl_lh_cost"),
    ).filter(F.col("total_loads") > min_loads)


def lane_carrier_loads(
    shipments: DataFrame,
    locations: DataFrame,
    carrier_types: DataFrame,
    as_of: dt.date,
    months: int | None = 3,
    min_line_haul: float = 100.0,
    min_loads: int = 5,
    stage: Stage | None = None,
) -> DataFrame:
    """``carrier_loads`` of the ``lane_costs``, locations and carriers looked up at the end.

    Ids of locations stand for their codes: shipments are told apart by them, their
    sums are grouped by them, and only groups with enough loads are looked up.
    """
    twins = location_twins(locations, stage or Stage(shipments.sparkSession))
    if twins is None:
        costs = lane_costs(shipments, locations, carrier_types, as_of, months)
        return carrier_loads(costs, min_line_haul, min_loads)
    loads = _loads_by_id(
        shipments, carrier_types, twins, as_of, months, min_line_haul, min_loads
    )
    kind = F.col("movetype")
    return (
        _with_ends(loads, locations)
        .select(
            "movetype",
            lane_id(*_codes()).alias("lane_id"),
            depot_side(kind, *_codes()).alias("depot"),
            customer_side(kind, *_codes()).alias("customer"),
            "scac",
            "carrier_type",
            "total_loads",
            "ttl_lh_cost",
        )
        .dropna(subset=["lane_id"])
    )


def lane_top_carriers(
    shipments: DataFrame,
    locations: DataFrame,
    carrier_types: DataFrame,
    as_of: dt.date,
    months: int | None = 3,
    min_line_haul: float = 100.0,
    min_loads: int = 5,
    stage: Stage | None = None,
) -> DataFrame:
    """``top_carriers`` of the ``lane_carrier_loads``.

    Where ids stand for codes, a pair of ids is a lane: its carriers are ranked by that,
    and only its first one meets the locations.
    """
    stage = stage or Stage(shipments.sparkSession)
    twins = location_twins(locations, stage)
    if twins is None:
        costs = lane_costs(shipments, locations, carrier_types, as_of, months)
        return top_carriers(carrier_loads(costs, min_line_haul, min_loads))
    loads = _loads_by_id(
        shipments, carrier_types, twins, as_of, months, min_line_haul, min_loads
    )
    by_carrier = loads.drop("ttl_lh_cost").withColumnRenamed("total_loads", "carrier_loads")
    first = top_per_group(
        by_carrier, ["movetype", "location_from", "location_to"], _by_carrier_loads()
    )
    named = _with_ends(first, locations).withColumn("lane_id", lane_id(*_codes()))
    return named.select("movetype", "lane_id", "scac", "carrier_type", "carrier_loads").dropna(
        subset=["lane_id"]
    )


def _by_carrier_loads() -> list[Column]:
    return [F.col("carrier_loads").desc(), F.col("scac").asc(), F.col("carrier_type").asc()]


def top_carriers(loads: DataFrame) -> DataFrame:
    """The carrier with most loads per lane; ties go to the lower code."""
    by_carrier = loads.groupBy("movetype", "lane_id", "scac", "carrier_type").agg(
        F.sum("total_loads").alias("carrier_loads")
    )
    return top_per_group(by_carrier, ["movetype", "lane_id"], _by_carrier_loads())


def cost_per_load(
    costs: DataFrame, min_line_haul: float = 100.0, min_loads: int = 5
) -> DataFrame:
    """Line haul per load over all carriers, with the lane's main carrier."""
    return cost_of_loads(carrier_loads(costs, min_line_haul, min_loads))


def cost_of_loads(loads: DataFrame) -> DataFrame:
    """The same from ``carrier_loads``."""
    by_carrier = loads.groupBy("movetype", "lane_id", "scac", "carrier_type").agg(
        F.sum("total_loads").alias("n"), F.sum("ttl_lh_cost").alias("lh")
    )
    # Lane totals and main carrier come from one grouping, without a self-join.
    main = F.min_by(
        F.struct("scac", "carrier_type"), F.struct(-F.col("n"), "scac", "carrier_type")
    )
    return (
        by_carrier.groupBy("movetype", "lane_id")
        .agg(main.alias("main"), F.try_divide(F.sum("lh"), F.sum("n")).alias("histrate"))
        .select("movetype", "lane_id", "main.scac", "main.carrier_type", "histrate")
    )


def lane_types(loads: DataFrame, cost: DataFrame) -> DataFrame:
    """Carrier class of each lane, with its cost per load and main carrier."""
    joined = loads.dropna().join(
        cost.select("movetype", "lane_id", "scac", "histrate"), ["movetype", "lane_id"], "left"
    )
    return joined.withColumn("lane_type", _lane_type())


def _lane_type() -> Column:
    cpu, dedicated, other = (
        F.col(c) for c in ("cpu_loads", "dedicated_loads", "other_loads")
    )
    shared = F.col("split_flag") == "Split"
    return (
        F.when(~shared & (cpu > 0), CPU)
        .when(~shared & (dedicated > 0), DEDICATED)
        .when(~shared, CONTRACT)
        .when((cpu > dedicated) & (cpu > other), CPU)
        .when((dedicated > cpu) & (dedicated > other), DEDICATED)
        .otherwise(CONTRACT)
    )


def typed_lanes(
    shipments: DataFrame,
    locations: DataFrame,
    carrier_types: DataFrame,
    as_of: dt.date,
    days: int | None = 60,
    months: int | None = 3,
    min_line_haul: float = 100.0,
    min_loads: int = 5,
    stage: Stage | None = None,
    apart: bool = False,
) -> DataFrame:
    """``lane_types`` of the ``lane_loads`` and the cost of the ``lane_carrier_loads``.

    Where each code has one location id, a pair of ids is a lane of both. Shipments are
    then read once, their loads and costs summed side by side, and lanes looked up last.
    With ``apart`` costs have a read of their own, which Spark leaves out where no column
    of it is used.

    In a caller's ``stage`` the sums are cut before they meet locations, so the disk need
    not hold what shipments and what lanes shuffle at the same time.
    """
    given, stage = stage, stage or Stage(shipments.sparkSession)
    twins = location_twins(locations, stage)
    shared = twins is None or bool(twins.take(1))
    if shared or apart:
        carried = lane_carrier_loads(
            shipments, locations, carrier_types, as_of, months, min_line_haul, min_loads, stage
        )
    if shared:
        loads = lane_loads(shipments, locations, carrier_types, as_of, days)
        return lane_types(loads, cost_of_loads(carried))
    ends = ["location_from", "location_to"]
    counted = within_days(F.col("date_to"), as_of, days)
    costed = within_months(F.col("date_to"), as_of, months) & F.col("distance").isNotNull()
    live = live_shipments(shipments).dropna(subset=["scac", *ends])
    # Written, so that Spark knows how few they are.
    flags = stage.cut(_carrier_flags(carrier_types), "carrier_flags")
    cpu, loads = F.col("is_cpu"), F.col("loads")
    dedicated, other = F.col("is_dedicated"), ~cpu & ~F.col("is_dedicated")
    zero = F.lit(0).cast("bigint")
    by_class = [
        F.sum(F.when(cpu, loads).otherwise(zero)).alias("cpu_loads"),
        F.sum(F.when(dedicated, loads).otherwise(zero)).alias("dedicated_loads"),
        F.sum(F.when(other, loads).otherwise(zero)).alias("other_loads"),
    ]
    if apart:
        by_ends = live.filter(counted).groupBy(
            move_type(F.col("tnumber")).alias("movetype"), *ends, "scac"
        ).agg(F.count(F.lit(1)).alias("loads"))
        by_lane = _with_flags(by_ends, flags).groupBy("movetype", *ends).agg(*by_class)
        if given:
            by_lane = given.cut(by_lane, "lane_sums")
        return lane_types(_named_lanes(by_lane, locations), cost_of_loads(carried))
    kept = live.filter(counted | costed)
    sums = kept.groupBy("tnumber", "scac", *ends, *_SHIPMENT_DATES).agg(
        F.count_if(counted).alias("loads"),
        F.count(F.when(costed, F.col("qty_from"))).alias("n"),
        F.sum(F.when(costed, or_zero(F.col("inv_linehaul")))).alias("lh"),
    )
    typed = sums.withColumn("movetype", move_type(F.col("tnumber")))
    by_ends = typed.groupBy("movetype", *ends, "scac").agg(
        F.sum("loads").alias("loads"), *_sums_enough(min_line_haul)
    )
    classed = _with_flags(by_ends, flags)
    n = F.when(cpu, _all_of("n")).otherwise(F.col("n_enough"))
    lh = F.when(cpu, _all_of("lh")).otherwise(F.col("lh_enough"))
    enough = n > min_loads
    by_lane = classed.groupBy("movetype", *ends).agg(
        *by_class,
        F.min(F.when(enough, F.struct((-n).alias("n"), "scac"))).alias("main"),
        F.sum(F.when(enough, n)).alias("n"),
        F.sum(F.when(enough, lh)).alias("lh"),
    )
    lanes = by_lane.filter("cpu_loads > 0 OR dedicated_loads > 0 OR other_loads > 0").select(
        "movetype",
        *ends,
        "cpu_loads",
        "dedicated_loads",
        "other_loads",
        F.col("main.scac").alias("scac"),
        F.try_divide("lh", "n").alias("histrate"),
    )
    if given:
        lanes = given.cut(lanes, "lane_sums")
    return _named_lanes(lanes, locations, "scac", "histrate").withColumn("lane_type", _lane_type())


def _named_lanes(lanes: DataFrame, locations: DataFrame, *extra: str) -> DataFrame:
    """Lanes by pairs of ids, with what their locations say; those with a code or name missing
    drop."""
    kind = F.col("movetype")
    named = _with_ends(lanes, locations, "name").select(
        "movetype",
        lane_id(*_codes()).alias("lane_id"),
        depot_side(kind, *_codes()).alias("depot"),
        customer_side(kind, *_codes()).alias("customer"),
        "origin_name",
        "destination_name",
        "cpu_loads",
        "dedicated_loads",
        "other_loads",
        _split_flag().alias("split_flag"),
        *extra,
    )
    return named.dropna(subset=["lane_id", "depot", "customer", "origin_name", "destination_name"])


def lane_model_ids(
    lanes: DataFrame, customers: DataFrame, facilities: DataFrame, code_length: int = 5
) -> DataFrame:
    """Model ids of both ends, chosen by move type in one pass."""
    roles = customers.select(
        F.lit(CUSTOMER_ROLE).alias("role"), "loccode", F.col("customername").alias("id")
    )
    for prefix in (DEPOT_ROLE, RETURN_ROLE):
        roles = roles.unionByName(
            with_prefix_role(facilities, prefix).select(
                F.lit(prefix).alias("role"), "loccode", F.col("facilityname").alias("id")
            )
        )
    roles = roles.distinct()
    kind = F.col("movetype")
    ends = lanes.withColumns(
        {
            "__o_role": F.when(kind == RETURN, RETURN_ROLE).otherwise(DEPOT_ROLE),
            "__d_role": F.when(kind == ISSUE, CUSTOMER_ROLE).otherwise(DEPOT_ROLE),
            "__o_code": F.when(kind == ISSUE, F.col("depot"))
            .when(kind == RETURN, F.col("customer"))
            .otherwise(origin_code(F.col("lane_id"), code_length)),
            "__d_code": F.when(kind == ISSUE, F.col("customer"))
            .when(kind == RETURN, F.col("depot"))
            .otherwise(destination_code(F.col("lane_id"), code_length)),
        }
    )
    ends = lookup(ends, roles, {"__o_role": "role", "__o_code": "loccode"}, {"originname": "id"})
    ends = lookup(
        ends, roles, {"__d_role": "role", "__d_code": "loccode"}, {"destinationname": "id"}
    )
    return ends.drop("__o_role", "__d_role", "__o_code", "__d_code").dropna(
        subset=["origin_name", "destination_name"]
    )

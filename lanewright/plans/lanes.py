"""Lane attributes, candidates for the model, and the closest depot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewright.functions.bands import depots_band, mileage_band, pallet_band
from lanewright.functions.nulls import in_list, is_true, or_zero
from lanewright.functions.shipments import RETURN_ROLE
from lanewright.operators.lookup import Lookup, lookup, lookup_all
from lanewright.operators.rank import top_per_group
from lanewright.operators.update import update_by_key
from lanewright.plans.places import horizon_totals
from lanewright.specs import Params

# Depot types that can be the closest depot.
CLOSEST_TYPES = ("Full Service", "Sort Only")

_PLACE_COLUMNS = ("country", "georegion", "territory", "subterritory", "zone")

_SHARED_COLUMNS = [
    "oregion",
    "dregion",
    "ocountry",
    "dcountry",
    "oterritory",
    "dterritory",
    "osubterritory",
    "dsubterritory",
    "mileageband",
    "monthly_avg",
    "monthlypalletband",
    "number_of_depots_served",
    "nbrdepotsband",
    "addtomodel",
    "closestdepot",
]
FULFILLMENT_COLUMNS = ["depottype", "ozone", "dzone", *_SHARED_COLUMNS]
REPLENISHMENT_COLUMNS = ["odepottype", "ddepottype", *_SHARED_COLUMNS]


def add_to_model(params: Params = Params()) -> Column:
    """Unplanned greenfield lane in reach, with low volume or a second depot."""
    small = is_true(F.col("monthly_avg") <= params.pallet_limit)
    shared = is_true(F.col("number_of_depots") >= 2)
    candidate = (
        (F.col("planflag") == "N")
        & (F.col("miles") <= params.mileage_limit)
        & (F.col("greenfieldcandidate") == "Y")
        & F.col("cpudedicated").isNull()
        & (small | shared)
    )
    return is_true(candidate)


def _is_open(status: str, depottype: str) -> Column:
    return (F.col(status) == "Include") & in_list(F.col(depottype), CLOSEST_TYPES)


def _miles(params: Params) -> Column:
    miles = F.col("distance").cast("double")
    if params.missing_distance is None:
        return miles
    return F.coalesce(miles, F.lit(params.missing_distance))


def _with_place(
    df: DataFrame,
    places: DataFrame,
    on: dict[str, str],
    end: str,
    **further: str,
) -> DataFrame:
    """Region columns of one lane end, prefixed 'o' or 'd', and ``further`` ones."""
    names = {"georegion": "region"}
    take = {f"{end}{names.get(c, c)}": c for c in _PLACE_COLUMNS}
    return lookup(df, places, on, {**take, **further}, one_row=True)


def _with_bands(df: DataFrame, params: Params, extra_condition: Column | None = None):
    served = or_zero(F.col("number_of_depots"))
    candidate = add_to_model(params)
    if extra_condition is not None:
        candidate = candidate & is_true(extra_condition)
    return df.withColumn("monthly_avg", or_zero(F.col("amount"))).withColumns(
        {
            "mileageband": mileage_band(F.col("miles")),
            "monthlypalletband": pallet_band(F.col("monthly_avg"), params.pallet_limit),
            "number_of_depots_served": served,
            "nbrdepotsband": depots_band(served),
            "addtomodel": F.when(candidate, "Y").otherwise("N"),
        }
    )


def closest_depots(
    policies: DataFrame,
    facilities: DataFrame,
    location: str,
    depot: str,
    params: Params = Params(),
) -> DataFrame:
    """The nearest open depot of a fitting type per location.

    Ties go to the lower depot type, then the lower name. Missing distances
    come last.
    """
    open_depots = facilities.filter(_is_open("status", "depottype"))
    lanes = policies.select(location, depot, _miles(params).alias("miles")).dropna(
        subset=[location]
    )
    near = lookup(
        lanes, open_depots, {depot: "facilityname"}, {"type": "depottype"}, how="inner"
    )
    order = [F.col(c).asc_nulls_last() for c in ("miles", "type", depot)]
    return top_per_group(near, [location], order).select(location, depot)


_OWN_COLUMNS = ["planflag", "distance", "greenfieldcandidate", "cpudedicated"]


def lane_grain(
    policies: DataFrame, keys: Sequence[str], params: Params = Params()
) -> DataFrame:
    """One row per lane: own values of its first product, and ``least_miles`` of any.

    The only narrow read of the policy table: products are folded before the
    shuffle, so what moves is a row a lane and map task. Rows of one product
    that repeat give their smallest own values; a missing product comes last.
    Lanes with a missing end are left out.
    """
    own = F.struct(F.col("productname").isNull().alias("none"), "productname", *_OWN_COLUMNS)
    folded = (
        policies.select(*keys, own.alias("own"), _miles(params).alias("any_miles"))
        .dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.min("own").alias("own"), F.min("any_miles").alias("least_miles"))
    )
    lanes = folded.select(*keys, *[f"own.{c}" for c in _OWN_COLUMNS], "least_miles")
    return lanes.withColumn("miles", _miles(params))


def _with_closest(
    lanes: DataFrame, location: str, depot: str, depottype: str, status: str, among: Column | None = None
) -> DataFrame:
    """Flag the nearest open depot of each location, by the order of ``closest_depots``.

    Lanes are folded already, so a location has a row a depot and no more, and
    the window of a location with a third of all policies is as short as others.
    """
    fits = _is_open(status, depottype)
    if among is not None:
        fits = fits & among
    miles = F.col("least_miles")
    order = F.struct(miles.isNull().alias("none"), "least_miles", depottype, depot)
    nearest = F.min(F.when(fits, order)).over(Window.partitionBy(location))
    hit = is_true(nearest[depot] == F.col(depot))
    return lanes.withColumn("closestdepot", F.when(hit, "Y").otherwise("N"))


def fulfillment_attributes(
    policies: DataFrame,
    customers: DataFrame,
    facilities: DataFrame,
    demand: DataFrame,
    depots_served: DataFrame,
    params: Params = Params(),
) -> DataFrame:
    """Attributes per (customer, source); the first product decides own values."""
    keys = ["customername", "sourcename"]
    lanes = lane_grain(policies, keys, params)
    # What goes by one key stands together: past broadcast size it shares a shuffle.
    lanes = _with_place(
        lanes, facilities, {"sourcename": "facilityname"}, "o", depottype="depottype", ostatus="status"
    )
    lanes = _with_closest(lanes, "customername", "sourcename", "depottype", "ostatus")
    lanes = _with_place(lanes, customers, {"customername": "customername"}, "d")
    monthly = horizon_totals(demand, "customername", "quantity", params, mean=True)
    lanes = lookup(lanes, monthly, {"customername": "customername"}, {"amount": "amount"})
    lanes = lookup(
        lanes,
        depots_served,
        {"customername": "model_id"},
        {"number_of_depots": "number_of_depots"},
        one_row=True,
    )
    lanes = _with_bands(lanes, params)
    return update_by_key(policies, lanes, keys, FULFILLMENT_COLUMNS, source_is_unique=True)


def replenishment_attributes(
    policies: DataFrame,
    facilities: DataFrame,
    production: DataFrame,
    depots_served: DataFrame,
    params: Params = Params(),
) -> DataFrame:
    """The same with a facility at both ends; only return lanes are candidates."""
    keys = ["facilityname", "sourcename"]
    lanes = lane_grain(policies, keys, params)
    for key, end in (("facilityname", "d"), ("sourcename", "o")):
        further = {f"{end}depottype": "depottype", f"{end}status": "status"}
        lanes = _with_place(lanes, facilities, {key: "facilityname"}, end, **further)
    returns = F.col("sourcename").startswith("R")
    lanes = _with_closest(lanes, "sourcename", "facilityname", "ddepottype", "dstatus", returns)
    forecast = production.filter(F.col("notes") == params.returns_notes)
    monthly = horizon_totals(forecast, "facilityname", "constraintvalue", params, mean=True)
    lanes = lookup(lanes, monthly, {"sourcename": "facilityname"}, {"amount": "amount"})
    lanes = lookup(
        lanes,
        depots_served,
        {"sourcename": "model_id"},
        {"number_of_depots": "number_of_depots"},
        one_row=True,
    )
    lanes = _with_bands(lanes, params, F.col("sourcename").startswith(RETURN_ROLE))
    return update_by_key(policies, lanes, keys, REPLENISHMENT_COLUMNS, source_is_unique=True)


_PLACED = ("ocountry", "dcountry", "oloccode", "dloccode")


def place_lookups(facilities: DataFrame) -> list[Lookup]:
    """Country and location code of both ends, from facilities."""
    return [
        Lookup(
            facilities,
            {name: "facilityname"},
            {f"__{end}country": "country", f"__{end}loccode": "loccode"},
            one_row=True,
        )
        for name, end in (("originname", "o"), ("destinationname", "d"))
    ]


def set_places(rows: DataFrame) -> DataFrame:
    """What these lookups found, which drop, in place."""
    found = {c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in _PLACED}
    return rows.withColumns(found).drop(*[f"__{c}" for c in _PLACED])


def transport_places(policies: DataFrame, facilities: DataFrame) -> DataFrame:
    """Country and location code of both ends, from facilities, in place."""
    return set_places(lookup_all(policies, place_lookups(facilities)))

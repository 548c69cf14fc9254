"""Corporate details and planned quantities of customers and return sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.functions.nulls import in_list, or_zero
from lanewright.functions.shipments import RETURN_ROLE, period_number
from lanewright.operators.lookup import lookup, with_prefix_role
from lanewright.operators.update import Update, update_all
from lanewright.specs import Params

# Location types of customers and of return sites.
RENTER = "Renter"
RETURN_SITE_TYPES = ("Distributor", "Recovery", "NPD")


def horizon_totals(
    df: DataFrame, key: str, value: str, params: Params = Params(), mean: bool = False
) -> DataFrame:
    """Sum or mean per key over the planning periods. Null keys drop."""
    kept = df.filter(period_number(F.col("periodname")) <= params.horizon_periods)
    amount = F.col(value).cast("double")
    measure = F.avg(amount) if mean else F.coalesce(F.sum(amount), F.lit(0.0))
    return kept.dropna(subset=[key]).groupBy(key).agg(measure.alias("amount"))


def customer_details(
    customers: DataFrame, locations: DataFrame, demand: DataFrame, params: Params = Params()
) -> DataFrame:
    return update_all(customers, [customer_details_update(customers, locations, demand, params)])


def customer_details_update(
    customers: DataFrame, locations: DataFrame, demand: DataFrame, params: Params = Params()
) -> Update:
    """Of ``customers`` only names and location codes are read, which no update writes."""
    kept = locations.filter((F.col("rl_type") == RENTER) | F.col("rl_type").isNull())
    source = lookup(
        customers.select("customername", "loccode"),
        kept,
        {"loccode": "code"},
        {"corpcode": "corp_code", "corpname": "corp_name"},
    )
    totals = horizon_totals(demand, "customername", "quantity", params)
    source = lookup(
        source, totals, {"customername": "customername"}, {"amount": "amount"}
    ).withColumns(
        {"planquantity": or_zero(F.col("amount")), "issueqty": or_zero(F.col("amount"))}
    )
    return Update(
        source,
        ["customername"],
        ["corpcode", "corpname", "planquantity", "issueqty"],
        on_duplicate="first",
    )


def return_details(
    facilities: DataFrame,
    locations: DataFrame,
    production: DataFrame,
    params: Params = Params(),
) -> DataFrame:
    return update_all(
        facilities, [return_details_update(facilities, locations, production, params)]
    )


def return_details_update(
    facilities: DataFrame,
    locations: DataFrame,
    production: DataFrame,
    params: Params = Params(),
) -> Update:
    """A return site with two locations of a fitting type is an error.

    Of ``facilities`` only names and location codes are read, which no update writes.
    """
    kept = locations.filter(in_list(F.col("rl_type"), RETURN_SITE_TYPES))
    source = lookup(
        with_prefix_role(facilities, RETURN_ROLE).select("facilityname", "loccode"),
        kept,
        {"loccode": "code"},
        {"corpcode": "corp_code", "corpname": "corp_name"},
    )
    forecast = production.filter(F.col("notes") == params.returns_notes)
    totals = horizon_totals(forecast, "facilityname", "constraintvalue", params)
    source = lookup(
        source, totals, {"facilityname": "facilityname"}, {"amount": "amount"}
    ).withColumn("returnqty", or_zero(F.col("amount")))
    return Update(source, ["facilityname"], ["corpcode", "corpname", "returnqty"])

"""Shipment ids, lanes, roles, carriers and trailing windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lanewright.functions.nulls import or_zero

# Shipment id prefixes, move types, carrier classes.
ISSUE, RETURN, TRANSFER = "Issue", "Return", "Transfer"
CPU, DEDICATED, OTHER, CONTRACT = "CPU", "Dedicated", "Other", "Contract Carrier"
CANCELLED_STATUS = 5
DIVERTED_PREFIX = "DDT"
TRANSFER_PREFIX = "TOR"
DEPOT_ROLE, RETURN_ROLE, CUSTOMER_ROLE = "D_", "R_", "I_"


def move_type(shipment_id: Column, transfers: bool = True) -> Column:
    """Issue, Return, Transfer or '' by id prefix; the first match wins."""
    kind = F.when(shipment_id.startswith("IS"), ISSUE).when(shipment_id.startswith("R"), RETURN)
    if transfers:
        kind = kind.when(shipment_id.startswith(TRANSFER_PREFIX), TRANSFER)
    return kind.otherwise("")


def depot_side(movetype: Column, origin: Column, destination: Column) -> Column:
    """Issues leave the depot, returns go to it; other moves have no depot side."""
    return F.when(movetype == ISSUE, origin).when(movetype == RETURN, destination).otherwise("")


def customer_side(movetype: Column, origin: Column, destination: Column) -> Column:
    return F.when(movetype == ISSUE, destination).when(movetype == RETURN, origin).otherwise("")


def lane_id(origin: Column, destination: Column) -> Column:
    """Null if either code is missing."""
    return F.concat(origin, F.lit("-"), destination)


def origin_code(lane: Column, length: int = 5) -> Column:
    return F.left(lane, F.lit(length))


def destination_code(lane: Column, length: int = 5) -> Column:
    return F.right(lane, F.lit(length))


def period_number(period: Column) -> Column:
    """Last two characters of a period name as a number, null if they are not one."""
    return F.right(period, F.lit(2)).try_cast("int")


def carrier_class(scac: Column, cpu, dedicated) -> Column:
    return (
        F.when(scac.isin(list(cpu)), CPU)
        .when(scac.isin(list(dedicated)), DEDICATED)
        .otherwise(OTHER)
    )


def within_days(moment: Column, as_of: dt.date, days: int | None) -> Column:
    """At most ``days`` before ``as_of``. Later moments pass, missing ones do not.

    Stated as a bound on the raw column, so it reaches the scan as a pushed
    filter and prunes partitions. ``None`` means no bound. The same holds for
    ``within_months``.
    """
    if days is None:
        return moment.isNotNull()
    return moment >= F.lit(as_of - dt.timedelta(days=days))


def within_months(moment: Column, as_of: dt.date, months: int | None) -> Column:
    """At most ``months`` month boundaries before ``as_of``."""
    if months is None:
        return moment.isNotNull()
    first = as_of.year * 12 + as_of.month - 1 - months
    return moment >= F.lit(dt.date(first // 12, first % 12 + 1, 1))


def not_prefixed(shipment_id: Column, prefix: str) -> Column:
    return F.left(shipment_id, F.lit(len(prefix))) != prefix


def invoice_cost(
    line_haul: Column,
    surcharges: list[Column],
    norm_charge: Column,
    charge: Column,
) -> Column:
    """Invoiced total scaled to the normal currency, else the normal charge.

    A zero charge gives null, which the sum leaves out.
    """
    total = or_zero(line_haul)
    for part in surcharges:
        total = total + or_zero(part)
    scaled = total * (norm_charge / F.nullif(charge, F.lit(0.0)))
    return F.when(or_zero(line_haul) != 0, scaled).otherwise(or_zero(norm_charge))

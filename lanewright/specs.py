"""Declared keys, types and rules of the model tables and the side inputs."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    """Knobs of one refresh. Labels must equal the notes used in the model."""

    repair_notes: str = "Repair_Capacity"
    min_inventory_notes: str = "MinInventory"
    max_inventory_notes: str = "Depot_Capacity"
    initial_inventory_notes: str = "Beginning_Inventory"
    returns_notes: str = "Returns_Forecast"
    repair_bom: str = "BOM_RFU_REPAIR"
    ready_product: str = "RFU"

    new_pallet_cost: float = 25.0
    load_size_issue: float = 521.0
    load_size_return: float = 487.0
    load_size_transfer: float = 560.0
    fuel_surcharge: float = 0.55
    duty_us_to_canada: float = 5.0
    duty_canada_to_us: float = 5.6

    # Trailing windows; None means all of history.
    days_depots: int | None = 90
    days_load_size: int | None = 60
    days_lane_loads: int | None = 60
    months_costs: int | None = 3
    min_line_haul: float = 100.0
    min_loads: int = 5

    horizon_periods: int = 12
    code_length: int = 5
    pallet_limit: float = 3500.0
    mileage_limit: float = 1000.0
    # None leaves a missing distance missing: it sorts last and bands to null.
    # 0.0 reads it as zero miles.
    missing_distance: float | None = None
    # Clear last month's flags before this month's are written.
    reset_flags: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    primary_key: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    published: bool = True


# Primary keys and numeric columns of the model tables.
MODEL_TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec("customerdemand", (), ("quantity",), published=False),
        TableSpec(
            "customerfulfillmentpolicies",
            ("customername", "productname", "sourcename"),
            ("unitcost", "distance", "monthly_avg", "number_of_depots_served"),
        ),
        TableSpec(
            "customers",
            ("customername",),
            ("planquantity", "issueqty", "avgloadsz"),
        ),
        TableSpec(
            "facilities",
            ("facilityname",),
            (
                "fixedstartupcost",
                "fixedclosingcost",
                "fixedoperatingcost",
                "returnqty",
                "avgloadsz",
            ),
        ),
        TableSpec("groups", ("groupname", "grouptype", "membername")),
        TableSpec(
            "inventoryconstraints",
            (
                "facilityname",
                "facilitynamegroupbehavior",
                "productname",
                "productnamegroupbehavior",
                "periodname",
                "periodnamegroupbehavior",
                "constrainttype",
                "constraintvalueuom",
                "consideredinventory",
            ),
            ("constraintvalue",),
        ),
        TableSpec("inventorypolicies", ("facilityname", "productname"), ("initialinventory",)),
        TableSpec("periods", ("periodname",), ("workingdays",)),
        TableSpec(
            "productionconstraints",
            (
                "facilityname",
                "facilitynamegroupbehavior",
                "productname",
                "productnamegroupbehavior",
                "periodname",
                "periodnamegroupbehavior",
                "bomname",
                "bomnamegroupbehavior",
                "processname",
                "processnamegroupbehavior",
                "constrainttype",
                "constraintvalueuom",
            ),
            ("constraintvalue",),
        ),
        TableSpec(
            "productionpolicies",
            ("facilityname", "productname", "bomname", "processname"),
            ("unitcost",),
        ),
        TableSpec(
            "replenishmentpolicies",
            ("facilityname", "productname", "sourcename"),
            ("unitcost", "distance", "monthly_avg", "number_of_depots_served"),
        ),
        TableSpec(
            "transportationpolicies",
            ("originname", "destinationname", "productname", "modename"),
            (
                "histrate",
                "marketrate",
                "rfqrate",
                "fixedcost",
                "unitcost",
                "dutyrate",
                "averageshipmentsize",
            ),
        ),
        TableSpec(
            "warehousingpolicies",
            ("facilityname", "productname"),
            ("inboundhandlingcost", "outboundhandlingcost"),
        ),
    )
}


# Cells of a side input that should be numbers and are not: array of (column_name, value).
UNREADABLE = "__unreadable"


@dataclass(frozen=True)
class SideInputSpec:
    """One hand-kept input: where its header is, its names, and its rules.

    ``columns`` maps the header text to the name used in the plans. Rules are
    stated on the plan names.
    """

    name: str
    header_row: int
    columns: dict[str, str]
    key: tuple[str, ...]
    numeric: tuple[str, ...] = ()
    one_to_one: tuple[tuple[str, ...], ...] = ()
    required: tuple[str, ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)


# Headers, keys and rules of the seven side inputs.
SIDE_INPUTS: dict[str, SideInputSpec] = {
    spec.name: spec
    for spec in (
        SideInputSpec(
            "depot_assumptions",
            header_row=2,
            columns={
                "ModelID": "model_id",
                "LocCode": "loc_code",
                "Loc Description": "loc_description",
                "Type": "type",
                "Closed": "closed",
                "Paint Upd": "paint_upd",
                "Heat Treat": "heat_treat",
                "Fixed Upd": "fixed_upd",
                "Minimum Inv": "minimum_inv",
                "Storage": "storage",
                "Yard Space": "yard_space",
                "Temp Storage": "temp_storage",
                "DmgRate": "dmg_rate",
                "BegInv_RFU": "beginv_rfu",
                "BegInv_WIP": "beginv_wip",
                "BegInv_MIX": "beginv_mix",
                "Repair / Day": "repair_per_day",
                "Repair Upd": "repair_upd",
                "Handling In Upd": "handling_in_upd",
                "Handling Out Upd": "handling_out_upd",
                "Sort Upd": "sort_upd",
            },
            key=("model_id",),
            numeric=(
                "paint_upd",
                "fixed_upd",
                "minimum_inv",
                "storage",
                "yard_space",
                "temp_storage",
                "dmg_rate",
                "beginv_rfu",
                "beginv_wip",
                "beginv_mix",
                "repair_per_day",
                "repair_upd",
                "handling_in_upd",
                "handling_out_upd",
                "sort_upd",
            ),
            one_to_one=(("model_id", "loc_code", "loc_description"),),
            required=("model_id", "loc_code", "loc_description", "type", "closed"),
        ),
        SideInputSpec(
            "renter_assumptions",
            header_row=3,
            columns={
                "Loc Code": "loc_code",
                "ModelID": "model_id",
                "Loc Desc": "loc_desc",
                "Postal": "postal",
                "City": "city",
                "State": "state",
                "Country": "country",
                "Corp Name": "corp_name",
                "Corp Code": "corp_code",
                "NPD %": "npd_share",
            },
            key=("model_id",),
            numeric=("npd_share",),
            one_to_one=(("loc_code", "model_id", "loc_desc"),),
            required=(
                "loc_code",
                "model_id",
                "loc_desc",
                "postal",
                "city",
                "state",
                "country",
                "corp_name",
                "corp_code",
            ),
        ),
        SideInputSpec(
            "multisource_list",
            header_row=1,
            columns={
                "MoveType": "movetype",
                "CustomerCode": "customer_code",
                "CustName": "customer_name",
                "Cust Zone": "customer_zone",
                "Cust Region": "customer_region",
                "DepotCode": "depot_code",
                "DepotName": "depot_name",
                "Depot Type": "depot_type",
                "Total": "total",
                "Pct of Location Volume": "volume_share",
                "NbrDepots": "depots",
                "OK to Include": "ok_to_include",
            },
            key=("movetype", "customer_code", "depot_code"),
            numeric=("total", "volume_share", "depots"),
            one_to_one=(("customer_code", "customer_name"), ("depot_code", "depot_name")),
            required=(
                "movetype",
                "customer_code",
                "customer_name",
                "customer_zone",
                "customer_region",
                "depot_code",
                "depot_name",
                "depot_type",
                "total",
                "volume_share",
                "depots",
                "ok_to_include",
            ),
            allowed={"ok_to_include": ("YES", "Yes", "yes", "Y", "y", "NO", "N", "no", "n")},
        ),
        SideInputSpec(
            "preferred_depots",
            header_row=0,
            columns={
                "Ocode": "ocode",
                "O-Name": "oname",
                "Dcode": "dcode",
                "D-Name": "dname",
                "Last 90 Days # Loads": "recent_loads",
                "Trans Comments (Y/N)": "comments",
            },
            key=("ocode", "dcode"),
            numeric=("recent_loads",),
            one_to_one=(("ocode", "oname"), ("dcode", "dname")),
            required=("ocode", "oname", "dcode", "dname", "recent_loads", "comments"),
        ),
        SideInputSpec(
            "depot_assignments",
            header_row=0,
            columns={
                "MoveType": "movetype",
                "Loc Code": "loc_code",
                "Location Name": "location_name",
                "Default Depot Code": "depot_code",
                "Default Depot Name": "depot_name",
                "Oname": "oname",
                "RevisedDName": "revised_dname",
            },
            key=("movetype", "loc_code", "depot_code"),
            one_to_one=(("loc_code", "location_name"),),
            required=("movetype", "loc_code", "location_name", "depot_code", "depot_name"),
        ),
        SideInputSpec(
            "carrier_types",
            header_row=0,
            columns={
                "TMS_CarrierSCAC": "scac",
                "TMS_CarrierName": "carrier_name",
                "Carrier_Type": "carrier_type",
            },
            key=("scac", "carrier_name"),
            one_to_one=(("scac", "carrier_name"),),
            required=("scac",),
            allowed={"carrier_type": ("CPU", "Dedicated")},
        ),
        SideInputSpec(
            "rfq_rates",
            header_row=0,
            columns={"Lane Name": "lane_name", "Final Rate Award": "rfqrate"},
            key=("lane_name",),
            numeric=("rfqrate",),
            required=("lane_name", "rfqrate"),
        ),
    )
}

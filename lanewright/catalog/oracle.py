"""SQL that states each query a second time, independently of the plans.

Texts are written against the views and the intermediate relations below; the
relations a text uses are put in front of it as common table expressions.
"""

from __future__ import annotations

from lanewright.catalog.views import AS_OF, PARAMS, VIEWS, with_clause
from lanewright.specs import MODEL_TABLES, SIDE_INPUTS, TableSpec

_DAY = f"DATE '{AS_OF.isoformat()}'"
_MV2 = """CASE WHEN left(tnumber, 2) = 'IS' THEN 'Issue' WHEN left(tnumber, 1) = 'R' THEN 'Return'
  ELSE '' END"""
_MV3 = """CASE WHEN left(tnumber, 2) = 'IS' THEN 'Issue' WHEN left(tnumber, 1) = 'R' THEN 'Return'
  WHEN left(tnumber, 3) = 'TOR' THEN 'Transfer' ELSE '' END"""
_CPU = "(SELECT scac FROM carrier_types WHERE carrier_type = 'CPU')"
_DED = "(SELECT scac FROM carrier_types WHERE carrier_type = 'Dedicated')"
_BOTH = "(SELECT scac FROM carrier_types)"
_CPU_LIST = "('Brand#1', 'Brand#2', 'Brand#3')"
_DED_LIST = "('Brand#4', 'Brand#5', 'Brand#6', 'Brand#7')"
_BAND = """CASE WHEN {0} IS NULL THEN NULL WHEN {0} < 50 THEN 'LT0050' WHEN {0} < 100 THEN 'GT0050'
  WHEN {0} < 150 THEN 'GT0100' WHEN {0} < 200 THEN 'GT0150' WHEN {0} < 300 THEN 'GT0200'
  WHEN {0} < 400 THEN 'GT0300' WHEN {0} < 500 THEN 'GT0400' WHEN {0} < 1000 THEN 'GT0500'
  WHEN {0} < 1500 THEN 'GT1000' WHEN {0} < 2000 THEN 'GT1500' ELSE 'GT2000' END"""
_COST = """CASE WHEN coalesce(inv_linehaul, 0) <> 0
  THEN (coalesce(inv_linehaul, 0) + coalesce(inv_fuel, 0) + coalesce(inv_other, 0)
    + coalesce(inv_detention, 0) + coalesce(inv_tax, 0)) * (norm_charge / nullif(charge, 0))
  ELSE coalesce(norm_charge, 0) END"""
_PERIOD_NO = "CAST(right(periodname, 2) AS INTEGER)"

REL: dict[str, str] = {}


# --- history relations -------------------------------------------------------

REL["ship_ends"] = f"""
SELECT s.*, {_MV2} AS mv2, {_MV3} AS mv3, b.code AS bcode, b.name AS bname, b.nav_type AS btype,
  c.code AS ccode, c.name AS cname, c.nav_type AS ctype
FROM shipments s LEFT JOIN locations b ON s.location_from = b.iid
  LEFT JOIN locations c ON s.location_to = c.iid"""


def _side(mv: str, issue: str, returned: str) -> str:
    return f"CASE {mv} WHEN 'Issue' THEN {issue} WHEN 'Return' THEN {returned} ELSE '' END"


def _trailing(unit: str, n: int | None) -> str:
    if n is None:
        return "date_to IS NOT NULL"
    return f"date_diff('{unit}', CAST(date_to AS DATE), {_DAY}) <= {n}"


def _depots(days: int | None) -> str:
    return f"""
SELECT mv2 AS movetype, {_side("mv2", "ccode", "bcode")} AS customer,
  count(DISTINCT {_side("mv2", "bcode", "ccode")}) AS number_of_depots
FROM ship_ends WHERE {_trailing("day", days)} GROUP BY 1, 2"""


REL["nod_raw"] = _depots(PARAMS.days_depots)
REL["nod"] = """
SELECT movetype, customer, number_of_depots, customername AS model_id
FROM nod_raw JOIN customers ON customer = loccode WHERE movetype = 'Issue'
UNION ALL
SELECT movetype, customer, number_of_depots, facilityname
FROM nod_raw JOIN facilities ON customer = loccode
WHERE movetype = 'Return' AND facilityname LIKE 'R\\_%' ESCAPE '\\'"""
REL["sizes"] = f"""
SELECT movetype, customer_code, customer_name, load_count, average_cube, model_id,
  CASE WHEN movetype = 'Return' THEN model_id END AS originname,
  CASE WHEN movetype = 'Issue' THEN model_id END AS destinationname
FROM (
  SELECT r.*, CASE movetype WHEN 'Issue' THEN customername WHEN 'Return' THEN facilityname END
    AS model_id
  FROM (
    SELECT mv2 AS movetype, {_side("mv2", "ccode", "bcode")} AS customer_code,
      {_side("mv2", "cname", "bname")} AS customer_name, count(*) AS load_count,
      avg(coalesce(qty_to, 0)) AS average_cube
    FROM ship_ends
    WHERE date_diff('day', CAST(date_to AS DATE), {_DAY}) <= {PARAMS.days_load_size}
      AND status <> 5 AND left(tnumber, 3) NOT IN ('DDT', 'TOR') AND scac IS NOT NULL
    GROUP BY 1, 2, 3) r
  LEFT JOIN customers c ON r.customer_code = c.loccode
  LEFT JOIN (SELECT * FROM facilities WHERE left(facilityname, 2) = 'R_') f
    ON r.customer_code = f.loccode)"""


def _loads(days: int | None) -> str:
    return f"""
SELECT *, CASE WHEN (cpu_loads > 0 AND dedicated_loads > 0) OR (cpu_loads > 0 AND other_loads > 0)
    OR (dedicated_loads > 0 AND other_loads > 0) THEN 'Split' ELSE '' END AS split_flag
FROM (
  SELECT mv3 AS movetype, {_side("mv3", "bcode", "ccode")} AS depot,
    {_side("mv3", "ccode", "bcode")} AS customer, bcode || '-' || ccode AS lane_id,
    bname AS origin_name, cname AS destination_name,
    CAST(count(*) FILTER (scac IN {_CPU}) AS BIGINT) AS cpu_loads,
    CAST(count(*) FILTER (scac IN {_DED}) AS BIGINT) AS dedicated_loads,
    CAST(count(*) FILTER (scac NOT IN {_BOTH}) AS BIGINT) AS other_loads
  FROM ship_ends
  WHERE {_trailing("day", days)} AND status <> 5
    AND left(tnumber, 3) <> 'DDT' AND scac IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5, 6)"""


def _costs(months: int | None) -> str:
    return f"""
SELECT mv3 AS movetype, {_side("mv3", "bcode", "ccode")} AS depot,
  {_side("mv3", "ccode", "bcode")} AS customer, bcode || '-' || ccode AS lane_id, scac,
  CASE WHEN scac IN {_CPU} THEN 'CPU' WHEN scac IN {_DED} THEN 'Dedicated' ELSE 'Other' END
    AS carrier_type,
  ccode AS destination_code, ctype AS destination_nav_type, bcode AS origin_code,
  btype AS origin_nav_type, creation_date, delivery_date, planned_to, planned_from, date_from,
  date_to, actual_ship, actual_delivery, tnumber, sum({_COST}) AS ttl_cost,
  sum(qty_from * -1) AS volume, count(qty_from) AS total_loads,
  sum(coalesce(inv_fuel, 0)) AS ttl_fuel_cost, sum(coalesce(inv_linehaul, 0)) AS ttl_lh_cost
FROM ship_ends
WHERE {_trailing("month", months)} AND status <> 5
  AND left(tnumber, 3) <> 'DDT' AND distance IS NOT NULL
GROUP BY ALL"""


REL["loads60"] = _loads(60)
REL["loads_all"] = _loads(PARAMS.days_lane_loads)
REL["costs_all"] = _costs(PARAMS.months_costs)


def _carrier_loads(min_loads: int) -> str:
    return f"""
SELECT movetype, lane_id, depot, customer, scac, carrier_type,
  CAST(sum(total_loads) AS BIGINT) AS total_loads, sum(ttl_lh_cost) AS ttl_lh_cost
FROM costs_all
WHERE (ttl_lh_cost > 100 OR carrier_type = 'CPU') AND lane_id IS NOT NULL AND scac IS NOT NULL
  AND depot IS NOT NULL AND customer IS NOT NULL
GROUP BY ALL HAVING sum(total_loads) > {min_loads}"""


def _top(loads: str) -> str:
    return f"""
SELECT movetype, lane_id, scac, carrier_type, carrier_loads FROM (
  SELECT movetype, lane_id, scac, carrier_type, CAST(sum(total_loads) AS BIGINT) AS carrier_loads,
    row_number() OVER (PARTITION BY movetype, lane_id ORDER BY sum(total_loads) DESC, scac,
      carrier_type) AS rn
  FROM {loads} GROUP BY movetype, lane_id, scac, carrier_type) WHERE rn = 1"""


REL["carrier_loads1"] = _carrier_loads(PARAMS.min_loads)
REL["carrier_loads0"] = _carrier_loads(0)
REL["top1"] = _top("carrier_loads1")
REL["lane_totals"] = """
SELECT movetype, lane_id, CAST(sum(total_loads) AS BIGINT) AS total_loads,
  sum(ttl_lh_cost) AS ttl_lh_cost FROM carrier_loads1 GROUP BY ALL"""
REL["cost_per_load"] = """
SELECT movetype, lane_id, scac, carrier_type, ttl_lh_cost / total_loads AS histrate
FROM lane_totals JOIN top1 USING (movetype, lane_id)"""
REL["lane_types"] = """
SELECT l.*, c.scac, c.histrate, CASE
    WHEN split_flag <> 'Split' AND cpu_loads > 0 THEN 'CPU'
    WHEN split_flag <> 'Split' AND dedicated_loads > 0 THEN 'Dedicated'
    WHEN split_flag <> 'Split' THEN 'Contract Carrier'
    WHEN cpu_loads > dedicated_loads AND cpu_loads > other_loads THEN 'CPU'
    WHEN dedicated_loads > cpu_loads AND dedicated_loads > other_loads THEN 'Dedicated'
    ELSE 'Contract Carrier' END AS lane_type
FROM (SELECT * FROM loads_all WHERE lane_id IS NOT NULL AND depot IS NOT NULL
    AND customer IS NOT NULL) l
  LEFT JOIN cost_per_load c ON l.movetype = c.movetype AND l.lane_id = c.lane_id"""
REL["d_ids"] = "SELECT facilityname, loccode FROM facilities WHERE left(facilityname, 2) = 'D_'"
REL["r_ids"] = "SELECT facilityname, loccode FROM facilities WHERE left(facilityname, 2) = 'R_'"
REL["lane_history"] = f"""
SELECT t.*, d.facilityname AS originname, c.customername AS destinationname
FROM lane_types t LEFT JOIN customers c ON t.customer = c.loccode
  LEFT JOIN d_ids d ON t.depot = d.loccode WHERE movetype = 'Issue'
UNION ALL
SELECT t.*, r.facilityname, d.facilityname
FROM lane_types t LEFT JOIN r_ids r ON t.customer = r.loccode
  LEFT JOIN d_ids d ON t.depot = d.loccode WHERE movetype = 'Return'
UNION ALL
SELECT t.*, a.facilityname, b.facilityname
FROM lane_types t LEFT JOIN d_ids a ON left(t.lane_id, {PARAMS.code_length}) = a.loccode
  LEFT JOIN d_ids b ON right(t.lane_id, {PARAMS.code_length}) = b.loccode
WHERE movetype NOT IN ('Issue', 'Return')"""
REL["msl"] = """
SELECT movetype, CASE WHEN movetype = 'Issue' THEN d.facilityname ELSE r.facilityname END
    AS omodelid,
  CASE WHEN movetype = 'Issue' THEN c.customername ELSE d.facilityname END AS dmodelid
FROM multisource_list m LEFT JOIN customers c ON m.customer_code = c.loccode
  LEFT JOIN r_ids r ON m.customer_code = r.loccode LEFT JOIN d_ids d ON m.depot_code = d.loccode
WHERE ok_to_include IN ('YES', 'Yes', 'yes', 'Y', 'y')"""


# --- steps, as functions of the table they change ----------------------------


def fulfillment_cost(t: str) -> str:
    return f"""
SELECT t.* REPLACE (CASE WHEN a.model_id IS NULL THEN 0 ELSE coalesce(paint_upd, 0) END AS unitcost,
  coalesce(a.type, t.depottype) AS depottype)
FROM {t} t LEFT JOIN depot_assumptions a ON t.sourcename = a.model_id"""


def facility_attributes(t: str) -> str:
    return f"""
SELECT t.* REPLACE (0e0 AS fixedstartupcost, 0e0 AS fixedclosingcost,
  CAST(coalesce(a.fixed_upd, 0) AS DOUBLE) AS fixedoperatingcost,
  CASE WHEN a.model_id IS NULL THEN t.heat_treatment_rqmt ELSE coalesce(a.heat_treat, 'N') END
    AS heat_treatment_rqmt,
  coalesce(a.type, t.depottype) AS depottype, coalesce(a.closed, t.closed) AS closed,
  CASE WHEN left(a.model_id, 1) = 'D' AND a.closed = 'NO' THEN 'Include'
    WHEN left(a.model_id, 1) = 'D' THEN 'Exclude' ELSE t.status END AS status)
FROM {t} t LEFT JOIN depot_assumptions a ON t.facilityname = a.model_id"""


def depot_types(t: str) -> str:
    return f"""
SELECT t.* REPLACE (coalesce(o.type, t.odepottype) AS odepottype,
  coalesce(d.type, t.ddepottype) AS ddepottype)
FROM {t} t LEFT JOIN depot_assumptions o ON t.sourcename = o.model_id
  LEFT JOIN depot_assumptions d ON t.facilityname = d.model_id"""


INVENTORY_LIMITS = """
SELECT t.* REPLACE (CASE WHEN model_id IS NULL THEN constraintvalue
    WHEN notes = 'MinInventory' THEN coalesce(minimum_inv, 0)
    WHEN notes = 'Depot_Capacity' THEN coalesce(storage, 0) + coalesce(yard_space, 0)
      + coalesce(temp_storage, 0)
    ELSE constraintvalue END AS constraintvalue)
FROM inventoryconstraints t LEFT JOIN depot_assumptions ON facilityname = model_id"""
INITIAL_INVENTORY = """
SELECT t.* REPLACE (CASE WHEN notes <> 'Beginning_Inventory' THEN initialinventory
    WHEN model_id IS NULL THEN 0
    WHEN productname = 'RFU' THEN rfu + (1 - dmg) * mix ELSE wip + dmg * mix END
    AS initialinventory)
FROM inventorypolicies t LEFT JOIN (
  SELECT model_id, CASE WHEN dmg_rate > 0 THEN dmg_rate ELSE 0 END AS dmg,
    CASE WHEN beginv_rfu > 0 THEN beginv_rfu ELSE 0 END AS rfu,
    CASE WHEN beginv_wip > 0 THEN beginv_wip ELSE 0 END AS wip,
    CASE WHEN beginv_mix > 0 THEN beginv_mix ELSE 0 END AS mix FROM depot_assumptions) a
  ON facilityname = model_id"""
REPAIR_CAPACITY = """
SELECT t.* REPLACE (CASE WHEN notes = 'Repair_Capacity'
  THEN coalesce(p.workingdays * coalesce(a.repair_per_day, 0), constraintvalue)
  ELSE constraintvalue END AS constraintvalue)
FROM productionconstraints t LEFT JOIN periods p ON t.periodname = p.periodname
  LEFT JOIN depot_assumptions a ON t.facilityname = a.model_id"""
REPAIR_COST = """
SELECT t.* REPLACE (CASE WHEN model_id IS NOT NULL AND bomname = 'BOM_RFU_REPAIR'
  THEN coalesce(repair_upd, 0) ELSE unitcost END AS unitcost)
FROM productionpolicies t LEFT JOIN depot_assumptions ON facilityname = model_id"""
HANDLING_COST = """
SELECT t.* REPLACE (
  CAST(coalesce(handling_in_upd, 0) + coalesce(sort_upd, 0) AS DOUBLE) AS inboundhandlingcost,
  CAST(coalesce(handling_out_upd, 0) AS DOUBLE) AS outboundhandlingcost)
FROM warehousingpolicies t LEFT JOIN depot_assumptions ON facilityname = model_id"""


def assigned_issues(t: str) -> str:
    return f"""
SELECT t.* REPLACE (CASE WHEN a.oname IS NULL THEN 'N' ELSE 'Y' END AS planflag,
  coalesce(a.revised_dname, t.plan_depot_id) AS plan_depot_id,
  CASE WHEN a.oname IS NULL THEN 'Exclude' ELSE 'Include' END AS status,
  CASE WHEN a.oname IS NULL THEN 'NewAllToAll_Issues' ELSE 'Baseline_Issues' END AS notes)
FROM {t} t LEFT JOIN (SELECT DISTINCT oname, revised_dname FROM depot_assignments) a
  ON t.customername = a.oname AND t.sourcename = a.revised_dname"""


def assigned_returns(t: str) -> str:
    return f"""
SELECT t.* REPLACE (CASE WHEN a.oname IS NULL THEN 'N' ELSE 'Y' END AS planflag,
  coalesce(a.revised_dname, t.plan_depot_id) AS plan_depot_id,
  CASE WHEN a.oname IS NOT NULL THEN 'Include' WHEN left(t.sourcename, 1) = 'R' THEN 'Exclude'
    ELSE t.status END AS status,
  CASE WHEN a.oname IS NOT NULL THEN 'Baseline_Returns'
    WHEN left(t.sourcename, 1) = 'R' THEN 'NewAllToAll_Returns' ELSE t.notes END AS notes)
FROM {t} t LEFT JOIN (SELECT DISTINCT oname, revised_dname FROM depot_assignments) a
  ON t.sourcename = a.oname AND t.facilityname = a.revised_dname"""


def active_customers(t: str) -> str:
    return f"""
SELECT t.* REPLACE (CASE WHEN q > 0 THEN 'Include' ELSE 'Exclude' END AS status,
  CASE WHEN q > 0 THEN 'Y' ELSE 'N' END AS inplan)
FROM {t} t LEFT JOIN (SELECT customername, sum(quantity) AS q FROM customerdemand GROUP BY 1) d
  ON t.customername = d.customername"""


def active_returns(t: str) -> str:
    return f"""
SELECT t.* REPLACE (
  CASE WHEN d.facilityname IS NULL AND left(t.facilityname, 2) <> 'R_' THEN t.status
    WHEN q > 0 THEN 'Include' ELSE 'Exclude' END AS status,
  CASE WHEN d.facilityname IS NULL AND left(t.facilityname, 2) <> 'R_' THEN t.inplanmodel
    WHEN q > 0 THEN 'Y' ELSE 'N' END AS inplanmodel)
FROM {t} t LEFT JOIN (SELECT facilityname, sum(constraintvalue) AS q FROM productionconstraints
  WHERE notes = 'Returns_Forecast' GROUP BY 1) d ON t.facilityname = d.facilityname"""


def customer_details(t: str) -> str:
    return f"""
SELECT t.* REPLACE (coalesce(corp_code, t.corpcode) AS corpcode,
  coalesce(corp_name, t.corpname) AS corpname,
  CAST(coalesce(q, 0) AS DOUBLE) AS planquantity, CAST(coalesce(q, 0) AS DOUBLE) AS issueqty)
FROM {t} t LEFT JOIN (SELECT * FROM locations WHERE rl_type = 'Renter' OR rl_type IS NULL) l
    ON t.loccode = l.code
  LEFT JOIN (SELECT customername, sum(quantity) AS q FROM customerdemand
    WHERE {_PERIOD_NO} <= 12 GROUP BY 1) d ON t.customername = d.customername"""


def return_details(t: str) -> str:
    return f"""
SELECT t.* EXCLUDE (is_r) REPLACE (
  CASE WHEN is_r THEN coalesce(corp_code, t.corpcode) ELSE t.corpcode END AS corpcode,
  CASE WHEN is_r THEN coalesce(corp_name, t.corpname) ELSE t.corpname END AS corpname,
  CASE WHEN is_r THEN CAST(coalesce(q, 0) AS DOUBLE) ELSE t.returnqty END AS returnqty)
FROM (SELECT *, left(facilityname, 2) = 'R_' AS is_r FROM {t}) t
  LEFT JOIN (SELECT * FROM locations WHERE rl_type IN ('Distributor', 'Recovery', 'NPD')) l
    ON t.loccode = l.code
  LEFT JOIN (SELECT facilityname, sum(constraintvalue) AS q FROM productionconstraints
    WHERE notes = 'Returns_Forecast' AND {_PERIOD_NO} <= 12 GROUP BY 1) d
    ON t.facilityname = d.facilityname"""


def _closest(t: str, f: str, location: str, depot: str, where: str = "true") -> str:
    return f"""
SELECT {location}, {depot} FROM (
  SELECT p.{location}, p.{depot}, row_number() OVER (PARTITION BY p.{location}
    ORDER BY p.distance NULLS LAST, f.depottype, p.{depot}) AS rn
  FROM {t} p JOIN {f} f ON p.{depot} = f.facilityname
  WHERE f.status = 'Include' AND f.depottype IN ('Full Service', 'Sort Only') AND {where})
WHERE rn = 1"""


_ADD = """CASE WHEN planflag = 'N' AND distance <= 1000 AND greenfieldcandidate = 'Y'
  AND cpudedicated IS NULL AND (coalesce(q, 0) <= 3500 OR number_of_depots >= 2) {extra}
  THEN 'Y' ELSE 'N' END"""


def _first_product(t: str) -> str:
    return f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {{keys}} ORDER BY productname) AS rn
  FROM {t}) WHERE rn = 1"""


_BANDS = f"""{_BAND.format("p.distance")} AS mileageband, CAST(coalesce(q, 0) AS DOUBLE) AS monthly_avg,
    CASE WHEN coalesce(q, 0) <= 3500 THEN 'LT3500' ELSE 'GT3500' END AS monthlypalletband,
    CAST(coalesce(number_of_depots, 0) AS DOUBLE) AS number_of_depots_served,
    CASE WHEN coalesce(number_of_depots, 0) <= 1 THEN 'LT01' ELSE 'GT01' END AS nbrdepotsband"""
_KEPT_LANE = [
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


def _keep(columns: list[str]) -> str:
    return ", ".join(f"coalesce(s.{c}, t.{c}) AS {c}" for c in columns)


def fulfillment_attributes(t: str, c: str, f: str) -> str:
    return f"""
SELECT t.* REPLACE ({_keep(["depottype", "ozone", "dzone", *_KEPT_LANE])})
FROM {t} t LEFT JOIN (
  SELECT p.customername, p.sourcename, f.depottype, f.georegion AS oregion,
    c.georegion AS dregion, f.country AS ocountry, c.country AS dcountry, f.zone AS ozone,
    c.zone AS dzone, f.territory AS oterritory, c.territory AS dterritory,
    f.subterritory AS osubterritory, c.subterritory AS dsubterritory, {_BANDS},
    {_ADD.format(extra="")} AS addtomodel,
    CASE WHEN k.sourcename IS NULL THEN 'N' ELSE 'Y' END AS closestdepot
  FROM ({_first_product(t).format(keys="customername, sourcename")}) p
    LEFT JOIN {c} c ON p.customername = c.customername
    LEFT JOIN {f} f ON p.sourcename = f.facilityname
    LEFT JOIN (SELECT customername, avg(quantity) AS q FROM customerdemand
      WHERE {_PERIOD_NO} <= 12 GROUP BY 1) d ON p.customername = d.customername
    LEFT JOIN nod ON p.customername = nod.model_id
    LEFT JOIN ({_closest(t, f, "customername", "sourcename")}) k
      ON p.customername = k.customername AND p.sourcename = k.sourcename) s
  ON t.customername = s.customername AND t.sourcename = s.sourcename"""


def replenishment_attributes(t: str, f: str) -> str:
    is_return = "left(p.sourcename, 1) = 'R'"
    return f"""
SELECT t.* REPLACE ({_keep(["odepottype", "ddepottype", *_KEPT_LANE])})
FROM {t} t LEFT JOIN (
  SELECT p.facilityname, p.sourcename, o.depottype AS odepottype, e.depottype AS ddepottype,
    o.georegion AS oregion, e.georegion AS dregion, o.country AS ocountry, e.country AS dcountry,
    o.territory AS oterritory, e.territory AS dterritory, o.subterritory AS osubterritory,
    e.subterritory AS dsubterritory, {_BANDS},
    {_ADD.format(extra="AND left(p.sourcename, 2) = 'R_'")} AS addtomodel,
    CASE WHEN k.sourcename IS NULL THEN 'N' ELSE 'Y' END AS closestdepot
  FROM ({_first_product(t).format(keys="facilityname, sourcename")}) p
    LEFT JOIN {f} o ON p.sourcename = o.facilityname
    LEFT JOIN {f} e ON p.facilityname = e.facilityname
    LEFT JOIN (SELECT facilityname, avg(constraintvalue) AS q FROM productionconstraints
      WHERE notes = 'Returns_Forecast' AND {_PERIOD_NO} <= 12 GROUP BY 1) d
      ON p.sourcename = d.facilityname
    LEFT JOIN nod ON p.sourcename = nod.model_id
    LEFT JOIN ({_closest(t, f, "sourcename", "facilityname", is_return)}) k
      ON p.sourcename = k.sourcename AND p.facilityname = k.facilityname) s
  ON t.facilityname = s.facilityname AND t.sourcename = s.sourcename"""


def transport_places(t: str, f: str) -> str:
    return f"""
SELECT t.* REPLACE (coalesce(o.country, t.ocountry) AS ocountry,
  coalesce(d.country, t.dcountry) AS dcountry, coalesce(o.loccode, t.oloccode) AS oloccode,
  coalesce(d.loccode, t.dloccode) AS dloccode)
FROM {t} t LEFT JOIN {f} o ON t.originname = o.facilityname
  LEFT JOIN {f} d ON t.destinationname = d.facilityname"""


def pallet_penalty(t: str) -> str:
    return f"""
SELECT t.* REPLACE (CASE WHEN r.model_id IS NOT NULL AND depottype = 'Manufacturing'
  THEN coalesce(npd_share * 25, 0) ELSE unitcost END AS unitcost)
FROM {t} t LEFT JOIN renter_assumptions r ON t.customername = r.model_id"""


def select_rates(t: str) -> str:
    n = PARAMS.code_length
    return f"""
SELECT t.* REPLACE (h.histrate AS histrate, q.rfqrate AS rfqrate, h.scac AS scac,
  h.lane_type AS scaccarriertype,
  CASE h.lane_type WHEN 'CPU' THEN 'C' WHEN 'Dedicated' THEN 'D' END AS cpu,
  CASE WHEN h.lane_type = 'CPU' THEN 'CPU' WHEN q.rfqrate IS NOT NULL THEN 'rfqrate'
    WHEN h.histrate IS NOT NULL THEN 'HistRate' ELSE 'MarketRate' END AS rateused,
  CASE WHEN h.lane_type = 'CPU' THEN 0 WHEN q.rfqrate IS NOT NULL THEN q.rfqrate
    WHEN h.histrate IS NOT NULL THEN h.histrate ELSE t.marketrate END AS fixedcost,
  CASE WHEN h.lane_type = 'CPU' THEN NULL ELSE CAST(0.55 AS DOUBLE) END AS unitcost,
  CASE WHEN ocountry = 'USA' AND dcountry = 'CAN' THEN CAST(5 AS DOUBLE)
    WHEN ocountry = 'CAN' AND dcountry = 'USA' THEN CAST(5.6 AS DOUBLE) END AS dutyrate)
FROM {t} t
  LEFT JOIN (SELECT left(lane_name, {n}) AS a, right(lane_name, {n}) AS b,
      first(rfqrate ORDER BY lane_name, rfqrate) AS rfqrate FROM rfq_rates GROUP BY 1, 2) q
    ON right(t.originname, {n}) = q.a AND right(t.destinationname, {n}) = q.b
  LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY originname, destinationname
      ORDER BY movetype, lane_id, origin_name, destination_name) AS rn FROM lane_history)
    WHERE rn = 1) h ON t.originname = h.originname AND t.destinationname = h.destinationname"""


def carrier_flags(t: str, transport: str, location: str, depot: str, here: str, there: str) -> str:
    flagged = f"SELECT * FROM {transport} WHERE cpu IN ('C', 'D')"
    return f"""
SELECT t.* REPLACE (coalesce(x.cpu, 'N' || a.cpu, t.cpudedicated) AS cpudedicated)
FROM {t} t LEFT JOIN (SELECT {here}, min(cpu) AS cpu FROM ({flagged}) GROUP BY 1) a
    ON t.{location} = a.{here}
  LEFT JOIN (SELECT {here}, {there}, min(cpu) AS cpu FROM ({flagged}) GROUP BY 1, 2) x
    ON t.{location} = x.{here} AND t.{depot} = x.{there}"""


def issue_flags(t: str, transport: str) -> str:
    return carrier_flags(
        t, transport, "customername", "sourcename", "destinationname", "originname"
    )


def move_flags(t: str, transport: str) -> str:
    return carrier_flags(
        t, transport, "sourcename", "facilityname", "originname", "destinationname"
    )


def customer_sizes(t: str) -> str:
    return f"""
SELECT t.* REPLACE (coalesce(s.average_cube, CAST(521 AS DOUBLE)) AS avgloadsz)
FROM {t} t LEFT JOIN sizes s ON t.customername = s.destinationname"""


def facility_sizes(t: str) -> str:
    return f"""
SELECT t.* REPLACE (coalesce(s.average_cube, CASE left(facilityname, 2)
  WHEN 'R_' THEN CAST(487 AS DOUBLE) WHEN 'D_' THEN CAST(560 AS DOUBLE) END, avgloadsz)
  AS avgloadsz)
FROM {t} t LEFT JOIN sizes s ON t.facilityname = s.originname"""


def lane_sizes(t: str) -> str:
    return f"""
SELECT t.* REPLACE (CASE
    WHEN left(t.destinationname, 2) = 'I_' THEN coalesce(i.average_cube, CAST(521 AS DOUBLE))
    WHEN left(t.originname, 2) = 'R_' THEN coalesce(r.average_cube, CAST(487 AS DOUBLE))
    ELSE CAST(560 AS DOUBLE) END AS averageshipmentsize)
FROM {t} t LEFT JOIN sizes i ON t.destinationname = i.destinationname
  LEFT JOIN sizes r ON t.originname = r.originname"""


def issue_multi(t: str) -> str:
    return f"""
SELECT t.* REPLACE (CASE WHEN customername IN (SELECT dmodelid FROM msl WHERE movetype = 'Issue'
      AND dmodelid IS NOT NULL) THEN
    CASE WHEN EXISTS (SELECT 1 FROM msl m WHERE m.omodelid = t.sourcename
      AND m.dmodelid = t.customername) THEN 'Y' ELSE 'N' END
  ELSE multi_source_option END AS multi_source_option)
FROM {t} t"""


def move_multi(t: str) -> str:
    return f"""
SELECT t.* REPLACE (CASE WHEN sourcename IN (SELECT omodelid FROM msl WHERE movetype = 'Return'
      AND omodelid IS NOT NULL) THEN
    CASE WHEN EXISTS (SELECT 1 FROM msl m WHERE m.omodelid = t.sourcename
      AND m.dmodelid = t.facilityname) THEN 'Y' ELSE 'N' END
  ELSE multi_source_option END AS multi_source_option)
FROM {t} t"""


GROUPS = """
SELECT CASE WHEN customername IN (SELECT dmodelid FROM msl WHERE movetype = 'Issue'
      AND dmodelid IS NOT NULL) THEN 'SplitSource_Renter_AllowToMultiSource'
    ELSE 'SplitSource_Renter_KeepSingleSource' END AS groupname, 'Customers' AS grouptype,
  customername AS membername
FROM (SELECT DISTINCT customername FROM customers)
UNION ALL
SELECT CASE WHEN facilityname IN (SELECT omodelid FROM msl WHERE movetype = 'Return'
      AND omodelid IS NOT NULL) THEN 'SplitSource_Distributor_AllowToMultiSource'
    ELSE 'SplitSource_Distributor_KeepSingleSource' END, 'Facilities', facilityname
FROM (SELECT DISTINCT facilityname FROM r_ids)
UNION ALL
SELECT groupname, grouptype, membername FROM groups WHERE groupname NOT LIKE 'SplitSource%'"""


def transfer_matrix(t: str) -> str:
    return f"""
SELECT t.* REPLACE (CASE WHEN left(sourcename, 1) <> 'D' OR left(facilityname, 1) <> 'D' THEN status
    WHEN odepottype = 'Manufacturing' AND ddepottype IN ('Manufacturing', 'DO NOT USE',
      'Distributor Sort', 'Renter Sort', 'Repair Only', 'Sort Only') THEN 'Exclude'
    WHEN odepottype = 'Full Service' AND ddepottype IN ('Manufacturing', 'DO NOT USE')
      THEN 'Exclude'
    WHEN odepottype = 'Sort Only' AND ddepottype IN ('Manufacturing', 'DO NOT USE', 'Sort Only')
      THEN 'Exclude'
    WHEN odepottype = 'Storage' AND ddepottype IN ('Manufacturing', 'DO NOT USE',
      'Distributor Sort', 'Renter Sort', 'Storage') THEN 'Exclude'
    WHEN odepottype = 'Repair Only' AND ddepottype IN ('Manufacturing', 'DO NOT USE',
      'Distributor Sort', 'Renter Sort') THEN 'Exclude'
    WHEN odepottype = 'DO NOT USE' THEN 'Exclude'
    WHEN odepottype IN ('Distributor Sort', 'Renter Sort')
      AND ddepottype IS DISTINCT FROM 'Full Service' THEN 'Exclude'
    ELSE 'Include' END AS status)
FROM {t} t"""


def preferred_pairs(t: str) -> str:
    return f"""
SELECT t.* REPLACE (CASE WHEN p.a IS NULL THEN 'N' ELSE 'Y' END AS rentdistsortprefassig)
FROM {t} t LEFT JOIN (
  SELECT o.facilityname AS a, d.facilityname AS b FROM preferred_depots
    JOIN facilities o ON ocode = o.loccode JOIN facilities d ON dcode = d.loccode
  UNION
  SELECT d.facilityname, o.facilityname FROM preferred_depots
    JOIN facilities o ON ocode = o.loccode JOIN facilities d ON dcode = d.loccode) p
  ON t.facilityname = p.a AND t.sourcename = p.b"""


# --- the refresh as a chain of steps -----------------------------------------

REL["new_fac_1"] = facility_attributes("facilities")
REL["new_fac_2"] = active_returns("new_fac_1")
REL["new_fac_3"] = return_details("new_fac_2")
REL["new_facilities"] = facility_sizes("new_fac_3")
REL["new_cus_1"] = active_customers("customers")
REL["new_cus_2"] = customer_details("new_cus_1")
REL["new_customers"] = customer_sizes("new_cus_2")
REL["new_tps_1"] = transport_places("transportationpolicies", "new_facilities")
REL["new_tps_2"] = select_rates("new_tps_1")
REL["new_transport"] = lane_sizes("new_tps_2")
REL["new_cfp_1"] = fulfillment_cost("customerfulfillmentpolicies")
REL["new_cfp_2"] = assigned_issues("new_cfp_1")
REL["new_cfp_3"] = fulfillment_attributes("new_cfp_2", "new_customers", "new_facilities")
REL["new_cfp_4"] = pallet_penalty("new_cfp_3")
REL["new_cfp_5"] = issue_flags("new_cfp_4", "new_transport")
REL["new_issues"] = issue_multi("new_cfp_5")
REL["new_rps_1"] = depot_types("replenishmentpolicies")
REL["new_rps_2"] = assigned_returns("new_rps_1")
REL["new_rps_3"] = replenishment_attributes("new_rps_2", "new_facilities")
REL["new_rps_4"] = move_flags("new_rps_3", "new_transport")
REL["new_rps_5"] = move_multi("new_rps_4")
REL["new_rps_6"] = transfer_matrix("new_rps_5")
REL["new_moves"] = preferred_pairs("new_rps_6")
REL["new_groups"] = GROUPS
REL["new_limits"] = INVENTORY_LIMITS
REL["new_inventory"] = INITIAL_INVENTORY
REL["new_capacity"] = REPAIR_CAPACITY
REL["new_repair"] = REPAIR_COST
REL["new_handling"] = HANDLING_COST
REL["new_rates"] = select_rates("transportationpolicies")

_NEW_NAMES = {
    "customerfulfillmentpolicies": "new_issues",
    "customers": "new_customers",
    "facilities": "new_facilities",
    "groups": "new_groups",
    "inventoryconstraints": "new_limits",
    "inventorypolicies": "new_inventory",
    "periods": "periods",
    "productionconstraints": "new_capacity",
    "productionpolicies": "new_repair",
    "replenishmentpolicies": "new_moves",
    "transportationpolicies": "new_transport",
    "warehousingpolicies": "new_handling",
}


# --- quality and reconciliation texts ----------------------------------------


def _gate() -> str:
    parts = []
    for name, spec in SIDE_INPUTS.items():
        keys = ", ".join(spec.key)
        parts.append(
            f"""SELECT '{name}' AS input, 'duplicate_keys' AS "check", '' AS column_name,
  count(*) AS n_values, sum(n - 1) AS n_rows
FROM (SELECT count(*) AS n FROM {name} GROUP BY {keys} HAVING count(*) > 1)"""
        )
        for group in spec.one_to_one:
            tuple_ = ", ".join(group)
            for c in group:
                parts.append(
                    f"""SELECT '{name}', 'one_to_one', '{c} of ({tuple_})', count(*), sum(n)
FROM (SELECT count(*) AS n FROM (SELECT DISTINCT {tuple_} FROM {name}) GROUP BY {c}
  HAVING count(*) > 1)"""
                )
        for c in spec.required:
            parts.append(
                f"""SELECT '{name}', 'missing_values', '{c}', 1, count(*) FROM {name}
WHERE {c} IS NULL"""
            )
        for c, members in spec.allowed.items():
            listed = ", ".join(f"'{m}'" for m in members)
            parts.append(
                f"""SELECT '{name}', 'allowed_values', '{c}', count(DISTINCT coalesce({c}, '')),
  count(*) FROM {name} WHERE {c} IS NULL OR {c} NOT IN ({listed})"""
            )
    union = " UNION ALL ".join(parts)
    return f"""SELECT input, "check", column_name, CAST(n_values AS BIGINT) AS n_values,
  CAST(n_rows AS BIGINT) AS n_rows FROM ({union}) WHERE n_rows > 0"""


def _summary(name: str, old: str, new: str, spec: TableSpec, column_diffs: int = 0) -> str:
    keys = ", ".join(spec.primary_key)
    same = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in spec.primary_key)
    numbers = ", ".join(
        f"coalesce(round_even(TRY_CAST(nullif(CAST({c} AS VARCHAR), '') AS DOUBLE), 2), 0e0) AS {c}"
        for c in spec.numeric
    )
    replace = f"REPLACE ({numbers})" if numbers else ""

    def cells(table: str) -> str:
        text = f"SELECT CAST(COLUMNS(*) AS VARCHAR) FROM (SELECT * {replace} FROM {table})"
        single = f"""SELECT {keys} FROM {table} GROUP BY ALL HAVING count(*) = 1"""
        held = " AND ".join(
            f"x.{k} IS NOT DISTINCT FROM CAST(y.{k} AS VARCHAR)" for k in spec.primary_key
        )
        return f"""(SELECT {keys}, cell, nullif(v, '') AS v FROM (
  SELECT x.* FROM ({text}) x SEMI JOIN ({single}) y ON {held})
  UNPIVOT INCLUDE NULLS (v FOR cell IN (COLUMNS(* EXCLUDE ({keys})))))"""

    def count(side: str) -> str:
        return f"(SELECT {keys}, count(*) AS n FROM {side} GROUP BY ALL)"

    checks = {
        "columns": f"{column_diffs}",
        "row_count": f"(SELECT count(*) FROM {old}) - (SELECT count(*) FROM {new})",
        "duplicates_old": f"(SELECT coalesce(sum(n), 0) FROM {count(old)} WHERE n > 1)",
        "duplicates_new": f"(SELECT coalesce(sum(n), 0) FROM {count(new)} WHERE n > 1)",
        "keys_old_only": f"""(SELECT count(*) FROM (SELECT * FROM {count(old)} WHERE n = 1) a
  ANTI JOIN (SELECT * FROM {count(new)} WHERE n = 1) b ON {same})""",
        "keys_new_only": f"""(SELECT count(*) FROM (SELECT * FROM {count(new)} WHERE n = 1) a
  ANTI JOIN (SELECT * FROM {count(old)} WHERE n = 1) b ON {same})""",
        "changed_cells": f"""(SELECT count(*) FROM {cells(old)} a JOIN {cells(new)} b
  ON {same} AND a.cell = b.cell WHERE a.v IS DISTINCT FROM b.v)"""
        if spec.name != "groups"  # keys only
        else "0",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{check}' AS check_name, CAST({sql} AS BIGINT) AS n_found"
        for check, sql in checks.items()
    )
    return f"""SELECT table_name, check_name,
  CASE n_found WHEN 0 THEN 'PASS' ELSE 'DIFF' END AS status, n_found FROM ({rows})"""


_OLD_PRICE = "coalesce(round_even(TRY_CAST(nullif(o_totalprice, '') AS DOUBLE), 2), 0e0)"
_NEW_PRICE = "coalesce(round_even(o_totalprice, 2), 0e0)"
_ISSUE = "customername, productname, sourcename"
_MOVE = "facilityname, productname, sourcename"
_ORDERS = TableSpec("orders", ("o_orderkey",), ("o_totalprice",))
_LINE_KEYS = "l_orderkey, l_linenumber"


def _shown(moments: list[str]) -> str:
    return ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in moments)


_MOMENTS = [
    "creation_date",
    "delivery_date",
    "planned_to",
    "planned_from",
    "date_from",
    "date_to",
    "actual_ship",
    "actual_delivery",
]
_TRAILING = f"SELECT tnumber, location_from, location_to, {_shown(['date_to'])} FROM shipments WHERE"
_UPDATE = """SELECT o_orderkey, o_custkey, {} AS o_totalprice, o_orderpriority FROM orders"""

TEXTS: dict[str, str] = {
    "src_model_snapshot": f"SELECT {_ISSUE}, unitcost, distance FROM customerfulfillmentpolicies",
    "src_model_tables": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '*' AS column_name, count(*) AS n_values,"
        f" CAST(NULL AS DOUBLE) AS total FROM {name} HAVING count(*) > 0"
        + (
            f""" UNION ALL SELECT '{name}', cell, count(*), round(sum(v), 2) FROM (
  SELECT CAST(COLUMNS('^({"|".join(spec.numeric)})$') AS DOUBLE) FROM {name})
  UNPIVOT (v FOR cell IN (COLUMNS(*))) GROUP BY ALL"""
            if spec.numeric
            else ""
        )
        for name, spec in MODEL_TABLES.items()
    ),
    "src_side_input_typed": "SELECT * FROM depot_assumptions",
    "src_side_inputs": " UNION ALL ".join(
        f"SELECT '{name}' AS input_name, '*' AS column_name, count(*) AS n_values,"
        f" CAST(NULL AS DOUBLE) AS total FROM {name}"
        + "".join(
            f" UNION ALL SELECT '{name}', '{c}', count({c}), "
            + (f"round(sum(CAST({c} AS DOUBLE)), 2)" if c in spec.numeric else "NULL")
            + f" FROM {name}"
            for c in spec.columns.values()
        )
        for name, spec in SIDE_INPUTS.items()
    ),
    "snk_roundtrip": "SELECT * FROM transportationpolicies",
    "prj_rename_select": """SELECT 'Issue' AS movetype, loccode AS customer,
  customername AS model_id FROM customers""",
    "prj_suffix_selfjoin": """SELECT sourcename, p.facilityname, productname,
  o.facilityname AS facilityname_orig, o.country AS country_orig, o.depottype AS depottype_orig,
  o.zone AS zone_orig, d.facilityname AS facilityname_dest, d.country AS country_dest,
  d.depottype AS depottype_dest, d.zone AS zone_dest
FROM replenishmentpolicies p LEFT JOIN facilities o ON sourcename = o.facilityname
  LEFT JOIN facilities d ON p.facilityname = d.facilityname""",
    "prj_conditional_reset": f"""SELECT {_MOVE},
  CASE WHEN sourcename LIKE 'R%' THEN 'Exclude' ELSE status END AS status,
  CASE WHEN sourcename LIKE 'R%' THEN 'NewAllToAll_Returns' ELSE notes END AS notes
FROM replenishmentpolicies""",
    "prj_masked_assign": """SELECT originname, destinationname, productname,
  CASE WHEN ocountry = 'USA' AND dcountry = 'CAN' THEN CAST(5 AS DOUBLE)
    WHEN ocountry = 'CAN' AND dcountry = 'USA' THEN CAST(5.6 AS DOUBLE) END AS dutyrate
FROM transportationpolicies""",
    "flt_equality": """SELECT facilityname, periodname, constraintvalue
FROM productionconstraints WHERE notes = 'Repair_Capacity'""",
    "flt_isin": """SELECT facilityname, depottype FROM facilities
WHERE depottype IS NULL OR depottype NOT IN ('Full Service', 'Sort Only')""",
    "flt_prefix": """SELECT facilityname, sourcename, productname FROM replenishmentpolicies
WHERE sourcename LIKE 'D%' AND facilityname LIKE 'D%'""",
    "flt_dropna": """SELECT tnumber, scac, status, distance FROM shipments
WHERE scac IS NOT NULL AND status IS NOT NULL AND distance IS NOT NULL""",
    "flt_period_horizon": f"SELECT * FROM customerdemand WHERE {_PERIOD_NO} <= 12",
    "flt_cost_or_type": """SELECT tnumber, lane_id, carrier_type, ttl_lh_cost FROM costs_all
WHERE ttl_lh_cost > 2000 OR carrier_type = 'CPU'""",
    "flt_trailing_days": f"{_TRAILING} date_diff('day', CAST(date_to AS DATE), {_DAY}) <= 60",
    "flt_trailing_months": f"{_TRAILING} date_diff('month', CAST(date_to AS DATE), {_DAY}) <= 3",
    "flt_shipment_valid": """SELECT tnumber, status, scac FROM shipments WHERE status <> 5
  AND left(tnumber, 3) <> 'DDT' AND left(tnumber, 3) <> 'TOR' AND scac IS NOT NULL""",
    "jn_left_lookup": f"""SELECT {_ISSUE}, f.depottype AS depot_type, f.country AS depot_country
FROM customerfulfillmentpolicies LEFT JOIN facilities f ON sourcename = facilityname""",
    "jn_left_shared": """SELECT p.periodname, facilityname, productname, notes, workingdays
FROM productionconstraints p LEFT JOIN periods q ON p.periodname = q.periodname""",
    "jn_left_composite": f"""SELECT {_ISSUE}, depot_code AS assigned_depot
FROM customerfulfillmentpolicies LEFT JOIN depot_assignments
  ON customername = oname AND sourcename = revised_dname""",
    "jn_inner": """SELECT movetype, lane_id, total_loads, ttl_lh_cost, scac, carrier_type,
  carrier_loads FROM lane_totals JOIN top1 USING (movetype, lane_id)""",
    "jn_full_outer": """SELECT movetype, lane_id, other_loads, cpu_loads, scac, histrate
FROM (SELECT * FROM loads60 WHERE lane_id IS NOT NULL AND depot IS NOT NULL
  AND customer IS NOT NULL) FULL JOIN cost_per_load USING (movetype, lane_id)""",
    "jn_dual_lookup": f"""SELECT originname, destinationname, productname, ocountry, dcountry,
  oloccode, dloccode FROM ({transport_places("transportationpolicies", "facilities")})""",
    "jn_exists_flag": f"""SELECT {_ISSUE}, CASE WHEN customername IN (SELECT oname
  FROM depot_assignments WHERE movetype = 'Issue') THEN 'Y' ELSE 'N' END AS listed
FROM customerfulfillmentpolicies""",
    "jn_semi_anti": """SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT o_orderkey
  FROM orders_new) THEN 'both' ELSE 'left_only' END AS side FROM orders_old""",
    "upd_coalesce": _UPDATE.format(
        """CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P'
  THEN o_totalprice + 10 ELSE o_totalprice END"""
    ),
    "upd_fused": """
WITH l AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1),
o AS (SELECT *, CASE WHEN n >= 5 THEN '5-MANY' ELSE 'few' END AS priority, coalesce(q, 0) AS base
  FROM orders LEFT JOIN l ON l_orderkey = o_orderkey)
SELECT o_orderkey,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus WHEN o_orderkey % 2 = 0 THEN 'X' END AS o_orderstatus,
  priority AS o_orderpriority,
  CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P' THEN o_totalprice + 10
    ELSE base + CASE priority WHEN 'few' THEN 1 ELSE 0 END END AS o_totalprice
FROM o""",
    "upd_overwrite": _UPDATE.format(
        """CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice
  WHEN o_orderstatus <> 'P' THEN o_totalprice + 10 END"""
    ),
    "upd_reset_then_update": """SELECT customername, territory,
  CASE WHEN territory IN ('BUILDING', 'MACHINERY') THEN 'Y' ELSE 'N' END AS inplan
FROM customers""",
    "upd_dedup_first": f"""SELECT * EXCLUDE (rn) REPLACE (strftime(l_shipdate, '%Y-%m-%d')
  AS l_shipdate) FROM (SELECT *, row_number() OVER (PARTITION BY {_LINE_KEYS}
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate,
    l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1""",
    "upd_source_duplicates": f"""SELECT {_LINE_KEYS}, count(*) AS n_rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
    "upd_two_roles": f"""SELECT {_MOVE}, odepottype, ddepottype
FROM ({depot_types("replenishmentpolicies")})""",
    "upd_replace_groups": GROUPS,
    "agg_sum": """SELECT customername, coalesce(sum(quantity), 0e0) AS quantity
FROM customerdemand GROUP BY 1""",
    "agg_mean": f"""SELECT customername, avg(quantity) AS amount FROM customerdemand
WHERE {_PERIOD_NO} <= 12 GROUP BY 1""",
    "agg_multi_level": """SELECT CASE grouping(scac) WHEN 0 THEN 'carrier' ELSE 'lane' END AS level,
  movetype, lane_id, scac, CAST(sum(total_loads) AS BIGINT) AS total_loads,
  sum(ttl_lh_cost) AS ttl_lh_cost
FROM carrier_loads0 GROUP BY GROUPING SETS ((movetype, lane_id, scac), (movetype, lane_id))""",
    "agg_conditional_counts": f"""SELECT location_from,
  count(*) FILTER (scac IN {_CPU_LIST}) AS cpu_loads,
  count(*) FILTER (scac IN {_DED_LIST}) AS dedicated_loads,
  count(*) FILTER (scac NOT IN {_CPU_LIST} AND scac NOT IN {_DED_LIST}) AS other_loads
FROM shipments GROUP BY 1""",
    "agg_having": "SELECT * FROM carrier_loads1",
    "agg_count_distinct": _depots(None),
    "agg_null_default": """SELECT location_from, count(*) AS load_count,
  avg(coalesce(qty_to, 0)) AS average_cube FROM shipments GROUP BY 1""",
    "agg_guarded_cost": f"""SELECT location_from, round(sum({_COST}), 2) AS ttl_cost
FROM shipments GROUP BY 1""",
    "agg_signed_sum": """SELECT location_to, sum(qty_from * -1) AS volume,
  count(qty_to) AS total_loads FROM shipments GROUP BY 1""",
    "rnk_top1_nearest": _closest(
        "customerfulfillmentpolicies", "facilities", "customername", "sourcename"
    ),
    "rnk_top_carrier": _top("carrier_loads0"),
    "srt_multi_key": f"""SELECT o_custkey, o_orderkey,
  nullif(o_orderpriority, '') AS o_orderpriority, o_orderstatus, {_OLD_PRICE} AS o_totalprice
FROM orders_old ORDER BY o_orderkey, o_orderpriority""",
    "dst_distinct": """SELECT customername, sourcename FROM customerfulfillmentpolicies
GROUP BY 1, 2""",
    "set_union_all": """SELECT loccode, country, customername AS model_id,
  CAST(NULL AS VARCHAR) AS depottype FROM customers
UNION ALL SELECT loccode, country, facilityname, depottype FROM facilities""",
    "set_symmetric_pairs": """SELECT ocode, dcode FROM preferred_depots
UNION SELECT dcode, ocode FROM preferred_depots""",
    "set_split_recombine": """
SELECT originname, destinationname, productname, 'Issue' AS movetype, country AS end_country
FROM transportationpolicies LEFT JOIN customers ON destinationname = customername
WHERE left(destinationname, 2) = 'I_'
UNION ALL
SELECT originname, destinationname, productname, 'Return', country
FROM transportationpolicies LEFT JOIN facilities ON destinationname = facilityname
WHERE left(destinationname, 2) <> 'I_' AND left(originname, 2) = 'R_'
UNION ALL
SELECT originname, destinationname, productname, 'Transfer', country
FROM transportationpolicies LEFT JOIN facilities ON destinationname = facilityname
WHERE left(destinationname, 2) <> 'I_' AND left(originname, 2) <> 'R_'""",
    "sc_substrings": f"""SELECT lane_name, substring(lane_name, 1, {PARAMS.code_length})
  AS origin_code, substring(lane_name, length(lane_name) - {PARAMS.code_length - 1})
  AS destination_code FROM rfq_rates""",
    "sc_lane_id": """SELECT tnumber, CASE WHEN a.code IS NOT NULL AND b.code IS NOT NULL
  THEN concat(a.code, '-', b.code) END AS lane_id
FROM shipments LEFT JOIN locations a ON location_from = a.iid
  LEFT JOIN (SELECT * FROM locations WHERE rl_type IS NOT NULL) b ON location_to = b.iid""",
    "sc_movetype": f"""SELECT tnumber, {_MV3} AS movetype, {_MV2} AS movetype_no_transfer
FROM shipments""",
    "sc_role_swap": f"""SELECT tnumber,
  {_side("(" + _MV3 + ")", "CAST(location_from AS VARCHAR)", "CAST(location_to AS VARCHAR)")}
    AS depot,
  {_side("(" + _MV3 + ")", "CAST(location_to AS VARCHAR)", "CAST(location_from AS VARCHAR)")}
    AS customer
FROM shipments""",
    "sc_carrier_class": f"""SELECT tnumber, scac, CASE WHEN scac IN {_CPU_LIST} THEN 'CPU'
  WHEN scac IN {_DED_LIST} THEN 'Dedicated' ELSE 'Other' END AS carrier_type FROM shipments""",
    "sc_null_default": """SELECT tnumber, coalesce(qty_to, 0e0) AS qty_to,
  coalesce(scac, 'none') AS scac FROM shipments""",
    "sc_coalesce_cols": """SELECT tnumber, CASE WHEN qty_to IS NOT NULL THEN qty_to
  WHEN inv_other IS NOT NULL THEN inv_other ELSE distance END AS first_value FROM shipments""",
    "sc_clip": """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0e0 ELSE c_acctbal END
  AS c_acctbal FROM customer""",
    "sc_distance_band": f"""SELECT tnumber, distance, {_BAND.format("distance")} AS band
FROM shipments""",
    "sc_threshold_band": """SELECT customername, periodname, quantity,
  CASE WHEN quantity <= 3500 THEN 'LT3500' ELSE 'GT3500' END AS band FROM customerdemand""",
    "sc_numeric_cast": """SELECT o_orderkey, TRY_CAST(nullif(o_totalprice, '') AS DOUBLE) AS price,
  TRY_CAST(left(o_orderpriority, 1) AS DOUBLE) AS priority FROM orders_old""",
    "dq_duplicate_keys": f"""SELECT {_LINE_KEYS}, count(*) - 1 AS n_extra FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
    "dq_one_to_one": """
SELECT 'p_brand' AS column_name, p_brand AS value, count(*) AS n_tuples
FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY p_brand HAVING count(*) > 1
UNION ALL
SELECT 'p_type', p_type, count(*)
FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY p_type HAVING count(*) > 1""",
    "dq_missing_values": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_missing FROM shipments WHERE {c} IS NULL "
        "HAVING count(*) > 0"
        for c in ("tnumber", "status", "scac", "distance", "qty_to", "inv_linehaul", "inv_other")
    ),
    "dq_allowed_values": f"""
SELECT 'scac' AS column_name, scac AS value, count(*) AS n_rows FROM shipments
WHERE scac IS NULL OR scac NOT IN {_CPU_LIST} AND scac NOT IN {_DED_LIST} GROUP BY scac
UNION ALL
SELECT 'status', CAST(status AS VARCHAR), count(*) FROM shipments
WHERE status IS NULL OR status NOT IN (1, 3) GROUP BY status""",
    "dq_gate_report": _gate(),
    "dq_unreadable": """
SELECT 'sheet' AS input, 'unreadable_number' AS check, 'cost' AS column_name,
  count(DISTINCT CASE WHEN s_suppkey % 7 = 0 THEN CAST(s_acctbal AS VARCHAR) ELSE 'n/a' END)
    AS n_values, count(*) AS n_rows
FROM supplier WHERE s_suppkey % 7 = 0 OR s_suppkey % 11 = 0 HAVING count(*) > 0
UNION ALL
SELECT 'customerdemand', 'unreadable_period', 'periodname', 1, count(*)
FROM customerdemand WHERE customername LIKE '%7' HAVING count(*) > 0""",
    "rec_column_diff": """SELECT 'new_only' AS side, 'o_orderdate' AS column_name,
  count(o_orderdate) AS n_values FROM orders_new""",
    "rec_row_counts": """SELECT o AS n_old, n AS n_new, o - n AS n_diff
FROM (SELECT count(*) AS o FROM orders_old), (SELECT count(*) AS n FROM orders_new)""",
    "rec_normalize": f"""
SELECT o_orderkey, o_custkey, nullif(o_orderstatus, '') AS o_orderstatus,
  {_OLD_PRICE} AS o_totalprice, nullif(o_orderpriority, '') AS o_orderpriority, 'old' AS side
FROM orders_old
UNION ALL
SELECT o_orderkey, o_custkey, nullif(o_orderstatus, ''), {_NEW_PRICE},
  nullif(o_orderpriority, ''), 'new' FROM orders_new""",
    "rec_split_duplicates": """SELECT * EXCLUDE (n), CASE WHEN n > 1 THEN 'repeated'
  ELSE 'single' END AS part
FROM (SELECT *, count(*) OVER (PARTITION BY o_orderkey) AS n FROM orders_old)""",
    "rec_key_diff": """
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
  CASE WHEN b.o_orderkey IS NULL THEN 'left_only' ELSE 'right_only' END AS side
FROM (SELECT o_orderkey FROM orders_old GROUP BY 1 HAVING count(*) = 1) a
  FULL JOIN (SELECT o_orderkey FROM orders_new GROUP BY 1 HAVING count(*) = 1) b
  ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL""",
    "rec_cell_diff": f"""SELECT * FROM (
WITH a AS (SELECT o_orderkey, any_value(o_custkey) AS o_custkey,
    any_value(o_orderstatus) AS o_orderstatus, any_value({_OLD_PRICE}) AS price,
    any_value(o_orderpriority) AS o_orderpriority
  FROM orders_old GROUP BY 1 HAVING count(*) = 1),
b AS (SELECT o_orderkey, any_value(o_custkey) AS o_custkey,
    any_value(o_orderstatus) AS o_orderstatus, any_value({_NEW_PRICE}) AS price,
    any_value(o_orderpriority) AS o_orderpriority
  FROM orders_new GROUP BY 1 HAVING count(*) = 1)
SELECT o_orderkey, 'o_orderstatus' AS column_name, a.o_orderstatus AS old_value,
  b.o_orderstatus AS new_value
FROM a JOIN b USING (o_orderkey) WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
UNION ALL
SELECT o_orderkey, 'o_totalprice', CAST(a.price AS VARCHAR), CAST(b.price AS VARCHAR)
FROM a JOIN b USING (o_orderkey) WHERE a.price IS DISTINCT FROM b.price
UNION ALL
SELECT o_orderkey, 'o_custkey', CAST(a.o_custkey AS VARCHAR), CAST(b.o_custkey AS VARCHAR)
FROM a JOIN b USING (o_orderkey) WHERE a.o_custkey IS DISTINCT FROM b.o_custkey
UNION ALL
SELECT o_orderkey, 'o_orderpriority', a.o_orderpriority, b.o_orderpriority
FROM a JOIN b USING (o_orderkey) WHERE a.o_orderpriority IS DISTINCT FROM b.o_orderpriority)""",
    "rec_summary": _summary(
        "orders", "orders_old", "(SELECT * EXCLUDE (o_orderdate) FROM orders_new)", _ORDERS, 1
    ),
    "rec_numeric_keys": """
SELECT 'part' AS table_name, check_name, CASE n WHEN 0 THEN 'PASS' ELSE 'DIFF' END AS status,
  CAST(n AS BIGINT) AS n_found
FROM (SELECT count(*) FILTER (p_partkey % 10 = 0) AS gone,
    count(*) FILTER (p_partkey % 10 <> 0 AND p_partkey % 4 = 0)
      + count(*) FILTER (p_partkey % 10 <> 0 AND p_partkey <> 1) AS changed FROM part),
  LATERAL (VALUES ('columns', 0), ('row_count', gone), ('duplicates_old', 0),
    ('duplicates_new', 0), ('keys_old_only', gone), ('keys_new_only', 0),
    ('changed_cells', changed)) AS v(check_name, n)""",
    "hist_depots_per_customer": "SELECT * FROM nod",
    "hist_load_size": "SELECT * FROM sizes",
    "hist_incremental": """
SELECT 'depots' AS kind, movetype, model_id AS name, number_of_depots AS n, CAST(NULL AS DOUBLE) AS size
FROM nod
UNION ALL SELECT 'sizes', movetype, customer_name, load_count, average_cube FROM sizes
UNION ALL SELECT 'lanes', movetype, lane_id, cpu_loads + dedicated_loads + other_loads, NULL
FROM loads60""",
    "hist_lane_loads": "SELECT * FROM loads60",
    "hist_lane_costs": f"""SELECT * REPLACE (round(ttl_cost, 4) AS ttl_cost, {_shown(_MOMENTS)})
FROM ({_costs(3)})""",
    "hist_cost_per_load": "SELECT * FROM cost_per_load",
    "hist_lane_type": "SELECT * FROM lane_types",
    "hist_lane_model_ids": "SELECT * FROM lane_history",
    "dep_unit_cost": f"""SELECT {_ISSUE}, unitcost, depottype
FROM ({fulfillment_cost("customerfulfillmentpolicies")})""",
    "dep_attributes": facility_attributes("facilities"),
    "dep_inventory_limits": INVENTORY_LIMITS,
    "dep_initial_inventory": INITIAL_INVENTORY,
    "dep_repair_capacity": f"""SELECT facilityname, productname, periodname, notes, constraintvalue
FROM ({REPAIR_CAPACITY})""",
    "dep_repair_cost": REPAIR_COST,
    "dep_handling_cost": HANDLING_COST,
    "flg_assigned_lanes": f"""SELECT {_ISSUE}, planflag, plan_depot_id, status, notes
FROM ({assigned_issues("customerfulfillmentpolicies")})""",
    "flg_assigned_returns": f"""SELECT {_MOVE}, planflag, plan_depot_id, status, notes
FROM ({assigned_returns("replenishmentpolicies")})""",
    "flg_active_customers": f"""SELECT customername, status, inplan
FROM ({active_customers("customers")})""",
    "flg_active_returns": f"""SELECT facilityname, status, inplanmodel
FROM ({active_returns("facilities")})""",
    "loc_customer_details": f"""SELECT customername, corpcode, corpname, planquantity, issueqty
FROM ({customer_details("customers")})""",
    "loc_return_details": f"""SELECT facilityname, corpcode, corpname, returnqty
FROM ({return_details("facilities")})""",
    "lane_attributes": f"""SELECT {_ISSUE}, depottype, ozone, dzone, {", ".join(_KEPT_LANE)}
FROM ({fulfillment_attributes("customerfulfillmentpolicies", "customers", "facilities")})""",
    "lane_add_to_model": f"""SELECT {_ISSUE}, CASE WHEN planflag = 'N' AND distance <= 1000
  AND greenfieldcandidate = 'Y' AND cpudedicated IS NULL
  AND (coalesce(q, 0) <= 3500 OR number_of_depots >= 2) THEN 'Y' ELSE 'N' END AS addtomodel
FROM customerfulfillmentpolicies LEFT JOIN nod ON customername = model_id
  LEFT JOIN (SELECT customername AS c, avg(quantity) AS q FROM customerdemand
    WHERE {_PERIOD_NO} <= 12 GROUP BY 1) d ON customername = c""",
    "lane_closest_depot": f"""SELECT {_ISSUE}, closestdepot
FROM ({fulfillment_attributes("customerfulfillmentpolicies", "customers", "facilities")})""",
    "lane_replenishment": f"""SELECT {_MOVE}, odepottype, ddepottype, {", ".join(_KEPT_LANE)}
FROM ({replenishment_attributes("replenishmentpolicies", "facilities")})""",
    "pen_new_pallet": f"""SELECT {_ISSUE}, depottype, unitcost
FROM ({pallet_penalty("(" + fulfillment_cost("customerfulfillmentpolicies") + ")")})""",
    "rate_selection": "SELECT * EXCLUDE (averageshipmentsize, oloccode, dloccode) FROM new_rates",
    "rate_flag_propagation": f"""
SELECT 'issue' AS kind, customername AS location, productname, sourcename AS depot, cpudedicated
FROM ({issue_flags("customerfulfillmentpolicies", "new_rates")})
UNION ALL
SELECT 'move', sourcename, productname, facilityname, cpudedicated
FROM ({move_flags("replenishmentpolicies", "new_rates")})""",
    "size_customer": f"SELECT customername, avgloadsz FROM ({customer_sizes('customers')})",
    "size_facility": f"SELECT facilityname, avgloadsz FROM ({facility_sizes('facilities')})",
    "size_lane": f"""SELECT originname, destinationname, productname, averageshipmentsize
FROM ({lane_sizes("transportationpolicies")})""",
    "msrc_resolve": "SELECT * FROM msl",
    "msrc_flag": f"""
SELECT customername AS a, productname AS b, sourcename AS c, multi_source_option
FROM ({issue_multi("customerfulfillmentpolicies")})
UNION ALL
SELECT facilityname, productname, sourcename, multi_source_option
FROM ({move_multi("replenishmentpolicies")})""",
    "xfer_matrix": f"""SELECT {_MOVE}, odepottype, ddepottype, status
FROM ({transfer_matrix("(" + depot_types("replenishmentpolicies") + ")")})""",
    "pref_pairs": f"""SELECT {_MOVE}, rentdistsortprefassig
FROM ({preferred_pairs("replenishmentpolicies")})""",
    "refresh_fulfillment": "SELECT * FROM new_issues",
    "refresh_replenishment": "SELECT * FROM new_moves",
    "refresh_transportation": "SELECT * FROM new_transport",
    "rec_column_profile": """
SELECT column_name, n_values, n_numbers, n_moments FROM (
  SELECT count(nullif(a.o_orderstatus, '')) AS s FROM orders_old a),
(SELECT count(*) FILTER (o_totalprice <> '') AS t, count(o_orderpriority) AS p FROM orders_old),
(SELECT count(*) AS n, count(*) FILTER (o_orderkey % 7 <> 0) AS m,
  count(*) FILTER (o_orderkey % 9 <> 0) AS d FROM orders),
LATERAL (VALUES ('o_orderstatus', s + m, 0::BIGINT, 0::BIGINT), ('o_totalprice', t, t, 0),
  ('o_orderpriority', p, 0, 0), ('o_custkey', n, n, 0), ('o_orderdate', n, 0, d)
) AS v(column_name, n_values, n_numbers, n_moments)""",
    "rec_bucket_diff": """
SELECT 'orders' AS table_name, kind, '{"o_orderkey":' || id || '}' AS key, column_name, old_value,
  new_value
FROM (SELECT *, o_orderkey % 1499 = 0 AS gone, o_orderkey % 1999 = 0 AS added FROM orders),
LATERAL (VALUES
  (gone, 'left_only', o_orderkey, NULL, NULL, NULL),
  (added, 'right_only', -o_orderkey - 1, NULL, NULL, NULL),
  (NOT gone AND o_orderkey % 997 = 0, 'cell', o_orderkey, 'o_totalprice',
    CAST(o_totalprice AS VARCHAR), CAST(round(o_totalprice + 10, 2) AS VARCHAR))
) AS v(holds, kind, id, column_name, old_value, new_value)
WHERE holds""",
    "rec_type_drift": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, column_name, old_value, new_value FROM (
  SELECT *, CAST(o_custkey AS VARCHAR) AS customer, CAST(o_totalprice AS VARCHAR) AS price,
    CAST(CAST(o_orderdate AS TIMESTAMP) AS VARCHAR) AS moment FROM orders),
LATERAL (VALUES
  ('o_custkey', customer, CASE WHEN o_orderkey % 50 = 0 THEN 'n/a'
    WHEN o_orderkey % 70 = 0 THEN NULL ELSE customer END),
  ('o_totalprice', price, CASE WHEN o_orderkey % 30 = 0 THEN '7.25' ELSE price END),
  ('o_orderdate', moment, CASE WHEN o_orderkey % 40 = 0 THEN '1999-01-01 00:00:00' ELSE moment END),
  ('o_orderstatus', o_orderstatus, CASE WHEN o_orderkey % 60 <> 0 THEN o_orderstatus END)
) AS v(column_name, old_value, new_value)
WHERE old_value IS DISTINCT FROM new_value""",
    "refresh_reconciled": " UNION ALL ".join(
        "(" + _summary(name, name, _NEW_NAMES[name], MODEL_TABLES[name]) + ")"
        for name in _NEW_NAMES
    ),
}

_KEY = """'{"o_orderkey":' || o_orderkey || '}' AS key"""
TEXTS["snk_report"] = f"""
SELECT 'key_diff' AS kind, 'orders' AS table_name, {_KEY}, side, NULL AS "row",
  NULL AS column_name, NULL AS old_value, NULL AS new_value FROM ({TEXTS["rec_key_diff"]})
UNION ALL
SELECT 'duplicates', 'orders', {_KEY}, 'old', CAST(to_json({{'o_orderkey': o_orderkey,
    'o_custkey': o_custkey, 'o_orderstatus': nullif(o_orderstatus, ''),
    'o_totalprice': {_OLD_PRICE}, 'o_orderpriority': nullif(o_orderpriority, '')}}) AS VARCHAR),
  NULL, NULL, NULL
FROM (SELECT *, count(*) OVER (PARTITION BY o_orderkey) AS n FROM orders_old) WHERE n > 1
UNION ALL
SELECT 'cell_diff', 'orders', {_KEY}, NULL, NULL, column_name, old_value, new_value
FROM ({TEXTS["rec_cell_diff"]})"""
TEXTS["refresh_published"] = TEXTS["refresh_reconciled"]

_KNOWN = {**VIEWS, **REL}
ORACLE: dict[str, str] = {name: with_clause(text, _KNOWN) for name, text in TEXTS.items()}
# The same run on inputs that the gate lets through.
_FILLED = f"""SELECT * REPLACE (coalesce(type, 'Sort Only') AS type, coalesce(closed, 'N') AS closed)
FROM ({VIEWS["depot_assumptions"]})"""
ORACLE["refresh_gated"] = with_clause(
    TEXTS["refresh_reconciled"], {**_KNOWN, "depot_assumptions": _FILLED}
)

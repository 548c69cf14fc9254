"""The inputs of a refresh, derived from the given star-schema tables.

Each view is ANSI SQL that Spark and the checking engine both run. Suppliers
play depots, customers play customers and return sites, and order lines play
shipments, lanes, demand and forecasts, so every view grows with its tables.
Amounts are whole numbers held as doubles: sums are exact in any order.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.specs import Params

# Declared, so that opening a table runs no job to infer its schema.
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}
RAW_TABLES = tuple(RAW_SCHEMAS)

AS_OF = dt.date(2001, 8, 1)
# Lanes of these views are thin, so rates look at all of history and at lanes
# with two loads or more.
PARAMS = Params(code_length=13, min_loads=1, days_lane_loads=None, months_costs=None)


def _code(letter: str, key: str) -> str:
    return f"'{letter}' || lpad(CAST({key} AS STRING), 12, '0')"


_D, _C = _code("D", "s_suppkey"), _code("C", "c_custkey")
_LINE_D, _LINE_C, _LINE_D2 = (
    _code("D", "suppkey"),
    _code("C", "custkey"),
    _code("D", "suppkey2"),
)
_COUNTRY = "CASE r_name WHEN 'AMERICA' THEN 'USA' WHEN 'EUROPE' THEN 'CAN' ELSE n_name END"
_DEPOT_TYPE = """CASE s_nationkey % 8 WHEN 0 THEN 'Full Service' WHEN 1 THEN 'Sort Only'
    WHEN 2 THEN 'Manufacturing' WHEN 3 THEN 'Storage' WHEN 4 THEN 'Repair Only'
    WHEN 5 THEN 'DO NOT USE' WHEN 6 THEN 'Distributor Sort' ELSE 'Renter Sort' END"""
_PERIOD = """'P' || lpad(CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS STRING), 2, '0')"""
_PRODUCT = "CASE WHEN l_linenumber <= 3 THEN 'RFU' ELSE 'WIP' END"
_OLD_LANE = """'old' AS oregion, 'old' AS dregion, 'old' AS ocountry, 'old' AS dcountry,
    'old' AS oterritory, 'old' AS dterritory, 'old' AS osubterritory, 'old' AS dsubterritory,
    'old' AS mileageband, -1e0 AS monthly_avg, 'old' AS monthlypalletband,
    -1e0 AS number_of_depots_served, 'old' AS nbrdepotsband, 'old' AS addtomodel,
    'old' AS closestdepot, 'old' AS multi_source_option"""

VIEWS: dict[str, str] = {
    "lines": """
SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, l_shipdate, l_quantity,
  l_extendedprice, l_discount, l_tax, l_suppkey AS suppkey, o_custkey AS custkey,
  CASE WHEN l_suppkey > l_linenumber THEN l_suppkey - l_linenumber
    ELSE l_suppkey + l_linenumber END AS suppkey2,
  o_orderdate, o_orderstatus, o_orderpriority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "shipments": """
SELECT
  CASE WHEN p_size = 7 THEN 'DDT' WHEN p_size = 11 THEN 'X' WHEN l_returnflag = 'N' THEN 'IS'
    WHEN l_returnflag = 'R' THEN 'R' ELSE 'TOR' END
    || '-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS tnumber,
  CASE WHEN l_returnflag = 'R' THEN 2 * custkey + 1 ELSE 2 * suppkey END AS location_from,
  CASE WHEN l_returnflag = 'N' THEN 2 * custkey + 1 WHEN l_returnflag = 'R' THEN 2 * suppkey
    ELSE 2 * suppkey2 END AS location_to,
  -l_quantity AS qty_from,
  CASE WHEN p_size = 13 THEN NULL ELSE l_quantity END AS qty_to,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 5
    WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'O' THEN 1 ELSE 3 END AS status,
  CASE WHEN p_size = 17 THEN NULL ELSE p_brand END AS scac,
  CASE WHEN p_size = 19 THEN NULL
    ELSE CAST(abs(suppkey * 37 - custkey) % 2500 AS DOUBLE) END AS distance,
  CASE WHEN p_size = 23 THEN 0e0 ELSE CAST(floor(l_extendedprice / 1e1) AS DOUBLE) END AS charge,
  CAST(floor(l_extendedprice / 8e0) AS DOUBLE) AS norm_charge,
  CASE WHEN p_size = 29 THEN NULL WHEN p_size = 31 THEN 0e0
    ELSE CAST(floor(l_extendedprice * (1 - l_discount) / 1e1) AS DOUBLE) END AS inv_linehaul,
  CAST(floor(l_extendedprice * l_tax / 1e1) AS DOUBLE) AS inv_fuel,
  CASE WHEN p_size = 37 THEN NULL ELSE l_quantity END AS inv_other,
  CAST(p_size AS DOUBLE) AS inv_detention,
  CAST(floor(l_extendedprice * l_tax / 2e1) AS DOUBLE) AS inv_tax,
  l_shipdate AS date_to, o_orderdate AS date_from, o_orderdate AS creation_date,
  l_shipdate AS delivery_date, l_shipdate AS planned_to, o_orderdate AS planned_from,
  o_orderdate AS actual_ship, l_shipdate AS actual_delivery
FROM lines JOIN part ON l_partkey = p_partkey""",
    "locations": f"""
SELECT 2 * s_suppkey AS iid, {_D} AS code, s_name AS name, 'Depot' AS nav_type,
  'Depot' AS rl_type, 'K' || CAST(s_nationkey AS STRING) AS corp_code, n_name AS corp_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL
SELECT 2 * c_custkey + 1, {_C}, c_name, c_mktsegment,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Renter' WHEN 'BUILDING' THEN NULL
    WHEN 'FURNITURE' THEN 'Distributor' WHEN 'HOUSEHOLD' THEN 'Recovery' ELSE 'NPD' END,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE 'K' || CAST(c_nationkey AS STRING) END, n_name
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "carrier_types": """
SELECT DISTINCT p_brand AS scac, 'Carrier ' || p_brand AS carrier_name,
  CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'CPU'
    ELSE 'Dedicated' END AS carrier_type
FROM part
WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5', 'Brand#6', 'Brand#7')""",
    "customers": f"""
SELECT 'I_' || {_C} AS customername, {_C} AS loccode, {_COUNTRY} AS country,
  r_name AS georegion, c_mktsegment AS territory, n_name AS subterritory,
  'Z' || CAST(n_nationkey AS STRING) AS zone, 'old' AS status, 'old' AS inplan,
  'old' AS corpcode, 'old' AS corpname, -1e0 AS planquantity, -1e0 AS issueqty,
  -1e0 AS avgloadsz
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "facilities": f"""
SELECT 'D_' || {_D} AS facilityname, {_D} AS loccode, {_COUNTRY} AS country,
  CASE WHEN s_acctbal < 0 THEN NULL ELSE {_DEPOT_TYPE} END AS depottype,
  r_name AS georegion, r_name AS territory, n_name AS subterritory,
  'Z' || CAST(n_nationkey AS STRING) AS zone,
  CASE WHEN s_acctbal < 2000 THEN 'Exclude' ELSE 'Include' END AS status,
  'old' AS closed, 'old' AS heat_treatment_rqmt, 9e0 AS fixedstartupcost,
  9e0 AS fixedclosingcost, 9e0 AS fixedoperatingcost, 'old' AS inplanmodel,
  'old' AS corpcode, 'old' AS corpname, -1e0 AS returnqty, -1e0 AS avgloadsz
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT 'R_' || {_C}, {_C}, {_COUNTRY}, CAST(NULL AS STRING), r_name, c_mktsegment, n_name,
  'Z' || CAST(n_nationkey AS STRING), 'Include', 'old', 'old', 9e0, 9e0, 9e0, 'old', 'old',
  'old', -1e0, -1e0
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "customerdemand": f"""
SELECT 'I_' || {_LINE_C} AS customername, {_PERIOD} AS periodname,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity * 150 END AS quantity
FROM lines WHERE l_returnflag = 'N'""",
    "periods": f"""
SELECT DISTINCT {_PERIOD} AS periodname,
  CASE WHEN month(l_shipdate) = 7 THEN NULL
    ELSE CAST(18 + month(l_shipdate) % 5 AS DOUBLE) END AS workingdays
FROM lineitem""",
    "productionconstraints": f"""
SELECT facilityname, 'x' AS facilitynamegroupbehavior, productname,
  'x' AS productnamegroupbehavior, periodname, 'x' AS periodnamegroupbehavior, bomname,
  'x' AS bomnamegroupbehavior, 'x' AS processname, 'x' AS processnamegroupbehavior,
  'Max' AS constrainttype, 'x' AS constraintvalueuom, notes, constraintvalue
FROM (
  SELECT 'R_' || {_LINE_C} AS facilityname, {_PRODUCT} AS productname, {_PERIOD} AS periodname,
    'none' AS bomname, 'Returns_Forecast' AS notes, sum(l_quantity * 150) AS constraintvalue
  FROM lines WHERE l_returnflag = 'R' GROUP BY 1, 2, 3
  UNION ALL
  SELECT DISTINCT 'D_' || {_code("D", "l_suppkey")}, 'RFU', {_PERIOD}, 'BOM_RFU_REPAIR',
    'Repair_Capacity', -1e0
  FROM lineitem
) AS both_kinds""",
    "customerfulfillmentpolicies": f"""
SELECT 'I_' || {_LINE_C} AS customername, productname, 'D_' || {_LINE_D} AS sourcename,
  9e0 AS unitcost, 'old' AS depottype, 'N' AS planflag, 'old' AS plan_depot_id,
  'old' AS status, 'old' AS notes,
  CASE WHEN (custkey + suppkey) % 19 = 0 THEN NULL
    WHEN productname = 'RFU' THEN CAST(abs(suppkey * 37 - custkey) % 2500 AS DOUBLE)
    ELSE CAST(abs(suppkey * 37 - custkey) % 2500 + 5 AS DOUBLE) END AS distance,
  CASE WHEN (custkey + suppkey) % 2 = 0 THEN 'Y' ELSE 'N' END AS greenfieldcandidate,
  CASE WHEN custkey % 5 = 0 THEN 'C' END AS cpudedicated, 'old' AS ozone, 'old' AS dzone,
  {_OLD_LANE}
FROM (SELECT DISTINCT custkey, suppkey, {_PRODUCT} AS productname FROM lines
  WHERE l_returnflag = 'N') AS lanes""",
    "replenishmentpolicies": f"""
SELECT facilityname, productname, sourcename, 9e0 AS unitcost, 'old' AS odepottype,
  'old' AS ddepottype, 'N' AS planflag, 'old' AS plan_depot_id, 'old' AS status,
  'old' AS notes,
  CASE WHEN (a + b) % 19 = 0 THEN NULL
    WHEN productname = 'RFU' THEN CAST(abs(b * 37 - a) % 2500 AS DOUBLE)
    ELSE CAST(abs(b * 37 - a) % 2500 + 5 AS DOUBLE) END AS distance,
  CASE WHEN (a + b) % 2 = 0 THEN 'Y' ELSE 'N' END AS greenfieldcandidate,
  CASE WHEN a % 5 = 0 THEN 'C' END AS cpudedicated, 'old' AS rentdistsortprefassig,
  {_OLD_LANE}
FROM (
  SELECT DISTINCT 'D_' || {_LINE_D} AS facilityname, {_PRODUCT} AS productname,
    'R_' || {_LINE_C} AS sourcename, custkey AS a, suppkey AS b
  FROM lines WHERE l_returnflag = 'R'
  UNION ALL
  SELECT DISTINCT 'D_' || {_LINE_D2}, {_PRODUCT}, 'D_' || {_LINE_D}, suppkey, suppkey2
  FROM lines WHERE l_returnflag = 'A'
) AS lanes""",
    "transportationpolicies": f"""
SELECT originname, destinationname, productname, 'TL' AS modename,
  CASE WHEN a % 2 = 0 THEN 'USA' ELSE 'CAN' END AS ocountry,
  CASE WHEN b % 3 = 0 THEN 'CAN' ELSE 'USA' END AS dcountry,
  'old' AS oloccode, 'old' AS dloccode, -1e0 AS histrate,
  CAST(500 + (a * 7 + b) % 700 AS DOUBLE) AS marketrate, -1e0 AS rfqrate,
  'old' AS rateused, -1e0 AS fixedcost, 'old' AS scac, 'old' AS scaccarriertype,
  'old' AS cpu, -1e0 AS unitcost, -1e0 AS dutyrate, -1e0 AS averageshipmentsize
FROM (
  SELECT DISTINCT
    CASE l_returnflag WHEN 'R' THEN 'R_' || {_LINE_C} ELSE 'D_' || {_LINE_D} END AS originname,
    CASE l_returnflag WHEN 'N' THEN 'I_' || {_LINE_C} WHEN 'R' THEN 'D_' || {_LINE_D}
      ELSE 'D_' || {_LINE_D2} END AS destinationname,
    {_PRODUCT} AS productname,
    CASE l_returnflag WHEN 'R' THEN custkey ELSE suppkey END AS a,
    CASE l_returnflag WHEN 'N' THEN custkey WHEN 'R' THEN suppkey ELSE suppkey2 END AS b
  FROM lines
) AS lanes""",
    "depot_assumptions": f"""
SELECT 'D_' || {_D} AS model_id, {_D} AS loc_code, s_name AS loc_description,
  CASE WHEN s_nationkey = 9 THEN NULL ELSE {_DEPOT_TYPE} END AS type,
  CASE WHEN s_nationkey % 4 = 0 THEN 'YES' WHEN s_nationkey = 5 THEN NULL ELSE 'NO' END AS closed,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(s_suppkey % 50 AS DOUBLE) END AS paint_upd,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Y' END AS heat_treat,
  CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST(s_suppkey % 90 AS DOUBLE) END AS fixed_upd,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_suppkey % 400 AS DOUBLE) END AS minimum_inv,
  CAST(s_suppkey % 900 AS DOUBLE) AS storage,
  CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE 70e0 END AS yard_space,
  CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 30e0 END AS temp_storage,
  CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE (s_suppkey % 8 - 1) / 8e0 END AS dmg_rate,
  CAST(s_suppkey % 120 - 10 AS DOUBLE) AS beginv_rfu,
  CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE CAST(s_suppkey % 60 AS DOUBLE) END AS beginv_wip,
  CAST(s_suppkey % 64 AS DOUBLE) AS beginv_mix,
  CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE CAST(s_suppkey % 33 AS DOUBLE) END AS repair_per_day,
  CASE WHEN s_suppkey % 12 = 0 THEN NULL ELSE CAST(s_suppkey % 17 AS DOUBLE) END AS repair_upd,
  CASE WHEN s_suppkey % 14 = 0 THEN NULL ELSE CAST(s_suppkey % 19 AS DOUBLE) END AS handling_in_upd,
  CASE WHEN s_suppkey % 15 = 0 THEN NULL ELSE CAST(s_suppkey % 21 AS DOUBLE) END AS handling_out_upd,
  CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE CAST(s_suppkey % 5 AS DOUBLE) END AS sort_upd
FROM supplier WHERE s_acctbal > 0
UNION ALL
SELECT 'R_' || {_C}, {_C}, c_name, 'Distributor Sort', 'NO', 1e0, 'Y', 2e0, 3e0, 4e0, 5e0, 6e0,
  5e-1, 8e0, 9e0, 1e1, 11e0, 12e0, 13e0, 14e0, 15e0
FROM customer WHERE c_mktsegment = 'HOUSEHOLD'""",
    "renter_assumptions": f"""
SELECT {_C} AS loc_code, 'I_' || {_C} AS model_id, c_name AS loc_desc, 'P' AS postal,
  n_name AS city, n_name AS state, n_name AS country, 'Corp' AS corp_name, 'K' AS corp_code,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE (c_custkey % 16) / 16e0 END AS npd_share
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')""",
    "depot_assignments": f"""
SELECT DISTINCT CASE l_returnflag WHEN 'N' THEN 'Issue' ELSE 'Return' END AS movetype,
  {_LINE_C} AS loc_code, {_LINE_C} AS location_name, {_LINE_D} AS depot_code,
  {_LINE_D} AS depot_name,
  CASE l_returnflag WHEN 'N' THEN 'I_' ELSE 'R_' END || {_LINE_C} AS oname,
  'D_' || {_LINE_D} AS revised_dname
FROM lines WHERE l_returnflag IN ('N', 'R') AND o_orderpriority = '1-URGENT'""",
    "multisource_list": f"""
SELECT DISTINCT CASE l_returnflag WHEN 'N' THEN 'Issue' ELSE 'Return' END AS movetype,
  {_LINE_C} AS customer_code, {_LINE_C} AS customer_name, 'Z' AS customer_zone,
  'R' AS customer_region, {_LINE_D} AS depot_code, {_LINE_D} AS depot_name,
  'T' AS depot_type, 1e0 AS total, 1e0 AS volume_share, 1e0 AS depots,
  CASE (custkey + suppkey) % 5 WHEN 0 THEN 'YES' WHEN 1 THEN 'yes' WHEN 2 THEN 'N'
    WHEN 3 THEN 'y' ELSE 'no' END AS ok_to_include
FROM lines WHERE l_returnflag IN ('N', 'R') AND l_discount >= 85e-3""",
    "preferred_depots": f"""
SELECT {_LINE_D} AS ocode, {_LINE_D} AS oname, {_LINE_D2} AS dcode, {_LINE_D2} AS dname,
  CAST(count(*) AS DOUBLE) AS recent_loads, 'Y' AS comments
FROM lines WHERE l_returnflag = 'A' AND l_tax >= 65e-3 GROUP BY suppkey, suppkey2""",
    "rfq_rates": f"""
SELECT DISTINCT
  CASE l_returnflag WHEN 'R' THEN {_LINE_C} ELSE {_LINE_D} END || ' to ' ||
  CASE l_returnflag WHEN 'N' THEN {_LINE_C} WHEN 'R' THEN {_LINE_D} ELSE {_LINE_D2} END
    AS lane_name,
  CAST(300 + (CASE l_returnflag WHEN 'A' THEN suppkey2 ELSE custkey END + suppkey * 13) % 400
    AS DOUBLE) AS rfqrate
FROM lines WHERE l_tax >= 75e-3""",
    "groups": f"""
SELECT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'SplitSource_Renter_KeepSingleSource'
    WHEN 'BUILDING' THEN 'SplitSource_Distributor_AllowToMultiSource'
    ELSE c_mktsegment END AS groupname, 'Customers' AS grouptype, 'I_' || {_C} AS membername
FROM customer""",
    "inventoryconstraints": f"""
SELECT facilityname, 'x' AS facilitynamegroupbehavior, 'RFU' AS productname,
  'x' AS productnamegroupbehavior, 'P01' AS periodname, 'x' AS periodnamegroupbehavior,
  constrainttype, 'x' AS constraintvalueuom, 'x' AS consideredinventory, notes,
  -1e0 AS constraintvalue
FROM (
  SELECT 'D_' || {_D} AS facilityname, 'Min' AS constrainttype, 'MinInventory' AS notes
  FROM supplier
  UNION ALL SELECT 'D_' || {_D}, 'Max', 'Depot_Capacity' FROM supplier
  UNION ALL SELECT 'D_' || {_D}, 'Other', 'Other' FROM supplier
) AS kinds""",
    "inventorypolicies": f"""
SELECT 'D_' || {_D} AS facilityname, 'RFU' AS productname, 'Beginning_Inventory' AS notes,
  -1e0 AS initialinventory FROM supplier
UNION ALL SELECT 'D_' || {_D}, 'WIP', 'Beginning_Inventory', -1e0 FROM supplier
UNION ALL SELECT 'D_' || {_D}, 'NEW', 'Other', -1e0 FROM supplier""",
    "productionpolicies": f"""
SELECT 'D_' || {_D} AS facilityname, 'RFU' AS productname, 'BOM_RFU_REPAIR' AS bomname,
  'x' AS processname, -1e0 AS unitcost FROM supplier
UNION ALL SELECT 'D_' || {_D}, 'RFU', 'OTHER', 'x', -1e0 FROM supplier""",
    "warehousingpolicies": f"""
SELECT 'D_' || {_D} AS facilityname, 'RFU' AS productname, 9e0 AS inboundhandlingcost,
  9e0 AS outboundhandlingcost FROM supplier
UNION ALL SELECT 'D_' || {_D}, 'WIP', 9e0, 9e0 FROM supplier""",
    "orders_old": """
SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN ''
    ELSE CAST(o_totalprice AS STRING) END AS o_totalprice, o_orderpriority
FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS STRING), 'twice'
FROM orders WHERE o_totalprice < 15e2""",
    "orders_new": """
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN NULL
    ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN NULL
    WHEN o_orderstatus = 'O' THEN o_totalprice + 4e-3
    WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 10
    ELSE o_totalprice END AS o_totalprice,
  o_orderpriority, o_orderdate
FROM orders WHERE o_totalprice >= 2e3
UNION ALL
SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate
FROM orders WHERE o_totalprice < 25e2""",
}

# What Spark works out of an order line before it joins it, and the columns that it then
# need not move: the net amount stands for price and discount, and the second depot is
# worked out again from what the shipment id needs anyway. The rows stay the same.
_NET = "floor(l_extendedprice * (1 - l_discount) / 1e1)"
_SECOND_DEPOT = """CASE WHEN suppkey > l_linenumber THEN suppkey - l_linenumber
    ELSE suppkey + l_linenumber END"""
NARROW = {
    "lines": VIEWS["lines"].replace("SELECT l_orderkey,", "SELECT l_orderkey, l_net,"),
    "shipments": VIEWS["shipments"].replace(_NET, "l_net").replace("suppkey2", _SECOND_DEPOT),
}

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def needed(sql: str, known: dict[str, str]) -> list[str]:
    """Names of ``known`` that the text uses, directly or through each other,
    in the order of their definition."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(_WORD.findall(todo.pop()))
        for name in (words & known.keys()) - found:
            found.add(name)
            todo.append(known[name])
    return [name for name in known if name in found]


def with_clause(sql: str, known: dict[str, str]) -> str:
    parts = [f"{name} AS ({known[name].strip()})" for name in needed(sql, known)]
    return (f"WITH {', '.join(parts)} " if parts else "") + sql.strip()


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def view(
    spark: SparkSession, sf_dir: str, name: str, stored: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """A view over the tables of ``sf_dir``. Raw tables are passed in as DataFrames, and so are
    views in ``stored``, which are not computed again."""
    stored = stored or {}
    narrow = NARROW if name == "shipments" and not stored.keys() & NARROW.keys() else {}
    others = {n: text for n, text in {**VIEWS, **narrow}.items() if n not in stored}
    text = with_clause(f"SELECT * FROM {name}", others)
    tables = [t for t in (*RAW_TABLES, *stored) if re.search(rf"\b{t}\b", text)]
    for table in tables:
        text = re.sub(rf"\b{table}\b", f"{{{table}}}", text)
    given = {t: stored[t] if t in stored else raw(spark, sf_dir, t) for t in tables}
    if narrow:
        given["lineitem"] = given["lineitem"].withColumn("l_net", F.expr(_NET))
    return spark.sql(text, **given)

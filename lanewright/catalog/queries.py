"""One query per operator, each over the whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.catalog.views import AS_OF, PARAMS, raw, view
from lanewright.functions import bands, nulls
from lanewright.functions import shipments as sf
from lanewright.operators import lookup as lk
from lanewright.operators import profile, quality, rank, reconcile, snapshot_diff, update
from lanewright.plans import (
    depots,
    flags,
    history,
    history_states,
    lanes,
    multisource,
    penalties,
    places,
    rates,
    refresh,
    sizes,
    transfers,
)
from lanewright.sources import readers, staging, versions
from lanewright.specs import MODEL_TABLES, SIDE_INPUTS, SideInputSpec, TableSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Carrier lists of the literal-list classifier.
CPU_LIST = ("Brand#1", "Brand#2", "Brand#3")
DEDICATED_LIST = ("Brand#4", "Brand#5", "Brand#6", "Brand#7")

ORDERS_SPEC = TableSpec("orders", ("o_orderkey",), ("o_totalprice",))


class Inputs:
    """Lazy access to views and raw tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.written: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        """Called once per name; the DataFrame then stays as an attribute."""
        if name.startswith("raw_"):
            df = raw(self.spark, self.sf_dir, name[4:])
        else:
            df = view(self.spark, self.sf_dir, name, self.written)
        setattr(self, name, df)
        return df

    def store(self, stage: staging.Stage, name: str) -> None:
        """Write a view that others read, so that those opened from now on do not compute it."""
        self.written[name] = stage.cut(getattr(self, name), f"view_{name}")
        setattr(self, name, self.written[name])

    def model(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in MODEL_TABLES}

    def side(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in SIDE_INPUTS}


def query(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
    return fn


def _text(moment: str) -> Column:
    return F.date_format(moment, "yyyy-MM-dd").alias(moment)


# --- sources and sinks -------------------------------------------------------


@query
def src_model_snapshot(i: Inputs) -> DataFrame:
    """Text columns and a surrogate id, as a model database holds them, read typed."""
    policies = i.customerfulfillmentpolicies
    stored = policies.select(
        F.xxhash64("customername", "productname", "sourcename").alias("id"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in policies.columns],
    )
    typed = readers.typed_model_table(stored, MODEL_TABLES["customerfulfillmentpolicies"])
    return typed.select("customername", "productname", "sourcename", "unitcost", "distance")


@query
def src_model_tables(i: Inputs) -> DataFrame:
    """All model tables stored as text, read typed: rows, and values and total of each number."""
    stage = staging.Stage(i.spark)
    stage.cut_all(
        {
            name: df.select(
                F.monotonically_increasing_id().alias("id"),
                *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns],
            )
            for name, df in i.model().items()
        }
    )
    parts = []
    for name, df in readers.read_model(i.spark, stage.root).items():
        numbers = [c for c in MODEL_TABLES[name].numeric if c in df.columns]
        none = F.lit(None).cast("double")
        found = [("*", F.count(F.lit(1)), none)]
        found += [(c, F.count(c), F.round(F.sum(c), 2)) for c in numbers]
        facts = df.agg(*[v.alias(f"n{k}") for k, (_, v, _t) in enumerate(found)],
                       *[t.alias(f"t{k}") for k, (_, _v, t) in enumerate(found) if k])
        lines = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.col(f"n{k}").alias("n_values"),
                (F.col(f"t{k}") if k else none).alias("total"),
            )
            for k, (c, _v, _t) in enumerate(found)
        ]
        parts.append(facts.select(F.inline(F.array(*lines))).filter("n_values > 0"))
    return reduce(DataFrame.unionByName, parts)


def _kept_as_csv(i: Inputs, stage: staging.Stage, name: str) -> DataFrame:
    """The side input as people keep it: CSV, notes above the header, cells that are
    quoted; read back typed. The sheet is its first file, and what follows may be many."""
    spec = SIDE_INPUTS[name]
    sheet = getattr(i, name)
    present = [(old, new) for old, new in spec.columns.items() if new in sheet.columns]
    quoted = {"escape": '"', "quoteAll": "true"}
    cells = F.struct(*[F.col(new).cast("string").alias(old) for old, new in present])
    notes = [f"notes on {name}, line {k + 1}" for k in range(spec.header_row)]
    header = ",".join(f'"{old}"' for old, _ in present)
    above = i.spark.createDataFrame(list(enumerate([*notes, header])), "at int, value string")
    body = sheet.select(F.to_csv(cells, quoted).alias("value"))
    path = f"{stage.root}/sheets/{name}"
    top = above.coalesce(1).sortWithinPartitions("at")
    top.select("value").write.text(f"{path}/top")
    body.select("value").write.text(f"{path}/rows")
    return readers.read_side_input(i.spark, f"{path}/top", spec, more=f"{path}/rows")


@query
def src_side_input_typed(i: Inputs) -> DataFrame:
    """A side input kept as a CSV file, its notes skipped, read under plan names and typed."""
    return _kept_as_csv(i, staging.Stage(i.spark), "depot_assumptions")


@query
def src_side_inputs(i: Inputs) -> DataFrame:
    """All side inputs kept as CSV files and read back: rows, and values of each column."""
    stage = staging.Stage(i.spark)
    parts = []
    for name, sheet in i.side().items():
        df = _kept_as_csv(i, stage, name)
        numbers = [c for c in SIDE_INPUTS[name].numeric if c in df.columns]
        total = {c: F.round(F.sum(c), 2) for c in numbers}
        none = F.lit(None).cast("double")
        facts = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.struct(F.count(c).alias("n"), total.get(c, none).alias("t")).alias(c) for c in df.columns],
        )
        lines = [F.struct(F.lit("*").alias("column_name"), F.col("rows").alias("n_values"), none.alias("total"))]
        lines += [
            F.struct(
                F.lit(c).alias("column_name"), F.col(c)["n"].alias("n_values"), F.col(c)["t"].alias("total")
            )
            for c in df.columns
        ]
        parts.append(facts.select(F.lit(name).alias("input_name"), F.inline(F.array(*lines))))
    return reduce(DataFrame.unionByName, parts)


@query
def snk_roundtrip(i: Inputs) -> DataFrame:
    """Publish a snapshot of two tables and read the current one back."""
    stage = staging.Stage(i.spark)
    tables = {"transportationpolicies": i.transportationpolicies, "periods": i.periods}
    staging.publish(tables, f"{stage.root}/published")
    current = staging.read_published(i.spark, f"{stage.root}/published")
    return current["transportationpolicies"]


@query
def snk_report(i: Inputs) -> DataFrame:
    """Reconciliation details written by kind and table, and read back."""
    stage = staging.Stage(i.spark)
    details = reconcile.report(
        {"orders": i.orders_old}, {"orders": i.orders_new}, {"orders": ORDERS_SPEC}, stage
    )
    staging.write_report(details, f"{stage.root}/report")
    parts = [
        i.spark.read.parquet(f"{stage.root}/report/{kind}").withColumn("kind", F.lit(kind))
        for kind in details
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# --- projections, filters, predicates ----------------------------------------


@query
def prj_rename_select(i: Inputs) -> DataFrame:
    renamed = i.customers.withColumnsRenamed({"customername": "model_id", "loccode": "customer"})
    return renamed.select(F.lit(sf.ISSUE).alias("movetype"), "customer", "model_id")


@query
def prj_suffix_selfjoin(i: Inputs) -> DataFrame:
    facilities = i.facilities.select("facilityname", "country", "depottype", "zone")
    origin = lk.suffix_columns(facilities, "_orig")
    destination = lk.suffix_columns(facilities, "_dest")
    policies = i.replenishmentpolicies.select("sourcename", "facilityname", "productname")
    return policies.join(
        origin, F.col("sourcename") == F.col("facilityname_orig"), "left"
    ).join(destination, F.col("facilityname") == F.col("facilityname_dest"), "left")


@query
def prj_conditional_reset(i: Inputs) -> DataFrame:
    is_return = F.col("sourcename").startswith("R")
    return i.replenishmentpolicies.select(
        "facilityname",
        "productname",
        "sourcename",
        F.when(is_return, "Exclude").otherwise(F.col("status")).alias("status"),
        F.when(is_return, flags.ALL_RETURNS).otherwise(F.col("notes")).alias("notes"),
    )


@query
def prj_masked_assign(i: Inputs) -> DataFrame:
    to_canada = (F.col("ocountry") == rates.USA) & (F.col("dcountry") == rates.CANADA)
    to_us = (F.col("ocountry") == rates.CANADA) & (F.col("dcountry") == rates.USA)
    duty = F.when(to_canada, PARAMS.duty_us_to_canada).when(to_us, PARAMS.duty_canada_to_us)
    return i.transportationpolicies.select(
        "originname", "destinationname", "productname", duty.alias("dutyrate")
    )


@query
def flt_equality(i: Inputs) -> DataFrame:
    return i.productionconstraints.filter(F.col("notes") == PARAMS.repair_notes).select(
        "facilityname", "periodname", "constraintvalue"
    )


@query
def flt_isin(i: Inputs) -> DataFrame:
    """Facilities not of a closest type; a missing type is not of one."""
    return i.facilities.filter(~nulls.in_list(F.col("depottype"), lanes.CLOSEST_TYPES)).select(
        "facilityname", "depottype"
    )


@query
def flt_prefix(i: Inputs) -> DataFrame:
    transfer = F.col("sourcename").startswith("D") & F.col("facilityname").startswith("D")
    return i.replenishmentpolicies.filter(transfer).select(
        "facilityname", "sourcename", "productname"
    )


@query
def flt_dropna(i: Inputs) -> DataFrame:
    cols = ["scac", "status", "distance"]
    return i.shipments.dropna(subset=cols).select("tnumber", *cols)


@query
def flt_period_horizon(i: Inputs) -> DataFrame:
    inside = sf.period_number(F.col("periodname")) <= PARAMS.horizon_periods
    return i.customerdemand.filter(inside)


def _costs(i: Inputs) -> DataFrame:
    return history.lane_costs(
        i.shipments, i.locations, i.carrier_types, AS_OF, PARAMS.months_costs
    )


@query
def flt_cost_or_type(i: Inputs) -> DataFrame:
    kept = (F.col("ttl_lh_cost") > 2000.0) | (F.col("carrier_type") == sf.CPU)
    return _costs(i).filter(kept).select("tnumber", "lane_id", "carrier_type", "ttl_lh_cost")


@query
def flt_trailing_days(i: Inputs) -> DataFrame:
    return i.shipments.filter(sf.within_days(F.col("date_to"), AS_OF, 60)).select(
        "tnumber", "location_from", "location_to", _text("date_to")
    )


@query
def flt_trailing_months(i: Inputs) -> DataFrame:
    return i.shipments.filter(sf.within_months(F.col("date_to"), AS_OF, 3)).select(
        "tnumber", "location_from", "location_to", _text("date_to")
    )


@query
def flt_shipment_valid(i: Inputs) -> DataFrame:
    kept = history.live_shipments(i.shipments).filter(
        sf.not_prefixed(F.col("tnumber"), sf.TRANSFER_PREFIX) & F.col("scac").isNotNull()
    )
    return kept.select("tnumber", "status", "scac")


# --- joins -------------------------------------------------------------------


@query
def jn_left_lookup(i: Inputs) -> DataFrame:
    policies = i.customerfulfillmentpolicies.select("customername", "productname", "sourcename")
    take = {"depot_type": "depottype", "depot_country": "country"}
    return lk.lookup(policies, i.facilities, {"sourcename": "facilityname"}, take)


@query
def jn_left_shared(i: Inputs) -> DataFrame:
    rows = i.productionconstraints.select("facilityname", "periodname", "productname", "notes")
    return rows.join(i.periods, "periodname", "left")


@query
def jn_left_composite(i: Inputs) -> DataFrame:
    policies = i.customerfulfillmentpolicies.select("customername", "productname", "sourcename")
    return lk.lookup(
        policies,
        i.depot_assignments,
        {"customername": "oname", "sourcename": "revised_dname"},
        {"assigned_depot": "depot_code"},
    )


def _carrier_inputs(i: Inputs) -> tuple:
    given = (i.shipments, i.locations, i.carrier_types)
    return (*given, AS_OF, PARAMS.months_costs, PARAMS.min_line_haul)


def _carrier_loads(i: Inputs, min_loads: int = PARAMS.min_loads) -> DataFrame:
    return history.lane_carrier_loads(*_carrier_inputs(i), min_loads)


def _cost_per_load(i: Inputs) -> DataFrame:
    return history.cost_of_loads(_carrier_loads(i))


@query
def jn_inner(i: Inputs) -> DataFrame:
    """Lane totals with the lane's main carrier."""
    loads = staging.Stage(i.spark).cut(_carrier_loads(i), "carrier_loads")
    totals = loads.groupBy("movetype", "lane_id").agg(
        F.sum("total_loads").alias("total_loads"), F.sum("ttl_lh_cost").alias("ttl_lh_cost")
    )
    return totals.join(history.top_carriers(loads), ["movetype", "lane_id"], "inner")


def _lane_loads(i: Inputs, days: int) -> DataFrame:
    return history.lane_loads(i.shipments, i.locations, i.carrier_types, AS_OF, days)


@query
def jn_full_outer(i: Inputs) -> DataFrame:
    loads = _lane_loads(i, 60).dropna().select("movetype", "lane_id", "other_loads", "cpu_loads")
    cost = _cost_per_load(i)
    return loads.join(
        cost.select("movetype", "lane_id", "scac", "histrate"),
        ["movetype", "lane_id"],
        "full_outer",
    )


@query
def jn_dual_lookup(i: Inputs) -> DataFrame:
    placed = lanes.transport_places(i.transportationpolicies, i.facilities)
    return placed.select(
        "originname",
        "destinationname",
        "productname",
        "ocountry",
        "dcountry",
        "oloccode",
        "dloccode",
    )


@query
def jn_exists_flag(i: Inputs) -> DataFrame:
    policies = i.customerfulfillmentpolicies.select("customername", "productname", "sourcename")
    listed = i.depot_assignments.filter(F.col("movetype") == sf.ISSUE)
    flagged = lk.exists_flag(policies, listed, {"customername": "oname"}, "listed")
    return flagged.withColumn("listed", F.when(F.col("listed"), "Y").otherwise("N"))


@query
def jn_semi_anti(i: Inputs) -> DataFrame:
    old, new = i.orders_old.select("o_orderkey"), i.orders_new.select("o_orderkey")
    both = old.join(new, "o_orderkey", "left_semi").withColumn("side", F.lit("both"))
    gone = old.join(new, "o_orderkey", "left_anti").withColumn("side", F.lit("left_only"))
    return both.unionByName(gone)


# --- keyed update ------------------------------------------------------------


def _update_target(i: Inputs) -> DataFrame:
    return i.raw_orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


def _update_source(i: Inputs) -> DataFrame:
    urgent = i.raw_orders.filter(F.col("o_orderpriority") == "1-URGENT")
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") + 10)
    return urgent.select("o_orderkey", price.alias("o_totalprice"), "o_orderdate")


@query
def upd_coalesce(i: Inputs) -> DataFrame:
    return update.update_by_key(
        _update_target(i), _update_source(i), ["o_orderkey"], ["o_totalprice"]
    )


@query
def upd_overwrite(i: Inputs) -> DataFrame:
    return update.update_by_key(
        _update_target(i),
        _update_source(i),
        ["o_orderkey"],
        ["o_totalprice"],
        null_policy="overwrite",
    )


@query
def upd_reset_then_update(i: Inputs) -> DataFrame:
    listed = i.customers.filter(F.col("territory").isin("BUILDING", "MACHINERY"))
    source = listed.select("customername", F.lit("Y").alias("inplan"))
    updated = update.update_by_key(
        i.customers, source, ["customername"], ["inplan"], defaults={"inplan": "N"}
    )
    return updated.select("customername", "territory", "inplan")


@query
def upd_fused(i: Inputs) -> DataFrame:
    """Four updates of orders by their key, with resets and both null rules, in one pass."""
    lines = i.raw_lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity")
    )
    many = lines.filter("n_lines >= 5").select(
        F.col("l_orderkey").alias("o_orderkey"), F.lit("5-MANY").alias("o_orderpriority")
    )
    odd = i.raw_orders.filter("o_orderkey % 3 = 0").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, "X").alias("o_orderstatus")
    )
    target = i.raw_orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return update.update_all(
        target,
        [
            update.Update(
                lines.select("l_orderkey", F.col("quantity").alias("o_totalprice")),
                {"o_orderkey": "l_orderkey"},
                ["o_totalprice"],
                source_is_unique=True,
                defaults={"o_totalprice": 0.0},
            ),
            update.Update(many, ["o_orderkey"], ["o_orderpriority"], defaults={"o_orderpriority": "few"}),
            update.Update(odd, ["o_orderkey"], ["o_orderstatus"], null_policy="overwrite"),
            update.Update(
                _update_source(i),
                ["o_orderkey"],
                ["o_totalprice"],
                defaults={"o_totalprice": F.col("o_totalprice") + F.when(F.col("o_orderpriority") == "few", 1).otherwise(0)},
            ),
        ],
    )


@query
def upd_dedup_first(i: Inputs) -> DataFrame:
    order = [
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_shipdate",
        "l_returnflag",
        "l_linestatus",
    ]
    kept = rank.first_per_key(i.raw_lineitem, ["l_orderkey", "l_linenumber"], order)
    return kept.withColumn("l_shipdate", _text("l_shipdate"))


@query
def upd_source_duplicates(i: Inputs) -> DataFrame:
    return update.duplicate_source_keys(i.raw_lineitem, ["l_orderkey", "l_linenumber"])


@query
def upd_two_roles(i: Inputs) -> DataFrame:
    typed = depots.replenishment_depot_types(i.replenishmentpolicies, i.depot_assumptions)
    return typed.select("facilityname", "productname", "sourcename", "odepottype", "ddepottype")


def _resolved(i: Inputs) -> DataFrame:
    return multisource.resolve(i.multisource_list, i.customers, i.facilities)


@query
def upd_replace_groups(i: Inputs) -> DataFrame:
    return multisource.rebuild_groups(i.groups, _resolved(i), i.customers, i.facilities)


# --- aggregations ------------------------------------------------------------


@query
def agg_sum(i: Inputs) -> DataFrame:
    return i.customerdemand.groupBy("customername").agg(
        F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("quantity")
    )


@query
def agg_mean(i: Inputs) -> DataFrame:
    return places.horizon_totals(i.customerdemand, "customername", "quantity", PARAMS, mean=True)


@query
def agg_multi_level(i: Inputs) -> DataFrame:
    """Loads and line haul by lane side, by lane and carrier, and by lane."""
    loads = staging.Stage(i.spark).cut(_carrier_loads(i, 0), "carrier_loads")
    shown = ["movetype", "lane_id", "scac"]

    def level(name: str, keys: list[str]) -> DataFrame:
        sums = loads.groupBy(*keys).agg(
            F.sum("total_loads").alias("total_loads"), F.sum("ttl_lh_cost").alias("ttl_lh_cost")
        )
        cols = [F.col(c) if c in keys else F.lit(None).cast("string").alias(c) for c in shown]
        return sums.select(F.lit(name).alias("level"), *cols, "total_loads", "ttl_lh_cost")

    return level("carrier", shown).unionByName(level("lane", shown[:2]))


@query
def agg_conditional_counts(i: Inputs) -> DataFrame:
    kind = sf.carrier_class(F.col("scac"), CPU_LIST, DEDICATED_LIST)
    named = F.col("scac").isNotNull()
    return i.shipments.groupBy("location_from").agg(
        F.count_if(kind == sf.CPU).alias("cpu_loads"),
        F.count_if(kind == sf.DEDICATED).alias("dedicated_loads"),
        F.count_if((kind == sf.OTHER) & named).alias("other_loads"),
    )


@query
def agg_having(i: Inputs) -> DataFrame:
    return _carrier_loads(i)


@query
def agg_count_distinct(i: Inputs) -> DataFrame:
    """Distinct depots per customer over all of history."""
    return history.depots_per_customer(i.shipments, i.locations, AS_OF, None)


@query
def agg_null_default(i: Inputs) -> DataFrame:
    return i.shipments.groupBy("location_from").agg(
        F.count(F.lit(1)).alias("load_count"),
        F.avg(F.coalesce("qty_to", F.lit(0.0))).alias("average_cube"),
    )


@query
def agg_guarded_cost(i: Inputs) -> DataFrame:
    parts = [F.col(c) for c in ("inv_fuel", "inv_other", "inv_detention", "inv_tax")]
    cost = sf.invoice_cost(F.col("inv_linehaul"), parts, F.col("norm_charge"), F.col("charge"))
    return i.shipments.groupBy("location_from").agg(F.round(F.sum(cost), 2).alias("ttl_cost"))


@query
def agg_signed_sum(i: Inputs) -> DataFrame:
    return i.shipments.groupBy("location_to").agg(
        F.sum(-F.col("qty_from")).alias("volume"), F.count("qty_to").alias("total_loads")
    )


# --- ranking, sort, distinct, set operations ---------------------------------


@query
def rnk_top1_nearest(i: Inputs) -> DataFrame:
    return lanes.closest_depots(
        i.customerfulfillmentpolicies, i.facilities, "customername", "sourcename", PARAMS
    )


@query
def rnk_top_carrier(i: Inputs) -> DataFrame:
    return history.lane_top_carriers(*_carrier_inputs(i), 0)


@query
def srt_multi_key(i: Inputs) -> DataFrame:
    rows = reconcile.normalize(i.orders_old, ["o_totalprice"])
    return rows.select(*sorted(rows.columns)).orderBy(
        "o_orderkey", F.col("o_orderpriority").asc_nulls_last()
    )


@query
def dst_distinct(i: Inputs) -> DataFrame:
    return i.customerfulfillmentpolicies.select("customername", "sourcename").distinct()


@query
def set_union_all(i: Inputs) -> DataFrame:
    customers = i.customers.select("loccode", "country", F.col("customername").alias("model_id"))
    sites = i.facilities.select(
        F.col("facilityname").alias("model_id"), "loccode", "country", "depottype"
    )
    return customers.unionByName(sites, allowMissingColumns=True)


@query
def set_symmetric_pairs(i: Inputs) -> DataFrame:
    return lk.symmetric_pairs(i.preferred_depots, "ocode", "dcode")


@query
def set_split_recombine(i: Inputs) -> DataFrame:
    """Country of the destination: customers for issues, facilities for the rest."""
    lanes_ = i.transportationpolicies.select("originname", "destinationname", "productname")
    lanes_ = lanes_.withColumn(
        "movetype",
        F.when(F.col("destinationname").startswith(sf.CUSTOMER_ROLE), sf.ISSUE)
        .when(F.col("originname").startswith(sf.RETURN_ROLE), sf.RETURN)
        .otherwise(sf.TRANSFER),
    )
    rows = lk.lookup(lanes_, i.customers, {"destinationname": "customername"}, {"a": "country"})
    rows = lk.lookup(rows, i.facilities, {"destinationname": "facilityname"}, {"b": "country"})
    country = F.when(F.col("movetype") == sf.ISSUE, F.col("a")).otherwise(F.col("b"))
    return rows.withColumn("end_country", country).drop("a", "b")


# --- scalar functions --------------------------------------------------------


@query
def sc_substrings(i: Inputs) -> DataFrame:
    return i.rfq_rates.select(
        "lane_name",
        sf.origin_code(F.col("lane_name"), PARAMS.code_length).alias("origin_code"),
        sf.destination_code(F.col("lane_name"), PARAMS.code_length).alias("destination_code"),
    )


@query
def sc_lane_id(i: Inputs) -> DataFrame:
    ends = lk.lookup(i.shipments, i.locations, {"location_from": "iid"}, {"a": "code"})
    ends = lk.lookup(
        ends,
        i.locations.filter(F.col("rl_type").isNotNull()),
        {"location_to": "iid"},
        {"b": "code"},
    )
    return ends.select("tnumber", sf.lane_id(F.col("a"), F.col("b")).alias("lane_id"))


@query
def sc_movetype(i: Inputs) -> DataFrame:
    return i.shipments.select(
        "tnumber",
        sf.move_type(F.col("tnumber")).alias("movetype"),
        sf.move_type(F.col("tnumber"), transfers=False).alias("movetype_no_transfer"),
    )


@query
def sc_role_swap(i: Inputs) -> DataFrame:
    kind = sf.move_type(F.col("tnumber"))
    a, b = F.col("location_from").cast("string"), F.col("location_to").cast("string")
    return i.shipments.select(
        "tnumber",
        sf.depot_side(kind, a, b).alias("depot"),
        sf.customer_side(kind, a, b).alias("customer"),
    )


@query
def sc_carrier_class(i: Inputs) -> DataFrame:
    kind = sf.carrier_class(F.col("scac"), CPU_LIST, DEDICATED_LIST)
    return i.shipments.select("tnumber", "scac", kind.alias("carrier_type"))


@query
def sc_null_default(i: Inputs) -> DataFrame:
    return i.shipments.select(
        "tnumber",
        nulls.or_zero(F.col("qty_to")).alias("qty_to"),
        F.coalesce("scac", F.lit("none")).alias("scac"),
    )


@query
def sc_coalesce_cols(i: Inputs) -> DataFrame:
    value = F.coalesce("qty_to", "inv_other", "distance")
    return i.shipments.select("tnumber", value.alias("first_value"))


@query
def sc_clip(i: Inputs) -> DataFrame:
    return i.raw_customer.select(
        "c_custkey", nulls.floor_at(F.col("c_acctbal")).alias("c_acctbal")
    )


@query
def sc_distance_band(i: Inputs) -> DataFrame:
    return i.shipments.select(
        "tnumber", "distance", bands.mileage_band(F.col("distance")).alias("band")
    )


@query
def sc_threshold_band(i: Inputs) -> DataFrame:
    return i.customerdemand.select(
        "customername", "periodname", "quantity", bands.pallet_band(F.col("quantity")).alias("band")
    )


@query
def sc_numeric_cast(i: Inputs) -> DataFrame:
    return i.orders_old.select(
        "o_orderkey",
        nulls.to_double(F.col("o_totalprice")).alias("price"),
        nulls.to_double(F.left("o_orderpriority", F.lit(1))).alias("priority"),
    )


# --- data quality ------------------------------------------------------------


@query
def dq_duplicate_keys(i: Inputs) -> DataFrame:
    return quality.duplicate_keys(i.raw_lineitem, ["l_orderkey", "l_linenumber"])


@query
def dq_one_to_one(i: Inputs) -> DataFrame:
    return quality.one_to_one(i.raw_part, ["p_brand", "p_type"])


@query
def dq_missing_values(i: Inputs) -> DataFrame:
    cols = ["tnumber", "status", "scac", "distance", "qty_to", "inv_linehaul", "inv_other"]
    return quality.missing_values(i.shipments, cols)


@query
def dq_allowed_values(i: Inputs) -> DataFrame:
    allowed = {"scac": CPU_LIST + DEDICATED_LIST, "status": ("1", "3")}
    return quality.allowed_values(
        i.shipments.withColumn("status", F.col("status").cast("string")), allowed
    )


@query
def dq_gate_report(i: Inputs) -> DataFrame:
    """All rules over all seven side inputs, stored once as each rule reads them."""
    return quality.gate_report(staging.Stage(i.spark).cut_all(i.side()), SIDE_INPUTS)


SHEET = SideInputSpec("sheet", 0, {"Key": "key", "Cost": "cost"}, ("key",), numeric=("cost",))


@query
def dq_unreadable(i: Inputs) -> DataFrame:
    """Numbers and periods that cannot be read are broken rules, not nulls."""
    key, cost = F.col("s_suppkey"), F.col("s_acctbal").cast("string")
    odd = F.when(key % 7 == 0, F.concat(F.lit("$"), cost)).when(key % 11 == 0, "n/a")
    raw_sheet = i.raw_supplier.select(
        key.cast("string").alias("Key"), F.coalesce(odd, cost).alias("Cost")
    )
    sheet = readers.typed_side_input(raw_sheet, SHEET, SHEET.columns, list_unreadable=True)
    month = F.when(F.col("customername").endswith("7"), "Jan").otherwise(F.col("periodname"))
    demand = i.customerdemand.withColumn("periodname", month)
    return quality.gate_report({"sheet": sheet}, {"sheet": SHEET}, {"customerdemand": demand})


# --- reconciliation ----------------------------------------------------------


@query
def rec_column_diff(i: Inputs) -> DataFrame:
    return reconcile.column_diff(i.orders_old, i.orders_new)


@query
def rec_row_counts(i: Inputs) -> DataFrame:
    return reconcile.row_count_diff(i.orders_old, i.orders_new)


@query
def rec_normalize(i: Inputs) -> DataFrame:
    old = reconcile.normalize(i.orders_old, ["o_totalprice"])
    new = reconcile.normalize(i.orders_new.drop("o_orderdate"), ["o_totalprice"])
    side = F.lit
    return old.withColumn("side", side("old")).unionByName(new.withColumn("side", side("new")))


@query
def rec_split_duplicates(i: Inputs) -> DataFrame:
    repeated, single = reconcile.split_duplicates(i.orders_old, ["o_orderkey"])
    return repeated.withColumn("part", F.lit("repeated")).unionByName(
        single.withColumn("part", F.lit("single"))
    )


@query
def rec_key_diff(i: Inputs) -> DataFrame:
    return reconcile.key_diff(i.orders_old, i.orders_new, ["o_orderkey"])


@query
def rec_cell_diff(i: Inputs) -> DataFrame:
    return reconcile.cell_diff(i.orders_old, i.orders_new, ["o_orderkey"], ["o_totalprice"])


@query
def rec_summary(i: Inputs) -> DataFrame:
    return reconcile.summary(
        {"orders": i.orders_old}, {"orders": i.orders_new}, {"orders": ORDERS_SPEC}
    )


@query
def rec_numeric_keys(i: Inputs) -> DataFrame:
    """Keys and undeclared columns in other spellings of the same numbers, and one column
    that a single other value keeps text."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    padded = F.when(F.col("p_partkey") % 3 == 0, F.lpad(key, 12, "0"))
    mark = F.when(F.col("p_partkey") == 1, "n/a")
    old = i.raw_part.select(
        F.coalesce(padded, F.concat(key, F.lit(".0"))).alias("part"),
        F.concat(size, F.lit(".10")).alias("share"),
        size.alias("cost"),
        F.concat(size, F.lit("e3")).alias("weight"),
        F.coalesce(mark, F.concat(size, F.lit(".0"))).alias("mark"),
        "p_brand",
    )
    new = i.raw_part.filter(F.col("p_partkey") % 10 != 0).select(
        key.alias("part"),
        F.concat(size, F.lit(".1")).alias("share"),
        F.concat(size, F.lit(".004")).alias("cost"),
        F.concat(size, F.lit("000")).alias("weight"),
        F.coalesce(mark, size).alias("mark"),
        F.when(F.col("p_partkey") % 4 == 0, "other").otherwise(F.col("p_brand")).alias("p_brand"),
    )
    return reconcile.summary({"part": old}, {"part": new}, {"part": TableSpec("part", ("part",))})


@query
def rec_column_profile(i: Inputs) -> DataFrame:
    """Values, numbers and moments of each text column of both sides."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    old = i.orders_old.withColumn("o_orderdate", F.lit(None).cast("timestamp"))
    new = i.raw_orders.select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 9 == 0, "soon").otherwise(day).alias("o_orderdate"),
    )
    return profile.column_profile(old, new)


@query
def rec_type_drift(i: Inputs) -> DataFrame:
    """Cells that differ where columns changed their type between the snapshots."""
    key = F.col("o_orderkey")
    old = i.raw_orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    customer = F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    new = i.raw_orders.select(
        F.concat(F.lit("0"), key.cast("string")).alias("o_orderkey"),
        F.when(key % 50 == 0, "n/a").when(key % 70 == 0, "").otherwise(customer).alias("o_custkey"),
        F.when(key % 30 == 0, "7.25").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(key % 40 == 0, "1999-01-01").otherwise(day).alias("o_orderdate"),
        F.when(key % 60 == 0, None).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    return reconcile.cell_diff(old, new, ["o_orderkey"], ["o_totalprice"])


@query
def rec_bucket_diff(i: Inputs) -> DataFrame:
    """Differences of two published versions, from the buckets whose digests differ."""
    key = F.col("o_orderkey")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    old = i.raw_orders.select(*columns)
    changed = F.when(key % 997 == 0, F.col("o_totalprice") + 10).otherwise(F.col("o_totalprice"))
    kept = old.filter(key % 1499 != 0)
    added = old.filter(key % 1999 == 0).withColumn("o_orderkey", -key - 1)
    new = kept.unionByName(added).withColumn("o_totalprice", changed)
    specs = {"orders": ORDERS_SPEC}
    root = f"{staging.Stage(i.spark).root}/published"
    for tables in (old, new):
        staging.publish({"orders": tables}, root, specs=specs)
    newest, before = versions.versions(i.spark, root)[:2]
    return snapshot_diff.diff_versions(i.spark, root, specs, before, newest)


# --- history -----------------------------------------------------------------


@query
def hist_depots_per_customer(i: Inputs) -> DataFrame:
    served = history.depots_per_customer(i.shipments, i.locations, AS_OF, PARAMS.days_depots)
    return history.depots_by_model_id(served, i.customers, i.facilities)


def _load_sizes(i: Inputs) -> DataFrame:
    found = history.load_sizes(i.shipments, i.locations, AS_OF, PARAMS.days_load_size)
    return history.load_sizes_by_model_id(found, i.customers, i.facilities)


@query
def hist_load_size(i: Inputs) -> DataFrame:
    return _load_sizes(i)


@query
def hist_lane_loads(i: Inputs) -> DataFrame:
    return _lane_loads(i, 60)


@query
def hist_lane_costs(i: Inputs) -> DataFrame:
    costs = history.lane_costs(i.shipments, i.locations, i.carrier_types, AS_OF, 3)
    dates = [c for c in costs.columns if dict(costs.dtypes)[c].startswith("timestamp")]
    shown = {c: F.date_format(c, "yyyy-MM-dd") for c in dates}
    return costs.withColumns({**shown, "ttl_cost": F.round("ttl_cost", 4)})


@query
def hist_cost_per_load(i: Inputs) -> DataFrame:
    return _cost_per_load(i)


@query
def hist_incremental(i: Inputs) -> DataFrame:
    """Three windows from monthly states: all months stored, then the last ones anew."""
    root = f"{staging.Stage(i.spark).root}/states"
    known = F.date_sub(F.lit(AS_OF), 40)
    history_states.write_months(i.shipments.filter(F.col("date_to") < known), root)
    history_states.write_months(i.shipments, root, AS_OF - dt.timedelta(days=40))

    def window(days: int | None) -> DataFrame:
        return history_states.read_window(i.spark, root, AS_OF, days)

    served = history_states.depots_per_customer(window(PARAMS.days_depots), i.locations)
    found = history_states.load_sizes(window(PARAMS.days_load_size), i.locations)
    loads = history_states.lane_loads(window(60), i.locations, i.carrier_types)
    served = history.depots_by_model_id(served, i.customers, i.facilities)
    found = history.load_sizes_by_model_id(found, i.customers, i.facilities)
    n_loads = F.col("cpu_loads") + F.col("dedicated_loads") + F.col("other_loads")
    none = F.lit(None).cast("double").alias("size")
    parts = [
        served.select(F.lit("depots").alias("kind"), "movetype", F.col("model_id").alias("name"),
                      F.col("number_of_depots").alias("n"), none),
        found.select(F.lit("sizes"), "movetype", "customer_name", "load_count", "average_cube"),
        loads.select(F.lit("lanes"), "movetype", "lane_id", n_loads, none),
    ]
    return reduce(DataFrame.unionAll, parts)


def _lane_types(i: Inputs) -> DataFrame:
    return history.typed_lanes(
        i.shipments,
        i.locations,
        i.carrier_types,
        AS_OF,
        PARAMS.days_lane_loads,
        PARAMS.months_costs,
        PARAMS.min_line_haul,
        PARAMS.min_loads,
    )


@query
def hist_lane_type(i: Inputs) -> DataFrame:
    return _lane_types(i)


def _lane_history(
    i: Inputs, apart: bool = False, stage: staging.Stage | None = None
) -> DataFrame:
    return refresh.lane_history_by_model_id(
        i.shipments,
        i.locations,
        i.carrier_types,
        i.customers,
        i.facilities,
        AS_OF,
        PARAMS,
        stage,
        apart,
    )


@query
def hist_lane_model_ids(i: Inputs) -> DataFrame:
    return _lane_history(i)


# --- depots ------------------------------------------------------------------


@query
def dep_unit_cost(i: Inputs) -> DataFrame:
    updated = depots.fulfillment_unit_cost(i.customerfulfillmentpolicies, i.depot_assumptions)
    return updated.select("customername", "productname", "sourcename", "unitcost", "depottype")


@query
def dep_attributes(i: Inputs) -> DataFrame:
    return depots.facility_attributes(i.facilities, i.depot_assumptions)


@query
def dep_inventory_limits(i: Inputs) -> DataFrame:
    return depots.inventory_limits(i.inventoryconstraints, i.depot_assumptions, PARAMS)


@query
def dep_initial_inventory(i: Inputs) -> DataFrame:
    return depots.initial_inventory(i.inventorypolicies, i.depot_assumptions, PARAMS)


@query
def dep_repair_capacity(i: Inputs) -> DataFrame:
    updated = depots.repair_capacity(
        i.productionconstraints, i.depot_assumptions, i.periods, PARAMS
    )
    return updated.select("facilityname", "productname", "periodname", "notes", "constraintvalue")


@query
def dep_repair_cost(i: Inputs) -> DataFrame:
    return depots.repair_unit_cost(i.productionpolicies, i.depot_assumptions, PARAMS)


@query
def dep_handling_cost(i: Inputs) -> DataFrame:
    return depots.handling_cost(i.warehousingpolicies, i.depot_assumptions)


# --- flags and places --------------------------------------------------------

_ISSUE_KEYS = ["customername", "productname", "sourcename"]
_MOVE_KEYS = ["facilityname", "productname", "sourcename"]
_FLAGS = ["planflag", "plan_depot_id", "status", "notes"]


@query
def flg_assigned_lanes(i: Inputs) -> DataFrame:
    updated = flags.assigned_fulfillment_lanes(
        i.customerfulfillmentpolicies, i.depot_assignments
    )
    return updated.select(*_ISSUE_KEYS, *_FLAGS)


@query
def flg_assigned_returns(i: Inputs) -> DataFrame:
    updated = flags.assigned_return_lanes(i.replenishmentpolicies, i.depot_assignments)
    return updated.select(*_MOVE_KEYS, *_FLAGS)


@query
def flg_active_customers(i: Inputs) -> DataFrame:
    updated = flags.active_customers(i.customers, i.customerdemand)
    return updated.select("customername", "status", "inplan")


@query
def flg_active_returns(i: Inputs) -> DataFrame:
    updated = flags.active_returns(i.facilities, i.productionconstraints, PARAMS)
    return updated.select("facilityname", "status", "inplanmodel")


@query
def loc_customer_details(i: Inputs) -> DataFrame:
    updated = places.customer_details(i.customers, i.locations, i.customerdemand, PARAMS)
    return updated.select("customername", "corpcode", "corpname", "planquantity", "issueqty")


@query
def loc_return_details(i: Inputs) -> DataFrame:
    updated = places.return_details(
        i.facilities, i.locations, i.productionconstraints, PARAMS
    )
    return updated.select("facilityname", "corpcode", "corpname", "returnqty")


# --- lanes -------------------------------------------------------------------


def _served(i: Inputs) -> DataFrame:
    found = history.depots_per_customer(i.shipments, i.locations, AS_OF, PARAMS.days_depots)
    return history.depots_by_model_id(found, i.customers, i.facilities)


def _issue_lanes(i: Inputs) -> DataFrame:
    return lanes.fulfillment_attributes(
        i.customerfulfillmentpolicies,
        i.customers,
        i.facilities,
        i.customerdemand,
        _served(i),
        PARAMS,
    )


@query
def lane_attributes(i: Inputs) -> DataFrame:
    return _issue_lanes(i).select(*_ISSUE_KEYS, *lanes.FULFILLMENT_COLUMNS)


@query
def lane_add_to_model(i: Inputs) -> DataFrame:
    """The candidate rule over all fulfilment rows, with the customer's mean monthly demand."""
    monthly = places.horizon_totals(i.customerdemand, "customername", "quantity", PARAMS, mean=True)
    served = lk.lookup(
        i.customerfulfillmentpolicies,
        _served(i),
        {"customername": "model_id"},
        {"number_of_depots": "number_of_depots"},
    )
    served = lk.lookup(served, monthly, {"customername": "customername"}, {"amount": "amount"})
    rows = served.withColumns(
        {"miles": F.col("distance"), "monthly_avg": nulls.or_zero(F.col("amount"))}
    )
    verdict = F.when(lanes.add_to_model(PARAMS), "Y").otherwise("N")
    return rows.select(*_ISSUE_KEYS, verdict.alias("addtomodel"))


@query
def lane_closest_depot(i: Inputs) -> DataFrame:
    return _issue_lanes(i).select(*_ISSUE_KEYS, "closestdepot")


@query
def lane_replenishment(i: Inputs) -> DataFrame:
    updated = lanes.replenishment_attributes(
        i.replenishmentpolicies, i.facilities, i.productionconstraints, _served(i), PARAMS
    )
    return updated.select(*_MOVE_KEYS, *lanes.REPLENISHMENT_COLUMNS)


@query
def pen_new_pallet(i: Inputs) -> DataFrame:
    typed = depots.fulfillment_unit_cost(i.customerfulfillmentpolicies, i.depot_assumptions)
    updated = penalties.new_pallet_penalty(typed, i.renter_assumptions, PARAMS)
    return updated.select(*_ISSUE_KEYS, "depottype", "unitcost")


# --- rates and sizes ---------------------------------------------------------


def _rates(i: Inputs, stage: staging.Stage, apart: bool = False) -> DataFrame:
    lanes = _lane_history(i, apart, stage)
    if not apart:
        # Cut, so the lanes' shuffle files are gone when the policies move.
        lanes = stage.cut(lanes.select(*rates.HISTORY_COLUMNS), "lane_history")
        stage.forget("lane_sums")
    return rates.select_rates(i.transportationpolicies, lanes, i.rfq_rates, PARAMS)


@query
def rate_selection(i: Inputs) -> DataFrame:
    rated = _rates(i, staging.Stage(i.spark))
    return rated.drop("averageshipmentsize", "oloccode", "dloccode")


@query
def rate_flag_propagation(i: Inputs) -> DataFrame:
    # A flag needs the class of a lane and no cost.
    stage = staging.Stage(i.spark)
    flagged = _rates(i, stage, apart=True).select("originname", "destinationname", "cpu")
    transport = stage.cut(flagged, "flagged_lanes")
    stage.forget("lane_sums")
    issues = rates.fulfillment_carrier_flags(i.customerfulfillmentpolicies, transport)
    moves = rates.replenishment_carrier_flags(i.replenishmentpolicies, transport)
    return issues.select(
        F.lit("issue").alias("kind"),
        F.col("customername").alias("location"),
        "productname",
        F.col("sourcename").alias("depot"),
        "cpudedicated",
    ).unionByName(
        moves.select(
            F.lit("move").alias("kind"),
            F.col("sourcename").alias("location"),
            "productname",
            F.col("facilityname").alias("depot"),
            "cpudedicated",
        )
    )


@query
def size_customer(i: Inputs) -> DataFrame:
    updated = sizes.customer_sizes(i.customers, _load_sizes(i), PARAMS)
    return updated.select("customername", "avgloadsz")


@query
def size_facility(i: Inputs) -> DataFrame:
    updated = sizes.facility_sizes(i.facilities, _load_sizes(i), PARAMS)
    return updated.select("facilityname", "avgloadsz")


@query
def size_lane(i: Inputs) -> DataFrame:
    updated = sizes.lane_sizes(i.transportationpolicies, _load_sizes(i), PARAMS)
    return updated.select("originname", "destinationname", "productname", "averageshipmentsize")


# --- multi-source, transfers, preferences ------------------------------------


@query
def msrc_resolve(i: Inputs) -> DataFrame:
    return _resolved(i)


@query
def msrc_flag(i: Inputs) -> DataFrame:
    resolved = staging.Stage(i.spark).cut(_resolved(i), "resolved")
    issues = multisource.flag_fulfillment(i.customerfulfillmentpolicies, resolved)
    moves = multisource.flag_replenishment(i.replenishmentpolicies, resolved)
    parts = [
        issues.select(*[F.col(c).alias(n) for c, n in zip(_ISSUE_KEYS, "abc")], _MS),
        moves.select(*[F.col(c).alias(n) for c, n in zip(_MOVE_KEYS, "abc")], _MS),
    ]
    return reduce(DataFrame.unionByName, parts)


_MS = "multi_source_option"


@query
def xfer_matrix(i: Inputs) -> DataFrame:
    typed = depots.replenishment_depot_types(i.replenishmentpolicies, i.depot_assumptions)
    updated = transfers.transfer_matrix(typed)
    return updated.select(*_MOVE_KEYS, "odepottype", "ddepottype", "status")


@query
def pref_pairs(i: Inputs) -> DataFrame:
    updated = transfers.preferred_pairs(
        i.replenishmentpolicies, i.preferred_depots, i.facilities
    )
    return updated.select(*_MOVE_KEYS, "rentdistsortprefassig")


# --- the whole refresh -------------------------------------------------------


def _refresh(
    i: Inputs, only: tuple[str, ...], clean: dict[str, DataFrame] | None = None
) -> tuple[dict, dict]:
    """Old and new tables. The inputs are stored first, as a model database is.

    The views break some gate rules on purpose, so the gate is off unless
    ``clean`` gives the inputs that break any in a form that does not.
    """
    stage = staging.Stage(i.spark)
    i.store(stage, "lines")
    model, side = i.model(), {**i.side(), **(clean or {})}
    stored = stage.cut_all(
        {
            **{f"in_{n}": t for n, t in model.items() if n not in _UNUSED.get(only, ())},
            **{f"in_{n}": t for n, t in side.items()},
            "in_shipments": i.shipments,
            "in_locations": i.locations,
        }
    )
    stage.forget("view_lines")
    model = {n: stored.get(f"in_{n}", t) for n, t in model.items()}
    side = {n: stored[f"in_{n}"] for n in side}
    new = refresh.refresh(
        model,
        side,
        stored["in_shipments"],
        stored["in_locations"],
        AS_OF,
        PARAMS,
        stage,
        check_inputs=clean is not None,
        only=only,
        spent=("in_shipments",),
    )
    return {n: model[n] for n in only}, new


_SMALL = (
    "groups",
    "inventoryconstraints",
    "inventorypolicies",
    "productionpolicies",
    "warehousingpolicies",
)
_ISSUES = ("customerfulfillmentpolicies",)
_MOVES = ("replenishmentpolicies",)
_TRANSPORT = ("transportationpolicies",)
_UNUSED = {
    _ISSUES: (*_SMALL, *_MOVES),
    _MOVES: (*_SMALL, *_ISSUES),
    _TRANSPORT: (*_SMALL, *_ISSUES, *_MOVES),
}


@query
def refresh_fulfillment(i: Inputs) -> DataFrame:
    return _refresh(i, _ISSUES)[1][_ISSUES[0]]


@query
def refresh_replenishment(i: Inputs) -> DataFrame:
    return _refresh(i, _MOVES)[1][_MOVES[0]]


@query
def refresh_transportation(i: Inputs) -> DataFrame:
    return _refresh(i, _TRANSPORT)[1][_TRANSPORT[0]]


@query
def refresh_reconciled(i: Inputs) -> DataFrame:
    """Refresh all tables, then reconcile old against new over all of them."""
    old, new = _refresh(i, refresh.PUBLISHED)
    return reconcile.summary(old, new, MODEL_TABLES, stored=("old",))


@query
def refresh_gated(i: Inputs) -> DataFrame:
    """The whole run: the gate passes the inputs, all tables are refreshed and reconciled."""
    filled = i.depot_assumptions.fillna({"type": "Sort Only", "closed": "N"})
    old, new = _refresh(i, refresh.PUBLISHED, {"depot_assumptions": filled})
    return reconcile.summary(old, new, MODEL_TABLES, stored=("old",))


@query
def refresh_published(i: Inputs) -> DataFrame:
    """Publish the old tables and the refreshed ones, read both back, and reconcile them."""
    root = f"{staging.Stage(i.spark).root}/published"
    for tables in _refresh(i, refresh.PUBLISHED):
        staging.publish(tables, root)
    old, new = (staging.read_published(i.spark, root, back=back) for back in (1, 0))
    return reconcile.summary(old, new, MODEL_TABLES, stored=("old", "new"))

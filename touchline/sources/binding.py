"""Binding of the driver's TPC-H-like tables to the silver marketing feeds.

The reference lands eight CSV feeds; the driver ships TPC-H-shaped parquet
instead.  These projections give every silver feed the schema the gold layer
expects, with expressions that mean the same in Spark and in the DuckDB
oracle (see ``plans/oracle.py``):

=====================  =========================================================
silver feed            derived from
=====================  =========================================================
crm_channels           nation ⋈ region            (channel_name, category)
mrkt_campaigns         supplier ⋈ nation          (one campaign per supplier)
crm_user_acquisitions  customer ⋈ nation
crm_purchases          orders (returns: o_orderkey % 20 = 0, NULL revenue: % 50 = 7)
web_touchpoints        lineitem ⋈ orders ⋈ supplier ⋈ nation, DISTINCT
mrkt_clicks            same join, l_returnflag = 'R'
mrkt_ad_spend          lineitem ⋈ supplier ⋈ nation
web_sessions           events
=====================  =========================================================

Only ``nation`` and ``region`` (fixed 25 / 5 rows) are broadcast explicitly;
every other join is left to the planner, whose automatic broadcast is bounded
by ``spark.sql.autoBroadcastJoinThreshold`` on measured sizes (AQE) and falls
back to a shuffle join beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import scalar
from .driver import DriverTables

# Fixed values of the binding (must equal plans/oracle.py).
EPOCH = "1995-01-01"
OBJECTIVES = ("Awareness", "Traffic", "Conversion")      # by s_suppkey % 3
DEVICES = ("Mobile", "Desktop", "Tablet")                # by event_id % 3
INTERACTIONS = {"R": "Click", "A": "Impression"}         # else View
CAMPAIGN_DAYS = 180


def _epoch_plus(days_col):
    return F.date_add(F.lit(EPOCH).cast("date"), days_col.cast("int"))


def _pick(key_col, values):
    out = None
    for i, v in enumerate(values):
        out = (F.when(key_col == i, v) if out is None else out.when(key_col == i, v))
    return out


def _nations(t: DriverTables) -> DataFrame:
    # 25 rows, fixed by the TPC-H schema: safe to broadcast at any scale.
    return F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))


def crm_channels(t: DriverTables) -> DataFrame:
    region = F.broadcast(t.region.select("r_regionkey", "r_name"))
    return (t.nation.join(region, t.nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_name").alias("channel_name"), F.col("r_name").alias("category")))


def mrkt_campaigns(t: DriverTables) -> DataFrame:
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    n = _nations(t)
    start = _epoch_plus(F.col("s_suppkey") % 365)
    return (s.join(n, s.s_nationkey == n.n_nationkey)
            .select(F.col("s_suppkey").alias("campaign_id"),
                    F.col("s_name").alias("campaign_name"),
                    F.col("n_name").alias("channel"),
                    start.alias("start_date"),
                    F.date_add(start, CAMPAIGN_DAYS).alias("end_date"),
                    _pick(F.col("s_suppkey") % 3, OBJECTIVES).alias("objective")))


def crm_user_acquisitions(t: DriverTables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_nationkey")
    n = _nations(t)
    # number of campaigns: a scalar subquery (computed once, no join)
    nsupp = scalar(t.supplier, F.count(F.lit(1)))
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("c_custkey").alias("user_id"),
                    _epoch_plus(F.col("c_custkey") % 365).alias("acquisition_date"),
                    F.col("n_name").alias("acquisition_channel"),
                    (F.col("c_custkey") % nsupp + 1).alias("acquisition_campaign")))


def crm_purchases(t: DriverTables) -> DataFrame:
    o = t.orders
    price = F.col("o_totalprice").cast("decimal(12,2)")
    revenue = (F.when(F.col("o_orderkey") % 50 == 7, F.lit(None).cast("decimal(12,2)"))
               .when(F.col("o_orderkey") % 20 == 0, -price)
               .otherwise(price))
    return o.select(F.col("o_orderkey").alias("purchase_id"),
                    F.col("o_custkey").alias("user_id"),
                    F.to_date("o_orderdate").alias("purchase_date"),
                    revenue.cast("decimal(12,2)").alias("revenue"),
                    F.col("o_orderpriority").alias("channel_last_touch"))


def _line_supplier(t: DriverTables, cols) -> DataFrame:
    li = t.lineitem.select(*cols)
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = _nations(t)
    return (li.join(s, li.l_suppkey == s.s_suppkey)
            .join(n, s.s_nationkey == n.n_nationkey))


def _interaction(flag):
    return (F.when(flag == "R", INTERACTIONS["R"])
            .when(flag == "A", INTERACTIONS["A"]).otherwise("View"))


def web_touchpoints(t: DriverTables) -> DataFrame:
    ls = _line_supplier(t, ["l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate"])
    o = t.orders.select("o_orderkey", "o_custkey")
    return (ls.join(o, ls.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"),
                    F.col("l_shipdate").alias("touchpoint_time"),
                    F.col("n_name").alias("channel"),
                    F.when(F.col("l_linenumber") == 7, F.lit(None).cast("long"))
                     .otherwise(F.col("l_suppkey")).alias("campaign_id"),
                    _interaction(F.col("l_returnflag")).alias("interaction_type"))
            .distinct())


def mrkt_clicks(t: DriverTables) -> DataFrame:
    ls = _line_supplier(t, ["l_orderkey", "l_suppkey", "l_returnflag", "l_shipdate"])
    ls = ls.filter(F.col("l_returnflag") == "R")
    o = t.orders.select("o_orderkey", "o_custkey")
    return (ls.join(o, ls.l_orderkey == o.o_orderkey)
            .select(F.col("l_orderkey").alias("click_id"),
                    F.col("o_custkey").alias("user_id"),
                    F.col("n_name").alias("channel"),
                    F.col("l_suppkey").alias("campaign_id"),
                    F.col("l_shipdate").alias("click_timestamp")))


def mrkt_ad_spend(t: DriverTables) -> DataFrame:
    ls = _line_supplier(t, ["l_suppkey", "l_linenumber", "l_extendedprice", "l_discount", "l_shipdate"])
    spend = (F.col("l_extendedprice").cast("decimal(12,2)")
             * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(12,2)")
    return ls.select(F.to_date("l_shipdate").alias("spend_date"),
                     F.col("n_name").alias("channel"),
                     F.when(F.col("l_linenumber") == 7, F.lit(None).cast("long"))
                      .otherwise(F.col("l_suppkey")).alias("campaign_id"),
                     spend.alias("spend"))


def web_sessions(t: DriverTables) -> DataFrame:
    e = t.events
    return e.select(F.col("event_id").alias("session_id"),
                    F.col("user_id"),
                    F.col("ts").alias("session_start"),
                    _pick(F.col("event_id") % 3, DEVICES).alias("device"),
                    F.col("event_type").alias("source_channel"),
                    (F.floor("value") % 15 + 1).cast("int").alias("pages_viewed"))


SILVER_FEEDS = {
    "crm_channels": crm_channels,
    "mrkt_campaigns": mrkt_campaigns,
    "crm_user_acquisitions": crm_user_acquisitions,
    "crm_purchases": crm_purchases,
    "web_touchpoints": web_touchpoints,
    "mrkt_clicks": mrkt_clicks,
    "mrkt_ad_spend": mrkt_ad_spend,
    "web_sessions": web_sessions,
}


def silver_from_driver(t: DriverTables) -> dict[str, DataFrame]:
    return {name: fn(t) for name, fn in SILVER_FEEDS.items()}

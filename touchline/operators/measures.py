"""Exploration and headline measures (EXP-01 … EXP-05, MEA-01 … MEA-08,
KPI-ALL).

Whole-period measures are one aggregate per source table; the one-row
results are combined as scalar subqueries (run once each, merged by
Catalyst when they read the same source; no join).
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import RATIO_SCALE, int_avg, month_index, one_row, safe_div


def _one_row(*dfs: DataFrame) -> DataFrame:
    return one_row(*dfs)


def overall_kpis(g) -> DataFrame:
    """KPI-ALL: whole-period ROAS, CAC, CPA, CPC, CTR, CVR, AOV, ARPU, ROI."""
    p = g.fact_purchases.agg(F.sum("revenue").alias("rev"), F.count("user_id").alias("p_users"),
                             F.count("purchase_id").alias("p_orders"),
                             F.countDistinct("purchase_id").alias("orders_distinct"))
    s = g.fact_spend.agg(F.sum("spend").alias("spend"))
    k = g.fact_clicks.agg(F.count("click_id").alias("clicks"))
    i = (g.fact_touchpoints.filter(F.col("interaction_type") == "Impression")
         .agg(F.count("interaction_type").alias("impressions")))
    lin = g.fact_attribution_linear.agg(F.sum("revenue_share").alias("lin_rev"),
                                        F.countDistinct("purchase_id").alias("lin_orders"),
                                        F.countDistinct("user_id").alias("lin_users"))
    r = lambda n, d: F.round(safe_div(n, d), RATIO_SCALE)
    return _one_row(p, s, k, i, lin).select(
        F.col("rev").alias("revenue"), "spend", r("rev", "spend").alias("roas"),
        F.col("p_users").alias("new_users"), r("spend", "p_users").alias("cac"),
        F.col("p_orders").alias("conversions"), r("spend", "p_orders").alias("cpa"),
        "clicks", r("spend", "clicks").alias("cpc"),
        "impressions", r("clicks", "impressions").alias("ctr"),
        "orders_distinct", r("orders_distinct", "clicks").alias("cvr"),
        F.col("lin_rev").alias("attributed_revenue"), "lin_orders", r("lin_rev", "lin_orders").alias("aov"),
        "lin_users", r("lin_rev", "lin_users").alias("arpu"),
        F.round(safe_div(F.col("rev") - F.col("spend"), F.col("spend")), RATIO_SCALE).alias("roi"))


# --- exploration ------------------------------------------------------------------

def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """EXP-01: tables of a catalog database as a DataFrame."""
    rows = [(t.catalog, t.namespace[0] if t.namespace else None, t.name, t.tableType)
            for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table_catalog string, table_schema string, table_name string, table_type string")


def list_columns(df: DataFrame, table: str) -> DataFrame:
    """EXP-02: columns of a table (name, position, type, nullable)."""
    spark = df.sparkSession
    rows = [(table, f.name, i + 1, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, column_name string, ordinal_position int, "
                                       "data_type string, is_nullable boolean")


def distinct_combinations(df: DataFrame, cols: list[str]) -> DataFrame:
    """EXP-03."""
    return df.select(*cols).distinct().orderBy(*cols)


def first_distinct(df: DataFrame, col: str, n: int = 30) -> DataFrame:
    """EXP-04: ``SELECT DISTINCT TOP n col ORDER BY col`` (a top-n report)."""
    return df.select(col).distinct().orderBy(F.col(col).asc_nulls_first()).limit(n)


def date_range(df: DataFrame, col: str, label: str) -> DataFrame:
    """EXP-05: first / last date and the inclusive span in months."""
    return df.agg(F.lit(label).alias("source"), F.min(col).cast("date").alias("first_date"),
                  F.max(col).cast("date").alias("last_date"),
                  (month_index(F.max(col)) - month_index(F.min(col)) + 1).alias("range_months"))


# --- headline measures ------------------------------------------------------------

def measures_report(g) -> DataFrame:
    """MEA-08: the KPI report — named measures in one long table
    (measure_name, measure_value double).  One aggregate per source table
    (8 scans instead of one per measure), then an unpivot via ``stack``."""
    g = g.sharing("web_touchpoints")
    spend = g.fact_spend.agg(F.sum("spend").alias("total_spend"), F.avg("spend").alias("avg_spend"))
    clicks = g.fact_clicks.agg(
        F.count(F.lit(1)).alias("total_clicks"),
        (F.count(F.lit(1)) / (F.datediff(F.max(F.to_date("click_timestamp")),
                                         F.min(F.to_date("click_timestamp"))) + 1)).alias("avg_clicks_per_day"))
    sessions = g.fact_sessions.agg(F.count(F.lit(1)).alias("total_sessions"),
                                   F.countDistinct("user_id").alias("session_users"))
    touches = g.fact_touchpoints.agg(F.count(F.lit(1)).alias("total_touchpoints"),
                                     F.countDistinct("user_id").alias("touchpoint_users"))
    purchases = g.fact_purchases.agg(F.count(F.lit(1)).alias("total_purchases"),
                                     F.countDistinct("user_id").alias("purchasing_users"),
                                     F.sum("revenue").alias("total_revenue"))
    per_user = g.fact_purchases.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    customers = per_user.agg(F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("one_time_customers"),
                             F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("multi_time_customers"))
    path = g.fact_touchpath.agg(F.count(F.lit(1)).alias("contributing_touchpoints"),
                                int_avg("touchpoint_number").alias("avg_funnel_position"))
    lin = g.fact_attribution_linear
    lin_a = lin.agg(F.count(F.lit(1)).alias("attributed_touchpoints"),
                    F.countDistinct("user_id").alias("users_in_model"),
                    F.avg("revenue_share").alias("avg_revenue_share"))
    lin_p = (lin.select("purchase_id", "touchpoints_in_path", "total_revenue").distinct()
             .agg(int_avg("touchpoints_in_path").alias("avg_path_length"),
                  F.avg("total_revenue").alias("avg_revenue_per_purchase")))
    last = g.fact_attribution_last_touch.agg(F.avg("revenue").alias("avg_last_touch_revenue"),
                                             int_avg("touchpoint_number").alias("avg_last_touch_path_length"))
    wide = _one_row(spend, clicks, sessions, touches, purchases, customers, path, lin_a, lin_p, last)
    names = ["total_spend", "avg_spend", "total_clicks", "avg_clicks_per_day", "total_sessions", "session_users",
             "total_touchpoints", "touchpoint_users", "total_purchases", "purchasing_users", "total_revenue",
             "one_time_customers", "multi_time_customers", "contributing_touchpoints", "avg_funnel_position",
             "attributed_touchpoints", "avg_path_length", "users_in_model", "avg_revenue_share",
             "avg_revenue_per_purchase", "avg_last_touch_revenue", "avg_last_touch_path_length"]
    stack = "stack({}, {}) as (measure_name, measure_value)".format(
        len(names), ", ".join(f"'{n}', round(cast({n} as double), {RATIO_SCALE})" for n in names))
    return wide.selectExpr(stack)

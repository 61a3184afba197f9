"""Silver feed specs (CLN-15) and the silver load job.

One declarative spec per feed: output column → cleaner over the bronze
columns.  ``to_silver`` turns a spec into a single ``select`` (plus the
reference's DISTINCT where it has one), so each feed is one narrow stage
(plus one shuffle for the distinct feeds).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean as C
from .bronze import layer_path, run_layer, scan_delimited, BRONZE_FEEDS

#: The largest campaign id of the reference's own feed: pass it to cap ids as there.
COMPAT_MAX_CAMPAIGN = 53


def specs(max_campaign=None, date_years=None, force_year: str | None = None
          ) -> dict[str, tuple[str, dict[str, Callable[[], Column]], bool]]:
    """feed → (bronze table, {silver column: cleaner}, distinct).
    ``max_campaign`` (a number or a Column) bounds campaign ids; None does not."""
    return {
        "mrkt_ad_spend": ("mrkt_raw_ad_spend", {
            "spend_date": lambda: C.parse_mixed_date("date", "not_available", date_years),
            "channel": lambda: C.canonical_channel("channel"),
            "campaign_id": lambda: C.bounded_id("campaign_id", max_campaign),
            "spend": lambda: C.parse_money("spend"),
        }, True),
        "mrkt_campaigns": ("mrkt_raw_campaigns", {
            "campaign_id": lambda: C.parse_int("campaign_id"),
            "campaign_name": lambda: C.campaign_name_rules(),
            "channel": lambda: C.canonical_channel("channel"),
            "start_date": lambda: C.parse_mixed_date("start_date", "not_available", date_years),
            "end_date": lambda: C.parse_mixed_date("end_date", "not_available", date_years),
            "objective": lambda: C.objective("objective"),
        }, False),
        "mrkt_clicks": ("mrkt_raw_clicks", {
            "click_id": lambda: C.parse_int("click_id"),
            "user_id": lambda: C.decimal_id("user_id"),
            "channel": lambda: C.blank_channel("channel"),
            "campaign_id": lambda: C.bounded_id("campaign_id", max_campaign),
            "click_timestamp": lambda: C.parse_mixed_timestamp("timestamp", ("invalid_date",), whole_seconds=True),
        }, False),
        "web_sessions": ("web_raw_sessions", {
            "session_id": lambda: C.parse_int("session_id"),
            "user_id": lambda: C.decimal_id("user_id"),
            "session_start": lambda: C.parse_mixed_timestamp("session_start", ("not_a_date",), whole_seconds=True),
            "device": lambda: C.bucket("device", C.DEVICE_BUCKETS),
            "source_channel": lambda: C.canonical_channel("source_channel"),
            "pages_viewed": lambda: C.sentinel_int("pages_viewed"),
        }, False),
        "web_touchpoints": ("web_raw_touchpoints", {
            "user_id": lambda: C.decimal_id("user_id"),
            "touchpoint_time": lambda: C.parse_mixed_timestamp("touchpoint_time", ("invalid",)),
            "channel": lambda: C.blank_channel("channel"),
            "campaign_id": lambda: C.bounded_id("campaign_id", max_campaign),
            "interaction_type": lambda: C.bucket("interaction_type", C.INTERACTION_BUCKETS),
        }, True),
        "crm_channels": ("crm_raw_channels", {
            "channel_name": lambda: F.col("channel_name"),
            "category": lambda: F.col("category"),
        }, False),
        "crm_purchases": ("crm_raw_purchases", {
            "purchase_id": lambda: C.parse_int("purchase_id"),
            "user_id": lambda: C.decimal_id("user_id"),
            "purchase_date": lambda: C.parse_mixed_date("purchase_date", "invalid", date_years),
            "revenue": lambda: C.parse_decimal("revenue"),
            "channel_last_touch": lambda: C.canonical_channel(C.after_first_comma("channel_last_touch")),
        }, False),
        "crm_user_acquisitions": ("crm_raw_user_acquisitions", {
            "user_id": lambda: C.parse_int("user_id"),
            "acquisition_date": lambda: C.parse_mixed_date("acquisition_date", "invalid", date_years, force_year),
            "acquisition_channel": lambda: C.canonical_channel("acquisition_channel"),
            "acquisition_campaign": lambda: C.bounded_id("acquisition_campaign", max_campaign),
        }, False),
    }


def to_silver(bronze: DataFrame, spec: dict[str, Callable[[], Column]], distinct: bool,
              audit: bool = True) -> DataFrame:
    """CLN-15: one projection; DISTINCT after cleaning (CLN-13); audit column
    (CLN-14) added after the distinct so it never defeats it."""
    out = bronze.select(*[fn().alias(name) for name, fn in spec.items()])
    if distinct:
        out = out.distinct()
    return out.withColumn("dwh_create_date", F.current_timestamp()) if audit else out


def load_silver(spark: SparkSession, root: str, **spec_kw) -> DataFrame:
    """Silver job: bronze parquet → cleaned silver parquet, with audit rows.
    Unless given, the bound of campaign ids is the largest id of the campaign
    feed (a scalar subquery)."""
    if "max_campaign" not in spec_kw:
        campaigns = spark.read.parquet(layer_path(root, "bronze", "mrkt_raw_campaigns"))
        spec_kw["max_campaign"] = campaigns.agg(F.max(C.parse_int("campaign_id"))).scalar()
    jobs = {}
    for feed, (bronze_table, spec, distinct) in specs(**spec_kw).items():
        jobs[feed] = (lambda b=bronze_table, s=spec, d=distinct:
                      to_silver(spark.read.parquet(layer_path(root, "bronze", b)), s, d))
    return run_layer(spark, "silver", jobs, root)


def silver_from_text(spark: SparkSession, path: str, feed: str, **spec_kw) -> DataFrame:
    """Bronze text scan + silver cleaning in one plan (no bronze table)."""
    bronze_table, spec, distinct = specs(**spec_kw)[feed]
    return to_silver(scan_delimited(spark, path, BRONZE_FEEDS[bronze_table]), spec, distinct, audit=False)

"""Gold facts (FCT-01 … FCT-06).

Each fact is the silver feed enriched by lookups.  The calendar is a bounded
table (one row per day of the configured range), so it is broadcast; the
per-user acquisition lookup grows with the user base and is left to the
planner (broadcast only under the measured size threshold, otherwise a
shuffle join that AQE splits when one user is hot).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_acquisition(acq: DataFrame, user: str = "user_id", date: str = "acquisition_date",
                      cols=("acquisition_channel", "acquisition_date", "acquisition_campaign")) -> DataFrame:
    """FCT-01: the earliest acquisition row per user (NULL dates first, then
    channel, then campaign as tie-breakers).

    ``min`` over a struct is an ordinary aggregate: it is combined map-side,
    so a user with millions of rows never lands whole in one task."""
    order = [date] + [c for c in ("acquisition_channel", "acquisition_campaign") if c != date]
    rest = [c for c in cols if c not in order]
    best = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_first")
    return (acq.filter(F.col(user).isNotNull()).groupBy(user).agg(best)
            .select(user, *[F.col(f"_first.{c}").alias(c) for c in cols]))


def _calendar(dim_date: DataFrame, on_col, prefix: str = "d") -> tuple[DataFrame, object]:
    d = F.broadcast(dim_date.select(F.col("full_date").alias(f"_{prefix}_date"),
                                    F.col("date_key").alias(f"_{prefix}_key")))
    return d, (on_col == F.col(f"_{prefix}_date"))


def fact_spend(spend: DataFrame, dim_date: DataFrame, campaigns: DataFrame) -> DataFrame:
    """FCT-02: spend + date key + campaign attributes; date, spend and a
    calendar match are required."""
    d, cond = _calendar(dim_date, F.col("spend_date"))
    c = campaigns.select(F.col("campaign_id").alias("_c_id"), F.col("campaign_name").alias("_c_name"),
                         F.col("objective").alias("_c_obj"))
    return (spend.filter(F.col("spend_date").isNotNull() & F.col("spend").isNotNull())
            .join(d, cond, "inner")
            .join(c, F.col("campaign_id") == F.col("_c_id"), "left")
            .select("spend_date", F.col("_d_key").alias("date_key"), "channel",
                    F.col("_c_name").alias("campaign_name"), F.col("_c_id").alias("campaign_id"),
                    F.col("_c_obj").alias("objective"), "spend"))


def fact_clicks(clicks: DataFrame, dim_date: DataFrame, first_acq: DataFrame) -> DataFrame:
    """FCT-03."""
    d, cond = _calendar(dim_date, F.to_date("click_timestamp"))
    a = first_acq.select(F.col("user_id").alias("_a_user"), "acquisition_channel")
    return (clicks.filter(F.col("click_timestamp").isNotNull() & F.col("channel").isNotNull()
                          & F.col("campaign_id").isNotNull() & F.col("user_id").isNotNull())
            .join(d, cond, "left")
            .join(a, F.col("user_id") == F.col("_a_user"), "left")
            .select("click_id", "click_timestamp", F.col("_d_key").alias("date_key"), "user_id",
                    F.col("channel").alias("click_channel"), "campaign_id", "acquisition_channel"))


def fact_sessions(sessions: DataFrame, dim_date: DataFrame, first_acq: DataFrame) -> DataFrame:
    """FCT-04."""
    d, cond = _calendar(dim_date, F.to_date("session_start"))
    a = first_acq.select(F.col("user_id").alias("_a_user"), "acquisition_channel")
    return (sessions.filter(F.col("session_start").isNotNull() & F.col("user_id").isNotNull()
                            & F.col("pages_viewed").isNotNull() & F.col("source_channel").isNotNull()
                            & F.col("device").isNotNull())
            .join(a, F.col("user_id") == F.col("_a_user"), "left")
            .join(d, cond, "left")
            .select("session_id", "user_id", F.col("device").alias("device_category"),
                    "source_channel", "acquisition_channel", F.col("_d_key").alias("date_key"),
                    F.to_date("session_start").alias("session_date"), "session_start", "pages_viewed"))


def fact_touchpoints(touches: DataFrame, dim_date: DataFrame, campaigns: DataFrame) -> DataFrame:
    """FCT-05."""
    d, cond = _calendar(dim_date, F.to_date("touchpoint_time"))
    c = campaigns.select(F.col("campaign_id").alias("_c_id"), F.col("campaign_name"))
    return (touches.filter(F.col("user_id").isNotNull() & F.col("touchpoint_time").isNotNull()
                           & F.col("interaction_type").isNotNull() & F.col("channel").isNotNull())
            .join(d, cond, "left")
            .join(c, F.col("campaign_id") == F.col("_c_id"), "left")
            .select("user_id", F.to_date("touchpoint_time").alias("tp_date"), "touchpoint_time",
                    F.col("_d_key").alias("date_key"), "channel", "campaign_id", "campaign_name",
                    "interaction_type"))


def fact_purchases(purchases: DataFrame, dim_date: DataFrame, first_acq: DataFrame) -> DataFrame:
    """FCT-06."""
    d, cond = _calendar(dim_date, F.col("purchase_date"))
    a = first_acq.select(F.col("user_id").alias("_a_user"), "acquisition_channel",
                         "acquisition_date", "acquisition_campaign")
    return (purchases.filter(F.col("user_id").isNotNull() & F.col("purchase_date").isNotNull())
            .join(d, cond, "left")
            .join(a, F.col("user_id") == F.col("_a_user"), "left")
            .select("purchase_id", "user_id", "purchase_date", F.col("_d_key").alias("date_key"),
                    "revenue", "channel_last_touch", "acquisition_channel", "acquisition_date",
                    "acquisition_campaign"))

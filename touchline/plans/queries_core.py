"""Registered queries: dimensions, facts, journeys and attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dims
from ..operators.attribution import rank_by_range
from .gold import FACT_KEYS, SURROGATE_KEYS
from .registry import add

# --- dimensions (DIM-01 … DIM-04) ---------------------------------------------
add("dim_01_calendar", lambda g: g.dim_date,
    "SELECT * FROM dim_date")
add("dim_02_users", lambda g: g.dim_user,
    "SELECT user_id FROM dim_user")
add("dim_03_campaigns", lambda g: g.dim_campaign,
    "SELECT * FROM dim_campaign")
add("dim_04_channels", lambda g: g.dim_channel,
    "SELECT * FROM dim_channel")
for _dim, (_key, _order) in SURROGATE_KEYS.items():
    add(f"dim_05_{_key}", lambda g, d=_dim, k=_key, o=_order: dims.with_dense_key(g.table(d), k, o),
        f"SELECT ROW_NUMBER() OVER (ORDER BY {', '.join(_order)}) AS {_key}, * FROM {_dim}")

# --- facts (FCT-01 … FCT-06) -----------------------------------------------------
add("fct_01_first_acquisition", lambda g: g.first_acquisition,
    "SELECT user_id, acquisition_channel, acquisition_date, acquisition_campaign FROM first_acq")
add("fct_02_fact_spend", lambda g: g.fact_spend, "SELECT * FROM fact_spend")
add("fct_03_fact_clicks", lambda g: g.fact_clicks, "SELECT * FROM fact_clicks")
add("fct_04_fact_sessions", lambda g: g.fact_sessions, "SELECT * FROM fact_sessions")
add("fct_05_fact_touchpoints", lambda g: g.fact_touchpoints, "SELECT * FROM fact_touchpoints")
add("fct_06_fact_purchases", lambda g: g.fact_purchases, "SELECT * FROM fact_purchases")

# every fact's dense key over its whole order; rows that tie are equal
for _fact, (_key, _order) in FACT_KEYS.items():
    add(f"dim_05_{_fact}", lambda g, f=_fact: g.keyed_fact(f),
        f"SELECT ROW_NUMBER() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in _order)}) AS {_key}, * FROM {_fact}")


def _key_report(g):
    """Each fact numbered as produced: keys run from 1 to the row count, each once.

    Only the keys are staged.  Distinct keys are counted by bitmaps of 64 neighbours, which a task
    fills before anything moves."""
    g = g.sharing("web_touchpoints")

    def keys(f: str, k: str):
        blocks = (dims.with_dense_key(g.table(f), k, carry=[]).groupBy(F.shiftright(k, 6).alias("_block"))
                  .agg(F.count(F.lit(1)).alias("_n"), F.min(k).alias("_lo"), F.max(k).alias("_hi"),
                       F.expr(f"bit_or(shiftleft(1L, cast({k} & 63 as int)))").alias("_bits")))
        return blocks.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.min("_lo").alias("first_key"), F.max("_hi").alias("last_key"),
                          F.coalesce(F.sum(F.expr("cast(bit_count(_bits) as long)")), F.lit(0)).alias("n_keys"))

    parts = [keys(f, k).select(F.lit(f).alias("table_name"), "n_rows", "first_key", "last_key", "n_keys") for f, (k, _) in FACT_KEYS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


add("dim_05_keys_as_produced", _key_report, " UNION ALL ".join(
    f"SELECT '{f}' AS table_name, COUNT(*) AS n_rows, CASE WHEN COUNT(*) > 0 THEN 1 END AS first_key, NULLIF(COUNT(*), 0) AS last_key, COUNT(*) AS n_keys FROM {f}"
    for f in FACT_KEYS))

# --- journeys and attribution (ATT-01 … ATT-07) ----------------------------------
add("att_02_touch_numbers",
    lambda g: rank_by_range(g.silver["web_touchpoints"])[0].select("user_id", "touchpoint_time", "channel", "campaign_id", "interaction_type",
                                                                   "touchpoint_number", F.col("_rank_kept").alias("number_kept")),
    """SELECT user_id, touchpoint_time, channel, campaign_id, interaction_type, touchpoint_number,
              CAST(SUM(CASE WHEN channel IS NOT NULL AND interaction_type IS NOT NULL THEN 1 ELSE 0 END) OVER (
                PARTITION BY user_id ORDER BY touchpoint_number ROWS UNBOUNDED PRECEDING) AS INTEGER) AS number_kept
       FROM numbered_touches""")
add("att_03_fact_touchpath", lambda g: g.fact_touchpath, "SELECT * FROM fact_touchpath")
add("att_04_path_length", lambda g: g.path_lengths,
    "SELECT purchase_id, CAST(count(*) AS INTEGER) AS touchpoints_in_path FROM fact_touchpath GROUP BY purchase_id")
add("att_05_fact_attribution_linear", lambda g: g.fact_attribution_linear,
    "SELECT * FROM fact_attribution_linear")
add("att_06_fact_attribution_last_touch", lambda g: g.fact_attribution_last_touch,
    "SELECT * FROM fact_attribution_last_touch")
add("att_07_first_touch_acquisition", lambda g: g.fact_user_acquisition,
    "SELECT * FROM fact_user_acquisition")


def _mag_9_1(g):
    return (g.fact_attribution_linear.groupBy("channel")
            .agg(F.sum("revenue_share").alias("total_revenue"))
            .orderBy(F.desc("total_revenue")))


# Flagship: attributed revenue by channel.
add("mag_9_1_linear_revenue_by_channel", _mag_9_1,
    """SELECT channel, SUM(revenue_share) AS total_revenue
       FROM fact_attribution_linear GROUP BY channel ORDER BY total_revenue DESC""")

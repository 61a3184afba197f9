"""Registered queries: silver cleaning of dirty feeds (CLN-15), profiling
(PRF-*) and the data-quality suite (DQ-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions.stats import scalar
from ..operators import profile as prf
from ..operators import quality as dq
from ..sources import dirty
from ..sources.feeds import specs, to_silver
from .registry import add

_CHAN_CASE = "CASE l_suppkey % 9 " + " ".join(
    f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(dirty.DIRTY_CHANNELS_CLEAN)) + " END"
_RAW_CASE = "CASE l_suppkey % 9 " + " ".join(
    f"WHEN {i} THEN {'NULL' if v == '' else repr(v)}" for i, v in enumerate(dirty.DIRTY_CHANNELS)) + " END"


def _max_campaign(g):
    # the largest valid campaign id = number of campaigns (scalar subquery)
    return scalar(g.driver.supplier, F.count(F.lit(1)))


def _clean_spend(g):
    raw = dirty.dirty_ad_spend(g.driver.lineitem)
    _, spec, distinct = specs(max_campaign=_max_campaign(g))["mrkt_ad_spend"]
    return to_silver(raw, spec, distinct, audit=False)


def _clean_touchpoints(g):
    raw = dirty.dirty_touchpoints(g.driver.lineitem)
    _, spec, distinct = specs(max_campaign=_max_campaign(g))["web_touchpoints"]
    return to_silver(raw, spec, distinct, audit=False)


# --- CLN-15: bronze text → silver -------------------------------------------------------
add("cln_15_silver_from_dirty_feed", _clean_spend, f"""
SELECT DISTINCT CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS spend_date,
       {_CHAN_CASE} AS channel,
       CASE WHEN l_linenumber = 7 OR l_suppkey = 0 OR l_suppkey > (SELECT COUNT(*) FROM supplier) THEN NULL
            ELSE l_suppkey END AS campaign_id,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS spend
FROM lineitem""")
add("cln_15_touchpoints_from_dirty_feed", _clean_touchpoints, f"""
SELECT DISTINCT l_orderkey AS user_id,
       CASE WHEN l_partkey % 50 = 1 THEN NULL ELSE l_shipdate END AS touchpoint_time,
       {_RAW_CASE} AS channel,
       CASE WHEN l_suppkey = 0 OR l_suppkey > (SELECT COUNT(*) FROM supplier) THEN NULL ELSE l_suppkey END AS campaign_id,
       CASE WHEN l_returnflag = 'R' THEN 'Click' WHEN l_returnflag = 'A' THEN 'Impression' ELSE 'View' END
         AS interaction_type
FROM lineitem""")

def _silver(feed, raw, **kw):
    """A builder of one cleaned feed; its bound of campaign ids is the number of campaigns."""
    def build(g):
        _, spec, distinct = specs(max_campaign=_max_campaign(g), **kw)[feed]
        return to_silver(raw(g.driver), spec, distinct, audit=False)
    return build


def _case(key, values):
    """SQL: the value by key % number of values."""
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values)) + " END"


add("cln_15_campaigns_from_dirty_feed", _silver("mrkt_campaigns", lambda t: dirty.dirty_campaigns(t.supplier)), f"""
SELECT s_suppkey AS campaign_id,
       CASE s_suppkey % 8 WHEN 0 THEN 'Brand_Awareness_Q1' WHEN 4 THEN 'New_Year_Launch' WHEN 1 THEN 'New_Year_Launch'
                          WHEN 5 THEN 'Summer_Launch' ELSE s_name END AS campaign_name,
       {_case('s_suppkey', dirty.DIRTY_NAMES_CLEAN)} AS channel,
       CASE WHEN s_suppkey % 8 = 1 THEN DATE '2023-12-30' ELSE DATE '2023-01-01' + CAST(s_suppkey % 300 AS INTEGER) END AS start_date,
       CASE s_suppkey % 8 WHEN 0 THEN DATE '2024-03-26' WHEN 4 THEN DATE '2024-01-26' END AS end_date,
       {_case('s_suppkey', dirty.DIRTY_OBJECTIVES_CLEAN)} AS objective
FROM supplier""")
add("cln_15_clicks_from_dirty_feed", _silver("mrkt_clicks", lambda t: dirty.dirty_clicks(t.lineitem)), f"""
SELECT l_orderkey AS click_id, l_orderkey + {dirty.WIDE_ID} AS user_id, {_case('l_orderkey', dirty.DIRTY_NAMES_TRIMMED)} AS channel,
       CASE WHEN l_linenumber <> 7 AND l_suppkey BETWEEN 1 AND (SELECT COUNT(*) FROM supplier) THEN l_suppkey END AS campaign_id,
       CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 2 = 0 THEN date_trunc('minute', l_shipdate)
            ELSE date_trunc('second', l_shipdate) + INTERVAL 1 SECOND END AS click_timestamp
FROM lineitem""")
add("cln_15_sessions_from_dirty_feed", _silver("web_sessions", lambda t: dirty.dirty_sessions(t.events)), f"""
SELECT event_id AS session_id, user_id, CASE WHEN event_id % 13 <> 0 THEN date_trunc('second', ts) END AS session_start,
       {_case('event_id', dirty.DIRTY_DEVICES_CLEAN)} AS device, {_case('event_id', dirty.DIRTY_NAMES_CLEAN)} AS source_channel,
       CASE WHEN event_id % 5 <> 0 AND event_id % 11 <> 0 THEN event_id % 15 + 1 END AS pages_viewed
FROM events""")
add("cln_15_channels_from_dirty_feed", _silver("crm_channels", lambda t: dirty.dirty_channels(t.nation)),
    "SELECT n_name AS channel_name, 'Region ' || n_regionkey AS category FROM nation")
add("cln_15_purchases_from_dirty_feed", _silver("crm_purchases", lambda t: dirty.dirty_purchases(t.orders)), f"""
SELECT o_orderkey AS purchase_id, o_custkey AS user_id, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS purchase_date,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 20 = 0 THEN -CAST(o_totalprice AS DECIMAL(12,2))
            ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS revenue,
       {_case('o_orderkey', dirty.DIRTY_NAMES_CLEAN)} AS channel_last_touch
FROM orders""")
add("cln_15_acquisitions_from_dirty_feed", _silver("crm_user_acquisitions", lambda t: dirty.dirty_acquisitions(t.customer)), f"""
SELECT c_custkey AS user_id, CASE WHEN c_custkey % 11 <> 0 THEN DATE '1996-01-01' + CAST(c_custkey % 365 AS INTEGER) END AS acquisition_date,
       {_case('c_custkey', dirty.DIRTY_NAMES_CLEAN)} AS acquisition_channel,
       CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 20 BETWEEN 1 AND (SELECT COUNT(*) FROM supplier) THEN c_custkey % 20 END AS acquisition_campaign
FROM customer""")

# --- profiling of the raw feed (PRF-*) ------------------------------------------------------
_RAW = lambda g: dirty.dirty_ad_spend(g.driver.lineitem)
_RAW_SQL = f"""(SELECT CASE WHEN l_partkey % 50 = 0 THEN 'not_available'
                            WHEN l_linenumber % 3 = 0 THEN strftime(l_shipdate, '%Y-%m-%d')
                            WHEN l_linenumber % 3 = 1 THEN strftime(l_shipdate, '%d/%m/%Y')
                            ELSE strftime(l_shipdate, '%Y/%m/%d') END AS date,
                       {_RAW_CASE.replace('NULL', "''")} AS channel,
                       CASE WHEN l_linenumber = 7 THEN 'abc' ELSE CAST(l_suppkey AS VARCHAR) || '.0' END AS campaign_id,
                       CASE WHEN l_orderkey % 7 = 0 THEN '-' ELSE '' END ||
                       CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || 'USD'
                            ELSE '"' || replace(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') || '"' END AS spend
                FROM lineitem) r"""
#: Columns of the silver feeds: those of whole seconds or days are compared as such text.
PROFILED = {"mrkt_campaigns": "campaign_id, campaign_name, channel, start_date, end_date, objective", "crm_channels": "channel_name, category",
            "crm_purchases": "purchase_id, user_id, purchase_date, revenue, channel_last_touch", "mrkt_ad_spend": "spend_date, channel, campaign_id, spend",
            "crm_user_acquisitions": "user_id, acquisition_date, acquisition_channel, acquisition_campaign",
            "mrkt_clicks": "click_id, user_id, channel, campaign_id, click_timestamp", "web_sessions": "session_id, user_id, session_start, device, source_channel, pages_viewed",
            "web_touchpoints": "user_id, touchpoint_time, channel, campaign_id, interaction_type"}
_TIMES = ("click_timestamp", "session_start", "touchpoint_time")


def _profile_sql(columns, source):
    text = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c in _TIMES and source in PROFILED else f"CAST({c} AS VARCHAR)"
    kinds = " ".join(f"WHEN regexp_matches(value, '{p}') THEN '{k}'" for k, p in prf.PROFILE_CLASSES)
    counts = ", ".join(f"COUNT(*) FILTER (kind = '{k}') AS {k}_rows" for k in ("null", "blank", *[k for k, _ in prf.PROFILE_CLASSES], "other"))
    return f"""WITH cells AS ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, {text(c)} AS value FROM {source}" for c in columns)}),
    classed AS (SELECT *, CASE WHEN value IS NULL THEN 'null' WHEN trim(value) = '' THEN 'blank' {kinds} ELSE 'other' END AS kind,
                       regexp_replace(regexp_replace(value, '[0-9]', '9', 'g'), '[A-Za-z]', 'A', 'g') AS shape FROM cells),
    often AS (SELECT column_name, value, COUNT(*) AS n FROM cells WHERE value IS NOT NULL GROUP BY ALL),
    shaped AS (SELECT column_name, shape, COUNT(*) AS n FROM classed WHERE shape IS NOT NULL GROUP BY ALL),
    top_value AS (SELECT * FROM often QUALIFY ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY n DESC, value) = 1),
    top_shape AS (SELECT * FROM shaped QUALIFY ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY n DESC, shape) = 1),
    repeated AS (SELECT column_name, COUNT(*) FILTER (n > 1) AS k FROM often GROUP BY 1)
    SELECT c.column_name, COUNT(*) AS rows, {counts}, COUNT(*) FILTER (trim(c.value) <> c.value) AS untrimmed_rows,
           COUNT(DISTINCT c.value) AS distinct_values, COALESCE(ANY_VALUE(r.k), 0) AS repeated_values,
           MIN(length(c.value)) AS shortest, MAX(length(c.value)) AS longest, COUNT(DISTINCT c.shape) AS shapes,
           ANY_VALUE(s.shape) AS top_shape, ANY_VALUE(v.value) AS top_value, ANY_VALUE(v.n) AS top_rows
    FROM classed c LEFT JOIN top_value v USING (column_name) LEFT JOIN top_shape s USING (column_name) LEFT JOIN repeated r USING (column_name)
    GROUP BY c.column_name"""


def _profiled(g, feed, columns):
    text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c in _TIMES else F.col(c) for c in columns]
    return prf.profile(g.silver[feed].select(*text))


add("prf_profile_raw_ad_spend", lambda g: prf.profile(_RAW(g)), _profile_sql(["date", "channel", "campaign_id", "spend"], _RAW_SQL))
for _feed, _cols in PROFILED.items():
    add(f"prf_profile_{_feed}", lambda g, f=_feed, c=_cols.split(", "): _profiled(g, f, c), _profile_sql(_cols.split(", "), _feed))
add("prf_01_row_count", lambda g: prf.row_count(_RAW(g)), "SELECT COUNT(*) AS row_count FROM lineitem")
add("prf_02_true_duplicates", lambda g: prf.true_duplicates(_RAW(g)),
    f"""SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (
          SELECT date, channel, campaign_id, spend, COUNT(*) AS n FROM {_RAW_SQL} GROUP BY ALL HAVING COUNT(*) > 1) t""")
add("prf_05_channel_frequencies", lambda g: prf.frequencies(_RAW(g), "channel"),
    f"SELECT channel, COUNT(*) AS occurrences FROM {_RAW_SQL} GROUP BY channel ORDER BY occurrences DESC")
add("prf_06_date_format_status",
    lambda g: prf.status_counts(_RAW(g), prf.date_format_rules("date")),
    f"""SELECT CASE WHEN date IS NULL THEN 'missing' WHEN regexp_full_match(date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'iso'
                    WHEN regexp_full_match(date, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') THEN 'dd/mm/yyyy'
                    WHEN regexp_full_match(date, '[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}') THEN 'yyyy/mm/dd'
                    WHEN regexp_full_match(date, '[A-Za-z_]+') THEN 'sentinel' ELSE 'other' END AS status,
               COUNT(*) AS n FROM {_RAW_SQL} GROUP BY 1""")
add("prf_06_money_format_status",
    lambda g: prf.status_counts(_RAW(g), prf.money_format_rules("spend")),
    """SELECT CASE WHEN l_orderkey % 7 = 0 THEN 'negative' WHEN l_linenumber % 2 = 0 THEN 'currency suffix'
                   ELSE 'decimal comma' END AS status, COUNT(*) AS n FROM lineitem GROUP BY 1""")
add("prf_06_campaign_id_format_status",
    lambda g: prf.status_counts(_RAW(g), prf.id_format_rules("campaign_id")),
    """SELECT CASE WHEN l_linenumber = 7 THEN 'non-numeric' ELSE 'decimal .0' END AS status, COUNT(*) AS n
       FROM lineitem GROUP BY 1""")
add("prf_06_touch_time_format_status",
    lambda g: prf.status_counts(dirty.dirty_touchpoints(g.driver.lineitem), prf.timestamp_format_rules("touchpoint_time")),
    """SELECT CASE WHEN l_partkey % 50 = 1 THEN 'sentinel' WHEN l_linenumber % 2 = 0 THEN 'iso'
                   ELSE 'dd/mm/yyyy hh:mm' END AS status, COUNT(*) AS n FROM lineitem GROUP BY 1""")
add("prf_06_revenue_format_status",
    lambda g: prf.status_counts(dirty.dirty_purchases(g.driver.orders), prf.number_format_rules("revenue")),
    """SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'non-numeric' WHEN o_orderkey % 20 = 0 THEN 'negative' ELSE 'decimal' END AS status,
              COUNT(*) AS n FROM orders GROUP BY 1""")
add("prf_06_pages_format_status",
    lambda g: prf.status_counts(dirty.dirty_sessions(g.driver.events), prf.number_format_rules("pages_viewed")),
    "SELECT CASE WHEN event_id % 5 = 0 THEN 'negative' ELSE 'decimal' END AS status, COUNT(*) AS n FROM events GROUP BY 1")
add("prf_06_campaign_name_status",
    lambda g: prf.status_counts(dirty.dirty_campaigns(g.driver.supplier), prf.text_case_rules("campaign_name")),
    """SELECT CASE s_suppkey % 4 WHEN 0 THEN 'upper case' WHEN 1 THEN 'plain' ELSE 'untrimmed' END AS status, COUNT(*) AS n
       FROM supplier GROUP BY 1""")
add("prf_06_objective_status",
    lambda g: prf.status_counts(dirty.dirty_campaigns(g.driver.supplier), prf.text_case_rules("objective")),
    "SELECT CASE WHEN s_suppkey % 4 IN (0, 2) THEN 'untrimmed' ELSE 'plain' END AS status, COUNT(*) AS n FROM supplier GROUP BY 1")
add("prf_08_raw_ids_without_campaign",
    lambda g: prf.absent_from(_RAW(g).select(C.decimal_id("campaign_id").alias("campaign_id")), "campaign_id",
                              g.dim_campaign, "campaign_id"),
    """SELECT DISTINCT l_suppkey AS campaign_id FROM lineitem WHERE l_linenumber <> 7
       AND l_suppkey NOT IN (SELECT campaign_id FROM dim_campaign)""")
add("prf_08_customers_without_purchase",
    lambda g: prf.absent_from(g.driver.customer, "c_custkey", g.driver.orders, "o_custkey"),
    "SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
add("prf_15_sentinel_pages_rows",
    lambda g: dirty.dirty_sessions(g.driver.events).filter(F.col("pages_viewed") == C.PAGES_SENTINEL).select("session_id", "pages_viewed"),
    "SELECT CAST(event_id AS VARCHAR) AS session_id, '-1.0' AS pages_viewed FROM events WHERE event_id % 5 = 0")
add("prf_15_negative_revenue_count",
    lambda g: dirty.dirty_purchases(g.driver.orders).filter(C.parse_decimal("revenue") < 0).agg(F.count(F.lit(1)).alias("negative_rows")),
    "SELECT COUNT(*) AS negative_rows FROM orders WHERE o_orderkey % 20 = 0 AND o_orderkey % 17 <> 0 AND o_totalprice > 0")
add("prf_07_date_length_outliers", lambda g: prf.length_outliers(_RAW(g), "date", 10).groupBy("date").count()
    .withColumnRenamed("count", "n"),
    f"SELECT date, COUNT(*) AS n FROM {_RAW_SQL} WHERE length(rtrim(date)) <> 10 GROUP BY date")
add("prf_08_unknown_channels",
    lambda g: prf.absent_from(_clean_spend(g), "channel", g.dim_channel, "channel_name"),
    f"""SELECT DISTINCT channel FROM (SELECT {_CHAN_CASE} AS channel FROM lineitem) x
        WHERE channel IS NOT NULL AND channel NOT IN (SELECT channel_name FROM dim_channel)""")
add("prf_03_hot_campaign_ids", lambda g: prf.key_counts(_RAW(g), "campaign_id", 100),
    f"SELECT campaign_id, COUNT(*) AS n FROM {_RAW_SQL} GROUP BY campaign_id HAVING COUNT(*) > 100")
add("prf_04_missing_channel_rows", lambda g: prf.missing(_RAW(g), "channel"),
    f"SELECT date, channel, campaign_id, spend FROM {_RAW_SQL} WHERE channel IS NULL OR trim(channel) = ''")
add("prf_09_repeated_dates", lambda g: dq.repeated_values(_RAW(g), "date", 50),
    f"SELECT date, COUNT(*) AS n FROM {_RAW_SQL} GROUP BY date HAVING COUNT(*) > 50")
add("prf_10_channel_preview", lambda g: prf.preview(_RAW(g), "channel", C.canonical_channel),
    f"""SELECT DISTINCT {_RAW_CASE.replace('NULL', "''")} AS raw_channel, {_CHAN_CASE} AS clean_channel FROM lineitem""")
add("prf_11_null_like_rows", lambda g: prf.null_like(_RAW(g)).groupBy().count()
    .withColumnRenamed("count", "n"),
    f"SELECT COUNT(*) AS n FROM {_RAW_SQL} WHERE date IS NULL OR trim(date) = '' OR channel IS NULL OR trim(channel) = '' "
    "OR campaign_id IS NULL OR trim(campaign_id) = '' OR spend IS NULL OR trim(spend) = ''")
add("prf_14_sentinel_dates", lambda g: prf.pattern_rows(_RAW(g), "date", "^[A-Za-z_]+$").groupBy("date").count()
    .withColumnRenamed("count", "n"),
    f"SELECT date, COUNT(*) AS n FROM {_RAW_SQL} WHERE regexp_full_match(date, '[A-Za-z_]+') GROUP BY date")
add("prf_15_distinct_objectives", lambda g: g.dim_campaign.select("objective").distinct(),
    "SELECT DISTINCT objective FROM dim_campaign")
add("prf_12_returns_matching", lambda g: dq.returns_matching(g.fact_purchases), """
SELECT total_rows, negative_rows, matched_returns, ROUND(negative_rows * 100.0 / total_rows, 2) AS negative_pct FROM
  (SELECT COUNT(*) AS total_rows FROM fact_purchases) a,
  (SELECT COUNT(*) AS negative_rows FROM fact_purchases WHERE revenue < 0) b,
  (SELECT COUNT(*) AS matched_returns FROM fact_purchases n WHERE n.revenue < 0 AND EXISTS (
      SELECT 1 FROM fact_purchases p WHERE p.revenue > 0 AND p.user_id = n.user_id AND p.revenue = -n.revenue)) c""")
add("prf_13_missing_campaign_pct", lambda g: prf.share_pct(_clean_spend(g), F.col("campaign_id").isNull(),
                                                            "missing_campaign_pct"),
    """SELECT ROUND(SUM(CASE WHEN campaign_id IS NULL THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2) AS missing_campaign_pct
       FROM (SELECT DISTINCT CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS d,
             l_suppkey % 9 AS c,
             CASE WHEN l_linenumber = 7 OR l_suppkey = 0 OR l_suppkey > (SELECT COUNT(*) FROM supplier) THEN NULL
                  ELSE l_suppkey END AS campaign_id,
             CAST(l_extendedprice AS DECIMAL(12,2)) AS s FROM lineitem) t""")
add("dq_09_purchase_id_digit_buckets", lambda g: dq.digit_buckets(g.fact_purchases, "purchase_id"), """
SELECT CASE WHEN purchase_id = 0 THEN 1 ELSE CAST(floor(log10(abs(purchase_id))) AS INTEGER) + 1 END AS digits, COUNT(*) AS n
FROM fact_purchases GROUP BY 1""")
add("dq_10_row_counts",
    lambda g: dq.row_counts(silver_purchases=g.silver["crm_purchases"], fact_purchases=g.fact_purchases,
                            fact_touchpath=g.fact_touchpath, fact_attribution_linear=g.fact_attribution_linear,
                            fact_attribution_last_touch=g.fact_attribution_last_touch),
    """SELECT (SELECT COUNT(*) FROM crm_purchases) AS silver_purchases, (SELECT COUNT(*) FROM fact_purchases) AS fact_purchases,
              (SELECT COUNT(*) FROM fact_touchpath) AS fact_touchpath,
              (SELECT COUNT(*) FROM fact_attribution_linear) AS fact_attribution_linear,
              (SELECT COUNT(*) FROM fact_attribution_last_touch) AS fact_attribution_last_touch""")


# --- the DQ suite (B10) ------------------------------------------------------------------------
def _suite(g):
    g = g.sharing("web_touchpoints")
    return dq.suite([
        ("dq_01_unique", "fact_purchases", dq.unique_key(g.fact_purchases, ["purchase_id"])),
        ("dq_01_unique", "dim_user", dq.unique_key(g.dim_user, ["user_id"])),
        ("dq_01_unique", "fact_touchpath", dq.unique_key(g.fact_touchpath, ["purchase_id", "touchpoint_number"])),
        ("dq_01_unique", "fact_attribution_last_touch", dq.unique_key(g.fact_attribution_last_touch, ["purchase_id"])),
        ("dq_02_required", "fact_clicks", dq.required(g.fact_clicks, ["click_id", "click_timestamp", "user_id",
                                                                      "click_channel", "campaign_id"])),
        ("dq_03_orphans", "fact_purchases.user_id", dq.orphans(g.fact_purchases, "user_id", g.dim_user, "user_id")),
        ("dq_03_orphans", "fact_spend.channel", dq.orphans(g.fact_spend, "channel", g.dim_channel, "channel_name")),
        ("dq_03_orphans", "fact_touchpoints.campaign_id",
         dq.orphans(g.fact_touchpoints, "campaign_id", g.dim_campaign, "campaign_id")),
        ("dq_04_consistency", "fact_attribution_linear",
         dq.consistent_with(g.fact_attribution_linear, g.fact_touchpath, ["purchase_id", "touchpoint_number", "user_id"])),
        ("dq_05_date_key", "fact_spend", dq.date_key_mismatch(g.fact_spend, "spend_date")),
        ("dq_06_range", "fact_spend.spend", g.fact_spend.filter(F.col("spend") <= 0)),
        ("dq_06_range", "fact_touchpath.touchpoint_number", dq.out_of_range(g.fact_touchpath, "touchpoint_number", lo=1)),
        ("dq_07_accepted", "fact_touchpoints.interaction_type",
         dq.not_accepted(g.fact_touchpoints, "interaction_type", ["Click", "Impression", "View"])),
        ("dq_08_repeated", "fact_clicks.click_timestamp", dq.repeated_values(g.fact_clicks, "click_timestamp", 5)),
        ("dq_12_conservation", "fact_attribution_linear", dq.conservation(g.fact_attribution_linear, 1.0)),
        ("path_gaps", "fact_touchpath", dq.path_gaps(g.fact_touchpath)),
    ])


add("dq_suite", _suite, """
SELECT 'dq_01_unique' AS "check", 'fact_purchases' AS table_name, COUNT(*) AS violations FROM (
  SELECT purchase_id FROM fact_purchases GROUP BY purchase_id HAVING COUNT(*) > 1 OR purchase_id IS NULL) t
UNION ALL SELECT 'dq_01_unique', 'dim_user', COUNT(*) FROM (
  SELECT user_id FROM dim_user GROUP BY user_id HAVING COUNT(*) > 1 OR user_id IS NULL) t
UNION ALL SELECT 'dq_01_unique', 'fact_touchpath', COUNT(*) FROM (
  SELECT purchase_id, touchpoint_number FROM fact_touchpath GROUP BY 1, 2
  HAVING COUNT(*) > 1 OR purchase_id IS NULL OR touchpoint_number IS NULL) t
UNION ALL SELECT 'dq_01_unique', 'fact_attribution_last_touch', COUNT(*) FROM (
  SELECT purchase_id FROM fact_attribution_last_touch GROUP BY 1 HAVING COUNT(*) > 1 OR purchase_id IS NULL) t
UNION ALL SELECT 'dq_02_required', 'fact_clicks', COUNT(*) FROM fact_clicks
  WHERE click_id IS NULL OR click_timestamp IS NULL OR user_id IS NULL OR click_channel IS NULL OR campaign_id IS NULL
UNION ALL SELECT 'dq_03_orphans', 'fact_purchases.user_id', COUNT(*) FROM fact_purchases f
  WHERE f.user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_user d WHERE d.user_id = f.user_id)
UNION ALL SELECT 'dq_03_orphans', 'fact_spend.channel', COUNT(*) FROM fact_spend f
  WHERE f.channel IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_channel d WHERE d.channel_name = f.channel)
UNION ALL SELECT 'dq_03_orphans', 'fact_touchpoints.campaign_id', COUNT(*) FROM fact_touchpoints f
  WHERE f.campaign_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_campaign d WHERE d.campaign_id = f.campaign_id)
UNION ALL SELECT 'dq_04_consistency', 'fact_attribution_linear', COUNT(*) FROM fact_attribution_linear l
  ANTI JOIN fact_touchpath t ON t.purchase_id = l.purchase_id
        AND t.touchpoint_number = l.touchpoint_number AND t.user_id = l.user_id
UNION ALL SELECT 'dq_05_date_key', 'fact_spend', COUNT(*) FROM fact_spend
  WHERE date_key IS DISTINCT FROM year(spend_date) * 10000 + month(spend_date) * 100 + day(spend_date)
UNION ALL SELECT 'dq_06_range', 'fact_spend.spend', COUNT(*) FROM fact_spend WHERE spend <= 0
UNION ALL SELECT 'dq_06_range', 'fact_touchpath.touchpoint_number', COUNT(*) FROM fact_touchpath WHERE touchpoint_number < 1
UNION ALL SELECT 'dq_07_accepted', 'fact_touchpoints.interaction_type', COUNT(*) FROM (
  SELECT DISTINCT interaction_type FROM fact_touchpoints
  WHERE interaction_type IS NOT NULL AND interaction_type NOT IN ('Click', 'Impression', 'View')) t
UNION ALL SELECT 'dq_08_repeated', 'fact_clicks.click_timestamp', COUNT(*) FROM (
  SELECT click_timestamp FROM fact_clicks GROUP BY 1 HAVING COUNT(*) > 5) t
UNION ALL SELECT 'dq_12_conservation', 'fact_attribution_linear', COUNT(*) FROM (
  SELECT purchase_id FROM fact_attribution_linear GROUP BY 1
  HAVING abs(SUM(revenue_share) - MAX(total_revenue)) > 1.0) t
UNION ALL SELECT 'path_gaps', 'fact_touchpath', COUNT(*) FROM (
  SELECT purchase_id FROM fact_touchpath GROUP BY 1
  HAVING MIN(touchpoint_number) <> 1 OR MAX(touchpoint_number) <> COUNT(*)) t
""")

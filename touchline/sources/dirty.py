"""Bronze-shaped dirty text derived from ``lineitem`` (input of B8 and of the
cleaning queries).

The text is derived with portable rules so that the oracle can state the
expected typed value directly from the original columns, without repeating
the cleaning logic:

* date text by ``l_linenumber % 3``: ISO, ``dd/mm/yyyy``, ``yyyy/mm/dd``;
  the sentinel ``not_available`` when ``l_partkey % 50 = 0``;
* channel text by ``l_suppkey % 9`` (fixed spellings below);
* campaign id text ``<l_suppkey>.0``, ``abc`` when ``l_linenumber = 7``;
* money text: ``<price>USD`` for even line numbers, ``"<price with decimal
  comma>"`` for odd ones, a leading ``-`` when ``l_orderkey % 7 = 0``
  (the sign is dropped by the cleaner);
* touch time text by ``l_linenumber % 2``: ``yyyy-MM-dd HH:mm:ss`` or
  ``dd/MM/yyyy HH:mm``; ``invalid`` when ``l_partkey % 50 = 1``;
* interaction text by return flag: R ``clk``, A ``impr``, else ``page_view``;
* user id text ``<l_orderkey>.0``.

The other feeds follow the same way (one function each below): campaigns from
``supplier``, clicks from ``lineitem``, sessions from ``events``, channels from
``nation``, purchases from ``orders`` and acquisitions from ``customer``, with
blanks around names, ids that carry a fraction or exceed 32 bits, mixed date
and time spellings, sentinels, spelling variants and a shifted last column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed spellings by l_suppkey % 9 and the canonical value each must become.
DIRTY_CHANNELS = ["gogle search", "FB Ads", "insta_ads", "tik_tok_ads", "Referal",
                  "googel display", "", "Radio", "ORGANIC_SEARCH"]
DIRTY_CHANNELS_CLEAN = ["Google Search", "Facebook Ads", "Instagram Ads", "TikTok Ads", "Referral",
                        "Google Display", None, "Radio", "Organic Search"]


def _pick(idx, values):
    out = None
    for i, v in enumerate(values):
        out = F.when(idx == i, F.lit(v)) if out is None else out.when(idx == i, F.lit(v))
    return out


def dirty_ad_spend(lineitem: DataFrame) -> DataFrame:
    """(date, channel, campaign_id, spend) as text, like the raw spend feed."""
    d = F.to_date("l_shipdate")
    date_txt = (F.when(F.col("l_partkey") % 50 == 0, F.lit("not_available"))
                .when(F.col("l_linenumber") % 3 == 0, F.date_format(d, "yyyy-MM-dd"))
                .when(F.col("l_linenumber") % 3 == 1, F.date_format(d, "dd/MM/yyyy"))
                .otherwise(F.date_format(d, "yyyy/MM/dd")))
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    money = F.when(F.col("l_linenumber") % 2 == 0, F.concat(price, F.lit("USD"))).otherwise(
        F.concat(F.lit('"'), F.regexp_replace(price, r"\.", ","), F.lit('"')))
    money = F.when(F.col("l_orderkey") % 7 == 0, F.concat(F.lit("-"), money)).otherwise(money)
    camp = F.when(F.col("l_linenumber") == 7, F.lit("abc")).otherwise(
        F.concat(F.col("l_suppkey").cast("string"), F.lit(".0")))
    return lineitem.select(date_txt.alias("date"), _pick(F.col("l_suppkey") % 9, DIRTY_CHANNELS).alias("channel"),
                           camp.alias("campaign_id"), money.alias("spend"))


def dirty_touchpoints(lineitem: DataFrame) -> DataFrame:
    """(user_id, touchpoint_time, channel, campaign_id, interaction_type) as text."""
    ts = F.col("l_shipdate")
    t_txt = (F.when(F.col("l_partkey") % 50 == 1, F.lit("invalid"))
             .when(F.col("l_linenumber") % 2 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
             .otherwise(F.date_format(ts, "dd/MM/yyyy HH:mm")))
    inter = (F.when(F.col("l_returnflag") == "R", "clk").when(F.col("l_returnflag") == "A", "impr")
             .otherwise("page_view"))
    return lineitem.select(F.concat(F.col("l_orderkey").cast("string"), F.lit(".0")).alias("user_id"),
                           t_txt.alias("touchpoint_time"),
                           _pick(F.col("l_suppkey") % 9, DIRTY_CHANNELS).alias("channel"),
                           F.concat(F.col("l_suppkey").cast("string"), F.lit(".0")).alias("campaign_id"),
                           inter.alias("interaction_type"))


# Fixed spellings of the feeds below, by row number % length, and what each must become.
DIRTY_NAMES = [" Email ", "fb ads", "LinkedIn Ads", "  ", "Radio ", "SMS"]
DIRTY_NAMES_CLEAN = ["Email", "Facebook Ads", "LinkedIn Ads", None, "Radio", "SMS"]
#: The same where spelling is kept (clicks): trimmed only.
DIRTY_NAMES_TRIMMED = ["Email", "fb ads", "LinkedIn Ads", None, "Radio", "SMS"]
DIRTY_DEVICES = ["iphone", " Desk_Top", "TABLET", "Fridge"]
DIRTY_DEVICES_CLEAN = ["Mobile", "Desktop", "Tablet", "Fridge"]
DIRTY_OBJECTIVES = [" AWARE reach", "conversions", "Traffic ", "Loyalty"]
DIRTY_OBJECTIVES_CLEAN = ["Awareness", "Conversion", "Traffic", "Loyalty"]
#: An id beyond 32 bits is this much larger than its row's own.
WIDE_ID = 3_000_000_000
#: A page count too wide for an integer.
WIDE_PAGES = "99999999999.0"


def _id_text(key):
    """``17.0``, ``17.6`` (cut off to 17) or a bare number, by the key."""
    return F.concat(key.cast("string"), F.when(key % 3 == 0, ".0").when(key % 3 == 1, ".6").otherwise(""))


def _date_text(date, key):
    return (F.when(key % 11 == 0, F.lit("invalid")).when(key % 3 == 0, F.date_format(date, "yyyy-MM-dd"))
            .when(key % 3 == 1, F.date_format(date, "dd/MM/yyyy")).otherwise(F.date_format(date, "yyyy/MM/dd")))


def dirty_campaigns(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    day = F.date_add(F.lit("2023-01-01").cast("date"), (k % 300).cast("int"))
    summer = k % 4 == 0
    return supplier.select(
        k.cast("string").alias("campaign_id"),
        F.when(summer, "SUMMER_RETARGETING").when(k % 4 == 1, "Summer_Launch").otherwise(F.concat(F.lit(" "), "s_name", F.lit(" "))).alias("campaign_name"),
        _pick(k % len(DIRTY_NAMES), DIRTY_NAMES).alias("channel"),
        F.when((k % 4 == 1) & (k % 8 == 1), "2023-12-30").otherwise(F.date_format(day, "dd-MM-yyyy")).alias("start_date"),
        F.when(k % 8 == 0, "2024-03-26").when(k % 8 == 4, "2024-01-26").otherwise("not_available").alias("end_date"),
        _pick(k % len(DIRTY_OBJECTIVES), DIRTY_OBJECTIVES).alias("objective"))


def dirty_clicks(lineitem: DataFrame) -> DataFrame:
    k, ts = F.col("l_orderkey"), F.col("l_shipdate")
    return lineitem.select(
        k.cast("string").alias("click_id"), _id_text(k + WIDE_ID).alias("user_id"),
        _pick(k % len(DIRTY_NAMES), DIRTY_NAMES).alias("channel"),
        F.when(F.col("l_linenumber") == 7, "0").otherwise(F.concat(F.col("l_suppkey").cast("string"), F.lit(".0"))).alias("campaign_id"),
        F.when(k % 13 == 0, "invalid_date").when(k % 2 == 0, F.date_format(ts, "dd/MM/yyyy HH:mm"))
        .otherwise(F.concat(F.lit(" "), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(".500"))).alias("timestamp"))


def dirty_sessions(events: DataFrame) -> DataFrame:
    k = F.col("event_id")
    return events.select(
        k.cast("string").alias("session_id"), _id_text(F.col("user_id")).alias("user_id"),
        F.when(k % 13 == 0, "not_a_date").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("session_start"),
        _pick(k % len(DIRTY_DEVICES), DIRTY_DEVICES).alias("device"),
        _pick(k % len(DIRTY_NAMES), DIRTY_NAMES).alias("source_channel"),
        F.when(k % 5 == 0, "-1.0").when(k % 11 == 0, WIDE_PAGES)
        .otherwise(F.concat((k % 15 + 1).cast("string"), F.lit(".0"))).alias("pages_viewed"))


def dirty_channels(nation: DataFrame) -> DataFrame:
    return nation.select(F.col("n_name").alias("channel_name"), F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("category"))


def dirty_purchases(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    return orders.select(
        k.cast("string").alias("purchase_id"), _id_text(F.col("o_custkey")).alias("user_id"),
        _date_text(F.to_date("o_orderdate"), k).alias("purchase_date"),
        F.when(k % 17 == 0, "n/a").when(k % 20 == 0, F.concat(F.lit("-"), price)).otherwise(price).alias("revenue"),
        F.concat(F.when(k % 2 == 0, "50,").otherwise(""), _pick(k % len(DIRTY_NAMES), DIRTY_NAMES)).alias("channel_last_touch"))


def dirty_acquisitions(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.cast("string").alias("user_id"),
        _date_text(F.date_add(F.lit("1996-01-01").cast("date"), (k % 365).cast("int")), k).alias("acquisition_date"),
        _pick(k % len(DIRTY_NAMES), DIRTY_NAMES).alias("acquisition_channel"),
        F.when(k % 7 == 0, "none").otherwise(F.concat((k % 20).cast("string"), F.lit(".0"))).alias("acquisition_campaign"))

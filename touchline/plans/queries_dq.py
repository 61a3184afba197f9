"""The data-quality sites of silver and gold (DQ-01 … DQ-13), one pass per table.

Row checks of a table (required values, ranges, accepted lists, date keys) are
conditions of one aggregate; keys are one pre-aggregated group-by each; orphans
of all columns are found in one aggregate over every table's values, each table
scanned once.
Every query returns (check, table_name, violations) rows, or the listing the
site asks for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import quality as dq
from .registry import add

SILVER = ("mrkt_ad_spend", "mrkt_campaigns", "mrkt_clicks", "web_sessions", "web_touchpoints", "crm_channels",
          "crm_purchases", "crm_user_acquisitions")
#: DQ-01: keys that must be unique and set.
KEYS = [("mrkt_campaigns", "campaign_id"), ("mrkt_clicks", "click_id"), ("web_sessions", "session_id"), ("crm_purchases", "purchase_id"),
        ("crm_user_acquisitions", "user_id"), ("dim_date", "date_key"), ("dim_date", "full_date"), ("dim_user", "user_id"),
        ("dim_campaign", "campaign_id"), ("dim_channel", "channel_name"), ("fact_clicks", "click_id"), ("fact_sessions", "session_id"),
        ("fact_purchases", "purchase_id"), ("fact_user_acquisition", "user_id"), ("fact_touchpath", "purchase_id, touchpoint_number"),
        ("fact_attribution_linear", "purchase_id, touchpoint_number"), ("fact_attribution_last_touch", "purchase_id")]
#: DQ-02: required columns.
REQUIRED = {"mrkt_ad_spend": "spend_date", "fact_clicks": "user_id, click_channel, campaign_id",
            "fact_sessions": "user_id, source_channel, device_category", "fact_touchpoints": "user_id, touchpoint_time, channel, interaction_type",
            "fact_touchpath": "user_id, touchpoint_number, touchpoint_time, channel, interaction_type, purchase_id",
            "fact_attribution_linear": "user_id, purchase_id, touchpoint_number, touchpoint_time, channel, interaction_type, revenue_share, total_revenue, touchpoints_in_path, purchase_date",
            "fact_attribution_last_touch": "user_id, purchase_id, touchpoint_number, touchpoint_time, last_touch_channel, interaction_type, revenue, purchase_date"}
#: DQ-05: (date column) whose date_key must be that day's.
DATED = {"fact_spend": "spend_date", "fact_clicks": "click_timestamp", "fact_sessions": "session_date",
         "fact_touchpoints": "tp_date", "fact_purchases": "purchase_date"}
#: DQ-06: (column, least, greatest) of accepted values; None is open.
RANGES = {"mrkt_ad_spend": ("spend", 0.01, None), "fact_spend": ("spend", 0.01, None), "web_sessions": ("pages_viewed", 1, 15),
          "crm_purchases": ("revenue", 10, 300), "fact_touchpath": ("touchpoint_number", 1, None)}
#: DQ-07: closed lists of accepted values.
ACCEPTED = {"mrkt_campaigns": ("objective", list(C.OBJECTIVE_PREFIXES) + list(C.OBJECTIVE_EXACT)), "web_sessions": ("device", list(C.DEVICE_BUCKETS)),
            "web_touchpoints": ("interaction_type", list(C.INTERACTION_BUCKETS)), "fact_touchpoints": ("interaction_type", list(C.INTERACTION_BUCKETS))}
#: DQ-07: columns whose distinct values are listed.
LISTED = [("mrkt_ad_spend", "channel"), ("mrkt_ad_spend", "campaign_id"), ("mrkt_campaigns", "campaign_name"), ("mrkt_campaigns", "channel"),
          ("mrkt_campaigns", "objective"), ("mrkt_clicks", "channel"), ("mrkt_clicks", "campaign_id"), ("web_sessions", "device"),
          ("web_sessions", "source_channel"), ("web_sessions", "pages_viewed"), ("web_touchpoints", "channel"), ("web_touchpoints", "campaign_id"),
          ("web_touchpoints", "interaction_type"), ("crm_purchases", "channel_last_touch"), ("crm_channels", "category"),
          ("crm_user_acquisitions", "acquisition_channel"), ("crm_user_acquisitions", "acquisition_campaign"), ("dim_campaign", "objective"),
          ("fact_spend", "objective")]
#: DQ-03: (table, columns, reference, its columns).
REFERENCES = [(f, "user_id", "dim_user", "user_id") for f in ("fact_clicks", "fact_sessions", "fact_touchpoints", "fact_purchases", "fact_touchpath",
                                                             "fact_attribution_linear", "fact_attribution_last_touch")]
REFERENCES += [(f, "channel", "dim_channel", "channel_name") for f in ("fact_spend", "fact_touchpoints", "fact_touchpath")]
REFERENCES += [("fact_purchases", "acquisition_channel", "dim_channel", "channel_name"), ("fact_clicks", "acquisition_channel", "dim_channel", "channel_name"),
               ("fact_sessions", "acquisition_channel", "dim_channel", "channel_name")]
REFERENCES += [(f, "campaign_id", "dim_campaign", "campaign_id") for f in ("fact_spend", "fact_touchpoints", "fact_touchpath")]
REFERENCES += [("fact_spend", "campaign_name", "dim_campaign", "campaign_name"),
               ("fact_purchases", "user_id, acquisition_date", "crm_user_acquisitions", "user_id, acquisition_date"),
               ("dim_campaign", "campaign_name", "mrkt_campaigns", "campaign_name")]
#: DQ-04: each column's values must appear in the parent.
PARENTS = [("fact_attribution_linear", c, "fact_touchpath", c) for c in ("user_id", "purchase_id", "touchpoint_number", "touchpoint_time", "channel",
                                                                        "campaign_id", "interaction_type")]
PARENTS += [("fact_attribution_linear", "total_revenue", "fact_purchases", "revenue"), ("fact_attribution_linear", "purchase_date", "fact_purchases", "purchase_date")]
PARENTS += [("fact_attribution_last_touch", a, "fact_touchpath", b) for a, b in (
    ("user_id", "user_id"), ("purchase_id", "purchase_id"), ("touchpoint_number", "touchpoint_number"), ("touchpoint_time", "touchpoint_time"),
    ("last_touch_channel", "channel"), ("last_touch_campaign", "campaign_id"), ("interaction_type", "interaction_type"))]
PARENTS += [("fact_attribution_last_touch", "revenue", "fact_purchases", "revenue"), ("fact_attribution_last_touch", "purchase_date", "fact_purchases", "purchase_date")]
#: DQ-08: timestamps that occur more often than this.
REPEATED = [("mrkt_clicks", "click_timestamp", 3), ("web_sessions", "session_start", 3), ("web_touchpoints", "touchpoint_time", 5)]
#: DQ-09: ids by number of digits.
DIGITS = [("mrkt_clicks", "click_id"), ("web_sessions", "session_id"), ("web_touchpoints", "user_id"), ("crm_purchases", "purchase_id"),
          ("crm_user_acquisitions", "user_id")]
#: DQ-10: rows of a fact beside those of its source.
COUNTS = [("dim_date", "dim_user"), ("mrkt_ad_spend", "fact_spend"), ("mrkt_clicks", "fact_clicks"), ("web_sessions", "fact_sessions"),
          ("web_touchpoints", "fact_touchpoints"), ("crm_purchases", "fact_purchases"), ("fact_touchpath", "fact_touchpoints"),
          ("fact_attribution_linear", "fact_touchpath"), ("fact_attribution_last_touch", "fact_purchases")]


def _get(g, name: str) -> DataFrame:
    return g.silver[name] if name in SILVER else g.table(name)


def _sharing(g):
    """Gold tables of one query start from one copy of the touches."""
    return g.sharing("web_touchpoints")


def _row_checks(name: str) -> list[tuple[str, object]]:
    """(check, condition of a violating row) of a table."""
    out = []
    if name in REQUIRED:
        out.append(("dq_02_required", reduce(lambda a, b: a | b, [F.col(c).isNull() for c in REQUIRED[name].split(", ")])))
    if name in DATED:
        d = F.to_date(DATED[name])
        out.append(("dq_05_date_key", d.isNotNull() & ~F.col("date_key").eqNullSafe(F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d))))
    if name in RANGES:
        c, low, high = RANGES[name]
        out.append((f"dq_06_range_{c}", (F.col(c) < low) | (F.col(c) > high) if high is not None else F.col(c) < low))
    if name in ACCEPTED:
        c, values = ACCEPTED[name]
        out.append((f"dq_07_accepted_{c}", F.col(c).isNotNull() & ~F.col(c).isin(values)))
    return out


def _rows_of(g, name: str) -> DataFrame:
    checks = _row_checks(name)
    wide = _get(g, name).agg(*[F.coalesce(F.sum(F.coalesce(cond, F.lit(False)).cast("long")), F.lit(0)).alias(f"v{i}") for i, (_, cond) in enumerate(checks)])
    stack = ", ".join(f"'{label}', v{i}" for i, (label, _) in enumerate(checks))
    return wide.selectExpr(f"stack({len(checks)}, {stack}) AS (`check`, violations)").select("check", F.lit(name).alias("table_name"), "violations")


def _count(df: DataFrame, check: str, table: str, what=None) -> DataFrame:
    return df.agg(F.coalesce(F.sum(what) if what is not None else F.count(F.lit(1)), F.lit(0)).cast("long").alias("violations")).select(
        F.lit(check).alias("check"), F.lit(table).alias("table_name"), "violations")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _absent(g, name: str, sites: list[tuple[str, str, str, str]]) -> DataFrame:
    """All sites in one pass: every table that a site names is scanned once."""
    g = _sharing(g)
    found = dq.absent_values({t: _get(g, t) for s in sites for t in (s[0], s[2])}, [(t, c.split(", "), r, rc.split(", ")) for t, c, r, rc in sites])
    # the sites are a fixed list; one without any value has no row in the aggregate
    named = g.spark.createDataFrame([(i, f"{name}_{s[1]}", s[0]) for i, s in enumerate(sites)], "site int, `check` string, table_name string")
    return F.broadcast(named).join(found, "site", "left").select("check", "table_name", F.coalesce("violations", F.lit(0)).alias("violations"))


_TABLES = [t for t in dict.fromkeys([*REQUIRED, *DATED, *RANGES, *ACCEPTED])]


def _sql_rows(name: str) -> str:
    parts = []
    if name in REQUIRED:
        parts.append(("dq_02_required", f"least({', '.join(f'{c} IS NOT NULL' for c in REQUIRED[name].split(', '))}, true) = false"))
    if name in DATED:
        parts.append(("dq_05_date_key", f"{DATED[name]} IS NOT NULL AND date_key IS DISTINCT FROM CAST(strftime(CAST({DATED[name]} AS DATE), '%Y%m%d') AS INTEGER)"))
    if name in RANGES:
        c, low, high = RANGES[name]
        parts.append((f"dq_06_range_{c}", f"NOT ({c} BETWEEN {low} AND {high if high is not None else 10**15})"))
    if name in ACCEPTED:
        c, values = ACCEPTED[name]
        parts.append((f"dq_07_accepted_{c}", f"NOT list_contains({values!r}, {c})"))
    return " UNION ALL ".join(f"""SELECT '{label}' AS "check", '{name}' AS table_name, COUNT(*) AS violations FROM {name} WHERE {cond}""" for label, cond in parts)


for _layer, _names in (("silver", [t for t in _TABLES if t in SILVER]), ("gold", [t for t in _TABLES if t not in SILVER])):
    _model = _sharing if _layer == "gold" else (lambda g: g)
    add(f"dq_rows_{_layer}", lambda g, names=_names, m=_model: _union([_rows_of(m(g), n) for n in names]), " UNION ALL ".join(_sql_rows(n) for n in _names))
    _keys = [k for k in KEYS if (k[0] in SILVER) == (_layer == "silver")]
    add(f"dq_01_keys_{_layer}",
        lambda g, keys=_keys, m=_model: _union([_count(dq.unique_key(_get(m(g), t), k.split(", ")), f"dq_01_unique_{k}", t) for t, k in keys]),
        " UNION ALL ".join(f"""SELECT 'dq_01_unique_{k}' AS "check", '{t}' AS table_name,
                                      COUNT(*) FILTER (n > 1 OR {' OR '.join(f'{c} IS NULL' for c in k.split(', '))}) AS violations
                               FROM (SELECT {k}, COUNT(*) AS n FROM {t} GROUP BY {k}) counted""" for t, k in _keys))

for _name, _sites in (("dq_03_references", REFERENCES), ("dq_04_parents", PARENTS)):
    add(_name, lambda g, n=_name, sites=_sites: _absent(g, n, sites),
        " UNION ALL ".join(f"""SELECT '{_name}_{c}' AS "check", '{t}' AS table_name, COUNT(*) AS violations FROM {t} WHERE """
                           + " AND ".join(f"{x} IS NOT NULL" for x in c.split(", ")) + f" AND ({c}) NOT IN (SELECT ({rc}) FROM {r} WHERE "
                           + " AND ".join(f"{x} IS NOT NULL" for x in rc.split(", ")) + ")" for t, c, r, rc in _sites))

add("dq_07_value_listing",
    lambda g: _union([_get(g, t).groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
                      .select(F.lit(f"{t}.{c}").alias("column_name"), "value", "n") for t, c in LISTED]),
    " UNION ALL ".join(f"SELECT '{t}.{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n FROM {t} GROUP BY {c}" for t, c in LISTED))
#: DQ-13: tables of which a stable sample is shown, with the columns whose text is the same in either engine.
SAMPLED = [("mrkt_campaigns", "campaign_id, campaign_name, channel, objective"), ("crm_channels", "channel_name, category"),
           ("crm_purchases", "purchase_id, user_id, purchase_date, revenue, channel_last_touch"), ("mrkt_clicks", "click_id, user_id, channel, campaign_id"),
           ("fact_touchpath", "user_id, purchase_id, touchpoint_number, channel, campaign_id, interaction_type"),
           ("fact_attribution_last_touch", "user_id, purchase_id, last_touch_channel, revenue, purchase_date")]
for _table, _cols in SAMPLED:
    add(f"dq_13_sample_{_table}", lambda g, t=_table, c=_cols: dq.sample(_get(g, t).select(*c.split(", "))),
        f"SELECT {_cols} FROM {_table} ORDER BY md5(concat_ws('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in _cols.split(", ")) + ")) LIMIT 10")

add("dq_08_repeated_times",
    lambda g: _union([_count(dq.repeated_values(_get(g, t), c, n), f"dq_08_repeated_{c}", t) for t, c, n in REPEATED]),
    " UNION ALL ".join(f"""SELECT 'dq_08_repeated_{c}' AS "check", '{t}' AS table_name, COUNT(*) AS violations
                           FROM (SELECT 1 FROM {t} GROUP BY {c} HAVING COUNT(*) > {n}) often""" for t, c, n in REPEATED))
add("dq_09_digits",
    lambda g: _union([dq.digit_buckets(_get(g, t), c).select(F.lit(f"{t}.{c}").alias("column_name"), "digits", "n") for t, c in DIGITS]),
    " UNION ALL ".join(f"""SELECT '{t}.{c}' AS column_name, CASE WHEN {c} = 0 THEN 1 ELSE CAST(floor(log10(abs({c}))) AS INTEGER) + 1 END AS digits,
                                  COUNT(*) AS n FROM {t} GROUP BY 2""" for t, c in DIGITS))
add("dq_10_layer_counts",
    lambda g: _union([_get(_sharing(g), a).agg(F.count(F.lit(1)).alias("source_rows")).select(
        F.lit(a).alias("source"), F.lit(b).alias("target"), "source_rows", _get(_sharing(g), b).agg(F.count(F.lit(1))).scalar().alias("target_rows")) for a, b in COUNTS]),
    " UNION ALL ".join(f"SELECT '{a}' AS source, '{b}' AS target, (SELECT COUNT(*) FROM {a}) AS source_rows, (SELECT COUNT(*) FROM {b}) AS target_rows"
                       for a, b in COUNTS))

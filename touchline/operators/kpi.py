"""KPI family with month-over-month analysis (KPI-00, KPI-01, KPI-ALL, movers).

A KPI view is: one or two monthly aggregates (numerator / denominator) per
(year, month[, entity]) → joined → ratio → two windows over the entity (the
entity mean and the previous present month).  Both windows share one
partitioning, so a view costs one shuffle per aggregate (partial
aggregation map-side) plus one for the windows; the windows run over
monthly aggregates (rows = months × entities), never over raw facts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import RATIO_SCALE
from ..sources.staging import staged

#: Columns that an LP measure takes from the purchase.
_P_COLS = ("acquisition_campaign", "acquisition_channel")

# Fixed label sets of the reference (avg labels, previous-month labels).
LABELS = {
    "A": (("Above Avg", "Below Avg", "Equals Average"), ("Increase", "Decrease", "No Change")),
    "B": (("Worsened (Above Avg)", "Improved (Below Avg)", "Equals Average"),
          ("Worsened (Higher)", "Improved (Lower)", "No Change")),
    "C": (("Above Avg", "Below Avg", "Equals Average"), ("Improved", "Decreased", "No Change")),
    "D": (("Above Avg", "Below Avg", "Equals Avg"), ("Improved", "Declined", "No Change")),
    "E": (("Above Avg", "Below Avg", "Equals Average"), ("Higher", "Lower", "No Change")),
}


@dataclass(frozen=True)
class Measure:
    """A monthly aggregate of one fact.

    source: P purchases, L linear, T last touch, S spend, K clicks (month of
    the click), Kd clicks (month via the calendar key), I impressions,
    LP linear ⟕ purchases, TP last touch ⟕ purchases.
    agg: sum | count | count_star | count_distinct."""
    source: str
    agg: str
    col: str | None
    alias: str
    entity: str | None = None
    nn: bool = False          # WHERE entity IS NOT NULL inside the aggregate
    name: bool = False        # add campaign_name via dim_campaign


@dataclass(frozen=True)
class KpiView:
    id: str
    view: str
    metric: str               # roas, cac, …; "revenue" for single-measure views
    a: Measure                # FROM side
    b: Measure | None = None  # joined side
    how: str = "full"         # full | left | inner
    key: str = "a"            # a | b | coalesce — which side's entity survives
    name_from: str = "a"      # a | b | coalesce
    nn: bool = False          # view filters entity IS NOT NULL (before windows)
    num: str = "a"            # numerator side
    coalesce0: tuple = ()     # sides coalesced to 0
    labels: str = "A"
    inputs: tuple = ()        # output order of the two inputs (aliases)
    entity_out: str | None = None
    roi: bool = False
    single_names: str = "entity"  # "global" naming for REV-1
    top: int = 10
    lower_is_better: bool = False

    @property
    def entity(self) -> str | None:
        return self.a.entity


# --- source relations --------------------------------------------------------

def _source(g, m: Measure) -> tuple[DataFrame, object]:
    """(DataFrame, date column expression) of a measure's source."""
    s = m.source
    if s == "P":
        return g.fact_purchases, F.col("purchase_date")
    if s == "L":
        return g.fact_attribution_linear, F.col("purchase_date")
    if s == "T":
        return g.fact_attribution_last_touch, F.col("purchase_date")
    if s == "S":
        return g.fact_spend, F.col("spend_date")
    if s == "K":
        return g.fact_clicks, F.col("click_timestamp")
    if s == "Kd":
        return g.fact_clicks, None
    if s == "I":
        return g.fact_touchpoints.filter(F.col("interaction_type") == "Impression"), F.col("touchpoint_time")
    if s == "LP":
        p = g.fact_purchases.select(F.col("purchase_id").alias("_p_id"), "acquisition_campaign",
                                    "acquisition_channel")
        lp = g.fact_attribution_linear.join(p, F.col("purchase_id") == F.col("_p_id"), "left")
        return lp, F.col("purchase_date")
    if s == "TP":
        # last touch ⟕ purchases: the purchase's user and date are the last
        # touch's own (the path is built per purchase), so the join is elided
        return g.fact_attribution_last_touch, F.col("purchase_date")
    raise ValueError(s)


def _agg(m: Measure):
    if m.agg == "sum":
        return F.sum(m.col)
    if m.agg == "count":
        return F.count(m.col)
    if m.agg == "count_star":
        return F.count(F.lit(1))
    if m.agg == "count_distinct":
        return F.countDistinct(m.col)
    raise ValueError(m.agg)


def monthly(g, m: Measure) -> DataFrame:
    """KPI-01 building block: (performance_year, performance_month[, entity
    [, campaign_name]], alias).

    Memoised per model: the 55 views need ~40 distinct monthly aggregates,
    so views built on one ``GoldModel`` share them (and ``shared_monthly``
    can persist them once for a whole report run)."""
    memo = g._t.setdefault("_monthly", {})
    if m not in memo:
        memo[m] = _monthly(g, m)
    return memo[m]


def shared_monthly(g, views, storage=None) -> list[DataFrame]:
    """Monthly aggregates of a whole report, one pass per source.

    All measures of one source (fact) are computed by a single GROUPING SETS
    aggregate — one scan and one shuffle of the fact instead of one per
    measure — then each measure is a filter on the grouping id.  The
    combined aggregates are small (months × entities × sets) and persisted;
    returns them for ``unpersist``."""
    from pyspark import StorageLevel
    measures = {m for v in views for m in (v.a, v.b) if m is not None}
    by_source: dict[str, list[Measure]] = {}
    for m in measures:
        by_source.setdefault(m.source, []).append(m)
    memo = g._t.setdefault("_monthly", {})
    persisted = []
    for src, ms in by_source.items():
        df, date = _source(g, ms[0])
        if date is None:
            y = F.floor(F.col("date_key") / 10000).cast("int")
            mo = (F.floor(F.col("date_key") / 100) % 100).cast("int")
        else:
            y, mo = F.year(date), F.month(date)
        ents = sorted({m.entity for m in ms if m.entity})
        keys = ["performance_year", "performance_month"] + ents
        aggs = {}
        for m in ms:
            aggs.setdefault((m.agg, m.col), f"_v{len(aggs)}")
        value_cols = sorted({c for (_, c) in aggs if c})
        base = df.select(y.alias("performance_year"), mo.alias("performance_month"),
                         *[F.col(c) for c in ents], *[F.col(c) for c in value_cols if c not in ents])
        sets = sorted({(m.entity,) if m.entity else () for m in ms})
        grouped = (base.groupingSets([["performance_year", "performance_month", *e] for e in sets], *keys)
                   .agg(F.grouping_id().alias("_gid"),
                        *[_agg(Measure(src, k, c, a)).alias(a) for (k, c), a in aggs.items()])
                   .persist(storage or StorageLevel.MEMORY_AND_DISK))
        persisted.append(grouped)
        for m in ms:
            present = ["performance_year", "performance_month"] + ([m.entity] if m.entity else [])
            gid = sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in present)
            r = grouped.filter(F.col("_gid") == gid)
            if m.nn and m.entity:
                r = r.filter(F.col(m.entity).isNotNull())
            r = r.select(*present, F.col(aggs[(m.agg, m.col)]).alias(m.alias))
            memo[m] = _with_name(g, m, r)
    return persisted


def _with_name(g, m: Measure, out: DataFrame) -> DataFrame:
    if not m.name:
        return out
    c = g.dim_campaign.select(F.col("campaign_id").alias("_c_id"), "campaign_name")
    return out.join(c, F.col(m.entity) == F.col("_c_id"), "left").drop("_c_id")


def _per_purchase(g, m: Measure) -> DataFrame:
    """The LP source for a measure by a column of the purchase: the linear rows are summed (or made
    distinct) per purchase before they meet the purchases, one row of a path instead of all."""
    keys = ["user_id", "purchase_id", "purchase_date"]
    lin = g.fact_attribution_linear
    lin = lin.groupBy(*keys).agg(F.sum(m.col).alias(m.col)) if m.agg == "sum" else lin.select(*keys).distinct()
    p = g.fact_purchases.select(F.col("purchase_id").alias("_p_id"), "acquisition_campaign", "acquisition_channel")
    return lin.join(p, F.col("purchase_id") == F.col("_p_id"), "left")


def _shared_purchases(g) -> DataFrame:
    """Purchase ids of more than one user (none, where ids are unique), found once per model."""
    if "_shared_purchases" not in g._t:
        users = g.fact_purchases.groupBy("purchase_id").agg(F.min("user_id").alias("_lo"), F.max("user_id").alias("_hi"))
        g._t["_shared_purchases"] = staged(users.filter("_lo <> _hi").select(F.col("purchase_id").alias("_shared_id")), "shared-purchases")
    return g._t["_shared_purchases"]


def _distinct_purchases(g, df: DataFrame, keys: list, alias: str) -> DataFrame:
    """COUNT(DISTINCT purchase_id) of path rows.  A purchase of one user is made distinct among that
    user's rows, where they stand, so path rows need not travel; ids of several users, if there are
    any, are counted apart, and the two counts of a key add up as they have no id in common."""
    count = lambda rows: (rows.groupBy("user_id", "purchase_id", *keys).agg(F.count(F.lit(1)).alias("_n"))
                          .groupBy(*_names(keys)).agg(F.count("purchase_id").alias(alias)))
    shared = _shared_purchases(g)
    if shared.isEmpty():
        return count(df)
    on = F.col("purchase_id") == F.col("_shared_id")
    apart = df.join(shared, on, "left_semi").groupBy(*keys).agg(F.countDistinct("purchase_id").alias(alias))
    return (count(df.join(shared, on, "left_anti")).unionByName(apart)
            .groupBy(*_names(keys)).agg(F.sum(alias).alias(alias)))


def _names(keys: list) -> list[str]:
    return ["performance_year", "performance_month", "_entity"][:len(keys)]


def _monthly(g, m: Measure) -> DataFrame:
    df, date = _source(g, m)
    if m.source == "LP" and m.entity in _P_COLS and (m.agg == "count_distinct" or (m.agg, m.col) == ("sum", "revenue_share")):
        df = _per_purchase(g, m)
    if date is None:  # month through the calendar key yyyymmdd
        y = F.floor(F.col("date_key") / 10000).cast("int")
        mo = (F.floor(F.col("date_key") / 100) % 100).cast("int")
    else:
        y, mo = F.year(date), F.month(date)
    if m.nn and m.entity:
        df = df.filter(F.col(m.entity).isNotNull())
    keys = [y.alias("performance_year"), mo.alias("performance_month")]
    if m.source == "L" and (m.agg, m.col) == ("count_distinct", "purchase_id"):
        if m.entity:
            keys.append(F.col(m.entity).alias("_entity"))
        out = _distinct_purchases(g, df, keys, m.alias)
        return _with_name(g, m, out.withColumnRenamed("_entity", m.entity) if m.entity else out)
    if m.entity:
        keys.append(F.col(m.entity))
    if m.source == "LP" and m.agg == "sum" and m.entity in _P_COLS:  # the type of a sum of shares
        kind = g.fact_attribution_linear.agg(F.sum(m.col)).schema[0].dataType
        return _with_name(g, m, df.groupBy(*keys).agg(F.sum(m.col).cast(kind).alias(m.alias)))
    return _with_name(g, m, df.groupBy(*keys).agg(_agg(m).alias(m.alias)))


def _labels(diff, names):
    pos, neg, zero = names
    return F.when(diff > 0, pos).when(diff < 0, neg).otherwise(zero)


def mom(df: DataFrame, entity: str | None, metric: str, names: dict, labels: str,
        decimal_metric: bool = True) -> DataFrame:
    """KPI-00: entity mean, difference and label; previous present month,
    difference, label and percentage change.

    Both windows partition by the entity, so they share one exchange.  The
    arithmetic is exact: the metric is a decimal (ratios are rounded to 6
    places first), the mean is Σ/count in decimal rounded half-up to 6
    places, differences are decimal; only the percentage is a double."""
    avg_l, pm_l = LABELS[labels]
    part = [entity] if entity else []
    w_all = Window.partitionBy(*part)
    w_ord = Window.partitionBy(*part).orderBy("performance_year", "performance_month")
    m = F.col(metric)
    md = m.cast("decimal(38,6)")
    df = df.withColumn(names["avg"], F.round(F.sum(md).over(w_all) / F.count(md).over(w_all), RATIO_SCALE))
    df = df.withColumn("diff_avg", md - F.col(names["avg"]))
    df = df.withColumn("avg_change", _labels(F.col("diff_avg"), avg_l))
    df = df.withColumn(names["pm"], F.lag(m).over(w_ord))
    pmc = F.col(names["pm"])
    df = df.withColumn(names["diff_pm"], m - pmc)
    df = df.withColumn("pm_change", _labels(F.col(names["diff_pm"]), pm_l))
    pct = F.when(pmc.cast("double") == 0, F.lit(None).cast("double")).otherwise(
        F.col(names["diff_pm"]).cast("double") / pmc.cast("double") * 100)
    return df.withColumn("mom_percentage", F.round(pct, 2))


def output_names(v: KpiView) -> dict:
    if v.b is None:
        if v.single_names == "global":
            return {"cur": "current_revenue", "avg": "avg_current_revenue", "pm": "pm_current_revenue",
                    "diff_pm": "diff_pm_current_revenue"}
        return {"cur": "current_revenue", "avg": "avg_revenue", "pm": "pm_revenue", "diff_pm": "diff_pm"}
    k = v.metric
    return {"cur": f"current_{k}", "avg": f"avg_{k}", "pm": f"pm_{k}", "diff_pm": f"diff_pm_{k}"}


def entity_out(v: KpiView) -> str | None:
    return v.entity_out or v.a.entity


def kpi_view(g, v: KpiView) -> DataFrame:
    """Build one KPI view as a DataFrame."""
    names = output_names(v)
    ent = entity_out(v)
    A = monthly(g, v.a)
    if v.b is None:
        df = A.withColumnRenamed(v.a.alias, names["cur"])
        if v.a.entity and v.a.entity != ent:
            df = df.withColumnRenamed(v.a.entity, ent)
        body = mom(df, ent, names["cur"], names, v.labels, decimal_metric=True)
        cols = ["performance_year", "performance_month"] + ([ent] if ent else []) + \
               (["campaign_name"] if v.a.name else []) + \
               [names["cur"], names["avg"], "diff_avg", "avg_change", names["pm"], names["diff_pm"],
                "pm_change", "mom_percentage"]
        return body.select(*cols)

    B = monthly(g, v.b)
    a_cols = {c: f"a_{c}" for c in A.columns}
    b_cols = {c: f"b_{c}" for c in B.columns}
    A2 = A.select(*[F.col(c).alias(n) for c, n in a_cols.items()])
    B2 = B.select(*[F.col(c).alias(n) for c, n in b_cols.items()])
    cond = ((F.col("a_performance_year") == F.col("b_performance_year"))
            & (F.col("a_performance_month") == F.col("b_performance_month")))
    if v.a.entity:
        cond = cond & (F.col(f"a_{v.a.entity}") == F.col(f"b_{v.b.entity}"))
    j = A2.join(B2, cond, v.how)

    def pick(which, a_name, b_name):
        if which == "a":
            return F.col(a_name)
        if which == "b":
            return F.col(b_name)
        return F.coalesce(F.col(a_name), F.col(b_name))

    # year/month: COALESCE for full/inner joins, FROM side for left joins
    ym_from = "coalesce" if v.how in ("full", "inner") else v.key
    sel = [pick(ym_from, "a_performance_year", "b_performance_year").alias("performance_year"),
           pick(ym_from, "a_performance_month", "b_performance_month").alias("performance_month")]
    if v.a.entity:
        sel.append(pick(v.key, f"a_{v.a.entity}", f"b_{v.b.entity}").alias(ent))
    has_name = v.a.name or v.b.name
    if has_name:
        nf = v.name_from if (v.a.name and v.b.name) else ("a" if v.a.name else "b")
        sel.append(pick(nf, "a_campaign_name", "b_campaign_name").alias("campaign_name"))
    av = F.col(f"a_{v.a.alias}")
    bv = F.col(f"b_{v.b.alias}")
    if "a" in v.coalesce0:
        av = F.coalesce(av, F.lit(0))
    if "b" in v.coalesce0:
        bv = F.coalesce(bv, F.lit(0))
    sel += [av.alias(v.a.alias), bv.alias(v.b.alias)]
    df = j.select(*sel)
    num, den = (F.col(v.a.alias), F.col(v.b.alias)) if v.num == "a" else (F.col(v.b.alias), F.col(v.a.alias))
    # exact ratio: decimal(38,2) / decimal(38,2) is rounded half-up to 6 places
    nd, dd = num.cast("decimal(38,2)"), den.cast("decimal(38,2)")
    if v.roi:
        df = df.withColumn("current_profit", (num - den))
        nd = nd - dd
    metric = F.when(dd == 0, F.lit(None).cast("decimal(38,6)")).otherwise(nd / dd)
    df = df.withColumn(names["cur"], F.round(metric, RATIO_SCALE).cast("decimal(38,6)"))
    if v.nn and ent:
        df = df.filter(F.col(ent).isNotNull())
    if v.roi:
        df = df.filter(F.col(names["cur"]).isNotNull())
    body = mom(df, ent, names["cur"], names, v.labels)
    inputs = list(v.inputs) if v.inputs else [v.a.alias, v.b.alias]
    cols = ["performance_year", "performance_month"] + ([ent] if ent else []) + \
           (["campaign_name"] if has_name else []) + inputs + \
           [names["cur"], names["avg"], "diff_avg", "avg_change", names["pm"], names["diff_pm"],
            "pm_change", "mom_percentage"]
    return body.select(*cols)


def movers(view_df: DataFrame, v: KpiView, by: str, best: bool) -> DataFrame:
    """KPI-TOP-1…4: top-n rows of a view by absolute (``by='diff'``) or
    percentage (``by='pct'``) month-over-month change.

    Revenue-style views (labels A) rank best-first only: by difference
    unfiltered, by percentage where the previous month is > 0.  Cost metrics
    (``lower_is_better``) improve downwards, rate metrics upwards; both drop
    rows without a previous month.  NULL ordering is the reference's (NULL is
    the smallest value); ties are broken by (entity, year, month) so the
    top-n set is deterministic."""
    names = output_names(v)
    ent = entity_out(v)
    col = names["diff_pm"] if by == "diff" else "mom_percentage"
    desc = best != v.lower_is_better
    df = view_df
    if v.labels == "A":
        if by == "pct":
            df = df.filter(F.col(names["pm"]) > 0)
    elif by == "diff":
        df = df.filter(F.col(names["diff_pm"]).isNotNull())
    else:
        df = df.filter(F.col(names["pm"]).isNotNull())
    o = F.col(col).desc_nulls_last() if desc else F.col(col).asc_nulls_first()
    tie = ([F.col(ent).asc_nulls_first()] if ent else []) + [F.col("performance_year"), F.col("performance_month")]
    return df.orderBy(o, *tie).limit(v.top)

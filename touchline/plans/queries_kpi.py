"""Registered queries: the 55 KPI views, their movers, the overall KPIs and
the filtered reports (SURVEY §2.10).

Each view is one ``KpiView`` row.  The DataFrame comes from
``operators.kpi.kpi_view``; the oracle SQL is generated here from the same
row by a separate, SQL-only code path (``_view_sql``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dims import with_dense_key
from ..operators.kpi import LABELS, KpiView, Measure, entity_out, kpi_view, movers, output_names
from .registry import add

M = Measure

# revenue-side measures
P_REV = M("P", "sum", "revenue", "current_revenue")
L_REV = M("L", "sum", "revenue_share", "current_revenue")
T_REV = M("T", "sum", "revenue", "current_revenue")
S_SPEND = M("S", "sum", "spend", "current_spend")


def _camp(m: Measure, entity: str, nn=True, name=True) -> Measure:
    return M(m.source, m.agg, m.col, m.alias, entity, nn, name)


def _ent(m: Measure, entity: str, nn=False) -> Measure:
    return M(m.source, m.agg, m.col, m.alias, entity, nn, False)


V = KpiView
VIEWS: list[KpiView] = [
    # ---- revenue (0901) ----------------------------------------------------
    V("rev_1", "revenue", "revenue", P_REV, single_names="global"),
    V("rev_2", "funnel_campaigns_performance", "revenue", _camp(L_REV, "campaign_id")),
    V("rev_3", "acquisition_campaigns_performance", "revenue", _camp(P_REV, "acquisition_campaign")),
    V("rev_4", "last_touch_campaigns_performance", "revenue", _camp(T_REV, "last_touch_campaign")),
    V("rev_5", "funnel_channels_performance", "revenue", _ent(L_REV, "channel")),
    V("rev_6", "acquisition_channels_performance", "revenue", _ent(P_REV, "acquisition_channel")),
    V("rev_7", "last_touch_channels_performance", "revenue", _ent(T_REV, "last_touch_channel")),
    V("rev_8", "funnel_interaction_types_performance", "revenue", _ent(L_REV, "interaction_type"), top=5),
    # ---- ROAS (0902) -------------------------------------------------------
    V("roas_1", "roas", "roas", P_REV, S_SPEND),
    V("roas_2", "funnel_campaigns_roas", "roas", _camp(L_REV, "campaign_id"), _camp(S_SPEND, "campaign_id", name=False)),
    V("roas_3", "acquisition_campaigns_roas", "roas", _camp(P_REV, "acquisition_campaign"),
      _camp(S_SPEND, "campaign_id", name=False)),
    V("roas_4", "last_touch_campaigns_roas", "roas", _camp(T_REV, "last_touch_campaign"),
      _camp(S_SPEND, "campaign_id", name=False)),
    V("roas_5", "funnel_channels_roas", "roas", _ent(L_REV, "channel"), _ent(S_SPEND, "channel"), key="coalesce"),
    V("roas_6", "acquisition_channels_roas", "roas", _ent(P_REV, "acquisition_channel"), _ent(S_SPEND, "channel")),
    V("roas_7", "last_touch_channels_roas", "roas", _ent(T_REV, "last_touch_channel"), _ent(S_SPEND, "channel")),
]

# ---- cost metrics: CAC (0903), CPA (0904), CPC (0905) -------------------------
_P_USERS = M("P", "count", "user_id", "current_new_users")
_T_CONV = M("T", "count", "purchase_id", "current_conversions")
_K_CLICKS = M("Kd", "count", "click_id", "current_clicks")
for fam, den, camp_ent, chan_ent in (("cac", _P_USERS, "acquisition_campaign", "acquisition_channel"),
                                     ("cpa", _T_CONV, "last_touch_campaign", "last_touch_channel"),
                                     ("cpc", _K_CLICKS, "campaign_id", "click_channel")):
    inputs = ("current_spend", den.alias)
    VIEWS += [
        V(f"{fam}_1", fam, fam, den, S_SPEND, num="b", labels="B", inputs=inputs, lower_is_better=True),
        V(f"{fam}_2", f"campaigns_{fam}", fam, _camp(den, camp_ent), _camp(S_SPEND, "campaign_id", name=False),
          num="b", labels="B", nn=True, inputs=inputs, lower_is_better=True),
        V(f"{fam}_3", f"channels_{fam}", fam, _ent(den, chan_ent, nn=True), _ent(S_SPEND, "channel", nn=True),
          num="b", labels="B", nn=True, inputs=inputs, lower_is_better=True),
    ]

# ---- CTR (0906) ---------------------------------------------------------------
_I_IMPR = M("I", "count", "interaction_type", "current_impressions")
VIEWS += [
    V("ctr_1", "ctr", "ctr", _K_CLICKS, _I_IMPR, labels="C"),
    V("ctr_2", "campaigns_ctr", "ctr", _camp(_K_CLICKS, "campaign_id"), _camp(_I_IMPR, "campaign_id"),
      key="b", name_from="coalesce", nn=True, labels="C"),
    V("ctr_3", "channels_ctr", "ctr", _ent(_K_CLICKS, "click_channel", nn=True), _ent(_I_IMPR, "channel", nn=True),
      key="coalesce", nn=True, labels="C", entity_out="channel"),
]

# ---- CVR (0907) ---------------------------------------------------------------
_K_STAR = M("K", "count_star", None, "current_clicks")
_I_STAR = M("I", "count_star", None, "current_impressions")
_P_CONV = M("P", "count_distinct", "purchase_id", "current_conversions")
_L_CONV = M("L", "count_distinct", "purchase_id", "current_conversions")
_T_CONVD = M("T", "count_distinct", "purchase_id", "current_conversions")
VIEWS += [
    V("cvr_1", "cvr", "cvr", _K_STAR, _P_CONV, how="left", num="b", coalesce0=("b",), labels="C"),
    V("cvr_2", "channels_cvr", "cvr", _ent(_K_STAR, "click_channel", nn=True), _ent(_L_CONV, "channel", nn=True),
      how="left", num="b", coalesce0=("b",), labels="D", nn=True, entity_out="channel"),
    V("cvr_3", "channels_tofu_cvr", "cvr", _ent(_I_STAR, "channel"), _ent(_K_STAR, "click_channel", nn=True),
      how="left", key="b", num="b", coalesce0=("a", "b"), labels="D", nn=True, entity_out="channel"),
    V("cvr_4", "channels_bofu_cvr", "cvr", _ent(_K_STAR, "click_channel", nn=True), _ent(_T_CONVD, "last_touch_channel"),
      how="left", num="b", coalesce0=("b",), labels="D", nn=True, entity_out="channel"),
    V("cvr_5", "campaigns_cvr", "cvr", _camp(_K_STAR, "campaign_id"), _ent(_L_CONV, "campaign_id", nn=True),
      how="left", num="b", coalesce0=("b",), labels="D", nn=True),
    V("cvr_6", "campaigns_tofu_cvr", "cvr", _ent(_I_STAR, "campaign_id"), _ent(_K_STAR, "campaign_id", nn=True),
      how="left", key="b", num="b", coalesce0=("a", "b"), labels="D", nn=True),
    V("cvr_7", "campaigns_bofu_cvr", "cvr", _camp(_K_STAR, "campaign_id"), _ent(_T_CONVD, "last_touch_campaign"),
      how="left", num="b", coalesce0=("b",), labels="D", nn=True),
]

# ---- AOV (0908) ---------------------------------------------------------------
_L_ORD = M("L", "count_distinct", "purchase_id", "current_orders")
_LP_REV = M("LP", "sum", "revenue_share", "current_revenue")
_LP_ORD = M("LP", "count_distinct", "purchase_id", "current_orders")
_T_ORD = M("T", "count", "purchase_id", "current_orders")
VIEWS += [
    V("aov_1", "aov", "aov", L_REV, _L_ORD, how="inner"),
    V("aov_2", "campaigns_aov", "aov", _camp(L_REV, "campaign_id"), _ent(_L_ORD, "campaign_id", nn=True), how="inner"),
    V("aov_3", "acquisition_campaigns_aov", "aov", _camp(_LP_REV, "acquisition_campaign"),
      _ent(_LP_ORD, "acquisition_campaign", nn=True), how="inner"),
    V("aov_4", "last_touch_campaigns_aov", "aov", _camp(T_REV, "last_touch_campaign"),
      _ent(_T_ORD, "last_touch_campaign", nn=True), how="inner"),
    V("aov_5", "channels_aov", "aov", _ent(L_REV, "channel", nn=True), _ent(_L_ORD, "channel", nn=True), how="inner"),
    V("aov_6", "acquisition_channels_aov", "aov", _ent(_LP_REV, "acquisition_channel", nn=True),
      _ent(_LP_ORD, "acquisition_channel", nn=True), how="inner"),
    V("aov_7", "last_touch_channels_aov", "aov", _ent(T_REV, "last_touch_channel", nn=True),
      _ent(_T_ORD, "last_touch_channel", nn=True), how="inner"),
]

# ---- ARPU (0909) --------------------------------------------------------------
_LP_USERS = M("LP", "count_distinct", "user_id", "active_users")
_P_USERSD = M("P", "count_distinct", "user_id", "active_users")
_TP_USERS = M("TP", "count_distinct", "user_id", "active_users")
VIEWS += [
    V("arpu_1", "arpu", "arpu", L_REV, _LP_USERS, how="inner"),
    V("arpu_2", "campaigns_arpu", "arpu", _camp(L_REV, "campaign_id"), _ent(_LP_USERS, "campaign_id", nn=True),
      how="inner"),
    V("arpu_3", "acquisition_campaigns_arpu", "arpu", _camp(_LP_REV, "acquisition_campaign"),
      _ent(_P_USERSD, "acquisition_campaign", nn=True), how="inner"),
    V("arpu_4", "last_touch_campaigns_arpu", "arpu", _camp(T_REV, "last_touch_campaign"),
      _ent(_TP_USERS, "last_touch_campaign", nn=True), how="inner"),
    V("arpu_5", "channels_arpu", "arpu", _ent(L_REV, "channel", nn=True), _ent(_LP_USERS, "channel", nn=True),
      how="inner"),
    V("arpu_6", "acquisition_channels_arpu", "arpu", _ent(_LP_REV, "acquisition_channel", nn=True),
      _ent(_P_USERSD, "acquisition_channel", nn=True), how="inner"),
    V("arpu_7", "last_touch_channels_arpu", "arpu", _ent(T_REV, "last_touch_channel", nn=True),
      _ent(_TP_USERS, "last_touch_channel", nn=True), how="inner"),
]

# ---- ROI (0911) ---------------------------------------------------------------
_ROI = dict(how="inner", roi=True, labels="E", inputs=("current_profit", "current_spend"))
VIEWS += [
    V("roi_1", "roi", "roi", L_REV, S_SPEND, **_ROI),
    V("roi_2", "channels_roi", "roi", _ent(L_REV, "channel", nn=True), _ent(S_SPEND, "channel", nn=True), **_ROI),
    V("roi_3", "acquisition_channels_roi", "roi", _ent(P_REV, "acquisition_channel", nn=True),
      _ent(S_SPEND, "channel", nn=True), **_ROI),
    V("roi_4", "last_touch_channels_roi", "roi", _ent(T_REV, "last_touch_channel", nn=True),
      _ent(S_SPEND, "channel", nn=True), **_ROI),
    V("roi_5", "campaigns_roi", "roi", _camp(L_REV, "campaign_id"), _camp(S_SPEND, "campaign_id", name=False), **_ROI),
    V("roi_6", "acquisition_campaigns_roi", "roi", _camp(P_REV, "acquisition_campaign"),
      _camp(S_SPEND, "campaign_id", name=False), **_ROI),
    V("roi_7", "last_touch_campaigns_roi", "roi", _camp(T_REV, "last_touch_campaign"),
      _camp(S_SPEND, "campaign_id", name=False), **_ROI),
]

assert len(VIEWS) == 55, len(VIEWS)
BY_ID = {v.id: v for v in VIEWS}

# ============================================================================
# SQL generation (oracle) — independent of the DataFrame code above.
# ============================================================================

_SQL_SRC = {
    "P": ("fact_purchases f", "f.purchase_date"),
    "L": ("fact_attribution_linear f", "f.purchase_date"),
    "T": ("fact_attribution_last_touch f", "f.purchase_date"),
    "S": ("fact_spend f", "f.spend_date"),
    "K": ("fact_clicks f", "f.click_timestamp"),
    "Kd": ("fact_clicks f LEFT JOIN dim_date d ON f.date_key = d.date_key", None),
    "I": ("fact_touchpoints f", "f.touchpoint_time"),
    "LP": ("fact_attribution_linear f LEFT JOIN fact_purchases p ON f.purchase_id = p.purchase_id", "f.purchase_date"),
    "TP": ("fact_attribution_last_touch f LEFT JOIN fact_purchases p ON f.purchase_id = p.purchase_id",
           "p.purchase_date"),
}
_P_SIDE = {"acquisition_campaign", "acquisition_channel"}


def _qcol(m: Measure, c: str) -> str:
    if m.source in ("LP", "TP") and (c in _P_SIDE or c == "user_id"):
        return f"p.{c}"
    return f"f.{c}"


def _measure_sql(m: Measure) -> str:
    frm, date = _SQL_SRC[m.source]
    y, mo = ("d.year", "d.month") if date is None else (f"year({date})", f"month({date})")
    agg = {"sum": f"SUM({_qcol(m, m.col)})" if m.col else "",
           "count": f"COUNT({_qcol(m, m.col)})" if m.col else "",
           "count_star": "COUNT(*)",
           "count_distinct": f"COUNT(DISTINCT {_qcol(m, m.col)})" if m.col else ""}[m.agg]
    sel = [f"{y} AS performance_year", f"{mo} AS performance_month"]
    grp = [y, mo]
    where = []
    if m.source == "I":
        where.append("f.interaction_type = 'Impression'")
    if m.entity:
        e = _qcol(m, m.entity)
        sel.append(f"{e} AS {m.entity}")
        grp.append(e)
        if m.nn:
            where.append(f"{e} IS NOT NULL")
    if m.name:
        frm += f" LEFT JOIN dim_campaign c ON {_qcol(m, m.entity)} = c.campaign_id"
        sel.append("c.campaign_name")
        grp.append("c.campaign_name")
    sel.append(f"{agg} AS {m.alias}")
    w = (" WHERE " + " AND ".join(where)) if where else ""
    return f"SELECT {', '.join(sel)} FROM {frm}{w} GROUP BY {', '.join(grp)}"


def _case(expr: str, labels) -> str:
    pos, neg, zero = labels
    return f"CASE WHEN {expr} > 0 THEN '{pos}' WHEN {expr} < 0 THEN '{neg}' ELSE '{zero}' END"


def _mom_sql(src: str, ent: str | None, cur: str, names: dict, labels: str, decimal_metric: bool,
             head: list[str], where: str = "") -> str:
    avg_l, pm_l = LABELS[labels]
    part = f"PARTITION BY {ent}" if ent else ""
    ordw = f"OVER ({part} ORDER BY performance_year, performance_month)"
    md = f"CAST({cur} AS DECIMAL(38,6))"
    s_, c_ = f"SUM({md}) OVER ({part})", f"COUNT({cur}) OVER ({part})"
    # exact mean, half-up at 6 places, with integer arithmetic
    avg = (f"(CAST(CASE WHEN {s_} >= 0 THEN (CAST({s_} * 1000000 AS HUGEINT) * 2 + {c_}) // (2 * {c_}) "
           f"ELSE -((CAST(-{s_} * 1000000 AS HUGEINT) * 2 + {c_}) // (2 * {c_})) END AS DECIMAL(38,0)) "
           f"* CAST(0.000001 AS DECIMAL(7,6)))")
    diff_avg = f"({md} - {avg})"
    lag = f"LAG({cur}) {ordw}"
    diff_pm = f"({cur} - {lag})"
    pct = (f"ROUND(CASE WHEN CAST({lag} AS DOUBLE) = 0 THEN NULL ELSE "
           f"CAST({diff_pm} AS DOUBLE) / CAST({lag} AS DOUBLE) * 100 END, 2) + 0.0")
    cols = head + [cur, f"{avg} AS {names['avg']}", f"{diff_avg} AS diff_avg",
                   f"{_case(diff_avg, avg_l)} AS avg_change", f"{lag} AS {names['pm']}",
                   f"{diff_pm} AS {names['diff_pm']}", f"{_case(diff_pm, pm_l)} AS pm_change",
                   f"{pct} AS mom_percentage"]
    return f"SELECT {', '.join(cols)} FROM {src}{where}"


def _exact_ratio_sql(n: str, d: str) -> str:
    """n / d rounded half-up to 6 places with integer arithmetic (inputs
    have at most 2 decimals)."""
    nu, du = f"CAST({n} * 100 AS HUGEINT)", f"CAST({d} * 100 AS HUGEINT)"
    q = f"((2 * abs({nu}) * 1000000 + abs({du})) // (2 * abs({du})))"
    return (f"CASE WHEN {d} = 0 THEN NULL ELSE CAST(sign({nu}) * sign({du}) * {q} AS DECIMAL(38,0)) "
            f"* CAST(0.000001 AS DECIMAL(7,6)) END")


def _view_sql(v: KpiView) -> str:
    names = output_names(v)
    ent = entity_out(v)
    if v.b is None:
        head = ["performance_year", "performance_month"]
        a_sql = _measure_sql(v.a)
        if ent:
            head.append(f"{v.a.entity} AS {ent}" if v.a.entity != ent else ent)
        if v.a.name:
            head.append("campaign_name")
        src = f"(SELECT *, {v.a.alias} AS {names['cur']} FROM ({a_sql}) q) m" \
            if v.a.alias != names["cur"] else f"({a_sql}) m"
        return _mom_sql(src, v.a.entity, names["cur"], names, v.labels, True, head)

    def pick(which, col_a, col_b):
        return {"a": f"a.{col_a}", "b": f"b.{col_b}"}.get(which, f"COALESCE(a.{col_a}, b.{col_b})")

    ym = "coalesce" if v.how in ("full", "inner") else v.key
    sel = [f"{pick(ym, 'performance_year', 'performance_year')} AS performance_year",
           f"{pick(ym, 'performance_month', 'performance_month')} AS performance_month"]
    on = "a.performance_year = b.performance_year AND a.performance_month = b.performance_month"
    if v.a.entity:
        sel.append(f"{pick(v.key, v.a.entity, v.b.entity)} AS {ent}")
        on += f" AND a.{v.a.entity} = b.{v.b.entity}"
    has_name = v.a.name or v.b.name
    if has_name:
        nf = v.name_from if (v.a.name and v.b.name) else ("a" if v.a.name else "b")
        sel.append(f"{pick(nf, 'campaign_name', 'campaign_name')} AS campaign_name")
    av = f"a.{v.a.alias}" if "a" not in v.coalesce0 else f"COALESCE(a.{v.a.alias}, 0)"
    bv = f"b.{v.b.alias}" if "b" not in v.coalesce0 else f"COALESCE(b.{v.b.alias}, 0)"
    sel += [f"{av} AS {v.a.alias}", f"{bv} AS {v.b.alias}"]
    num, den = (av, bv) if v.num == "a" else (bv, av)
    if v.roi:
        sel.append(f"{num} - {den} AS current_profit")
        n_expr = f"({num} - {den})"
    else:
        n_expr = num
    sel.append(f"{_exact_ratio_sql(n_expr, den)} AS {names['cur']}")
    join = {"full": "FULL JOIN", "left": "LEFT JOIN", "inner": "INNER JOIN"}[v.how]
    metrics = (f"(SELECT {', '.join(sel)} FROM ({_measure_sql(v.a)}) a {join} ({_measure_sql(v.b)}) b "
               f"ON {on}) m")
    conds = []
    if v.nn and ent:
        conds.append(f"{ent} IS NOT NULL")
    if v.roi:
        conds.append(f"{names['cur']} IS NOT NULL")
    where = (" WHERE " + " AND ".join(conds)) if conds else ""
    inputs = list(v.inputs) if v.inputs else [v.a.alias, v.b.alias]
    head = ["performance_year", "performance_month"] + ([ent] if ent else []) + \
           (["campaign_name"] if has_name else []) + inputs
    return _mom_sql(metrics, ent, names["cur"], names, v.labels, False, head, where)


def _movers_sql(v: KpiView, by: str, best: bool) -> str:
    names = output_names(v)
    ent = entity_out(v)
    col = names["diff_pm"] if by == "diff" else "mom_percentage"
    desc = best != v.lower_is_better
    if v.labels == "A":
        where = f" WHERE {names['pm']} > 0" if by == "pct" else ""
    elif by == "diff":
        where = f" WHERE {names['diff_pm']} IS NOT NULL"
    else:
        where = f" WHERE {names['pm']} IS NOT NULL"
    o = f"{col} DESC NULLS LAST" if desc else f"{col} ASC NULLS FIRST"
    tie = ([f"{ent} ASC NULLS FIRST"] if ent else []) + ["performance_year", "performance_month"]
    return f"SELECT * FROM ({_view_sql(v)}) v{where} ORDER BY {o}, {', '.join(tie)} LIMIT {v.top}"


# ============================================================================
# registration
# ============================================================================

def _reg_view(v: KpiView):
    add(f"kpi_{v.id}_{v.view}", lambda g, v=v: kpi_view(g, v), _view_sql(v))


for _v in VIEWS:
    _reg_view(_v)

# movers (KPI-TOP-1…4): revenue & ROAS best-first; cost and rate metrics both ways
_MOVER_FAMILIES = {"rev", "roas", "cac", "cpa", "cpc", "ctr", "roi"}
for _v in VIEWS:
    fam = _v.id.split("_")[0]
    if fam not in _MOVER_FAMILIES or _v.entity is None:
        continue
    directions = (True,) if _v.labels == "A" else (True, False)
    for best in directions:
        for by in ("diff", "pct"):
            tag = "top" if best else "worst"
            add(f"kpi_top_{_v.id}_{tag}_{by}",
                lambda g, v=_v, by=by, best=best: movers(kpi_view(g, v), v, by, best),
                _movers_sql(_v, by, best))

# KPI-RPT: every view as an ordered report that carries each row's place; order values and revenue per user
# only where there were any.  The place is that of a range-partitioned sort (DIM-05), so the order is checked.
for _v in VIEWS:
    _only = {"aov": "current_orders > 0", "arpu": "active_users > 0"}.get(_v.id.split("_")[0])
    _order = [*([entity_out(_v)] if _v.entity else []), "performance_year", "performance_month"]
    if _v.entity and _v.b is not None and _v.how == "full":  # rows of the other side have no entity: their amounts tell them apart
        _order += [m.alias for m in (_v.a, _v.b)]

    def _report(g, v=_v, only=_only, order=_order):
        out = kpi_view(g, v)
        return with_dense_key(out.filter(only) if only else out, "report_row", order)

    add(f"kpi_rpt_{_v.id}", _report, f"""SELECT ROW_NUMBER() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in _order)}) AS report_row, *
        FROM ({_view_sql(_v)}) v""" + (f" WHERE {_only}" if _only else ""))


# KPI-ALL: whole-period KPIs, one aggregate per source, combined as scalars
def _kpi_all(g):
    from ..operators.measures import overall_kpis
    return overall_kpis(g)


add("kpi_all_overall", _kpi_all, """
SELECT rev AS revenue, spend, ROUND(CAST(rev AS DOUBLE) / CAST(spend AS DOUBLE), 6) AS roas,
       p_users AS new_users, ROUND(CAST(spend AS DOUBLE) / p_users, 6) AS cac,
       p_orders AS conversions, ROUND(CAST(spend AS DOUBLE) / p_orders, 6) AS cpa,
       clicks, ROUND(CAST(spend AS DOUBLE) / clicks, 6) AS cpc,
       impressions, ROUND(clicks * 1.0 / impressions, 6) AS ctr,
       orders_distinct, ROUND(orders_distinct * 1.0 / clicks, 6) AS cvr,
       lin_rev AS attributed_revenue, lin_orders, ROUND(CAST(lin_rev AS DOUBLE) / lin_orders, 6) AS aov,
       lin_users, ROUND(CAST(lin_rev AS DOUBLE) / lin_users, 6) AS arpu,
       ROUND((CAST(rev AS DOUBLE) - CAST(spend AS DOUBLE)) / CAST(spend AS DOUBLE), 6) AS roi
FROM (SELECT SUM(revenue) AS rev, COUNT(user_id) AS p_users, COUNT(purchase_id) AS p_orders,
             COUNT(DISTINCT purchase_id) AS orders_distinct FROM fact_purchases) p,
     (SELECT SUM(spend) AS spend FROM fact_spend) s,
     (SELECT COUNT(click_id) AS clicks FROM fact_clicks) k,
     (SELECT COUNT(interaction_type) AS impressions FROM fact_touchpoints WHERE interaction_type = 'Impression') i,
     (SELECT SUM(revenue_share) AS lin_rev, COUNT(DISTINCT purchase_id) AS lin_orders,
             COUNT(DISTINCT user_id) AS lin_users FROM fact_attribution_linear) l
""")

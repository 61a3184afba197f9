"""Registered queries vs their DuckDB oracle at sf0.001 (one or more per
family; the full set runs with tools/check_oracle.py)."""

import datetime as dt
import decimal
import math
import re

import pytest

import __spark_entry__ as entry

SAMPLE = [
    "dim_01_calendar", "fct_06_fact_purchases", "att_03_fact_touchpath", "att_05_fact_attribution_linear",
    "att_06_fact_attribution_last_touch", "att_07_first_touch_acquisition", "mag_9_1_linear_revenue_by_channel",
    "kpi_rev_1_revenue", "kpi_roas_2_funnel_campaigns_roas", "kpi_ctr_2_campaigns_ctr", "kpi_cvr_3_channels_tofu_cvr",
    "kpi_roi_5_campaigns_roi", "kpi_top_cac_2_top_pct", "kpi_all_overall", "mag_6_1_users_by_touchpoint_count",
    "mag_10_14_position_revenue_correlation", "mag_10_19_revenue_by_channel_campaign_label", "rnk_2_rank_top5_campaigns_revenue",
    "cum_1_running_revenue", "ltv_5_cohort_by_campaign", "fun_6_drop_off_by_stage", "mea_8_kpi_report",
    "cln_15_silver_from_dirty_feed", "prf_06_date_format_status", "dq_suite",
]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (float, decimal.Decimal, int)):
        f = float(v)
        return "nan" if math.isnan(f) else round(f, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    from conftest import SF_SMALL
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, srows) == _canon(dcols, cur.fetchall())


def test_every_query_has_oracle():
    """All have SQL but corpus queries that SQL cannot express; no SQL is without its query."""
    names, sql = set(entry.queries()), set(entry.oracle_sql())
    corpus = {n for n in names if re.match(r"op\d+_|pipeline$", n)}
    assert sql <= names and names - corpus == sql - corpus


def test_entry_smoke(spark):
    assert entry.entry(spark).count() > 0

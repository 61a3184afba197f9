"""

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS],
each query written to the ``noop`` sink; one warm-up run, then the median of
$BENCH_RUNS runs (default 3).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import StorageLevel  # noqa: E402

from touchline.plans.gold import GoldModel  # noqa: E402
from touchline.plans.registry import REGISTRY, _load_all  # noqa: E402
from touchline.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = {
    "b1_touch_path": "att_03_fact_touchpath",
    "b2_linear_by_channel": "mag_9_1_linear_revenue_by_channel",
    "b3_last_touch_by_campaign": "mag_10_2_last_touch_revenue_by_campaign",
    "b4_campaign_roas_mom": "kpi_roas_2_funnel_campaigns_roas",
    "b6_cohort_ltv_by_channel": "ltv_4_cohort_by_channel",
    "b7_kpi_report": "mea_8_kpi_report",
    "b8_silver_cleaning": "cln_15_silver_from_dirty_feed",
    "b9_drop_off_funnel": "fun_6_drop_off_by_stage",
    "b10_quality_suite": "dq_suite",
}


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn) -> float:
    fn()  # warm-up
    times = []
    for _ in range(RUNS):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    spark = build_session(master=f"local[{CPUS}]", app="touchline-bench",
                          shuffle_partitions=int(CPUS) * 2)
    _load_all()
    out: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for label, name in HEADLINE.items():
        q = REGISTRY.get(name)
        if q is None:
            continue
        try:
            out[label] = round(_timed(lambda q=q: _noop(q.build(GoldModel.from_driver(spark, SF_DIR)))), 3)
        except Exception as exc:  # keep the JSON line; report the failure
            out[label] = None
            errors[label] = str(exc).splitlines()[0][:200]

    # B5: all 55 KPI views in one session: shared facts and shared monthly
    # aggregates persisted once, views submitted concurrently (Spark runs
    # jobs from several threads side by side).
    from concurrent.futures import ThreadPoolExecutor

    from touchline.operators.kpi import kpi_view, shared_monthly
    from touchline.plans.queries_kpi import VIEWS

    def b5():
        g = GoldModel.from_driver(spark, SF_DIR)
        shared = [g.fact_purchases, g.fact_spend, g.fact_clicks, g.fact_touchpoints,
                  g.fact_attribution_linear, g.fact_attribution_last_touch, g.dim_campaign]
        for df in shared:
            df.persist(StorageLevel.MEMORY_AND_DISK)
        monthly = shared_monthly(g, VIEWS)
        try:
            with ThreadPoolExecutor(max_workers=int(CPUS)) as pool:
                list(pool.map(lambda v: _noop(kpi_view(g, v)), VIEWS))
        finally:
            for df in monthly + shared:
                df.unpersist()

    try:
        out["b5_all_kpi_views"] = round(_timed(b5), 3)
    except Exception as exc:
        out["b5_all_kpi_views"] = None
        errors["b5_all_kpi_views"] = str(exc).splitlines()[0][:200]
    total = round(sum(v for v in out.values() if v is not None), 3)
    line = {"metric": "headline_total", "value": total, "unit": "sec", "queries": out,
            "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""), "runs": RUNS, "kpi_views": 55}
    if errors:
        line["errors"] = errors
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()

"""Bronze text scan (SRC-01) → silver (CLN-15) → load jobs with audit
(SRC-02/04/05); idempotent full refresh."""

import os
import tempfile

import pytest

from touchline.sources import bronze, feeds

CAMPAIGNS = """campaign_id,campaign_name,channel,start_date,end_date,objective
1,Summer_Launch,Facebok Ads,2023-12-30,2024-02-01,CONVERSION
2,SUMMER_RETARGETING,tik_tok_ads,18/05/2024,2024-03-30,awarenss
3,Brand,,2024/04/06,not_available,TRAFFIC
"""
PURCHASES = """purchase_id,user_id,purchase_date,revenue,channel_last_touch
10,5.0,2024-01-02,20.00,Email
11,5.0,2024-01-03,-20.00,fb_ads
12,6.0,invalid,"12,34",Email
"""


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_text_scan_keeps_rest_of_line(spark):
    d = tempfile.mkdtemp(prefix="tl-bronze-")
    p = _write(d, "purchases.csv", PURCHASES)
    rows = bronze.scan_delimited(spark, p, bronze.BRONZE_FEEDS["crm_raw_purchases"]).collect()
    assert len(rows) == 3
    shifted = [r for r in rows if r.purchase_id == "12"][0]
    assert shifted.revenue == '"12' and shifted.channel_last_touch == '34",Email'


def test_silver_from_text(spark):
    d = tempfile.mkdtemp(prefix="tl-bronze-")
    p = _write(d, "campaigns.csv", CAMPAIGNS)
    rows = {r.campaign_id: r for r in feeds.silver_from_text(spark, p, "mrkt_campaigns").collect()}
    assert rows[1].campaign_name == "New_Year_Launch" and rows[1].channel == "Facebook Ads"
    assert rows[2].campaign_name == "Brand_Awareness_Q1" and str(rows[2].start_date) == "2024-05-18"
    assert rows[2].objective == "Awareness" and rows[3].objective == "Traffic"
    assert rows[3].channel is None and rows[3].end_date is None and str(rows[3].start_date) == "2024-04-06"
    p2 = _write(d, "purchases.csv", PURCHASES)
    pr = {r.purchase_id: r for r in feeds.silver_from_text(spark, p2, "crm_purchases").collect()}
    assert pr[12].revenue is None and pr[12].channel_last_touch == "Email" and pr[12].purchase_date is None
    assert str(pr[11].revenue) == "-20.00" and pr[11].channel_last_touch == "Facebook Ads" and pr[11].user_id == 5


def test_layer_jobs_idempotent(spark):
    src = tempfile.mkdtemp(prefix="tl-src-")
    root = tempfile.mkdtemp(prefix="tl-wh-")
    paths = {"mrkt_raw_campaigns": _write(src, "c.csv", CAMPAIGNS), "crm_raw_purchases": _write(src, "p.csv", PURCHASES)}
    a1 = {r.table: r.rows for r in bronze.load_bronze(spark, paths, root).collect()}
    a2 = {r.table: r.rows for r in bronze.load_bronze(spark, paths, root).collect()}
    assert a1 == a2 == {"mrkt_raw_campaigns": 3, "crm_raw_purchases": 3}
    t = spark.read.parquet(bronze.layer_path(root, "bronze", "crm_raw_purchases"))
    assert t.count() == 3


def test_streaming_landing_matches_batch(spark):
    from touchline.streaming.bronze_stream import stream_feed
    src = tempfile.mkdtemp(prefix="tl-stream-src-")
    sink = os.path.join(tempfile.mkdtemp(prefix="tl-stream-sink-"), "campaigns")
    _write(src, "c1.csv", CAMPAIGNS)
    q = stream_feed(spark, src, "mrkt_campaigns", sink)
    q.awaitTermination(120)
    got = spark.read.parquet(sink).drop("dwh_create_date", "epoch")
    batch = feeds.silver_from_text(spark, os.path.join(src, "c1.csv"), "mrkt_campaigns")
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_gold_materialize_and_reload(spark):
    from conftest import SF_SMALL
    from touchline.plans.gold import GOLD_TABLES, GoldModel
    root = tempfile.mkdtemp(prefix="tl-gold-")
    g = GoldModel.from_driver(spark, SF_SMALL)
    rows = g.materialize(root).collect()
    audit = {r.table: r.rows for r in rows if r.layer == "gold"}
    assert {r.table for r in rows if r.layer == "silver"} == set(g.silver)
    assert set(audit) == set(GOLD_TABLES) and audit["fact_touchpath"] == g.fact_touchpath.count()
    g2 = GoldModel.from_tables(spark, f"{root}/gold")
    assert g2.fact_purchases.columns == g.fact_purchases.columns
    part = GoldModel.from_tables(spark, f"{root}/gold", keep_partition_column=True).fact_purchases
    plan = part.filter("part_month = date'1996-03-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_month" in plan
    assert sorted(r.user_key for r in g2.dim_user.collect()) == list(range(1, audit["dim_user"] + 1))
    a = g.fact_attribution_linear.agg({"revenue_share": "sum"}).first()[0]
    b = g2.fact_attribution_linear.agg({"revenue_share": "sum"}).first()[0]
    assert a == b


def test_kpi_report_job_from_materialised_gold(spark):
    from conftest import SF_SMALL
    from touchline.operators.kpi import kpi_view
    from touchline.plans import jobs
    from touchline.plans.gold import GoldModel
    from touchline.plans.queries_kpi import BY_ID
    root = tempfile.mkdtemp(prefix="tl-wh-")
    jobs.build_warehouse(spark, SF_SMALL, root)
    views = [BY_ID["roas_2"], BY_ID["cvr_3"], BY_ID["arpu_4"]]
    audit = jobs.kpi_report(spark, f"{root}/gold", root, views, threads=3).collect()
    quality = {(r.check, r.table_name): r.violations for r in jobs.quality_report(spark, f"{root}/gold").collect()}
    assert quality[("dq_01_unique", "fact_purchases")] == 0 and quality[("path_gaps", "fact_touchpath")] == 0
    assert {r.table for r in audit} == {v.view for v in views}
    direct = kpi_view(GoldModel.from_driver(spark, SF_SMALL), BY_ID["roas_2"])
    written = spark.read.parquet(f"{root}/kpi/funnel_campaigns_roas")
    assert direct.exceptAll(written).count() == 0 and written.exceptAll(direct).count() == 0


def test_streaming_distinct_feed_across_batches(spark):
    """Ad spend is a DISTINCT feed: a row repeated in a later file (later
    micro-batch) is not landed twice; reruns resume from the checkpoint."""
    from touchline.streaming.bronze_stream import stream_feed
    src = tempfile.mkdtemp(prefix="tl-stream-src-")
    sink = os.path.join(tempfile.mkdtemp(prefix="tl-stream-sink-"), "spend")
    head = "date,channel,campaign_id,spend\n"
    _write(src, "a.csv", head + "2024-01-02,fb_ads,3.0,10.00USD\n2024-01-03,Email,4.0,5.00\n")
    stream_feed(spark, src, "mrkt_ad_spend", sink).awaitTermination(120)
    _write(src, "b.csv", head + "02/01/2024,FB Ads,3.0,\"10,00\"\n2024-01-04,SMS,5.0,7.00\n")
    stream_feed(spark, src, "mrkt_ad_spend", sink).awaitTermination(120)
    got = spark.read.parquet(sink).drop("dwh_create_date", "epoch", "event_day")
    assert got.count() == 3 and got.distinct().count() == 3


def test_failing_load_leaves_its_audit(spark):
    """Rows of the tables loaded before the failure and of the failure itself stay, over several runs."""
    from touchline.sources.audit import read_audit
    from touchline.sources.bronze import run_layer
    root = tempfile.mkdtemp(prefix="tl-audit-")
    good = {"a": lambda: spark.range(5), "b": lambda: spark.range(3)}

    def broken():
        raise ValueError("no such feed")

    with pytest.raises(RuntimeError, match="silver.c failed"):
        run_layer(spark, "silver", {**good, "c": broken, "d": good["a"]}, root)
    rows = {(r.table, r.rows, r.status, r.error) for r in read_audit(spark, root).collect()}
    assert rows == {("a", 5, "ok", None), ("b", 3, "ok", None), ("c", None, "failed", "no such feed")}
    run_layer(spark, "silver", good, root)
    again = read_audit(spark, root)
    assert again.count() == 5 and again.select("run").distinct().count() == 2 and again.filter("ended is null").isEmpty()


def test_layers_as_databases(spark):
    from conftest import SF_SMALL
    from touchline.plans.gold import FACT_KEYS, GOLD_TABLES, GoldModel
    from touchline.sources import catalog
    root = tempfile.mkdtemp(prefix="tl-catalog-")
    g = GoldModel.from_driver(spark, SF_SMALL)
    audit = {r.table: r.rows for r in g.materialize(root, catalog="tl").collect()}
    tables = catalog.list_tables(spark, "tl_bronze", "tl_silver", "tl_gold", rows=True).collect()
    assert {(r.table_schema, r.table_name) for r in tables} == {("tl_silver", n) for n in g.silver} | {("tl_gold", n) for n in GOLD_TABLES}
    assert {r.table_name: r.n_rows for r in tables} == audit
    columns = {(r.table_name, r.column_name) for r in catalog.list_columns(spark, "tl_gold").collect()}
    assert {(f, k) for f, (k, _) in FACT_KEYS.items()} <= columns
    for f, (k, _) in FACT_KEYS.items():  # every written fact carries keys 1..n
        got = spark.table(f"tl_gold.{f}").selectExpr(f"count(*)", f"min({k})", f"max({k})", f"count(distinct {k})").first()
        assert tuple(got) == (audit[f], 1, audit[f], audit[f])
    plain = g.fact_attribution_linear
    written = GoldModel.from_tables(spark, f"{root}/gold").fact_attribution_linear.select(*plain.columns)
    assert written.exceptAll(plain).isEmpty() and plain.exceptAll(written).isEmpty()
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE tl_{layer} CASCADE")

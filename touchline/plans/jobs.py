"""End-to-end jobs: the production path of the reference's pipeline.

``build_warehouse``  driver tables (or silver feeds) → gold parquet + audit
``kpi_report``       materialised gold → every KPI view written as a table

The report reads the gold tables once per fact: all monthly aggregates of a
fact come from one GROUPING SETS pass (``kpi.shared_monthly``), and the 55
views are submitted concurrently (they are small jobs over persisted
aggregates, so running them side by side keeps the cluster busy).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..operators.kpi import kpi_view, shared_monthly
from ..sources.bronze import load_table
from .gold import GoldModel


def build_warehouse(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Gold layer from the driver's tables; returns the audit table."""
    return GoldModel.from_driver(spark, sf_dir).materialize(root)


def kpi_report(spark: SparkSession, gold_root: str, out_root: str, views=None,
               threads: int = 8) -> DataFrame:
    """Write every KPI view under ``<out_root>/kpi/<view>``; returns the
    audit table (one row per view)."""
    from .queries_kpi import VIEWS
    views = list(views or VIEWS)
    g = GoldModel.from_tables(spark, gold_root)
    persisted = shared_monthly(g, views)
    base = out_root.rstrip("/")
    try:
        with ThreadPoolExecutor(max_workers=threads) as pool:
            rows = list(pool.map(lambda v: load_table("report", v.view, kpi_view(g, v), f"{base}/kpi/{v.view}"),
                                 views))
    finally:
        for df in persisted:
            df.unpersist()
    out = spark.createDataFrame([r.__dict__ for r in rows],
                                "layer string, table string, rows long, seconds double, status string")
    return out


def quality_report(spark: SparkSession, gold_root: str) -> DataFrame:
    """The DQ suite over the materialised gold tables (the reference runs its
    checks after loading): each check reads the written tables, so no fact is
    rebuilt from raw data.  Returns (check, table_name, violations)."""
    from .queries_quality import _suite
    return _suite(GoldModel.from_tables(spark, gold_root))

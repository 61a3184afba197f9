"""Registered queries of sources and catalog (SRC-01 … SRC-06, EXP-01, EXP-02)."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from ..sources import audit, bronze, catalog, dirty
from ..sources.driver import TABLES
from ..sources.staging import staging_path
from .queries_dq import SILVER
from .queries_quality import _RAW_SQL
from .registry import add


def _scan(g):
    """The raw ad spend as delimited text files with headers, landed and scanned (SRC-01)."""
    columns = bronze.BRONZE_FEEDS["mrkt_raw_ad_spend"]
    raw = dirty.dirty_ad_spend(g.driver.lineitem).select(*columns)
    path = staging_path(g.spark, "raw-ad-spend")
    # every file gets a header line, as exports have
    lines = raw.select(F.concat_ws(",", *columns).alias("value"))
    head = g.spark.range(1).select(F.lit(",".join(columns)).alias("value"))
    lines.unionByName(head).write.text(path)
    return bronze.scan_delimited(g.spark, path, columns)


add("src_01_text_scan", _scan, f"""SELECT {', '.join(f"NULLIF({c}, '') AS {c}" for c in bronze.BRONZE_FEEDS['mrkt_raw_ad_spend'])} FROM {_RAW_SQL}""")


def _load(g):
    """The silver layer loaded (SRC-02, SRC-05), and what its durable audit holds (SRC-04) beside the rows read back."""
    root = staging_path(g.spark, "silver-load")
    bronze.run_layer(g.spark, "silver", {n: (lambda n=n: g.silver[n]) for n in SILVER}, root)
    return audit.read_audit(g.spark, root).select("layer", "table", "rows", "status")


add("src_04_load_audit", _load, " UNION ALL ".join(f"""SELECT 'silver' AS layer, '{t}' AS "table", COUNT(*) AS "rows", 'ok' AS status FROM {t}""" for t in SILVER))


def _reload(g):
    """A second load replaces the first (SRC-02): the rows read back are those of one load."""
    path = bronze.layer_path(staging_path(g.spark, "reload"), "silver", "crm_purchases")
    for _ in range(2):
        bronze.write_table(g.silver["crm_purchases"], path)
    return g.spark.read.parquet(path)


add("src_02_full_refresh", _reload, "SELECT * FROM crm_purchases")


def _database(g) -> str:
    """The given tables registered in a database of their folder's own."""
    name = f"touchline_source_{zlib.crc32(g.driver.sf_dir.encode()):08x}"
    catalog.create_database(g.spark, name, staging_path(g.spark, "source-database"))
    for t in TABLES:
        catalog.register_table(g.spark, name, t, f"{g.driver.sf_dir}/{t}.parquet")
    return name


_IN = ", ".join(f"'{t}'" for t in TABLES)
add("exp_1_tables", lambda g: catalog.list_tables(g.spark, _database(g), rows=True).select("table_name", "n_columns", "n_rows"), " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT CAST(COUNT(DISTINCT column_name) AS INTEGER) FROM information_schema.columns WHERE table_name = '{t}') AS n_columns, "
    f"(SELECT COUNT(*) FROM {t}) AS n_rows" for t in TABLES))
add("exp_2_columns", lambda g: catalog.list_columns(g.spark, _database(g)).select("table_name", "ordinal_position", "column_name"),
    f"SELECT DISTINCT table_name, CAST(ordinal_position AS INTEGER) AS ordinal_position, column_name FROM information_schema.columns WHERE table_name IN ({_IN})")

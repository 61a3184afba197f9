"""SRC-04: the durable load audit, an append-only table beside the layers.

One row per attempted table load, appended as soon as the load ends, also when
it fails, so what a broken run had done stays on record.  Appending writes one
new file under ``<root>/audit``; rows are never rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AUDIT = "run string, layer string, table string, rows long, seconds double, status string, error string, ended timestamp"


def audit_path(root: str) -> str:
    return f"{root.rstrip('/')}/audit"


def append_audit(spark: SparkSession, root: str, run: str, layer: str, table: str, rows: int | None, seconds: float,
                 status: str, error: str | None = None) -> None:
    import datetime

    row = (run, layer, table, rows, seconds, status, error, datetime.datetime.now())
    spark.createDataFrame([row], AUDIT).coalesce(1).write.mode("append").parquet(audit_path(root))


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """All rows so far, of every run."""
    return spark.read.schema(AUDIT).parquet(audit_path(root))

"""SRC-06, EXP-01 and EXP-02: the layers as catalog databases, and what they hold.

Tables are registered by their place on shared storage (external tables), so
dropping a name drops no data.  A database's own place is given as well: nothing
is written to a folder of the driver alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bronze import LAYERS, layer_path


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION '{location}'")


def create_layers(spark: SparkSession, prefix: str, root: str) -> list[str]:
    """One database per layer: ``<prefix>_bronze``, ``_silver`` and ``_gold``; their names."""
    names = [f"{prefix}_{layer}" for layer in LAYERS]
    for name, layer in zip(names, LAYERS):
        create_database(spark, name, layer_path(root, layer))
    return names


def register_table(spark: SparkSession, database: str, table: str, path: str) -> None:
    """The Parquet files at ``path`` as ``database.table``; an earlier entry of that name is replaced."""
    name = f"{_quoted(database)}.{_quoted(table)}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def list_tables(spark: SparkSession, *databases: str, rows: bool = False) -> DataFrame:
    """EXP-01: (table_schema, table_name, n_columns[, n_rows]) of the catalog's tables; ``rows`` counts them,
    in one job over all tables."""
    out = None
    for database in databases:
        for t in sorted(x.name for x in spark.catalog.listTables(database)):
            df = spark.table(f"{_quoted(database)}.{_quoted(t)}")
            one = df.agg(F.count(F.lit(1)).alias("n_rows")) if rows else spark.range(1)
            one = one.select(F.lit(database).alias("table_schema"), F.lit(t).alias("table_name"), F.lit(len(df.columns)).alias("n_columns"),
                             *(["n_rows"] if rows else []))
            out = one if out is None else out.unionByName(one)
    if out is None:
        return spark.createDataFrame([], "table_schema string, table_name string, n_columns int" + ", n_rows long" * rows)
    return out


def list_columns(spark: SparkSession, *databases: str) -> DataFrame:
    """EXP-02: (table_schema, table_name, ordinal_position, column_name, data_type, is_nullable) of every column."""
    found = [(d, t.name, i + 1, f.name, f.dataType.simpleString(), f.nullable) for d in databases for t in spark.catalog.listTables(d)
             for i, f in enumerate(spark.table(f"{_quoted(d)}.{_quoted(t.name)}").schema.fields)]
    return spark.createDataFrame(found, "table_schema string, table_name string, ordinal_position int, column_name string, data_type string, is_nullable boolean")

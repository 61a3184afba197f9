"""Shared-folder tables, size-checked broadcasts and text helpers of the corpus operators.

Intermediate results that are read twice are written as Parquet tables under
the folder the cluster names in ``spark.checkpoint.dir``: that cuts lineage,
survives lost executors and freezes values that a re-run could change.
"""

from __future__ import annotations

import os
import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import ensure_checkpoint_dir

#: Rows up to which a side may be broadcast; callers keep such rows under 64 bytes (6.4 MB).
BROADCAST_ROWS = 100_000
#: Bytes of one Arrow batch sent to a Python worker.
BATCH_BYTES = 8 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name on shared storage."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/touchline-{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to shared storage and read back."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder made by :func:`scratch` that nothing reads any more."""
    if "touchline-" not in path.rsplit("/", 1)[-1]:
        raise ValueError(f"not a scratch folder: {path}")
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def broadcast_if_small(stored: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``stored`` (a stored, narrow table) with a broadcast hint if it has ``rows`` rows at
    most; beyond that the planner shuffles it."""
    return F.broadcast(stored) if stored.count() <= rows else stored


def python_tasks(spark: SparkSession) -> None:
    """Prepare a session for Python tasks: Arrow batches bounded by bytes, as texts can be very
    long, and this package's place on the workers' path (local runs from any folder)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def release() -> None:
    """Give the memory of passed batches back to the system: Python workers outlive their tasks, and
    what each stage has left in them would add up."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column name as it must be written where dots would mean fields."""
    return "`" + name.replace("`", "``") + "`"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character kept."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)

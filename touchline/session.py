"""SparkSession construction with the settings every job here relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "touchline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with this library's SQL settings.

    ``master`` and driver memory are set only when asked for (argument or
    ``TOUCHLINE_MASTER`` / ``TOUCHLINE_DRIVER_MEM``), because values set in
    code beat those of spark-submit; without either, Spark's own
    configuration decides and a plain local run gets ``local[*]``."""
    b = SparkSession.builder.appName(app)
    master = master or os.environ.get("TOUCHLINE_MASTER")
    if master is None and not _submitted():
        master = "local[*]"
    if master:
        b = b.master(master)
    memory = os.environ.get("TOUCHLINE_DRIVER_MEM") or (
        "8g" if master and master.startswith("local") else None)
    if memory:
        b = b.config("spark.driver.memory", memory)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if is_local(spark) or _configured(spark):
        ensure_checkpoint_dir(spark)
    return spark


def _submitted() -> bool:
    """True inside spark-submit or a shell, which bring their own master."""
    return "PYSPARK_GATEWAY_PORT" in os.environ or bool(os.environ.get("SPARK_MASTER"))


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process, so they share every folder."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def _configured(spark: SparkSession) -> str | None:
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is absent a scratch folder is made in local mode only
    (tests); on a cluster a machine-local folder would lose data, so the
    call raises instead."""
    sc = spark.sparkContext
    conf_dir = _configured(spark)
    if conf_dir:
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="touchline-ckpt-")
    sc.setCheckpointDir(local)
    return local

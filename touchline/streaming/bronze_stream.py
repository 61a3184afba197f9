"""Incremental bronze → silver landing with Structured Streaming.

The reference loads by full refresh only; this module runs the *same*
operators (SRC-01 text split, CLN-15 feed spec, CLN-14 audit column) over
files as they arrive, so a feed folder can be landed continuously:

    readStream.text(folder) → split_lines → to_silver → writeStream.parquet

The checkpoint lives under the cluster's shared ``spark.checkpoint.dir``
(never a machine-local folder), so a restarted query resumes exactly once.
Each micro-batch is written to its own ``epoch=<id>`` folder and
overwritten if the batch is replayed after a failure, so the output is
exactly-once.  Feeds whose silver step is a DISTINCT (ad spend, touchpoints) are
de-duplicated per micro-batch inside ``foreachBatch`` by an anti join
against the rows already landed for the batch's own event days (the sink is
partitioned by event day, so the cost follows the batch, not the history);
the sink stays equal to the batch result without unbounded streaming state.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_checkpoint_dir
from ..sources.bronze import BRONZE_FEEDS, split_lines
from ..sources.feeds import specs, to_silver


#: Partition column of a de-duplicated sink.
DAY = "event_day"


def stream_feed(spark: SparkSession, source_dir: str, feed: str, sink_dir: str,
                trigger_once: bool = True, **spec_kw) -> StreamingQuery:
    """Start a streaming load of one silver feed from a folder of text files."""
    bronze_table, spec, distinct = specs(**spec_kw)[feed]
    lines = spark.readStream.format("text").load(source_dir)
    bronze = split_lines(lines, BRONZE_FEEDS[bronze_table])
    tag = hashlib.sha1(sink_dir.encode()).hexdigest()[:12]
    checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{feed}-{tag}"

    def land(batch: DataFrame, epoch_id: int) -> None:
        out = to_silver(batch, spec, distinct=False, audit=False)
        if distinct:
            out = out.distinct()
            if _exists(spark, sink_dir):
                # only the event days of this batch are read back: at most one per calendar day
                days = [r[0] for r in out.select(_day(out)).distinct().collect()]
                at = F.col(DAY)
                same = at.isin([d for d in days if d is not None]) | (at.isNull() if None in days else F.lit(False))
                landed = (spark.read.schema(_landed(out)).parquet(sink_dir)
                          .filter((F.col("epoch") != epoch_id) & same).select(*out.columns))
                cond = reduce(lambda x, y: x & y, [out[c].eqNullSafe(landed[c]) for c in out.columns])
                out = out.join(landed, cond, "left_anti")
        # one folder per micro-batch, overwritten on replay: exactly-once output
        stamped = out.withColumn("dwh_create_date", F.current_timestamp())
        if distinct:
            stamped = stamped.withColumn(DAY, _day(out))
        (stamped.write.mode("overwrite").partitionBy(*([DAY] if distinct else [])).parquet(f"{sink_dir.rstrip('/')}/epoch={epoch_id}"))

    w = bronze.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
    return w.start()


def _day(out: DataFrame):
    """The event day of a feed's rows: its first date or time column, as text."""
    for f in out.schema.fields:
        if f.dataType.typeName() in ("date", "timestamp", "timestamp_ntz"):
            return F.to_date(f.name).cast("string").alias(DAY)
    return F.lit("none").alias(DAY)


def _landed(out: DataFrame):
    from pyspark.sql import types as T

    return T.StructType([*out.schema.fields, T.StructField("epoch", T.LongType()), T.StructField(DAY, T.StringType())])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

"""Extendible hashing: shards under a byte limit (DataFrame functions only).

Every row gets a 60-bit key, the leading bits of md5 over its id and its
text's md5.  The directory starts with enough leading bits for the whole
table; only buckets above the limit split on further bits, round by round,
until every shard fits.  Rounds after the first read only the rows of
oversized buckets.  Nothing but a per-round "is anything left" count reaches
the driver.

Defined results: a null text has 0 bytes; null ids form their own key; rows
equal in id and text have equal keys and stay together, so a shard that
exceeds the limit at all 60 bits is kept whole and flagged ``overflow`` (also
a single document above the limit); an empty table gives no rows; other
columns of the input are not touched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh, store

BITS = 60
#: Bits added for the buckets that are still too large after a round.
STEP = 8


def hash_key(id_col: str, text_col: str) -> Column:
    """The leading 60 bits of md5(id ':' md5(text))."""
    joined = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"),
                      F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    return F.conv(F.substring(F.md5(joined), 1, BITS // 4), 16, 10).cast("long")


def prefix(key: Column, depth) -> Column:
    """The first ``depth`` bits of a key, as a number."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.expr("1L").cast("long") * F.call_function("shiftright", key, (F.lit(BITS) - depth).cast("int"))


def bits(number: Column, depth: Column) -> Column:
    """A prefix as text of 0 and 1; depth 0 is the empty text."""
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.conv(number.cast("string"), 10, 2), depth, "0"))


def shard(docs: DataFrame, limit_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_bytes, shard (prefix bits), depth, shard_bytes,
    shard_rows, overflow."""
    rows = store(docs.select(F.col(id_col).alias("__id"),
                             F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("__size"),
                             hash_key(id_col, text_col).alias("__key")), "shard-keys")
    total = rows.agg(F.sum("__size")).first()[0] or 0
    done, low = [], 0
    high = min(BITS, max(1, math.ceil(math.log2(max(1, total / limit_bytes))) + 3))
    while True:
        cells = _leaves(rows, limit_bytes, low, high)
        placed = rows.withColumn("__slot", prefix(F.col("__key"), high)).join(cells, "__slot")
        done.append(placed.filter(F.col("__depth").isNotNull()))
        if high == BITS:
            break
        rest = store(placed.filter(F.col("__depth").isNull()).select("__id", "__size", "__key"), "shard-rest")
        if rest.isEmpty():
            break
        rows, low, high = rest, high, min(BITS, high + STEP)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(F.col("__id").alias(id_col), F.col("__size").alias("n_bytes"),
                      bits(prefix(F.col("__key"), F.col("__depth")), F.col("__depth")).alias("shard"),
                      F.col("__depth").cast("int").alias("depth"), F.col("__bytes").alias("shard_bytes"),
                      F.col("__rows").alias("shard_rows"), (F.col("__bytes") > limit_bytes).alias("overflow"))


def _leaves(rows: DataFrame, limit: int, low: int, high: int) -> DataFrame:
    """The directory of one round: for each used slot of ``high`` bits the depth, bytes and
    rows of the bucket it points to (nulls: still too large).  The histogram has at most one
    row per used slot, whatever the number of rows."""
    hist = (rows.groupBy(prefix(F.col("__key"), high).alias("__slot"))
            .agg(F.sum("__size").alias("__b"), F.count(F.lit(1)).alias("__n")))
    levels = (hist.withColumn("__d", F.explode(F.sequence(F.lit(low), F.lit(high))))
              .withColumn("__p", F.call_function("shiftright", F.col("__slot"), (F.lit(high) - F.col("__d")).cast("int"))))
    sums = levels.groupBy("__d", "__p").agg(F.sum("__b").alias("__bytes"), F.sum("__n").alias("__rows"))
    fits = (F.col("__bytes") <= limit) | (F.col("__d") == BITS)
    best = (levels.select("__slot", "__d", "__p").join(sums, ["__d", "__p"]).filter(fits)
            .groupBy("__slot").agg(F.min(F.struct("__d", "__bytes", "__rows")).alias("__leaf")))
    return (hist.select("__slot").join(best, "__slot", "left")
            .select("__slot", F.col("__leaf.__d").alias("__depth"), F.col("__leaf.__bytes").alias("__bytes"),
                    F.col("__leaf.__rows").alias("__rows")))


def write_shards(docs: DataFrame, path: str, limit_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """``docs`` with all columns, one folder per shard.  Rows are assigned by their own key, so a
    repeated id goes where each of its texts belongs."""
    key, pre, place = fresh(docs, "__key"), fresh(docs, "__prefix"), fresh(docs, "__shard")
    marked = docs.withColumn(key, hash_key(id_col, text_col))
    shards = (shard(docs, limit_bytes, id_col, text_col).select("shard", "depth").distinct()
              .withColumn(pre, F.when(F.col("shard") == "", F.lit("0")).otherwise(F.conv("shard", 2, 10)).cast("long")))
    out = None
    # at most one pass per depth; a hash's depths differ by few
    for d in [r[0] for r in shards.select("depth").distinct().collect()]:
        one = shards.filter(F.col("depth") == d).select(pre, F.col("shard").alias(place))
        part = marked.withColumn(pre, prefix(F.col(key), int(d))).join(one, pre).drop(pre, key)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.withColumn(place, F.lit("")).limit(0)
    out.repartition(place).write.mode("overwrite").partitionBy(place).parquet(path)


def oracle(limit_bytes: int) -> str:
    return f"""
WITH k AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
levels AS (SELECT k.*, d, h // (1::BIGINT << (60 - d)) AS p FROM k, range(0, 33) t(d)),
cells AS (SELECT d, p, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM levels GROUP BY d, p),
leaf AS (SELECT l.doc_id, l.h, l.n_bytes, min(l.d) AS d
         FROM levels l JOIN cells c ON l.d = c.d AND l.p = c.p
         WHERE c.shard_bytes <= {limit_bytes} OR l.d = 32 GROUP BY ALL)
SELECT leaf.doc_id, leaf.n_bytes,
       CASE WHEN leaf.d = 0 THEN '' ELSE right(format('{{:032b}}', c.p), leaf.d::INT) END AS shard,
       leaf.d::INTEGER AS depth, c.shard_bytes, c.shard_rows, c.shard_bytes > {limit_bytes} AS overflow
FROM leaf JOIN cells c ON leaf.d = c.d AND leaf.h // (1::BIGINT << (60 - leaf.d)) = c.p"""

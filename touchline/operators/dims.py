"""Gold dimensions (DIM-01 … DIM-05)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import date_key, us_week
from ..sources.staging import staged

#: Dates that a calendar derived from data can hold.
CALENDAR_LIMITS = ("1900-01-01", "2199-12-31")
_MID_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def with_dense_key(df: DataFrame, key: str, order: list[str] | None = None, carry: list[str] | None = None) -> DataFrame:
    """DIM-05: dense surrogate key 1..n following ``order`` without a
    single-partition window; without ``order`` rows are numbered as they are
    produced, with neither sort nor shuffle.  ``carry`` names the columns that
    are wanted beside the key (default: all); others are not staged.

    Rows are range-partitioned on ``order`` (sampled bounds split large key
    ranges over many tasks), sorted and numbered inside each partition, and
    staged once as a table together with their partition: the range exchange
    samples its bounds anew each time it is planned, so it is never evaluated
    twice.  Counts and keys both come from that table.  The offsets have one
    row per partition, so they are bounded by the partition count and
    broadcast safely.  With a unique ``order`` the result equals
    ``row_number() OVER (ORDER BY order)``."""
    cols = df.columns if carry is None else carry
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    ranged = staged(rows.select(*cols, F.monotonically_increasing_id().alias("_mid")), f"keys-{key}")
    part = F.shiftright("_mid", _MID_BITS)
    counts = ranged.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << _MID_BITS) - 1))
    return (ranged.join(F.broadcast(offsets), part == F.col("_pid"))
            .select((F.col("_off") + local + 1).cast("long").alias(key), *cols))


def calendar_bounds(*dated: tuple[DataFrame, str]) -> tuple:
    """Whole years covering every event date of the given (frame, column)
    pairs: (Jan 1 of the first year, Dec 31 of the last year), as scalar
    subqueries (one aggregate per frame, no join).  Dates outside
    ``CALENDAR_LIMITS`` are read as errors and stretch nothing, so the
    calendar has 110,000 rows at most and may be broadcast."""
    lo_, hi_ = (F.lit(d).cast("date") for d in CALENDAR_LIMITS)
    inside = lambda c: F.when(F.to_date(c).between(lo_, hi_), F.to_date(c))
    los = [df.agg(F.min(inside(c))).scalar() for df, c in dated]
    his = [df.agg(F.max(inside(c))).scalar() for df, c in dated]
    lo = los[0] if len(los) == 1 else F.least(*los)
    hi = his[0] if len(his) == 1 else F.greatest(*his)
    return F.trunc(lo, "YEAR"), F.make_date(F.year(hi), F.lit(12), F.lit(31))


def dim_date(spark: SparkSession, start, end) -> DataFrame:
    """DIM-01: calendar from ``start`` to ``end`` inclusive (one row per day).

    ``start``/``end`` are dates (text) or Columns (e.g. ``calendar_bounds``
    over the facts).  The range is bounded by the calendar, not by the data
    volume (one row per day)."""
    s = F.lit(start).cast("date") if isinstance(start, str) else start
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    days = spark.range(1).select(F.explode(F.sequence(s, e)).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"), d,
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        us_week(d).alias("week"), F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.when(F.dayofweek(d).isin(1, 7), 1).otherwise(0).alias("is_weekend"))


def dim_user(*user_sources: DataFrame, user_col: str = "user_id") -> DataFrame:
    """DIM-02: distinct non-NULL users over all feeds (partial dedupe map-side)."""
    u = None
    for s in user_sources:
        part = s.select(F.col(user_col).alias("user_id")).filter(F.col("user_id").isNotNull())
        u = part if u is None else u.unionByName(part)
    return u.distinct()


def dim_campaign(campaigns: DataFrame) -> DataFrame:
    """DIM-03."""
    return campaigns.select("campaign_id", "campaign_name", "channel",
                            "start_date", "end_date", "objective")


def dim_channel(channels: DataFrame) -> DataFrame:
    """DIM-04."""
    return channels.select("channel_name", "category")

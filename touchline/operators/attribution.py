"""Journeys and attribution (ATT-01 … ATT-07).

The touch path pairs every touch of a user with each of the user's
purchases on a later day (``touchpoint_time < purchase_date``: same-day
touches are excluded because a timestamp is compared with the date's
midnight) and numbers the touches of each path by time with the total
tie-break (channel, campaign_id, interaction_type).

Two plans are provided (``attribution_facts(method=...)``):

* ``"rank"`` (default): a touch's number in any path is its rank among all
  of the user's touches, so touches are ranked once (``rank_touches``, two
  levels: inside (user, day), plus per-day offsets); path lengths come from
  per-day kept counts, the last touch from an equi-join on (user, rank).
  Path rows are produced by one join and never sorted or re-shuffled, and
  no group ever holds a whole path.
* ``"window"``: numbering, path length and last touch are windows over
  (user, salt, purchase) — the direct formulation, one shuffle of each
  input plus an in-task sort of path rows.

Hot users.  A user's path has up to touches x purchases rows.  Both numbers
come from per-user counts (partial aggregates); a user whose product exceeds
``rows_per_task`` is salted: the purchases are spread over as many buckets as
the product needs (at most one per purchase) and the touches replicated into
each, so that path rows are built by many tasks.  There is no limit on the
number of salted users or buckets, and the planner broadcasts their table
only while it is small.  The salt is a function of the purchase, so
per-purchase results are unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged
from .dims import with_dense_key

TIE_BREAK = ("channel", "campaign_id", "interaction_type")


#: Path rows that one (user, salt) group builds at most, on average.
ROWS_PER_TASK = 1_000_000


def _salts(touch_counts: DataFrame, purchases: DataFrame, rows_per_task: int) -> DataFrame:
    """(_hot_user, _salts > 1) from (_u, _n) touch counts and purchases by _p_user."""
    bought = purchases.groupBy("_p_user").agg(F.count(F.lit(1)).alias("_np"))
    need = F.ceil(F.col("_n").cast("double") * F.col("_np") / rows_per_task)
    return (touch_counts.join(bought, F.col("_u") == F.col("_p_user"))
            .select(F.col("_u").alias("_hot_user"), F.least(need, F.col("_np")).cast("int").alias("_salts"))
            .filter("_salts > 1"))


def _salted(touches: DataFrame, purchases: DataFrame, hot: DataFrame, user: str, purchase: str) -> tuple[DataFrame, DataFrame]:
    """Touches replicated into their user's buckets (_salt), purchases dealt to one (_p_salt)."""
    t = (touches.join(hot, F.col(user) == F.col("_hot_user"), "left")
         .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
         .drop("_hot_user", "_salts"))
    p = (purchases.join(hot, F.col("_p_user") == F.col("_hot_user"), "left")
         .withColumn("_p_salt", F.pmod(F.xxhash64(purchase), F.coalesce("_salts", F.lit(1))).cast("int"))
         .drop("_hot_user", "_salts"))
    return t, p


def touch_path(touches: DataFrame, purchases: DataFrame, *, user: str = "user_id",
               time: str = "touchpoint_time", purchase: str = "purchase_id",
               purchase_date: str = "purchase_date", tie_break=TIE_BREAK,
               purchase_cols=(), rows_per_task: int | None = ROWS_PER_TASK,
               keep_salt: bool = False) -> DataFrame:
    """ATT-01 + ATT-02 + ATT-03 (``fact_touchpath``).

    Returns (user_id, purchase_id, touchpoint_number, touchpoint_time, channel,
    campaign_id, interaction_type, *purchase_cols) — one row per touch of the
    user strictly before each purchase date, numbered 1..n per purchase.
    Rows with a NULL channel / interaction are dropped after numbering, as in
    the reference."""
    t = touches.filter(F.col(user).isNotNull() & F.col(time).isNotNull())
    extra = [c for c in purchase_cols if c not in (purchase, purchase_date)]
    p = (purchases.filter(F.col(user).isNotNull() & F.col(purchase_date).isNotNull())
         .select(F.col(user).alias("_p_user"), purchase, purchase_date, *extra))

    if rows_per_task:
        counts = t.groupBy(F.col(user).alias("_u")).agg(F.count(F.lit(1)).alias("_n"))
        t, p = _salted(t, p, _salts(counts, p, rows_per_task), user, purchase)
    else:
        t, p = t.withColumn("_salt", F.lit(0)), p.withColumn("_p_salt", F.lit(0))
    cond = ((F.col(user) == F.col("_p_user")) & (F.col("_salt") == F.col("_p_salt"))
            & (F.col(time) < F.col(purchase_date)))
    joined = t.join(p, cond, "inner")
    order = [F.col(time).asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in tie_break]
    w = Window.partitionBy(user, "_salt", purchase).orderBy(*order)
    path = (joined.withColumn("touchpoint_number", F.row_number().over(w))
            .filter(F.col("interaction_type").isNotNull() & F.col("channel").isNotNull()))
    cols = [user, purchase, "touchpoint_number", time, "channel", "campaign_id", "interaction_type",
            *[c for c in purchase_cols if c != purchase]]
    return path.select(*cols, *(["_salt"] if keep_salt else []))


def _path_windows(path: DataFrame, user: str, purchase: str) -> DataFrame:
    w = Window.partitionBy(user, "_salt", purchase)
    return (path.withColumn("touchpoints_in_path", F.count(F.lit(1)).over(w).cast("int"))
            .withColumn("_last_number", F.max("touchpoint_number").over(w)))


def attribution_facts(touches: DataFrame, purchases: DataFrame, method: str = "rank",
                      **kw) -> dict[str, DataFrame]:
    """ATT-03/04/05/06 from one path plan.

    ``method="rank"`` (default) numbers touches once per user and never
    sorts path rows (see ``rank_touches``); ``method="window"`` numbers each
    (user, purchase) path with a window — the direct formulation, kept as
    the reference implementation the rank plan is tested against.

    ``purchases`` must carry (purchase_id, user_id, purchase_date, revenue)
    with ``purchase_id`` unique (checked by DQ-01), so the revenue of the
    purchase fact can ride along the path join instead of a second join."""
    if method == "rank":
        return _attribution_by_rank(touches, purchases, **kw)
    path = touch_path(touches, purchases, purchase_cols=("revenue", "purchase_date"), keep_salt=True, **kw)
    touchpath = touchpath_from_path(path)
    pw = _path_windows(path, "user_id", "purchase_id")
    linear = linear_from_path(pw)
    last = last_touch_from_path(pw)
    return {"fact_touchpath": touchpath, "fact_attribution_linear": linear,
            "fact_attribution_last_touch": last}


def rank_touches(touches: DataFrame, user: str = "user_id", time: str = "touchpoint_time",
                 tie_break=TIE_BREAK, bucket: str = "hour") -> tuple[DataFrame, DataFrame]:
    """Rank every touch within its user, in two levels.

    A touch's number in any purchase path equals its rank among all of the
    user's touches (a path is the prefix of the user's time-ordered touches
    before the purchase day), so the number is computed once per touch:

    * ``row_number`` inside (user, hour) — a user's touches are spread over
      as many groups as they have active hours (``bucket="day"``: days);
    * per-bucket counts (a partial aggregate) and their running sum over the
      user's buckets (at most 24 rows per day of the calendar) give each
      bucket's offset;
    * rank = offset + local number; ``_rank_kept`` does the same for the
      touches that survive the path filters (channel and interaction set),
      whose rank is the path length at that touch.

    ``bucket="range"`` is ``rank_by_range``: no group but a range partition.

    Returns (ranked touches, per-(user, day) kept counts)."""
    if bucket == "range":
        return rank_by_range(touches, user, time, tie_break)
    kept = (F.col("channel").isNotNull() & F.col("interaction_type").isNotNull()).cast("int")
    t = touches.filter(F.col(user).isNotNull() & F.col(time).isNotNull())
    t = t.withColumn("_bucket", F.date_trunc("hour", time) if bucket == "hour" else F.to_date(time)).filter("_bucket is not null")
    order = [F.col(time).asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in tie_break]
    w = Window.partitionBy(user, "_bucket").orderBy(*order)
    # what follows from a touch's own columns is added behind the exchange
    t = (t.withColumn("_local", F.row_number().over(w))
         .withColumn("_local_kept", F.sum(kept).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
         .withColumn("_day", F.to_date(time)).withColumn("_kept", kept))
    # a bucket's counts are its last numbers: both sides of the join below read one exchange of the touches
    groups = t.groupBy(user, "_bucket", "_day").agg(F.max("_local").cast("long").alias("_n"), F.max("_local_kept").alias("_nk"))
    before = Window.partitionBy(user).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select(F.col(user).alias("_o_user"), F.col("_bucket").alias("_o_bucket"),
                            F.col("_day").alias("_o_day"), "_nk",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                            F.coalesce(F.sum("_nk").over(before), F.lit(0)).alias("_off_kept"))
    ranked = (t.join(offsets.drop("_o_day", "_nk"),
                     (F.col(user) == F.col("_o_user")) & (F.col("_bucket") == F.col("_o_bucket")))
              .withColumn("touchpoint_number", (F.col("_off") + F.col("_local")).cast("int"))
              .withColumn("_rank_kept", (F.col("_off_kept") + F.col("_local_kept")).cast("int"))
              .drop("_o_user", "_o_bucket", "_bucket", "_off", "_off_kept", "_local", "_local_kept"))
    daily = offsets if bucket == "day" else (
        offsets.groupBy("_o_user", "_o_day").agg(F.sum("_nk").alias("_nk")))
    daily_kept = daily.select("_o_user", "_o_day", "_nk").filter(F.col("_nk") > 0)
    return ranked, daily_kept


def rank_by_range(touches: DataFrame, user: str = "user_id", time: str = "touchpoint_time",
                  tie_break=TIE_BREAK) -> tuple[DataFrame, DataFrame]:
    """``rank_touches`` for any distribution: a user's touches of one hour may span many tasks.

    All touches are range-partitioned on (user, time, tie-break), so bounds may
    fall inside a user and inside an hour, and staged once with their place (the
    range exchange samples anew whenever it is planned).  A touch's number is its
    number inside (partition, user), plus the user's touches in earlier
    partitions.  Only a partition's first user can have such, so the offsets
    have one row per partition at most and are broadcast.  Touches that tie in
    all of (user, time, tie-break) are numbered in either order."""
    kept = (F.col("channel").isNotNull() & F.col("interaction_type").isNotNull()).cast("int")
    order = [user, time, *tie_break]
    t = (touches.filter(F.col(user).isNotNull() & F.col(time).isNotNull())
         .withColumn("_day", F.to_date(time)).withColumn("_kept", kept))
    ranged = staged(t.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_mid", F.monotonically_increasing_id()), "touch-ranges")
    ranged = ranged.withColumn("_part", F.shiftright("_mid", 33))
    w = Window.partitionBy("_part", user).orderBy("_mid")
    numbered = (ranged.withColumn("_local", F.row_number().over(w))
                .withColumn("_local_kept", F.sum("_kept").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    before = Window.partitionBy(user).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(user, "_part").agg(F.count(F.lit(1)).alias("_n"), F.sum("_kept").alias("_nk"))
               .select(F.col(user).alias("_o_user"), F.col("_part").alias("_o_part"),
                       F.sum("_n").over(before).alias("_off"), F.sum("_nk").over(before).alias("_off_kept"))
               .filter("_off > 0"))
    off = lambda c: F.coalesce(c, F.lit(0))
    ranked = (numbered.join(F.broadcast(offsets), (F.col(user) == F.col("_o_user")) & (F.col("_part") == F.col("_o_part")), "left")
              .withColumn("touchpoint_number", (off("_off") + F.col("_local")).cast("int"))
              .withColumn("_rank_kept", (off("_off_kept") + F.col("_local_kept")).cast("int"))
              .drop("_o_user", "_o_part", "_part", "_mid", "_off", "_off_kept", "_local", "_local_kept"))
    daily = (ranged.groupBy(F.col(user).alias("_o_user"), F.col("_day").alias("_o_day"))
             .agg(F.sum("_kept").alias("_nk")).filter(F.col("_nk") > 0))
    return ranked, daily


def _lengths(daily: DataFrame, purchases: DataFrame) -> DataFrame:
    """(_l_user, _l_date, touchpoints_in_path): the kept touches of a user before each purchase day.
    Purchase days join the user's sequence of active days with a count of 0 and a running sum
    passes over it: one row per user and day, no touches x purchases join."""
    days = (daily.select(F.col("_o_user").alias("_l_user"), F.col("_o_day").alias("_l_date"), "_nk")
            .withColumn("_bought", F.lit(False))
            .unionByName(purchases.select(F.col("_p_user").alias("_l_user"), F.col("purchase_date").alias("_l_date"),
                                          F.lit(0).cast("long").alias("_nk"), F.lit(True).alias("_bought")))
            .groupBy("_l_user", "_l_date").agg(F.sum("_nk").alias("_nk"), F.bool_or("_bought").alias("_bought")))
    before = Window.partitionBy("_l_user").orderBy("_l_date").rowsBetween(Window.unboundedPreceding, -1)
    return (days.withColumn("touchpoints_in_path", F.sum("_nk").over(before).cast("int"))
            .filter("_bought and touchpoints_in_path > 0").drop("_nk", "_bought"))


def path_length_per_purchase(touches: DataFrame, purchases: DataFrame) -> DataFrame:
    """ATT-04 without path rows: (purchase_id, touchpoints_in_path) from daily counts."""
    kept = touches.filter(F.col("user_id").isNotNull() & F.col("touchpoint_time").isNotNull()
                          & F.col("channel").isNotNull() & F.col("interaction_type").isNotNull())
    daily = (kept.groupBy(F.col("user_id").alias("_o_user"), F.to_date("touchpoint_time").alias("_o_day"))
             .agg(F.count(F.lit(1)).alias("_nk")))
    p = (purchases.filter(F.col("user_id").isNotNull() & F.col("purchase_date").isNotNull())
         .select(F.col("user_id").alias("_p_user"), "purchase_id", "purchase_date"))
    return (p.join(_lengths(daily, p), (F.col("_p_user") == F.col("_l_user")) & (F.col("purchase_date") == F.col("_l_date")))
            .select("purchase_id", "touchpoints_in_path"))


def _path_parts(touches: DataFrame, purchases: DataFrame, *, rows_per_task: int | None = ROWS_PER_TASK,
                tie_break=TIE_BREAK, bucket: str = "hour", stage: bool = False):
    """(kept touches, purchases, purchases with their path length, path rows of given purchases)
    of ``_attribution_by_rank``."""
    ranked, daily = rank_touches(touches, tie_break=tie_break, bucket=bucket)
    kept = ranked.filter(F.col("_kept") == 1)
    if stage:
        kept = staged(kept.drop("_day", "_kept"), "ranked-touches")
        # one by one: the path lengths group the days themselves
        daily = kept.select(F.col("user_id").alias("_o_user"), F.to_date("touchpoint_time").alias("_o_day"), F.lit(1).cast("long").alias("_nk"))
    p = (purchases.filter(F.col("user_id").isNotNull() & F.col("purchase_date").isNotNull())
         .select(F.col("user_id").alias("_p_user"), "purchase_id", "purchase_date", "revenue"))
    pn = (p.join(_lengths(daily, p), (F.col("_p_user") == F.col("_l_user")) & (F.col("purchase_date") == F.col("_l_date")))
          .drop("_l_user", "_l_date"))
    if stage:  # a purchase without a path length has no path row
        p = pn = staged(pn, "path-purchases")
    hot = None
    if rows_per_task and stage:
        # a user's path rows are the sum of the path lengths
        paths = pn.groupBy(F.col("_p_user").alias("_hot_user")).agg(F.sum("touchpoints_in_path").alias("_n"), F.count(F.lit(1)).alias("_np"))
        hot = staged(paths.select("_hot_user", F.least(F.ceil(F.col("_n") / rows_per_task), F.col("_np")).cast("int").alias("_salts"))
                     .filter("_salts > 1"), "hot-users")
        if hot.isEmpty():  # path rows stay where their user is: grouping by user and more needs no exchange
            hot = None
    elif rows_per_task:
        # per-user totals from the per-day counts, not from another pass over the touches
        hot = _salts(daily.groupBy(F.col("_o_user").alias("_u")).agg(F.sum("_nk").alias("_n")), p, rows_per_task)

    def path_rows(q):
        t, cond = kept, F.lit(True)
        if hot is not None:
            t, q = _salted(kept, q, hot, "user_id", "purchase_id")
            cond = F.col("_salt") == F.col("_p_salt")
        return t.join(q, (F.col("user_id") == F.col("_p_user")) & cond
                      & (F.col("touchpoint_time") < F.col("purchase_date")), "inner")

    return kept, p, pn, path_rows


def _attribution_by_rank(touches: DataFrame, purchases: DataFrame, **kw) -> dict[str, DataFrame]:
    """Touch path and attribution without any per-purchase window.

    1. ``rank_touches``: number of every touch within its user;
    2. path length per purchase = Σ kept touches on the user's days before
       the purchase day (a running sum over the user's days);
    3. path rows = kept touches ⋈ purchases on the user with
       ``touchpoint_time < purchase_date``; they carry their number and the
       path length, so the linear share needs no window and no shuffle of
       path rows; hot users are salted as in ``touch_path`` (output
       explosion from many purchases is invisible to AQE's input-size skew
       detection);
    4. last touch = the kept touch whose kept-rank equals the path length:
       an equi-join on (user, rank), one row per purchase.

    With ``stage`` the kept touches, the purchases with their path length and
    the salts are written once; all three facts, each as often as a query
    reads it, start from there instead of ranking anew."""
    kept, p, pn, path_rows = _path_parts(touches, purchases, **kw)
    # the touch path itself needs no path length: join the plain purchases
    touchpath = touchpath_from_path(path_rows(p))
    linear = linear_from_path(path_rows(pn))
    last = (kept.join(pn.filter(F.col("revenue").isNotNull()),
                      (F.col("user_id") == F.col("_p_user")) & (F.col("_rank_kept") == F.col("touchpoints_in_path")))
            .select("user_id", "purchase_id", "touchpoint_number", "touchpoint_time",
                    F.col("channel").alias("last_touch_channel"), F.col("campaign_id").alias("last_touch_campaign"),
                    "interaction_type", "revenue", "purchase_date"))
    return {"fact_touchpath": touchpath, "fact_attribution_linear": linear, "fact_attribution_last_touch": last}


def keyed_path_facts(touches: DataFrame, purchases: DataFrame, fact: str, key: str, **kw) -> DataFrame:
    """``fact_touchpath`` or ``fact_attribution_linear`` with the dense key of its rows in the
    order (purchase_id, touchpoint_number), nulls first; no path row is exchanged or staged for it.

    A purchase has as many path rows as its path length, and the touch that is the n-th kept one
    of its user is the n-th of them.  So a row's key is that n after the path lengths of all
    purchases with smaller ids: a running sum over one row per purchase id, which is range
    partitioned and staged once as in ``with_dense_key``.  The rows of an id that stands more
    than once interleave: these alone are numbered row by row, then moved behind the other
    rows of smaller ids."""
    linear = fact == "fact_attribution_linear"
    _, _, pn, path_rows = _path_parts(touches, purchases, **kw)
    if linear:
        pn = pn.filter(_ATTRIBUTED)
    own = ["_p_user", "purchase_date", *(["revenue"] if linear else [])]
    ids = (pn.groupBy("purchase_id")
           .agg(F.count(F.lit(1)).alias("_times"), F.sum("touchpoints_in_path").alias("_rows"), *[F.min(c).alias(c) for c in own]))
    ids = staged(ids.repartitionByRange("purchase_id").sortWithinPartitions("purchase_id")
                 .withColumn("_mid", F.monotonically_increasing_id()), f"path-{key}")
    ids = ids.withColumn("_part", F.shiftright("_mid", 33))
    repeats = F.when(F.col("_times") > 1, F.col("_rows")).otherwise(0)
    inside = Window.partitionBy("_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_o_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition
    sums = (ids.groupBy(F.col("_part").alias("_o_part")).agg(F.sum("_rows").alias("_r"), F.sum(repeats).alias("_rr"))
            .select("_o_part", F.sum("_r").over(earlier).alias("_base"), F.sum("_rr").over(earlier).alias("_base_repeats")))
    off = lambda c: F.coalesce(c, F.lit(0))
    placed = (ids.withColumn("_sum", F.sum("_rows").over(inside)).withColumn("_sum_repeats", F.sum(repeats).over(inside))
              .join(F.broadcast(sums), F.col("_part") == F.col("_o_part"))
              .withColumn("_off", off("_base") + off("_sum"))
              .withColumn("_shift", F.col("_off") - off("_base_repeats") - off("_sum_repeats")))

    def out(path: DataFrame, number, *more: str) -> DataFrame:
        rows = (linear_from_path if linear else touchpath_from_path)(path.withColumn("_key", number.cast("long")), "_key", *more)
        return rows.select(F.col("_key").alias(key), *[c for c in rows.columns if c != "_key"])

    once = placed.filter("_times = 1").select("purchase_id", *own, F.col("_rows").cast("int").alias("touchpoints_in_path"), "_off")
    keyed = out(path_rows(once), F.col("_off") + F.col("_rank_kept"))
    if ids.filter("_times > 1").isEmpty():
        return keyed
    several = placed.filter("_times > 1").select(F.col("purchase_id").alias("_id"), "_shift")
    rows = out(path_rows(pn.join(several, F.col("purchase_id").eqNullSafe(F.col("_id"))).drop("_id")), F.lit(0), "_shift").drop(key)
    rows = with_dense_key(rows, key, ["purchase_id", "touchpoint_number"])
    return keyed.unionByName(rows.withColumn(key, F.col(key) + F.col("_shift")).drop("_shift"))


def touchpath_from_path(path: DataFrame, *more: str) -> DataFrame:
    """ATT-03: the columns of ``fact_touchpath``."""
    return path.select("user_id", "purchase_id", "touchpoint_number", "touchpoint_time",
                       "channel", "campaign_id", "interaction_type", *more)


#: Paths that ``linear_from_path`` shares out.
_ATTRIBUTED = "revenue is not null and revenue >= 0"


def linear_from_path(pw: DataFrame, *more: str) -> DataFrame:
    """ATT-05: each touch gets revenue / path length as DECIMAL(12,2) (half-up).

    Returns (revenue < 0) and purchases without revenue are left out."""
    share = (F.col("revenue") / F.col("touchpoints_in_path")).cast("decimal(12,2)")
    return (pw.filter(_ATTRIBUTED)
            .select("user_id", "purchase_id", "touchpoint_number", "channel", "campaign_id",
                    "interaction_type", "touchpoint_time", share.alias("revenue_share"),
                    F.col("revenue").cast("decimal(12,2)").alias("total_revenue"),
                    "touchpoints_in_path", "purchase_date", *more))


def last_touch_from_path(pw: DataFrame) -> DataFrame:
    """ATT-06: the latest touch of each path gets the full revenue (returns
    kept, NULL revenue dropped)."""
    return (pw.filter((F.col("touchpoint_number") == F.col("_last_number")) & F.col("revenue").isNotNull())
            .select("user_id", "purchase_id", "touchpoint_number", "touchpoint_time",
                    F.col("channel").alias("last_touch_channel"),
                    F.col("campaign_id").alias("last_touch_campaign"), "interaction_type",
                    "revenue", "purchase_date"))


def path_lengths(touchpath: DataFrame) -> DataFrame:
    """ATT-04: touches per purchase (a partial aggregate)."""
    return touchpath.groupBy("purchase_id").agg(F.count(F.lit(1)).cast("int").alias("touchpoints_in_path"))


def first_touch(touchpoints: DataFrame, user: str = "user_id", time: str = "touchpoint_time") -> DataFrame:
    """ATT-07 (``fact_user_acquisition``): earliest touch per user →
    (user_id, acquisition_date [timestamp], acquisition_channel,
    acquisition_campaign).  ``min(struct)`` is combined map-side: no window,
    no sort, and a hot user is reduced before the shuffle."""
    order = [time] + [c for c in TIE_BREAK if c in touchpoints.columns]
    best = F.min(F.struct(*[F.col(c) for c in order])).alias("_f")
    return (touchpoints.filter(F.col(user).isNotNull())
            .groupBy(user).agg(best)
            .select(user, F.col(f"_f.{time}").alias("acquisition_date"),
                    F.col("_f.channel").alias("acquisition_channel"),
                    F.col("_f.campaign_id").alias("acquisition_campaign")))

"""Invariants on our own output."""

from pyspark.sql import functions as F

from touchline.operators import attribution
from touchline.plans.gold import GoldModel
from touchline.plans.registry import REGISTRY, _load_all


def test_quality_suite_is_clean(spark):
    from conftest import SF_SMALL
    _load_all()
    g = GoldModel.from_driver(spark, SF_SMALL)
    # structural checks must pass on our own output; range / repetition checks
    # (dq_06 spend <= 0, dq_08 repeated timestamps) report properties of the
    # input data (zero discounts, busy ship dates) and are not asserted
    structural = ["dq_01_unique", "dq_02_required", "dq_03_orphans", "dq_04_consistency",
                  "dq_05_date_key", "dq_07_accepted", "dq_12_conservation", "path_gaps"]
    rows = REGISTRY["dq_suite"].build(g).collect()
    assert {r.check for r in rows} >= set(structural)
    bad = [r for r in rows if r.check in structural and r.violations > 0]
    assert bad == []
    assert [r.violations for r in rows if r.table_name == "fact_touchpath.touchpoint_number"] == [0]


def test_salted_path_equals_plain_path(spark):
    """Hot-user salting must not change the touch path."""
    from conftest import SF_SMALL
    g = GoldModel.from_driver(spark, SF_SMALL)
    t, p = g.silver["web_touchpoints"], g.silver["crm_purchases"]
    plain = attribution.touch_path(t, p, rows_per_task=None)
    salted = attribution.touch_path(t, p, rows_per_task=5)  # nearly every user is salted
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0


def test_entity_sums_equal_global(spark):
    from conftest import SF_SMALL
    g = GoldModel.from_driver(spark, SF_SMALL)
    lin = g.fact_attribution_linear
    total = lin.agg(F.sum("revenue_share")).first()[0]
    by_channel = lin.groupBy("channel").agg(F.sum("revenue_share").alias("s")).agg(F.sum("s")).first()[0]
    assert total == by_channel


def test_dense_key_of_wide_rows(spark):
    """No row is lost or numbered twice, with and without adaptive execution."""
    from touchline.operators.dims import with_dense_key
    df = spark.range(0, 400_000).select((F.col("id") * 7919 % 400_000).alias("k"), F.repeat(F.lit("x"), 40).alias("a"),
                                        F.sha2(F.col("id").cast("string"), 256).alias("b")).repartition(16)
    for adaptive in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            keyed = with_dense_key(df, "sk", ["k"])
            got = keyed.agg(F.count(F.lit(1)), F.countDistinct("sk"), F.min("sk"), F.max("sk"), F.sum((F.col("sk") != F.col("k") + 1).cast("int"))).first()
            assert tuple(got) == (400_000, 400_000, 1, 400_000, 0)
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lengths_equal_path_counts_of_a_skewed_user(spark):
    """Path lengths by running sums, and salted rank paths, for one user with most touches and purchases."""
    rows = [(1 if i % 3 else i % 5, f"2024-01-{i % 28 + 1:02d} {i % 24:02d}:00:00", "Email" if i % 7 else None, i % 4, "Click") for i in range(600)]
    t = spark.createDataFrame(rows, "user_id long, t string, channel string, campaign_id long, interaction_type string").select(
        "user_id", F.to_timestamp("t").alias("touchpoint_time"), "channel", "campaign_id", "interaction_type").distinct()
    p = spark.createDataFrame([(i, 1 if i % 2 else i % 5, f"2024-01-{i % 28 + 1:02d}", i * 1.5) for i in range(80)],
                              "purchase_id long, user_id long, d string, r double").select(
        "purchase_id", "user_id", F.to_date("d").alias("purchase_date"), F.col("r").cast("decimal(12,2)").alias("revenue"))
    ref = attribution.attribution_facts(t, p, method="window", rows_per_task=None)
    got = attribution.attribution_facts(t, p, rows_per_task=200)
    for name in ref:
        assert ref[name].exceptAll(got[name]).count() == 0 and got[name].exceptAll(ref[name]).count() == 0, name
    want = attribution.path_lengths(ref["fact_touchpath"])
    have = attribution.path_length_per_purchase(t, p)
    assert want.exceptAll(have).count() == 0 and have.exceptAll(want).count() == 0


def test_dense_key_matches_row_number(spark):
    from touchline.operators.dims import with_dense_key
    df = spark.range(0, 1000, 3).withColumnRenamed("id", "k").repartition(7)
    keyed = with_dense_key(df, "sk", ["k"]).collect()
    assert sorted((r.k, r.sk) for r in keyed) == [(k, i + 1) for i, k in enumerate(range(0, 1000, 3))]


def test_rank_plan_equals_window_plan(spark):
    """The rank-first attribution (no per-purchase window) equals the direct
    window formulation, with and without hot-user salting."""
    from conftest import SF_SMALL
    g = GoldModel.from_driver(spark, SF_SMALL)
    t, p = g.silver["web_touchpoints"], g.silver["crm_purchases"]
    ref = attribution.attribution_facts(t, p, method="window", rows_per_task=None)
    for kw in ({"rows_per_task": None}, {"rows_per_task": 5}, {"rows_per_task": None, "bucket": "day"}):
        got = attribution.attribution_facts(t, p, method="rank", **kw)
        for name in ref:
            a, b = ref[name], got[name].select(*ref[name].columns)
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, (name, kw)


def test_range_ranks_of_a_hot_hour_equal_windows(spark):
    """A user with a third of all touches, all in one hour: many tasks number them, as one window would."""
    from pyspark.sql import Window
    n = 30_000
    t = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).cast("long").alias("user_id"),
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 1_000_000 + F.col("id") * 7919 % 3600).otherwise(F.col("id") * 1000)).alias("touchpoint_time"),
        F.when(F.col("id") % 10 != 1, F.concat(F.lit("c"), F.col("id").cast("string"))).alias("channel"), F.col("id").alias("campaign_id"),
        F.when(F.col("id") % 11 != 1, F.lit("View")).alias("interaction_type"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked, daily = attribution.rank_by_range(t)
        order = [F.col(c).asc_nulls_first() for c in ("touchpoint_time", *attribution.TIE_BREAK)]
        w = Window.partitionBy("user_id").orderBy(*order)
        kept = F.col("channel").isNotNull() & F.col("interaction_type").isNotNull()
        want = t.withColumn("touchpoint_number", F.row_number().over(w)).withColumn(
            "_rank_kept", F.sum(kept.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int"))
        cols = ["user_id", "campaign_id", "touchpoint_number", "_rank_kept"]
        got = ranked.select(*cols)
        assert got.count() == n and got.exceptAll(want.select(*cols)).isEmpty()
        # the hot user's rows stand in several range partitions, none of which holds them all
        hot = t.filter("user_id = 7").count()
        pieces = t.repartitionByRange("user_id", "touchpoint_time").filter("user_id = 7").groupBy(F.spark_partition_id()).count().collect()
        assert len(pieces) > 1 and max(r["count"] for r in pieces) < hot
        assert daily.agg(F.sum("_nk")).first()[0] == t.filter(kept).count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_keys_as_produced_are_dense(spark):
    from touchline.operators.dims import with_dense_key
    got = with_dense_key(spark.range(0, 10_000, 1, 7).filter("id % 3 <> 0"), "k").agg(F.count(F.lit(1)), F.countDistinct("k"), F.min("k"), F.max("k")).first()
    assert tuple(got) == (6666, 6666, 1, 6666)
    assert with_dense_key(spark.range(0), "k").collect() == []


def test_absent_values_of_all_sites_in_one_pass(spark):
    from touchline.operators.quality import absent_values
    child = spark.createDataFrame([(1, "a", None), (1, "b", 2.5), (9, None, 2.5), (9, "c", 7.0)], "k long, s string, d double")
    parent = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "k long, s string, d double")
    nothing = child.limit(0)
    sites = [("child", ["k"], "parent", ["k"]), ("child", ["s"], "parent", ["s"]), ("child", ["k", "s"], "parent", ["k", "s"]),
             ("child", ["d"], "parent", ["d"]), ("child", ["k"], "nothing", ["k"]), ("nothing", ["k"], "parent", ["k"]), ("child", ["k"], "child", ["k"])]
    got = {r.site: r.violations for r in absent_values({"child": child, "parent": parent, "nothing": nothing}, sites).collect()}
    assert got == {0: 2, 1: 1, 2: 2, 3: 1, 4: 4, 5: 0, 6: 0}


def test_sample_is_stable(spark):
    from touchline.operators.quality import sample
    df = spark.range(5000).select("id", (F.col("id") % 7).alias("x"))
    first = sorted(map(tuple, sample(df, 20).collect()))
    assert first == sorted(map(tuple, sample(df.repartition(13), 20).collect())) and len(first) == 20
    assert sample(df.limit(0)).collect() == []


def test_profile_by_hand(spark):
    from touchline.operators.profile import profile
    df = spark.createDataFrame([("12", None), ("-3", " "), (" x", "2024-01-02"), ("12", "ab"), ("1.5", "ab"), (None, "cd")], "a string, b string")
    got = {r.column_name: r for r in profile(df).collect()}
    a, b = got["a"], got["b"]
    assert (a.rows, a.null_rows, a.whole_rows, a.decimal_rows, a.other_rows, a.untrimmed_rows) == (6, 1, 3, 1, 1, 1)
    assert (a.distinct_values, a.repeated_values, a.shortest, a.longest, a.top_value, a.top_rows, a.top_shape, a.shapes) == (4, 1, 2, 3, "12", 2, "99", 4)
    assert (b.blank_rows, b.date_rows, b.word_rows, b.top_value, b.top_rows, b.top_shape) == (1, 1, 3, "ab", 2, "AA")
    assert profile(df.limit(0)).collect() == []

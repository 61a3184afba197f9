"""Queries over path rows: one ranking per model, no exchange of path rows, exact on repeated and null keys."""

from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from touchline.operators import attribution


def _same(a, b):
    return Counter(map(tuple, a.collect())) == Counter(map(tuple, b.select(*a.columns).collect()))


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def feeds(spark):
    """Touches and purchases with null keys, purchase ids of two users and rows that come twice."""
    t = spark.range(900).select(
        F.when(F.col("id") % 41 != 0, F.col("id") % 13).alias("user_id"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 4999 % 2_000_000).alias("touchpoint_time"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("c"), (F.col("id") % 5).cast("string"))).alias("channel"),
        F.when(F.col("id") % 9 != 0, F.col("id") % 31).alias("campaign_id"),
        F.when(F.col("id") % 11 != 0, F.lit("Click")).alias("interaction_type")).distinct()
    p = spark.range(120).select(
        F.when(F.col("id") % 17 != 0, F.when(F.col("id") % 10 == 3, F.col("id") - 3).otherwise(F.col("id"))).alias("purchase_id"),
        F.when(F.col("id") % 19 != 0, F.col("id") % 13).alias("user_id"),
        F.when(F.col("id") % 23 != 0, F.date_add(F.lit("2023-11-15").cast("date"), (F.col("id") % 25).cast("int"))).alias("purchase_date"),
        F.when(F.col("id") % 6 != 0, (F.col("id") - 10) * 3.5).cast("decimal(12,2)").alias("revenue"))
    return t, p.unionByName(p.filter("purchase_id % 10 = 1"))


@pytest.mark.parametrize("rows_per_task", [40, 1_000_000])
def test_staged_attribution_equals_windows(spark, feeds, rows_per_task):
    t, p = feeds
    once = p.filter("purchase_id is not null").dropDuplicates(["purchase_id"])
    ref = attribution.attribution_facts(t, once, method="window", rows_per_task=None)
    got = attribution.attribution_facts(t, once, stage=True, rows_per_task=rows_per_task)
    for name in ref:
        assert _same(ref[name], got[name]), name
    plain, staged = (attribution.attribution_facts(t, p, stage=s) for s in (False, True))
    for name in plain:
        assert _same(plain[name], staged[name]), name


def test_path_facts_of_a_model_start_from_one_ranking(spark):
    from conftest import SF_SMALL
    from touchline.plans.gold import GoldModel
    g = GoldModel.from_driver(spark, SF_SMALL)
    for name in ("fact_touchpath", "fact_attribution_linear", "fact_attribution_last_touch"):
        assert not [f for f in g.table(name).inputFiles() if "lineitem" in f], name


def _brute_unique(df, keys):
    n = Counter(tuple(r[k] for k in keys) for r in df.select(*keys).collect())
    return Counter({(*k, c): 1 for k, c in n.items() if c > 1 or None in k})


def test_unique_key_counts_repeats_and_nulls(spark):
    from touchline.operators.quality import unique_key
    rows = [(i // 100, i % 100 - 30) for i in range(300)]
    clean = spark.createDataFrame(rows, "a long, b int")
    odd = spark.createDataFrame(rows + [(1, 5), (1, 5), (2, -30), (None, 5), (None, 5), (2, None), (2, None), (None, None), (7, None)], "a long, b int")
    for df in (clean, odd, clean.limit(0)):
        got = unique_key(df, ["a", "b"])
        assert got.columns == ["a", "b", "n"] and Counter(map(tuple, got.collect())) == _brute_unique(df, ["a", "b"])
    # rows without repeats do not travel one by one
    assert _exchanges(unique_key(clean, ["a", "b"])) <= 1 and "LocalTableScan <empty>" in unique_key(clean, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString().replace("LocalRelation", "LocalTableScan")


def test_consistent_with_by_bitmaps_and_nulls(spark):
    from touchline.operators.quality import consistent_with
    schema = "p long, n int, u long, x string"
    parent = spark.createDataFrame([(i % 9, i - 40, i % 4, "a") for i in range(200)] + [(None, 3, 1, "a"), (2, None, 1, "a")], schema)
    child = spark.createDataFrame([(i % 9, i - 40, i % 4, "b") for i in range(0, 200, 3)] + [(None, 3, 1, "b"), (2, None, 1, "b")], schema)
    odd = child.unionByName(spark.createDataFrame([(0, 500, 0, "c"), (0, 500, 0, "c"), (None, 4, 1, "c"), (2, None, None, "c"), (0, -39, 0, "c")], schema))
    keys = ["p", "n", "u"]
    assert consistent_with(child, parent, keys).collect() == []
    got = consistent_with(odd, parent, keys)
    assert Counter(map(tuple, got.collect())) == Counter({(0, 500, 0, "c"): 2, (None, 4, 1, "c"): 1, (2, None, None, "c"): 1, (0, -39, 0, "c"): 1})


def test_absent_values_scans_rows_once(spark):
    """A row is counted per column, not copied for every site."""
    from touchline.operators.quality import absent_values
    child = spark.range(50).select((F.col("id") % 5).alias("k"), (F.col("id") % 3).cast("string").alias("s"))
    parent = spark.range(4).select(F.col("id").alias("k"), F.lit("0").alias("s"))
    found = absent_values({"c": child, "p": parent}, [("c", ["k"], "p", ["k"]), ("c", ["s"], "p", ["s"]), ("p", ["k"], "c", ["k"]), ("c", ["k", "s"], "p", ["k", "s"])])
    rows = Counter((r.k, r.s) for r in child.collect())
    want = {0: 10, 1: 33, 2: 0, 3: sum(n for (k, s), n in rows.items() if k > 3 or s != "0")}
    assert {r.site: r.violations for r in found.collect()} == want
    assert "Expand" in found._jdf.queryExecution().optimizedPlan().toString()


def test_keys_without_columns_and_their_report(spark):
    from conftest import SF_SMALL
    from touchline.operators.dims import with_dense_key
    from touchline.plans.gold import GoldModel
    from touchline.plans.registry import REGISTRY, _load_all
    df = spark.range(0, 1000, 1, 7).select("id", F.repeat(F.lit("x"), 50).alias("wide"))
    assert sorted(r.k for r in with_dense_key(df, "k", carry=[]).collect()) == list(range(1, 1001))
    assert with_dense_key(df, "k", carry=["id"]).columns == ["k", "id"]
    _load_all()
    g = GoldModel.from_driver(spark, SF_SMALL)
    rows = REGISTRY["dim_05_keys_as_produced"].build(g).collect()
    assert len(rows) == 8 and all((r.first_key, r.last_key, r.n_keys) == (1, r.n_rows, r.n_rows) for r in rows)


def test_touches_are_written_once_for_a_query(spark):
    from conftest import SF_SMALL
    from touchline.plans.gold import GoldModel
    g = GoldModel.from_driver(spark, SF_SMALL)
    m = g.sharing("web_touchpoints")
    assert m is g.sharing("web_touchpoints") and not [f for f in m.fact_touchpoints.inputFiles() if "lineitem" in f]
    assert m.fact_touchpoints.count() == g.fact_touchpoints.count()


@pytest.mark.parametrize("odd", [False, True])
def test_purchases_of_linear_rows_are_counted_exactly(spark, odd):
    """One user per id, and an id of two users with a month in common."""
    from touchline.operators import kpi
    rows = [(i % 4, i % 40, f"2024-0{i % 3 + 1}-05", f"c{i % 3}" if i % 5 else None, 1.25) for i in range(240)]
    if odd:
        rows += [(9, 3, "2024-01-05", "c0", 2.0), (9, 3, "2024-01-05", "c0", 2.0), (9, 3, "2024-03-05", "c9", 2.0), (8, None, "2024-04-05", "c9", 1.0)]
    lin = spark.createDataFrame(rows, "user_id long, purchase_id long, d string, channel string, r double").select(
        "user_id", "purchase_id", F.to_date("d").alias("purchase_date"), "channel", F.col("r").cast("decimal(12,2)").alias("revenue_share"))
    p = lin.select("purchase_id", "user_id", (F.col("user_id") % 2).alias("acquisition_campaign"), F.lit("x").alias("acquisition_channel")).distinct()
    g = SimpleNamespace(fact_attribution_linear=lin, fact_purchases=p, _t={})
    for entity in (None, "channel"):
        keys = [F.year("purchase_date").alias("performance_year"), F.month("purchase_date").alias("performance_month")] + ([entity] if entity else [])
        want = lin.groupBy(*keys).agg(F.countDistinct("purchase_id").alias("n"))
        got = kpi.monthly(g, kpi.Measure("L", "count_distinct", "purchase_id", "n", entity))
        assert got.schema.simpleString() == want.schema.simpleString() and _same(want, got), entity
    lp = lin.join(p.select(F.col("purchase_id").alias("_i"), "acquisition_campaign"), F.col("purchase_id") == F.col("_i"), "left")
    keys = [F.year("purchase_date").alias("performance_year"), F.month("purchase_date").alias("performance_month"), "acquisition_campaign"]
    for agg, col, f in (("sum", "revenue_share", F.sum), ("count_distinct", "purchase_id", F.countDistinct)):
        want = lp.groupBy(*keys).agg(f(col).alias("n"))
        got = kpi.monthly(g, kpi.Measure("LP", agg, col, "n", "acquisition_campaign"))
        assert got.schema.simpleString() == want.schema.simpleString() and _same(want, got), agg


@pytest.mark.parametrize("fact", ["fact_touchpath", "fact_attribution_linear"])
@pytest.mark.parametrize("odd", [False, True])
def test_keys_of_path_rows_follow_their_order(spark, feeds, fact, odd):
    """One null id; null ids, ids of two users and rows that come twice."""
    t, p = feeds
    opts = {"stage": True, "rows_per_task": 40}
    if not odd:
        opts = {"stage": True}
        p = p.filter("purchase_id is not null").dropDuplicates(["purchase_id"]).withColumn("purchase_id", F.when(F.col("purchase_id") != 42, F.col("purchase_id")))
    rows = attribution.attribution_facts(t, p, stage=True)[fact]
    got = attribution.keyed_path_facts(t, p, fact, "k", **opts)
    assert got.columns == ["k", *rows.columns] and [f.dataType for f in got.schema][1:] == [f.dataType for f in rows.schema]
    found = sorted(got.collect())
    assert Counter(tuple(r)[1:] for r in found) == Counter(map(tuple, rows.collect()))
    assert [r.k for r in found] == list(range(1, len(found) + 1)) and found
    order = [(r.purchase_id is not None, r.purchase_id or 0, r.touchpoint_number) for r in found]
    assert order == sorted(order)


def test_path_rows_are_not_staged_for_their_keys(spark):
    from conftest import SF_SMALL
    from touchline.plans.gold import GoldModel
    from touchline.plans.registry import REGISTRY, _load_all
    _load_all()
    g = GoldModel.from_driver(spark, SF_SMALL)
    for fact in ("fact_touchpath", "fact_attribution_linear"):
        read = {f.rsplit("/", 1)[0] for f in REGISTRY[f"dim_05_{fact}"].build(g).inputFiles()}
        assert max(spark.read.parquet(d).count() for d in read) < g.table(fact).count(), fact

"""Magnitude analysis (MAG-00 and the special shapes of SURVEY §2.8).

``magnitude`` is the one generic operator: optional left lookup of a
dimension → group by keys → aggregates → order by the first aggregate.
Aggregation is partial (map-side) before the shuffle, so a hot key costs one
pre-aggregated row per task, not its raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import RATIO_SCALE, int_avg, scalar


def agg_expr(kind: str, col: str | None) -> Column:
    """count | count_star | sum | avg (decimal mean, 6 places) | int_avg."""
    if kind == "count":
        return F.count(col)
    if kind == "count_star":
        return F.count(F.lit(1))
    if kind == "sum":
        return F.sum(col)
    if kind == "avg":
        return F.round(F.avg(col), RATIO_SCALE)
    if kind == "int_avg":
        return int_avg(col)
    raise ValueError(kind)


def with_dim(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str, cols: list[str],
             prefix: str = "d_") -> DataFrame:
    """Left lookup of dimension attributes (prefixed ``d_``)."""
    d = dim.select(F.col(dim_col).alias(f"{prefix}key"), *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    return fact.join(d, F.col(fact_col) == F.col(f"{prefix}key"), "left").drop(f"{prefix}key")


def magnitude(fact: DataFrame, keys: list, aggs: list[tuple[str, str, str | None]],
              order: str | None = None, ascending: bool = False) -> DataFrame:
    """MAG-00: ``keys`` are column names or (expression, alias) pairs; ``aggs``
    is a list of (alias, kind, column)."""
    kcols = [F.col(k) if isinstance(k, str) else k[0].alias(k[1]) for k in keys]
    out = fact.groupBy(*kcols).agg(*[agg_expr(kind, c).alias(a) for a, kind, c in aggs])
    o = order or aggs[0][0]
    return out.orderBy(F.col(o).asc() if ascending else F.col(o).desc())


def histogram(entities: DataFrame, fact: DataFrame, key: str, count_col: str,
              count_alias: str, users_alias: str = "total_users") -> DataFrame:
    """MAG-6.1 / 7.1: entities by their number of fact rows, zero included.

    The fact is reduced to one row per entity first (partial aggregation, so
    a hot entity never travels as raw rows), then left-joined to the
    entities; missing entities count 0."""
    per_fact = fact.groupBy(F.col(key).alias("_k")).agg(F.count(count_col).alias("_c"))
    per = (entities.select(key).join(per_fact, F.col(key) == F.col("_k"), "left")
           .select(key, F.coalesce(F.col("_c"), F.lit(0)).alias(count_alias)))
    return per.groupBy(count_alias).agg(F.count(key).alias(users_alias)).orderBy(F.desc(users_alias))


def path_length_histogram(lengths: DataFrame) -> DataFrame:
    """MAG-8.1: purchases by path length (ATT-04's rows), ordered by length."""
    return (lengths.groupBy(F.col("touchpoints_in_path").cast("long").alias("touchpath_length"))
            .agg(F.count("purchase_id").alias("purchase_count")).orderBy("touchpath_length"))


def funnel_stage(interaction: Column) -> Column:
    """Upper funnel = Impression, View; lower = Click; else Unknown."""
    return (F.when(interaction.isin("Impression", "View"), "Upper Funnel")
            .when(interaction == "Click", "Lower Funnel").otherwise("Unknown"))


def pearson_explicit(df: DataFrame, x: str, y: str, alias: str = "r_correlation") -> DataFrame:
    """MAG-10.14 exactly as written in the reference: centred on the
    *truncated* integer mean of ``x`` and the mean of ``y`` (scalar
    subqueries), then one aggregate pass (no global window, no join)."""
    mx, my = scalar(df, int_avg(x)), scalar(df, F.avg(y))
    dx = F.col(x).cast("double") - mx.cast("double")
    dy = F.col(y).cast("double") - my.cast("double")
    s = df.agg(F.sum(dx * dy).alias("sxy"), F.sum(dx * dx).alias("sxx"), F.sum(dy * dy).alias("syy"))
    return s.select(F.round(F.col("sxy") / (F.sqrt("sxx") * F.sqrt("syy")), RATIO_SCALE).alias(alias))


def pearson(df: DataFrame, x: str, y: str, alias: str = "r_correlation") -> DataFrame:
    """Built-in Pearson correlation (exact means) — the textbook variant."""
    return df.agg(F.round(F.corr(F.col(x).cast("double"), F.col(y).cast("double")), RATIO_SCALE).alias(alias))



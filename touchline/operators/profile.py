"""Profiling of raw (bronze) columns (PRF-01 … PRF-15)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    """PRF-01."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def true_duplicates(df: DataFrame) -> DataFrame:
    """PRF-02: Σ(count − 1) over all-column groups with count > 1."""
    cols = df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def key_counts(df: DataFrame, key: str, threshold: int = 1) -> DataFrame:
    """PRF-03: keys occurring more than ``threshold`` times."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > threshold)


def missing(df: DataFrame, col: str) -> DataFrame:
    """PRF-04: rows whose column is NULL or blank."""
    return df.filter(F.col(col).isNull() | (F.trim(F.col(col)) == ""))


def frequencies(df: DataFrame, col: str) -> DataFrame:
    """PRF-05: value → occurrences, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("occurrences")).orderBy(F.desc("occurrences"))


def classify(df: DataFrame, col: str, rules: list[tuple[Column, str]], default: str = "other",
             counted: bool = True) -> DataFrame:
    """PRF-06: status of each raw value by the first matching rule; counted
    per (value, status) when ``counted``."""
    status = None
    for pred, label in rules:
        status = F.when(pred, label) if status is None else status.when(pred, label)
    status = status.otherwise(default)
    out = df.select(F.col(col), status.alias("status"))
    return out.groupBy(col, "status").agg(F.count(F.lit(1)).alias("n")) if counted else out


def date_format_rules(c: str) -> list[tuple[Column, str]]:
    """Format classes of raw date text used by PRF-06."""
    x = F.col(c)
    return [(x.isNull(), "missing"),
            (x.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "iso"),
            (x.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), "dd/mm/yyyy"),
            (x.rlike(r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$"), "yyyy/mm/dd"),
            (x.rlike(r"^[A-Za-z_]+$"), "sentinel")]


def timestamp_format_rules(c: str) -> list[tuple[Column, str]]:
    """Format classes of raw timestamp text (PRF-06)."""
    x = F.col(c)
    return [(x.isNull(), "missing"),
            (x.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?$"), "iso"),
            (x.rlike(r"^[0-3][0-9]/[0-1][0-9]/[1-2][0-9]{3} [0-2][0-9]:[0-5][0-9]$"), "dd/mm/yyyy hh:mm"),
            (x.rlike(r"^[A-Za-z_]+$"), "sentinel")]


def id_format_rules(c: str) -> list[tuple[Column, str]]:
    """Format classes of raw id text (PRF-06): integer, ``n.0`` decimal,
    other decimal, non-numeric."""
    x = F.col(c)
    return [(x.isNull() | (F.trim(x) == ""), "missing"),
            (x.rlike(r"^[0-9]+$"), "integer"),
            (x.rlike(r"^[0-9]+\.0$"), "decimal .0"),
            (x.rlike(r"^-?[0-9]+\.[0-9]+$"), "decimal"),
            (F.lit(True), "non-numeric")]


def money_format_rules(c: str) -> list[tuple[Column, str]]:
    """Format classes of raw money text (PRF-06): plain, currency suffix,
    quoted decimal comma, negative."""
    x = F.col(c)
    return [(x.isNull() | (F.trim(x) == ""), "missing"),
            (x.startswith("-"), "negative"),
            (x.rlike("(?i)USD$"), "currency suffix"),
            (x.contains(","), "decimal comma"),
            (x.rlike(r"^[0-9]+(\.[0-9]+)?$"), "plain")]


def number_format_rules(c: str) -> list[tuple[Column, str]]:
    """Classes of raw numbers such as revenue or page counts (PRF-06)."""
    x = F.trim(F.col(c))
    return [(x.isNull() | (x == ""), "missing"),
            (x.rlike(r"^-[0-9]+(\.[0-9]+)?$"), "negative"),
            (x.rlike(r"^[0-9]+$"), "whole"),
            (x.rlike(r"^[0-9]+\.[0-9]+$"), "decimal"),
            (F.lit(True), "non-numeric")]


def text_case_rules(c: str) -> list[tuple[Column, str]]:
    """Classes of raw names (PRF-06): blank, surrounded by blanks, upper case, as written."""
    x = F.col(c)
    return [(x.isNull() | (F.trim(x) == ""), "missing"),
            (F.trim(x) != x, "untrimmed"),
            (x == F.upper(x), "upper case"),
            (F.lit(True), "plain")]


def status_counts(df: DataFrame, rules: list[tuple[Column, str]], default: str = "other") -> DataFrame:
    """PRF-06 by status alone: rows are counted per status, raw values are never shuffled."""
    status = None
    for pred, label in rules:
        status = F.when(pred, label) if status is None else status.when(pred, label)
    return df.groupBy(status.otherwise(default).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def length_outliers(df: DataFrame, col: str, lo: int, hi: int | None = None) -> DataFrame:
    """PRF-07: ``LEN(x)`` (trailing blanks ignored) outside [lo, hi]
    (``hi=None`` means exactly ``lo``)."""
    n = F.length(F.rtrim(F.col(col)))
    cond = (n != lo) if hi is None else ((n < lo) | (n > hi))
    return df.filter(cond)


def absent_from(df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """PRF-08: distinct values absent from a reference table (anti join)."""
    r = ref.select(F.col(ref_col).alias("_r")).distinct()
    return df.select(col).filter(F.col(col).isNotNull()).distinct().join(r, F.col(col) == F.col("_r"), "left_anti")


def preview(df: DataFrame, col: str, cleaner) -> DataFrame:
    """PRF-10: raw value next to its cleaned value (distinct pairs)."""
    return df.select(F.col(col).alias(f"raw_{col}"), cleaner(col).alias(f"clean_{col}")).distinct()


def null_like(df: DataFrame) -> DataFrame:
    """PRF-11: rows with any column NULL or blank."""
    return df.filter(reduce(lambda a, b: a | b,
                            [F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in df.columns]))


def share_pct(df: DataFrame, cond: Column, alias: str = "pct") -> DataFrame:
    """PRF-13: share of rows matching ``cond`` in %, 2 decimals."""
    return df.agg(F.round(F.sum(F.when(cond, 1).otherwise(0)) * 100.0 / F.count(F.lit(1)), 2).alias(alias))


#: Kinds of text in a profiled column, in the order they are tried.
PROFILE_CLASSES = [("whole", r"^-?[0-9]+$"), ("decimal", r"^-?[0-9]+\.[0-9]+$"), ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
                   ("timestamp", r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"), ("word", r"^[A-Za-z_]+$")]


def profile(df: DataFrame) -> DataFrame:
    """PRF-01, 03 … 07, 11 and 15 for every column of a feed in one pass: one row a column with its rows,
    nulls, blanks, untrimmed, distinct and repeated values, shortest and longest text, rows of each
    class of text, number of shapes (digits as 9, letters as A) and the most frequent shape, and the
    most frequent value (ties: the smallest) with its count.

    The feed is unpivoted to (column, text) and scanned once.  Three aggregates follow, each over
    the summaries of the one before, by (column, text), (column, shape) and column: all counts are
    exact, all partial results merge, and a frequent value is one row per task.  A column's
    distinct values are never gathered."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns]
    one = F.count(F.lit(1))
    values = df.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*").groupBy("column_name", "value").agg(one.alias("n"))
    v, n = F.col("value"), F.col("n")
    kind = reduce(lambda acc, rule: acc.when(v.rlike(rule[1]), rule[0]), PROFILE_CLASSES, F.when(v.isNull(), "null").when(F.trim(v) == "", "blank")).otherwise("other")
    shape = F.regexp_replace(F.regexp_replace(v, "[0-9]", "9"), "[A-Za-z]", "A")
    kinds = ["null", "blank", *[k for k, _ in PROFILE_CLASSES], "other"]
    some = lambda cond: F.sum(F.when(cond, n).otherwise(0))
    shapes = values.withColumn("_kind", kind).groupBy("column_name", shape.alias("shape")).agg(
        F.sum("n").alias("rows"), *[some(F.col("_kind") == k).alias(f"{k}_rows") for k in kinds], some(F.trim(v) != v).alias("untrimmed_rows"),
        F.count("value").alias("distinct_values"), F.count_if(v.isNotNull() & (n > 1)).alias("repeated_values"),
        F.min(F.length(v)).alias("shortest"), F.max(F.length(v)).alias("longest"),
        F.min(F.when(v.isNotNull(), F.struct((-n).alias("less"), v.alias("value")))).alias("top"))
    total = [F.sum(c).alias(c) for c in ("rows", *[f"{k}_rows" for k in kinds], "untrimmed_rows", "distinct_values", "repeated_values")]
    out = shapes.groupBy("column_name").agg(
        *total, F.min("shortest").alias("shortest"), F.max("longest").alias("longest"), F.count("shape").alias("shapes"),
        F.min(F.when(F.col("shape").isNotNull(), F.struct((-F.col("rows")).alias("less"), "shape"))).alias("_shape"), F.min("top").alias("_top"))
    return out.select("column_name", *[c for c in out.columns if c not in ("column_name", "_shape", "_top")],
                      F.col("_shape.shape").alias("top_shape"), F.col("_top.value").alias("top_value"), (-F.col("_top.less")).alias("top_rows"))


def pattern_rows(df: DataFrame, col: str, regex: str) -> DataFrame:
    """PRF-14."""
    return df.filter(F.col(col).rlike(regex))

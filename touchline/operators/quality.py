"""Data-quality checks (DQ-01 … DQ-13).

Each check returns the violating rows (empty = pass); ``suite`` runs a list
of checks and returns one table (check, table, violations).  Referential
checks use ``left_anti`` joins (NULL-safe in the direction that matters:
unlike the reference's ``NOT IN`` they do detect NULL names, defect D7).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from ..functions.stats import one_row
from ..sources.staging import staged


def unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """DQ-01: keys duplicated or NULL.

    Where the last of several keys is a whole number, 64 neighbours of it are first one bitmap per
    task; keys are counted one by one only in the bitmaps that have fewer bits than rows."""
    null_any = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    if len(keys) > 1 and isinstance(df.schema[keys[-1]].dataType, _WHOLE):
        bits = _bits(df, keys, keys[-1]).groupBy(*_block(keys, keys[-1])).agg(F.count(F.lit(1)).alias("_n"), F.expr("bit_or(_bit)").alias("_bits"))
        null_block = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in _block(keys, keys[-1])])
        suspect = staged(bits.filter((F.col("_n") > F.expr("bit_count(_bits)")) | null_block).drop("_n", "_bits"), "repeated-keys")
        df = df.limit(0) if suspect.isEmpty() else _within(df, suspect, keys, keys[-1])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") > 1) | null_any))


#: Types whose values are packed 64 to a bitmap.
_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def _block(keys: list[str], packed: str) -> list[str]:
    return [f"_b_{k}" for k in keys if k != packed] + ["_b_block"]


def _bits(df: DataFrame, keys: list[str], packed: str) -> DataFrame:
    """Rows as (the other keys, number of the block of 64 values of ``packed``, bit); NULL has a block of its own."""
    return df.select(*[F.col(k).alias(f"_b_{k}") for k in keys if k != packed], F.shiftright(F.col(packed).cast("long"), 6).alias("_b_block"),
                     F.expr(f"coalesce(shiftleft(1L, cast(`{packed}` & 63 as int)), 1L)").alias("_bit"))


def _within(df: DataFrame, blocks: DataFrame, keys: list[str], packed: str) -> DataFrame:
    """The rows of ``df`` whose key stands in one of the blocks (NULLs equal)."""
    mine = [F.col(k) for k in keys if k != packed] + [F.shiftright(F.col(packed).cast("long"), 6)]
    return df.join(blocks, reduce(lambda a, b: a & b, [c.eqNullSafe(F.col(b)) for c, b in zip(mine, _block(keys, packed))]), "left_semi")


def required(df: DataFrame, cols: list[str]) -> DataFrame:
    """DQ-02: rows with a NULL in any required column."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def orphans(df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """DQ-03: non-NULL values absent from the reference table."""
    r = ref.select(F.col(ref_col).alias("_ref")).distinct()
    return df.filter(F.col(col).isNotNull()).join(r, F.col(col) == F.col("_ref"), "left_anti")


def consistent_with(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """DQ-04: child rows whose full key tuple is absent from the parent.

    Where a key is a whole number in both, its values are compared 64 at a time as bitmaps; rows
    meet one by one only in the bitmaps in which the child has a bit that the parent lacks."""
    packed = next((k for k in reversed(keys) if all(isinstance(d.schema[k].dataType, IntegerType) for d in (child, parent))), None)
    if packed and len(keys) > 1:
        both = (_bits(child, keys, packed).withColumn("_of", F.lit(0).cast("long"))
                .unionByName(_bits(parent, keys, packed).withColumn("_of", F.col("_bit")).withColumn("_bit", F.lit(0).cast("long"))))
        bits = both.groupBy(*_block(keys, packed)).agg(F.expr("bit_or(_bit)").alias("_bits"), F.expr("bit_or(_of)").alias("_of"))
        suspect = staged(bits.filter("_bits & ~_of <> 0").drop("_bits", "_of"), "absent-keys")
        if suspect.isEmpty():
            return child.limit(0)
        child, parent = (_within(d, suspect, keys, packed) for d in (child, parent))
    p = parent.select(*[F.col(k).alias(f"_p_{k}") for k in keys]).distinct()
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_p_{k}")) for k in keys])
    return child.join(p, cond, "left_anti")


#: Stands between the values of a key of several columns.
_BETWEEN = "\x1f"


def absent_values(tables: dict[str, DataFrame], sites: list[tuple[str, list[str], str, list[str]]]) -> DataFrame:
    """DQ-03 / DQ-04 for many sites at once: (site, violations), the child rows whose (set) values the
    parent lacks, for sites (child table, its columns, parent table, its columns) by their number.

    Each table is scanned once: one GROUPING SETS aggregate counts the values of every column (or
    key of several) that a site names, each once whatever the number of its sites.  Values are
    combined before the shuffle, so a value of a third of all rows is one row per task; only the
    distinct values become one (site, value, side) for every site they take part in, as child or
    parent, and presence on either side is one aggregate, not a join per site.
    Values compare as text of the parent column's type."""
    roles: dict[str, list] = {}
    for i, (child, cols, parent, parent_cols) in enumerate(sites):
        kinds = [tables[parent].schema[c].dataType for c in parent_cols]
        roles.setdefault(child, []).append((i, cols, kinds, True))
        roles.setdefault(parent, []).append((i, parent_cols, kinds, False))
    parts = []
    for name, mine in roles.items():
        sets = list(dict.fromkeys(tuple(cols) for _, cols, _, _ in mine))
        every = list(dict.fromkeys(c for s in sets for c in s))
        counted = tables[name].groupingSets([list(s) for s in sets], *every).agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"))
        cells = []
        for i, cols, kinds, is_child in mine:
            gid = sum(1 << (len(every) - 1 - at) for at, c in enumerate(every) if c not in cols)
            text = [F.col(c).cast(k).cast("string") for c, k in zip(cols, kinds)]
            known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
            cells.append(F.when((F.col("_set") == gid) & known, F.struct(F.lit(i).alias("site"), F.concat_ws(_BETWEEN, *text).alias("value"), F.lit(is_child).alias("is_child"))))
        parts.append(counted.select(F.explode(F.array_compact(F.array(*cells))).alias("_c"), "_n").select("_c.*", "_n"))
    values = reduce(lambda a, b: a.unionByName(b), parts).groupBy("site", "value").agg(
        F.sum(F.when(F.col("is_child"), F.col("_n")).otherwise(0)).alias("n"), F.bool_and("is_child").alias("orphan"))
    return values.groupBy("site").agg(F.coalesce(F.sum(F.when(F.col("orphan"), F.col("n"))), F.lit(0)).alias("violations"))


def date_key_mismatch(df: DataFrame, date_col: str, key_col: str = "date_key") -> DataFrame:
    """DQ-05: the key is missing or does not encode the row's date."""
    d = F.to_date(F.col(date_col))
    k = F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    return df.filter(d.isNotNull() & (F.col(key_col).isNull() | (F.col(key_col) != k)))


def out_of_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """DQ-06."""
    c = F.col(col)
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < lo)
    if hi is not None:
        cond = cond | (c > hi)
    return df.filter(cond)


def not_accepted(df: DataFrame, col: str, accepted: list) -> DataFrame:
    """DQ-07: values outside an accepted list (distinct)."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(accepted)).select(col).distinct()


def repeated_values(df: DataFrame, col: str, threshold: int) -> DataFrame:
    """DQ-08 / PRF-09: values occurring more than ``threshold`` times."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > threshold)


def digit_buckets(df: DataFrame, col: str) -> DataFrame:
    """DQ-09: (digits, n): ids by their number of digits, every length that
    occurs (0 and negatives by their digits without sign), NULL ids as NULL."""
    digits = F.length(F.abs(F.col(col).cast("decimal(20,0)")).cast("string"))
    return df.groupBy(digits.alias("digits")).agg(F.count(F.lit(1)).alias("n"))


def row_counts(**tables: DataFrame) -> DataFrame:
    """DQ-10: row counts side by side (one aggregate per table, combined as
    scalar subqueries)."""
    frames = [df.agg(F.count(F.lit(1)).alias(name)) for name, df in tables.items()]
    return one_row(*frames)


def returns_matching(purchases: DataFrame, user: str = "user_id", amount: str = "revenue") -> DataFrame:
    """DQ-11 / PRF-12: negative amounts, how many have an equal positive of
    the same user, and the share of negatives (%)."""
    neg = purchases.filter(F.col(amount) < 0).select(F.col(user).alias("_u"), (-F.col(amount)).alias("_a"))
    pos = (purchases.filter(F.col(amount) > 0).select(F.col(user).alias("_pu"), F.col(amount).alias("_pa"))
           .distinct())
    matched = neg.join(pos, (F.col("_u") == F.col("_pu")) & (F.col("_a") == F.col("_pa")), "left_semi")
    total = purchases.agg(F.count(F.lit(1)).alias("total_rows"))
    n_neg = neg.agg(F.count(F.lit(1)).alias("negative_rows"))
    n_match = matched.agg(F.count(F.lit(1)).alias("matched_returns"))
    return (one_row(total, n_neg, n_match)
            .withColumn("negative_pct", F.round(F.col("negative_rows") * 100.0 / F.col("total_rows"), 2)))


def conservation(linear: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """DQ-12: purchases whose shares do not add up to the revenue (± tol)."""
    return (linear.groupBy("purchase_id")
            .agg(F.sum("revenue_share").alias("sum_shares"), F.max("total_revenue").alias("total_revenue"))
            .filter(F.abs(F.col("sum_shares") - F.col("total_revenue")) > tolerance))


def path_gaps(touchpath: DataFrame) -> DataFrame:
    """Invariant: touch numbers are 1..n without gaps per purchase."""
    return (touchpath.groupBy("purchase_id")
            .agg(F.count(F.lit(1)).alias("n"), F.min("touchpoint_number").alias("lo"),
                 F.max("touchpoint_number").alias("hi"))
            .filter((F.col("lo") != 1) | (F.col("hi") != F.col("n"))))


def sample(df: DataFrame, n: int = 10) -> DataFrame:
    """DQ-13: ``TOP n *`` as a stable sample: the n rows whose text has the smallest md5.

    The same rows on every run, whatever the partitions: each task keeps its n smallest and these
    are merged, so nothing but n rows a task moves.  Equal rows count as often as they stand."""
    key = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]))
    return df.orderBy(key).limit(n)


def suite(checks: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """Run checks → (check, table_name, violations).  Each check is one
    aggregate; the union is one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("violations"))
             .select(F.lit(name).alias("check"), F.lit(table).alias("table_name"), "violations")
             for name, table, df in checks]
    return reduce(lambda a, b: a.unionByName(b), parts)

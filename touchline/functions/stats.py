"""Expression helpers shared by all operators.

Each returns a ``Column`` built from built-in functions only, so every use
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal places kept for KPI ratios and means (they are doubles).
RATIO_SCALE = 6


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_avg(c) -> Column:
    """Mean of an integer column truncated to an integer (integer AVG).

    Exact for the non-negative counts it is used on; returns bigint."""
    return F.floor(F.avg(col(c))).cast("long")


def safe_div(n, d) -> Column:
    """``n / NULLIF(d, 0)`` as a double; NULL instead of a division error."""
    dd = col(d).cast("double")
    return F.when(dd == 0, F.lit(None).cast("double")).otherwise(col(n).cast("double") / dd)


def ratio(n, d, scale: int = RATIO_SCALE) -> Column:
    """Rounded double ratio with a zero-guard, the form every KPI uses."""
    return F.round(safe_div(n, d), scale)


def dround(c, scale: int = RATIO_SCALE) -> Column:
    return F.round(col(c).cast("double"), scale)


def month_index(c) -> Column:
    """Months since year 0: ``year*12 + month``."""
    return F.year(col(c)) * 12 + F.month(col(c))


def month_diff(a, b) -> Column:
    """Number of month boundaries between two dates (``DATEDIFF(MONTH, a, b)``)."""
    return month_index(b) - month_index(a)


def month_start(c) -> Column:
    return F.trunc(col(c), "MM")


def us_week(c) -> Column:
    """US week number: week 1 contains January 1st, weeks start on Sunday."""
    d = col(c)
    return (F.floor((F.dayofyear(d) + F.dayofweek(F.trunc(d, "YEAR")) - 2) / 7) + 1).cast("int")


def date_key(c) -> Column:
    """yyyymmdd integer key of a date."""
    d = col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def blank_to_null(c) -> Column:
    t = F.trim(col(c))
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def concat_nullsafe(*cols) -> Column:
    """String concatenation treating NULL as empty text."""
    return F.concat_ws("", *[col(c) for c in cols])


def exact_ratio(n, d, in_scale: int = 2) -> Column:
    """``n / NULLIF(d, 0)`` as decimal(38,6), rounded half-up from the exact
    quotient (both inputs are cast to decimal(38, in_scale); the decimal
    division result then has scale 6)."""
    nd = col(n).cast(f"decimal(38,{in_scale})")
    dd = col(d).cast(f"decimal(38,{in_scale})")
    return F.when(dd == 0, F.lit(None).cast("decimal(38,6)")).otherwise(nd / dd).cast("decimal(38,6)")


def scalar(df, expr: Column) -> Column:
    """A one-row aggregate of ``df`` used as a value (scalar subquery).

    Catalyst runs it once and merges scalar subqueries over the same plan;
    no join is planned."""
    return df.agg(expr.alias("_scalar")).scalar()


def one_row(*frames):
    """Combine one-row aggregate frames into one row (scalar subqueries on
    the first frame, no cross join)."""
    base, rest = frames[0], frames[1:]
    extra = [f.select(c).scalar().alias(c) for f in rest for c in f.columns]
    return base.select(*[F.col(c) for c in base.columns], *extra)

"""Silver cleaning expressions (CLN-01 … CLN-12).

Every cleaner maps a ``Column`` to a ``Column`` with built-in functions only
(no UDF); bad values become NULL, never errors (``try_*`` functions — Spark
4 runs with ANSI mode on).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stats import col

# ---------------------------------------------------------------------------
# Fixed values of the reference (accepted lower-case spellings → canonical
# channel name; device, interaction and objective buckets; sentinels).
# ---------------------------------------------------------------------------
CHANNEL_SYNONYMS = {
    "Google Search": ["gogle search", "google-search", "googel search", "google  search", "google search"],
    "Google Display": ["googel display", "google  display", "google display"],
    "Facebook Ads": ["fb ads", "fb_ads", "facebok ads", "facebook ads"],
    "Instagram Ads": ["instgram ads", "insta_ads", "instagram ads"],
    "TikTok Ads": ["tik_tok_ads", "tictok ads", "tiktok ads"],
    "Organic Search": ["organic  search", "organic_search", "organic search"],
    "Referral": ["referal", "referral"],
    "Direct": ["direct"],
    "Email": ["email"],
    "LinkedIn Ads": ["linkedin ads"],
    "Programmatic Display": ["programmatic display"],
    "SMS": ["sms"],
}
DEVICE_BUCKETS = {
    "Mobile": ["phone", "android", "mobile_web", "iphone", "mobile"],
    "Desktop": ["desktop", "desk_top"],
    "Tablet": ["tablet", "tab_let"],
}
INTERACTION_BUCKETS = {
    "Click": ["click", "clik", "clk"],
    "Impression": ["impr", "impression", "impressions"],
    "View": ["page_view", "view"],
}
OBJECTIVE_PREFIXES = {"Awareness": "aware", "Conversion": "conv"}
OBJECTIVE_EXACT = {"Traffic": "traffic"}
DATE_SENTINELS = ("not_available", "invalid")
TIMESTAMP_SENTINELS = ("invalid_date", "not_a_date", "invalid")
PAGES_SENTINEL = "-1.0"
# dd/mm/yyyy hh:mm as a pattern (the reference's LIKE character classes)
DMY_HM_PATTERN = r"^[0-3][0-9]/[0-1][0-9]/[1-2][0-9]{3} [0-2][0-9]:[0-5][0-9]$"


def lookup_map(buckets: dict[str, list[str]]) -> Column:
    """A literal map spelling → canonical value (evaluated once per task)."""
    kv = []
    for canon, spellings in buckets.items():
        for s in spellings:
            kv += [F.lit(s), F.lit(canon)]
    return F.create_map(*kv)


def canonical_channel(c) -> Column:
    """CLN-01: canonical channel name, compared trimmed and in lower case;
    NULL/blank → NULL; unknown values pass through trimmed."""
    c = blank_channel(c)
    return F.coalesce(F.element_at(lookup_map(CHANNEL_SYNONYMS), F.lower(c)), c)


def bucket(c, buckets: dict[str, list[str]]) -> Column:
    """CLN-10 (list form): bucket compared trimmed and in lower case; unknown
    values pass through trimmed, blank ones are NULL."""
    c = blank_channel(c)
    return F.coalesce(F.element_at(lookup_map(buckets), F.lower(c)), c)


def objective(c) -> Column:
    """CLN-10 (prefix form): aware% → Awareness, conv% → Conversion,
    traffic → Traffic; unknown passes through."""
    c = col(c)
    t = F.trim(F.lower(c))
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for canon, prefix in OBJECTIVE_PREFIXES.items():
        out = out.when(t.startswith(prefix), canon)
    for canon, exact in OBJECTIVE_EXACT.items():
        out = out.when(t == exact, canon)
    return out.otherwise(c)


def _try_date(text: Column, fmt: str) -> Column:
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def parse_mixed_date(c, sentinel: str | tuple = DATE_SENTINELS, years=None, force_year: str | None = None) -> Column:
    """CLN-02: sentinel → NULL; ``dd?mm?yyyy`` when characters 7–10 are an
    accepted year (``years=None`` accepts any 4 digits); else ISO or
    ``yyyy/mm/dd``; anything else → NULL.  ``force_year`` reproduces the
    reference's fixed-year rewrite (defect D1)."""
    c = col(c)
    sentinels = (sentinel,) if isinstance(sentinel, str) else tuple(sentinel)
    y = F.substring(c, 7, 4)
    is_dmy = y.rlike(r"^[0-9]{4}$") if years is None else y.isin([str(v) for v in years])
    year_part = F.lit(force_year) if force_year else y
    dmy = F.concat_ws("-", year_part, F.substring(c, 4, 2), F.substring(c, 1, 2))
    iso = F.coalesce(_try_date(c, "yyyy-MM-dd"), _try_date(c, "yyyy/MM/dd"))
    return (F.when(c.isNull() | c.isin(*sentinels), F.lit(None).cast("date"))
            .when(is_dmy, _try_date(dmy, "yyyy-MM-dd"))
            .otherwise(iso))


def parse_mixed_timestamp(c, sentinels=TIMESTAMP_SENTINELS, whole_seconds: bool = False) -> Column:
    """CLN-03: sentinel → NULL; ``dd/mm/yyyy hh:mm`` (16 chars) → timestamp;
    otherwise the trimmed text as an ISO timestamp (NULL if invalid).
    ``whole_seconds`` rounds fractions half-up to the second (the
    reference's DATETIME2(0) for clicks and sessions); touchpoints keep
    milliseconds."""
    c = col(c)
    dmy = F.try_to_timestamp(c, F.lit("dd/MM/yyyy HH:mm"))
    iso = F.coalesce(F.try_to_timestamp(F.trim(c), F.lit("yyyy-MM-dd HH:mm:ss")),
                     F.try_to_timestamp(F.trim(c), F.lit("yyyy-MM-dd HH:mm:ss.SSS")),
                     F.try_to_timestamp(F.trim(c), F.lit("yyyy-MM-dd HH:mm")),
                     F.try_to_timestamp(F.trim(c), F.lit("yyyy-MM-dd")))
    out = (F.when(c.isNull() | c.isin(*sentinels), F.lit(None).cast("timestamp"))
           .when(c.rlike(DMY_HM_PATTERN) & (F.length(c) == 16), dmy)
           .otherwise(iso))
    out = out.cast("timestamp_ntz")
    if whole_seconds:
        out = F.date_trunc("second", out + F.expr("INTERVAL 500 MILLISECONDS")).cast("timestamp_ntz")
    return out


def decimal_id(c) -> Column:
    """CLN-08: ``"17.0"`` → 17, ``"17.6"`` → 17 (text → one decimal place →
    whole number, cut off); 64-bit ids."""
    return col(c).try_cast("decimal(20,1)").try_cast("long")


def bounded_id(c, max_id=None) -> Column:
    """CLN-04: non-numeric, 0 or > ``max_id`` (None: no bound) → NULL; else
    rounded to a whole number."""
    d = col(c).try_cast("decimal(20,1)")
    bad = d.isNull() | (d == 0)
    if max_id is not None:
        bad = bad | (d > (max_id if isinstance(max_id, Column) else F.lit(max_id)))
    return F.when(bad, F.lit(None).cast("long")).otherwise(F.round(d, 0).try_cast("long"))


def parse_money(c) -> Column:
    """CLN-05: strip ``USD``, quotes and minus signs (sign dropped, defect
    D12), decimal comma → point, trim, → decimal(18,2) or NULL."""
    t = F.regexp_replace(col(c), r'(?i)USD|["-]', "")
    t = F.trim(F.regexp_replace(t, ",", "."))
    return t.try_cast("decimal(18,2)")


def parse_decimal(c, precision: int = 18, scale: int = 2) -> Column:
    """CLN-06: plain decimal, negatives (returns) kept."""
    return col(c).try_cast(f"decimal({precision},{scale})")


def parse_int(c) -> Column:
    """CLN-07: a 64-bit whole number; text with a decimal point is NULL."""
    return col(c).try_cast("long")


def sentinel_int(c, sentinel: str = PAGES_SENTINEL) -> Column:
    """CLN-11: sentinel text → NULL, then CLN-08; a number too wide for an integer is NULL."""
    c = col(c)
    return F.when(c.isNull() | (F.trim(c) == sentinel), F.lit(None).cast("long")).otherwise(decimal_id(c)).try_cast("int")


def after_first_comma(c) -> Column:
    """CLN-12: keep the text after the first comma (undoes an unquoted
    ``"12,34",Email`` split), trimmed."""
    c = col(c)
    pos = F.instr(c, ",")
    return F.trim(F.when(pos > 0, c.substr(pos + 1, F.length(c))).otherwise(c))


def rename_rules(name, rules: list[tuple[Column, str]]) -> Column:
    """CLN-09: first matching (predicate, new value) wins, else trimmed name."""
    out = None
    for pred, value in rules:
        out = F.when(pred, value) if out is None else out.when(pred, value)
    return F.trim(col(name)) if out is None else out.otherwise(F.trim(col(name)))


def campaign_name_rules(name="campaign_name", start="start_date", end="end_date") -> Column:
    """CLN-09 with the reference's rules (raw date text compared)."""
    n, s, e = col(name), col(start), col(end)
    return rename_rules(n, [
        (((n == "Summer_Launch") & (s == "2023-12-30")) | ((n == "SUMMER_RETARGETING") & (e == "2024-01-26")),
         "New_Year_Launch"),
        ((n == "SUMMER_RETARGETING") & e.isin("2024-03-30", "2024-03-26"), "Brand_Awareness_Q1"),
        ((n == "SUMMER_RETARGETING") & ~e.isin("2024-03-30", "2024-03-26"), "Summer_Retargeting"),
    ])


def audit_column() -> Column:
    """CLN-14: load timestamp."""
    return F.current_timestamp().alias("dwh_create_date")


def blank_channel(c) -> Column:
    """NULL/blank → NULL, otherwise trimmed with its spelling kept (clicks and
    touchpoints)."""
    return F.nullif(F.trim(col(c)), F.lit(""))

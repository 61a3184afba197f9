"""Cleaner unit tests on literal dirty values (FIXTURES.md §1)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from touchline.functions import clean as C


def one(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_mixed_dates(spark):
    got = one(spark, ["2024-01-23", "18/05/2024", "22/12/2023", "2024/04/06", "not_available", "invalid",
                      "2024-13-40", None], lambda c: C.parse_mixed_date(c, ("not_available", "invalid"), [2023, 2024]))
    assert got == [dt.date(2024, 1, 23), dt.date(2024, 5, 18), dt.date(2023, 12, 22), dt.date(2024, 4, 6),
                   None, None, None, None]


def test_force_year_reproduces_d1(spark):
    got = one(spark, ["22/12/2023"], lambda c: C.parse_mixed_date(c, "invalid", [2023, 2024], force_year="2024"))
    assert got == [dt.date(2024, 12, 22)]


def test_mixed_timestamps(spark):
    got = one(spark, ["2024-01-05 10:11:12", "05/01/2024 10:11", "invalid_date", "not_a_date", "invalid", None],
              C.parse_mixed_timestamp)
    assert got == [dt.datetime(2024, 1, 5, 10, 11, 12), dt.datetime(2024, 1, 5, 10, 11), None, None, None, None]


def test_bounded_and_decimal_ids(spark):
    got = one(spark, ["17.0", "17.5", "0", "54", "999", "abc", "", None], lambda c: C.bounded_id(c, 53))
    assert got == [17, 18, None, None, None, None, None, None]
    assert one(spark, ["123.0", "x", None], C.decimal_id) == [123, None, None]


def test_money(spark):
    got = one(spark, ["12.50", "12.50USD", '"12,34"', "-5.00", "n/a"], C.parse_money)
    assert got == [Decimal("12.50"), Decimal("12.50"), Decimal("12.34"), Decimal("5.00"), None]
    assert one(spark, ["-20.00", '"12'], C.parse_decimal) == [Decimal("-20.00"), None]


def test_channels(spark):
    got = one(spark, ["GOOGLE SEARCH", "Google  Search", "Googel Search", "fb_ads", "FB Ads", "Facebok Ads",
                      "insta_Ads", "Instgram Ads", "tik_tok_ads", "", None, "Radio"], C.canonical_channel)
    assert got == ["Google Search"] * 3 + ["Facebook Ads"] * 3 + ["Instagram Ads"] * 2 + ["TikTok Ads", None, None,
                                                                                            "Radio"]


def test_shifted_channel(spark):
    assert one(spark, ['34",Email', "Email"], C.after_first_comma) == ["Email", "Email"]


def test_buckets(spark):
    assert one(spark, ["CONVERSION", "conv", "awarenss", "TRAFFIC", None, "other"], C.objective) == [
        "Conversion", "Conversion", "Awareness", "Traffic", None, "other"]
    assert one(spark, ["phone", "android", "mobile_web", "iphone", "desk_top", "tab_let", "tv"],
               lambda c: C.bucket(c, C.DEVICE_BUCKETS)) == ["Mobile"] * 4 + ["Desktop", "Tablet", "tv"]
    assert one(spark, ["click", "clik", "clk", "impr", "impressions", "page_view"],
               lambda c: C.bucket(c, C.INTERACTION_BUCKETS)) == ["Click"] * 3 + ["Impression"] * 2 + ["View"]
    assert one(spark, ["-1.0", "3.0", None, "99999999999.0", "x"], C.sentinel_int) == [None, 3, None, None, None]


def test_campaign_rename_rules(spark):
    df = spark.createDataFrame([("Summer_Launch", "2023-12-30", "x"), ("SUMMER_RETARGETING", "a", "2024-01-26"),
                                ("SUMMER_RETARGETING", "a", "2024-03-30"), ("SUMMER_RETARGETING", "a", "2024-05-01"),
                                (" Other ", "a", "b")], "campaign_name string, start_date string, end_date string")
    got = [r[0] for r in df.select(C.campaign_name_rules()).collect()]
    assert got == ["New_Year_Launch", "New_Year_Launch", "Brand_Awareness_Q1", "Summer_Retargeting", "Other"]


def test_first_acquisition_nulls_first_and_tie_break(spark):
    from touchline.operators.facts import first_acquisition
    rows = [(1, dt.date(2024, 2, 1), "Email", 3), (1, None, "SMS", 4),          # NULL date sorts first
            (2, dt.date(2024, 1, 5), "SMS", 1), (2, dt.date(2024, 1, 5), "Direct", 9),  # tie → channel
            (3, dt.date(2024, 3, 1), "Email", 2)]
    df = spark.createDataFrame(rows, "user_id long, acquisition_date date, acquisition_channel string, "
                                     "acquisition_campaign long")
    got = {r.user_id: (r.acquisition_channel, r.acquisition_campaign) for r in first_acquisition(df).collect()}
    assert got == {1: ("SMS", 4), 2: ("Direct", 9), 3: ("Email", 2)}


def test_timestamp_whole_seconds(spark):
    got = one(spark, ["2024-01-05 10:11:12.600", "2024-01-05 10:11:12.400", "05/01/2024 10:11"],
              lambda c: C.parse_mixed_timestamp(c, whole_seconds=True))
    assert got == [dt.datetime(2024, 1, 5, 10, 11, 13), dt.datetime(2024, 1, 5, 10, 11, 12),
                   dt.datetime(2024, 1, 5, 10, 11)]
    keep = one(spark, ["2024-01-05 10:11:12.600"], C.parse_mixed_timestamp)
    assert keep == [dt.datetime(2024, 1, 5, 10, 11, 12, 600000)]


def test_long_ids_truncate_and_text_is_trimmed(spark):
    assert one(spark, ["17.6", "17.0", "3000000000.0", " 12.0 "], C.decimal_id) == [17, 17, 3_000_000_000, 12]
    assert one(spark, ["3000000000", "17.5", "x"], C.parse_int) == [3_000_000_000, None, None]
    assert one(spark, ["17.6", "0", "99.0"], lambda c: C.bounded_id(c, 50)) == [18, None, None]
    assert one(spark, ["99.0", "3000000000.0"], C.bounded_id) == [99, 3_000_000_000]
    assert one(spark, ["Email ", " fb ads", "  ", " Radio"], C.canonical_channel) == ["Email", "Facebook Ads", None, "Radio"]
    assert one(spark, [" IPHONE ", "", "Fridge "], lambda c: C.bucket(c, C.DEVICE_BUCKETS)) == ["Mobile", None, "Fridge"]
    assert one(spark, ["  ", " fb ads "], C.blank_channel) == [None, "fb ads"]


def test_text_scan_with_a_pattern_separator_and_odd_headers(spark):
    from touchline.sources.bronze import split_lines
    lines = spark.createDataFrame([("\ufeffChannel_Name | Category",), ("a|b|c",), ("|x",)], "value string")
    got = split_lines(lines, ["channel_name", "category"], sep="|").collect()
    assert sorted((r.channel_name, r.category) for r in got if r.channel_name) == [("a", "b|c")]
    assert [(r.channel_name, r.category) for r in got if not r.channel_name] == [(None, "x")]


def test_digit_buckets_and_missing_date_keys(spark):
    from touchline.operators import quality as dq
    ids = spark.createDataFrame([(5,), (12345,), (1234567890123,), (None,), (99999,)], "id long")
    assert {(r.digits, r.n) for r in dq.digit_buckets(ids, "id").collect()} == {(1, 1), (5, 2), (13, 1), (None, 1)}
    days = spark.sql("SELECT date'2024-01-02' d, 20240102 date_key UNION ALL SELECT date'2024-01-03', NULL UNION ALL SELECT date'2024-01-04', 20240105")
    assert dq.date_key_mismatch(days, "d").count() == 2

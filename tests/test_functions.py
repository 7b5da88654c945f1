"""Literal-row tests for the Column functions (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gigframe.functions import (counter_review_count, month_abbrev, parse_event_date,
                                parse_review_count, parse_review_pct, parse_subgenre, present,
                                productivity_bucket, surrogate_key, touring_bucket, ws_trim)


def _eval(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_subgenre(spark):
    got = _eval(spark, parse_subgenre, [
        "Death Metal (early); Thrash (later)", "Black/Death Metal", "Heavy Metal, Rock",
        "Doom; Sludge", "(early)", "/x", "", None, "  ", " Folk Metal "])
    assert got == ["Death Metal", "Black", "Heavy Metal", "Doom; Sludge", None, None, None,
                   None, "", "Folk Metal"]


def test_review_count(spark):
    assert _eval(spark, parse_review_count, [None, "No Reviews", "12 (87%)", "x", ""]) == \
        [0, 0, 12, None, None]


def test_review_pct(spark):
    assert _eval(spark, parse_review_pct, ["12 (87%)", "12", "No Reviews", None]) == \
        [87, None, None, None]


def test_counter_review_count(spark):
    assert _eval(spark, counter_review_count,
                 ["12 (87%)", "12 reviews (87%)", "No Reviews", "", None, " 7 (1%)"]) == \
        [12, None, None, None, None, 7]


@pytest.mark.parametrize("n,label", [(0, "0-5"), (5, "0-5"), (6, "6-20"), (20, "6-20"),
                                     (21, "21-50"), (50, "21-50"), (51, "51-100"),
                                     (100, "51-100"), (101, "100+"), (None, "100+")])
def test_touring_bucket(spark, n, label):
    assert _eval(spark, touring_bucket, [n], "bigint") == [label]


def test_productivity_bucket(spark):
    assert _eval(spark, productivity_bucket, [2, 3, 6, 11, 20, 21], "bigint") == [
        "1-2 albums", "3-5 albums", "6-10 albums", "11-20 albums", "11-20 albums", "20+ albums"]


def test_month_abbrev(spark):
    assert _eval(spark, month_abbrev, [1, 12, 13], "bigint") == ["Jan", "Dec", None]


def test_year_safe_cast(spark):
    assert _eval(spark, lambda c: c.try_cast("bigint"), ["1986", "N/A", ""]) == [1986, None, None]


def test_event_date(spark):
    d = dt.date(2019, 8, 23)
    assert _eval(spark, parse_event_date, ["23-08-2019", "2019-08-23", "x"]) == [d, d, None]


def test_present_and_trim(spark):
    assert _eval(spark, present, ["a", "", None]) == [True, False, False]
    assert _eval(spark, ws_trim, ["\t a b \n"]) == ["a b"]


def test_surrogate_key_matches_md5_and_propagates_null(spark):
    import hashlib
    df = spark.createDataFrame([("1", "x", 1986), ("1", None, 1986)], "a string, b string, y bigint")
    got = [r[0] for r in df.select(surrogate_key("a", "b", "y")).collect()]
    assert got == [hashlib.md5(b"1|x|1986").hexdigest(), None]


def test_event_date_tries_one_format_only(spark):
    texts = ["23-08-2019", "2019-08-23", "x", "", None, "20-1-2019", "1-1-2020", "2019-8-23", "--------",
             "32-01-2020", "2019-13-01", "ab-cd-efgh"]
    d = dt.date(2019, 8, 23)
    assert _eval(spark, parse_event_date, texts) == [d, d] + [None] * 10
    plan = spark.range(1).select(parse_event_date(F.col("id").cast("string"))) \
        ._jdf.queryExecution().analyzed().toString()
    assert "CASE WHEN (substring(" in plan  # before: both formats were tried for most rows


def test_try_bigint_is_try_cast(spark):
    from gigframe.functions import try_bigint
    texts = ["1986", " 7 ", "\t+5", "-3", "N/A", "", None, "1.5", ".5", "12x", "9" * 30, "\x7f4", "inf"]
    want = _eval(spark, lambda c: c.try_cast("bigint"), texts)
    assert _eval(spark, try_bigint, texts) == want and want[:4] == [1986, 7, 5, -3]

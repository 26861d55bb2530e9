import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from wayprint.constants import BANNER_URL_PREFIXES
from wayprint.functions import (
    any_prefix, day_window, decimal_of, document_id, explode_codes, in_values, in_window, integer_mean_of,
    json_field, json_fields, label_flag, limbs_of, mean_of, not_blank, prefix_id, present, priority_of, reaches, url_segment,
    with_amount,
)

JSON_CASES = [
    ('{"userId":1,"code":"R1"}', "1", "R1"),
    ('{"userId":"1"}', "1", None),
    ('{"userId":null,"code":"R1"}', None, "R1"),
    ('{"userId":"","code":"R1"}', "", "R1"),
    ('{"userId":{"a":"x"},"code":"R1"}', "{a:x}", "R1"),
    ("[1]", None, None),
    ("not json", None, None),
    ("", None, None),
    (None, None, None),
]


@pytest.mark.parametrize("text,user,code", JSON_CASES)
def test_json_values(spark, text, user, code):
    df = spark.createDataFrame([(text,)], "param string")
    assert rows_of(df, json_field("param", "userId"), json_field("param", "code")) == [(user, code)]
    both = json_fields(df, "param", {"userId": "user_id", "code": "item_code"})
    assert rows_of(both, "user_id", "item_code") == [(user, code)]


@pytest.mark.parametrize("codes,expected", [
    ("a,b", ["a", "b"]), ("a,b,,", ["a", "b"]), (",a", ["", "a"]), (",", [""]), ("", [""]), ("a,,b", ["a", "", "b"]), (None, []),
])
def test_code_lists(spark, codes, expected):
    df = spark.createDataFrame([(1, codes)], "user_id int, codes string")
    assert [r.code for r in explode_codes(df, "codes", "code").collect()] == expected


@pytest.mark.parametrize("url,segment", [
    ("https://h/institute/17?x=1", "17"), ("https://h/institute/17", "17"), ("https://h/institute/17#top", "17#top"),
    ("https://h/institute/", ""), ("https://h/institute/?x=1", ""), ("https://h", ""), ("", ""), (None, None),
])
def test_url_segments(spark, url, segment):
    df = spark.createDataFrame([(url,)], "url string")
    assert rows_of(df, url_segment("url", 4)) == [(segment,)]


def test_prefix_ids(spark):
    urls = [(p + "/more", b) for b, p in BANNER_URL_PREFIXES.items()] + [("https://other.example.com", None), (None, None)]
    df = spark.createDataFrame(urls, "url string, expected string")
    found = df.select(prefix_id("url", BANNER_URL_PREFIXES).alias("found"), "expected").collect()
    assert all(r.found == r.expected for r in found)
    assert df.filter(any_prefix("url", BANNER_URL_PREFIXES.values())).count() == len(BANNER_URL_PREFIXES)
    assert not any(a != b and a.startswith(b) for a in BANNER_URL_PREFIXES.values() for b in BANNER_URL_PREFIXES.values())


def test_longest_prefix_wins(spark):
    df = spark.createDataFrame([("abc",)], "url string")
    for prefixes in ({"short": "a", "long": "ab"}, {"long": "ab", "short": "a"}):
        assert rows_of(df, prefix_id("url", prefixes)) == [("long",)]


def test_row_filters(spark):
    df = spark.createDataFrame([("a", "x"), ("", "x"), (None, "x"), ("b", None)], "k string, v string")
    assert rows_of(df.filter(not_blank("k")), "k") == [("a",), ("b",)]
    assert rows_of(df.filter(present("k", "v")), "k") == [("",), ("a",)]
    assert rows_of(df.filter(in_values("k", ["a", "a", "z"])), "k") == [("a",)]


def test_label_flags(spark):
    df = spark.createDataFrame([("家庭出行,十一",), ("x",), (None,)], "t string")
    assert {r[0]: r[1] for r in df.select("t", label_flag("t", "十一")).collect()} == {"家庭出行,十一": 1, "x": 0, None: None}


def test_day_window_of_instants(spark):
    # 2024-01-15 00:00 at GMT+8 is 16:00 UTC of the day before.
    at = ["2024-01-13 15:59:59.999999", "2024-01-13 16:00:00", "2024-01-14 15:59:59.999999", "2024-01-14 16:00:00"]
    df = spark.createDataFrame([(t,) for t in at], "t string").select("t", F.col("t").cast("timestamp").alias("at"))
    assert rows_of(df.filter(day_window(df, "at", dt.date(2024, 1, 15))), "t") == [(at[1],), (at[2],)]


def test_day_window_does_not_depend_on_session_zone(spark):
    df = spark.sql("SELECT timestamp_seconds(1705161600) AS at")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            assert df.filter(day_window(df, "at", dt.date(2024, 1, 15))).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_day_window_of_local_times_and_dates(spark):
    at = ["2024-01-13 23:59:59.999999", "2024-01-14 00:00:00", "2024-01-14 23:59:59.999999", "2024-01-15 00:00:00"]
    df = spark.createDataFrame([(t,) for t in at], "t string").select("t", F.col("t").cast("timestamp_ntz").alias("at"))
    assert rows_of(df.filter(day_window(df, "at", dt.date(2024, 1, 15))), "t") == [(at[1],), (at[2],)]
    days = df.select("t", F.to_date("at").alias("at"))
    assert rows_of(days.filter(day_window(days, "at", dt.date(2024, 1, 15))), "t") == [(at[1],), (at[2],)]
    assert days.filter(in_window(days, "at")).count() == 4
    dated = days.unionByName(days.limit(1).selectExpr("'none' as t", "cast(null as date) as at"))
    first, second = dt.date(2024, 1, 14), dt.date(2024, 1, 15)
    spans = [(None, first), (first, second), (second, None)]
    found = [r.t for s, e in spans for r in dated.filter(in_window(dated, "at", s, e)).collect()]
    assert sorted(found) == sorted([*at, "none"])
    with pytest.raises(TypeError):
        day_window(df, "t", dt.date(2024, 1, 15))


def test_ids_collide_but_keys_do_not(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), ("1", None)], "u string, i string")
    assert [r[0] for r in df.select(document_id("u", "i")).collect()] == ["123", "123", None]
    assert df.groupBy("u", "i").count().count() == 3


def summed(df, function=mean_of, **more):
    """A function of the sums of an amount's limbs and their count."""
    made = with_amount(df, "v", "v").filter("v_whole is not null")
    return made.agg(function(*[F.sum(c) for c in limbs_of("v")], F.count(F.lit(1)), **more)).first()[0]


def test_amounts_add_exactly_in_any_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, 0.7, -1e9] * 50
    totals = set()
    for order in (values, sorted(values), values[::-1]):
        totals.add(summed(spark.createDataFrame([(v,) for v in order], "v double").repartition(7)))
    assert totals == {65.0 / 300}


@pytest.mark.parametrize("text,amount", [
    ("1", "1"), ("0.29", "0.29"), ("n/a", None), (None, None), ("-2.5", "-2.5"), ("0.49996", "0.49996"), ("1e15", "1e15"), ("-0.1", "-0.1"),
    ("1.999999999", "1.999999999"), ("0.4999999999", "0.4999999999"), ("1e-9", "1e-9"), ("-1e-16", "-1e-16"), ("123456.78", "123456.78"),
    ("99999999.99", "99999999.99"), ("12345678.1234567", "12345678.1234567"), ("0.0123456789012345", "0.0123456789012345"),
    ("123456789012345.6", "123456789012346"), ("0", "0"), ("-0.0", "0"), ("9e17", "9e17")])
def test_limbs_hold_what_is_written(spark, text, amount):
    """Numbers of up to fifteen digits, exactly, from text and from doubles."""
    df = spark.createDataFrame([(text,)], "v string")
    for given in (df, df.select(F.col("v").try_cast("double").alias("v"))):
        found = with_amount(given, "v", "v").select("*", decimal_of(*map(F.col, limbs_of("v"))).alias("d")).first()
        assert found.d == (None if amount is None else Decimal(amount))
        assert amount is None or abs(found.v_high) <= 10**8 and abs(found.v_low) < 10**8


def test_limbs_of_other_types(spark):
    df = spark.sql("select 12345678901234567.0123456789012345BD as d, 7L as l, cast(null as int) as n, 0.5f as f")
    for column, amount in {"d": "12345678901234567.0123456789012345", "l": "7", "n": None, "f": "0.5"}.items():
        found = with_amount(df, column, "v").select(decimal_of(*map(F.col, limbs_of("v")))).first()[0]
        assert found == (None if amount is None else Decimal(amount)), column


@pytest.mark.parametrize("value", [1e25, -1e19, float("nan"), float("inf"), 1e-17])
def test_an_amount_that_does_not_fit_is_an_error(spark, value):
    with pytest.raises(Exception, match="cannot be added exactly"):
        with_amount(spark.createDataFrame([(value,)], "v double"), "v", "v").collect()


def test_sums_equal_decimal_arithmetic(spark):
    rng = random.Random(9)
    values = [round(rng.choice([-1, 1]) * 10 ** rng.uniform(-6, 7), rng.randrange(9)) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    total = sum(Decimal(repr(v)) for v in values if v)
    assert summed(df) == float(total) / len(values)
    assert summed(df, integer_mean_of) == (abs(int(total)) // len(values)) * (1 if total > 0 else -1)
    exact = float(total / len(values))
    assert summed(df, reaches, threshold=round(exact - 1e-6, 6)) and not summed(df, reaches, threshold=round(exact + 2e-6, 6))


@pytest.mark.parametrize("amounts,expected", [
    ([1.9, 1.9, 1.9], 1), ([10.0, 3.0], 6), ([-7.0, 0.0], -3), ([2.99], 2), ([1.99999], 1), ([1.999999999], 1), ([-1.999999999], -1),
    ([9e14, 9e14], 900000000000000), ([-0.5, 0.2], 0), ([5.0, -0.5], 2)])
def test_integer_means_truncate_twice(spark, amounts, expected):
    assert summed(spark.createDataFrame([(a,) for a in amounts], "v double"), integer_mean_of) == expected


@pytest.mark.parametrize("value,reached", [(0.5, True), (0.4999999999, False), (0.499999999999999, False), (0.50001, True)])
def test_a_threshold_is_decided_on_exact_numbers(spark, value, reached):
    assert summed(spark.createDataFrame([(value,)], "v double"), reaches, threshold=0.5) is reached


def test_priority_takes_the_first_flag(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (0, 1), (0, None), (2, 0)], "a int, b int")
    assert [r[0] for r in df.select(priority_of([("a", 3), ("b", 2)])).collect()] == [3, 2, 2, 0, 0]

"""Column functions on hand-made edge values."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martkit.functions import dates, keys, nested, numbers, text, urls
from tests.helpers import frame, values


def test_to_long(spark):
    got = values(spark, numbers.to_long, ["12", "-3", "+4", " 12 ", "12.5", "", None, "9" * 30, "1e3"])
    assert got == [12, -3, 4, None, None, None, None, None, None]


def test_to_double(spark):
    given_ = ["1.5", "1.", ".5", "1e3", "NaN", "inf", "1.0d", "0x1p3", " 1", "1,5", "", None]
    got = values(spark, numbers.to_double, given_)
    assert got == [1.5, 1.0, 0.5, 1000.0] + [None] * 8


def test_defaults(spark):
    assert values(spark, lambda c: numbers.to_long(c, 0), ["x", None, "7"]) == [0, 0, 7]
    assert values(spark, lambda c: numbers.to_double(c, 0), ["x", None, "7"]) == [0.0, 0.0, 7.0]


def test_decimal_comma(spark):
    got = values(spark, numbers.decimal_comma, ["1,5", "1.5", "1.234,56", "1,2,3", "", None, "nan"])
    assert got == [1.5, 1.5, 0.0, 0.0, 0.0, 0.0, 0.0]


def test_scrubs(spark):
    assert values(spark, numbers.scrub_int, ["1.234", "12.0", "R$ 7", "-5", "", None, "a"]) == [
        1234, 120, 7, -5, 0, 0, 0,
    ]
    assert values(spark, numbers.scrub_float, ["R$ 1,5", "1,2,3", "7%", "1.2.3", None]) == [
        1.5, 1.23, 7.0, 0.0, 0.0,
    ]


def test_brl(spark):
    got = values(spark, numbers.brl_to_decimal, ["R$ 1.234,56", "R$\xa010", "1,5", None])
    assert got == [Decimal("1234.56"), Decimal("10.00"), Decimal("1.50"), None]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", ["abc", "", "1,2,3", "R$"])
def test_brl_rejects_garbage(spark, ansi, bad):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="not an amount"):
            values(spark, numbers.brl_to_decimal, [bad])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=12), max_size=20))
def test_lenient_functions_never_raise(spark, texts):
    for fn in (numbers.to_long, numbers.to_double, numbers.decimal_comma, numbers.scrub_int,
               numbers.scrub_float, dates.parse_date, dates.parse_iso_ts,
               dates.pt_month_to_date_text, text.slugify, text.blank_to_zero,
               urls.normalize_video_url, urls.click_url):
        assert len(values(spark, fn, texts)) == len(texts)


def test_truncated(spark):
    assert values(spark, numbers.truncated, ["3.9", " -3.9 ", "x", None, "1e400"]) == [
        3, -3, None, None, None,
    ]


def test_dates(spark):
    got = values(spark, dates.parse_date, ["2025-1-5", " 2025-01-05 ", "2025-02-30", "05/01/2025", "0", None])
    assert got == [dt.date(2025, 1, 5)] * 2 + [None] * 4
    br = values(spark, lambda c: dates.parse_date(c, dates.BR_DATE), ["31/02/2025", "5/1/2025", "", "1.5"])
    assert br == [None, dt.date(2025, 1, 5), None, None]


def test_timestamps_ignore_zone(spark):
    given_ = ["2025-01-05T10:11:12.123+00:00", "2025-01-05 10:11:12-03:00", "2025-01-05", "soon", "", None]
    want = dt.datetime(2025, 1, 5, 10, 11, 12)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Sao_Paulo", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert values(spark, dates.parse_iso_ts, given_) == [want, want, None, None, None, None]
            ms = values(spark, dates.epoch_ms_to_ts, [0, 1736071872123, -1, None], "bigint")
            assert ms == [
                dt.datetime(1970, 1, 1), dt.datetime(2025, 1, 5, 10, 11, 12, 123000),
                dt.datetime(1969, 12, 31, 23, 59, 59, 999000), None,
            ]
            clock = [dt.datetime(1999, 10, 3, 0, 30), dt.datetime(1970, 1, 1, 0, 0, 0, 5000),
                     dt.datetime(1969, 12, 31, 23, 59, 59, 999000), None]
            back = values(spark, dates.ts_to_epoch_ms, clock, "timestamp_ntz")
            assert back == [938910600000, 5, -1, None]
            assert values(spark, dates.epoch_ms_to_ts, back, "bigint") == clock
            local = values(
                spark, lambda c: dates.br_text(dates.fixed_offset(dates.epoch_ms_to_ts(c))),
                [1736046000000, None], "bigint",
            )
            assert local == ["05/01/2025 00:00:00", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_pt_month(spark):
    got = values(spark, dates.pt_month_to_date_text, ["jan/2025", " FEV/2025", "dez/2026", "xyz/2025", None])
    assert got == ["01/01/2025", "01/02/2025", "01/12/2026", None, None]


def test_blank_to_zero(spark):
    got = values(spark, text.blank_to_zero, ["", "  ", "None", " NaN\t", "\xa0", None, " x ", "none!"])
    assert got == ["0", "0", "0", "0", "0", "0", "x", "none!"]


def test_null_tokens(spark):
    got = values(spark, text.null_tokens, ["", "null", "NULL", "None", "NaN", "none", " ", None])
    assert got == [None] * 5 + ["none", " ", None]


def test_slugify(spark):
    got = values(spark, text.slugify, ["UTM Campaign", "  A - b__C ", "Área nº 1", "_x_", "!!"])
    assert got == ["utm_campaign", "a_b_c", "rea_n_1", "x", ""]


def test_custom_field_name(spark):
    df = frame(spark, "t string, i string", ("UTM Source", "1"), (" ", "2"), (None, "3"))
    got = [r[0] for r in df.select(text.custom_field_name(F.col("t"), F.col("i"))).collect()]
    assert got == ["cf__utm_source", "cf__field_2", "cf__field_3"]


def test_format_label(spark):
    df = frame(
        spark, "n string, s string", ("A", "1"), (" A ", None), ("", "2"), (None, ""), ("nan", "nan")
    )
    got = [r[0] for r in df.select(text.format_label(F.col("n"), F.col("s"))).collect()]
    assert got == ["A [1]", "A", "unknown_list [2]", "unknown_list", "unknown_list"]


def test_keys(spark):
    df = frame(spark, "a int, b string", (1, "x"), (None, "x"), (2, None))
    got = [tuple(r) for r in df.select(keys.pipe_key(F.col("a"), F.col("b")), keys.md5_key(F.col("b"))).collect()]
    assert got == [
        ("1|x", "9dd4e461268c8034f5c8564e155c67a6"), (None, "9dd4e461268c8034f5c8564e155c67a6"),
        (None, "d41d8cd98f00b204e9800998ecf8427e"),
    ]


def test_fallback_key(spark):
    df = frame(
        spark, "id long, email string, role string",
        (7, "A@x", "BUYER"), (None, "a@x", "BUYER"), (None, "", "BUYER"), (None, None, None), (8, None, None),
    )
    key = keys.fallback_key(F.col("role"), id=F.col("id"), email=F.lower("email"))
    assert [r[0] for r in df.select(key).collect()] == [
        "id:7|role:BUYER", "email:a@x|role:BUYER", None, None, "id:8|role:",
    ]


def test_urls(spark):
    given_ = [
        "https://e.org/a", "/page/videos/12/", "123", "9_8", "/rel", "other", "", None,
        "https://e.org/videos/5/x", "videos/5",
    ]
    watch = "https://www.facebook.com/watch/?v="
    assert values(spark, urls.normalize_video_url, given_) == [
        "https://e.org/a", watch + "12", watch + "123", "https://www.facebook.com/9/posts/8",
        "https://www.facebook.com/rel", "other", "", "", "https://e.org/videos/5/x", "videos/5",
    ]
    assert values(spark, urls.click_url, given_)[-2:] == [watch + "5", "videos/5"]


ACTION = "array<struct<action_type:string,value:string>>"


def test_action_value(spark):
    lists = [
        [("lead", "3.0"), ("lead", "9")], [("lead", "x")], [("other", "1")], [], None, [("lead", None)],
        [("lead", " 2 ")],
    ]
    longs = values(spark, lambda c: nested.action_value(c, "lead"), lists, ACTION)
    assert longs == [3, 0, 0, 0, 0, 0, 2]
    doubles = values(spark, lambda c: nested.action_value(c, "lead", as_double=True), lists, ACTION)
    assert doubles == [3.0, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0]


TARGETING = (
    "struct<custom_audiences:array<struct<id:string,name:string>>,"
    "flexible_spec:array<struct<custom_audiences:array<struct<id:string,name:string>>>>>"
)


def test_audience_text(spark):
    given_ = [
        ([("1", "B"), ("2", None)], [([("3", "A"), ("4", "B")],), (None,), ([("0", "")],)]),
        (None, None), None, ([], []), ([("9", None)], None), ([(None, None)], None),
    ]
    got = values(spark, nested.audience_text, given_, TARGETING)
    assert got == ["A | B | CA:0 | CA:2", "", "", "", "CA:9", ""]


def test_first_of(spark):
    arrays = [["a", "b"], [], None, [None, "c"]]
    assert values(spark, nested.first_of, arrays, "array<string>") == ["a", None, None, None]


def test_set_join(spark):
    arrays = [["b", " a", "a", "", "nan", None], [], None]
    assert values(spark, nested.set_join, arrays, "array<string>") == ["a, b", "", None]

"""Scalar rules: casts, dates, prices, article texts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriesmill import fixed
from seriesmill.functions import articles, casts, dates, prices
from seriesmill.operators import pages


def one(spark, schema, values, expr):
    rows = spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)
    return [r[0] for r in rows.select(expr).collect()]


def test_lenient_casts(spark):
    texts = ["7", "7.0", "7.5", "x", "NaN", "9007199254740993", None]
    assert one(spark, "t string", texts, casts.to_id(F.col("t"))) == [7, 7, None, None, None, 9007199254740993, None]
    assert one(spark, "t string", ["1.5", "abc", "NaN", None], casts.to_number(F.col("t"))) == [1.5, None, None, None]
    assert one(spark, "t string", ["2024-02-30", "2024-02-03"], casts.to_date(F.col("t"))) == [None, dt.date(2024, 2, 3)]
    assert one(spark, "t string", ["\t R01 \n"], casts.strip(F.col("t"))) == ["R01"]


def test_price_map_reads_both_spellings(spark):
    text = ["{'NPK 16-16-8': '720000-740000', 'Kali': None}", '{"Ure Cà Mau": "620000-640000", "Kali": null}']
    m = prices.price_map(F.col("t"))
    npk = one(spark, "t string", text, prices.range_mid(prices.item_price(m, "NPK 16-16-8")))
    urea = one(spark, "t string", text, prices.range_mid(prices.item_price(m, "Urê Cà Mau")))
    kali = one(spark, "t string", text, prices.item_price(m, "Kali"))
    assert (npk, urea, kali) == ([14600.0, None], [None, 12600.0], [None, None])


def test_ranges_and_bounds(spark):
    texts = ["5900-6000", "8450", "x", None]
    assert one(spark, "t string", texts, prices.range_low(F.col("t"))) == [5900.0, 8450.0, None, None]
    assert one(spark, "v double", [2026.0, 6000.0], prices.within(F.col("v"), 4000, 20000)) == [None, 6000.0]


@pytest.mark.parametrize(
    "item,text,found",
    [
        ("NPK 16-16-8", "NPK 16-16-8 720.000 – 740.000 đồng", "720000-740000"),
        ("NPK 16-16-8", "phân npk 16 16 8 giá 700.000", "700000"),
        ("NPK 16-16-8", "NPK 16-16-8 (16168) bao 750.000", "750000"),
        ("NPK 16-16-8", "NPK 16-16-8 16168 không giá", None),
        ("Kali", "KALI bột 90.000", None),
        ("Kali", "kali 2500.000", None),
        ("Urê Cà Mau", "Cà Mau 610.000; Đạm Cà Mau 630.000", "630000"),
        ("Urê Cà Mau", "ĐẠM CÀ MAU: 615000", "615000"),
        ("Kali", "không có", None),
    ],
)
def test_price_after_keyword(spark, item, text, found):
    df = spark.createDataFrame([(text,)], "t string")
    assert pages.with_text_prices(df, "t", {"p": fixed.FERT_ALIASES[item]}).first()["p"] == found


@pytest.mark.parametrize(
    "title,text,expected",
    [
        ("", "CPI THÁNG 1 TĂNG 0,52 %", ("Tăng", "0.52")),
        ("", "Lạm phát cơ bản giảm nhẹ 0.03%", ("Giảm", "0.03")),
        ("", "chỉ số giá tiêu dùng Ổn Định quanh 0,1 %", ("Đi ngang", "0.1")),
        ("Giá tăng 1,5%", "không nhắc đến", ("Tăng", "1.5")),
        ("Giá 1,5%", "không nhắc đến", ("Không rõ", "1.5")),
        ("Giá giảm", "không nhắc đến", ("Không rõ", None)),
        ("", "CPI\ntăng 0,5%", ("Không rõ", None)),
    ],
)
def test_index_move(spark, title, text, expected):
    rows = spark.createDataFrame([(title, text)], "title string, text string")
    got = pages.with_index_move(rows, "title", F.concat_ws(". ", "title", "text"))
    assert tuple(got.select("trend", "amount").first()) == expected


def test_signed_change_and_label(spark):
    rows = spark.createDataFrame([(0.2, "Giảm"), (0.2, "Tăng"), (0.0, "Ổn định")], "v double, t string")
    signed = articles.signed_change(F.col("v"), F.col("t"))
    got = rows.select(signed, articles.trend_label(signed)).collect()
    assert [tuple(r) for r in got] == [(-0.2, "Giảm"), (0.2, "Tăng"), (0.0, "Ổn định")]


def test_url_dates(spark):
    day = dt.date(2020, 5, 5)
    urls = [
        "gia-phan-hom-nay-812-x-2024.htm", "gia-hom-nay-1012-2024", "gia-ngay-81-2024", "gia-hom-nay-121-2024",
        "gia-ngay-5-2024", "gia-hom-nay-812-2021", "gia-phan",
    ]
    expr = dates.url_date(F.col("u"), F.lit(day))
    assert one(spark, "u string", urls, expr) == [
        dt.date(2024, 12, 8), dt.date(2024, 12, 10), dt.date(2024, 1, 8), day, day, day, day,
    ]


def test_day_first(spark):
    texts = ["5/2/2024", "05-02-2024", "2024-02-05", "12/25/2024", "chưa rõ", None]
    assert one(spark, "t string", texts, dates.day_first(F.col("t"))) == [
        "2024-02-05", "2024-02-05", "2024-02-05", "2024-12-25", "chưa rõ", None,
    ]


def test_calendar(spark):
    day = F.lit(dt.date(2024, 11, 30))
    rows = spark.range(1).select(
        dates.month_start(day), dates.forecast_month(day, 3), dates.month_label(day), *dates.month_cycle(F.lit(3))
    ).first()
    assert rows[0] == dt.date(2024, 11, 1) and rows[1] == dt.date(2025, 2, 1) and rows[2] == "11/2024"
    assert rows[3] == pytest.approx(1.0) and rows[4] == pytest.approx(0.0)


def test_date_texts_that_are_not_iso(spark):
    texts = ["2024-01-05", "2024/01/05", "05/01/2024", "25/01/2024", "20240105", "2024.1.5", "2024-01-05T10:30", "2024/1/5 10:30:00", "5", "soon", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(casts.to_date(F.col("t")).alias("d")).collect()
    day = dt.date(2024, 1, 5)
    assert [r.d for r in rows] == [day, day, dt.date(2024, 5, 1), dt.date(2024, 1, 25), day, day, day, day, None, None, None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert frame.agg(casts.unread_dates(F.col("t"))).first()[0] == 2


def test_day_first_with_time_and_short_year(spark):
    texts = ["05/01/2024 10:30", "3/4/24", "3-4-24 7:05:09", "31.12.1999", "chưa rõ", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(dates.day_first(F.col("t")).alias("d")).collect()
    assert [r.d for r in rows] == ["2024-01-05", "2024-04-03", "2024-04-03", "1999-12-31", "chưa rõ", None]

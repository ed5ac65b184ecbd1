"""Queries over sources, staging rules and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from seriesmill import fixed
from seriesmill.functions import dates, prices
from seriesmill.operators import fills, pages, profile, staging
from seriesmill.plans import standins as st
from seriesmill.session import fresh_dir
from seriesmill.sources import files, star
from seriesmill.streaming import ingest


# --- sources and sinks ---------------------------------------------------------------


def load_star(spark, sf) -> DataFrame:
    base = fresh_dir(spark, "star")
    for name, df in st.star(spark, sf).items():
        df.write.parquet(f"{base}/{fixed.FACT_TABLE if name == 'fact' else name}.parquet")
    return profile.shapes(star.load_star(spark, base))


def read_csv_schema(spark, sf) -> DataFrame:
    path = fresh_dir(spark, "csv")
    rows = st.table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("date").alias("report_date"), "event_type", "value",
        F.when(F.col("event_id") % 9 != 0, F.col("props")).alias("data"),
    )
    files.write_csv(rows, path)
    schema = "event_id bigint, report_date date, event_type string, value double, data string"
    return files.read_csv(spark, path, schema)


def write_csv(spark, sf) -> DataFrame:
    path = fresh_dir(spark, "csv")
    quoted = F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('"'))
    files.write_csv(
        st.table(spark, sf, "customer").select("c_custkey", quoted.alias("label"), "c_acctbal"), path
    )
    return files.read_csv(spark, path, "c_custkey bigint, label string, c_acctbal double")


def write_json(spark, sf) -> DataFrame:
    path = fresh_dir(spark, "json")
    label = F.concat(F.lit("giá gạo "), F.col("event_type"))
    rows = st.table(spark, sf, "events").select(
        "event_id", label.alias("tieu_de"),
        F.when(F.col("event_id") % 9 != 0, F.col("value")).alias("muc_tang_giam"),
    )
    files.write_json(rows, path)
    return files.read_json(spark, path, "event_id bigint, tieu_de string, muc_tang_giam double")


def clean_fact(spark, sf) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    raw = st.table(spark, sf, "orders").select(
        key.alias("row_key"),
        F.when(key % 13 == 0, "bad day").when(key % 11 == 0, F.date_format(day, "yyyy/MM/dd"))
        .when(key % 7 == 0, F.date_format(day, "M/d/yyyy")).when(key % 6 == 0, F.date_format(day, "yyyyMMdd"))
        .when(key % 5 == 0, F.date_format(day, "yyyy-MM-dd HH:mm")).otherwise(day.cast("string")).alias("date_id"),
        F.when(key % 17 == 0, "x").when(key % 3 == 0, F.concat((key % 5).cast("string"), F.lit(".0")))
        .when(key % 19 == 0, "1.5").otherwise((key % 5).cast("string")).alias("region_id"),
        (key % 4).cast("string").alias("eco_id"),
        F.when(key % 23 == 0, "NaN").otherwise(F.col("o_totalprice").cast("string")).alias("price_rice"),
        F.concat(F.lit(" \t"), F.col("o_orderpriority"), F.lit(" ")).alias("rice_id"),
    )
    return star.clean_fact(raw)


def ingest_stream(spark, sf) -> DataFrame:
    schema = st.table(spark, sf, "events").schema
    return ingest.refresh(
        spark, sf, schema, fresh_dir(spark, "feed"), fresh_dir(spark, "state"),
        keys=["event_type", "user_id"], day="ts", name_filter="events.parquet",
    ).select("event_type", "user_id", F.col("ts").cast("date").alias("day"))


# --- staging rules -------------------------------------------------------------------


def parse_price_map(spark, sf) -> DataFrame:
    kind = F.col("event_id") % 3
    named = F.replace(
        "props", F.lit('"k"'), F.when(F.col("event_id") % 2 == 0, '"Ure Cà Mau"').otherwise('"Urê Cà Mau"')
    )
    single = F.replace(named, F.lit('"'), F.lit("'"))
    kali = F.when(F.col("event_id") % 5 == 0, "None").otherwise(F.concat(F.lit("'"), F.col("event_id").cast("string"), F.lit("'")))
    with_none = F.concat(F.substring(single, F.lit(1), F.length(single) - 1), F.lit(", 'Kali': "), kali, F.lit("}"))
    rows = st.table(spark, sf, "events").select(
        "event_id", F.when(kind == 0, named).when(kind == 1, single).otherwise(with_none).alias("data")
    )
    out = staging.parse_items(rows, "data", {"Urê Cà Mau": "ure", "Kali": "kali"})
    return out.select("event_id", "ure", "kali")


def _ranges(spark, sf) -> DataFrame:
    low = F.col("p_size") * 100
    high = low + F.col("p_partkey") % 50 * 10
    text = F.when(F.col("p_partkey") % 5 == 0, low.cast("string")).otherwise(F.concat_ws("-", low, high))
    return st.table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 7 != 0, text).alias("price_text")
    )


def range_low(spark, sf) -> DataFrame:
    return _ranges(spark, sf).select("p_partkey", prices.range_low(F.col("price_text")).alias("price"))


def range_mid(spark, sf) -> DataFrame:
    return st.rounded(
        _ranges(spark, sf).select("p_partkey", prices.range_mid(F.col("price_text")).alias("price_per_kg"))
    )


def ffill(spark, sf) -> DataFrame:
    rows = st.table(spark, sf, "events").select(
        "event_type", "event_id", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value")
    )
    return fills.forward_fill(
        rows, ["event_type"], "event_id", ["value"], block=fills.number_block("event_id", 4096)
    )


def neighbor_mean_fill(spark, sf) -> DataFrame:
    return st.rounded(
        fills.neighbor_mean_fill(
            st.gappy_daily(spark, sf, every_day=True), ["event_type"], "date", ["mean_value", "max_value"], cascade=True
        )
    )


def linear_interp(spark, sf) -> DataFrame:
    return st.rounded(
        fills.linear_interpolate(
            st.gappy_daily(spark, sf), ["event_type"], "date", ["mean_value", "max_value"]
        )
    )


def dedupe_rows(spark, sf) -> DataFrame:
    return staging.dedupe(
        st.table(spark, sf, "events").select("event_type", "user_id", F.col("ts").cast("date").alias("day"))
    )


def overlay_fix(spark, sf) -> DataFrame:
    orders = st.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderstatus").alias("feed"), F.col("o_totalprice").alias("price"),
    )
    recent = F.col("day") >= F.lit("2001-01-01").cast("date")
    fix = orders.where((F.col("feed") == "P") & (F.col("o_orderkey") % 2 == 0)).withColumn(
        "price", F.col("price") + 1000
    )
    fixed_rows = staging.overlay(orders.where(~recent), fix, F.col("feed") == "P")
    return staging.append_newer(fixed_rows, orders.where(recent), ["o_orderkey"])


def signed_change(spark, sf) -> DataFrame:
    status = F.col("o_orderstatus")
    rows = st.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status == "P", 0.0).otherwise(F.col("o_totalprice")).alias("change"),
        F.when(status == "F", fixed.DOWN).when(status == "O", fixed.UP).otherwise(fixed.STABLE).alias("trend"),
    )
    return staging.signed_changes(rows, "change", "trend")


def yield_derive(spark, sf) -> DataFrame:
    area = F.when(F.col("l_linenumber") == 7, 0.0).otherwise(F.col("l_quantity"))
    kg = staging.derived_yield(F.col("l_extendedprice"), area)
    return st.rounded(
        st.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", kg.alias("yield_kg"))
    )


def spot_reading_flag(spark, sf) -> DataFrame:
    days = (
        st.table(spark, sf, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("day"), "l_suppkey")
        .agg(F.avg("l_quantity").alias("a"), F.max("l_quantity").alias("h"), F.min("l_quantity").alias("l"))
    )
    flag = staging.is_spot_reading(F.col("a"), F.col("h"), F.col("l"))
    return days.select("day", "l_suppkey", flag.alias("is_spot"))


def price_range_guard(spark, sf) -> DataFrame:
    guarded = prices.within(F.col("o_totalprice"), 50_000, 300_000)
    return st.table(spark, sf, "orders").select("o_orderkey", guarded.alias("price"))


# --- text and dates ------------------------------------------------------------------


def page_title(spark, sf) -> DataFrame:
    """Titles of the index articles; every other page has one with an entity and a tag inside."""
    n = F.col("page_id")
    heading = F.concat(F.lit('<h1 class="detail-title">Gạo &amp; Cám <b>tăng</b> '), n.cast("string"), F.lit("</h1>"))
    html = F.concat(F.when(n % 2 == 0, heading).otherwise(""), F.col("html"))
    records = pages.index_articles(st.table(spark, sf, "pages").select(n.cast("string").alias("url"), html.alias("html")))
    return records.select(F.col("url").cast("bigint").alias("page_id"), F.col("tieu_de").alias("title"))


def _dressed_pages(spark, sf) -> DataFrame:
    """Pages with a publication tag, a shown date, an index sentence and a price table by rule."""
    n = F.col("page_id")
    day = F.lpad((n % 28 + 1).cast("string"), 2, "0")
    meta = F.concat(F.lit('<meta property="article:published_time" content="2024-03-'), day, F.lit('T08:00:00">'))
    shown = F.concat(F.lit('<div class="detail-time">'), (n % 28 + 1).cast("string"), F.lit("/7/2023 09:15</div>"))
    move = F.when(n % 2 == 0, "TĂNG").otherwise("giảm")
    value = F.concat((n % 9).cast("string"), F.lit(","), (n % 90 + 10).cast("string"))
    body = F.concat(F.lit('<div class="detail-content">CPI tháng này '), move, F.lit(" so với tháng trước "), value,
                    F.lit(" %</div>"))
    place = F.when(n % 3 == 0, "Long An").when(n % 3 == 1, "Hà Nội").otherwise("ĐBSCL")
    urea = F.concat((n % 500 + 400).cast("string"), F.lit(".000 - "), (n % 500 + 420).cast("string"), F.lit(".000"))
    prices_table = F.concat(
        F.lit("<table><tr><th>"), place, F.lit("</th></tr><tr><td>Phân Kali</td><td>"),
        (n % 300 + 90).cast("string"), F.lit(".000</td></tr><tr><td>Urê Cà Mau</td><td>"), urea,
        F.lit("</td></tr><tr><td>NPK 16-16-8</td><td>16.168 650.000</td></tr></table>"),
    )
    html = F.replace("html", F.lit("</head>"), F.concat(F.when(n % 3 == 0, meta).otherwise(""), F.lit("</head>")))
    tail = F.concat(
        F.when(n % 3 != 2, shown).otherwise(""), F.when(n % 4 != 3, body).otherwise(""),
        prices_table,
    )
    return st.table(spark, sf, "pages").select("page_id", "url", F.concat(html, tail).alias("html"))


def article_date(spark, sf) -> DataFrame:
    records = pages.index_articles(_dressed_pages(spark, sf))
    return records.select("url", "ngay_thang")


def article_records(spark, sf) -> DataFrame:
    records = pages.index_articles(_dressed_pages(spark, sf))
    return records.select("url", "tieu_de", "xu_huong_bien_dong", "muc_tang_giam", "don_vi")


def region_table_prices(spark, sf) -> DataFrame:
    rows = _dressed_pages(spark, sf).withColumn("ngay_dang", F.concat((F.col("page_id") % 28 + 1).cast("string"), F.lit("/2/2024")))
    found = pages.fertilizer_articles(rows)
    return found.select(
        "id", "ngay_dang", "url", *[F.col("data")[item].alias(f"price_{i}") for i, item in enumerate(fixed.FERT_ITEMS)]
    )


def trend_extract(spark, sf) -> DataFrame:
    key = F.col("o_orderkey")
    word = F.when(key % 4 == 0, "TĂNG").when(key % 4 == 1, "giảm").when(key % 4 == 2, "ổn định").otherwise("đứng yên")
    value = F.concat((key % 7).cast("string"), F.lit(","), (key % 89 + 10).cast("string"))
    body = F.concat(F.lit("Theo báo cáo, chỉ số giá tiêu dùng "), word, F.lit(" nhẹ "), value, F.lit(" %"))
    title = F.when(key % 5 == 0, F.concat(F.lit("Giá cả Tăng "), value, F.lit("%"))).otherwise("Tin thị trường")
    rows = st.table(spark, sf, "orders").select("o_orderkey", title.alias("title"), body.alias("body"))
    found = pages.with_index_move(rows, "title", F.concat_ws(". ", "title", "body"))
    return found.select("o_orderkey", "trend", "amount")


def _article_urls(spark, sf) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    key = F.col("o_orderkey")
    ddmm = F.when(key % 4 == 0, F.date_format(day, "ddMM")).when(key % 4 == 1, F.date_format(day, "dMM")).when(
        key % 4 == 2, F.date_format(day, "dM")).otherwise("")
    word = F.when(key % 2 == 0, "hom-nay-").otherwise("ngay-")
    year = (key % 6 + 2021).cast("string")
    url = F.concat(F.lit("https://news.example/gia-phan-bon-"), word, ddmm, F.lit("-tin-"), year, F.lit(".htm"))
    return st.table(spark, sf, "orders").select("o_orderkey", url.alias("URL"), day.cast("string").alias("Ngaydang"))


def url_date(spark, sf) -> DataFrame:
    return pages.clean_dates(_article_urls(spark, sf))


def dayfirst_date(spark, sf) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    key = F.col("o_orderkey")
    text = F.when(key % 12 == 0, F.date_format(day, "d/M/yyyy HH:mm")).when((key % 12 == 4) & (F.year(day) >= 2000), F.date_format(day, "d/M/yy")).when(
        key % 4 == 0, F.date_format(day, "d/M/yyyy")).when(key % 4 == 1, F.date_format(day, "yyyy-MM-dd")).when(
        key % 4 == 2, F.date_format(day, "dd-MM-yyyy")).otherwise("chưa rõ")
    return st.table(spark, sf, "orders").select("o_orderkey", dates.day_first(text).alias("day"))


def price_extract(spark, sf) -> DataFrame:
    key = F.col("o_orderkey")
    low = key % 700 + 80
    price = F.concat(low.cast("string"), F.lit(".000"))
    span = F.when(key % 3 == 0, F.concat(price, F.lit(" – "), (low + 20).cast("string"), F.lit(".000"))).otherwise(price)
    text = F.concat(
        F.lit("Giá npk 16-16-8 loại "), F.when(key % 5 == 0, "16.168 bao ").otherwise(""), span,
        F.lit(" đồng; KALI bột "), F.when(key % 7 == 0, "chưa có").otherwise(span),
    )
    rows = st.table(spark, sf, "orders").select("o_orderkey", text.alias("text"))
    items = {f"price_{i}": fixed.FERT_ALIASES[item] for i, item in enumerate(fixed.FERT_ITEMS[:2])}
    return pages.with_text_prices(rows, "text", items).drop("text")


QUERIES = [
    load_star, read_csv_schema, write_csv, write_json, clean_fact, ingest_stream,
    parse_price_map, range_low, range_mid, ffill, neighbor_mean_fill, linear_interp, dedupe_rows,
    overlay_fix, signed_change, yield_derive, spot_reading_flag, price_range_guard,
    page_title, article_date, article_records, region_table_prices, trend_extract, url_date,
    dayfirst_date, price_extract,
]

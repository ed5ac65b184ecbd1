"""Page extraction on hand-made pages."""

from pyspark.sql import functions as F

from seriesmill.operators import pages

INDEX_PAGE = """<html><head><title>t</title>
<meta itemprop="datePublished" content="2023-01-29T10:00">
<meta property="article:published_time" content="2024-02-05T08:00"></head>
<body><h1>Other</h1><h1 class="big detail-title"> CPI  <b>tháng 1</b></h1>
<div class="detail-time">1/1/2020</div><h2 class="detail-sapo">Tóm tắt.</h2>
<div class="detail-content"><div>Lạm phát</div><p>tăng &nbsp;0,52&#37;</p></div><div class="content">no</div></body></html>"""
PLAIN_PAGE = """<h1>Giá giảm 1,2%</h1><div class="detail-time">Ngày 7/3/2023 10:00</div><div class="content">x</div>"""
EMPTY_META = """<meta property="article:published_time"><h1>x</h1><div class="detail-time">7/3/2023</div>"""


def test_index_articles(spark):
    rows = [("u1", INDEX_PAGE), ("u2", PLAIN_PAGE), ("u3", EMPTY_META), ("u4", None)]
    got = {r["url"]: r for r in pages.index_articles(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert set(got) == {"u1", "u2", "u3"}
    assert got["u1"]["tieu_de"] == "CPItháng 1"
    assert got["u1"]["ngay_thang"] == "05/02/2024"
    assert (got["u1"]["xu_huong_bien_dong"], got["u1"]["muc_tang_giam"]) == ("Tăng", "0.52")
    assert got["u2"]["ngay_thang"] == "7/3/2023"
    assert (got["u2"]["xu_huong_bien_dong"], got["u2"]["muc_tang_giam"], got["u2"]["don_vi"]) == ("Giảm", "1.2", "%")
    # a meta tag without a date wins over the shown date
    assert got["u3"]["ngay_thang"] is None


def table(place, kali):
    return f"<table><tr><td>{place}</td></tr><tr><td>Kali</td><td>{kali}</td></tr></table>"


def test_region_tables(spark):
    rows = [
        ("2/1/2024", "http://a", table("Long An", "500.000") + table("Hà Nội", "900.000") + table("Cần Thơ", "510.000 - 530.000")),
        ("1/1/2024", "http://b", table("Hà Nội", "900.000") + "<p>NPK 16-16-8: 700.000</p>"),
        ("3/1/2024", "ftp://c", table("Long An", "500.000")),
        ("4/1/2024", "http://d", None),
        ("5/1/2024", "http://e", "<table><tr><td>ĐBSCL</td></tr></table><script>Kali 800.000</script><p>Cà Mau 600.000</p>"),
    ]
    df = spark.createDataFrame(rows, "ngay_dang string, url string, html string")
    got = {r["url"]: r for r in pages.fertilizer_articles(df).collect()}
    kali = {u: r["data"]["Kali"] for u, r in got.items()}
    assert kali == {"http://a": "510000-530000", "http://b": "900000", "ftp://c": None, "http://d": None, "http://e": None}
    assert got["http://b"]["data"]["NPK 16-16-8"] == "700000"
    assert got["http://e"]["data"]["Urê Cà Mau"] == "600000"
    assert [r["id"] for _, r in sorted(got.items(), key=lambda x: x[1]["ngay_dang"])] == [1, 2, 3, 4, 5]
    assert got["http://a"]["ngay_dang"] == "2024-01-02"


def test_positions_with_one_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("u"))
    got = pages.with_position(df, ["u"], "n")
    assert sorted(r["n"] for r in got.collect()) == list(range(1, 5001))
    names = [r["u"] for r in got.orderBy("n").collect()]
    assert names == sorted(names)


def test_unclosed_tags_and_nested_tables(spark):
    html = "<table>Long An<tr><td>Kali 500.000<table><tr><td>Cà Mau 600.000</table></table><div class='content'>a<p>b"
    texts = pages.page_texts(spark.createDataFrame([("u", html)], "url string, html string")).first()
    assert len(texts["tables"]) == 2 and "600.000" in texts["tables"][0]
    assert texts["any_body"] == "ab"


def test_clean_dates(spark):
    rows = [("x-hom-nay-81-2024", "2020-01-01"), ("y", "nonsense"), ("z", "2024-05-05")]
    got = pages.clean_dates(spark.createDataFrame(rows, "URL string, Ngaydang string")).collect()
    assert [tuple(r) for r in got] == [("2024-05-05", "z"), ("2024-01-08", "x-hom-nay-81-2024"), ("nonsense", "y")]

"""Raw rows to staging rows, files, stream ingest."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriesmill.operators import staging
from seriesmill.session import fresh_dir
from seriesmill.sources import files, star
from seriesmill.streaming import ingest

FERT = {"NPK 16-16-8": "npk", "Kali": "kali", "Urê Cà Mau": "ure"}


def test_stage_rice(spark):
    rows = [
        (dt.date(2024, 1, 1), "{'OM 5451': '5900-6000', 'Tấm': None}"),
        (dt.date(2024, 1, 3), '{"OM 5451": "6100", "Tấm": "7500"}'),
        (dt.date(2024, 2, 1), "{'OM 5451': None, 'Tấm': None}"),
    ]
    df = spark.createDataFrame(rows, "report_date date, data string")
    got = staging.stage_rice(df, {"OM 5451": "om", "Tấm": "tam"}).orderBy("report_date").collect()
    assert [(r["om"], r["tam"]) for r in got] == [(5900, None), (6100, 7500), (6100, 7500)]


def test_stage_fertilizer(spark):
    def text(npk, kali, ure):
        return f'{{"NPK 16-16-8": "{npk}", "Kali": {kali}, "Ure Cà Mau": "{ure}"}}'

    day = lambda n: dt.date(2025, 12, n)
    raw = [
        (day(18), text("700000-720000", '"500000"', "600000"), False),
        (day(18), text("700000-720000", '"500000"', "600000"), False),
        (day(19), text("710000", "null", "100000"), False),
        (day(20), text("720000", '"520000"', "620000"), False),
        (day(23), text("1", '"1"', "1"), True),
    ]
    fix = [(day(23), text("750000", '"550000"', "650000"))]
    got = staging.stage_fertilizer(
        spark.createDataFrame(raw, "report_date date, data string, second boolean"),
        spark.createDataFrame(fix, "report_date date, data string"), F.col("second"), FERT, "2025-12-20",
    ).orderBy("report_date").collect()
    assert [(r["report_date"].day, r["npk"], r["kali"], r["ure"]) for r in got] == [
        (18, 14200, 10000, 12000), (19, 14200, 10200, 12200), (20, 14400, 10400, 12400),
        (21, 14600, 10600, 12600), (22, 14800, 10800, 12800), (23, 15000, 11000, 13000),
    ]


def test_unread_maps_are_counted(spark):
    df = spark.createDataFrame([("{'a': None}",), ("not a map",), (None,)], "t string")
    assert tuple(staging.unread_maps(df, "t").first()) == (1, 3)


def test_append_newer_keeps_known_rows(spark):
    base = spark.createDataFrame([(1, "old")], "k int, v string")
    newer = spark.createDataFrame([(1, "new"), (2, "new")], "k int, v string")
    assert sorted(map(tuple, staging.append_newer(base, newer, ["k"]).collect())) == [(1, "old"), (2, "new")]


def test_yield_and_spot(spark):
    df = spark.createDataFrame([(20470.0, 3046.0, 5.0, 5.0, 5.0), (1.0, 0.0, 5.0, 6.0, 5.0)], "p double, a double, x double, y double, z double")
    got = df.select(
        F.round(staging.derived_yield(F.col("p"), F.col("a")), 1),
        staging.is_spot_reading(F.col("x"), F.col("y"), F.col("z")),
    ).collect()
    assert [tuple(r) for r in got] == [(6720.3, True), (None, False)]


def test_csv_round_trip(spark):
    rows = [(1, '{"a": "x, y"}'), (2, None), (3, 'Đài "Thơm" 8')]
    df = spark.createDataFrame(rows, "id int, data string")
    path = fresh_dir(spark, "t")
    files.write_csv(df, path)
    assert sorted(map(tuple, files.read_csv(spark, path, "id int, data string").collect())) == rows


def test_clean_fact_tolerates_missing_columns(spark):
    df = spark.createDataFrame([("2024-01-05", "2", " R01 ", "bad")], "date_id string, region_id string, rice_id string, price_rice string")
    assert tuple(star.clean_fact(df).first()) == (dt.date(2024, 1, 5), 2, "R01", None)


def test_refresh_takes_each_key_once(spark):
    folder, target, state = (fresh_dir(spark, n) for n in ("in", "out", "state"))
    schema = "day date, url string, v int"
    day = dt.date(2024, 1, 1)

    def add(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)

    def run():
        got = ingest.refresh(spark, folder, schema, target, state, ["url"], "day")
        return sorted(map(tuple, got.collect()))

    add([(day, "a", 1), (day, "a", 1), (day, "b", 2)])
    assert run() == [(day, "a", 1), (day, "b", 2)]
    add([(day, "b", 9), (day, "c", 3)])
    assert run() == [(day, "a", 1), (day, "b", 2), (day, "c", 3)]
    assert run() == [(day, "a", 1), (day, "b", 2), (day, "c", 3)]


def test_star_files(spark):
    base = fresh_dir(spark, "star")
    from seriesmill import fixed

    for name in (fixed.FACT_TABLE, *fixed.DIM_TABLES):
        spark.range(2).withColumn("date_id", F.lit("2024-01-01")).write.parquet(f"{base}/{name}.parquet")
    tables = star.clean_tables(star.load_star(spark, base, views=True))
    assert set(tables) == {"fact", *fixed.DIM_TABLES}
    assert dict(tables["dim_date"].dtypes)["date_id"] == "date"
    assert spark.table("dim_region").count() == 2
    with pytest.raises(Exception):
        star.load_star(spark, base + "-absent")


def test_refresh_takes_null_keys_once(spark, tmp_path):
    folder, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "url string, kind string, day date, price double"
    rows = [("a", None, dt.date(2024, 1, 1), 1.0), (None, "x", dt.date(2024, 1, 1), 2.0), ("b", "x", None, 3.0)]
    for _ in range(2):  # the same rows twice, then one more
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)
        got = ingest.refresh(spark, folder, schema, target, state, ["url", "kind"], "day")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
    more = ("b", "x", dt.date(2024, 1, 2), 4.0)
    spark.createDataFrame([*rows, more], schema).write.mode("append").parquet(folder)
    got = ingest.refresh(spark, folder, schema, target, state, ["url", "kind"], "day")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([*rows, more], key=str)


def test_csv_with_line_feeds(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [(1, 'two\nlines, "quoted"'), (2, None), (3, "plain")]
    files.write_csv(spark.createDataFrame(rows, "id int, data string"), path)
    assert sorted(map(tuple, files.read_csv(spark, path, "id int, data string", multi_line=True).collect())) == rows
    with pytest.raises(Exception):
        files.read_csv(spark, path, "id int, data string", mode="FAILFAST").collect()

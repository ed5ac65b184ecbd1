"""The general-purpose test tables dressed as the tables of the price domain.

Orders play the rice prices, line items the fertilizer prices and context measures, customer
segments the economy and order states the weather. Columns without nulls get some by rule, so
that lenient paths are exercised; the rules are repeated in the SQL checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

FERT_IDS = ("A", "N", "R")


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file footer once, not on every use."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Every double column rounded for comparisons between engines.

    The last bits of a sum depend on the order of its terms. The cut sits a thousandth off the
    half, so values that are exact halves cannot fall to different sides.
    """
    return df.selectExpr(
        *[
            f"floor(`{c}` * 1e{places}D + 0.501D) / 1e{places}D AS `{c}`" if t == "double" else f"`{c}`"
            for c, t in df.dtypes
        ]
    )


def _orders_by_region(spark, sf_dir) -> DataFrame:
    customer = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse fact: a row carries a rice price or a fertilizer price, never both."""
    orders = _orders_by_region(spark, sf_dir)
    day = F.col("o_orderdate").cast("date")
    region = F.when(F.col("o_orderkey") % 101 != 0, F.col("n_regionkey").cast("bigint"))
    key = F.col("o_orderkey")
    rice = orders.select(
        day.alias("date_id"),
        region.alias("region_id"),
        F.when(key % 7 != 0, F.ascii("c_mktsegment").cast("bigint")).alias("eco_id"),
        F.when(key % 5 != 0, F.ascii("o_orderstatus").cast("bigint")).alias("weather_id"),
        F.concat(F.lit(" R0"), F.substring("o_orderpriority", 1, 1), F.lit(" ")).alias("rice_id"),
        F.when(key % 11 != 0, F.col("o_totalprice")).alias("price_rice"),
        key.alias("row_key"),
    )
    quantity = F.col("l_quantity")
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == key)
        .select(
            day.alias("date_id"),
            region.alias("region_id"),
            F.col("l_returnflag").alias("fert_id"),
            (F.col("l_extendedprice") / quantity).alias("price_fert"),
            quantity.alias("avg_temperature"),
            (quantity + F.col("l_linenumber")).alias("max_temp"),
            (quantity - F.col("l_linenumber")).alias("min_temp"),
            F.when(F.col("l_linenumber") > 1, F.col("l_discount") * 100).alias("rainfall_mm"),
            (F.col("l_tax") * 100).alias("avg_wind_speed"),
            (F.col("l_extendedprice") / 100).alias("production_ton"),
            (quantity * 10).alias("area_harvest_ha"),
            (F.col("l_extendedprice") / (quantity * 10)).alias("yield_kg_per_ha"),
            (F.col("l_discount") - F.col("l_tax")).alias("cpi_change_value"),
            key.alias("row_key"),
        )
    )
    return rice.unionByName(lines, allowMissingColumns=True)


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Fact and dimensions under the names the loaders use; one weather state has no row."""
    orders = table(spark, sf_dir, "orders")
    day = F.col("date_id")
    season = F.when(F.month(day) <= 4, "Đông Xuân").when(F.month(day) <= 8, "Hè Thu").otherwise("Thu Đông")
    dim_date = (
        orders.select(F.col("o_orderdate").cast("date").alias("date_id"))
        .distinct()
        .select(
            day, F.year(day).alias("year"), F.quarter(day).alias("quarter"),
            F.month(day).alias("month"), F.dayofmonth(day).alias("day"), season.alias("crop_season"),
        )
    )
    digit = F.substring("o_orderpriority", 1, 1)
    dim_rice = orders.select("o_orderpriority").distinct().select(
        F.concat(F.lit("R0"), digit).alias("rice_id"),
        F.col("o_orderpriority").alias("rice_name"),
        F.when(digit <= "2", "fragrant").otherwise("plain").alias("rice_group"),
        F.lit("VND/kg").alias("unit"),
    )
    segment = F.col("c_mktsegment")
    dim_economy = table(spark, sf_dir, "customer").select(segment).distinct().select(
        F.ascii(segment).cast("bigint").alias("eco_id"),
        F.when(F.ascii(segment) < 70, "up").otherwise("down").alias("cpi_status"),
        F.lower(segment).alias("market_signal"),
        F.lit("%").alias("unit"),
    )
    status = F.col("o_orderstatus")
    dim_weather = orders.select(status).distinct().where(status != "P").select(
        F.ascii(status).cast("bigint").alias("weather_id"),
        F.concat(F.lit("type "), status).alias("weather_type"),
        F.when(status == "F", "high").otherwise("low").alias("severity_level"),
        F.concat(F.lit("impact "), status).alias("agriculture_impact"),
    )
    return {
        "fact": fact(spark, sf_dir),
        "dim_date": dim_date,
        "dim_economy": dim_economy,
        "dim_fertilizer_type": table(spark, sf_dir, "lineitem")
        .select(F.col("l_returnflag").alias("fert_id")).distinct(),
        "dim_region": table(spark, sf_dir, "region").select(
            F.col("r_regionkey").cast("bigint").alias("region_id"), F.col("r_name").alias("region_name")
        ),
        "dim_rice_type": dim_rice,
        "dim_weather": dim_weather,
    }


def gappy_daily(spark: SparkSession, sf_dir: str, every_day: bool = False) -> DataFrame:
    """Daily event values per type, some unknown; every fifth day is absent unless ``every_day``."""
    rows = table(spark, sf_dir, "events").select(
        "event_type", F.col("ts").cast("date").alias("date"), "value"
    )
    kept = rows if every_day else rows.where(F.dayofmonth("date") % 5 != 0)
    daily = kept.groupBy("event_type", "date").agg(
        F.avg("value").alias("mean_value"), F.max("value").alias("max_value")
    )
    mark = F.dayofmonth("date") + F.length("event_type")
    return daily.select(
        "event_type",
        "date",
        F.when(mark % 4 != 0, F.col("mean_value")).alias("mean_value"),
        F.when(mark % 7 != 0, F.col("max_value")).alias("max_value"),
    )

"""Star-schema tables: loading and lenient typing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from seriesmill import fixed
from seriesmill.functions import casts


def load_table(spark: SparkSession, location: str) -> DataFrame:
    """A Parquet path, or a catalog table when the name holds no slash."""
    return spark.read.parquet(location) if "/" in location else spark.table(location)


def load_star(
    spark: SparkSession, base: str, views: bool = False, fact: str = fixed.FACT_TABLE
) -> dict[str, DataFrame]:
    """Fact and dimensions below a folder, or in a catalog schema; scans stay lazy and pruned."""
    join = (lambda t: f"{base.rstrip('/')}/{t}.parquet") if "/" in base else (lambda t: f"{base}.{t}")
    tables = {"fact": load_table(spark, join(fact))}
    tables |= {name: load_table(spark, join(name)) for name in fixed.DIM_TABLES}
    if views:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
    return tables


def clean_fact(fact: DataFrame) -> DataFrame:
    """Dates, whole-number ids, doubles and trimmed text; columns that are missing are left out."""
    rules = {"date_id": casts.to_date}
    rules |= {c: casts.to_id for c in ("region_id", "eco_id", "weather_id")}
    rules |= {c: casts.to_number for c in ("price_rice", "price_fert", *fixed.CONTEXT_MEASURES)}
    rules |= {c: casts.strip for c in ("rice_id", "fert_id")}
    return fact.select(
        *[
            rules[f.name](fact[f.name], f.dataType).alias(f.name) if f.name in rules else fact[f.name]
            for f in fact.schema.fields
        ]
    )


def clean_dimension(dim: DataFrame) -> DataFrame:
    """Typed ``date_id`` and trimmed text columns."""
    out = []
    for field in dim.schema.fields:
        c = dim[field.name]
        if field.name == "date_id":
            c = casts.to_date(c, field.dataType)
        elif isinstance(field.dataType, T.StringType):
            c = casts.strip(c)
        out.append(c.alias(field.name))
    return dim.select(*out)


def clean_tables(source: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All tables cleaned; running it twice changes nothing."""
    return {
        name: clean_fact(df) if name == "fact" else clean_dimension(df) for name, df in source.items()
    }

"""CSV and JSON files with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = False, mode: str = "PERMISSIVE") -> DataFrame:
    """Header CSV whose quoted fields double their quotes; no inference pass over the data.

    Files whose fields hold line feeds need ``multi_line``, which reads each file as a whole. Mode ``FAILFAST``
    stops at a record that does not fit the schema instead of nulling what it cannot read.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", mode)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header CSV, UTF-8 without a byte-order mark."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, UTF-8; null fields are kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)

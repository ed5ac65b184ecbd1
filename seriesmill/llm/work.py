"""Intermediate tables of one run, in a folder of their own below the shared one."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.session import fresh_dir


class Work:
    """Writes tables below one new shared folder, reads them back, and removes those no longer needed.

    A written table cuts the lineage: a lost executor costs only the tasks that it ran.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = fresh_dir(spark, label)
        self.made = 0

    def settle(self, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
        path = f"{self.root}/{self.made:03d}-{name}"
        self.made += 1
        df.write.parquet(path, compression=codec)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._settled_at = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that this run wrote and nobody reads any more."""
        jvm, jsc = self.spark._jvm, self.spark.sparkContext._jsc
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._settled_at)
            path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark remove the shuffle files of finished jobs: it does so once their plans are collected."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def whole_row(docs: DataFrame) -> Column:
    """All columns as one, named ``row``: an operator's own columns then clash with none of them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")

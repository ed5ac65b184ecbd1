"""Setting aside the rows that a list may name, by a bitmap of fixed size, before a large table is joined with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap and of one of its rows: 256 rows of 4 KB, whatever the list holds.
BITS, ROW_BITS = 1 << 23, 1 << 15


def sift(rows: DataFrame, mark: Column, listed: DataFrame, listed_mark: str) -> tuple[DataFrame, DataFrame]:
    """(rows that ``listed`` surely does not name, the others); ``mark`` and ``listed_mark`` are equal longs for a row and its entry.

    Only the others need a join, so the wide columns of the rest are not shuffled. A long list fills the
    bitmap and sets aside less; the result of join and rest together stays the same. The bitmap is one
    megabyte and goes to every task.
    """
    place = F.pmod(F.col(listed_mark), F.lit(BITS))
    bitmap = (
        listed.select(F.floor(place / ROW_BITS).alias("bit_row"), (place % ROW_BITS).alias("bit"))
        .groupBy("bit_row")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    own = F.pmod(mark, F.lit(BITS))
    byte = F.substring(F.col("bits"), F.floor(F.col("own_bit") / 8).cast("int") + 1, F.lit(1))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(number, F.col("own_bit").cast("int") % 8) == 1, F.lit(False))
    tested = (
        rows.withColumn("own_row", F.floor(own / ROW_BITS))
        .withColumn("own_bit", own % ROW_BITS)
        .join(F.broadcast(bitmap), F.col("own_row") == F.col("bit_row"), "left")
        .withColumn("maybe", is_set)
        .drop("own_row", "own_bit", "bit_row", "bits")
    )
    return tested.filter("NOT maybe").drop("maybe"), tested.filter("maybe").drop("maybe")

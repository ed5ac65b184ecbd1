"""Scheduled refresh of a feed: take in new files, keep each key once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def refresh(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    target: str,
    state: str,
    keys: Sequence[str],
    day: str,
    file_format: str = "parquet",
    name_filter: str | None = None,
) -> DataFrame:
    """Process the files that arrived since the last call, then stop; returns the target table.

    Progress lives in ``state``, so a restarted run continues where the last one ended. A batch is
    reduced to one row per key, and keys the target already holds are left out; a null in a key
    equals another null. The target is partitioned by ``day``, the date of a row, which takes part in the key: a
    batch reads back only the days it touches, which it finds by a join.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    feed = reader.load(folder)
    # two partition columns under names of their own
    stored = T.StructType(feed.schema.fields).add("ingest_batch", "long").add("ingest_day", "date")

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("ingest_day", F.col(day).cast("date"))
        identity = ["ingest_day", *keys]
        rows.persist()
        fresh = rows.dropDuplicates(identity)
        if batch_id > 0:
            days = rows.select(F.col("ingest_day").alias("touched")).distinct()
            known = spark.read.schema(stored).parquet(target).where(F.col("ingest_batch") < batch_id)
            # the join on the partition column prunes the target to the days of the batch
            known = known.join(days, F.col("ingest_day").eqNullSafe(F.col("touched")), "left_semi")
            known = known.select(*[F.col(c).alias(f"known_{i}") for i, c in enumerate(identity)])
            same = F.lit(True)
            for i, c in enumerate(identity):
                same = same & F.col(c).eqNullSafe(F.col(f"known_{i}"))
            fresh = fresh.join(known, same, "left_anti")
        # one folder per batch: a repeated batch replaces itself instead of adding twice
        out = f"{target.rstrip('/')}/ingest_batch={batch_id}"
        fresh.write.mode("overwrite").partitionBy("ingest_day").parquet(out)
        rows.unpersist()

    query = (
        feed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stored).parquet(target).drop("ingest_batch", "ingest_day")

"""Chunks of a fixed number of rows in a global order, without sorting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def chunked(df: DataFrame, order: list[str], capacity: int, partitions: int = 0) -> DataFrame:
    """Adds `chunk`: the number of the chunk of ``capacity`` rows that a row is in.

    Rows are range-partitioned by the order, rows of equal order by all their columns; counts
    by partition, one row each, give the number that a partition starts with. Every chunk but
    the last is exactly full. Counts and rows read the same exchange: the counts also take a
    hash of all columns, so that neither side has an exchange of fewer columns.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = F.xxhash64(*(F.to_json(F.struct(F.col(f"`{c}`"))) for c in df.columns))
    parted = df.withColumn("_all", every).repartitionByRange(n, *order, "_all").withColumn("_part", F.spark_partition_id())
    counts = parted.groupBy("_part").agg(F.count("*").alias("_n"), F.max(F.xxhash64(*(F.to_json(F.struct(F.col(f"`{c}`"))) for c in df.columns))).alias("_same"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.where("_same is not null").select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order, "_all")) - 1
    placed = parted.withColumn("_own", own).join(F.broadcast(starts), "_part")  # one row a partition
    return placed.withColumn("chunk", F.floor((F.col("_start") + F.col("_own")) / capacity).cast("long")).drop("_part", "_start", "_own", "_all")

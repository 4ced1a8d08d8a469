"""Positions and pages over a totally ordered table, without a global window or offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.names import columns
from reviewloom.session import materialize


def positions(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """Adds ``position`` (from 0) in the total order given by ``order``, which must be unique.

    Rows are range-partitioned and sorted, and their partition number and place within it are
    written once: partition borders come from sampling, so computing them again could move rows.
    Each partition's start is then the number of rows before it, one row per partition.
    """
    spark = df.sparkSession
    n = partitions or max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
    ranged = df.repartitionByRange(n, *columns(order)).sortWithinPartitions(*columns(order))
    # monotonically_increasing_id counts from 0 in its low 33 bits within each partition
    placed = materialize(
        ranged.withColumn("_part", F.spark_partition_id()).withColumn(
            "_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        ),
        "positions",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    # at most one row per range partition, so the start table is always small
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn("position", F.col("_start") + F.col("_place"))
        .drop("_part", "_place", "_start")
    )


def page(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Adds ``position`` and ``page`` = position / size, both from 0."""
    return positions(df, order).withColumn("page", F.floor(F.col("position") / size))

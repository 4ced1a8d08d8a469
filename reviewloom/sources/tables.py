"""Parquet tables: scans, file lists, guarded writes, unions, load metrics."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when a scan yields fewer partitions than there are cores.

    Small tables come as one file and would keep one core busy with heavy text work. A scan that
    already has enough partitions is returned as it is, so a large table is never shuffled here.
    For scans and narrow steps over them only: asking for partitions would run a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table_files(df: DataFrame) -> DataFrame:
    """Files behind a scanned table with their row counts."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows")
    )


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None
) -> None:
    """Parquet sink. ``files`` deals the rows to that many files, in as many tasks.

    An overwrite is written beside the target and then takes its place, so a frame may be written
    over its own input, and a write that fails leaves the target as it was.
    """
    if files is not None:
        df = df.repartition(files)
    target = path.rstrip("/")
    if mode != "overwrite" or not _exists(df.sparkSession, target):
        df.write.mode(mode).parquet(target)
        return
    aside = f"{target}-{uuid.uuid4().hex}"
    df.write.parquet(aside)
    fs, old = _located(df.sparkSession, target)
    fs.delete(old, True)
    if not fs.rename(_located(df.sparkSession, aside)[1], old):
        raise OSError(f"{aside} holds the table, but could not be renamed to {target}")


def _located(spark: SparkSession, path: str):
    """The file system of a path, whatever its scheme, and the path on it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def _exists(spark: SparkSession, path: str) -> bool:
    fs, there = _located(spark, path)
    return fs.exists(there)


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


@dataclass(frozen=True)
class LoadMetrics:
    rows: int
    seconds: float
    total: int | None = None

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0

    @property
    def percent(self) -> float | None:
        return None if not self.total else 100.0 * self.rows / self.total

    @property
    def remaining_seconds(self) -> float | None:
        if self.total is None or not self.rows:
            return None
        return (self.total - self.rows) / self.rows_per_second


def write_with_metrics(
    df: DataFrame, path: str, mode: str = "overwrite", total: int | None = None
) -> LoadMetrics:
    """Write and count in the same job; the count rides along with the write."""
    seen = Observation()
    started = time.monotonic()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, mode)
    return LoadMetrics(seen.get["rows"], time.monotonic() - started, total)

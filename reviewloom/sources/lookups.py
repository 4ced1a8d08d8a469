"""A collection laid out for lookups by id: pages of each id's rows, in buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.names import quoted
from reviewloom.operators.paging import positions
from reviewloom.sources.collections import DATABASE, _ensure_database

PAGE = 1000  # rows of one id in a page
FEW = 1000  # asked ids that become a filter of the scan


class LookupTable:
    """A catalog table bucketed and sorted by upper-case id and page.

    Each row knows its place among its id's rows, so the first ``k`` of an id are its first pages
    and a lookup ranks nothing. Buckets are chosen by id and page: an id with a third of all rows
    fills its pages into all buckets, and a lookup reads the first ones only. The join needs no
    exchange of the table; Bloom filters on the id let a scan for few ids skip row groups.
    """

    def __init__(self, spark: SparkSession, name: str, database: str = DATABASE) -> None:
        self.spark, self.table = spark, f"{database}.{name}"
        _ensure_database(spark, database)

    def create(self, df: DataFrame, key: str, order: list[str], buckets: int = 64, page: int = PAGE) -> LookupTable:
        """Lays out ``df``; one of the same name goes first. ``order`` must be unique within an id.

        Rows without an id are left out: nothing finds them. Columns ``asked``, ``place`` and
        ``page`` are added; columns of these names are an error. An empty table gives an empty one.
        """
        taken = {"asked", "place", "page"} & {c.lower() for c in df.columns}
        if taken:
            raise ValueError(f"columns {sorted(taken)} are needed here")
        self.drop()
        keyed = df.withColumn("asked", F.upper(F.col(quoted(key)).cast("string"))).filter("asked IS NOT NULL")
        placed = positions(keyed, ["asked", *order])
        starts = placed.groupBy("asked").agg(F.min("position").alias("_start"))
        laid = placed.join(starts, "asked").withColumn("place", F.col("position") - F.col("_start"))
        laid = laid.withColumn("page", F.floor(F.col("place") / page)).drop("position", "_start")
        (
            laid.repartition(buckets, "asked", "page")
            .write.bucketBy(buckets, "asked", "page")
            .sortBy("asked", "page", "place")
            .option("parquet.bloom.filter.enabled#asked", "true")
            .format("parquet")
            .saveAsTable(self.table)
        )
        self.spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ('page_rows' = '{int(page)}')")
        return self

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def lookup(self, ids: DataFrame, id: str, k: int = 5) -> DataFrame:
        """Up to ``k`` rows per distinct asked id, matched in upper case, with ``asked`` and ``rank``.

        A null id, and one that is not there, has no rows.
        """
        shown = self.spark.sql(f"SHOW TBLPROPERTIES {self.table} ('page_rows')")
        pages = -(-k // int(shown.first()["value"]))
        asked = ids.select(F.upper(F.col(quoted(id)).cast("string")).alias("asked")).filter("asked IS NOT NULL").distinct()
        stored = self.spark.table(self.table).filter((F.col("page") < pages) & (F.col("place") < k))
        few = asked.limit(FEW + 1).collect()
        if len(few) <= FEW:
            return self._ranked(stored.filter(F.col("asked").isin([r["asked"] for r in few])))
        wanted = asked.select("asked", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(pages - 1).cast("bigint"))).alias("page"))
        return self._ranked(stored.join(wanted, ["asked", "page"], "left_semi"))

    @staticmethod
    def _ranked(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.col("place") + 1).drop("place", "page")

"""Collections with one row per id: loads overwrite by id and rewrite only the buckets they touch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.names import columns, quoted
from reviewloom.session import materialize
from reviewloom.sources.collections import DATABASE, Collection, Spec, coerce

BUCKET = "id_bucket"
MODE = "spark.sql.sources.partitionOverwriteMode"


class KeyedCollection(Collection):
    """A collection partitioned by a hash of its id.

    A load that runs again, wholly or after it stopped, leaves the same rows: each id has the row of
    the last load that named it. Buckets are replaced one by one when a load's tasks have all ended,
    so a killed task leaves nothing, and a crash between buckets leaves each bucket whole, old or new.
    """

    def __init__(self, spark: SparkSession, name: str, key: str, database: str = DATABASE) -> None:
        super().__init__(spark, name, database)
        self.key = key

    def create(self, spec: Spec, buckets: int = 64) -> KeyedCollection:
        """Create it empty, dropping one of the same name first. ``buckets`` cannot be changed later."""
        if self.key not in spec.properties:
            raise ValueError(f"{self.key} is no property of the collection")
        self.drop()
        cols = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in spec.schema().fields)
        self.spark.sql(
            f"CREATE TABLE {self.table} ({cols}, {BUCKET} int) USING parquet PARTITIONED BY ({BUCKET}) TBLPROPERTIES "
            f"('vector' = '{spec.vector}', 'distance' = '{spec.distance}', 'encoder' = '{spec.encoder}', "
            f"'buckets' = '{int(buckets)}')"
        )
        return self

    def buckets(self) -> int:
        return int(self.spark.sql(f"SHOW TBLPROPERTIES {self.table} ('buckets')").first()["value"])

    def read(self) -> DataFrame:
        return self.spark.table(self.table).drop(BUCKET)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        hashed = F.xxhash64(F.col(quoted(self.key)).cast("string"))
        return df.withColumn(BUCKET, F.pmod(hashed, F.lit(self.buckets())).cast("int"))

    def append(self, df: DataFrame) -> None:
        """As ``upsert``: rows with an id that is there take its place."""
        self.upsert(df)

    def write(self, df: DataFrame, spec: Spec) -> None:
        self.upsert(coerce(df, spec))

    def upsert(self, df: DataFrame) -> None:
        """Insert or replace by id rows that have exactly the collection's columns and types.

        Of several rows with one id in ``df`` the first in the order of all columns that can be
        ordered stays. Rows without an id are left out. Only the buckets of the given ids are read
        and written; no rows write nothing.
        """
        want = {f.name: f.dataType for f in self.read().schema.fields}
        have = {f.name: f.dataType for f in df.schema.fields}
        if want != have:
            wrong = sorted(n for n in want.keys() | have.keys() if want.get(n) != have.get(n))
            raise ValueError(f"columns differ from the collection: {wrong}")
        names = self.read().columns
        # one row per id by a minimum that is pre-aggregated, so a repeated id costs no task of its own
        row = F.struct(*columns(n for n in names if n != self.key))
        single = df.filter(F.col(quoted(self.key)).isNotNull()).groupBy(quoted(self.key)).agg(F.min(row).alias("_row"))
        new = materialize(self._bucketed(single.select(quoted(self.key), "_row.*").select(*columns(names))), "new")
        self._replace(new, new)

    def delete(self, ids: DataFrame, id: str) -> None:
        """Remove the rows of some ids; ids that are not there change nothing."""
        kind = self.read().schema[self.key].dataType
        gone = ids.select(F.col(quoted(id)).cast(kind).alias(self.key)).filter(F.col(quoted(self.key)).isNotNull()).distinct()
        self._replace(materialize(self._bucketed(gone), "gone"), None)

    def _replace(self, ids: DataFrame, new: DataFrame | None) -> None:
        touched = [r[0] for r in ids.select(BUCKET).distinct().collect()]  # at most the number of buckets
        if not touched:
            return
        there = self.spark.table(self.table)
        kept = there.filter(F.col(BUCKET).isin(touched)).join(ids.select(quoted(self.key)), self.key, "left_anti")
        kept = kept.select(*columns(there.columns))
        rows = kept if new is None else kept.unionByName(new)
        whole = materialize(rows, "merged")  # read in full before its source is overwritten
        emptied = set(touched) - {r[0] for r in whole.select(BUCKET).distinct().collect()}
        before = self.spark.conf.get(MODE)
        self.spark.conf.set(MODE, "dynamic")  # the buckets that are written, and no others, are replaced
        try:
            whole.hint("rebalance", BUCKET).write.mode("overwrite").insertInto(self.table)
        finally:
            self.spark.conf.set(MODE, before)
        for bucket in emptied:
            self._remove(bucket)

    def _remove(self, bucket: int) -> None:
        """A bucket without rows is not written, so its folder goes."""
        shown = self.spark.sql(f"DESCRIBE FORMATTED {self.table}").filter("col_name = 'Location'")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{shown.first()['data_type']}/{BUCKET}={bucket}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.spark.catalog.refreshTable(self.table)

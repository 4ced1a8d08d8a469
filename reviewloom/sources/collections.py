"""Vector collections as catalog tables: a typed property list, a vector column, a distance."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.names import columns, quoted

# Properties that are not text.
TYPED_PROPERTIES = {"unixReviewTime": "bigint", "overall": "double", "verified": "boolean"}
DATABASE = "vector_collections"


@dataclass(frozen=True)
class Spec:
    """Property types (text where not listed), the vector column and how it was made."""

    properties: tuple[str, ...]
    vector: str = "embedding"
    types: Mapping[str, str] = field(default_factory=lambda: dict(TYPED_PROPERTIES))
    distance: str = "cosine"
    encoder: str = "hashed-words"

    def schema(self) -> T.StructType:
        fields = [f"{quoted(p)} {self.types.get(p, 'string')}" for p in self.properties]
        return T.StructType.fromDDL(", ".join(fields + [f"{quoted(self.vector)} array<float>"]))


def coerce(df: DataFrame, spec: Spec) -> DataFrame:
    """Rows of a collection: properties cast to their types, nulls kept, values that do not fit null."""
    return df.select(
        *[
            F.col(quoted(f.name)).try_cast(f.dataType).alias(f.name)
            for f in spec.schema().fields
        ]
    )


class Collection:
    """One collection in the session catalog; its spec is kept as table properties."""

    def __init__(self, spark: SparkSession, name: str, database: str = DATABASE) -> None:
        self.spark, self.table, self.database = spark, f"{database}.{name}", database
        _ensure_database(spark, database)

    def create(self, spec: Spec) -> Collection:
        """Create it, dropping one of the same name first."""
        self.drop()
        cols = ", ".join(
            f"{quoted(f.name)} {f.dataType.simpleString()}" for f in spec.schema().fields
        )
        self.spark.sql(
            f"CREATE TABLE {self.table} ({cols}) USING parquet TBLPROPERTIES "
            f"('vector' = '{spec.vector}', 'distance' = '{spec.distance}', "
            f"'encoder' = '{spec.encoder}')"
        )
        return self

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def encoder(self) -> str:
        shown = self.spark.sql(f"SHOW TBLPROPERTIES {self.table} ('encoder')")
        return shown.first()["value"]

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def count(self) -> int:
        return self.read().count()

    def append(self, df: DataFrame) -> None:
        """Append rows that already have exactly the collection's columns and types."""
        want = {f.name: f.dataType for f in self.read().schema.fields}
        have = {f.name: f.dataType for f in df.schema.fields}
        if want != have:
            wrong = sorted(n for n in want.keys() | have.keys() if want.get(n) != have.get(n))
            raise ValueError(f"columns differ from the collection: {wrong}")
        df.select(*columns(self.read().columns)).write.mode("append").insertInto(self.table)

    def write(self, df: DataFrame, spec: Spec) -> None:
        """Coerce and append; executors write directly, nothing is paged through the driver."""
        self.append(coerce(df, spec))


def _ensure_database(spark: SparkSession, database: str) -> None:
    """The database lies in the warehouse of the session catalog, where tables outlive a session."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def list_collections(spark: SparkSession, database: str = DATABASE) -> list[str]:
    _ensure_database(spark, database)
    return sorted(t.name for t in spark.catalog.listTables(database))


def send_batches(
    df: DataFrame,
    send: Callable[[list[dict]], None],
    batch_size: int = 100,
    retries: int = 3,
    wait: float = 1.0,
) -> None:
    """Hand rows to an external store from the executors, nulls omitted, ``batch_size`` at a time.

    A failed batch is retried; a lost task runs again, so ``send`` must overwrite by the row's id.
    """

    def push(batch: list[dict]) -> None:
        for attempt in range(retries + 1):
            try:
                return send(batch)
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(wait)

    def partition(rows: Iterable[Row]) -> None:
        batch: list[dict] = []
        for row in rows:
            batch.append({k: v for k, v in row.asDict().items() if v is not None})
            if len(batch) == batch_size:
                push(batch)
                batch = []
        if batch:
            push(batch)

    df.foreachPartition(partition)

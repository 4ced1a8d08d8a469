"""Column counts from Parquet footers: rows and nulls that the row groups' statistics already hold."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.names import columns

AT_ONCE = 1000  # columns counted in one pass


def _counts(df: DataFrame, names: list[str]) -> tuple[int, list[int]]:
    row = df.agg(F.count("*"), *[F.count(c) for c in columns(names)]).first()
    return row[0] or 0, [n or 0 for n in row[1:]]  # sums over no row group are null


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans answer counts from footers."""
    own = spark.newSession()
    listed = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in listed if x != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_frame(spark: SparkSession, path: str) -> DataFrame:
    """The files below ``path``; counts over it read footers alone where their columns are not nested."""
    return _footer_session(spark).read.parquet(path)


def column_counts(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    """``(column, n_rows, non_null, scanned)`` for columns of the Parquet files below ``path``.

    Executors read the files' footers and add up the row groups' numbers of rows and nulls, so the
    cost depends on the number of files, not of rows. Nested columns, whose nulls footers do not
    tell, and files written without statistics are scanned instead (``scanned`` is true), each
    column read for itself. Empty strings are values. No rows give 0; a folder without columns of
    that name is an error.
    """
    df = footer_frame(spark, path)
    names = df.columns if cols is None else list(cols)
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    plain = [c for c in names if not isinstance(df.schema[c].dataType, nested)]
    rows = []
    for some, scanned in ((plain, False), ([c for c in names if c not in plain], True)):
        for at in range(0, len(some), AT_ONCE):
            part = some[at : at + AT_ONCE]
            try:
                n, counts = _counts(spark.read.parquet(path) if scanned else df, part)
                how = scanned
            except PySparkException:  # files without statistics
                if scanned:
                    raise
                n, counts = _counts(spark.read.parquet(path), part)
                how = True
            rows += [(c, n, x, how) for c, x in zip(part, counts)]
    return spark.createDataFrame(rows, "column string, n_rows long, non_null long, scanned boolean")


def all_null_columns(spark: SparkSession, path: str, cols: list[str] | None = None) -> list[str]:
    """Names of the columns without any value, in order."""
    empty = column_counts(spark, path, cols).filter("non_null = 0").select("column").collect()
    found = {r["column"] for r in empty}
    return [c for c in (cols or spark.read.parquet(path).columns) if c in found]


def sparse_columns(spark: SparkSession, path: str, prefix: str, min_non_null: int = 10_000) -> list[str]:
    """Names that begin with ``prefix`` of columns with fewer than ``min_non_null`` values."""
    names = [c for c in spark.read.parquet(path).columns if c.startswith(prefix)]
    few = column_counts(spark, path, names).filter(F.col("non_null") < min_non_null).collect() if names else []
    found = {r["column"] for r in few}
    return [c for c in names if c in found]

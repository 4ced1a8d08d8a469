"""Profiles, duplicates, missing values, sparse columns. Each report is one pass over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.names import columns, match_columns, quoted

AT_ONCE = 1000  # columns counted in one pass
LONG = 64  # characters from which a text key is compared by its hash


def present(c: Column) -> Column:
    """Neither null nor the empty string."""
    return c.isNotNull() & (c != "")


def missing(df: DataFrame, name: str) -> Column:
    """Null, or empty where the column is text (numbers are never compared with a text)."""
    c = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, T.StringType):
        return c.isNull() | (c == "")
    return c.isNull()


def _per_column(df: DataFrame, counts: dict[str, Column], out: str) -> DataFrame:
    """One aggregate row turned into rows ``(column, out)``."""
    one = df.agg(*[c.alias(name) for name, c in counts.items()])
    return one.unpivot([], columns(counts), "column", out)


def missing_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, missing)`` for all columns from one pass."""
    return _per_column(df, {c: F.count_if(missing(df, c)) for c in cols}, "missing")


def population(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, non_null)``, most populated first."""
    counts = {c: F.count(F.col(quoted(c))) for c in cols}
    return _per_column(df, counts, "non_null").orderBy(F.desc("non_null"), "column")


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(column, nulls)``."""
    counts = {c: F.count_if(F.col(quoted(c)).isNull()) for c in cols or df.columns}
    return _per_column(df, counts, "nulls")


def all_null_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column)`` for columns without any value; one pass however many columns there are."""
    return population(df, cols).filter("non_null = 0").select("column")


def short(df: DataFrame, name: str) -> Column:
    """A column to group by: long texts are replaced by their SHA-256, so none is shuffled."""
    c = F.col(quoted(name))
    if not isinstance(df.schema[name].dataType, T.StringType):
        return c.alias(name)
    hashed = F.concat(F.lit("\0sha256 "), F.sha2(c, 256))
    return F.when(F.length(c) > LONG, hashed).otherwise(c).alias(name)


def row_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """``(n_rows, n_distinct)`` over ``keys``. Groups are pre-aggregated before the shuffle."""
    return (
        df.groupBy(*[short(df, k) for k in keys])
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_distinct"))
    )


def duplicate_groups(df: DataFrame, keys: list[str], counted: str | None = None) -> DataFrame:
    """Key groups that occur more than once, with ``count``.

    ``counted`` counts only rows where that column is set, so a null key group never qualifies.
    """
    n = F.count("*") if counted is None else F.count(F.col(quoted(counted)))
    return df.groupBy(*columns(keys)).agg(n.alias("count")).filter("count > 1")


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: duplicate groups, and the rows beyond the first of each group."""
    return duplicate_groups(df, keys).agg(
        F.count("*").alias("groups"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("surplus_rows"),
    )


def dedupe(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key group: the first in ``order``, or any row when no order is given.

    Null keys form a group of their own. The window keeps one row per key in every input
    partition before the shuffle, so a key that holds a large share of all rows does not pile up.
    Long text keys are shuffled, sorted and compared by their hash.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    keyed = df.select("*", *[short(df, k).alias(n) for k, n in zip(keys, names, strict=True)])
    first = Window.partitionBy(*names).orderBy(*columns(order or keys))
    return (
        keyed.withColumn("_rank", F.row_number().over(first))
        .filter("_rank = 1")
        .drop("_rank", *names)
    )


def drop_columns(
    df: DataFrame,
    names: list[str] | None = None,
    prefix: str | None = None,
    regex: str | None = None,
    only_null: bool = False,
) -> DataFrame:
    """Drop columns by list, prefix or regex; with ``only_null``, refuse if any holds a value."""
    chosen = list(names or [])
    if prefix is not None or regex is not None:
        chosen += match_columns(df, prefix, regex)
    if only_null and chosen:
        filled = population(df, chosen).filter("non_null > 0").select("column")
        used = [r["column"] for r in filled.collect()]  # at most one row per column
        if used:
            raise ValueError(f"columns with values: {used}")
    return df.drop(*chosen)


def prune_sparse(df: DataFrame, prefix: str, min_non_null: int = 10_000) -> DataFrame:
    """Drop columns of a prefix with fewer than ``min_non_null`` values.

    Other columns come first, the kept ones after them. One aggregate row for every ``AT_ONCE``
    columns reaches the driver.
    """
    cols = match_columns(df, prefix=prefix)
    others = match_columns(df, prefix=prefix, negate=True)
    if not cols:
        return df
    kept = []
    for i in range(0, len(cols), AT_ONCE):
        some = cols[i : i + AT_ONCE]
        counts = df.agg(*[F.count(F.col(quoted(c))).alias(c) for c in some]).first()
        kept += [c for c in some if counts[c] >= min_non_null]
    return df.select(*columns(others + kept))

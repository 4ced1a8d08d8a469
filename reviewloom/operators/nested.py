"""JSON attribute columns to flat columns or to rows."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.names import columns, quoted, safe_key_column

TEXT_MAP = "map<string,string>"


def extract(df: DataFrame, col: str, keys: list[str], prefix: str = "style_") -> DataFrame:
    """Known top-level keys as trimmed columns ``<prefix><key without colon>``; one parse per row."""
    schema = ", ".join(f"{quoted(k)} string" for k in keys)
    return (
        df.withColumn("_parsed", F.from_json(quoted(col), schema))
        .select(
            *columns(df.columns),
            *[
                F.trim(F.col("_parsed")[k]).alias(prefix + k.replace(":", ""))
                for k in keys
            ],
        )
    )


def top_level_keys(df: DataFrame, col: str) -> DataFrame:
    """Distinct top-level keys of the JSON objects in a column."""
    return df.select(
        F.explode(F.map_keys(F.from_json(quoted(col), TEXT_MAP))).alias("key")
    ).distinct()


def named_keys(df: DataFrame, col: str, min_non_null: int = 0) -> DataFrame:
    """``(name, key)``: keys whose safe name has a value in at least ``min_non_null`` rows."""
    parsed = df.select(F.from_json(quoted(col), TEXT_MAP).alias("m"))
    keys = parsed.select(F.explode(F.map_keys("m")).alias("key")).distinct()
    named = keys.select(safe_key_column(F.col("key")).alias("name"), "key")
    if not min_non_null:
        return named
    filled = F.map_keys(F.map_filter("m", lambda k, v: v.isNotNull()))
    names = parsed.select(
        F.explode(F.array_distinct(F.transform(filled, safe_key_column))).alias("name")
    )
    enough = names.groupBy("name").agg(F.count("*").alias("n")).filter(F.col("n") >= min_non_null)
    return named.join(enough, "name", "left_semi")


def flatten_json(
    df: DataFrame,
    col: str,
    prefix: str = "style_",
    keys: list[str] | None = None,
    min_non_null: int = 0,
) -> DataFrame:
    """One column per top-level key found anywhere in ``col``, named by ``safe_key_column``.

    The keys come first, counted in long form; only those of columns with at least
    ``min_non_null`` values reach the driver and become columns, so noisy keys cost nothing more.
    Then one parse per row and one ``select``. Values that are objects or lists keep their JSON
    text; bad JSON gives nulls. Keys that share a safe name fill one column, the first non-null in
    key order. Keys may hold dots. Given ``keys`` are taken as they are.
    """
    if keys is None:
        found = named_keys(df, col, min_non_null)
    else:
        given = df.sparkSession.createDataFrame([(k,) for k in keys], "key string")
        found = given.select(safe_key_column(F.col("key")).alias("name"), "key")
    by_name = defaultdict(list)
    for row in sorted(found.collect(), key=lambda r: r["key"]):
        by_name[row["name"]].append(row["key"])
    parsed = df.withColumn("_map", F.from_json(quoted(col), TEXT_MAP))
    flat = [
        F.coalesce(*[F.trim(F.try_element_at("_map", F.lit(k))) for k in same]).alias(prefix + name)
        for name, same in sorted(by_name.items())
    ]
    return parsed.select(*columns(df.columns), *flat)


def attributes_long(df: DataFrame, col: str, id: list[str]) -> DataFrame:
    """``(id…, key, name, value)``, one row per attribute: any number of keys, one narrow pass."""
    return df.select(
        *columns(id), F.explode(F.from_json(quoted(col), TEXT_MAP)).alias("key", "value")
    ).select(
        *columns(id), "key", safe_key_column(F.col("key")).alias("name"), F.trim("value").alias("value")
    )

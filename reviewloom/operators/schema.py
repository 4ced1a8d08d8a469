"""Schemas found in JSON text: key paths, generated and inferred schemas, listings."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.session import materialize

LEVELS = 8  # levels opened in one plan


def accept_repeated_keys(spark: SparkSession) -> None:
    """Let objects that repeat a key parse, the last value winning; otherwise they count as bad."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def discover_keys(df: DataFrame, col: str = "value") -> DataFrame:
    """``(path, key)``: every key path of every record; list items share the list's path.

    Records of one shape have the same keys, so one record per shape is opened (see
    ``one_per_shape``). Every few levels the paths are written, those that end are put aside and
    the others are opened further, until none is left, so records may nest as deeply as the JSON
    parser allows. Only paths that end in a value are kept: their prefixes are all the keys. Paths
    are lists, so a key holding a dot stays one part; ``key`` joins the parts with dots. Records
    that are not JSON contribute nothing.
    """
    accept_repeated_keys(df.sparkSession)
    text = one_per_shape(df.select(F.col(col).alias("v")))
    open_paths = text.select(
        F.array().cast("array<string>").alias("path"), F.try_parse_json("v").alias("v")
    )
    ended: list[DataFrame] = []
    while True:
        for _ in range(LEVELS):
            open_paths = open_paths.select(
                "path",
                F.try_variant_get("v", "$", "map<string,variant>").alias("m"),
                F.try_variant_get("v", "$", "array<variant>").alias("a"),
            ).select(F.explode(_children()).alias("c")).select("c.path", "c.v")
        opened = materialize(open_paths, "paths")
        ended.append(opened.filter("v is null").select("path").distinct())
        open_paths = opened.filter("v is not null")
        if open_paths.isEmpty():
            break
    ends = reduce(DataFrame.union, ended).distinct()
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size("path")), lambda n: F.slice("path", 1, n)
    )
    return (
        ends.filter("size(path) > 0")
        .select(F.explode(prefixes).alias("path"))
        .distinct()
        .select("path", F.array_join("path", ".").alias("key"))
    )


def one_per_shape(text: DataFrame) -> DataFrame:
    """Records ``v`` such that every shape found in ``text`` keeps at least one record.

    The first pass hashes: per shape the smallest hash of a record, pre-aggregated, so no record
    text is shuffled. The second keeps records whose hash was chosen. A shape with a list of mixed
    items does not tell the keys inside, so each such record counts as a shape of its own.
    """
    h = F.xxhash64("v")
    shape = F.schema_of_variant(F.try_parse_json("v"))
    shaped = text.select(h.alias("h"), shape.alias("shape"))
    own = F.when(F.col("shape").contains("VARIANT"), F.col("h")).otherwise(0)
    chosen = (
        shaped.groupBy("shape", own.alias("own")).agg(F.min("h").alias("h")).select("h").distinct()
    )
    return text.withColumn("h", h).join(chosen, "h", "left_semi").select("v")


def _children() -> Column:
    """Entries of an object, items of a list, or the path alone when there is nothing below."""
    nothing = F.lit(None).cast("variant")
    here = F.array(F.struct(F.col("path").alias("path"), nothing.alias("v")))
    entries = F.transform(
        F.map_entries("m"),
        lambda e: F.struct(
            F.concat("path", F.array(e["key"])).alias("path"), e["value"].alias("v")
        ),
    )
    items = F.transform("a", lambda x: F.struct(F.col("path").alias("path"), x.alias("v")))
    return (
        F.when(F.size("m") > 0, entries).when(F.size("a") > 0, items).otherwise(here)
    )


def key_tree(keys: DataFrame) -> DataFrame:
    """``(depth, name, key)``, parents before children."""
    return keys.select(
        (F.size("path") - 1).alias("depth"),
        F.element_at("path", -1).alias("name"),
        "key",
        "path",
    ).orderBy("path").drop("path")


def type_column(name: Column, overrides: Mapping[str, str] | None = None) -> Column:
    """Type by key name; the first rule that fits wins. Overrides go by exact name."""
    low = F.lower(name)
    rule = (
        F.when(low.contains("id"), "string")
        .when(low.contains("time") | low.contains("date"), "bigint")
        .when(low == "verified", "boolean")
        .when(low == "overall", "double")
        .otherwise("string")
    )
    for key, type_name in (overrides or {}).items():
        rule = F.when(name == key, type_name).otherwise(rule)
    return rule


def from_keys(
    keys: DataFrame, mode: str = "nested", overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """Schema table from discovered keys.

    ``nested``: ``(key, path, type, is_struct)``; a key that has keys below it is a struct.
    ``unique``: ``(key, unique_name, type)``; each further key below a first part gets a first part
    of its own, ``name_dupN``, counted in key order.
    """
    name = F.element_at("path", -1)
    if mode == "nested":
        parents = keys.select(F.slice("path", 1, F.size("path") - 1).alias("path")).distinct()
        return keys.join(parents.withColumn("p", F.lit(True)), "path", "left").select(
            "key",
            "path",
            F.when(F.col("p"), "struct").otherwise(type_column(name, overrides)).alias("type"),
            F.coalesce("p", F.lit(False)).alias("is_struct"),
        )
    if mode == "unique":
        nth = F.row_number().over(Window.partitionBy(F.col("path")[0]).orderBy("key")) - 1
        first = F.concat(
            F.col("path")[0], F.when(nth > 0, F.concat(F.lit("_dup"), nth)).otherwise("")
        )
        rest = F.slice("path", 2, F.size("path"))
        return keys.select(
            "key",
            F.array_join(F.concat(F.array(first), rest), ".").alias("unique_name"),
            type_column(name, overrides).alias("type"),
        )
    raise ValueError(f"unknown mode {mode!r}")


def to_struct(table: DataFrame) -> T.StructType:
    """``StructType`` from the ``nested`` schema table, fields in key order."""
    # a schema is held by the driver, as every plan that uses it is
    rows = table.select("path", "type").orderBy("path").collect()
    root: dict = {}
    for row in rows:
        level = root
        for part in row["path"][:-1]:
            level = level[part]
        level[row["path"][-1]] = {} if row["type"] == "struct" else row["type"]
    return _struct(root)


def _struct(fields: dict) -> T.StructType:
    return T.StructType(
        [
            T.StructField(n, _struct(t) if isinstance(t, dict) else T.DataType.fromDDL(t))
            for n, t in fields.items()
        ]
    )


def infer(df: DataFrame, col: str = "value") -> T.DataType:
    """Schema merged over all records of a JSON text column; one aggregate row.

    Whole numbers are long, other numbers double; nulls, empty lists' items and places where
    records disagree are strings.
    """
    accept_repeated_keys(df.sparkSession)
    ddl = df.agg(F.schema_of_variant_agg(F.try_parse_json(col))).first()[0]
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", ddl)
    ddl = re.sub(r"\bDECIMAL\(\d+, ?\d+\)", "DOUBLE", ddl)
    ddl = re.sub(r"\b(VOID|VARIANT)(?=[,>]|$)", "STRING", ddl)
    return T.DataType.fromDDL(ddl)


def describe(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """``(path, type, nullable)`` for every field, nested ones included."""
    rows: list[tuple[str, str, bool]] = []

    def walk(prefix: str, struct: T.StructType) -> None:
        for f in struct.fields:
            path = prefix + f.name
            rows.append((path, f.dataType.simpleString(), f.nullable))
            inner = f.dataType
            while isinstance(inner, T.ArrayType):
                inner = inner.elementType
            if isinstance(inner, T.StructType):
                walk(path + ".", inner)

    walk("", schema)
    return spark.createDataFrame(rows, "path string, type string, nullable boolean")


def save(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """Keep a schema as a JSON text file."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def load(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path).first()["value"]))

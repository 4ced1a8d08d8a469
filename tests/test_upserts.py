"""Loads that overwrite by id: run twice, stopped, with repeated ids, and the buckets they touch."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from reviewloom.sources.collections import Spec
from reviewloom.sources.upserts import KeyedCollection

SPEC = Spec(("id", "note", "overall"))


@pytest.fixture
def made(spark):
    collection = KeyedCollection(spark, "upserts", "id").create(SPEC, buckets=6)
    yield collection
    collection.drop()


def rows(spark, ids, note):
    data = [(i, note, 1.0, [0.5, None]) for i in ids]
    return spark.createDataFrame(data, "id string, note string, overall double, embedding array<float>")


def held(made):
    return sorted((r.id, r.note) for r in made.read().collect())


def files(made):
    shown = made.spark.sql(f"DESCRIBE FORMATTED {made.table}").filter("col_name = 'Location'").first()["data_type"]
    return {f for f in glob.glob(shown.replace("file:", "") + "/*/*.parquet") if os.path.getsize(f)}


def test_a_load_run_twice_leaves_the_same_rows(spark, made):
    made.upsert(rows(spark, "abcdef", "old"))
    for _ in range(2):
        made.write(rows(spark, ["a", "z", "a"], "new").union(rows(spark, ["a", None], "newer")), SPEC)
        assert held(made) == [("a", "new"), *[(i, "old") for i in "bcdef"], ("z", "new")]
    assert made.count() == 7 and made.read().columns == ["id", "note", "overall", "embedding"]
    with pytest.raises(ValueError):
        made.append(rows(spark, "a", "x").drop("note"))


def test_only_touched_buckets_are_written(spark, made):
    made.upsert(rows(spark, "abcdefghijkl", "old"))
    before = files(made)
    made.upsert(rows(spark, "a", "new"))
    gone = {os.path.dirname(f) for f in before - files(made)}
    assert len(gone) == 1 and len({os.path.dirname(f) for f in before}) > 1
    made.upsert(rows(spark, [], "none"))
    made.delete(spark.createDataFrame([("a",), ("none",), (None,)], "gone string"), "gone")
    assert [i for i, _ in held(made)] == list("bcdefghijkl")
    made.delete(rows(spark, "bcdefghijkl", ""), "id")
    assert held(made) == []


def test_a_killed_load_leaves_nothing(spark, made):
    made.upsert(rows(spark, "abc", "old"))
    bad = rows(spark, "abcxyz", "new").withColumn(
        "note", F.when(F.col("id") == "y", F.raise_error(F.lit("stopped"))).otherwise(F.col("note"))
    )
    with pytest.raises(Exception, match="stopped"):
        made.upsert(bad.select("id", F.col("note").cast("string").alias("note"), "overall", "embedding"))
    assert held(made) == [("a", "old"), ("b", "old"), ("c", "old")]


def test_the_key_must_be_a_property(spark):
    with pytest.raises(ValueError):
        KeyedCollection(spark, "upserts_bad", "other").create(SPEC)

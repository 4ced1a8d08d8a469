"""What a search by cells copies and leaves on disk: a query is one row however many blocks it meets."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_vectors import brute

from reviewloom.operators import vectors as V
from reviewloom.session import cleaning, shared_dir

DIM = 6


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(8)
    m = rng.normal(size=(300, DIM)).astype(np.float32)
    m[40:60] = m[0]
    rows = [(f"v{i:03}", [float(x) for x in v]) for i, v in enumerate(m)]
    return rows, spark.createDataFrame(rows, "id string, embedding array<float>").repartition(3)


def folders(spark):
    root = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    return {d for d in (os.listdir(root) if os.path.isdir(root) else [])}


def test_queries_in_chunks_find_the_same_and_leave_the_hits_alone(spark, points, monkeypatch):
    rows, df = points
    monkeypatch.setattr(V, "BLOCK_ROWS", 40)
    monkeypatch.setattr(V, "CHUNK_BYTES", 8 * (DIM + 1) * 25)  # cells' queries are together, and some cells are cut
    before = folders(spark)
    got = V.knn(df, df, 4, DIM, "id", "embedding", "id", "embedding", broadcast_bytes=0, pivots=5)
    left = {d.rsplit("-", 1)[0] for d in folders(spark) - before}
    assert {(r.qid, r.id, r["rank"]) for r in got.collect()} == brute(rows, 4)
    assert left == {"named", "hits"}


def test_a_query_is_one_row_whatever_it_visits(spark, points, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 10)
    rows, df = points
    cells = V.index(df, DIM, pivots=6)
    order, begins, blocks = V._units(cells, whole=True)
    assert blocks.sum() > 20
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(300)), pa.array([v for _, v in rows], pa.list_(pa.float32()))], ["qid", "vec"]
    )
    (routed,) = V._Ways(cells, order, begins, 5).route(None)([batch])
    assert routed.num_rows == 300 and {len(u) for u in routed.column("units").to_pylist()} == {5}


def test_chunks_are_of_bounded_size(spark):
    asked = spark.range(1000).select(
        F.col("id").alias("qid"), F.array(F.when(F.col("id") < 700, 3).otherwise(F.col("id") % 50).cast("int")).alias("units")
    )
    made, chunks = V._chunked(V.materialize(asked), 100)
    sizes = {r["chunk"]: r["count"] for r in made.groupBy("chunk").count().collect()}
    assert sum(sizes.values()) == 1000 and max(sizes) < chunks <= 12 and max(sizes.values()) < 150
    apart = made.filter("units[0] <> 3").groupBy(F.col("units")[0]).agg(F.count_distinct("chunk").alias("n"))
    assert apart.agg(F.max("n")).first()[0] == 1


def test_cleaning_leaves_the_settings_as_they_were(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(KeyError), cleaning(spark):
        assert spark.conf.get(name) == "true"
        raise KeyError
    assert spark.conf.get(name) == before

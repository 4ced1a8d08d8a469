"""The stored vector index against the exact join, with its plans and its splits."""

import numpy as np
import pytest
from conftest import plan

from reviewloom.operators import vectors as V
from reviewloom.sources import vector_index
from reviewloom.sources.vector_index import VectorIndex

DIM = 8


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, DIM))
    made = centres[rng.integers(0, 12, 900)] + 0.3 * rng.normal(size=(900, DIM))
    made[10], made[500:560] = 0, made[499]  # a zero vector, and copies
    data = [(f"v{i}", v.tolist()) for i, v in enumerate(made.astype(np.float32).astype(float))]
    return spark.createDataFrame([*data, ("none", None)], "id string, embedding array<float>").repartition(3).cache()


def found(df):
    return sorted((r.qid, r["rank"], r.id, round(r.similarity, 6)) for r in df.collect())


@pytest.fixture(scope="module")
def want(rows):
    return found(V.knn(rows, rows, 4, DIM, "id"))


def halves(rows):
    return rows.filter("id < 'v5'"), rows.filter("id >= 'v5' OR id = 'none'")


def test_append_and_split_keep_exact_results(spark, rows, want):
    first, second = halves(rows)
    made = VectorIndex(spark, "split_and_append").create(first, DIM, cells=3)
    made.append(second.limit(0))
    made.append(second)
    before = made.pivots()[0]
    assert made.rows().count() == 900 and len(before) == 3
    assert found(made.search(rows, 4, qid="id")) == want
    assert made.split(200) > 0
    after = made.pivots()[0]
    assert not set(after) >= set(before) and len(after) > 3
    assert sum(r.n for r in made.cells().collect()) == made.rows().count() == 900
    other = VectorIndex(spark.newSession(), "split_and_append")
    asked = other.spark.createDataFrame([tuple(r) for r in rows.collect()], rows.schema)
    assert found(other.search(asked, 4, qid="id")) == want
    made.drop()
    assert not made.exists()


def test_probes_read_only_their_partitions(spark, rows, want):
    made = VectorIndex(spark, "pruned").create(rows, DIM, cells=30)
    near = found(made.search(rows, 4, probes=6, qid="id"))
    assert len(set(near) & set(want)) / len(want) >= 0.9
    stored = vector_index._Stored(made)
    read = stored.blocked([0, 2])
    text = plan(read)
    assert "PartitionFilters: [cell" in text and "IN (0,2)" in text.replace("cell#", "").replace(", ", ",").replace("in", "IN")
    assert {r.cell for r in read.select("cell").distinct().collect()} <= {0, 2}
    made.drop()


def test_a_crash_in_a_split_loses_nothing(spark, rows, want, monkeypatch):
    made = VectorIndex(spark, "crash").create(rows, DIM, cells=2)
    for step in ("_load", "_commit", "_remove"):
        real = getattr(VectorIndex, step)

        def fails(self, *args, step=step, real=real):
            if step != "_remove":
                real(self, *args) if step == "_load" else None
            raise RuntimeError(step)

        monkeypatch.setattr(VectorIndex, step, fails)
        with pytest.raises(RuntimeError):
            made.split(300)
        monkeypatch.setattr(VectorIndex, step, real)
        assert found(made.search(rows, 4, qid="id")) == want
    made.drop()


def test_empty_and_small_tables(spark, rows):
    made = VectorIndex(spark, "empty").create(rows.limit(0), DIM)
    assert made.search(rows, 3, qid="id").count() == 0
    assert made.search(rows, 3, probes=2, qid="id").count() == 0
    made.create(rows.filter("id = 'v1'"), DIM)
    assert {r.id for r in made.search(rows, 3, qid="id").collect()} == {"v1"}
    with pytest.raises(ValueError):
        made.create(rows, DIM, cells=V.PIVOT_BYTES)
    made.drop()

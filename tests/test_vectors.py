import numpy as np
import pytest
from conftest import plan
from pyspark.sql import functions as F

from reviewloom.operators import vectors
from reviewloom.sources.collections import Collection, Spec, list_collections, send_batches

DIM = 6


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(7)
    m = rng.normal(size=(300, DIM)).astype("float32")
    m[:100] = m[0]  # a third of all vectors are copies
    m[100:110] = 0
    rows = [(f"v{i:03d}", [float(x) for x in v]) for i, v in enumerate(m)]
    return rows, spark.createDataFrame([*rows, ("vnull", None)], "id string, embedding array<float>")


def brute(rows, k):
    ids = [r[0] for r in rows]
    m = np.array([r[1] for r in rows])
    n = np.linalg.norm(m, axis=1, keepdims=True)
    m = m / np.where(n > 0, n, 1)
    sim = np.round(m @ m.T, 9)
    return {
        (ids[i], ids[j], rank)
        for i in range(len(ids))
        for rank, j in enumerate(sorted(range(len(ids)), key=lambda j: (-sim[i, j], ids[j]))[:k], 1)
    }


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "pivots": 8}, {"broadcast_bytes": 0}])
def test_nearest_equal_brute_force(points, monkeypatch, options):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 40)  # cells and query parts are cut
    rows, df = points
    got = vectors.knn(df, df, 4, DIM, "id", "embedding", "id", "embedding", **options)
    assert {(r.qid, r.id, r["rank"]) for r in got.collect()} == brute(rows, 4)


def test_a_row_is_its_own_neighbour_and_limits_come_before_the_shuffle(points):
    _, df = points
    one = df.filter("id = 'v200'")
    got = vectors.knn(one, df, 1, DIM, "id", "embedding", "id", "embedding")
    assert got.first()["id"] == "v200"
    text = plan(got)
    assert "WindowGroupLimit" in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_fewer_rows_than_k(points):
    _, df = points
    few = df.filter("id IN ('v200', 'v201')")
    assert vectors.knn(df.filter("id = 'v000'"), few, 9, DIM, "id", "embedding", "id").count() == 2
    by_cells = vectors.knn(few, few, 9, DIM, "id", "embedding", "id", "embedding", 0, 2)
    assert by_cells.count() == 4
    assert vectors.knn(df.limit(0), few, 3, DIM, "id", "embedding", "id").count() == 0


def test_approximate_recall_grows_to_one(points):
    _, df = points
    exact = vectors.knn(df, df, 4, DIM, "id", "embedding", "id", "embedding")

    def recall(probes):
        found = vectors.knn_approx(df, df, 4, DIM, probes, "id", "embedding", "id", "embedding", 8)
        return vectors.recall(exact, found).first()["recall"]

    assert recall(8) == 1.0 and 0.5 < recall(3) <= 1.0


def test_one_index_serves_many_searches(points):
    rows, df = points
    made = vectors.index(df, DIM, "id", pivots=8)
    want = brute(rows, 3)
    for size in (0, vectors.BROADCAST_BYTES):
        got = vectors.knn(df, made, 3, DIM, "id", broadcast_bytes=size)
        assert {(r.qid, r.id, r["rank"]) for r in got.collect()} == want
    assert vectors.knn_approx(df, made, 3, DIM, 8, "id").count() == len(want)


def test_embed(spark):
    df = spark.createDataFrame([(1, "a b a", "c"), (2, None, None), (3, "...", "")], "id int, x string, y string")
    made = vectors.embed(df, ["x", "y"], dim=16).orderBy("id").collect()
    assert abs(sum(w * w for w in made[0].embedding) - 1) < 1e-6 and len(made[0].embedding) == 16
    assert made[1].embedding == [0.0] * 16 == made[2].embedding
    filtered = vectors.embed(df, ["x", "y"], dim=16).filter("embedding[0] >= 0 AND size(embedding) > 0")
    assert filtered.count() == 3  # a filter on the vector must not blow up the plan
    s = vectors.stats(vectors.embed(df, ["x"], dim=16)).first()
    assert (s.n, s.min_dim, s.max_dim) == (3, 16, 16)


def test_embed_with_model(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "id int, t string")

    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    got = {r.id: r.embedding for r in vectors.embed_with_model(df, ["t"], load).collect()}
    assert got == {1: [3.0, 1.0], 2: [0.0, 1.0]}


def test_near_text_wants_one_encoder(spark):
    df = vectors.embed(spark.createDataFrame([(1, "red shoe"), (2, "blue hat")], "id int, t string"), ["t"])
    q = spark.createDataFrame([(7, "a blue hat")], "qid int, q string")
    assert vectors.near_text(q, df, 1, "qid", "q").first()["id"] == 2
    with pytest.raises(ValueError):
        vectors.near_text(q, df, 1, "qid", "q", encoder="other")


def test_lookup_is_case_insensitive_and_keeps_few(spark):
    df = spark.createDataFrame([(i, "B1" if i % 3 else "B2") for i in range(50)], "id int, asin string")
    ids = spark.createDataFrame([("b1",)] * 20 + [("zz",)], "asked_id string")
    got = vectors.lookup(ids, df, "asked_id", "asin", ["id"], 5)
    assert [(r.asked, r.id) for r in got.orderBy("rank").collect()] == [("B1", i) for i in (1, 2, 4, 5, 7)]


def test_collections(spark):
    spec = Spec(("asin", "overall", "verified", "unixReviewTime"))
    made = Collection(spark, "review").create(spec)
    rows = spark.createDataFrame(
        [("B1", "5", "true", "10", [1.0, 0.0]), ("B2", "bad", None, "x", None)],
        "asin string, overall string, verified string, unixReviewTime string, embedding array<double>",
    )
    made.write(rows, spec)
    assert made.exists() and made.count() == 2 and made.encoder() == "hashed-words"
    assert "review" in list_collections(spark)
    got = made.read().filter("asin = 'B1'").first().asDict()
    assert got == {"asin": "B1", "overall": 5.0, "verified": True, "unixReviewTime": 10, "embedding": [1.0, 0.0]}
    with pytest.raises(ValueError):
        made.append(rows)
    Collection(spark, "review").create(spec)
    assert made.count() == 0
    made.drop()
    assert not made.exists()


def test_batches_are_sent_and_retried(spark, tmp_path):
    target = str(tmp_path)

    def send(batch):
        import os
        import uuid

        mark = f"{target}/failed"
        if not os.path.exists(mark):
            open(mark, "w").close()
            raise OSError("first try fails")
        with open(f"{target}/{uuid.uuid4().hex}.batch", "w") as f:
            f.write(repr(batch))

    df = spark.range(25).select("id", F.when(F.col("id") > 5, 1).alias("x")).coalesce(2)
    send_batches(df, send, batch_size=10, wait=0.01)
    sent = [eval(p.read_text()) for p in tmp_path.glob("*.batch")]
    assert max(map(len, sent)) <= 10
    flat = [row for batch in sent for row in batch]
    assert sorted(r["id"] for r in flat) == list(range(25))
    assert sum("x" in r for r in flat) == 19

"""The permutation index against brute force at a share that leaves most rows out."""

import numpy as np
from pyspark.sql import functions as F

from reviewloom.llm import permutation_index


def recall(spark, x, **how):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = permutation_index.nearest_by_inner_product(df, F.col("vec_id") % 40 == 0, **how).collect()
    hits = 0
    for q in range(0, len(x), 40):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len({r.vec_id for r in found if r.query_id == q} & set(np.argsort(-score)[:20].tolist()))
    return hits / (20 * len(range(0, len(x), 40)))


def directions(n):
    x = np.random.default_rng(8).standard_normal((n, 32))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_recall_at_the_share_of_large_blocks(spark):
    assert recall(spark, directions(4000), floor=100, block=1000) >= 0.9


def test_recall_with_mixed_lengths(spark):
    lengths = np.random.default_rng(9).lognormal(0, 0.7, (4000, 1))
    assert recall(spark, directions(4000) * lengths, floor=100, block=1000) >= 0.9
    lengths[:100] *= 50
    assert recall(spark, directions(4000) * lengths, floor=100, block=1000) >= 0.9

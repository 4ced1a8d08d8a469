"""Approximate nearest neighbours by a permutation index with pivot inverted files."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.near_vectors import packed, unpack, usable
from reviewloom.session import materialize


def choose_pivots(unit: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the sampled unit vectors, none close to an earlier one, so copies count once."""
    chosen = np.zeros((0, unit.shape[1]))
    for limit in (0.7, 0.95, 0.9999999):
        for x in unit:
            if len(chosen) == n:
                return chosen
            if not len(chosen) or (chosen @ x).max() < limit:
                chosen = np.vstack([chosen, x])
    return chosen


def nearest_by_inner_product(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    pivots: int = 128,
    share: float = 0.12,
    floor: int = 1000,
    block: int = 8192,
    query_block: int = 8192,
) -> DataFrame:
    """The ``k`` rows of largest inner product for each row that ``is_query`` selects, best first.

    Each vector is represented by all pivots in the order of their nearness to it. The index is a
    set of blocks of about ``block`` vectors, spread by a hash of the row, and in each block every
    pivot has an inverted file: the place of that pivot in each vector's order. Every block of
    queries meets every block of the index: the files are read pivot by pivot, the differences of
    places are added up to the footrule distance, and the best ``share`` of the block by it
    (at least ``floor`` vectors, and all that tie with the last of them) are ranked again
    by the exact inner product in double precision. Each block gives k rows a query, of which the
    best k stay. Of equal vectors the index holds the k + 1 smallest ids, all that any answer can
    use, so copies neither crowd out other candidates nor lose a place to larger ids. The order of
    pivots says nothing of a vector's length, so candidates are the rows whose length times the
    cosine that their footrule suggests, plus some standard errors, is largest; for vectors of one
    length that is the order of the footrule.

    Pivots come from a sample of at most 16 times their number, so the broadcast is bounded; every
    distinct usable vector is indexed, and a query never meets its own row. Columns: ``query_id``, ``rank``
    from 1, ``vec_id``, ``score``; ties go to the smaller id. Vectors that are null, zero, or hold
    null or non-finite parts take no part; shorter ones count as filled up with zeros. A row with
    fewer candidates than k gets all of them. Repeated ids are rows of their own.
    """
    rows = df.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("_v"), is_query.alias("_query"))
    rows = rows.filter(usable(F.col("_v")))
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"query_id {kind}, rank int, vec_id {kind}, score double"
    stats = rows.agg(F.max(F.size("_v")).alias("dims"), F.count("*").alias("n"), F.count(F.when(F.col("_query"), 1)).alias("q")).first()
    if not stats["dims"]:
        return df.sparkSession.createDataFrame([], schema)
    dims, n = stats["dims"], stats["n"]
    # written once, so that a row's number and block are the same in all uses
    numbered = materialize(
        packed(rows.withColumn("_row", F.monotonically_increasing_id()), "_v", dims, unit=False), "vectors"
    )
    sample = numbered.select("vec").sample(min(1.0, 32 * pivots / n), seed=11).limit(16 * pivots).toArrow()
    x = unpack(sample.column("vec") if len(sample) else numbered.select("vec").limit(pivots).toArrow().column("vec"), dims)
    x = x / np.abs(x).max(1, keepdims=True)
    chosen = choose_pivots(x / np.linalg.norm(x, axis=1, keepdims=True), pivots)
    sent = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(chosen.T))

    def places(vectors: np.ndarray) -> np.ndarray:
        """The place of each pivot in each vector's order, pivot by pivot."""
        order = np.argsort(-(vectors @ sent.value), axis=1, kind="stable")
        place = np.empty(order.shape, np.uint8 if order.shape[1] <= 128 else np.uint16)
        np.put_along_axis(place, order, np.arange(order.shape[1], dtype=place.dtype)[None, :], 1)
        return np.ascontiguousarray(place.T)

    n_blocks, n_queries = -(-n // block), max(1, -(-stats["q"] // query_block))
    spread = F.xxhash64("_row")
    copies = Window.partitionBy("vec").orderBy("vec_id", "_row")
    index = numbered.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= k + 1)
    index = index.withColumn("b", F.pmod(spread, F.lit(n_blocks)).cast("int"))
    # one copy of each row for each block of queries, one of each query for each block of rows
    index = index.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1)))).withColumn("side", F.lit(0))
    asked = numbered.filter("_query").withColumn("q", F.pmod(spread, F.lit(n_queries)).cast("int"))
    asked = asked.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn("side", F.lit(1))
    columns = ["b", "q", "side", "_row", "vec_id", "vec"]

    # the mean footrule of two orders with normal scores of correlation c is 1/2 - asin((1 + c) / 2) / pi
    # of the squared number of pivots; long vectors get the doubt, since they can win the most
    p = chosen.shape[0]
    cosines = 2 * np.cos(np.pi * np.arange(p * p // 2 + 1) / p**2) - 1 + 2.5 / np.sqrt(p)

    def search(key: tuple, group: pa.Table) -> pa.Table:
        side = group["side"].to_numpy()
        here, there = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        out: list[list] = [[], [], [], []]
        if len(here) and len(there):
            number, ids = group["_row"].to_numpy(), group["vec_id"]
            names = ids.to_numpy() if pa.types.is_integer(ids.type) else np.array(ids.to_pylist())
            vectors = unpack(group["vec"], dims)
            mine = vectors[here]
            files, wanted = places(mine), places(vectors[there])
            scaled = mine / np.abs(mine).max()  # so that no square overflows
            length = np.linalg.norm(scaled, axis=1)
            top = min(len(here), max(floor, int(np.ceil(share * len(here)))))
            scratch, more, least = (np.empty(len(here), files.dtype) for _ in range(3))

            def apart(file: np.ndarray, place: int, out: np.ndarray) -> np.ndarray:
                np.minimum(file, place, out=least)
                return np.subtract(np.maximum(file, place, out=out), least, out=out)

            for j, q in enumerate(there):
                footrule = np.zeros(len(here), np.uint32)
                for i in range(0, len(files), 2):  # two differences fit the small type
                    total = apart(files[i], wanted[i, j], scratch)
                    if i + 1 < len(files):
                        total += apart(files[i + 1], wanted[i + 1, j], more)
                    footrule += total
                worth = length * cosines[footrule]
                worth[number[here] == number[q]] = -np.inf
                last = np.partition(worth, len(here) - top)[len(here) - top]
                near = np.flatnonzero(worth >= last)  # all that tie at the cut
                near = near[number[here[near]] != number[q]]
                exact = (mine[near] * vectors[q]).sum(1)
                first = np.lexsort((names[here[near]], -exact))[:k]
                out[0] += [number[q]] * len(first)
                out[1] += [names[q]] * len(first)
                out[2] += names[here[near[first]]].tolist()
                out[3] += exact[first].tolist()
        types = [pa.int64(), group.schema.field("vec_id").type, group.schema.field("vec_id").type, pa.float64()]
        return pa.table({c: pa.array(v, t) for c, v, t in zip(["_row", "query_id", "vec_id", "score"], out, types)})

    found = (
        index.select(columns)
        .union(asked.select(columns))
        .groupBy("b", "q")
        .applyInArrow(search, f"_row long, query_id {kind}, vec_id {kind}, score double")
    )
    best = Window.partitionBy("_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

"""Vectors within a cosine of each other: an epsilon grid order join over blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.components import components
from reviewloom.operators.paging import positions
from reviewloom.session import materialize


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null, no null or non-finite part, not all zero."""
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    )
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unpack(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dims)


def packed(df: DataFrame, vector: str, dims: int, unit: bool) -> DataFrame:
    """``df`` with ``vector`` as bytes of ``dims`` doubles, shorter ones filled up with zeros."""
    names = [c for c in df.columns if c != vector]
    at = [df.columns.index(c) for c in names]
    v = df.columns.index(vector)

    def run(batches):
        for b in batches:
            rows = np.zeros((b.num_rows, dims))
            for i, x in enumerate(b.column(v).to_numpy(zero_copy_only=False)):
                rows[i, : len(x)] = x
            if unit:
                rows /= np.abs(rows).max(1, keepdims=True)  # so that no square overflows
                rows /= np.linalg.norm(rows, axis=1, keepdims=True)
            made = pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in at], made], [*names, "vec"])

    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in names)
    return df.mapInArrow(run, f"{kinds}, vec binary")


def principal(df: DataFrame, dims: int, rows: int = 4096) -> np.ndarray:
    """Principal directions (columns) of a sample of at most ``rows`` vectors."""
    total = df.count()
    share = min(1.0, 2 * rows / max(total, 1))
    sample = df.select("vec").sample(share, seed=3).limit(rows).toArrow()
    x = unpack(sample.column("vec"), dims)
    if not len(x):
        return np.eye(dims)
    x = x - x.mean(0)
    return np.linalg.eigh(x.T @ x)[1][:, ::-1]


def link(
    df: DataFrame,
    least: float = 0.9,
    key: str = "vec_id",
    vector: str = "embedding",
    leading: int = 16,
    block: int = 4096,
    fan: int = 8,
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Two vectors are linked if their cosine, in double precision, is at least ``least``. Equal
    directions are first folded into one weighted row. Unit vectors within the matching distance
    are found by an epsilon grid order: cells of that width on the leading principal directions
    give the order, which is cut into blocks; intervals of blocks are joined recursively, and a
    pair of intervals whose bounding boxes lie further apart than the distance is skipped with all
    it holds. Remaining block pairs are compared as matrices, a slice at a time, and give counts
    and a forest of links, never the pairs themselves. The result is exact; the sample behind the
    principal directions changes only which blocks are skipped.

    Vectors that are null, zero, or hold null or non-finite parts have no links and are their own
    component; shorter vectors count as filled up with zeros. Rows with equal ids are vectors of
    their own that share an id; ``kept`` is true where the id is the component's smallest. Other
    columns are not read; an empty table gives no rows.
    """
    rows = df.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("_v"))
    good = rows.filter(usable(F.col("_v")))
    dims = good.agg(F.max(F.size("_v"))).first()[0]
    alone = [
        F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
        F.lit(True).alias("kept"),
    ]
    if not dims:
        return rows.select("vec_id", *alone)
    unit = packed(good, "_v", dims, unit=True).withColumn("_same", F.sha2("vec", 256))
    unit = materialize(unit, "unit")
    folded = unit.groupBy("_same").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("weight"), F.first("vec").alias("vec")
    )
    basis = principal(unit, dims)[:, :leading]
    width = np.sqrt(max(2 - 2 * least, 0.0)) + 1e-9
    k = basis.shape[1]
    cells = [f"_c{i}" for i in range(min(k, 4))]

    def place(batches):
        for b in batches:
            y = unpack(b.column(b.schema.get_field_index("vec")), dims) @ basis
            made = [pa.array(list(y), pa.list_(pa.float64()))]
            made += [pa.array(np.floor(y[:, i] / width).astype(np.int32)) for i in range(len(cells))]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], [*b.schema.names, "y", *cells])

    schema = "_same string, first long, weight long, vec binary, y array<double>, " + ", ".join(
        f"{c} int" for c in cells
    )
    kind = rows.schema["vec_id"].dataType.simpleString()
    placed = folded.mapInArrow(place, schema.replace("first long", f"first {kind}"))
    ordered = positions(placed, [*cells, "_same"]).withColumn(
        "block", F.floor(F.col("position") / block)
    )
    ordered = materialize(ordered.select("position", "block", "first", "_same", "weight", "vec", "y"), "ordered")
    pairs = _block_pairs(ordered, k, width, fan)

    wide = ordered.select("block", "position", "weight", "vec")
    sides = wide.join(pairs, F.col("block") == F.col("a")).select("a", "b", F.lit(0).alias("side"), *wide.columns)
    others = wide.join(pairs.filter("a <> b"), F.col("block") == F.col("b")).select(
        "a", "b", F.lit(1).alias("side"), *wide.columns
    )

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        side = group["side"].to_numpy()
        order = np.lexsort((group["position"].to_numpy(), side))
        ids, weight = group["position"].to_numpy()[order], group["weight"].to_numpy()[order]
        x = unpack(group["vec"], dims)[order]
        n = int((side == 0).sum())
        same = key[0].as_py() == key[1].as_py()
        right = slice(0, n) if same else slice(n, len(x))
        count = np.zeros(len(x), np.int64)
        forest = Forest(len(x))
        for at in range(0, n, 512):
            near = x[at : min(at + 512, n)] @ x[right].T >= least
            if same:
                near[np.arange(len(near)), at + np.arange(len(near))] = False
            count[at : at + len(near)] += near @ weight[right]
            if not same:
                count[right] += weight[at : at + len(near)] @ near
            for i in np.flatnonzero(near.any(1)):
                forest.join(at + i, np.flatnonzero(near[i]) + right.start)
        hit = np.flatnonzero(count)
        root = forest.roots()
        return pa.table({"node": ids[hit], "n": count[hit], "root": ids[root[hit]]})

    found = (
        sides.union(others)
        .groupBy("a", "b")
        .applyInArrow(compare, "node long, n long, root long")
    )
    found = materialize(found, "near")
    links = found.groupBy("node").agg(F.sum("n").alias("_n"))
    classes = components(found.filter("node <> root").select("node", "root"))
    member = (
        ordered.select("_same", "first", "weight", F.col("position").alias("node"))
        .join(links, "node", "left")
        .join(classes, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    names = member.groupBy("component").agg(F.min("first").alias("component_id"))
    member = member.join(names, "component").select(
        "_same", (F.coalesce("_n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    linked = unit.select("vec_id", "_same").join(member, "_same")
    return linked.select(
        "vec_id",
        "n_links",
        "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    ).union(rows.filter(~usable(F.col("_v"))).select("vec_id", *alone))


class Forest:
    """Sets of row numbers that are joined; the smallest number names a set."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def join(self, i: int, others: np.ndarray) -> None:
        roots = self._roots(np.append(others, i))
        self.up[np.unique(roots)] = roots.min()

    def _roots(self, at: np.ndarray) -> np.ndarray:
        while True:
            up = self.up[at]
            if (up == at).all():
                return at
            self.up[at] = self.up[up]  # shorter next time
            at = up

    def roots(self) -> np.ndarray:
        return self._roots(np.arange(len(self.up)))


def _block_pairs(ordered: DataFrame, k: int, width: float, fan: int) -> DataFrame:
    """Pairs a <= b of blocks whose bounding boxes are within ``width``.

    Starts with the interval of all blocks against itself and replaces each pair of intervals that
    is near enough by the pairs of their ``fan`` parts, down to single blocks.
    """
    boxes = ordered.groupBy("block").agg(
        F.array(*[F.min(F.col("y")[i]) for i in range(k)]).alias("low"),
        F.array(*[F.max(F.col("y")[i]) for i in range(k)]).alias("high"),
    )
    boxes = materialize(boxes, "boxes")
    n = (boxes.agg(F.max("block")).first()[0] or 0) + 1
    spark = ordered.sparkSession
    depth = 0
    while fan**depth < n:
        depth += 1
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    for level in range(depth - 1, -1, -1):
        part = fan**level
        level_boxes = boxes.groupBy(F.floor(F.col("block") / part).alias("i")).agg(
            F.array(*[F.min(F.col("low")[j]) for j in range(k)]).alias("low"),
            F.array(*[F.max(F.col("high")[j]) for j in range(k)]).alias("high"),
        )
        children = F.sequence(F.lit(0), F.lit(fan - 1))
        pairs = (
            pairs.withColumn("i", F.explode(children))
            .withColumn("j", F.explode(children))
            .select((F.col("a") * fan + F.col("i")).alias("a"), (F.col("b") * fan + F.col("j")).alias("b"))
            .filter("a <= b")
        )
        left = level_boxes.select(F.col("i").alias("a"), F.col("low").alias("la"), F.col("high").alias("ha"))
        right = level_boxes.select(F.col("i").alias("b"), F.col("low").alias("lb"), F.col("high").alias("hb"))
        zero = F.lit(0.0)
        gaps = [
            F.pow(F.greatest(F.col("la")[j] - F.col("hb")[j], F.col("lb")[j] - F.col("ha")[j], zero), 2)
            for j in range(k)
        ]
        distance = sum(gaps[1:], gaps[0])
        pairs = materialize(
            pairs.join(left, "a").join(right, "b").filter(distance <= width**2).select("a", "b"), "pairs"
        )
    return pairs

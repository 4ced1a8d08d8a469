"""A quality classifier: random Fourier features of document statistics, ridge, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from reviewloom.llm.batches import add_columns, keep_rows
from reviewloom.session import materialize

#: Groups of bytes whose shares of a text are statistics.
GROUPS = [
    bytes(range(65, 91)),
    bytes(range(97, 123)),
    b"0123456789",
    b" \t",
    b"\n\r",
    b".",
    b",",
    b"!",
    b"?;:'\"-()",
    b"#$%&*@^~",
    b"|",
    b"<>{}[]\\/_=+`",
    bytes(range(128, 256)),
    bytes(b for b in range(32) if b not in b"\t\n\r"),
]
_GROUP = np.zeros((256, len(GROUPS)))
for _i, _g in enumerate(GROUPS):
    _GROUP[list(_g), _i] = 1.0
N_STATISTICS = len(GROUPS) + 12


def statistics(text: bytes) -> list[float]:
    """Sizes, shares of kinds of characters, and repetition of a whole text; zeros for an empty one."""
    if not text:
        return [0.0] * N_STATISTICS
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = counts / len(text)
    seen = shares[shares > 0]
    words, lines = text.split(), text.split(b"\n")
    n, n_lines = max(len(words), 1), len(lines)
    different = set(words)
    length = sum(map(len, words)) / n
    pairs = len(set(zip(words, words[1:]))) / max(len(words) - 1, 1) if len(words) > 1 else 1.0
    return [
        *(shares @ _GROUP),
        np.log1p(len(text)),
        np.log1p(len(words)),
        length,
        np.log1p(max(map(len, words), default=0)),
        len(different) / n,
        pairs,
        np.log1p(n_lines),
        len(set(lines)) / n_lines,
        np.log1p(len(text) / n_lines),
        float(-(seen * np.log2(seen)).sum()),
        sum(map(bytes.isalpha, different)) / max(len(different), 1),
        sum(map(bytes.isupper, different)) / max(len(different), 1),
    ]


def _features(x: np.ndarray, model: dict) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    standard = np.clip((x - model["mean"]) / model["std"], -8, 8)
    n = len(model["shift"])
    waves = np.sqrt(2.0 / n) * np.cos(standard @ model["waves"] + model["shift"])
    return np.concatenate([waves, np.ones((len(x), 1))], 1)


def fit(
    df: DataFrame,
    labels: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = 30_000,
    features: int = 192,
    width: float = 6.0,
    ridge: float = 1e-3,
    bins: int = 512,
) -> dict:
    """The model: kernel features, ridge weights, and the calibration from raw to final scores.

    Learns from a sample of about ``rows`` labelled keys (all, if there are fewer) for which
    ``learn`` is true, chosen by a hash of the key; a key with several labels has their mean. The
    sample is broadcast to the texts, so no text is shuffled. Three quarters of it give the normal
    equations, which each task sums over its rows before they are added up, and the rest the bins
    on which the isotonic calibration is fitted.
    """
    wanted = (
        labels.filter(learn)
        .select(F.col(key).alias("_key"), F.col(label).cast("double").alias("_label"))
        .filter(F.col("_key").isNotNull() & F.col("_label").isNotNull())
    )
    total = wanted.count()
    chance = F.pmod(F.xxhash64(F.lit(5), "_key"), F.lit(1 << 30)) / float(1 << 30)
    sample = (
        wanted.filter(chance < F.lit(min(1.0, rows / max(total, 1))))
        .groupBy("_key")
        .agg(F.avg("_label").alias("_label"))
        .withColumn("_calibrate", F.pmod(F.xxhash64(F.lit(6), "_key"), F.lit(4)) == 0)
    )
    # the sample has about 30,000 rows of three numbers at most
    chosen = df.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(sample), "_key")

    def describe(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            x = [statistics(t or b"") for t in b.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), pa.array(x, pa.list_(pa.float64()))], ["y", "calibrate", "x"]
            )

    known = materialize(
        chosen.select("text", "_label", "_calibrate").mapInArrow(
            describe, "y double, calibrate boolean, x array<double>"
        ),
        "statistics",
    )
    moments = known.select(
        F.count("*").alias("n"),
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(N_STATISTICS)],
        *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(N_STATISTICS)],
    ).first()
    rng = np.random.default_rng(17)
    model = {
        "waves": rng.normal(0, 1 / width, (N_STATISTICS, features)),
        "shift": rng.uniform(0, 2 * np.pi, features),
        "mean": np.array([moments[f"m{i}"] or 0.0 for i in range(N_STATISTICS)]),
        "std": np.array([max(moments[f"s{i}"] or 0.0, 1e-6) for i in range(N_STATISTICS)]),
        "weights": np.append(np.zeros(features), 0.5),
        "from": np.array([0.0, 1.0]),
        "to": np.array([0.0, 1.0]),
    }
    if not moments["n"]:
        return model
    size = features + 1
    upper = np.triu_indices(size)

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy().reshape(-1, N_STATISTICS)

    def equations(batches: Iterable[pa.RecordBatch]):
        left, right = np.zeros((size, size)), np.zeros(size)
        for b in batches:
            z = _features(matrix(b.column(1)), model)
            left += z.T @ z
            right += z.T @ b.column(0).to_numpy()
        values = np.concatenate([left[upper], right])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["cell", "v"])

    fitted = known.filter(~F.col("calibrate"))
    sums = (
        fitted.select("y", "x")
        .mapInArrow(equations, "cell long, v double")
        .groupBy("cell")
        .agg(F.sum("v").alias("v"))
        .toArrow()
    )  # as many rows as the equations have cells, whatever the corpus
    values = np.zeros(len(upper[0]) + size)
    values[sums.column("cell").to_numpy()] = sums.column("v").to_numpy()
    left = np.zeros((size, size))
    left[upper] = values[: len(upper[0])]
    left = left + np.triu(left, 1).T
    left[np.arange(features), np.arange(features)] += ridge * max(left[-1, -1], 1.0)
    model["weights"] = np.linalg.lstsq(left, values[len(upper[0]) :], rcond=None)[0]

    def binned(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            raw = np.clip(_features(matrix(b.column(1)), model) @ model["weights"], -0.5, 1.5)
            place = np.minimum(((raw + 0.5) * (bins / 2)).astype(np.int64), bins - 1)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(raw), b.column(0)], ["bin", "raw", "y"])

    places = (
        known.filter("calibrate")
        .select("y", "x")
        .mapInArrow(binned, "bin long, raw double, y double")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.avg("raw").alias("raw"), F.avg("y").alias("y"))
        .orderBy("bin")
        .collect()
    )  # one row a bin
    if places:
        model["from"], model["to"] = isotonic([(r["raw"], r["y"], r["n"]) for r in places])
    return model


def isotonic(points: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the non-decreasing least-squares fit to (place, value, weight) in order."""
    blocks: list[list[float]] = []
    for x, y, w in points:
        blocks.append([x * w, y * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    at = np.array([b[0] / b[2] for b in blocks])
    return at, np.array([b[1] / b[2] for b in blocks])


def _scores(texts: pa.Array, model: dict) -> np.ndarray:
    rows = [statistics(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
    if not rows:
        return np.zeros(0)
    raw = _features(np.array(rows), model) @ model["weights"]
    # a hundredth of the raw score keeps the order where the calibration is flat
    return 0.99 * np.interp(raw, model["from"], model["to"]) + 0.01 * np.clip((raw + 0.5) / 2, 0, 1)


def score(df: DataFrame, model: dict, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the calibrated score of each whole text, 0 to 1, higher for label 1.

    A null text counts as empty, whose statistics are all 0. Without labels the score is 0.5, give
    or take a hundredth. The model is a few hundred numbers squared and is sent with the tasks;
    texts are not shuffled. A column ``out`` is replaced; all rows stay.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)
    return add_columns(
        df, [text], [StructField(out, DoubleType())], lambda: lambda texts: [pa.array(_scores(texts, sent.value))]
    )


def keep_good(df: DataFrame, model: dict, text: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of ``df`` whose score is at least ``least``; all columns stay."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    return keep_rows(df, [text], lambda: lambda texts: _scores(texts, sent.value) >= least)

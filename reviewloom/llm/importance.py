"""Importance resampling towards a target corpus, with weights summed from bit planes."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from reviewloom.functions.names import quoted
from reviewloom.llm.batches import add_columns
from reviewloom.llm.licenses import NORMAL
from reviewloom.operators.paging import positions
from reviewloom.session import materialize

BUCKETS = 10_000
LONGEST = 3  # words of a feature
PIECE = 1 << 20  # bytes of a text split at once
TOGETHER, FEATURES = 32, 1 << 18  # texts, and features, whose counts are held in one matrix


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists from pieces of about ``PIECE`` bytes that tear no word."""
    plain, at = text.translate(NORMAL), 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE) + 1 or len(plain)
        yield plain[at:end].split()
        at = end


def _features(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Numbers of new words and the buckets of the features that end in them, piece by piece."""
    before: list[bytes] = []
    for new in _word_lists(text):
        words = before + new
        spaced = [b" " + w for w in words]
        sums = [list(map(crc32, words))]
        for order in range(1, LONGEST):  # a longer feature carries the checksum of the shorter one on
            sums.append(list(map(crc32, spaced[order:], sums[-1])))
        made = [s[max(len(before) - order, 0) :] for order, s in enumerate(sums)]
        n = sum(map(len, made))
        yield len(new), np.fromiter(chain(*made), np.int64, n) % BUCKETS
        before = words[max(len(words) - LONGEST + 1, 0) :]


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of truth values as rows of 64-bit words."""
    packed = np.packbits(np.atleast_2d(bits), axis=1)
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def bit_planes(counts: np.ndarray) -> list[np.ndarray]:
    """Plane i holds bit i of each of the non-negative counts, a row of words for a row of counts."""
    return [_packed((counts >> i) & 1 != 0) for i in range(int(counts.max(initial=0)).bit_length())]


def signed_planes(gains: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    """Planes of signed numbers in two's complement, and what a bit of each is worth."""
    bits = max(int(gains.max(initial=0)), -int(gains.min(initial=0)) - 1, 0).bit_length()
    planes = [_packed((gains >> i) & 1 != 0) for i in range(bits)] + [_packed(gains < 0)]
    return planes, [1 << i for i in range(bits)] + [-(1 << bits)]


def weigh(counts: np.ndarray, planes: np.ndarray, worth: list[int]) -> np.ndarray:
    """Of each row of counts, the exact sum of its counts times the gains that the planes hold."""
    out = np.zeros(len(counts), np.int64)
    for i, own in enumerate(bit_planes(counts)):
        for plane, w in zip(planes, worth):
            out += np.bitwise_count(own & plane).sum(1, dtype=np.int64) * (w << i)
    return out


def _count_rows(texts: list[bytes]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Numbers of words, and a matrix of bucket counts, of one group of texts after the other."""
    words: list[int] = []
    places: list[np.ndarray] = []
    summed: dict[int, np.ndarray] = {}  # counts of long texts' pieces
    size = 0

    def counted() -> np.ndarray:
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        matrix = np.bincount(at, minlength=len(words) * BUCKETS).reshape(-1, BUCKETS)
        for row, counts in summed.items():
            matrix[row] += counts
        return matrix.astype(np.uint8 if matrix.max() < 256 else np.int64)

    for row, text in enumerate(texts):
        words.append(0)
        own = len(words) - 1
        for n, buckets in _features(text):
            words[own] += n
            size += len(buckets)
            if len(buckets) > FEATURES // 2:
                summed[own] = summed.get(own, 0) + np.bincount(buckets, minlength=BUCKETS)
            else:
                places.append(buckets + own * BUCKETS)
        if len(words) == TOGETHER or size > FEATURES or row == len(texts) - 1:
            yield words, counted()
            words, places, summed, size = [], [], {}, 0


def _binary(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def bucket_counts(df: DataFrame, text: str = "text", least_words: int = 20) -> tuple[np.ndarray, int]:
    """Features of all texts in each bucket, and the number of texts of at least ``least_words`` words.

    Every task sums its rows first and passes on one row a bucket, so the driver gets as many rows
    as there are buckets, whatever the corpus.
    """

    def run(batches: Iterable[pa.RecordBatch]):
        total, long = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for words, matrix in _count_rows(_binary(batch.column(0))):
                total += matrix.sum(0, dtype=np.int64)
                long += sum(n >= least_words for n in words)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS)), pa.array(total), pa.array([long] + [0] * (BUCKETS - 1), pa.int64())],
            ["bucket", "n", "long"],
        )

    parts = df.select(text).mapInArrow(run, "bucket long, n long, long long")
    summed = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("long").alias("long")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    return out, int(sum(summed.column("long").to_pylist()))


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: thousandths of the logarithm of its smoothed share in the target over that in the source."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(key: str, seed: int = 42) -> Column:
    """Gumbel noise in thousandths, by a hash of the seed and the key alone; a null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _weighed(rows: DataFrame, planes: tuple[list[np.ndarray], list[int]]) -> DataFrame:
    """``rows`` with the numbers of words and features, and the weight, of ``_text``."""
    sent = rows.sparkSession.sparkContext.broadcast(planes)  # some 20 planes of as many bits as buckets

    def make():
        def compute(texts: pa.Array) -> list[pa.Array]:
            words, features, weights = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for n, matrix in _count_rows(_binary(texts)):
                words += n
                features.append(matrix.sum(1, dtype=np.int64))
                weights.append(weigh(matrix, *sent.value))
            return [pa.array(words, pa.int64()), *[pa.array(np.concatenate(x)) for x in (features, weights)]]

        return compute

    fields = [StructField(c, LongType()) for c in ("_words", "_features", "_weight")]
    return add_columns(rows, ["_text"], fields, make).drop("_text")


def resample(
    df: DataFrame,
    target: DataFrame,
    percent: int = 5,
    least_words: int = 20,
    seed: int = 42,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    carry: Iterable[str] = (),
) -> DataFrame:
    """One row per row of ``df``: its key, ``n_features``, ``weight``, ``score``, ``rank``, and the columns to ``carry``.

    Features are all runs of 1 to 3 consecutive words of a whole text, repeats counted, in 10,000
    buckets by checksum. A bucket's gain compares its share in the target with that in ``df``; a
    text's weight is the sum of its features' gains. Weights come from bit planes: bit i of a
    text's 10,000 bucket counts is one plane, bit j of the signed gains another; the number of
    their common bits, times the powers of two they stand for, adds up to the exact sum. With
    Gumbel noise added, the highest scores are a draw with chances that follow the weights. Of the
    N rows with at least ``least_words`` words, floor(``percent`` N / 100) are drawn and ranked
    from 1; all others have a null rank.

    The corpus is read twice, for the bucket totals and for the weights; texts are not shuffled and
    no text's counts are kept. The scored rows, without texts, are written once and sorted by range.
    Ties go to the smaller key, a null key (its noise is that of an empty one) after all others,
    then to fewer features; rows equal in all of these, such as repeated ones, are
    interchangeable. Null, empty and wordless texts have no features and weight 0. A very long text
    is counted in pieces. An empty table gives no rows; an empty target counts as T = 0. Columns of
    ``df`` may have any names; a carried one with the name of a result is left out.
    """
    source, n_long = bucket_counts(df, text, least_words)
    new = {"n_features", "weight", "score", "rank"}
    kept = [quoted(c) for c in (key, *carry) if c.lower() not in new]
    # the columns to keep in one struct, so that none can clash with those needed here
    rows = df.select(
        F.struct(*kept).alias("_row"), F.col(quoted(key)).alias("_key"), F.col(quoted(text)).alias("_text")
    )
    weighed = _weighed(rows, signed_planes(gains(source, bucket_counts(target, target_text)[0])))
    scored = materialize(weighed.withColumn("_score", F.col("_weight") + noise("_key", seed)), "scored")
    results = ["_row.*", F.col("_features").alias("n_features"), F.col("_weight").alias("weight")]
    results.append(F.col("_score").alias("score"))
    drawn = F.when(F.col("position") < percent * n_long // 100, F.col("position") + 1)
    order = scored.filter(F.col("_words") >= least_words).select(
        "*", (-F.col("_score")).alias("_down"), F.col("_key").isNull().alias("_last")
    )
    ranked = positions(order, ["_down", "_last", "_key", "_features"]).select(*results, drawn.alias("rank"))
    short = scored.filter(F.col("_words") < least_words)
    return ranked.union(short.select(*results, F.lit(None).cast("long").alias("rank")))

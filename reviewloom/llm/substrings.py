"""Passages of words that occur more than once anywhere, found by anchors of a difference cover."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from reviewloom.functions.names import quoted
from reviewloom.session import materialize

#: Perfect difference sets by period: every difference modulo the period occurs between two members.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
#: Every white-space byte that separates words becomes a space.
SPACES = bytes(32 if b == 32 or 9 <= b <= 13 else b for b in range(256))
CHUNK = 2 << 20  # bytes of text in a chunk
PIECE = 1 << 18  # bytes whose words are hashed at once
SHORT = 64  # bytes of a word up to which words are hashed together
BUCKET = 16 << 20  # bytes of hashes in a bucket


def cover(words: int) -> tuple[int, tuple[int, ...]]:
    """A period and its cover, for which an anchor still holds two fifths of a window's words."""
    period = max(m for m in COVERS if m == 1 or words - m + 1 >= max(2 * words / 5, 1))
    return period, COVERS[period]


def _numbers(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = _numbers(11, 256)
BYTE[32] = 0
POWER = np.cumprod(np.append(np.ones(1, np.uint64), np.repeat(_numbers(12, 1), SHORT - 1)), dtype=np.uint64)


def _short_words(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of all words; hashes of words over ``SHORT`` bytes are not to be used."""
    raw = np.frombuffer(blob, np.uint8)
    edge = np.diff((raw != 32).astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    raw, at = raw[starts[0] :], starts - starts[0]
    place = np.arange(len(raw)) - np.repeat(at, np.diff(at, append=len(raw)))
    value = BYTE[raw] * POWER[np.minimum(place, SHORT - 1)]
    return starts, ends, _mixed(np.add.reduceat(value, at) + (ends - starts).astype(np.uint64))


def word_hashes(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words of ``blob``, whose separators are spaces, piece by piece."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(blob):
        end = blob.find(b" ", at + PIECE) + 1 or len(blob)
        piece = blob[at:end]
        if len(piece) > 2 * PIECE:  # ends in a very long word
            cut = piece.rstrip(b" ").rfind(b" ") + 1
            last = piece[cut:].rstrip(b" ")
            starts, ends, hashes = _short_words(piece[:cut])
            starts, ends = np.append(starts, cut), np.append(ends, cut + len(last))
            hashes = np.append(hashes, np.zeros(1, np.uint64))
        else:
            starts, ends, hashes = _short_words(piece)
        for i in np.flatnonzero(ends - starts > SHORT).tolist():
            digest = blake2b(piece[starts[i] : ends[i]], digest_size=8).digest()
            hashes[i] = int.from_bytes(digest, "little")
        found.append((starts + at, hashes))
        at = end
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([s for s, _ in found]), np.concatenate([h for _, h in found])


def _at(words: np.ndarray, places: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of the ``n`` words from each of some places on."""
    total = np.zeros(len(places), np.uint64)
    for i, factor in enumerate(_numbers(seed, n)):
        total += words[places + i] * factor
    return _mixed(total)


class Chunk:
    """The texts of one chunk, their anchors, and the windows that hold a repeated anchor."""

    def __init__(self, blob: bytes, lengths: np.ndarray, n: int):
        self.n = n
        ends = np.cumsum(lengths + 1)  # a separator follows each text
        self.blob, self.ends = blob, ends
        starts, self.words = word_hashes(blob.translate(SPACES))
        self.first = np.searchsorted(starts, np.append(0, ends))  # each text's first word
        self.owner = np.repeat(np.arange(len(lengths)), np.diff(self.first))
        self.period, self.cover = cover(n)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the anchors, in texts long enough for a window, and their hashes."""
        size = self.n - self.period + 1
        place = np.arange(len(self.words)) - self.first[self.owner]
        long = np.diff(self.first)[self.owner]
        chosen = np.isin(np.arange(self.period), self.cover)[place % self.period]
        at = np.flatnonzero(chosen & (long >= self.n) & (place + size <= long))
        return at, _at(self.words, at, size, 13)

    def windows(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the windows around repeated anchors, with two hashes of each."""
        size = self.n - self.period + 1
        marks = np.zeros(len(self.words) + 1, np.int64)
        marks[repeated + 1] = 1
        before = np.cumsum(marks)
        start = np.arange(max(len(self.words) - self.n + 1, 0))
        inside = self.first[self.owner[start] + 1] >= start + self.n
        at = start[inside & (before[start + self.n - size + 1] > before[start])]
        return at, _at(self.words, at, self.n, 14), _at(self.words, at, self.n, 15)

    def covered(self, starts: np.ndarray) -> np.ndarray:
        """Which words lie in one of the windows that begin at ``starts``."""
        edge = np.zeros(len(self.words) + 1, np.int64)
        edge[starts] += 1
        edge[starts + self.n] -= 1
        return np.cumsum(edge)[:-1] > 0


def _distinct(bucket: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (bucket, hash) in order: buckets, hashes, how often, and the place of each item among them."""
    order = np.lexsort((hashes, bucket))
    b, h = bucket[order], hashes[order]
    new = np.append(True, (b[1:] != b[:-1]) | (h[1:] != h[:-1])) if len(b) else np.zeros(0, bool)
    place = np.empty(len(b), np.int64)
    place[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    return b[at], h[at], np.diff(at, append=len(b)), place


def _bucket(x: np.ndarray, n: int) -> np.ndarray:
    return (_mixed(x ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(n)).astype(np.int32)


def _sliced(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Slices of an array's bytes as binary values."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _posts(chunk: int, buckets: np.ndarray, hashes: np.ndarray) -> dict[str, pa.Array]:
    """One row for each bucket of a chunk: its distinct hashes there, in order."""
    at = np.flatnonzero(np.diff(buckets, prepend=-1))
    cuts = np.append(at, len(buckets))
    return {
        "bucket": pa.array(buckets[at], pa.int32()),
        "chunk": pa.array(np.full(len(at), chunk, np.int64)),
        "hashes": _sliced(hashes, cuts),
    }


POSTS = "bucket int, chunk long, hashes binary"


def _meet(key: tuple, group: pa.Table) -> pa.Table:
    """Which hashes of a bucket occur in more than one chunk: a byte for each, in the order of each row."""
    group = group.combine_chunks()
    rows = group.column("hashes").to_pylist()
    cuts = np.cumsum([0] + [len(x) // 8 for x in rows])
    hashes = np.frombuffer(b"".join(rows), np.uint64)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    shared = np.zeros(len(hashes), np.uint8)
    shared[order[1:][same]] = 1
    shared[order[:-1][same]] = 1
    return pa.table({"bucket": group.column("bucket"), "chunk": group.column("chunk"), "shared": _sliced(shared, cuts)})


SHARED = "bucket int, chunk long, shared binary"


def _flags(answers: pa.Table, kind: int, counts: np.ndarray) -> np.ndarray:
    """Which of a chunk's distinct hashes occur more than once, there or elsewhere."""
    own = answers.filter(pc.equal(answers["kind"], kind)).sort_by("bucket")
    shared = np.frombuffer(b"".join(own.column("shared").to_pylist()), np.uint8)
    return (shared > 0) | (counts > 1)


def _chunks(df: DataFrame, kept: StructType) -> DataFrame:
    """Rows of ``_row`` and ``_text`` in chunks: (chunk, rows, lengths, n_bytes, texts), texts compressed."""

    def chunk_of(batches: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        texts = [t or b"" for t in table.column(1).cast(pa.binary()).to_pylist()]
        rows = table.column(0).combine_chunks()
        blob = pa.compress(b"".join([t + b"\n" for t in texts]), "zstd", asbytes=True)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), rows),
                pa.array([lengths.tobytes()], pa.binary()),
                pa.array([int(lengths.sum())], pa.int64()),
                pa.array([blob], pa.binary()),
            ],
            ["chunk", "rows", "lengths", "n_bytes", "texts"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held, size = [], 0
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:  # up to the text that fills the chunk
                done = int(sizes[at - 1]) if at else 0
                end = min(int(np.searchsorted(sizes, done + CHUNK - size)) + 1, batch.num_rows)
                held.append(batch.slice(at, end - at))
                size += int(sizes[end - 1]) - done
                at = end
                if size >= CHUNK:
                    yield chunk_of(held, number)
                    number, held, size = number + 1, [], 0
        if held:
            yield chunk_of(held, number)

    schema = StructType(
        [
            StructField("chunk", LongType()),
            StructField("rows", ArrayType(kept)),
            StructField("lengths", BinaryType()),
            StructField("n_bytes", LongType()),
            StructField("texts", BinaryType()),
        ]
    )
    return materialize(df.mapInArrow(run, schema), "chunks")


def _opened(lengths: bytes, texts: bytes, n: int) -> Chunk:
    sizes = np.frombuffer(lengths, np.int64)
    return Chunk(pa.decompress(texts, int(sizes.sum()) + len(sizes), "zstd", asbytes=True), sizes, n)


def remove_repeated(
    df: DataFrame, words: int = 35, key: str = "doc_id", text: str = "text", carry: Iterable[str] = ()
) -> DataFrame:
    """One row per row of ``df``: its key, the columns to ``carry``, ``n_words``, ``n_removed`` and ``kept_text``.

    A word goes if it lies in a window of ``words`` consecutive words of one text that also begins
    anywhere else, in the same text or another one; windows are those of the input. ``kept_text``
    joins the other words by one space. Words are what white space separates (ASCII), unchanged.

    Anchors shorter than a window are hashed only at places whose number, modulo a period, is in a
    difference cover. Two equal windows, wherever they begin, share an anchor at the same distance
    from their starts, since every difference of starts occurs between two members of the cover. So
    only windows around an anchor that occurs twice are extended to their whole length and hashed.

    Texts are written once, in compressed chunks of about 2 MB. A chunk posts each distinct hash
    once, in buckets of bounded size, whatever the number of its copies there; the answer is one
    byte for each hash, so a passage that a third of all texts share puts no load on one task, and
    no pairs are made. Windows count as equal if 64 bits of one hash and the bucket by another agree.

    Null, empty and blank texts have no words and an empty ``kept_text``; texts of fewer words than
    a window keep all. Repeated rows are copies of each other. A very long text is a chunk of its
    own, hashed in pieces. An empty table gives no rows. Columns of ``df`` may have any names; a
    carried one with the name of a result is left out.
    """
    spark = df.sparkSession
    names = [c for c in (key, *carry) if c.lower() not in ("n_words", "n_removed", "kept_text")]
    # the columns to keep in one struct, so that none can clash with those needed here
    rows = df.select(F.struct(*[quoted(c) for c in names]).alias("_row"), F.col(quoted(text)).alias("_text"))
    kept = rows.schema["_row"].dataType
    chunks = _chunks(rows, kept)
    n_bytes = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    # at most one hash of 8 bytes a word, of some 6 bytes of text
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_bytes * 8 // 6 // BUCKET)

    def post_anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, lengths, texts in zip(*[c.to_pylist() for c in batch.columns]):
                _, hashes = _opened(lengths, texts, words).anchors()
                found, hashes, _, _ = _distinct(_bucket(hashes, n_buckets), hashes)
                yield pa.RecordBatch.from_pydict(_posts(number, found, hashes))

    def candidates(chunk: Chunk, answers: pa.Table):
        """Starts of the windows around repeated anchors, and these windows as ``_distinct`` has them."""
        at, hashes = chunk.anchors()
        _, _, counts, place = _distinct(_bucket(hashes, n_buckets), hashes)
        starts, one, other = chunk.windows(at[_flags(answers, 1, counts)[place]])
        return starts, _distinct(_bucket(other, n_buckets), one)

    def post_windows(texts: pa.Table, answers: pa.Table) -> pa.Table:
        number, lengths, packed = (texts.column(c)[0].as_py() for c in ("chunk", "lengths", "texts"))
        _, (found, hashes, _, _) = candidates(_opened(lengths, packed, words), answers)
        return pa.table(_posts(number, found, hashes))

    def cut(texts: pa.Table, answers: pa.Table) -> pa.Table:
        lengths, packed = (texts.column(c)[0].as_py() for c in ("lengths", "texts"))
        chunk = _opened(lengths, packed, words)
        starts, (_, _, counts, place) = candidates(chunk, answers)
        gone = chunk.covered(starts[_flags(answers, 2, counts)[place]])
        n_words = np.diff(chunk.first)
        before = np.append(0, np.cumsum(gone))
        removed = before[chunk.first[1:]] - before[chunk.first[:-1]]
        out = []
        for i, end in enumerate(chunk.ends.tolist()):
            own = chunk.blob[int(chunk.ends[i - 1]) if i else 0 : end].split()
            if removed[i]:
                own = compress(own, (~gone[chunk.first[i] : chunk.first[i + 1]]).tolist())
            out.append(b" ".join(own))
        return pa.table(
            {
                "_row": texts.column("rows").combine_chunks().flatten(),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_text": pa.array(out, pa.binary()).cast(pa.string()),
            }
        )

    packed = chunks.select("chunk", "lengths", "texts")
    met = packed.mapInArrow(post_anchors, POSTS).groupBy("bucket").applyInArrow(_meet, SHARED)
    anchors = materialize(met.withColumn("kind", F.lit(1)), "anchors")
    posted = packed.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(post_windows, POSTS)
    windows = posted.groupBy("bucket").applyInArrow(_meet, SHARED).withColumn("kind", F.lit(2))
    schema = StructType(
        [
            StructField("_row", kept),
            StructField("n_words", LongType()),
            StructField("n_removed", LongType()),
            StructField("kept_text", StringType()),
        ]
    )
    answers = anchors.union(windows)
    done = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(cut, schema)
    return done.select("_row.*", "n_words", "n_removed", "kept_text")

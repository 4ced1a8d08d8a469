"""Best-fit packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

from collections.abc import Iterable
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.word_pieces import word_pieces
from reviewloom.session import materialize

PIECE = "doc_id {key}, piece int, start long, length long, ids_crc32 long, _bin long, offset long, _left boolean, _fill long"


class OpenBins:
    """At most ``most`` open bins, found by their free space in a bitset.

    Bit f is set while some open bin has f tokens free, so the best fit for n tokens is the first
    set bit from n on. When no bin fits, a new one is opened; if that is one too many, the fullest
    closes first, which is the first set bit of all.
    """

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.open, self.by_free = 0, 0, {}
        self.closed: list[tuple[list, int, bool]] = []

    def _take(self, free: int) -> list:
        bins = self.by_free[free]
        items = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return items

    def add(self, item, n: int) -> None:
        """Puts an item of n tokens, 1 to the capacity, at the end of a bin."""
        fits = self.bits >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            items = self._take(free)
        else:
            free, items = self.capacity, []
            if self.open == self.most:
                fullest = (self.bits & -self.bits).bit_length() - 1
                self.closed.append((self._take(fullest), self.capacity - fullest, False))
        items.append((item, self.capacity - free))
        free -= n
        if not free:
            self.closed.append((items, self.capacity, False))
            return
        self.by_free.setdefault(free, []).append(items)
        self.bits |= 1 << free
        self.open += 1

    def take_closed(self) -> list[tuple[list, int, bool]]:
        """(items with their offsets, tokens, whether the bin was still open) of bins closed so far."""
        out, self.closed = self.closed, []
        return out

    def finish(self) -> list[tuple[list, int, bool]]:
        for free in sorted(self.by_free):
            self.closed += [(items, self.capacity - free, True) for items in self.by_free[free]]
        self.bits, self.open, self.by_free = 0, 0, {}
        return self.take_closed()


def pack_documents(
    df: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int = 4096,
    open_bins: int = 512,
    key: str = "doc_id",
    text: str = "text",
    parts_together: int = 64,
) -> DataFrame:
    """One row per piece of a document: its place in a sequence of at most ``capacity`` tokens.

    Each task packs its own documents in their order with a fixed number of open bins. The bins
    still open at its end, at most ``open_bins``, are packed once more, fullest first, as whole
    items with those of up to ``parts_together`` tasks. A document's ids are followed by
    ``end_id``; only documents longer than the capacity are cut, into pieces of that length and a
    rest. The pieces, without ids, are written once, so the places cannot change between uses.

    Columns: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset``. A null text counts as empty: one piece with the end id. Rows with equal or null
    keys are packed like any other. No other column is read or returned; an empty table gives no
    rows.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]):
        encode = word_pieces(content.value).encode
        part, n_bins, bins = TaskContext.get().partitionId(), 0, OpenBins(capacity, open_bins)
        schema = None

        def rows_of(closed):
            nonlocal n_bins
            made = []
            for items, fill, left in closed:
                number = (part << 33) + n_bins
                n_bins += 1
                made += [(*item, number, offset, left, fill) for item, offset in items]
            columns = list(zip(*made)) if made else [[]] * 9
            types = [schema, pa.int32(), *[pa.int64()] * 5, pa.bool_(), pa.int64()]
            names = "doc_id piece start length ids_crc32 _bin offset _left _fill".split()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for b in batches:
            schema = b.column(0).type
            for doc, ids in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist())):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    bins.add((doc, piece, at // 4, len(cut) // 4, crc32(cut)), len(cut) // 4)
            yield rows_of(bins.take_closed())
        if schema is not None:
            yield rows_of(bins.finish())

    placed = materialize(rows.mapInArrow(run, PIECE.format(key=kind)), "pieces")

    def again(key: tuple, bins: pa.Table) -> pa.Table:
        bins = sorted(zip(bins["_fill"].to_pylist(), bins["_bin"].to_pylist()), reverse=True)
        packed = OpenBins(capacity, len(bins) + 1)
        for fill, number in bins:
            packed.add(number, fill)
        moves = [
            (number, items[0][0], offset)
            for items, _, _ in packed.finish()
            for number, offset in items
        ]
        return pa.table(dict(zip(("_bin", "sequence_id", "_shift"), zip(*moves))))

    left = placed.filter(F.col("_left") & (F.col("offset") == 0)).select("_bin", "_fill")
    group = F.shiftright("_bin", 33) / F.lit(parts_together)
    moves = left.groupBy(F.floor(group).alias("_group")).applyInArrow(
        again, "_bin long, sequence_id long, _shift long"
    )
    return placed.join(moves, "_bin", "left").select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce("sequence_id", "_bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("_shift", F.lit(0))).alias("offset"),
    )

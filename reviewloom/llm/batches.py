"""Arrow batches: columns added to a frame, rows kept in it, runs of equal keys; a worker's model and cache."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_slot: list = [None, None]


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; batches of texts on their way to Python hold 8 MB, unless the session sets another size.

    The usual 64 MB, times some copies on both sides and the tasks of an executor, are much beside
    a model and its caches.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_BYTES, None) is None:
        conf.set(BATCH_BYTES, str(8 << 20))
    return df


def loaded(key, make: Callable):
    """What ``make`` gives, kept for later tasks of this worker until another key is asked for.

    All operators share the one place, so a worker holds one model however many operators run.
    """
    if _slot[0] != key:
        _slot[:] = [None, None]  # the old one goes before the new one is made
        _slot[:] = [key, make()]
    return _slot[1]


def add_columns(
    df: DataFrame, inputs: list[str], fields: list[StructField], make: Callable[[], Callable]
) -> DataFrame:
    """``df`` with ``fields`` computed from the ``inputs`` columns, batch by batch.

    ``make`` runs once per task and returns a function from Arrow arrays to one list of arrays.
    Other columns pass through unread. A column of ``df`` whose name (in any case) is one of the
    new ones is replaced.
    """
    new = {f.name.lower() for f in fields}
    keep = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in new]
    at = [_index(df, c) for c in inputs]
    schema = StructType([df.schema.fields[i] for i in keep] + fields)
    names = schema.fieldNames()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for b in batches:
            made = compute(*[b.column(i) for i in at])
            yield pa.RecordBatch.from_arrays([b.column(i) for i in keep] + made, names)
            del b, made
            pa.default_memory_pool().release_unused()

    return small_batches(df).mapInArrow(run, schema)


def keep_rows(df: DataFrame, inputs: list[str], make: Callable[[], Callable]) -> DataFrame:
    """The rows of ``df`` for which the function that ``make`` returns gives true; all columns stay."""
    at = [_index(df, c) for c in inputs]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = make()
        for b in batches:
            yield b.filter(pa.array(test(*[b.column(i) for i in at]), pa.bool_()))
            del b
            pa.default_memory_pool().release_unused()

    return small_batches(df).mapInArrow(run, df.schema)


def _index(df: DataFrame, name: str) -> int:
    low = [c.lower() for c in df.columns]
    return low.index(name.lower())


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows, cut anew so that no run of equal ``key`` values is torn apart.

    At most one run is carried from batch to batch, so the caller bounds the length of a run.
    """
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cut = int((keys != keys[-1]).nonzero()[0][-1]) + 1 if (keys != keys[-1]).any() else 0
        if held and (cut or _last(held[-1], key) != keys[-1]):
            yield _whole([*held, b.slice(0, cut)])
            held = [b.slice(cut)]
        elif cut:
            yield b.slice(0, cut)
            held = [b.slice(cut)]
        else:
            held.append(b)
    if held:
        yield _whole(held)


def _last(b: pa.RecordBatch, key: str):
    return b.column(b.schema.get_field_index(key))[-1].as_py()


def _whole(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


class Cache(dict):
    """A dict that computes missing values and holds two generations of at most ``size`` entries.

    When the young generation is full it becomes the old one, so values in use stay and memory is
    bounded. Keys longer than ``longest`` are computed each time.
    """

    def __init__(self, compute: Callable, size: int = 250_000, longest: int = 48):
        super().__init__()
        self.compute, self.size, self.longest, self.old = compute, size, longest, {}

    def __missing__(self, key):
        value = self.old.get(key, self)
        if value is self:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value

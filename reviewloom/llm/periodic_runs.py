"""Maximal periodic runs of words, found with a dictionary of basic factors."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from reviewloom.llm.batches import add_columns

RUN = ("start", "length", "period")
TOGETHER = 1 << 16  # words of texts whose factors are named together


def _same_after(a: np.ndarray, i: int, j: int, end: int) -> int:
    """How many items from ``i`` on equal those from ``j`` on, before ``end``; looks ahead in growing steps."""
    n, step = 0, 32
    while j + n < end:
        size = min(step, end - j - n)
        other = np.flatnonzero(a[i + n : i + n + size] != a[j + n : j + n + size])
        if len(other):
            return n + int(other[0])
        n, step = n + size, step * 2
    return n


def _same_before(a: np.ndarray, i: int, j: int, start: int) -> int:
    """How many items right before ``i`` equal those right before ``j``, ``i`` being the smaller, from ``start`` on."""
    n, step = 0, 32
    while i - n > start:
        size = min(step, i - n - start)
        other = np.flatnonzero(a[i - n - size : i - n] != a[j - n - size : j - n])
        if len(other):
            return n + size - 1 - int(other[-1])
        n, step = n + size, step * 2
    return n


def proposals(words: np.ndarray, ends: np.ndarray, first: int, most: np.ndarray) -> Iterable[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places and periods that may hold a run, one pair of arrays for each length of factors.

    ``words`` are the numbers of the words of texts in a row, no number in two texts, and ``ends``
    for each word the end of its text. A factor of 2^k words gets its name from the names of its
    two halves; only names that occur twice are kept, since longer factors with another half occur
    once. Where the next occurrence of the same factor lies within twice its length, the step to it
    is proposed as a period; of a row of such places with one step, the first stands for all. Only
    factors of ``first`` words or more propose; ``most`` bounds the period at each word.
    """
    at, name, size = np.arange(len(words)), words, 1
    whole = np.empty(len(words) + 1, np.int64)  # the name of the factor that begins at a place, if it occurs twice
    while len(at):
        whole[:] = -1
        whole[at] = name
        at = at[at + 2 * size <= ends[at]]
        right = whole[at + size]
        at, right = at[right >= 0], right[right >= 0]
        key = whole[at] * (len(words) + 1) + right
        size *= 2
        order = np.argsort(key, kind="stable")  # places of one factor stay in order
        same = key[order[1:]] == key[order[:-1]]
        if size >= first:
            place = at[order[:-1][same]]
            step = at[order[1:][same]] - place
            # steps of at most half the length are proposed by shorter factors, if there are any
            fits = (step <= np.minimum(2 * size, most[place])) & ((step > size // 2) | (size == first))
            place, step = place[fits], step[fits]
            by_place = np.argsort(place)
            place, step = place[by_place], step[by_place]
            new = np.append(True, (np.diff(place) != 1) | (np.diff(step) != 0))[: len(place)]
            yield place[new], step[new]
        twice, named = np.zeros(len(key), bool), np.empty(len(key), np.int64)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        named[order] = np.cumsum(np.append(True, ~same))[: len(key)] - 1
        at, name = at[twice], named[twice]


def runs(texts: list[np.ndarray], least: int = 24, repeats: int = 3) -> list[list[tuple[int, int, int]]]:
    """Of each text, all runs (start, length, period) in order of start and period.

    ``texts`` are numbers of words, below the number of all words, no number in two texts.
    A run is a stretch in which words a period apart are equal, with no smaller period, of at least
    ``least`` words and ``repeats`` periods, that no neighbouring word extends.
    """
    if repeats < 3:
        raise ValueError("a run has at least three periods")
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(np.append(0, sizes))
    words = np.concatenate(texts) if texts else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    # a factor at least as long as the period, and one period more, must fit into every run
    first = 2
    while 3 * first <= least:
        first *= 2
    found: list[dict[tuple[int, int], int]] = [{} for _ in texts]
    for places, periods in proposals(words, starts[1:][owner], first, (sizes // repeats)[owner]):
        until: dict[tuple[int, int], int] = {}  # how far a period holds in a text, places being in order
        for i, p in zip(places.tolist(), periods.tolist()):
            text = int(owner[i])
            if i < until.get((text, p), 0):
                continue
            a, z = int(starts[text]), int(starts[text + 1])
            start = i - _same_before(words, i, i + p, a)
            length = i + p + _same_after(words, i, i + p, z) - start
            until[text, p] = start + length - p
            if length >= max(least, repeats * p):
                key = (start - a, length)
                found[text][key] = min(p, found[text].get(key, p))
    return [sorted((s, n, p) for (s, n), p in f.items()) for f in found]


def _numbers(texts: list[list[bytes]]) -> list[np.ndarray]:
    """A number for each word of each text; equal words of one text, and no others, have the same."""
    out, numbers = [], count()
    for words in texts:
        of = defaultdict(numbers.__next__)
        out.append(np.fromiter(map(of.__getitem__, words), np.int64, len(words)))
    return out


def _dropped(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words follow the first period of some run that they lie in."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge)[:-1] > 0


def find_runs(
    df: DataFrame,
    text: str = "text",
    runs_column: str = "runs",
    collapsed: str = "collapsed",
    least: int = 24,
    repeats: int = 3,
) -> DataFrame:
    """``df`` with the periodic runs of each whole text, and the text with each run cut to one period.

    Words are what white space separates (ASCII), unchanged. ``runs`` is an array of (start, length,
    period), numbered in words from 0, in order of start and period: every stretch of at least
    ``least`` words and ``repeats`` (at least three) periods in which words a (smallest) period apart are equal and
    that no neighbour extends. ``collapsed`` joins by one space the words that no run drops; a run
    drops its words after the first period.

    Factors of 2, 4, 8 and so on words are named by pairs of shorter names, and only those that
    occur twice in a text are followed further, so a text without repetition costs three sorts. Each
    factor whose next occurrence lies within twice its length proposes a period, which is extended
    word by word to both sides; equal stretches are one run, with the smallest of their periods.

    Texts are not shuffled. Null, empty and blank texts have no runs and an empty ``collapsed``; a
    very long text takes memory in proportion to its words. Repeated rows give equal results; an
    empty table gives no rows. Columns of ``df`` with the names of the new ones are replaced.
    """

    def make():
        def compute(texts: pa.Array) -> list[pa.Array]:
            split = [(t or b"").split() for t in texts.cast(pa.binary()).to_pylist()]
            found: list[list[tuple[int, int, int]]] = []
            group, size = [], 0
            for i, words in enumerate(split):
                group.append(words)
                size += len(words)
                if size >= TOGETHER or i == len(split) - 1:
                    found += runs(_numbers(group), least, repeats)
                    group, size = [], 0
            kept = [
                b" ".join(compress(words, (~_dropped(len(words), own)).tolist()) if own else words)
                for words, own in zip(split, found)
            ]
            rows = [[dict(zip(RUN, r)) for r in own] for own in found]
            return [
                pa.array(rows, pa.list_(pa.struct([(c, pa.int64()) for c in RUN]))),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ]

        return compute

    run = StructType([StructField(c, LongType()) for c in RUN])
    fields = [StructField(runs_column, ArrayType(run)), StructField(collapsed, StringType())]
    return add_columns(df, [text], fields, make)

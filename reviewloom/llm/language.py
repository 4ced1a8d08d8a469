"""Language identification: known words first, shorter and shorter character n-grams for the rest."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from reviewloom.llm.batches import add_columns, keep_rows, loaded, small_batches
from reviewloom.session import materialize

WORDS = re.compile(r"[^\W\d_]+").findall
LONGEST = 4  # characters of an n-gram
TOGETHER = 50_000  # words of a text scored at once
UNSEEN, KEPT = 200_000, 48  # unseen words whose scores a worker keeps, and their most characters
PIECE = 1 << 16  # places of a word looked at before sums are carried on
COUNTED = 1 << 20  # counts that a learning task holds before it passes them on


def _pieces(word: str) -> Iterable[tuple[str, int]]:
    """The whole padded word in pieces of at most ``PIECE`` places, each with the characters its last n-grams need."""
    padded = f" {word} "
    for at in range(0, len(padded), PIECE):
        yield padded[at : at + PIECE + LONGEST - 1], min(PIECE, len(padded) - at)


def _counts(seen: Counter) -> pa.RecordBatch:
    one, order, item = zip(*seen) if seen else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(one, pa.string()),
            pa.array(order, pa.int32()),
            pa.array(item, pa.string()),
            pa.array(seen.values(), pa.int64()),
        ],
        ["lang", "n_chars", "item", "n"],
    )


def fit(
    df: DataFrame,
    learn: Column,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    rows: int = 2000,
    size: int = 30_000,
) -> dict:
    """A model of word and n-gram log frequencies per language.

    Learns from a sample of about ``rows`` texts a language (all, if there are fewer), chosen by a
    hash of the key, of the rows for which ``learn`` is true and whose language is known. Keeps the
    most frequent words, at most ``size``, and as many n-grams of each length (of items that occur
    equally often all or none), so the model grows with the languages alone, not with the corpus.
    Words without a letter are not learned. Repeated rows count as often as they occur; a very long
    text counts whole; an empty table, or one without known languages, gives a model of nothing.
    """
    known = df.filter(learn & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).alias("key")
    )
    numbers = known.groupBy("lang").count().collect()  # one row a language
    langs = sorted(r["lang"] for r in numbers)
    if not langs:
        return {"name": "", "langs": [], "items": {k: {} for k in range(LONGEST + 1)}, "logs": np.zeros((1, 0), np.float32)}
    # the share of each language's rows that gives about the number wanted
    share = F.create_map(*[F.lit(x) for r in numbers for x in (r["lang"], min(1.0, rows / r["count"]))])
    # a double made of the hash, so that equal keys fall on the same side everywhere
    chance = F.pmod(F.xxhash64(F.lit(8), "key"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.filter(F.col("lang").isin(langs) & (chance < F.try_element_at(share, F.col("lang"))))

    def run(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            seen = Counter()
            for one, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for word, n in Counter(WORDS((t or "").lower())).items():
                    if any(map(str.isalpha, word)):  # else a number that is no decimal one
                        seen[one, 0, word] += n
            for (one, _, word), n in list(seen.items()):
                for piece, places in _pieces(word):
                    for order in range(1, LONGEST + 1):
                        for i in range(min(places, len(piece) - order + 1)):
                            seen[one, order, piece[i : i + order]] += n
                    if len(seen) > COUNTED:
                        yield _counts(seen)
                        seen.clear()
            yield _counts(seen)

    counts = (
        small_batches(sample.select("lang", "text"))
        .mapInArrow(run, "lang string, n_chars int, item string, n long")
        .groupBy("n_chars", "item")
        .agg(
            *[F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{i}") for i, x in enumerate(langs)],
            F.sum("n").alias("total"),
        )
    )
    counts = materialize(counts, "items")
    # how many items occur how often: some thousands of rows, by which the least number to keep is found
    often: dict[int, int] = {}
    kept_items = Counter()
    for r in sorted(counts.groupBy("n_chars", "total").count().collect(), key=lambda r: -r["total"]):
        order = r["n_chars"]
        kept_items[order] += r["count"]
        if kept_items[order] <= size:
            often[order] = r["total"]
    least = F.create_map(*[F.lit(x) for item in often.items() for x in item]) if often else F.lit(None)
    kept = counts.filter(F.col("total") >= F.try_element_at(least, F.col("n_chars")) if often else F.lit(False)).toArrow()
    n = np.stack([kept.column(f"n{i}").to_numpy() for i in range(len(langs))], 1).astype(float)
    orders, items = kept.column("n_chars").to_numpy(), kept.column("item").to_pylist()
    logs = np.zeros((len(items) + 1, len(langs)), np.float32)  # row 0: no letters, says nothing
    for order in range(LONGEST + 1):
        at = orders == order
        logs[1:][at] = np.log((n[at] + 0.5) / (n[at].sum(0) + 0.5 * at.sum() + 0.5))
    tables: dict = {order: {} for order in range(LONGEST + 1)}
    for i, (order, item) in enumerate(zip(orders.tolist(), items)):
        tables[order][item] = i + 1
    return {"name": uuid.uuid4().hex, "langs": langs, "items": tables, "logs": logs}


class Scorer:
    """Sums of log frequencies, with the scores of unseen words kept in a bounded table."""

    def __init__(self, model: dict):
        self.langs, self.items = model["langs"], model["items"]
        self.known = len(model["logs"])
        room = self.known + UNSEEN + TOGETHER
        self.logs = np.zeros((room, len(self.langs)), np.float32)
        self.logs[: self.known] = model["logs"]
        self.grams = {
            gram: tuple(self.logs[row].tolist())
            for order in range(1, LONGEST + 1)
            for gram, row in self.items[order].items()
        }
        self.rows = _Rows(self._unseen)
        self._reset()

    def _reset(self) -> None:
        self.rows.clear()
        self.rows.update(self.items.get(0, {}))
        self.next = self.known

    def _unseen(self, word: str) -> int:
        """The row of a word outside the table: the mean over its places of the longest known n-gram."""
        if not any(c.isalpha() for c in word):
            return 0
        get, sums, n = self.grams.get, [], 0
        for piece, places in _pieces(word):
            found = []
            for i in range(places):
                for end in range(min(i + LONGEST, len(piece)), i, -1):
                    logs = get(piece[i:end])
                    if logs is not None:
                        found.append(logs)
                        break
            if found:
                n += len(found)
                sums = [sum(x) for x in zip(*found, *([sums] if sums else []))]
        row, self.next = self.next, self.next + 1
        self.logs[row] = [x / n for x in sums] or 0
        return row

    def score(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its probability; ties go to the first in the alphabet."""
        words = WORDS(text.lower()) if text else []
        sums, letters = np.zeros(len(self.langs)), False
        for at in range(0, len(words), TOGETHER):
            if self.next > self.known + UNSEEN:
                self._reset()
            rows = list(map(self.rows.__getitem__, words[at : at + TOGETHER]))
            letters = letters or max(rows) > 0
            sums += self.logs[rows].sum(0, dtype=np.float64)
        if not letters or not self.langs:
            return "und", 0.0
        chances = np.exp(sums - sums.max())
        best = int(sums.argmax())
        return self.langs[best], float(chances[best] / chances.sum())


class _Rows(dict):
    def __init__(self, unseen):
        super().__init__()
        self.unseen = unseen

    def __missing__(self, word: str) -> int:
        row = self.unseen(word)
        if len(word) <= KEPT:
            self[word] = row
        return row


def _scorer(sent) -> Scorer:
    model = sent.value  # one scorer per worker, so that its scores serve many tasks
    return loaded(("languages", model["name"]), lambda: Scorer(model))


def identify(df: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, the probability of that language among those learned.

    Known words count with their log frequency in each language; an unseen word counts with the
    mean over its characters of the longest known n-gram from there on. A text that is null or has
    no letter, and any text if nothing was learned, is ``und`` with score 0. The model is of bounded
    size and broadcast; texts are read whole and never shuffled. Columns with the new names are
    replaced.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = _scorer(sent)

        def compute(texts: pa.Array) -> list[pa.Array]:
            scores = [scorer.score(t) for t in texts.to_pylist()]
            return [pa.array([x for x, _ in scores], pa.string()), pa.array([x for _, x in scores], pa.float64())]

        return compute

    return add_columns(df, [text], [StructField("lang_pred", StringType()), StructField("score", DoubleType())], make)


def keep_identified(df: DataFrame, model: dict, text: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of ``df`` whose language is identified with a score of at least ``least``."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = _scorer(sent)

        def test(texts: pa.Array) -> list[bool]:
            scores = [scorer.score(t) for t in texts.to_pylist()]
            return [x != "und" and p >= least for x, p in scores]

        return test

    return keep_rows(df, [text], make)

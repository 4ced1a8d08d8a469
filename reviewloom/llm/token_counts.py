"""Token counts of whole texts, by a broadcast table of frequent pre-tokens and worker caches."""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterable
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField
from public_tokenizers import PATTERN

from reviewloom.llm.batches import Cache, add_columns, loaded


class Counts:
    """Numbers of tokens by the tokenizers library, with pre-tokens looked up before they are encoded.

    Tier one is the broadcast table of frequent pre-tokens; tier two is this worker's cache of
    encoded ones. A text that holds an added token's string goes to the library as a whole.
    """

    def __init__(self, content: str, frequent: dict[str, int]):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.find = regex.compile(PATTERN).findall
        self.frequent = frequent
        self.pieces = Cache(self.encode, 150_000)
        self.chunks = Cache(self._chunk, 250_000)

    def encode(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def piece(self, piece: str) -> int:
        n = self.frequent.get(piece)
        return self.pieces[piece] if n is None else n

    def _chunk(self, chunk: str) -> int | None:
        if not chunk or chunk[0].isspace():
            return None  # a space before white space may belong to a longer pre-token
        return sum(map(self.piece, self.find(" " + chunk)))

    def count(self, text: str) -> int:
        if any(a in text for a in self.added):
            return self.encode(text)
        first, *rest = text.split(" ")
        try:
            return sum(map(self.piece, self.find(first))) + sum(map(self.chunks.__getitem__, rest))
        except TypeError:  # white space in a row: split the text as a whole
            return sum(map(self.piece, self.find(text)))


def frequent_pretokens(
    df: DataFrame, content: str, text: str = "text", rows: int = 4000, size: int = 32_768
) -> dict[str, int]:
    """Token numbers of the most frequent pre-tokens in a sample of about ``rows`` texts.

    The table has at most ``size`` entries of at most 48 characters, so it may be broadcast. It
    only saves time: a pre-token outside it is encoded, so no count depends on the sample.
    """
    total = df.count()
    sample = df.sample(min(1.0, rows / total), seed=7) if total else df

    def run(batches: Iterable[pa.RecordBatch]):
        find, seen = regex.compile(PATTERN).findall, Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(x for x in find(t or "") if len(x) <= 48)
        top = seen.most_common(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            ["piece", "n"],
        )

    top = (
        sample.select(text)
        .mapInArrow(run, "piece string, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece")
        .limit(size)
    )
    counts = Counts(content, {})
    return {r.piece: counts.encode(r.piece) for r in top.select("piece").collect()}


def count_tokens(
    df: DataFrame, tokenizer_path: str, text: str = "text", out: str = "n_tokens", size: int = 32_768
) -> DataFrame:
    """``df`` with the number of tokens of each whole text, as the library counts it.

    For byte-level tokenizers that split text by the public pattern; no begin, end or other tokens
    are added, and special strings in a text are what the library takes them for. A null text
    counts as empty: 0. The tokenizer file and the table are broadcast; there is no shuffle of
    texts or pre-tokens. A column ``out`` of ``df`` is replaced; all rows stay.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    frequent = frequent_pretokens(df, content, text, size=size)
    sent = df.sparkSession.sparkContext.broadcast((content, frequent))
    # counts depend on the tokenizer alone, so a worker may keep another table for it
    key = sha256(content.encode()).hexdigest()

    def make():
        count = loaded(("token counts", key), lambda: Counts(*sent.value)).count
        return lambda texts: [
            pa.array([count(t) if t else 0 for t in texts.to_pylist()], pa.int64())
        ]

    return add_columns(df, [text], [StructField(out, LongType())], make)

"""Byte-level BPE over a rank file: encoding by a rank queue, and decoding."""

from __future__ import annotations

import base64
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField
from public_tokenizers import PATTERN

from reviewloom.llm.batches import add_columns, loaded

TOGETHER = 1 << 20  # characters of text whose new pre-tokens are merged together
QUEUED = 1 << 13  # bytes of pre-tokens in one queue, or one longer pre-token
DECODED = 1 << 22  # ids decoded at once, or one longer text
ROOM = 110 << 20  # bytes of cached pre-tokens in each of two generations, about


class BytePairs:
    """Encoder and decoder for one vocabulary of ``bytes -> rank``.

    Pre-tokens are merged with a rank queue, many in a row at once. The pairs of neighbours wait in
    one bucket per merge rank, as positions in a linked list; a two-level bitmap tells which buckets
    hold something, so the next rank is two find-first-set steps away. An entry whose pair has
    changed since is stale and skipped. Pre-tokens of n bytes take O(n log n) steps whatever their
    length. Ids of pre-tokens, and of what stands between two spaces, stay in caches of two
    generations of bounded size: a full one becomes the old one, from which what is used moves on.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        last = max(ranks.values(), default=-1)
        self.low = [0] * ((last >> 8) + 1)
        words = [b""] * (last + 1)
        for word, rank in ranks.items():
            words[rank] = word
        self.words = pa.array(words, pa.large_binary())
        self.of_byte = [ranks.get(bytes([a]), -1) for a in range(256)]
        self.of_two = [ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes | None] = {}
        self.old_pieces, self.old_chunks, self.held = {}, {}, 0
        # this pattern starts a piece at each space that a non-space follows
        self.spaced = pattern == PATTERN

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of some pre-tokens, none of them empty, as little-endian unsigned 32-bit integers.

        Ranks of different pre-tokens do not touch, so the lowest rank of all is the lowest of each
        that has it. Positions of one rank are taken from left to right, unless a lower rank comes up.
        """
        raw, n = b"".join(words), sum(map(len, words))
        ends = np.cumsum([len(w) for w in words])
        opens = [False] * (n + 1)  # where a pre-token begins, or all end
        waits = [self.of_two[a << 8 | b] for a, b in zip(raw, raw[1:])] + [-1]  # rank of the pair that starts here
        ids = [self.of_byte[b] for b in raw]  # -1: joined to what stands before
        after, before = list(range(1, n + 1)), list(range(-1, n))
        for end in ends.tolist():
            opens[end], waits[end - 1], before[end] = True, -1, -1
        get, low = self.ranks.get, self.low
        buckets: dict[int, list[int]] = {}
        for i, rank in enumerate(waits):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
        top = 0
        for rank in buckets:
            low[rank >> 8] |= 1 << (rank & 255)
            top |= 1 << (rank >> 8)
        while top:
            high = (top & -top).bit_length() - 1
            bits = low[high]
            rank = (high << 8) + (bits & -bits).bit_length() - 1
            low[high] = bits & (bits - 1)
            if not low[high]:
                top &= top - 1
            bucket = buckets.pop(rank)
            bucket.sort()
            for done, i in enumerate(bucket, 1):
                if waits[i] != rank:
                    continue  # stale
                j = after[i]
                k = after[i] = after[j]
                p = before[i]
                ids[i], ids[j], waits[j] = rank, -1, -1
                lowest = rank
                if opens[k]:
                    waits[i] = -1
                else:
                    before[k] = i
                    new = waits[i] = get(raw[i : after[k]], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            buckets[new] = [i]
                            low[new >> 8] |= 1 << (new & 255)
                            top |= 1 << (new >> 8)
                            lowest = min(lowest, new)
                if p >= 0:
                    new = waits[p] = get(raw[p:k], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(p)
                        else:
                            buckets[new] = [p]
                            low[new >> 8] |= 1 << (new & 255)
                            top |= 1 << (new >> 8)
                            lowest = min(lowest, new)
                if lowest < rank:
                    if done < len(bucket):  # the rest waits
                        buckets[rank] = bucket[done:]
                        low[rank >> 8] |= 1 << (rank & 255)
                        top |= 1 << (rank >> 8)
                    break
        made = np.array(ids, np.int64)
        packed = made[made >= 0].astype("<u4").tobytes()
        cuts = (np.cumsum(made >= 0)[ends - 1] * 4).tolist()
        return [packed[a:z] for a, z in zip([0, *cuts], cuts)]

    def _learn(self, pieces: Iterable[str]) -> None:
        """Adds the ids of pre-tokens to the cache."""
        keys, raws, size = [], [], 0

        def add() -> None:
            made = self.merge(raws)
            self.held += sum(map(len, made)) + 2 * size + 200 * len(keys)
            self.pieces.update(zip(keys, made))

        for piece in set(pieces) - self.pieces.keys():
            made = self.old_pieces.get(piece)
            raw = piece.encode()
            if made is None and raw in self.ranks:
                made = self.ranks[raw].to_bytes(4, "little")
            if made is not None:
                self.pieces[piece] = made
                self.held += 200 + len(made)
                continue
            if size and size + len(raw) > QUEUED:
                add()
                keys, raws, size = [], [], 0
            keys.append(piece)
            raws.append(raw)
            size += len(raw)
        if keys:
            add()

    def _whole(self, text: str) -> bytes:
        pieces = self.find(text)
        self._learn(pieces)
        return b"".join(map(self.pieces.__getitem__, pieces))

    def _group(self, texts: list[str]) -> list[bytes]:
        if self.held > ROOM:
            self.old_pieces, self.old_chunks = self.pieces, self.chunks
            self.pieces, self.chunks, self.held = {}, {}, 0
        if not self.spaced:
            return list(map(self._whole, texts))
        split = [t.split(" ") for t in texts]
        new: dict[str, list[str] | None] = {}
        for chunk in set().union(*[s[1:] for s in split]) - self.chunks.keys():
            if self.old_chunks.get(chunk) is not None:
                self.chunks[chunk] = self.old_chunks[chunk]
                self.held += 200 + 6 * len(chunk)
            else:  # a space before white space, or at the end, may belong to a longer piece: no chunk
                new[chunk] = self.find(" " + chunk) if chunk and not chunk[0].isspace() else None
        starts = [self.find(s[0]) for s in split]
        self._learn(p for found in (*new.values(), *starts) for p in found or ())
        get = self.pieces.__getitem__
        for chunk, found in new.items():
            self.chunks[chunk] = None if found is None else b"".join(map(get, found))
            self.held += 200 + 6 * len(chunk)
        out = []
        for text, first, (_, *rest) in zip(texts, starts, split):
            try:
                out.append(b"".join([*map(get, first), *map(self.chunks.__getitem__, rest)]))
            except TypeError:  # white space in a row: split the text as a whole
                out.append(self._whole(text))
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return self.decode_all([ids])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian unsigned 32-bit integers."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > TOGETHER:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)

    def decode_all(self, texts: list[bytes]) -> list[bytes]:
        """The bytes that the ids of each text stand for."""
        out, group, size = [], [], 0
        for packed in texts:
            group.append(packed)
            size += len(packed) // 4
            if size > DECODED:
                out += self._decode(group)
                group, size = [], 0
        return out + self._decode(group)

    def _decode(self, texts: list[bytes]) -> list[bytes]:
        ids = np.frombuffer(b"".join(texts), "<u4")
        found = self.words.take(pa.array(ids))  # its data are the words in a row
        if not len(ids):
            return [b""] * len(texts)
        _, offsets, data = found.buffers()
        ends = np.cumsum([0] + [len(t) // 4 for t in texts])
        cuts = np.frombuffer(offsets, np.int64)[ends].tolist()
        raw = data.to_pybytes()
        return [raw[a:z] for a, z in zip(cuts, cuts[1:])]


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks from a file of lines ``base64 rank``."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}


def _codec(content: bytes, pattern: str) -> BytePairs:
    # one per worker, so that its caches serve many tasks
    return loaded(("byte pairs", hash(content), pattern), lambda: BytePairs(read_ranks(content), pattern))


def encode_documents(
    df: DataFrame,
    ranks_path: str,
    pattern: str = PATTERN,
    text: str = "text",
    ids: str = "token_ids",
    decoded: str | None = None,
) -> DataFrame:
    """``df`` with the tokens of ``text`` as packed little-endian unsigned 32-bit ids.

    The rank file (some megabytes) is read once by the driver and broadcast. Each text is encoded
    whole, without a shuffle; a null text counts as empty and gives no ids. No special tokens are
    recognised. ``decoded`` names a column for the bytes that the ids decode to. A very long text
    is encoded whole, in memory proportional to it. Columns of ``df`` with the names of the new ones
    are replaced; all rows stay, repeated ones too; an empty table gives no rows.
    """
    with open(ranks_path, "rb") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())

    def make():
        codec = _codec(content.value, pattern)

        def compute(texts: pa.Array) -> list[pa.Array]:
            packed = codec.encode_all([t or "" for t in texts.to_pylist()])
            made = [pa.array(packed, pa.binary())]
            if decoded:
                made.append(pa.array(codec.decode_all(packed), pa.binary()))
            return made

        return compute

    fields = [StructField(c, BinaryType()) for c in [ids, decoded] if c]
    return add_columns(df, [text], fields, make)


def decode_documents(
    df: DataFrame,
    ranks_path: str,
    pattern: str = PATTERN,
    ids: str = "token_ids",
    decoded: str = "decoded",
) -> DataFrame:
    """``df`` with the bytes that packed ``ids`` stand for; null ids give null."""
    with open(ranks_path, "rb") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())

    def make():
        codec = _codec(content.value, pattern)

        def compute(packed: pa.Array) -> list[pa.Array]:
            words = codec.decode_all([x or b"" for x in packed.to_pylist()])
            return [pa.array(words, pa.binary(), mask=packed.is_null().to_numpy(zero_copy_only=False))]

        return compute

    return add_columns(df, [ids], [StructField(decoded, BinaryType())], make)

"""Ids of a lower-casing word tokenizer: words looked up in caches, anything unusual by the library."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterable

import numpy as np

from reviewloom.llm.batches import loaded


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x300) if unicodedata.category(chr(c))[0] == kind)


#: Characters that normalisation may change by more than their case, one to one.
UNUSUAL = re.compile("[^\x00-\u012f\u0131-\u02ff]")
#: Control characters that split() takes for white space and the tokenizer does not.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


#: Bytes of each of two generations of the cache, about, and characters of text split at once.
ROOM, TOGETHER = 88 << 20, 3_000_000
#: Bytes of a word from which on a wider matrix is used.
WIDTHS = [*range(2, 16), 18, 22, 28, 40, 80]
#: Characters of a word that is merged here; the library's queue is better for longer ones.
LONGEST = 256


def _shown_bytes() -> dict[str, int]:
    """The printable character that stands for each byte: itself, or one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class WordPieces:
    """Ids as the tokenizers library gives them with ``add_special_tokens=False``.

    The tokenizer drops white space and never looks across it, so a text is split there and each
    part's ids come from a cache; the parts that are new in some megabytes of text are merged
    together. A text with an unusual character, or with what may be an added token, goes to the
    library as a whole.
    """

    def __init__(self, content: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        model = json.loads(content)["model"]
        self.pairs = PairTable(model)
        # the tokenizer's own pattern, with its classes spelled out for plain characters
        letters, numbers = _class("L"), _class("N")
        self.find = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\\s{letters}{numbers}]+"
        ).findall
        self.ids: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _new(self, parts: set[str]) -> set[str]:
        """The parts in neither generation of the cache; those in the old one move to the young one."""
        parts = parts.difference(self.ids)
        known = [p for p in parts if p in self.old]
        self._keep(known, map(self.old.__getitem__, known))
        return parts.difference(known)

    def _keep(self, parts: list[str], ids: Iterable[bytes]) -> None:
        before = len(self.ids)
        self.ids.update(zip(parts, ids))
        # a word of n characters has n ids at most; a string, its ids and their entry take some 180 bytes besides
        self.held += 180 * (len(self.ids) - before) + 3 * sum(map(len, parts))

    def _learn(self, parts: set[str]) -> None:
        """Adds the ids of new parts, and of the words in them, to the cache, whose full generation becomes the old one."""
        if self.held > ROOM:
            self.ids, self.old, self.held = {}, self.ids, 0
        parts = self._new(parts)
        mixed = {p: self.find(p) for p in parts if not p.isalpha()}
        words = parts.difference(mixed)
        words |= self._new(set().union(*mixed.values()).difference(words))
        long = [w for w in words if len(w) > LONGEST]
        self._keep(long, map(self._library, long))
        words = list(words.difference(long))
        self._keep(words, self.pairs.merge([w.encode() for w in words]))
        get = self.ids.__getitem__
        self._keep(list(mixed), [b"".join(map(get, ws)) for ws in mixed.values()])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a null text counts as empty."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size > TOGETHER:
                out += self._encode(group)
                group, size = [], 0
        return out + self._encode(group)

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [t.lower().split() if self._plain(t) else None for t in texts]
        self._learn(set().union(*[s for s in split if s]))
        get, out = self.ids.__getitem__, []
        for text, parts in zip(texts, split):
            if parts is None:
                out.append(self._library(text))
            else:
                out.append(b"".join(map(get, parts)))
        return out

    def _library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    @staticmethod
    def _plain(text: str) -> bool:
        if "<|" in text or any(s in text for s in SEPARATORS):
            return False
        return text.isascii() or not UNUSUAL.search(text)


class PairTable:
    """Merges of pairs of symbols, done for many words at once: one merge a word and round."""

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        shown = {b: c for c, b in _shown_bytes().items()}
        self.inner = np.array([vocab[shown[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[shown[b] + suffix] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.keys, self.ranks = np.unique(keys, return_index=True)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.none = len(pairs)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word: always the pair of the lowest rank, the leftmost of equal ones."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        # words of about one length share a matrix, filled up with -1, which pairs with nothing
        for at in np.split(order, np.searchsorted(lengths[order], WIDTHS)):
            if not len(at):
                continue
            n = int(lengths[at[-1]])
            at, size = at.tolist(), lengths[at][:, None]
            raw = np.zeros((len(at), n), np.uint8)
            raw[np.arange(n) < size] = np.frombuffer(b"".join([words[i] for i in at]), np.uint8)
            ids = np.full((len(at), n + 1), -1, np.int64)
            ids[:, :n] = np.where(np.arange(n) < size - 1, self.inner[raw], -1)
            np.put_along_axis(ids, size - 1, self.final[np.take_along_axis(raw, size - 1, 1)], 1)
            ranks = self.rank(ids[:, :-1], ids[:, 1:])
            rows, cols = np.arange(len(at)), np.arange(n + 1)
            while len(rows):
                first = ranks.argmin(1)
                lowest = ranks[np.arange(len(rows)), first]
                done = lowest == self.none
                if done.any():
                    kept = ids[done].astype("<u4").tobytes()
                    step = 4 * (n + 1)
                    ends = np.arange(0, len(kept), step) + 4 * (ids[done] >= 0).sum(1)
                    for r, x, y in zip(rows[done].tolist(), range(0, len(kept), step), ends.tolist()):
                        out[at[r]] = kept[x:y]
                    rows, ids, ranks = rows[~done], ids[~done], ranks[~done]
                    first, lowest = first[~done], lowest[~done]
                    if not len(rows):
                        break
                i = np.arange(len(rows))
                ids[i, first + 1] = self.made[lowest]
                # what follows the left symbol moves up by one place
                moved = np.minimum(cols + (cols >= first[:, None]), n)
                ids = np.take_along_axis(ids, moved, 1)
                ranks = np.take_along_axis(ranks, np.minimum(moved[:, :-1], n - 1), 1)
                ids[:, -1], ranks[:, -1] = -1, self.none
                ranks[i, first] = self.rank(ids[i, first], ids[i, first + 1])
                left = first > 0
                ranks[i[left], first[left] - 1] = self.rank(
                    ids[i[left], first[left] - 1], ids[i[left], first[left]]
                )
        return out


def word_pieces(content: str) -> WordPieces:
    """One per worker, so that its caches serve many tasks."""
    return loaded(("word pieces", hash(content)), lambda: WordPieces(content))

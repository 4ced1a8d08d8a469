"""Repeated passages held against plain counting of windows, and on edge rows."""

import random
from collections import Counter

import numpy as np
import pytest

from reviewloom.llm import substrings


def plain(texts, n):
    """(n_words, n_removed, kept text) of each text."""
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + n]) for w in split for i in range(len(w) - n + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i : i + n])] > 1:
                gone[i : i + n] = [True] * n
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("n", [1, 2, 5, 17, 35, 80])
def test_cover_gives_any_two_windows_a_shared_anchor(n):
    period, members = substrings.cover(n)
    for i in range(period):
        for j in range(period):
            shifts = [d for d in range(period) if (i + d) % period in members and (j + d) % period in members]
            assert shifts and min(shifts) + n - period + 1 <= n


def test_words_are_hashed_alike_in_all_pieces(monkeypatch):
    rng = random.Random(4)
    words = [bytes(rng.choices(b"abc\xc3", k=rng.choice([1, 2, 5, 63, 64, 65, 300]))) for _ in range(200)]
    blob = b"".join(b" " * rng.choice([1, 1, 3]) + w for w in words) + b"  "
    starts, want = substrings.word_hashes(blob)
    assert [blob[a : a + len(w)] for a, w in zip(starts, words)] == words
    assert len(set(want.tolist())) == len(set(words))
    for piece in (65, 100, 1000):
        monkeypatch.setattr(substrings, "PIECE", piece)
        again = substrings.word_hashes(blob)
        assert (again[0] == starts).all() and (again[1] == want).all()


@pytest.mark.parametrize("n, chunk", [(35, 2 << 20), (35, 3000), (5, 500), (1, 200), (2, 1)])
def test_removal_equals_plain_counting(spark, monkeypatch, n, chunk):
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    monkeypatch.setattr(substrings, "BUCKET", 4000)
    rng = random.Random(n)
    vocabulary = [f"w{i}" for i in range(4000)] + ["Été", "日本", "x" * 100]

    def fresh(k):
        return rng.choices(vocabulary, k=k)

    passages = [fresh(k) for k in (n - 1, n, n + 1, 2 * n, 3 * n + 7)]
    texts = []
    for i in range(120):
        parts = [fresh(rng.randrange(40)), rng.choice(passages), fresh(rng.randrange(40))]
        texts.append(rng.choice([" ", "\n", " \t"]).join(sum(parts, [])))
    texts += [texts[0], texts[0], None, "", " \n\t ", "\x1c a\x85b ", "same " * (3 * n), "y" * 100_000, " ".join(passages[1])]
    texts += [" ".join(fresh(20_000))]
    rows = [(i % 100 if i % 7 else None, t, i, "a", "b") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_text int, chunk string, _row string").repartition(3)
    got = substrings.remove_repeated(df.withColumnRenamed("kept_text", "place"), n, carry=["place", "chunk", "_row"])
    assert got.columns == ["doc_id", "place", "chunk", "_row", "n_words", "n_removed", "kept_text"]
    found = {r.place: (r.n_words, r.n_removed, r.kept_text) for r in got.collect()}
    assert [found[i] for i in range(len(texts))] == plain(texts, n)
    assert sum(r[1] for r in found.values()) > 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeated(none).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, None)], "doc_id long, text string")
    assert [tuple(r) for r in substrings.remove_repeated(nulls).collect()] == [(None, 0, 0, "")] * 2


def test_hashes_meet_across_chunks_only():
    import pyarrow as pa

    one, two = np.array([1, 5, 9], np.uint64), np.array([5, 7], np.uint64)
    group = pa.table({"bucket": [0, 0], "chunk": [3, 4], "hashes": [one.tobytes(), two.tobytes()]})
    got = substrings._meet((0,), group).column("shared").to_pylist()
    assert got == [b"\0\1\0", b"\1\0"]

"""Importance resampling held against plain counting, and on edge rows."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from reviewloom.llm import importance

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_counts(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    grams = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), Counter(crc32(g.encode()) % importance.BUCKETS for g in grams)


def plain(docs, target, percent=5, least_words=20):
    """(key, n_features, weight, score, rank) of each row, in no order."""
    counts = [plain_counts(t) for _, t in docs]
    s, t = Counter(), Counter()
    for _, c in counts:
        s.update(c)
    for x in target:
        t.update(plain_counts(x)[1])
    s_all, t_all = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in range(10000)}
    rows = []
    for (key, _), (n, c) in zip(docs, counts):
        weight = sum(k * gain[b] for b, k in c.items())
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([key, sum(c.values()), weight, score, None, n])
    fit = sorted((r for r in rows if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = i + 1
    return sorted(map(repr, (tuple(r[:5]) for r in rows)))


def test_planes_give_exact_sums():
    rng = np.random.default_rng(3)
    for low, high in [(-5, 5), (-40000, 1), (0, 1), (-1, 0), (3, 9000)]:
        gains = rng.integers(low, high, 777)
        planes, worth = importance.signed_planes(gains)
        for most in (1, 2, 300, 1 << 33):
            counts = rng.integers(0, most, (5, 777))
            assert (importance.weigh(counts, planes, worth) == counts @ gains).all()


def test_long_texts_are_counted_in_pieces(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("a Bc ddd é9 x,y".split(" ")) for _ in range(n)) for n in (0, 1, 2, 3, 50, 4000)]
    want = [plain_counts(t) for t in texts]
    for piece, features in [(7, 20), (1, 1 << 18), (1 << 20, 1), (100, 200)]:
        monkeypatch.setattr(importance, "PIECE", piece)
        monkeypatch.setattr(importance, "FEATURES", features)
        words, rows = [], []
        for w, matrix in importance._count_rows([t.encode() for t in texts]):
            words, rows = words + w, rows + list(matrix)
        assert words == [n for n, _ in want]
        for row, (_, c) in zip(rows, want):
            assert {int(b): int(row[b]) for b in np.flatnonzero(row)} == dict(c)


def test_draw_equals_plain_counting(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ärger", "DON'T", "日本"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 3, 19, 20, 21, 80])))) for i in range(300)]
    docs += [(7, docs[7][1]), (None, docs[5][1]), (None, docs[5][1]), (400, None), (401, ""), (402, " \n!?"), (403, "A b " * 30000)]
    target = ["w1 w2 w3 w4", None, "", "w5 w6 Ärger w1 w2"]
    df = spark.createDataFrame([(k, t, "x", 1, "y") for k, t in docs], "doc_id long, text string, _key string, score int, position string")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (5, 50):
        got = importance.resample(df, goal, percent, carry=["_key", "position", "score"])
        assert got.columns == ["doc_id", "_key", "position", "n_features", "weight", "score", "rank"]
        rows = [(r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in got.collect()]
        assert sorted(map(repr, rows)) == plain(docs, target, percent)


@pytest.mark.parametrize("target", [[], ["w1 w2"]])
def test_empty_tables(spark, target):
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(none, goal).count() == 0
    one = spark.createDataFrame([(1, "a b " * 10)], "doc_id long, text string")
    assert importance.resample(one, goal, percent=100).first()["rank"] == 1

"""Periodic runs held against plain comparison of words, and on edge rows."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewloom.llm import periodic_runs


def plain(words, least=24, repeats=3):
    """All runs by trying every period at every place."""
    n, found = len(words), {}
    for p in range(1, n // repeats + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i + p - start
            if length >= max(least, repeats * p):
                found.setdefault((start, length), p)
    return sorted((s, n, p) for (s, n), p in found.items())


def collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


#: Texts built by repeating and joining parts, so that runs nest, overlap and touch.
PARTS = st.recursive(
    st.lists(st.sampled_from("ab"), min_size=1, max_size=6) | st.lists(st.sampled_from("abcdefgh"), max_size=20),
    lambda inner: st.builds(lambda x, k, cut: (x * k)[: len(x) * k - cut], inner, st.integers(1, 9), st.integers(0, 3))
    | st.builds(lambda x, y: x + y, inner, inner),
    max_leaves=6,
).map(lambda x: x[:600])


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=4), st.sampled_from([(24, 3), (3, 3), (1, 3), (7, 3), (10, 5)]))
def test_runs_equal_plain_comparison(texts, limits):
    numbered = periodic_runs._numbers([[w.encode() for w in t] for t in texts])
    assert periodic_runs.runs(numbered, *limits) == [plain(t, *limits) for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_random_words_of_few_kinds(seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(0, 2 + seed % 2, 400).tolist() for _ in range(5)] + [[0] * 100, [0, 1] * 50 + [0] * 30]
    a, b = [0], [0, 1]
    while len(b) < 500:  # a Fibonacci word, whose runs are as many as they get
        a, b = b, b + a
    texts.append(b)
    numbered = periodic_runs._numbers([[b"%d" % w for w in t] for t in texts])
    for least in (3, 12, 24):
        assert periodic_runs.runs(numbered, least) == [plain(t, least) for t in texts]


def test_two_periods_are_no_run():
    with pytest.raises(ValueError):
        periodic_runs.runs([], repeats=2)


def test_edge_rows(spark):
    texts = [
        None, "", " \n\t", "one two three", "a b c " * 8, "a b c " * 7 + "a b", "x\x1cy " * 24, "Ä ä\x85 " * 30,
        "same\v" * 24, "same " * 23, "p q r s t u v w " * 3 + "p", "w" * 200_000, "k l m n o " * 100_000,
        "a b c " * 8, " ".join(map(str, range(30_000))),
    ]
    rows = [(i % 3 or None, t, i, 5, "c") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, place int, Runs int, start string")
    got = periodic_runs.find_runs(df)
    assert got.columns == ["doc_id", "text", "place", "start", "runs", "collapsed"]
    for r in got.collect():
        words = (texts[r.place] or "").encode().split()
        runs = [tuple(x) for x in r.runs]
        if len(words) < 1000:
            assert runs == plain(words)
        assert r.collapsed.encode() == collapsed([w.decode() for w in words], runs).encode()
    long = got.filter("place = 12").first()
    assert [tuple(x) for x in long.runs] == [(0, 500_000, 5)] and long.collapsed == "k l m n o"
    assert periodic_runs.find_runs(df.limit(0)).count() == 0

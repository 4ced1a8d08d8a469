"""Operators held against brute force, the public libraries and held-out rows of the test tables."""

import hashlib
import os
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers as tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from reviewloom.llm import byte_pairs, ngram_join, queries, token_counts, word_pieces

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def content(name, mode="r"):
    with open(tokenizers.path(name), mode) as f:
        return f.read()


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in queries.documents(spark, SF).collect()}


@pytest.fixture(scope="module")
def word_ids(texts):
    library = Tokenizer.from_file(tokenizers.path("word_bpe_49k.json"))
    return {i: library.encode(r.text, add_special_tokens=False).ids for i, r in texts.items()}


RANKS = byte_pairs.read_ranks(content("byte_bpe_50k.tiktoken", "rb"))
PUBLIC = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PAIRS = byte_pairs.BytePairs(RANKS)
COUNTS = token_counts.Counts(content("byte_bpe_50k.json"), {" the": 1})
PIECES = word_pieces.WordPieces(content("word_bpe_49k.json"))
ODD = st.text(st.sampled_from(list(" \n\t\r\x1c\x1f\x85\xa0 ab'sABé²ΣσİßǅΩ漢́ͅ😀.,!_-<|endoftext|>")), max_size=40)


@settings(max_examples=400, deadline=None)
@given(ODD | st.text(max_size=40))
def test_encoders_equal_the_libraries(text):
    assert PAIRS.encode(text) == packed(PUBLIC.encode_ordinary(text))
    assert PAIRS.decode(PAIRS.encode(text)) == text.encode()
    assert COUNTS.count(text) == len(COUNTS.library.encode(text, add_special_tokens=False).ids)
    assert PIECES.encode([text])[0] == packed(PIECES.library.encode(text, add_special_tokens=False).ids)


def test_long_pretoken():
    raw = "ab" * 20_000 + "a" * 10_000
    assert PAIRS.encode(raw) == packed(PUBLIC.encode_ordinary(raw))


def test_op1(spark, texts):
    for r in queries.QUERIES["op1_byte_pairs"][0](spark, SF).collect():
        ids, raw = PUBLIC.encode_ordinary(texts[r.doc_id].text), texts[r.doc_id].text.encode()
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(raw).hexdigest()


def test_op2(spark, texts):
    for r in queries.QUERIES["op2_token_counts"][0](spark, SF).collect():
        n = len(COUNTS.library.encode(texts[r.doc_id].text, add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 1024, len(texts[r.doc_id].text.encode()))


def test_op3(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], float)
    got = defaultdict(list)
    for r in queries.QUERIES["op3_permutation_index"][0](spark, SF).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        found = got.pop(ids[i])
        assert [r.rank for r in found] == list(range(1, 21))
        assert np.allclose([r.score for r in found], score[np.searchsorted(ids, [r.vec_id for r in found])], atol=1e-12)
        hits += len({r.vec_id for r in found} & set(best.tolist()))
    assert not got and hits / (20 * (ids % 20 == 0).sum()) >= 0.9


def test_op4(spark, texts):
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    for r in queries.QUERIES["op4_license_scan"][0](spark, SF).collect():
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id].text))
        at = [
            (i, label)
            for phrase, label in phrases.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        starts, labels = [i for i, _ in at], {label for _, label in at}
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted(labels))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))


def test_op5(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.QUERIES["op5_quality"][0](spark, SF).collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [r.score for y, r in held if y], [r.score for y, r in held if not y]
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([y == r.predicted for y, r in held]) > 0.93


def test_op7(spark, texts, word_ids):
    start = 0
    for r in queries.QUERIES["op7_token_files"][0](spark, SF).orderBy("start").collect():
        ids = word_ids[r.doc_id] + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc32(packed(ids)))
        start += len(ids)


def test_op8(spark, texts):
    rows = queries.QUERIES["op8_language"][0](spark, SF).collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r.lang_pred == texts[r.doc_id].lang for r in rows if r.held_out]
    assert np.mean(held) > 0.98


def near_groups(texts, least=0.8, n=5):
    """Links and components by comparing all pairs that share an n-gram."""
    sets = {}
    for i, t in texts.items():
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(words[k : k + n]) for k in range(max(len(words) - n + 1, 1))} if words else set()
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    links = {i: set() for i in sets}
    for i, s in sets.items():
        for j, both in Counter(j for g in s for j in holders[g] if j != i).items():
            if both >= least * (len(s) + len(sets[j]) - both):
                links[i].add(j)
    component = {}
    for i in sorted(sets):
        todo = [] if i in component else [i]
        while todo:
            j = todo.pop()
            if j not in component:
                component[j] = i
                todo += links[j]
    return {i: (len(links[i]), component[i], component[i] == i) for i in sets}


def test_op9(spark, texts):
    want = near_groups({i: r.text for i, r in texts.items()})
    got = queries.QUERIES["op9_ngram_join"][0](spark, SF).collect()
    assert {r.doc_id: (r.n_links, r.component_id, r.kept) for r in got} == want


def test_op9_in_blocks(spark):
    """Large groups of different near copies, cut into many blocks."""
    rng = np.random.default_rng(5)
    rows = []
    for base in range(3):
        words = [f"w{base}x{k}" for k in range(120)]
        for copy in range(60):
            own = list(words)
            for k in rng.integers(0, 120, int(rng.integers(0, 4))):
                own[k] = f"z{base}y{copy}k{k}"
            rows.append((len(rows), " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.join(df, bucket_block=16, block=8).collect()
    assert {r.doc_id: (r.n_links, r.component_id, r.kept) for r in got} == near_groups(dict(rows))


def test_bands_reach_the_recall():
    for least in (0.5, 0.8, 0.9):
        b, r = ngram_join.bands_and_rows(least, 0.999)
        assert b * r <= ngram_join.MOST_HASHES and 1 - (1 - least**r) ** b >= 0.999


def test_op10(spark, word_ids):
    rows = queries.QUERIES["op10_best_fit_packing"][0](spark, SF).collect()
    pieces, sequences, total = defaultdict(list), defaultdict(list), 0
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, ids in word_ids.items():
        ids = ids + [1]
        total += len(ids)
        own = sorted(pieces.pop(i), key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in own] == [
            (k, a, min(4096, len(ids) - a)) for k, a in enumerate(range(0, len(ids), 4096))
        ]
        assert all(r.ids_crc32 == crc32(packed(ids[r.start : r.start + r.length])) for r in own)
    assert not pieces
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in own])
        assert [r.offset for r in own] == [0, *ends[:-1].tolist()] and ends[-1] <= 4096
    assert len(sequences) <= 1.03 * -(-total // 4096)


def test_pipeline(spark, texts):
    """Every stage keeps clean documents, and the near-duplicate stage one of each group."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs, path = queries.documents(spark, SF), queries.new_path(spark, "stages")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{path}/{k}")
        before, docs = docs, spark.read.parquet(f"{path}/{k}")
        if name == "quality classifier":
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            good = [i in ids for i, y in labels.items() if y and i in texts]
            bad = [i in ids for i, y in labels.items() if not y and i in texts]
            assert np.mean(good) > 0.99 and np.mean(bad) < 0.25
        if name == "n-gram Jaccard join":
            given = {r.doc_id: r.text for r in before.collect()}
            want = {i for i, (_, _, kept) in near_groups(given).items() if kept}
            assert {r.doc_id for r in docs.collect()} == want
    assert {r.doc_id for r in docs.collect()} == want

"""Edge rows for every operator: nulls, empty and long texts, ties, empty tables, clashing columns."""

import math

import numpy as np
import public_tokenizers as tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from reviewloom.llm import (
    byte_pairs,
    language,
    licenses,
    near_vectors,
    ngram_join,
    packing,
    permutation_index,
    quality,
    token_counts,
    token_files,
)

RANKS = tokenizers.path("byte_bpe_50k.tiktoken")
BYTES = tokenizers.path("byte_bpe_50k.json")
WORDS = tokenizers.path("word_bpe_49k.json")
LONG = "Some words in a row, and more of them. " * 4000
CLASH = "token_ids n_tokens n_words detections lang_pred score row id text_key h1 h2 _key _row _n _bin block".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)


def rows():
    texts = [
        (1, "One two three four five six."),
        (2, "One two three four five six."),
        (2, "One two three four five six."),
        (3, None),
        (4, ""),
        (5, " \n "),
        (6, LONG),
        (None, "One two three four five six."),
        (None, "Under the MIT license."),
        (7, "### $$$ 1234"),
        (8, "### $$$ 1234"),
        (9, "日本語 x́ <|endoftext|> İ"),
        (10, "a" * 30000),
        (11, "two words"),
    ]
    return [(i, t, "en" if t else None, None, None, *CLASH) for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def others(df, new):
    return sorted(c for c in df.columns if c not in new)


def test_byte_pairs(docs, empty):
    got = byte_pairs.encode_documents(docs, RANKS, decoded="decoded")
    assert others(got, {"token_ids", "decoded"}) == others(docs, {"token_ids"})
    for r in got.collect():
        assert bytes(r.decoded) == (r.text or "").encode()
        assert bool(r.token_ids) == bool(r.text)
    again = byte_pairs.decode_documents(got.drop("decoded"), RANKS)
    assert sorted(bytes(r.decoded) for r in again.collect()) == sorted((t or "").encode() for _, t, *_ in rows())
    assert byte_pairs.encode_documents(empty, RANKS).count() == 0
    nothing = docs.select(F.lit(None).cast("binary").alias("token_ids")).limit(1)
    assert byte_pairs.decode_documents(nothing, RANKS).first().decoded is None


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    for r in token_counts.count_tokens(docs, BYTES).collect():
        assert r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids)
    assert token_counts.count_tokens(empty, BYTES).count() == 0


def test_frequent_table_changes_no_count(docs):
    some = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, BYTES).collect()}
    none = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, BYTES, size=1).collect()}
    assert some == none


def test_token_files(spark, docs, empty, tmp_path):
    token_files.write_token_files(docs, f"{tmp_path}/t", WORDS, end_id=2)
    read = token_files.read_token_files(spark, f"{tmp_path}/t")
    got = read.orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((i for i, *_ in rows()), key=lambda i: (i is not None, i))
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert all(r.ids[-1] == 2 and len(r.ids) == r.n_tokens for r in got)
    assert token_files.id_checksums(read).where("ids_crc32 is null").count() == 0
    token_files.write_token_files(empty, f"{tmp_path}/e", WORDS, end_id=2)
    assert token_files.read_token_files(spark, f"{tmp_path}/e").count() == 0
    # selective reads: one column of the files
    plan = spark.read.parquet(f"{tmp_path}/t").select("n_tokens").filter("doc_id = 3")
    assert "ids" not in plan._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_packing(docs, empty):
    got = packing.pack_documents(docs, WORDS, end_id=1, capacity=64, open_bins=3).collect()
    assert len({(r.doc_id, r.piece) for r in got if r.doc_id == 6}) > 1
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    for pieces in by.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == np.cumsum([0] + [p.length for p in pieces])[:-1].tolist()
        assert sum(p.length for p in pieces) <= 64
    assert sum(r.doc_id == 2 for r in got) == 2 and sum(r.doc_id is None for r in got) == 2
    assert [r.length for r in got if r.doc_id == 4] == [1]
    assert packing.pack_documents(empty, WORDS, end_id=1).count() == 0


def test_licenses(docs, empty):
    got = licenses.scan_licenses(docs)
    found = {r.text: (r.n_words, r.detections) for r in got.collect()}
    assert found[None] == (0, []) and found[""] == (0, [])
    n, detections = found["Under the MIT license."]
    assert n == 4 and [d.label for d in detections if d.base] == ["mit"]
    assert licenses.scan_licenses(empty).count() == 0


def test_language(docs, empty):
    model = language.fit(docs, F.lit(True))
    got = {r.text: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    assert got[None] == got[""] == got[" \n "] == got["### $$$ 1234"] == ("und", 0.0)
    assert got["two words"] == ("en", 1.0)
    assert language.keep_identified(docs, model).columns == docs.columns
    nothing = language.fit(empty, F.lit(True))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(empty, model).count() == 0


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (6, 0), (None, 1), (7, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.lit(True))
    scores = quality.score(docs, model).collect()
    assert len(scores) == len(rows()) and all(0 <= r.score <= 1 for r in scores)
    assert quality.keep_good(docs, model).columns == docs.columns
    blank = quality.fit(docs, labels.limit(0), F.lit(True))
    assert all(abs(r.score - 0.5) < 0.02 for r in quality.score(docs, blank).collect())
    assert quality.score(empty, quality.fit(empty, labels, F.lit(True))).count() == 0


def test_isotonic():
    at, to = quality.isotonic([(0.0, 0.2, 1), (1.0, 0.1, 1), (2.0, 0.5, 2), (3.0, 0.4, 2), (4.0, 1.0, 1)])
    assert np.allclose(to, [0.15, 0.45, 1.0]) and np.allclose(at, [0.5, 2.5, 4.0])


def test_ngram_join(docs, empty):
    got = ngram_join.join(docs).collect()
    assert len(got) == len(rows())
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.n_links for r in by[1]] == [3] and {r.component_id for r in by[2]} == {1}
    assert sum(r.kept for r in by[1] + by[2]) == 1
    assert [(r.n_links, r.component_id, r.kept) for i in (3, 4, 5) for r in by[i]] == [(0, 3, True), (0, 4, True), (0, 5, True)]
    assert [(r.component_id, r.kept) for i in (7, 8) for r in by[i]] == [(7, True), (7, False)]
    assert sorted((r.component_id is None, r.kept) for r in by[None]) == [(False, False), (True, True)]
    one = ngram_join.keep_one(docs)
    assert one.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in one.collect()) == [0, 1, 3, 4, 5, 6, 7, 9, 10, 11]
    assert ngram_join.join(empty).count() == 0 and ngram_join.keep_one(empty).count() == 0


VECTORS = [
    (1, [1.0, 0.0, 0.0]),
    (2, [2.0, 0.0, 0.0]),
    (3, [1.0, 0.1, 0.0]),
    (3, [0.0, 0.0, 1.0]),
    (4, None),
    (5, [0.0, 0.0, 0.0]),
    (6, [1.0, None, 0.0]),
    (7, [math.nan, 1.0, 0.0]),
    (8, [math.inf, 1.0, 0.0]),
    (9, []),
    (10, [1.0]),
    (20, [1e30, 0.0, 0.0]),
    (40, [-1.0, 0.0, 0.0]),
]


@pytest.fixture(scope="module")
def vectors(spark):
    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("embedding", T.ArrayType(T.FloatType())),
            T.StructField("position", T.StringType()),
            T.StructField("block", T.StringType()),
        ]
    )
    return spark.createDataFrame([(i, v, "x", "y") for i, v in VECTORS], schema)


def test_near_vectors(vectors):
    got = near_vectors.link(vectors).collect()
    assert sorted(r.vec_id for r in got) == sorted(i for i, _ in VECTORS)
    linked = {1, 2, 10, 20}
    assert all(r.n_links == 4 and r.component_id == 1 for r in got if r.vec_id in linked)
    assert sorted(r.n_links for r in got if r.vec_id == 3) == [0, 4]
    assert all(r.n_links == 0 and r.kept for r in got if r.vec_id in {4, 5, 6, 7, 8, 9, 40})
    assert near_vectors.link(vectors.limit(0)).count() == 0


def test_permutation_index(vectors):
    got = permutation_index.nearest_by_inner_product(vectors, F.col("vec_id") % 20 == 0).collect()
    top = [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank) if r.query_id == 40]
    assert top[:2] == [(1, 3), (2, 1)] and len(top) == 6  # ties go to the smaller id
    assert permutation_index.nearest_by_inner_product(vectors.limit(0), F.lit(True)).count() == 0


def test_pipeline_stages(spark, docs, empty, tmp_path):
    labels = spark.createDataFrame([(1, 1), (6, 1), (11, 1)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for given in (docs, empty):
        df = given
        for name, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, str(tmp_path))
            assert df.columns == given.columns, name
        last = corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path))
        kept = {r.doc_id for r in last.collect()}
        assert kept <= {1, 2, 6, 9, 10, 11, None}


def test_permutation_index_copies(spark):
    """A third copies of one vector, and vectors of one direction: ties at the cut all reach the exact ranking."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 16)).astype(np.float32).astype(float)
    x[::3] = x[0]
    x[1:300:3] = np.outer(1 + np.arange(100) / 128, x[1])
    ids = np.arange(600)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    asked = F.col("vec_id").isin(0, 300, 1, 298)
    got = permutation_index.nearest_by_inner_product(df, asked, floor=30, share=0.05, block=600).collect()
    for q in (0, 300, 1, 298):
        score = x @ x[q]
        score[q] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]].tolist()
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == best


def test_language_reads_whole_words(spark, monkeypatch):
    """Texts without breaks are learned and judged by all their letters, whatever the pieces."""
    learned = [(1, "ab" * 100 + "cd" * 3000, "x"), (2, "ab" * 100 + "ef" * 3000, "y")]
    df = spark.createDataFrame(learned, "doc_id long, text string, lang string")
    model = language.fit(df, F.lit(True))
    assert {"cdcd", "efef", "bcdc"} <= set(model["items"][4])
    assert model["logs"][model["items"][3]["cdc"]].argmax() == 0
    texts = {"ba" * 150 + "cd" * 2000: "x", "ba" * 150 + "ef" * 2000: "y", "dc" * 150 + "ef" * 2000: "y"}
    asked = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r.text: r.lang_pred for r in language.identify(asked, model).collect()} == texts
    whole = [language.Scorer(model).score(t) for t in texts]
    monkeypatch.setattr(language, "PIECE", 7)
    assert np.allclose([p for _, p in whole], [language.Scorer(model).score(t)[1] for t in texts])
    assert ["".join(p[:n] for p, n in language._pieces("x" * m)) for m in range(30)] == [f" {'x' * m} " for m in range(30)]

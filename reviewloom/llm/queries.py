"""The operators over the test tables with production parameters, with SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import byte_pairs, importance, language, licenses, near_vectors, ngram_join, packing
from reviewloom.llm import periodic_runs, permutation_index, quality, substrings, token_counts, token_files
from reviewloom.session import new_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def byte_pair_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_pairs.encode_documents(docs, path, decoded="decoded").select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 1024).alias("over_limit"),
    )


def token_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_files.write_token_files(
        documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    return token_files.id_checksums(token_files.read_token_files(spark, path)).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )


def _joined(labels) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("detections", lambda d: d["base"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["start"])).alias("last_word"),
        _joined(F.transform(base, lambda d: d["label"])).alias("base_labels"),
        _joined(F.transform("detections", lambda d: d["label"])).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["score"])), F.lit(0.0)).alias("score"),
    )


def fold(n: int) -> Column:
    """Which of n folds a document falls in; null for a document without an id."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> dict:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.fit(docs, labels, fold(5) != 0)


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return quality.score(docs, quality_model(spark, docs, sf_dir)).select(
        "doc_id",
        F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def language_model(docs: DataFrame) -> dict:
    return language.fit(docs, fold(4) != 2)


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs.select("doc_id", "text"), language_model(docs)).select(
        "doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return permutation_index.nearest_by_inner_product(vectors, F.col("vec_id") % 20 == 0)


def near_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.link(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


NEAR_DOCUMENTS_SQL = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), grams AS (
    SELECT doc_id, CASE
        WHEN len(w) > 0 THEN list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
            lambda i: array_to_string(w[i:i + 4], ' ')))
        WHEN trim(text, E' \t\n\r\v\f') <> '' THEN [concat('- ', trim(text, E' \t\n\r\v\f'))]
        ELSE [] END AS g FROM worded
), each AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM grams),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), class AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a),
number AS (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_links, component_id, doc_id = component_id AS kept
FROM class LEFT JOIN number USING (doc_id)
"""


NEAR_VECTORS_SQL = """
WITH RECURSIVE unit AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b
        ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
), reached AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), class AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
number AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM class LEFT JOIN number USING (vec_id)
"""


def near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(documents(spark, sf_dir)).drop("text_key")


def importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


IMPORTANCE_SQL = r"""
WITH RECURSIVE worded AS (
    SELECT src, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT 's' AS src, doc_id AS id, text FROM documents
          UNION ALL SELECT 't', item_id, text FROM benchmark)
), words AS (SELECT src, id, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM worded),
runs AS (
    SELECT src, id, x, x || ' ' || lead(x) OVER a AS xx, x || ' ' || lead(x) OVER a || ' ' || lead(x, 2) OVER a AS xxx
    FROM words WINDOW a AS (PARTITION BY src, id ORDER BY i)
), each AS (
    SELECT src, id, x FROM runs UNION ALL SELECT src, id, xx FROM runs WHERE xx IS NOT NULL
    UNION ALL SELECT src, id, xxx FROM runs WHERE xxx IS NOT NULL
), bytes AS (
    SELECT i::BIGINT AS i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))::BIGINT AS v
    FROM range(256) t(i)
), parts AS (SELECT x, row_number() OVER () AS k FROM (SELECT DISTINCT x FROM each)),
step AS (
    SELECT k, hex(encode(x)) AS h, 4294967295::BIGINT AS c FROM parts
    UNION ALL
    SELECT k, h[3:], xor(c >> 8, v) FROM step JOIN bytes ON i = xor(c, ('0x' || h[1:2])::BIGINT) & 255 WHERE h <> ''
), crc AS (SELECT x, xor(c, 4294967295) % 10000 AS bucket FROM step JOIN parts USING (k) WHERE h = ''
), counted AS (
    SELECT src, id, bucket, count(*) AS n FROM each JOIN crc USING (x) GROUP BY src, id, bucket
), total AS (
    SELECT bucket, coalesce(sum(n) FILTER (src = 's'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (src = 't'), 0)::DOUBLE AS t
    FROM counted GROUP BY bucket
), gain AS (
    SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS g
    FROM total
), weighed AS (
    SELECT id AS doc_id, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight
    FROM counted JOIN gain USING (bucket) WHERE src = 's' GROUP BY id
), scored AS (
    SELECT id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS fit,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256(concat('42:', id))[1:8])::BIGINT + 0.5::DOUBLE)
            / 4294967296::DOUBLE)))::BIGINT AS score
    FROM worded LEFT JOIN weighed ON id = doc_id WHERE src = 's'
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place,
        5 * count(*) FILTER (fit) OVER () // 100 AS most FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= most THEN place END AS rank FROM placed
"""


def _repeating(text: str, key: str) -> Column:
    """The text; for a tenth of the keys, by hash, its words from some place on repeat with some period."""
    h = F.crc32(F.col(key).cast("string"))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def repeated(s: Column) -> Column:
        w, g = s["words"], s["g"]
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1), lambda i: F.get(w, (a + i % p).cast("int")))
        return F.array_join(F.concat(F.slice(w, 1, a.cast("int")), tail), " ")

    # an array of one struct, so that the words are split once and not once a word
    one = F.filter(F.array(F.struct(words.alias("words"), F.floor(h / 10).alias("g"))), lambda s: F.size(s["words"]) > 0)
    return F.when(h % 10 == 0, F.coalesce(F.get(F.transform(one, repeated), F.lit(0)), F.col(text))).otherwise(F.col(text))


def periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", _repeating("text", "doc_id").alias("text"))
    found = periodic_runs.find_runs(docs)
    # of the runs, which are in order, the first that no other exceeds
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in periodic_runs.RUN]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col("best")[c].alias(c) for c in periodic_runs.RUN],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# A run has at least 16 words that equal those a period later, so it begins with such a row of 16.
RUNS_SQL = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
        lambda c, b: xor(c >> 8, list_reduce([xor(c, b) & 255, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))))) AS h
    FROM documents
), placed AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) ELSE 0 END AS a FROM split),
texts AS (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_concat(w[1:a], list_transform(
        range(n - a), lambda i: w[a + i % (1 + (n - a) // (3 + g % 8)) + 1])) ELSE w END AS w
    FROM placed
), words AS (SELECT doc_id, n, w, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM texts),
rows16 AS (SELECT doc_id, n, i, md5(array_to_string(w[i + 1:i + 16], ' ')) AS r FROM words WHERE i + 16 <= n),
pairs AS (
    SELECT a.doc_id, a.i, b.i - a.i AS period FROM rows16 a JOIN rows16 b
        ON a.doc_id = b.doc_id AND a.r = b.r AND b.i > a.i AND 3 * (b.i - a.i) <= a.n
), islands AS (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM pairs
), stretches AS (
    SELECT doc_id, min(i) AS start, count(*) + 15 + period AS length, period FROM islands
    GROUP BY doc_id, period, island HAVING count(*) + 15 + period >= greatest(24, 3 * period)
), found AS (SELECT doc_id, start, length, min(period) AS period FROM stretches GROUP BY doc_id, start, length),
reports AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, E'\n'), '' ORDER BY start, period) AS lines
    FROM found GROUP BY doc_id
), best AS (
    SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1
), collapsed AS (
    SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM words w WHERE NOT EXISTS (
        SELECT 1 FROM found f WHERE f.doc_id = w.doc_id AND w.i >= f.start + f.period AND w.i < f.start + f.length)
    GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
    period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM texts LEFT JOIN reports USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN collapsed USING (doc_id)
"""


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


PASSAGES_SQL = r"""
WITH worded AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
    SELECT doc_id, w, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM worded
), windows AS (
    SELECT doc_id, x, i, CASE WHEN i + 34 <= len(w) THEN md5(array_to_string(w[i:i + 34], ' ')) END AS run FROM words
), counted AS (
    SELECT *, CASE WHEN run IS NOT NULL AND count(*) OVER (PARTITION BY run) > 1 THEN i END AS again FROM windows
), marked AS (
    SELECT doc_id, x, i, max(again) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone FROM counted
), cut AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(x, ' ' ORDER BY i) FILTER (NOT gone) AS kept
    FROM marked GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM worded LEFT JOIN cut USING (doc_id)
"""


QUERIES = {
    "op1_byte_pairs": (byte_pair_round_trip, None),
    "op2_token_counts": (token_count, None),
    "op3_permutation_index": (nearest, None),
    "op4_license_scan": (license_scan, None),
    "op5_quality": (quality_scores, None),
    "op6_near_vectors": (near_vector_links, NEAR_VECTORS_SQL),
    "op7_token_files": (token_file_round_trip, None),
    "op8_language": (languages, None),
    "op9_ngram_join": (near_documents, NEAR_DOCUMENTS_SQL),
    "op10_best_fit_packing": (packed_documents, None),
    "op11_importance_draw": (importance_draw, IMPORTANCE_SQL),
    "op12_periodic_runs": (periodic, RUNS_SQL),
    "op13_repeated_passages": (repeated_passages, PASSAGES_SQL),
}

"""Vectors: encoding, nearest neighbours, collections, lookups."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.operators import text_index, vectors
from reviewloom.queries.inputs import DOCUMENT_REVIEWS, documents, load, sql, table
from reviewloom.queries.texts import tokens_sql
from reviewloom.session import materialize, new_path
from reviewloom.sources.collections import Collection, Spec, coerce, list_collections
from reviewloom.sources.footers import column_counts
from reviewloom.sources.lookups import LookupTable
from reviewloom.sources.upserts import KeyedCollection
from reviewloom.sources.vector_index import VectorIndex

DIM = 64
PIVOTS, PROBES = 16, 4


def weights_cte(name: str, source: str, id: str, col: str, dim: int = vectors.DIM) -> str:
    """CTE ``name(id, b, w)``: hashed, unit-length word weights of each text."""
    return f"""{name} AS (SELECT id, b, (n / sqrt(sum(n * n) OVER (PARTITION BY id)))::FLOAT AS w FROM (
      SELECT id, b, count(*)::DOUBLE AS n FROM (SELECT {id} AS id,
        CAST(concat('0x', substr(md5(unnest({tokens_sql(col)})), 1, 8)) AS BIGINT) % {dim} AS b
        FROM {source}) GROUP BY ALL))"""


def near_ctes(queries: str, qid: str, qcol: str, docs: str, id: str, col: str, k: int) -> str:
    """CTEs ending in ``near(qid, id, similarity, rank)``: cosine over hashed words, ties by id."""
    return f"""{weights_cte("qw", queries, qid, qcol)}, {weights_cte("dw", docs, id, col)},
      qn AS (SELECT id, sqrt(sum(w::DOUBLE * w::DOUBLE)) AS r FROM qw GROUP BY id),
      dn AS (SELECT id, sqrt(sum(w::DOUBLE * w::DOUBLE)) AS r FROM dw GROUP BY id),
      dots AS (SELECT q.id AS qid, d.id AS id, sum(q.w::DOUBLE * d.w::DOUBLE) AS s
        FROM qw q JOIN dw d USING (b) GROUP BY ALL),
      sims AS (SELECT a.{qid} AS qid, c.{id} AS id, round(coalesce(s / qn.r / dn.r, 0.0), 9) AS similarity
        FROM (SELECT DISTINCT {qid} FROM {queries}) a CROSS JOIN (SELECT {id} FROM {docs}) c
        LEFT JOIN dots ON dots.qid = a.{qid} AND dots.id = c.{id}
        LEFT JOIN qn ON qn.id = a.{qid} LEFT JOIN dn ON dn.id = c.{id}),
      near AS (SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY qid ORDER BY similarity DESC, id) AS rank FROM sims) WHERE rank <= {k})"""


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.select(
        "qid", "id", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("bigint").alias("rank")
    )


def _pairs(spark, sf, **options) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return _rounded(
        vectors.knn(e, e, 5, DIM, "vec_id", "embedding", "vec_id", "embedding", **options)
    )


def _approx(spark, sf) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return vectors.knn_approx(
        e, e, 5, DIM, PROBES, "vec_id", "embedding", "vec_id", "embedding", PIVOTS
    )


def _recall(spark, sf) -> DataFrame:
    return vectors.recall(_pairs(spark, sf), _approx(spark, sf)).select(
        F.round("recall", 6).alias("recall")
    )


COSINE = "round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9)"
EXACT = f"""SELECT qid, id, round(similarity, 6) AS similarity, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY similarity DESC, id) AS rank FROM (
    SELECT a.vec_id AS qid, b.vec_id AS id, {COSINE} AS similarity FROM embeddings a, embeddings b))
  WHERE rank <= 5"""
APPROX = f"""WITH pivots AS (SELECT vec_id AS pid, embedding FROM embeddings
    ORDER BY md5(vec_id::VARCHAR), vec_id LIMIT {PIVOTS}),
  ranked AS (SELECT a.vec_id, b.pid, row_number() OVER (PARTITION BY a.vec_id
      ORDER BY {COSINE} DESC, md5(b.pid::VARCHAR)) AS place FROM embeddings a, pivots b),
  met AS (SELECT q.vec_id AS qid, c.vec_id AS id FROM ranked q JOIN ranked c
      ON q.pid = c.pid AND q.place <= {PROBES} AND c.place = 1),
  sims AS (SELECT qid, id, {COSINE} AS similarity FROM met
      JOIN embeddings a ON a.vec_id = qid JOIN embeddings b ON b.vec_id = id)
  SELECT qid, id, round(similarity, 6) AS similarity, rank FROM (SELECT *, row_number() OVER (
      PARTITION BY qid ORDER BY similarity DESC, id) AS rank FROM sims) WHERE rank <= 5"""


def _embed(spark, sf) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "lang", "text")
    made = vectors.embed(docs, ["lang", "text"])
    return made.select("doc_id", F.posexplode_outer("embedding").alias("bucket", "w")).filter("w > 0").select(
        "doc_id", F.col("bucket").cast("bigint").alias("bucket"), F.round(F.col("w").cast("double"), 6).alias("weight")
    )


def _near_text(spark, sf) -> DataFrame:
    docs = vectors.embed(documents(spark, sf).select("doc_id", "text"), ["text"])
    asked = table(spark, sf, "benchmark")
    return _rounded(vectors.near_text(asked, docs, 5, "item_id", "text", "doc_id"))


def _lookup(spark, sf) -> DataFrame:
    ids = table(spark, sf, "documents").select(F.lower(F.col("source")).alias("asked_id"))
    found = vectors.lookup(
        ids, load(spark, sf, DOCUMENT_REVIEWS), "asked_id", "asin", ["doc_id"], 5
    )
    return found.select("asked", F.col("rank").cast("bigint").alias("rank"), "doc_id", "overall")


def _stats(spark, sf) -> DataFrame:
    s = vectors.stats(table(spark, sf, "embeddings"))
    return s.select(
        "n",
        "min_dim",
        "max_dim",
        F.round("min_norm", 5).alias("min_norm"),
        F.round("max_norm", 5).alias("max_norm"),
    )


SPEC = Spec(("vec_id", "overall", "verified", "unixReviewTime", "note"))


def _objects(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id",
        F.when(F.col("label") == 0, "n/a").otherwise(F.col("label").cast("string")).alias("overall"),
        F.when(F.col("vec_id") % 3 == 0, "true").when(F.col("vec_id") % 3 == 1, "0").alias("verified"),
        (F.col("vec_id") * 1000).cast("string").alias("unixReviewTime"),
        F.col("label").alias("note"),
        "embedding",
    )


def _coerced(spark, sf) -> DataFrame:
    return coerce(_objects(spark, sf), SPEC).select(
        "vec_id",
        "overall",
        F.col("verified").cast("string").alias("verified"),
        "unixReviewTime",
        "note",
        F.size("embedding").cast("bigint").alias("dim"),
        F.round(F.col("embedding")[0].cast("double"), 6).alias("first"),
        F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 5).alias("total"),
    )


def _collection(spark, sf) -> DataFrame:
    """Create, load in two appends, read back, drop: the counts are written before."""
    made = Collection(spark, f"objects_{uuid.uuid4().hex}").create(SPEC)
    made.write(_objects(spark, sf), SPEC)
    made.append(made.read().filter("overall IS NULL"))
    counts = made.read().groupBy("note").agg(
        F.count("*").alias("objects"), F.count("overall").alias("rated"), F.count("embedding").alias("vectors")
    )
    kept = materialize(counts, "counts")
    made.drop()
    return kept


def _upserts(spark, sf) -> DataFrame:
    """All rows loaded, a third of them changed by a load that runs twice, a few deleted."""
    made = KeyedCollection(spark, f"keyed_{uuid.uuid4().hex}", "vec_id").create(SPEC, buckets=8)
    rows = _objects(spark, sf)
    made.write(rows, SPEC)
    changed = rows.filter("vec_id % 3 = 0").withColumn("note", F.lit("changed"))
    for _ in range(2):
        made.write(changed.union(changed), SPEC)
    made.delete(rows.filter("vec_id % 50 = 0"), "vec_id")
    counts = made.read().groupBy("note").agg(
        F.count("*").alias("objects"), F.count_distinct("vec_id").alias("ids"), F.count("overall").alias("rated")
    )
    kept = materialize(counts, "counts")
    made.drop()
    return kept


def _catalog(spark, sf) -> DataFrame:
    """Two collections are made and filled, one is dropped; what the catalog then says of each."""
    names = [f"catalog_{uuid.uuid4().hex}" for _ in range(2)]
    first, second = (Collection(spark, n).create(SPEC) for n in names)
    for made in (first, second):
        made.write(_objects(spark, sf), SPEC)
    listed = len({*names} & {*list_collections(spark)})
    second.drop()
    row = (listed, first.count(), first.exists(), second.exists(), first.encoder() == SPEC.encoder)
    first.drop()
    return spark.createDataFrame(
        [row], "listed long, objects long, kept boolean, dropped_found boolean, encoder_kept boolean"
    )


def _stored(spark, sf, cells: int, most: int | None, probes: int | None) -> DataFrame:
    """An index of half of the vectors, the rest appended, perhaps split, searched from another session."""
    e = table(spark, sf, "embeddings")
    name = f"index_{uuid.uuid4().hex}"
    made = VectorIndex(spark, name)
    made.create(e.filter("vec_id % 2 = 0"), DIM, "vec_id", cells=cells)
    made.append(e.filter("vec_id % 2 <> 0"), "vec_id")
    for _ in range(2 if most else 0):  # a cell of many copies of one vector stays as it is
        made.split(most)
    other = VectorIndex(spark.newSession(), name)
    asked = table(other.spark, sf, "embeddings")
    found, path = _rounded(other.search(asked, 5, probes, "vec_id")), new_path(spark, "found")
    found.write.parquet(path)
    made.drop()
    return spark.read.schema(found.schema).parquet(path)


def _lookup_table(spark, sf) -> DataFrame:
    """The same questions to a table laid out for lookups, in small pages."""
    ids = table(spark, sf, "documents").select(F.lower(F.col("source")).alias("asked_id"))
    laid = LookupTable(spark, f"lookup_{uuid.uuid4().hex}")
    laid.create(load(spark, sf, DOCUMENT_REVIEWS), "asin", ["doc_id"], buckets=8, page=3)
    found, path = laid.lookup(ids, "asked_id", 5).select("asked", "rank", "doc_id", "overall"), new_path(spark, "found")
    found.write.parquet(path)
    laid.drop()
    return spark.read.schema(found.schema).parquet(path)


def _footer_counts(spark, sf) -> DataFrame:
    made = [
        column_counts(spark, f"{sf}/{name}.parquet").withColumn("table", F.lit(name)) for name in ("documents", "embeddings")
    ]
    return made[0].union(made[1]).select("table", "column", "n_rows", "non_null")


LOOKED_UP = f"""SELECT asin AS asked, rank, doc_id, overall FROM (SELECT *, row_number() OVER (
  PARTITION BY asin ORDER BY doc_id) AS rank FROM {sql(DOCUMENT_REVIEWS)}) WHERE rank <= 5"""
FOOTER_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS non_null FROM {t}"
    for t, names in (("documents", "doc_id text lang source n_chars"), ("embeddings", "vec_id embedding label"))
    for c in names.split()
)


def _ranked_texts(spark, sf) -> DataFrame:
    """Questions against an index of all documents, in blocks small enough that there are several."""
    path = new_path(spark, "text-index")
    index = text_index.write_index(table(spark, sf, "documents"), path, "doc_id", "text", block_docs=64)
    found = index.search(table(spark, sf, "benchmark"), 5, "item_id")
    return found.select("qid", "id", "score", F.col("rank").cast("bigint").alias("rank"))


RANKED_TEXTS = f"""WITH lengths AS (SELECT doc_id AS id, coalesce(len({tokens_sql("text")}), 0) AS length FROM documents),
  size AS (SELECT count(*) AS n, sum(length)::DOUBLE / count(*) AS mean FROM lengths),
  times AS (SELECT id, term, count(*) AS times FROM (
    SELECT doc_id AS id, unnest({tokens_sql("text")}) AS term FROM documents) GROUP BY ALL),
  parts AS (SELECT id, term, floor(1000 * times * 2.2::DOUBLE / (times + 1.2::DOUBLE * (0.25::DOUBLE
      + 0.75::DOUBLE * length / mean)))::BIGINT AS part FROM times JOIN lengths USING (id), size),
  weights AS (SELECT term, floor(1000 * ln(1 + (n - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)))::BIGINT AS weight
    FROM times, size GROUP BY term, n),
  asked AS (SELECT DISTINCT item_id AS qid, unnest({tokens_sql("text")}) AS term FROM benchmark),
  scored AS (SELECT qid, id, sum(weight * part)::BIGINT AS score FROM asked JOIN weights USING (term)
    JOIN parts USING (term) WHERE weight > 0 GROUP BY ALL)
  SELECT qid, id, score, rank FROM (SELECT *, row_number() OVER (
    PARTITION BY qid ORDER BY score DESC, id) AS rank FROM scored) WHERE rank <= 5"""

QUERIES = {
    "collection_upserts": (
        _upserts,
        """SELECT note, count(*) AS objects, count(DISTINCT vec_id) AS ids, count(*) FILTER (label <> 0) AS rated
           FROM (SELECT *, CASE WHEN vec_id % 3 = 0 THEN 'changed' ELSE label::VARCHAR END AS note FROM embeddings)
           WHERE vec_id % 50 <> 0 GROUP BY note""",
    ),
    "lookup_table": (_lookup_table, LOOKED_UP),
    "footer_counts": (_footer_counts, FOOTER_COUNTS),
    "ranked_texts": (_ranked_texts, RANKED_TEXTS),
    "vector_index_search": (
        lambda s, d: _stored(s, d, PIVOTS, None, PROBES),
        APPROX.replace("FROM embeddings\n    ORDER BY", "FROM embeddings WHERE vec_id % 2 = 0\n    ORDER BY"),
    ),
    "vector_index_exact": (lambda s, d: _stored(s, d, 4, 100, None), EXACT),
    "nearest_vectors": (lambda s, d: _pairs(s, d), EXACT),
    "nearest_vectors_by_cells": (
        lambda s, d: _pairs(s, d, broadcast_bytes=0, pivots=PIVOTS),
        EXACT,
    ),
    "nearest_vectors_approximate": (lambda s, d: _rounded(_approx(s, d)), APPROX),
    "nearest_vectors_recall": (
        _recall,
        f"""SELECT round(count(a.id) / count(*), 6) AS recall FROM ({EXACT}) e
            LEFT JOIN ({APPROX}) a ON e.qid = a.qid AND e.id = a.id""",
    ),
    "text_vectors": (
        _embed,
        f"""WITH {weights_cte("w", "(SELECT doc_id, concat_ws(' ', lang, text) AS c FROM documents)", "doc_id", "c")}
            SELECT id AS doc_id, b AS bucket, round(w::DOUBLE, 6) AS weight FROM w""",
    ),
    "nearest_texts": (
        _near_text,
        f"""WITH {near_ctes("benchmark", "item_id", "text", "documents", "doc_id", "text", 5)}
            SELECT qid, id, round(similarity, 6) AS similarity, rank FROM near""",
    ),
    "lookup_by_id": (
        _lookup,
        LOOKED_UP,
    ),
    "vector_statistics": (
        _stats,
        """SELECT count(*) AS n, min(len(embedding))::INT AS min_dim, max(len(embedding))::INT AS max_dim,
           round(min(r), 5) AS min_norm, round(max(r), 5) AS max_norm
           FROM (SELECT embedding, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS r
                 FROM embeddings)""",
    ),
    "collection_objects": (
        _coerced,
        """SELECT vec_id::VARCHAR AS vec_id, CASE WHEN label <> 0 THEN label::DOUBLE END AS overall,
           CASE vec_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS verified,
           vec_id * 1000 AS "unixReviewTime", label::VARCHAR AS note, len(embedding) AS dim,
           round(embedding[1]::DOUBLE, 6) AS first, round(list_sum(embedding::DOUBLE[]), 5) AS total
           FROM embeddings""",
    ),
    "collection_catalog": (
        _catalog,
        """SELECT 2::BIGINT AS listed, count(*) AS objects, true AS kept, false AS dropped_found,
           true AS encoder_kept FROM embeddings""",
    ),
    "collection_load_and_count": (
        _collection,
        """SELECT label::VARCHAR AS note, count(*) * CASE WHEN label = 0 THEN 2 ELSE 1 END AS objects,
           count(*) * CASE WHEN label = 0 THEN 0 ELSE 1 END AS rated,
           count(embedding) * CASE WHEN label = 0 THEN 2 ELSE 1 END AS vectors
           FROM embeddings GROUP BY label""",
    ),
}

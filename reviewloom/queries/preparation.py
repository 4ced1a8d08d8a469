"""Profiles, duplicates, attribute columns, projections, samples, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.names import columns, match_columns
from reviewloom.operators import nested, paging, quality, sampling
from reviewloom.plans.preparation import prepare
from reviewloom.queries.inputs import REVIEWS, load, sql, table
from reviewloom.sources.tables import union_all

KEYS = ["reviewerID", "asin", "day"]
MIN_NON_NULL = 200
SEED_DRAW = "CAST(concat('0x', substr(md5(concat_ws(':', '42', CAST({} AS VARCHAR))), 1, 8)) AS BIGINT)"


def reviews(spark, sf) -> DataFrame:
    return load(spark, sf, REVIEWS)


def flat(spark, sf) -> DataFrame:
    return nested.flatten_json(reviews(spark, sf).drop("style_dup1", "style_dup2"), "style")


R = sql(REVIEWS)


def _path(key: str) -> str:
    return f"""CASE WHEN json_valid(style) THEN trim(json_extract_string(style, '$."{key}"')) END"""


FLAT = f"""(SELECT event_id, "reviewerID", asin, day, overall, style,
  {_path("Color:")} AS style_color,
  {_path("Format.Kind:")} AS "style_format.kind",
  CAST(NULL AS VARCHAR) AS style_never,
  {_path("Rare:")} AS style_rare,
  coalesce({_path("Size Name:")}, {_path("size name")}) AS style_size_name
  FROM {R})"""
STYLE_NAMES = ["style_color", "style_format.kind", "style_never", "style_rare", "style_size_name"]


def _counts(expr: str, out: str, source: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS \"column\", {expr.format(chr(34) + n + chr(34))} AS {out} FROM {source}"
        for n in names
    )


DEDUPED = f"""(SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY "reviewerID", asin, day ORDER BY event_id) AS rn FROM {FLAT}) WHERE rn = 1)"""


def _by_product(spark, sf):
    return quality.duplicate_groups(reviews(spark, sf), ["asin"], counted="asin")


def _pages(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return paging.page(orders, ["o_totalprice", "o_orderkey"], 1000).select(
        "o_orderkey", "position", "page"
    )


def _placeholders_dropped(spark, sf):
    df = reviews(spark, sf)
    return quality.drop_columns(df, regex=r"^style_dup\d+$", only_null=True)


def _column_choice(spark, sf):
    df = table(spark, sf, "lineitem")
    kept = match_columns(df, prefix="l_", regex=r"(key|number)$")
    others = match_columns(df, regex=r"(key|number|date)$", negate=True)
    return df.select(*columns(kept + others)).groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        F.min("l_orderkey").alias("min_key"),
        F.max("l_linenumber").alias("max_line"),
        F.max("l_quantity").alias("max_quantity"),
    )


def _union(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    s = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")
    )
    return union_all([c, s])


def _sample_groups(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return sampling.per_group(docs, "source", "doc_id", 0.5, 10, 7, 60)


def _split(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return sampling.split(orders, "o_orderkey", {"train": 0.8, "validation": 0.2})


def _position_window(order: str) -> str:
    return f"row_number() OVER (ORDER BY {order}) - 1"


QUERIES = {
    "prepare_reviews": (
        lambda s, d: prepare(reviews(s, d), KEYS, ["event_id"], min_non_null=MIN_NON_NULL),
        f"""SELECT event_id, "reviewerID", asin, day, overall, style, style_color,
            "style_format.kind", style_size_name FROM {DEDUPED}""",
    ),
    "duplicate_groups": (
        lambda s, d: quality.duplicate_groups(reviews(s, d), KEYS),
        f"""SELECT "reviewerID", asin, day, count(*) AS "count" FROM {R}
            GROUP BY ALL HAVING count(*) > 1""",
    ),
    "duplicate_products": (
        _by_product,
        f'SELECT asin, count(asin) AS "count" FROM {R} GROUP BY asin HAVING count(asin) > 1',
    ),
    "duplicate_line_keys": (
        lambda s, d: quality.duplicate_summary(
            table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]
        ),
        """SELECT count(*) AS "groups", CAST(sum(n - 1) AS BIGINT) AS surplus_rows FROM
           (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
    ),
    "missing_keys": (
        lambda s, d: quality.missing_report(reviews(s, d), [*KEYS, "overall"]),
        f"""SELECT 'reviewerID' AS "column", count(*) FILTER ("reviewerID" IS NULL OR "reviewerID" = '') AS missing FROM {R}
            UNION ALL SELECT 'asin', count(*) FILTER (asin IS NULL OR asin = '') FROM {R}
            UNION ALL SELECT 'day', count(*) FILTER (day IS NULL OR day = '') FROM {R}
            UNION ALL SELECT 'overall', count(*) FILTER (overall IS NULL) FROM {R}""",
    ),
    "column_population": (
        lambda s, d: quality.population(flat(s, d), STYLE_NAMES),
        _counts("count({})", "non_null", FLAT, STYLE_NAMES),
    ),
    "null_counts": (
        lambda s, d: quality.null_counts(flat(s, d)),
        _counts(
            "count(*) FILTER ({} IS NULL)",
            "nulls",
            FLAT,
            ["event_id", *KEYS, "overall", "style", *STYLE_NAMES],
        ),
    ),
    "all_null_columns": (
        lambda s, d: quality.all_null_columns(
            reviews(s, d), ["style", "style_dup1", "style_dup2", "overall"]
        ),
        f"""SELECT "column" FROM ({_counts("count({})", "n", R, ["style", "style_dup1", "style_dup2", "overall"])}) WHERE n = 0""",
    ),
    "row_counts": (
        lambda s, d: quality.row_counts(table(s, d, "documents"), ["text"]),
        "SELECT count(*) AS n_rows, count(DISTINCT text) AS n_distinct FROM documents",
    ),
    "dedupe_reviews": (
        lambda s, d: quality.dedupe(reviews(s, d), KEYS, ["event_id"]).select("event_id", *KEYS),
        f'SELECT event_id, "reviewerID", asin, day FROM {DEDUPED}',
    ),
    "dedupe_documents": (
        lambda s, d: quality.dedupe(table(s, d, "documents"), ["text"], ["doc_id"]),
        """SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, row_number() OVER (
           PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
    ),
    "prune_sparse_columns": (
        lambda s, d: quality.prune_sparse(flat(s, d), "style_", MIN_NON_NULL),
        f"""SELECT event_id, "reviewerID", asin, day, overall, style, style_color,
            "style_format.kind", style_size_name FROM {FLAT}""",
    ),
    "placeholder_columns_dropped": (
        _placeholders_dropped,
        f'SELECT event_id, "reviewerID", asin, day, overall, style FROM {R}',
    ),
    "column_choice": (
        _column_choice,
        """SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_orderkey) AS min_key,
           max(l_linenumber) AS max_line, max(l_quantity) AS max_quantity
           FROM lineitem GROUP BY ALL""",
    ),
    "attribute_filters": (
        lambda s, d: flat(s, d)
        .filter(F.col("style").contains("Format") & quality.present(F.col("style_color")))
        .select("event_id", "style_color", F.col("`style_format.kind`").alias("kind")),
        f"""SELECT event_id, style_color, "style_format.kind" AS kind FROM {FLAT}
            WHERE contains(style, 'Format') AND style_color IS NOT NULL AND style_color <> ''""",
    ),
    "extract_known_keys": (
        lambda s, d: nested.extract(
            reviews(s, d).select("event_id", "style"), "style", ["Color:", "Size Name:"]
        ),
        f"""SELECT event_id, style, {_path("Color:")} AS "style_Color",
            {_path("Size Name:")} AS "style_Size Name" FROM {R}""",
    ),
    "flatten_attributes": (flat, f"SELECT * FROM {FLAT}"),
    "attributes_long": (
        lambda s, d: nested.attributes_long(reviews(s, d), "style", ["event_id"]),
        f"""SELECT event_id, key, lower(translate(replace(key, ':', ''), ' ', '_')) AS name,
            trim(json_extract_string(style, '$."' || key || '"')) AS value
            FROM (SELECT event_id, style, unnest(json_keys(style)) AS key FROM {R}
                  WHERE json_valid(style))""",
    ),
    "first_orders": (
        lambda s, d: sampling.first_n(
            table(s, d, "orders").select("o_orderkey", "o_totalprice"),
            ["o_totalprice", "o_orderkey"],
            1000,
        ),
        """SELECT o_orderkey, o_totalprice FROM orders
           ORDER BY o_totalprice, o_orderkey LIMIT 1000""",
    ),
    "page_numbers": (
        _pages,
        f"""SELECT o_orderkey, position, position // 1000 AS page FROM
            (SELECT o_orderkey, {_position_window("o_totalprice, o_orderkey")} AS position FROM orders)""",
    ),
    "union_by_name": (
        _union,
        """SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
           UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier""",
    ),
    "sample_per_group": (
        _sample_groups,
        f"""WITH chosen AS (SELECT source FROM (SELECT DISTINCT source FROM documents) QUALIFY
              row_number() OVER (ORDER BY md5(concat_ws(':', '42', source)), source) <= 7),
            ranked AS (SELECT doc_id, source, md5(concat_ws(':', '42', CAST(doc_id AS VARCHAR))) AS h
              FROM documents SEMI JOIN chosen USING (source)
              WHERE {SEED_DRAW.format("doc_id")} < CAST(0.5 * 4294967296 AS BIGINT))
            SELECT doc_id, source FROM (SELECT *, row_number() OVER (
              PARTITION BY source ORDER BY h, doc_id) AS rn FROM ranked) WHERE rn <= 10
            ORDER BY h, doc_id LIMIT 60""",
    ),
    "sample_fraction": (
        lambda s, d: sampling.fraction(
            table(s, d, "orders").select("o_orderkey"), "o_orderkey", 0.1
        ),
        f"""SELECT o_orderkey FROM orders
            WHERE {SEED_DRAW.format("o_orderkey")} < floor(0.1 * 4294967296)""",
    ),
    "train_validation_split": (
        _split,
        f"""SELECT o_orderkey, CASE WHEN {SEED_DRAW.format("o_orderkey")} < floor(0.8 * 4294967296)
            THEN 'train' ELSE 'validation' END AS part FROM orders""",
    ),
}

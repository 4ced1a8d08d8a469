"""JSON lines and records: validation, key paths, schemas, arrays, scans, tables on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.operators import schema
from reviewloom.queries.inputs import RECORDS, REVIEWS, load, sql, table
from reviewloom.session import new_path
from reviewloom.sources import lines, tables
from reviewloom.sources.tables import spread

# event attributes as raw lines, some damaged, blank, padded or repeating a key
LINES = """
SELECT event_id,
       CASE WHEN event_id % 13 = 0 THEN '{bad' WHEN event_id % 17 = 0 THEN '   '
            WHEN event_id % 19 = 0 THEN concat('  ', props, ' ')
            WHEN event_id % 23 = 0 THEN concat('[', props, ',1]')
            ELSE props END AS value
FROM {events}
"""

WALK = f"""WITH RECURSIVE walk(path, j) AS (
  SELECT CAST([] AS VARCHAR[]), CAST(value AS JSON) FROM {sql(RECORDS)}
  UNION ALL
  SELECT CASE WHEN json_type(w.j) = 'OBJECT' THEN list_append(w.path, e.key) ELSE w.path END, e.value
  FROM walk w, json_each(w.j) e WHERE json_type(w.j) IN ('OBJECT', 'ARRAY')),
keys AS (SELECT DISTINCT path, array_to_string(path, '.') AS key FROM walk WHERE len(path) > 0)
"""
TYPE_RULE = """CASE WHEN contains(lower({0}), 'id') THEN 'string'
  WHEN contains(lower({0}), 'time') OR contains(lower({0}), 'date') THEN 'bigint'
  WHEN lower({0}) = 'verified' THEN 'boolean' WHEN lower({0}) = 'overall' THEN 'double'
  ELSE 'string' END"""


def _keys(spark, sf) -> DataFrame:
    return schema.discover_keys(spread(load(spark, sf, RECORDS)))


def _split(spark, sf) -> DataFrame:
    raw, path = load(spark, sf, LINES), new_path(spark, "lines")
    raw.select("value").write.option("compression", "gzip").text(path)
    good, bad = lines.split_json_lines(lines.read_lines(spark, path, partitions=8))
    both = good.withColumn("valid", F.lit(True)).unionByName(bad.withColumn("valid", F.lit(False)))
    return both.groupBy("value", "valid").agg(F.count("*").alias("n"))


SCAN_SCHEMA = "event_id bigint, asin string, overall double, style string, day string"


def _scan(spark, sf) -> DataFrame:
    """Records written as JSON lines, one in seven cut short, read with a declared schema."""
    path = new_path(spark, "records")
    body = F.to_json(F.struct("event_id", "asin", "overall", "day", F.parse_json(F.lit('{"n":[1]}')).alias("style")))
    cut = F.when(F.col("event_id") % 7 == 0, F.left(body, F.length(body) - 1)).otherwise(body)
    load(spark, sf, REVIEWS).select(cut.alias("value")).write.text(path)
    return lines.read_json(spark, path, SCAN_SCHEMA).select(
        F.when(F.col(lines.CORRUPT).isNull(), F.col("event_id").cast("string")).alias("event_id"),
        F.when(F.col(lines.CORRUPT).isNull(), F.col("asin")).alias("asin"),
        F.when(F.col(lines.CORRUPT).isNull(), F.col("style")).alias("style"),
        F.when(F.col(lines.CORRUPT).isNull(), F.col("day")).alias("day"),
        F.col(lines.CORRUPT).isNotNull().alias("corrupt"),
    )


def _arrays(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return lines.json_arrays(c, ["c_custkey"], 200)


def _round_trip(spark, sf) -> DataFrame:
    path = new_path(spark, "orders")
    done = tables.write_with_metrics(table(spark, sf, "orders"), path)
    back = tables.read_table(spark, path).select("o_orderkey", "o_custkey", "o_orderpriority")
    return back.withColumn("written", F.lit(done.rows).cast("bigint"))


def _files(spark, sf) -> DataFrame:
    return tables.table_files(table(spark, sf, "lineitem")).select(
        F.substring_index("file", "/", -1).alias("file"), "rows"
    )


def _saved_schema(spark, sf) -> DataFrame:
    path = new_path(spark, "schema")
    schema.save(spark, schema.infer(load(spark, sf, RECORDS)), path)
    return schema.describe(spark, schema.load(spark, path))


def _generated(spark, sf) -> DataFrame:
    """Records read back with the schema generated from their own keys."""
    records = spread(load(spark, sf, RECORDS))
    made = schema.to_struct(schema.from_keys(schema.discover_keys(records), overrides={"dates": "string"}))
    flat = T.StructType([f if f.name != "dates" else T.StructField("dates", T.StringType()) for f in made])
    read = records.select(F.from_json("value", flat).alias("r"))
    return read.select("r.id", F.col("r.buyer.priority").alias("priority"), "r.verified", "r.overall")


def _inferred_scan(spark, sf) -> DataFrame:
    path = new_path(spark, "inferred")
    load(spark, sf, RECORDS).select("value").write.text(path)
    return lines.read_json(spark, path, sample=1.0).select(
        "id", "buyer.custkey", "buyer.priority", "verified", "overall"
    )


def _multi_line(spark, sf) -> DataFrame:
    """Customers as JSON documents of up to 1000 records over several lines, one file each."""
    path = new_path(spark, "documents")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    pages = lines.json_arrays(rows, ["c_custkey"], 1000)
    spaced = pages.select("page", F.replace("records", F.lit("},"), F.lit("},\n")).alias("value"))
    spaced.write.partitionBy("page").text(path)
    return lines.read_json(spark, path, multiline=True).drop("page")


def _single_file(spark, sf) -> DataFrame:
    """A table written to one file, with what the load reported."""
    path = new_path(spark, "single")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    done = tables.write_with_metrics(rows, path, total=2 * rows.count())
    tables.write_table(tables.read_table(spark, path), path, files=1)
    known = done.rows_per_second > 0 and done.remaining_seconds > 0
    return tables.table_files(tables.read_table(spark, path)).select(
        F.lit(1).cast("long").alias("files"),
        "rows",
        F.lit(done.rows).cast("long").alias("loaded"),
        F.lit(done.percent).alias("percent"),
        F.lit(known).alias("rate_known"),
    )


QUERIES = {
    "json_lines_split": (
        _split,
        f"""SELECT trim(value) AS value, json_valid(trim(value)) AS valid, count(*) AS n
            FROM {sql(LINES)} GROUP BY ALL""",
    ),
    "json_scan_with_schema": (
        _scan,
        f"""SELECT CASE WHEN event_id % 7 <> 0 THEN CAST(event_id AS VARCHAR) END AS event_id,
            CASE WHEN event_id % 7 <> 0 THEN asin END AS asin,
            CASE WHEN event_id % 7 <> 0 THEN '{{"n":[1]}}' END AS style,
            CASE WHEN event_id % 7 <> 0 THEN day END AS day,
            event_id % 7 = 0 AS corrupt FROM {sql(REVIEWS)}""",
    ),
    "json_record_arrays": (
        _arrays,
        """SELECT (c_custkey_pos) // 200 AS page, CAST(to_json(list({'c_custkey': c_custkey,
             'c_name': c_name, 'c_nationkey': c_nationkey, 'c_mktsegment': c_mktsegment}
             ORDER BY c_custkey)) AS VARCHAR) AS records
           FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS c_custkey_pos FROM customer)
           GROUP BY 1""",
    ),
    "json_key_paths": (
        lambda s, d: _keys(s, d).select("key", F.size("path").cast("bigint").alias("parts")),
        WALK + "SELECT key, len(path) AS parts FROM keys",
    ),
    "json_key_tree": (
        lambda s, d: schema.key_tree(_keys(s, d)).withColumn("depth", F.col("depth").cast("bigint")),
        WALK + "SELECT len(path) - 1 AS depth, path[-1] AS name, key FROM keys",
    ),
    "schema_from_keys": (
        lambda s, d: schema.from_keys(_keys(s, d)).drop("path"),
        WALK
        + f""", parents AS (SELECT DISTINCT path[1:len(path) - 1] AS path FROM keys)
            SELECT key, p.path IS NOT NULL AS is_struct,
              CASE WHEN p.path IS NOT NULL THEN 'struct' ELSE {TYPE_RULE.format("k.path[-1]")} END AS type
              FROM keys k LEFT JOIN parents p ON p.path = k.path""",
    ),
    "schema_unique_names": (
        lambda s, d: schema.from_keys(_keys(s, d), "unique"),
        WALK
        + f"""SELECT key, concat(path[1], CASE WHEN n > 0 THEN concat('_dup', CAST(n AS VARCHAR)) ELSE '' END,
                CASE WHEN len(path) > 1 THEN concat('.', array_to_string(path[2:], '.')) ELSE '' END) AS unique_name,
              {TYPE_RULE.format("path[-1]")} AS type
              FROM (SELECT *, row_number() OVER (PARTITION BY path[1] ORDER BY key) - 1 AS n FROM keys)""",
    ),
    "schema_generated_scan": (
        _generated,
        f"""SELECT json_extract_string(value, '$.id') AS id,
            json_extract_string(value, '$.buyer.priority') AS priority,
            CAST(json_extract(value, '$.verified') AS BOOLEAN) AS verified,
            CAST(json_extract(value, '$.overall') AS DOUBLE) AS overall FROM {sql(RECORDS)}""",
    ),
    "schema_inferred": (_saved_schema, None),
    "table_round_trip": (
        _round_trip,
        """SELECT o_orderkey, o_custkey, o_orderpriority,
           (SELECT count(*) FROM orders) AS written FROM orders""",
    ),
    "table_files": (
        _files,
        "SELECT 'lineitem.parquet' AS file, count(*) AS \"rows\" FROM lineitem",
    ),
    "json_scan_inferred": (
        _inferred_scan,
        """SELECT o_orderkey AS id, o_custkey AS custkey, o_orderpriority AS priority,
           o_orderstatus = 'F' AS verified, 1.5::DOUBLE AS overall FROM orders""",
    ),
    "json_multi_line": (
        _multi_line,
        "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    ),
    "single_file_table": (
        _single_file,
        """SELECT 1::BIGINT AS files, count(*) AS rows, count(*) AS loaded, 50.0::DOUBLE AS percent,
           true AS rate_known FROM orders""",
    ),
}

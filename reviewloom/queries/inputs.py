"""The test tables seen as reviews, attribute JSON and conversations.

Each input is one SQL text that Spark and the checking engine both run over the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewloom.sources.tables import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# events as reviews: some keys missing, attribute text with several keys, some of it damaged
REVIEWS = """
SELECT event_id,
       CASE WHEN event_id % 70 = 0 THEN NULL WHEN event_id % 110 = 0 THEN ''
            ELSE CAST(user_id AS STRING) END AS "reviewerID",
       CASE WHEN event_id % 130 = 0 THEN NULL ELSE event_type END AS asin,
       CAST(CAST(ts AS DATE) AS STRING) AS day,
       value AS overall,
       CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN '{bad'
            ELSE concat('{"Color:":" ', event_type, ' ","Size Name:":"',
                        CAST(user_id % 10 AS STRING), '","size name":"low"',
                        CASE WHEN event_id % 3 = 0
                             THEN concat(',"Format.Kind:":{"k":', CAST(event_id % 5 AS STRING), '}')
                             ELSE '' END,
                        CASE WHEN event_id % 500 = 0 THEN ',"Rare:":"x","Never:":null' ELSE '' END,
                        '}') END AS style,
       CAST(NULL AS STRING) AS style_dup1,
       CAST(NULL AS STRING) AS style_dup2
FROM {events}
"""

# orders as nested records
RECORDS = """
SELECT o_orderkey AS id,
       concat('{"id":', CAST(o_orderkey AS STRING), ',"buyer":{"custkey":',
              CAST(o_custkey AS STRING), ',"priority":"', o_orderpriority, '"},"dates":[{"orderdate":"',
              CAST(CAST(o_orderdate AS DATE) AS STRING), '"},',
              CASE WHEN o_orderkey % 10 = 0 THEN '{"deep":[[{"x.y":1}]],"none":{}}'
                   WHEN o_orderkey % 100 = 1 THEN '[3,{"mixed":[null,{"m":true}]}]'
                   ELSE '{"orderdate":""}' END,
              '],"verified":', CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END,
              ',"overall":1.5}') AS value
FROM {orders}
"""

# user turns with product ids, a cleared id, exit words and recommendation questions put in
TURNS = """
SELECT conv_id, turn,
       CASE WHEN turn % 4 = 0 AND conv_id % 3 <> 0
                 THEN concat(text, ' ASIN: src', CAST((conv_id + turn) % 25 AS STRING), ' asin:zzz')
            WHEN conv_id % 5 = 0 AND turn = 2 THEN 'asin:'
            WHEN conv_id % 10 = 3 AND turn = 4 THEN 'Bye'
            WHEN conv_id % 10 = 6 THEN concat('Best product review ', text)
            WHEN conv_id % 10 = 9 AND turn > 0 THEN concat('review ', text)
            WHEN conv_id % 30 = 27 THEN ' '
            ELSE text END AS text
FROM {conversations}
WHERE role = 'user'
"""

# documents as the review collection, rated by their labels
DOCUMENT_REVIEWS = """
SELECT d.doc_id, upper(d.source) AS asin,
       CAST(1 + 3 * l.quality + (1 - l.toxic) AS DOUBLE) AS overall,
       d.text AS review_text_clean
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, spread over all cores for text work."""
    return spread(table(spark, sf_dir, "documents"))


def load(
    spark: SparkSession, sf_dir: str, text: str, given: dict[str, DataFrame] | None = None
) -> DataFrame:
    """An input text run by Spark over views of the tables it names, or of ``given`` frames."""
    names = {t: f"input_{t}" for t in TABLES if "{" + t + "}" in text}
    for t, view in names.items():
        if given and t in given:
            df = given[t]
        else:
            df = documents(spark, sf_dir) if t == "documents" else table(spark, sf_dir, t)
        df.createOrReplaceTempView(view)
    return spark.sql(_fill(text, names).replace('"reviewerID"', "reviewerID"))


def _fill(text: str, names: dict[str, str]) -> str:
    for t, name in names.items():
        text = text.replace("{" + t + "}", name)
    return text


def sql(text: str) -> str:
    """An input text as a subquery for the checking engine."""
    return "(" + _fill(text, {t: t for t in TABLES}) + ")"

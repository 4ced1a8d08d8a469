"""Connected components of a graph of links, without collecting any of it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.session import new_path


def _written(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = new_path(spark, f"links-{uuid.uuid4().hex[:6]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; a component is named by its smallest node.

    ``links`` has two columns of comparable ids, in any direction. Rounds of two steps: every node
    hands its larger neighbours to its smallest one, then the smaller ones too, until each node
    hangs on the smallest of its component. A node's smallest neighbour is a minimum that is
    pre-aggregated, so one with very many links needs no task of its own, and every round's links
    are written to the shared folder. No links give no rows.
    """
    a, b = links.columns
    edges = links.select(
        F.greatest(a, b).alias("node"), F.least(a, b).alias("to")
    ).filter(F.col("node") > F.col("to"))
    edges = _written(edges.distinct())
    if edges.isEmpty():
        return edges.withColumnRenamed("to", "component")
    while True:
        # smaller side: all smaller neighbours of a node, and the node, hang on the smallest
        low = edges.groupBy("node").agg(F.min("to").alias("low"), F.count("*").alias("n"))
        low = _written(low)
        several = low.filter("n > 1")
        chained = edges.join(low.select(F.col("node").alias("to")), "to", "left_semi")
        if several.isEmpty() and chained.isEmpty():
            return edges.select("node", F.col("to").alias("component"))
        small = (
            edges.join(several.select("node", "low"), "node")
            .filter("to > low")
            .select(F.col("to").alias("node"), F.col("low").alias("to"))
            .union(low.select("node", F.col("low").alias("to")))
            .distinct()
        )
        small = _written(small)
        # larger side: all larger neighbours of a node hang on its smallest neighbour, or on it
        down = small.groupBy("node").agg(F.min("to").alias("low"))
        edges = (
            small.join(down.select(F.col("node").alias("to"), "low"), "to", "left")
            .select("node", F.coalesce("low", "to").alias("to"))
            .union(down.select("node", F.col("low").alias("to")))
            .distinct()
        )
        edges = _written(edges)

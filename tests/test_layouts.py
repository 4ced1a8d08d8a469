"""Counts from footers, tables laid out for lookups, and the plans of lookups and retrieval."""

import glob
import struct

import pytest
from conftest import plan
from pyspark.sql import functions as F

from reviewloom.operators import vectors as V
from reviewloom.plans import chat
from reviewloom.sources import footers, lookups
from reviewloom.sources.lookups import LookupTable


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, None if i % 3 else f"t{i}", None, [i] if i % 2 else None, "") for i in range(100)]
    return spark.createDataFrame(data, "id bigint, `a.b` string, style_none string, list array<int>, style_empty string")


def test_footers_alone_are_read(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    rows.repartition(3).write.parquet(path)
    want = {("id", 100, 100), ("a.b", 100, 34), ("style_none", 100, 0), ("style_empty", 100, 100)}
    for name in glob.glob(f"{path}/*.parquet"):  # every data page is destroyed
        raw = bytearray(open(name, "rb").read())
        footer = struct.unpack("<I", raw[-8:-4])[0]
        raw[4 : len(raw) - 8 - footer] = bytes(len(raw) - 12 - footer)
        open(name, "wb").write(raw)
    for name in glob.glob(f"{path}/.*.crc"):
        open(name, "wb").write(b"")
    spark._jsc.hadoopConfiguration().set("fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
    names = ["id", "a.b", "style_none", "style_empty"]
    try:
        got = footers.column_counts(spark, path, names).collect()
    finally:
        spark._jsc.hadoopConfiguration().unset("fs.file.impl")
    assert {(r.column, r.n_rows, r.non_null) for r in got} == want and not any(r.scanned for r in got)


def test_nested_columns_are_scanned(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    rows.write.parquet(path)
    got = {r.column: r for r in footers.column_counts(spark, path).collect()}
    assert (got["list"].n_rows, got["list"].non_null, got["list"].scanned) == (100, 50, True)
    assert not got["id"].scanned
    assert "PushedAggregation: [COUNT(*), COUNT(id)]" in plan(footers.footer_frame(spark, path).agg(F.count("*"), F.count("id")))
    assert footers.all_null_columns(spark, path) == ["style_none"]
    assert footers.sparse_columns(spark, path, "style_", 1) == ["style_none"]
    rows.limit(0).write.parquet(f"{tmp_path}/empty")
    assert {(r.n_rows, r.non_null) for r in footers.column_counts(spark, f"{tmp_path}/empty").collect()} == {(0, 0)}


def test_a_table_for_lookups(spark, monkeypatch):
    data = [(i, "hot" if i % 3 else f"k{i % 40}", f"text {i}") for i in range(900)] + [(1000, None, "x")]
    df = spark.createDataFrame(data, "doc bigint, key string, text string").repartition(5)
    ids = spark.createDataFrame([("HOT",), ("k3",), ("K3",), ("none",), (None,)], "id string")
    made = LookupTable(spark, "looked_up").create(df, "key", ["doc"], buckets=4, page=10)
    stored = spark.table(made.table)
    pages = stored.filter("asked = 'HOT'").groupBy("page").count().collect()
    assert len(pages) == 60 and {r["count"] for r in pages} == {10}
    assert stored.filter("asked = 'HOT'").select(F.input_file_name()).distinct().count() == 4

    def want(k):
        by_key = {key: sorted(d for d, x, _ in data if x == key) for key in ("hot", "k3")}
        return sorted((key.upper(), r, d) for key, docs in by_key.items() for r, d in enumerate(docs[:k], 1))

    for few in (lookups.FEW, 0):
        monkeypatch.setattr(lookups, "FEW", few)
        for k in (1, 5, 25):
            got = made.lookup(ids, "id", k)
            assert sorted((r.asked, r["rank"], r.doc) for r in got.collect()) == want(k)
            assert got.columns == ["asked", "doc", "key", "text", "rank"] or set(got.columns) == {"asked", "doc", "key", "text", "rank"}
    monkeypatch.setattr(lookups, "FEW", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = made.lookup(ids, "id", 5)._jdf.queryExecution().sparkPlan().toString()
        done = plan(made.lookup(ids, "id", 5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    table_side = done[done.index("== Physical Plan ==") :].split("SortMergeJoin")[1].split("Exchange")[0]
    assert "Bucketed: true" in table_side and "looked_up" in table_side, text
    with pytest.raises(ValueError):
        made.create(df.withColumn("Place", F.lit(1)), "key", ["doc"])
    made.create(df.limit(0), "key", ["doc"])
    assert made.lookup(ids, "id").count() == 0
    made.drop()


def test_lookup_sends_few_ids_to_the_scan(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"k{i % 7}") for i in range(100)], "doc bigint, key string")
    ids = spark.createDataFrame([("k1",), ("K2",), (None,)], "id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = V.lookup(ids, df, "id", "key", ["doc"], 3)
        text = plan(got)
        window, scan = text.rindex("Window"), text.rindex("BroadcastHashJoin")
        assert "LeftSemi" in text[text.index("== Physical Plan ==") :] and window < scan
        few = sorted(map(tuple, got.collect()))
        monkeypatch.setattr(V, "FEW_IDS", 0)
        assert sorted(map(tuple, V.lookup(ids, df, "id", "key", ["doc"], 3).collect())) == few and len(few) == 6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_retrieval_shuffles_no_review_text(spark):
    df = spark.createDataFrame([(i, f"P{i % 5}", 1.0, f"words of review {i}") for i in range(50)], "doc_id bigint, asin string, overall double, review_text_clean string")
    reviews = chat.Reviews(V.embed(df, ["review_text_clean"]))
    turns = spark.createDataFrame([("review 7", None), ("words", "p1"), ("", None)], "query string, id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(chat.retrieve(turns, reviews, 2))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [item_id" in text and "SortMergeJoin" not in text[text.index("== Physical Plan ==") :]

import pytest
from conftest import plan
from pyspark.sql import functions as F

from reviewloom.functions.names import match_columns, safe_key_column
from reviewloom.operators import nested, paging, quality, sampling

KEYS = ["reviewerID", "asin", "unixReviewTime"]


@pytest.fixture
def keyed(spark):
    rows = [("u1", "B1", 10)] * 3 + [("u1", "B1", 11)] + [(None, "B1", 10)] * 2 + [("", "B2", None)]
    df = spark.createDataFrame(rows, "reviewerID string, asin string, unixReviewTime bigint")
    return df.withColumn("n", F.monotonically_increasing_id())


def test_duplicates_and_missing(keyed):
    assert quality.duplicate_summary(keyed, KEYS).first().asDict() == {"groups": 2, "surplus_rows": 3}
    found = {r["column"]: r["missing"] for r in quality.missing_report(keyed, KEYS).collect()}
    assert found == {"reviewerID": 3, "asin": 0, "unixReviewTime": 1}
    once = quality.dedupe(keyed, KEYS, ["n"])
    assert once.count() == 4 and quality.duplicate_groups(once, KEYS).count() == 0
    assert quality.dedupe(once, KEYS, ["n"]).count() == 4
    assert quality.dedupe(keyed, KEYS).count() == 4


def test_null_group_is_not_counted_by_column(keyed):
    by_reviewer = quality.duplicate_groups(keyed, ["reviewerID"], counted="reviewerID")
    assert [tuple(r) for r in by_reviewer.collect()] == [("u1", 4)]


def test_dedupe_limits_rows_before_the_shuffle(keyed):
    text = plan(quality.dedupe(keyed, KEYS, ["n"]))
    assert text.count("WindowGroupLimit") >= 2


def test_population_is_one_pass(spark):
    df = spark.createDataFrame(
        [(None, None, "a", "a"), (None, None, "b", "b"), (None, "x", None, "c")],
        "style_0 string, style_1 string, style_2 string, style_3 string",
    ).withColumn("id", F.lit(1))
    counts = quality.population(df, match_columns(df, prefix="style_"))
    assert [tuple(r) for r in counts.collect()] == [
        ("style_3", 3), ("style_2", 2), ("style_1", 1), ("style_0", 0),
    ]
    nulls = {r["column"]: r["nulls"] for r in quality.null_counts(df).collect()}
    assert nulls["style_0"] == 3 and nulls["id"] == 0
    assert [r[0] for r in quality.all_null_columns(df, df.columns).collect()] == ["style_0"]
    assert quality.prune_sparse(df, "style_", 2).columns == ["id", "style_2", "style_3"]
    with pytest.raises(ValueError):
        quality.drop_columns(df, prefix="style_", only_null=True)
    assert quality.drop_columns(df, regex=r"^style_0$", only_null=True).columns[0] == "style_1"


STYLES = [
    '{"Color Name:":" Red "}', '{" Size:":"L"}', '{"SCENT:":"a"}', '{"Scent:":"b"}',
    '{"Scent:":"b","SCENT:":"a"}', '{"a.b":"dot"}', '{"n":{"x":1},"z":null}',
    None, "", "   ", "{bad",
]


def test_flatten(spark):
    df = spark.createDataFrame(list(enumerate(STYLES)), "id int, style string")
    flat = nested.flatten_json(df, "style")
    rows = {r["id"]: r.asDict() for r in flat.collect()}
    assert len(rows) == len(STYLES)
    assert rows[0]["style_color_name"] == "Red"
    assert rows[1]["style__size"] == "L"
    assert [rows[i]["style_scent"] for i in (2, 3, 4)] == ["a", "b", "a"]
    assert rows[5]["style_a.b"] == "dot"
    assert rows[6]["style_n"] == '{"x":1}' and rows[6]["style_z"] is None
    for i in range(7, 11):
        assert all(v is None for k, v in rows[i].items() if k.startswith("style_"))
    dense = nested.flatten_json(df, "style", min_non_null=2)
    assert [c for c in dense.columns if c.startswith("style_")] == ["style_scent"]
    long = nested.attributes_long(df, "style", ["id"])
    assert {(r.id, r.name, r.value) for r in long.collect()} >= {(0, "color_name", "Red"), (6, "z", None)}


def test_safe_key(spark):
    keys = {"Color:": "color", " Size:": "_size", "A B:C": "a_bc", "x.y": "x.y", "É:": "é"}
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [r[0] for r in df.select(safe_key_column(F.col("k"))).collect()] == list(keys.values())


def test_more_keys_than_columns_are_wanted(spark):
    rows = [(i, '{"Often:":"x","Rare %d:":"y"}' % i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, style string")
    assert nested.flatten_json(df, "style", min_non_null=2).columns == ["id", "style", "style_often"]


def test_positions_follow_the_order_and_survive_skewed_values(spark):
    # a third of the rows share the first order column
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"))
    got = paging.page(df, ["v", "id"], 100).collect()
    want = sorted((r["v"], r["id"]) for r in got)
    assert [(r["v"], r["id"]) for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(3000))
    assert all(r["page"] == r["position"] // 100 for r in got)


def test_samples_and_splits(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20))
    a = {r.id for r in sampling.fraction(df, "id", 0.1).collect()}
    assert a == {r.id for r in sampling.fraction(df.repartition(7), "id", 0.1).collect()}
    assert 400 < len(a) < 600
    parts = sampling.split(df, "id", {"train": 0.8, "validation": 0.2}).groupBy("part").count().collect()
    assert sum(r["count"] for r in parts) == 5000 and len(parts) == 2
    some = sampling.per_group(df, "g", "id", 0.5, 10, 5, 1000)
    sizes = [r["count"] for r in some.groupBy("g").count().collect()]
    assert len(sizes) == 5 and max(sizes) <= 10
    assert sampling.per_group(df, "g", "id", 0.5, 10, 5, 12).count() == 12

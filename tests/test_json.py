import gzip
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewloom.operators import schema
from reviewloom.sources import lines, tables

LINES = [
    '{"asin":"B1","overall":5.0,"style":{"Color:":" Red "},"image":["u1","u2"],"reviewTime":"01 1, 2014"}',
    '{"a":[{"x":1},{"y":[{"z":1}]},3]}',
    '{"a.b":{"c":null}}',
    '{"a":1,"a":2}',
    "{bad",
    "",
    "[1,2]",
    r'{"s":"{\"no\":1}","t":"]]]"}',
]


def model(value, prefix=()):
    """Key paths as a recursive walk finds them."""
    if isinstance(value, dict):
        out = {(*prefix, k) for k in value}
        return out.union(*[model(v, (*prefix, k)) for k, v in value.items()]) if value else out
    if isinstance(value, list):
        return set().union(*[model(v, prefix) for v in value]) if value else set()
    return set()


def paths(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return {tuple(r["path"]) for r in schema.discover_keys(df).collect()}


def test_key_paths(spark):
    found = paths(spark, LINES)
    assert {("style",), ("style", "Color:"), ("a", "x"), ("a", "y", "z"), ("a.b", "c"), ("s",)} <= found
    assert not any(p[0] == "no" or "no" in p for p in found)
    assert paths(spark, ["[1]", "{bad", ""]) == set()


leaf = st.none() | st.booleans() | st.integers(-9, 9) | st.text(alphabet='ab{}[]"\\:, é', max_size=6)
keys = st.text(alphabet="abc.", min_size=1, max_size=2)
values = st.recursive(leaf, lambda v: st.lists(v, max_size=3) | st.dictionaries(keys, v, max_size=3), max_leaves=12)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(values, min_size=1, max_size=8))
def test_key_paths_equal_a_recursive_walk(spark, records):
    assert paths(spark, [json.dumps(r) for r in records]) == set().union(*map(model, records))


def test_schemas_from_keys(spark):
    df = spark.createDataFrame([(LINES[0],)], "value string")
    keys = schema.discover_keys(df)
    made = schema.to_struct(schema.from_keys(keys))
    assert made.simpleString() == (
        "struct<asin:string,image:string,overall:double,reviewTime:bigint,style:struct<Color::string>>"
    )
    names = {r["key"]: r["unique_name"] for r in schema.from_keys(keys, "unique").collect()}
    assert names["style"] == "style" and names["style.Color:"] == "style_dup1.Color:"
    fixed = schema.from_keys(keys, overrides={"reviewTime": "string"})
    assert fixed.filter("key = 'reviewTime'").first()["type"] == "string"
    tree = [(r.depth, r.name) for r in schema.key_tree(keys).collect()]
    assert tree[-2:] == [(0, "style"), (1, "Color:")]


@pytest.mark.parametrize(
    ("key", "type_name"),
    [("reviewerID", "string"), ("unixReviewTime", "bigint"), ("verified", "boolean"),
     ("overall", "double"), ("update", "bigint"), ("vote", "string"), ("video time", "string")],
)
def test_type_rule(spark, key, type_name):
    df = spark.createDataFrame([(key,)], "k string")
    assert df.select(schema.type_column(F.col("k"))).first()[0] == type_name


def test_inferred_schema_is_kept(spark, tmp_path):
    df = spark.createDataFrame([('{"a":1,"b":[],"c":{"d":1.5}}',), ('{"a":2,"e":true,"c":null}',)], "value string")
    made = schema.infer(df)
    assert made.simpleString() == "struct<a:bigint,b:array<string>,c:struct<d:double>,e:boolean>"
    schema.save(spark, made, str(tmp_path / "s"))
    assert schema.load(spark, str(tmp_path / "s")) == made
    assert schema.describe(spark, made).count() == 5


def test_lines_from_gzip(spark, tmp_path):
    with gzip.open(tmp_path / "x.json.gz", "wt") as f:
        f.write("\n".join([f"  {t} " for t in LINES]))
    good, bad = lines.split_json_lines(lines.read_lines(spark, str(tmp_path / "x.json.gz"), 3))
    assert sorted(r.value for r in good.collect()) == sorted(t for t in LINES if t not in ("", "{bad"))
    assert sorted(r.value for r in bad.collect()) == ["", "{bad"]


def test_scan_with_schema_keeps_text_and_bad_lines(spark, tmp_path):
    (tmp_path / "r.json").write_text("\n".join([LINES[0], LINES[4]]))
    rows = lines.read_json(spark, str(tmp_path / "r.json"), lines.REVIEW_SCHEMA).collect()
    good = next(r for r in rows if r.asin)
    assert good["style"] == '{"Color:":" Red "}' and json.loads(good["image"]) == ["u1", "u2"]
    assert good["reviewTime"] == "01 1, 2014"
    assert [r[lines.CORRUPT] for r in rows if not r.asin] == ["{bad"]
    assert "asin" in lines.read_json(spark, str(tmp_path / "r.json"), sample=1.0).columns
    with pytest.raises(ValueError):
        lines.read_json(spark, str(tmp_path / "r.json"), sample=1e-9)


def test_multiline_document(spark, tmp_path):
    (tmp_path / "d.json").write_text('{\n "a": 1,\n "b": [1, 2]\n}')
    assert lines.read_json(spark, str(tmp_path / "d.json"), multiline=True).first()["a"] == 1


def test_record_arrays_are_bounded(spark, tmp_path):
    df = spark.range(10).select("id")
    lines.write_json_arrays(df, str(tmp_path / "a"), ["id"], 4)
    arrays = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "a")).collect()]
    assert sorted(map(len, arrays)) == [2, 4, 4]
    assert sorted(x["id"] for a in arrays for x in a) == list(range(10))


LOG = (
    '{"timestamp": "2024-01-01T00:00:00.1", "user_input": "What is the rating for ASIN:B1", '
    '"intent": "general_query", "sentiment": {"label": "NEUTRAL", "score": 0.5}, "context": '
    '{"recent_products": [], "recent_intents": [], "user_preferences": {}}, "bot_response": "no"}'
)


def test_log_round_trip(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text(LOG)
    lines.write_log(lines.read_log(spark, str(tmp_path / "in.jsonl")), str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first().value) == json.loads(LOG)


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    done = tables.write_with_metrics(spark.range(100), path, total=200)
    assert done.rows == 100 and done.percent == 50.0 and done.remaining_seconds > 0
    back = tables.read_table(spark, path)
    assert back.count() == 100
    assert tables.table_files(back).agg(F.sum("rows")).first()[0] == 100
    uri = f"file://{path}"
    tables.write_table(spark.read.parquet(uri).filter("id < 40"), uri)  # over its own input
    back = spark.read.parquet(path)
    assert back.count() == 40
    tables.write_table(back, str(tmp_path / "u"), files=1)
    assert tables.table_files(spark.read.parquet(str(tmp_path / "u"))).count() == 1
    both = tables.union_all([spark.range(1).select("id"), spark.range(1).withColumn("x", F.lit("y"))])
    assert sorted(r.x or "" for r in both.collect()) == ["", "y"]

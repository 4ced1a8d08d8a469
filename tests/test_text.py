import pytest
from conftest import plan
from pyspark.sql import functions as F

from reviewloom import constants as K
from reviewloom.functions import text as X
from reviewloom.operators import text


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, t string")


def test_clean(spark):
    df = texts(spark, [None, "", "...", "the AND of", "The cats, boxes and Stories!", "Café über the Straße", "Children went"])
    got = [r.c for r in text.clean(df, {"t": "c"}).orderBy("id").collect()]
    assert got == [None, "", "", "", "cat box story", "café über straße", "child go"]
    assert "BatchEvalPython" not in plan(text.clean(df, {"t": "c"}))


def test_clean_by_language(spark):
    df = spark.createDataFrame([(1, "en", "the dogs"), (2, "de", "der Hund und die"), (3, "xx", "the der")], "id int, lang string, t string")
    lists = {"en": K.ENGLISH_STOPWORDS, **text.language_stopwords({"de": "german"})}
    got = [r.c for r in text.clean(df, {"t": "c"}, lists, "lang").orderBy("id").collect()]
    assert got == ["dog", "hund", "the der"]


@pytest.mark.parametrize("bound", [0, 500_000])
def test_dictionary_tables_of_any_size(spark, monkeypatch, bound):
    monkeypatch.setattr(text, "MAX_BROADCAST_WORDS", bound)
    # one word makes up most of the rows
    df = texts(spark, [None, "", "the the the cat", *["the ran the"] * 30])
    stop = spark.createDataFrame([("the",)], "token string")
    lemmas = spark.createDataFrame([("ran", "run")], "token string, lemma string")
    got = [r.cleaned for r in text.clean_with_tables(df, "id", "t", stop, lemmas).orderBy("id").collect()]
    assert got == [None, "", "cat", *["run"] * 30]


def test_sentiment(spark):
    df = texts(spark, ["great great bad", "awful", "good bad", None, ""])
    got = [(r.s.label, round(r.s.score, 3)) for r in text.sentiment(df, "t", "s").orderBy("id").collect()]
    assert got == [("POSITIVE", 0.667), ("NEGATIVE", 1.0), ("NEUTRAL", 0.5), ("NEUTRAL", 0.5), ("NEUTRAL", 0.5)]


def test_sentiment_model(spark):
    df = texts(spark, ["good fine", "bad awful"] * 10).withColumn("y", 1 - F.col("id") % 2)
    model = text.train_sentiment(df, "t", "y", 1 << 8)
    got = text.model_sentiment(texts(spark, ["good", "awful", None]), "t", model, "s").orderBy("id").collect()
    assert [r.s.label for r in got] == ["POSITIVE", "NEGATIVE", "NEUTRAL"]


def test_summaries(spark):
    body = "Battery life matters. I slept. Battery life of this battery is great! Other words here."
    df = texts(spark, [body, "", None, "...", "one two three four five"])
    got = [r.summary for r in text.summarize(df, "id", "t", {"summary": (8, 3)}).orderBy("id").collect()]
    assert got == ["Battery life matters.", K.NO_SUMMARY, K.NO_SUMMARY, K.NO_SUMMARY, "one two three four five"]
    short = text.summarize(df, "id", "t", {"summary": (3, 1)}).orderBy("id").first().summary
    assert len(short.split()) <= 3


def test_summary_shuffles_each_text_once(spark):
    df = texts(spark, ["a b. c d."] * 5).repartition(3)
    got = text.summarize(df, "id", "t")
    got.collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = plan(text.summarize(df, "id", "t")).split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shown.count("Exchange hashpartitioning") <= 2  # the same exchange, once per join side


def test_pairs_and_token_ids(spark):
    df = texts(spark, ["b a a", "", None, "a z"]).withColumn("s", F.lit("x"))
    assert text.training_pairs(df, "t", "s", ["id"]).count() == 2
    assert text.training_pairs(df, "t", "s", ["id"], limit=1).count() == 1
    vocab = text.vocabulary(df, ["t"], 5)
    assert {r.token: r.token_id for r in vocab.collect()} == {"a": 3, "b": 4}
    got = {r.id: r.token_ids for r in text.encode_tokens(df, "id", "t", vocab, 4).collect()}
    assert got == {0: [4, 3, 3, 1], 1: [1, 0, 0, 0], 2: [1, 0, 0, 0], 3: [3, 2, 1, 0]}


def test_intent_and_entities(spark):
    df = texts(spark, ["Best review", "a Review", "hello product", None])
    got = df.select(X.intent(F.col("t")), X.entities(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [
        ("recommendation", []), ("review_search", []), ("product_info", ["product"]), ("general_query", []),
    ]


def test_regular_lemmas(spark):
    said = "walk walked make making big bigger late latest sing thing ring stop stopped stopping"
    df = spark.createDataFrame([(1, said)], "id long, t string")
    table = text.regular_lemmas(text.vocabulary(df, ["t"]))
    assert {r.token: r.lemma for r in table.collect()} == {
        "walked": "walk", "making": "make", "bigger": "big", "latest": "late", "stopped": "stop", "stopping": "stop",
    }
    stop = spark.createDataFrame([], "token string")
    got = text.clean_with_tables(df, "id", "t", stop, table).first().cleaned
    assert got == "walk walk make make big big late late sing thing ring stop stop stop"

"""Texts without words are compared without their outer white space."""

from reviewloom.llm import ngram_join


def test_outer_white_space_of_wordless_texts(spark):
    texts = ["!!!", "!!!      ", "\n\t !!!" + " " * 40, "!!! !!!", "#" * 16, " " + "#" * 16, "#" * 8, "!!!\0", "   "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_links, r.component_id, r.kept) for r in ngram_join.join(df).collect()}
    assert got == {
        0: (2, 0, True), 1: (2, 0, False), 2: (2, 0, False), 3: (0, 3, True), 4: (1, 4, True),
        5: (1, 4, False), 6: (0, 6, True), 7: (0, 7, True), 8: (0, 8, True),
    }

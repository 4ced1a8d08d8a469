"""The corpus pipeline: documents through language, quality, near duplicates and packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reviewloom.llm import language, ngram_join, packing, quality
from reviewloom.llm.queries import language_model, quality_model
from reviewloom.session import new_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those without a letter or a likely language go."""
    return language.keep_identified(docs, language_model(docs))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of these documents, accepts."""
    return quality.keep_good(docs, quality_model(spark, docs, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word n-grams, Jaccard 0.8 or more."""
    return ngram_join.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("language ID", language_id),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("best-fit packing", best_fit_packing),
]

#: No stage can be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every other stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = new_path(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs

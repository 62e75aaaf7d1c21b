"""A corpus pipeline: language, toxicity, near duplicates, mixing and packing, stage by stage.

Every stage is a function of (session, documents, folder of tables); its rows are written as Parquet and read again as
the next stage's documents. All but the last return the columns of ``documents``, and whatever other columns came with them.

Every stage takes nulls in any column, repeated rows, very long texts, equal ids and empty tables; each says what they give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vellum.llm import language, mixing, near_dedup, packing, toxicity
from vellum.session import scratch, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without letters or of no clear language go.

    So null and empty texts go. Repeated rows stay as they are, equal texts stay or go together, long texts are scored whole; without any
    known language every row goes. Languages of equal likelihood have a score of a half at most and stay with two, go with more.
    """
    model = language.train(docs, language.fold("doc_id", 3) != 1)
    return language.told(docs, model)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic. It learns from the labels of the documents of this stage.

    Rows without text or label are scored like any other; repeated rows and equal texts stay or go together; long texts are scored
    whole. Without labels of both kinds the share of toxic ones decides, so all stay where none is known.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.clean(docs, toxicity.train(docs, labels, language.fold("doc_id", 5) != 0))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more.

    The row of the least id stays; rows that repeat in id and text count once; a group without ids keeps one row, a null or empty
    text is like no other and stays; of rows that tie the first by their other columns stays.
    """
    return near_dedup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Null and empty texts have no words and are not taken; null sources are a source; rows that repeat are taken each; ties of finish
    times go by source, copy, shuffle and id.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of at most 2048 tokens.

    A null or empty text is one closing token; repeated rows are packed each; long texts are cut into whole sequences.
    """
    return packing.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Fitted classifiers, iterated components and tokens are beyond SQL; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch(spark):  # a stage's own tables go when its rows are written
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input.

1. language: documents whose language cannot be told go: those without text or a letter, and those whose best language is
   no more likely than all others together. A missing lang is filled with the prediction, for the budgets of stage 5.
2. near_duplicates: one document of each group of texts with 5-word similarity of 0.8 or more stays; groups are found by the
   deletion variants of SimHash fingerprints and, for pairs that these miss, by MinHash, and verified on whole sets of shingles.
3. decontamination: documents that hold a benchmark item go.
4. personal_data: spans of personal data are replaced by their kind.
5. mixing: documents are chosen by token budgets of domains, languages and sources.

Every stage takes null texts, ids, langs and sources, empty and very long texts, repeated rows, empty tables and other columns
of any name. Texts that are null, empty or without a letter go in stage 1; rows that share a doc_id or have none are separate
documents throughout (of equal rows stage 2 keeps one); a null source is the source unknown in stage 5; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlas.llm import decontam, langid, minhash, mixing, pii
from statlas.llm._util import delete, scratch, table
from statlas.llm.queries import MIX

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: A language that is less likely than this is no answer.
MIN_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with a letter and a language of a score of MIN_SCORE or more; a null lang is filled."""
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))).select("text", "lang"))
    told = langid.identify(docs, model).where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_SCORE))
    return told.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with one row of each group of near-duplicates, that of the smallest doc_id (null counts as the largest)."""
    return minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs that hold no item of the table benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with personal data put out in text, and n_chars counted again."""
    text = pii.redacted(F.col("text"), F.col("pii"))
    return pii.with_spans(docs).withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The chosen docs, with the leaf of the tree of weights that they are from, their tokens and their copies."""
    return mixing.mixed(docs, MIX)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mix),
]

#: No SQL: the stages fit a classifier and hash shingles. tests/llm checks each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stages make of the table documents. A stage's written table is removed when the next one's is there."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)

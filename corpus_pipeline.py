"""A training corpus from `documents`: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import discard, joined, stage, table, written
from tidelog.llm.decontamination import decontaminate
from tidelog.llm.language_id import fit, held_out, identify
from tidelog.llm.line_dedup import dedup_lines
from tidelog.llm.ngram_join import linked_documents
from tidelog.llm.packing import packed_documents


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; learns from the labels of the others' share."""
    dictionaries = fit(docs.where(~held_out()).select("doc_id", "text", "lang"))
    return identify(docs, dictionaries).where("accepted").select(*docs.columns)


@stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines seen before; one that has lost all its lines goes."""
    cleaned = dedup_lines(docs).where("text RLIKE '\\\\S'")
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents."""
    linked = linked_documents(docs)
    copies = linked.where("doc_id <> component_id").select("doc_id").distinct()
    return joined(docs, copies, "doc_id", "left_anti").select(*docs.columns)


@stage
def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their sequences."""
    return packed_documents(docs)


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("ngram_join", near_copies),
    ("decontamination", leaks),
    ("packing", packing),
]

#: Language, sketches and components can't be put in SQL; the tests follow each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        before, docs = docs, written(apply(spark, docs, sf_dir), name)
        if name != STAGES[0][0]:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)

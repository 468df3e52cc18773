"""The training-text pipeline over `documents`: five stages in a fixed order.

Each stage is (spark, docs, sf_dir) -> DataFrame; its rows are written as
Parquet to the shared folder and read again as the next stage's docs. All but
the last return the columns of documents, whatever more columns there are and
however they are called. What all stages do with odd rows: an empty table gives
no rows; repeated rows are judged one by one; nothing is cut from a long text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmesh.llm import decontaminate, line_dedup, near_dups, quality, sentencepiece_fst
from quillmesh.llm.common import drop, settled


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others lose lines above the limit.

    Null and empty texts have too few words and go; rows without doc_id are judged
    as the others; a null source is a host of its own.
    """
    return quality.keep_quality(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents or more hold stay in the largest doc_id; n_chars follows the text.

    Null texts stay null; rows without doc_id lose nothing and hold no line.
    """
    return line_dedup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays, the one with the smallest doc_id.

    Texts without words are linked with nothing; rows that share the smallest
    doc_id of a component all stay; rows without doc_id stay.
    """
    return near_dups.drop_near_dups(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark window go; null and empty texts hold none."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip of each row that is left; null and empty texts have no ids."""
    return sentencepiece_fst.encode(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: SQL cannot express the last stage; tests/llm compares run() with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = settled(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
        if before is not None:
            drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)

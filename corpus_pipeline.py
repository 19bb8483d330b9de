"""From raw documents to packed training sequences: quality rules, line dedup, near-dedup, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import DOCUMENT_COLUMNS, cut, own_columns, table
from tablewright.llm.line_dedup import drop_recurring
from tablewright.llm.mixing import mix_sources
from tablewright.llm.packing import pack
from tablewright.llm.quality import LineRules, quality
from tablewright.llm.simhash import keep_one


def _documents(docs: DataFrame) -> DataFrame:
    """Just the columns of documents: further ones of any name are left out."""
    return own_columns(docs, *DOCUMENT_COLUMNS)


def _with_text(docs: DataFrame) -> DataFrame:
    return _documents(docs.withColumn("n_chars", F.length("text").cast("long")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without their failing lines and unfinished sentences."""
    kept = quality(_documents(docs), LineRules(by_sentence=True)).where("kept").drop("text").withColumnRenamed("clean_text", "text")
    return _with_text(kept)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document has; one that loses all its words this way goes."""
    cleaned = drop_recurring(_documents(docs), by_similarity=True).where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return _with_text(cleaned)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near copies."""
    return keep_one(_documents(docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All sources with an equal share of the characters, documents repeated by their counts, shuffled."""
    return _documents(mix_sources(_documents(docs)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document: its place in the sequences."""
    return pack(_documents(docs))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("source_mixing", source_mixing), ("packing", packing)]

#: Engine hashes and a tokenizer decide here: tests/llm/test_pipeline.py holds the rows against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

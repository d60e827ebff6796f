"""A training-data pipeline: quality rules, line dedup, near-dedup, mixing and byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; run() writes each
result as Parquet in the shared folder and reads it back as the next stage's docs, and removes tables
that no later stage reads.  Columns besides doc_id, text, lang, source and n_chars pass through all stages
but the last.  An empty table gives empty results in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatefold.llm.byte_bpe import encode_documents
from gatefold.llm.common import discard, importable, stored, table
from gatefold.llm.line_dedup import line_dedup
from gatefold.llm.mixing import mixed_sample
from gatefold.llm.near_dedup import near_duplicates
from gatefold.llm.quality import quality_filter


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base counts or lie outside their language's perplexity band go.

    Null and empty texts fail; null and rare languages share one band; repeated rows share their verdict.
    """
    importable(spark)
    return quality_filter(docs).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents share stay in the smallest doc_id alone; n_chars follows the text.

    A null text stays null; rows of one doc_id are one document; a document that loses all lines stays, with an empty text.
    """
    out = line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the smallest doc_id stays.

    Documents without words and rows with a null doc_id stay; rows of one doc_id stay or go together.
    """
    importable(spark)
    gone = near_duplicates(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the tempered source, language and topic shares.

    Null is a value of its own in each; documents without words stay; rows of one doc_id and cell stay or go together.
    """
    return mixed_sample(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and token ids of every document, each decoded again and compared with its text.

    A null or empty text has no ids; repeated rows are encoded each.
    """
    importable(spark)
    return encode_documents(docs, check=True).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_stage), ("near_dedup", near_stage), ("mixing", mixing_stage), ("byte_bpe", bpe_stage)]

#: The perplexity bands and near-duplicates aren't expressible in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        before, docs = docs, stored(out, f"pipeline-{name}")
        if k:
            discard(before)
    return docs

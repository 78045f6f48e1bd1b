"""A corpus pipeline of five operators, each stage written and read again.

Quality rules drop documents, line dedup cuts repeated lines, the n-gram join
keeps one text of each near-duplicate class, substring dedup cuts repeated
passages, and packing lays the tokens of what is left into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import jaccard, lines, packing, quality, substring
from strata.llm.common import Scratch, prepare
from strata.llm.queries import BYTE_BPE


def _with_text(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The columns of ``docs``, the text replaced by what is kept of it;
    documents that lost all their words go."""
    text = F.col("kept_text")
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return kept.where(F.size(quality.words_of(text)) > 0).select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality.judge(docs).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line repeats."""
    kept = lines.remove_lines(docs)
    same = F.col("n_removed") == 0
    return _with_text(docs, kept.withColumn("kept_text", F.when(same, F.col("text")).otherwise(F.col("kept_text"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each class of near-duplicate texts, that with the smallest
    doc_id. Texts under one doc_id are classed apart; of rows that repeat a
    doc_id and a text the smallest by all columns stays. Rows with a null
    doc_id stay whole and are no one's copy."""
    prepare(spark)
    first = jaccard.representatives(docs).toDF("__doc", "__copy")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("__doc"), F.xxhash64(F.col("text").cast("string")).alias("__copy"))
    kept = rows.join(first, ["__doc", "__copy"], "left_semi").groupBy("__doc", "__copy").agg(F.min("row").alias("row"))
    return kept.select("row.*").unionByName(docs.where("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words that a smaller doc_id has;
    documents that lose nothing keep their text as it is."""
    prepare(spark)
    kept = substring.remove_repeats(docs)
    same = F.col("n_removed") == 0
    return _with_text(docs, kept.withColumn("kept_text", F.when(same, F.col("text")).otherwise(F.col("kept_text"))))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their ids and places in sequences,
    and the CRC-32 of the ids."""
    prepare(spark)
    return packing.pack(docs, BYTE_BPE).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Packing takes a tokenizer, which SQL lacks; tests hold every stage against
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the packed pieces with their ids."""
    scratch = Scratch(prepare(spark), "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{i}")
        if i:
            scratch.drop(f"stage{i - 1}")
    return STAGES[-1][1](spark, docs, sf_dir).drop("ids_crc32")

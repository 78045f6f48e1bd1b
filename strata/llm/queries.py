"""The registered queries of the operators and their DuckDB SQL.

Every query reads its whole table. Digest columns are derived here from the
operators' texts and ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, chat, differencing, interactions, jaccard, lines, merkle, packing, quality, rollups, substring, topk, warc
from strata.llm.common import prepare

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(text) -> F.Column:
    return F.sha2(F.col(text).cast("binary") if isinstance(text, str) else text.cast("binary"), 256)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(_table(spark, sf_dir, "documents"), BYTE_BPE))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", _sha256("kept_text").alias("kept_sha256"))


def op3_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_documents(_table(spark, sf_dir, "documents"), WORD_BPE)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), _sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
                      _sha256("decoded").alias("decoded_sha256"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(_table(spark, sf_dir, "conversations"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.maintained_counts(_table(spark, sf_dir, "documents"), BYTE_BPE)


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents")).select("doc_id", *quality.FEATURES, "base_failed", "kept")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.remove_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", _sha256(F.coalesce("kept_text", F.lit(""))).alias("kept_sha256"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_differencing_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = differencing.pack(_table(spark, sf_dir, "documents"), WORD_BPE)
    return out.select(*[F.crc32("ids").alias("ids_crc32") if c == "ids" else c for c in out.columns])


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_best_fit_packing, op2_substring_dedup, op3_bpe_encoding, op4_chat_formatting, op5_token_counts,
        op6_exact_topk, op7_quality_rules, op8_line_dedup, op9_warc, op10_ngram_jaccard_join, op11_filter_interactions,
        op12_differencing_packing, op13_merkle_manifest)}


#: Packing, tokenizers and the 128-bit windows of long texts are beyond SQL, or
#: too slow in it over whole tables: op1, op3, op5 and op12 have none.
def oracle_sql() -> dict[str, str]:
    return {"op2_substring_dedup": substring.SQL, "op4_chat_formatting": chat.SQL, "op6_exact_topk": topk.SQL, "op7_quality_rules": quality.SQL,
            "op8_line_dedup": lines.SQL, "op9_warc": warc.SQL, "op10_ngram_jaccard_join": jaccard.SQL,
            "op11_filter_interactions": interactions.SQL, "op13_merkle_manifest": merkle.SQL}

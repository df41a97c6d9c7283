"""Registered queries of the text operators, with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcast.llm import bpe, chat, crosstoken, divergence, graphs, jaccard, knn, langid, lines, lm, mixing, secrets, warc
from cohortcast.llm.common import table
from cohortcast.llm.vectors import divisible

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BYTE_LEVEL, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score(table(spark, sf_dir, "documents"), lm.fold_of())
    return scored.select("doc_id", (F.col("fold") == lm.HELD_OUT).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


#: Texts that hold the template's own control strings.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(CONTROL_TEXT).alias("text"))
    return chat.read_back(chat.format_windows(turns.unionByName(added)))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "epoch")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op7_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphs.search(table(spark, sf_dir, "embeddings"), divisible(20), k=20)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op9_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.search(table(spark, sf_dir, "embeddings"), divisible(100), k=10)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.audit(table(spark, sf_dir, "pages"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path(BYTE_LEVEL), encoding="utf-8") as a, open(public_tokenizers.path(PIECE_MODEL), "rb") as b:
        return crosstoken.score(table(spark, sf_dir, "documents"), a.read(), b.read())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {f.__name__: f for f in (op1_line_dedup, op2_byte_bpe, op3_lm_score, op4_chat_windows, op5_mixing,
                                   op6_jaccard_join, op7_graph_ann, op8_secret_scan, op9_voronoi_knn, op10_language_id,
                                   op11_warc_revisits, op12_source_divergence, op13_cross_tokenizer)}
    return {**named, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**own, "op1_line_dedup": lines.ORACLE, "op4_chat_windows": chat.oracle(CONTROL_TEXT), "op5_mixing": mixing.oracle(),
            "op6_jaccard_join": jaccard.ORACLE, "op9_voronoi_knn": knn.ORACLE, "op11_warc_revisits": warc.ORACLE, "op12_source_divergence": divergence.ORACLE}

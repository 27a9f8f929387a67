"""The registered queries of this package: each applies its operator to whole tables and shapes the columns asked for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_folder
from . import bpe, chat, ctw, huffman, importance, lines, packing, partenum, rules, search, simhash, syncmers, tokens, toxicity
from .common import fold, read_table, work_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    training = read_table(spark, folder, "labels").where(fold(F.col("doc_id"), 3) != 1)
    scored = toxicity.score(read_table(spark, folder, "documents"), training)
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


@query("op2_bpe_round_trip")
def op2_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_text=False)


@query("op3_syncmer_fingerprints")
def op3_syncmer_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.compare_with_next(read_table(spark, folder, "documents"))


@query("op4_token_files")
def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    encoded = work_table(tokens.token_rows(read_table(spark, folder, "documents"), tokenizer, end_id=2), "ids")
    path = new_folder(spark, "llm-token-files")
    huffman.write_files(encoded, tokens.id_width(tokens.tokenizer_json(tokenizer)), path)
    return huffman.read_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op6_quality_rules", rules.judge_sql())
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(read_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_context_tree_scores")
def op7_context_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    scored = ctw.score(docs, fold(F.col("doc_id"), 7) != 2)
    return scored.select("doc_id", (fold(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op8_chat_role_repair")
def op8_chat_role_repair(spark: SparkSession, folder: str) -> DataFrame:
    repaired = chat.repair(read_table(spark, folder, "conversations"))
    return repaired.select("conv_id", "turn", "role", "action", "new_role", "inserted", "cost", F.length("fragment").cast("long").alias("fragment_chars"),
                           F.sha2(F.col("fragment").cast("binary"), 256).alias("fragment_sha256"))


@query("op9_ngram_jaccard_join")
def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return partenum.join(read_table(spark, folder, "documents"), size=4, percent=85)


@query("op10_line_dedup")
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.dedup(read_table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "n_links", F.length("text").cast("long").alias("kept_chars"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op11_importance_resampling", importance.resample_sql())
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = importance.resample(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_ranked_search", search.search_sql())
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query("op13_simhash_pivots")
def op13_simhash_pivots(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, folder, "documents"))

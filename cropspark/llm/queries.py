"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropspark.llm import (
    corpus_oracles,
    decontamination,
    embedding_near_dedup,
    fill_in_middle,
    line_dedup,
    lm_scoring,
    minhash_near_dedup,
    quality_rules,
    sentencepiece,
    suffix_array_dedup,
    token_alignment,
    token_counts,
    token_output,
    warc,
)
from cropspark.session import scratch_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.matches(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_pages(_table(spark, folder, "pages"), path)
    return warc.page_payloads(warc.read_records(spark, path))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = sentencepiece.load_model(public_tokenizers.path("piece_bpe_32k.model"))
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    back = sentencepiece.decode(sentencepiece.encode(docs, model), model)
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), sentencepiece.BLANK, " ")
    return back.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", same.alias("round_trip"))


def op5_token_output(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "sequences")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_output.write_sequences(_table(spark, folder, "documents"), path, tokenizer, public_tokenizers.PATTERN, end_id=2)
    return token_output.read_documents(spark, path)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = line_dedup.dedup_lines(_table(spark, folder, "documents"))
    return done.select(
        "doc.doc_id", F.col("text_left").alias("text"), "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines"
    )


def op7_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_near_dedup.near_duplicates(_table(spark, folder, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = suffix_array_dedup.remove_repeats(_table(spark, folder, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score(_table(spark, folder, "documents"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "flat-tokens")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    token_counts.write_flat(_table(spark, folder, "documents"), path, ranks, public_tokenizers.PATTERN, end_id=50256)
    return token_counts.count_tokens(spark, path, end_id=50256).select("document", "start", "n_tokens", "ended")


def op11_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_near_dedup.near_duplicates(_table(spark, folder, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    done = fill_in_middle.transform(_table(spark, folder, "documents"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")
    )


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    first, second = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    done = token_alignment.align(_table(spark, folder, "documents"), first, second)
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_quality_rules": op2_quality_rules,
    "op3_warc": op3_warc,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_token_output": op5_token_output,
    "op6_line_dedup": op6_line_dedup,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_token_counts": op10_token_counts,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_token_alignment": op13_token_alignment,
}

_STOPS = "[" + ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS)) + "]"
_BULLETS = ", ".join(f"'{b}'" for b in quality_rules.BULLETS)
ORACLES = {
    "op2_quality_rules": corpus_oracles.QUALITY_RULES.replace("{stops}", _STOPS).replace("{bullets}", _BULLETS),
    "op3_warc": corpus_oracles.WARC,
    "op6_line_dedup": corpus_oracles.LINE_DEDUP,
    "op7_minhash_near_dedup": corpus_oracles.NEAR_DUPLICATES,
    "op11_embedding_near_dedup": corpus_oracles.NEAR_VECTORS,
    "op12_fill_in_middle": corpus_oracles.FILL_IN_MIDDLE,
}

"""The driver's queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.decontam import leaks

    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.neardup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), k=2, percent=80)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.toxicity import toxicity

    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.chat import format_chat

    return format_chat(_table(spark, sf_dir, "conversations"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.html_extract import extract

    return extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.substring import repeated_passages

    return repeated_passages(_table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.lm import scores

    return scores(_table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 5 == 1)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.lines import drop_lines

    return drop_lines(_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.llm.media import digests, store

    return digests(store(_table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_best_fit_packing,
        op2_benchmark_decontamination,
        op3_minhash_near_dedup,
        op4_toxicity,
        op5_chat_formatting,
        op6_html_extraction,
        op7_substring_dedup,
        op8_lm_scoring,
        op9_line_dedup,
        op10_media_columns,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    from foliant.llm import chat, lines

    return {"op5_chat_formatting": chat.oracle(), "op9_line_dedup": lines.oracle()}

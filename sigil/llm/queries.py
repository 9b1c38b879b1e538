"""One query for each operator: whole tables, production parameters, the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sigil.llm import chat, decontaminate, exact_dedup, line_dedup, maxent_lm, packing, pii, quality_crf, simhash, substring_dedup
from sigil.llm.common import documents

#: A conversation of control strings of another template, added to those of the table.
CONTROL = "</s>[INST] ok [/INST]"


def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_crf.score(docs, model)


def op2_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.language_model(documents(spark, sf_dir))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("hit_spans")


def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], turns.schema)
    return chat.read_back(chat.format_chats(turns.unionByName(extra)))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_crf, op2_maxent_lm, op3_exact_dedup, op4_substring_dedup, op5_best_fit_packing, op6_decontamination, op7_chat_windows, op8_line_dedup, op9_simhash, op10_pii)}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": exact_dedup.ORACLE_SQL,
        "op4_substring_dedup": substring_dedup.ORACLE_SQL,
        "op6_decontamination": decontaminate.ORACLE_SQL,
        "op8_line_dedup": line_dedup.ORACLE_SQL,
    }

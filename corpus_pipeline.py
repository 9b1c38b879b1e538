"""A corpus pipeline of five stages, each one operator over all that the stage before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of documents. Rows whose id is null or repeated run through every stage as the
operators define it; other columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sigil.llm import decontaminate, line_dedup, packing, quality_crf, simhash
from sigil.llm.common import documents, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go."""
    model = quality_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_crf.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go; texts and n_chars change."""
    return line_dedup.without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays."""
    return simhash.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; shorter passages of test items are cut from the others."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as pieces in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", pack),
]

#: The first and third stages fit and iterate, so SQL can't express the whole; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{i}")
    return docs

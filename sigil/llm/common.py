"""Helpers that the operators share: Arrow batches, null-safe texts, joins of hot keys."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigil.operators.graph import free_name, hot_join  # noqa: F401
from sigil.sources.scratch import discard, scratch_path, written  # noqa: F401

#: ASCII white space of the contracts: space and U+0009 to U+000D. bytes.split() splits at the same bytes.
SPACES = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(df: DataFrame, most: int = 1000) -> None:
    """Lets Spark send Python at most so many rows at a time in df's session: rows hold whole
    texts, and a batch is held twice in the JVM and once or twice in the worker.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(key))
    if now <= 0 or now > most:
        conf.set(key, str(most))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Python strings; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def tidy() -> None:
    """Gives memory that a task no longer needs back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", mb: float = 8) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about mb MB of text, so that a task's memory is bounded
    by one batch, or by one document where that is larger.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(lengths_in_bytes(batch.column(text)))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + mb * 1e6, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    tidy()


def lengths_in_bytes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def crc_bucket(column: str, mod: int):
    """crc32 of an id's decimal text, modulo mod; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(mod))

"""Pages that arrive as files become candidates as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sigil.operators import candidates

PAGES = "page_id long, domain string, base_url string, html string"


def page_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(PAGES).parquet(path)


def write_choices(pages: DataFrame, path: str, checkpoint: str, policies: tuple[str, ...] = tuple(candidates.POLICIES)) -> StreamingQuery:
    """Appends the chosen candidates of every micro-batch to a table; a batch is written once."""

    def batch(df: DataFrame, number: int) -> None:
        candidates.choose(candidates.extract(df, policies)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

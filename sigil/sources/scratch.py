"""Scratch tables in the folder that all machines share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Where scratch tables go if a local session names no shared folder, as in tests.
DEFAULT_SCRATCH = "/tmp/checkpoints/sigil"
#: Spark drops the shuffle files of a query as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the session names in spark.checkpoint.dir. Without
    one a cluster has no place that all its machines see, so that is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = DEFAULT_SCRATCH
    return f"{base.rstrip('/')}/sigil-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, block_mb: int = 16) -> DataFrame:
    """Cuts the lineage: df as a Parquet table in the shared folder. A lost executor costs
    later readers nothing, and what the rows hold no longer depends on how they were made.
    """
    spark = df.sparkSession
    spark.conf.set(_CLEANUP, "true")
    path, schema = scratch_path(spark, name), df.schema
    df.write.option("compression", "zstd").option("parquet.block.size", block_mb << 20).parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more. Tables that a lazy result still reads stay."""
    for table in tables:
        path = table.__dict__.pop("scratch", None)
        if path:
            context = table.sparkSession.sparkContext
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)

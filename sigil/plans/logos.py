"""The whole way from images to groups, with every path and threshold a parameter."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigil.operators import graph, images, pairs
from sigil.sources.scratch import written


def indexed(features: DataFrame) -> DataFrame:
    """Features with site_idx, the place of the site in code-point order from 0, and the
    flags that pair scoring reads. Only names are ordered, over all partitions.
    """
    names = written(features.select("site").distinct().orderBy("site").withColumn("part", F.spark_partition_id()), "names")
    sizes = names.groupBy("part").count()
    offsets = sizes.select("part", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    numbered = names.withColumn("n", F.row_number().over(Window.partitionBy("part").orderBy("site"))).join(offsets, "part").select("site", (F.col("n") + F.col("offset") - 1).alias("site_idx"))
    return features.join(numbered, "site").withColumn("mask_ok", pairs.mask_valid(F.col("mask_cov"))).withColumn("is_mono", pairs.is_mono(F.col("s_med"), F.col("v_med")))


def matched(tiles: DataFrame, masks: DataFrame) -> DataFrame:
    """The tiles that have a mask of the same name; names are unique."""
    return tiles.join(masks.select("site"), "site", "left_semi")


def with_flags(features: DataFrame, masks: DataFrame, tiles: DataFrame) -> DataFrame:
    """features (site) with mask_cov of masks and s_med, v_med of tiles, and the flags that follow.
    What is missing counts as zero: such a mask is not valid, such a tile dark and plain.
    """
    joined = features.join(masks.select("site", "mask_cov"), "site", "left").join(tiles.select("site", "s_med", "v_med"), "site", "left").fillna(0.0, ["mask_cov", "s_med", "v_med"])
    return joined.withColumn("mask_ok", pairs.mask_valid(F.col("mask_cov"))).withColumn("is_mono", pairs.is_mono(F.col("s_med"), F.col("v_med")))


def similar(features: DataFrame, thresholds: pairs.Thresholds = pairs.Thresholds(), blocks: int | None = None) -> DataFrame:
    """Accepted edges between indexed features; the hash weights are of all of them."""
    weights = np.array(pairs.bit_weights(features, "ph").first()["weights"])
    return pairs.block_pairs(features.select("site_idx", "ph", "mph", "mp_h", "mp_v", "hu", "border", "dt", "mask_ok", "is_mono"), weights, thresholds, blocks)


def grouped(features: DataFrame, edges: DataFrame, k: int = graph.KNN, m: int = graph.TRIANGLE_M) -> DataFrame:
    """site, group_id for every site."""
    joined = graph.linked(edges, k, m)
    nodes = features.select(F.col("site_idx").alias("node"), "site")
    found = graph.numbered_groups(graph.components(joined.select("i", "j"), nodes.select("node")))
    return nodes.join(found, "node").select("site", F.col("group_id").cast("int").alias("group_id"))


def run(spark: SparkSession, image_path: str, thresholds: pairs.Thresholds = pairs.Thresholds(), blocks: int | None = None) -> dict[str, DataFrame]:
    """manifest, features, edges and groups of a folder of images."""
    manifest = written(images.preprocess_images(images.read_images(spark, image_path)), "manifest")
    features = written(indexed(images.image_features(manifest)), "features")
    edges = written(similar(features, thresholds, blocks), "edges")
    return {"manifest": manifest, "features": features, "edges": edges, "groups": grouped(features, edges)}

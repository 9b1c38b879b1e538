"""Similarity graphs: neighbour ranks, mutual neighbours, triangle support, components, groups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigil.sources.scratch import discard, written

KNN, TRIANGLE_M = 12, 20


def symmetric(edges: DataFrame, score: str = "rank_score") -> DataFrame:
    """Both directions of edges (i, j): src, dst, score. One pass over the edges gives both."""
    ends = F.array(F.struct(F.col("i").alias("src"), F.col("j").alias("dst")), F.struct(F.col("j").alias("src"), F.col("i").alias("dst")))
    return edges.select(F.explode(ends).alias("e"), F.col(score).alias("score")).select("e.src", "e.dst", "score")


def top_neighbors(both: DataFrame, k: int) -> DataFrame:
    """The k best neighbours of each node; equal scores go by the smaller neighbour."""
    best = Window.partitionBy("src").orderBy(F.desc("score"), "dst")
    return both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mutual(top: DataFrame) -> DataFrame:
    """Pairs i < j that are in each other's lists: those that stand there twice."""
    pairs = top.groupBy(F.least("src", "dst").alias("i"), F.greatest("src", "dst").alias("j")).agg(F.count(F.lit(1)).alias("n"))
    return pairs.where("n = 2").select("i", "j")


def triangles(edges: DataFrame, top: DataFrame) -> DataFrame:
    """Edges (i, j) whose ends share a neighbour, other than themselves, in their lists. The
    lists are of a bounded length, so the join adds that factor at most.
    """
    lists = top.groupBy("src").agg(F.collect_set("dst").alias("near"))
    pairs = edges.select("i", "j").join(lists.select(F.col("src").alias("i"), F.col("near").alias("a")), "i").join(lists.select(F.col("src").alias("j"), F.col("near").alias("b")), "j")
    shared = F.array_except(F.array_intersect("a", "b"), F.array("i", "j"))
    return pairs.where(F.size(shared) > 0).select("i", "j")


def linked(edges: DataFrame, k: int = KNN, m: int = TRIANGLE_M) -> DataFrame:
    """Edges that join groups, with the rule: mutual neighbours; or, unless both marks are
    dark and plain (mono), a shared neighbour. The edges, which are costly to make, are written
    once; ranks and flags read that table.
    """
    edges = written(edges, "edges")
    # One ranking serves both list lengths.
    ranked = top_neighbors(symmetric(edges), max(k, m))
    mk = mutual(ranked.where(F.col("rank") <= k)).withColumn("mk", F.lit(True))
    tri = triangles(edges, ranked.where(F.col("rank") <= m)).withColumn("tri", F.lit(True))
    flagged = edges.join(mk, ["i", "j"], "left").join(tri, ["i", "j"], "left").fillna(False, ["mk", "tri"])
    rule = F.when(F.col("mono") & F.col("mk"), "mono_mutual_knn").when(F.col("mk"), "mutual_knn").when(~F.col("mono") & F.col("tri"), "triangle")
    return flagged.withColumn("rule", rule).where("rule IS NOT NULL").drop("mk", "tri")


def free_name(taken: Iterable[str], name: str) -> str:
    """A column name like the given one that no input column has."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name += "_"
    return name


def hot_join(left: DataFrame, right: DataFrame, key: str, spread: str, salts: int = 32, share: int = 1000, total: int | None = None) -> DataFrame:
    """left inner join right on key, where right has each key once and left may hold a key in
    a large part of its rows. A key of more than one in `share` rows is hot; there are fewer
    than `share` of those, so they are broadcast. Their rows are dealt by a salt made of the
    column `spread`, and their row of right is repeated for each salt. Null keys don't match.
    """
    salt, hot_key = free_name([*left.columns, *right.columns], "salt"), free_name([*left.columns, *right.columns], "hot_key")
    total = left.count() if total is None else total
    hot = F.broadcast(left.groupBy(F.col(key).alias(hot_key)).count().where((F.col("count") * share > total) & (F.col("count") > share)).select(hot_key))
    dealt = left.join(hot, left[key] == F.col(hot_key), "left").withColumn(salt, F.when(F.col(hot_key).isNotNull(), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(0).cast("int")).drop(hot_key)
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = right.join(hot, right[key] == F.col(hot_key), "left").withColumn(salt, F.explode(F.when(F.col(hot_key).isNotNull(), every).otherwise(F.array(F.lit(0))))).drop(hot_key)
    return dealt.join(copies, [key, salt]).drop(salt)


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node of edges (a, b), a > b, is either a centre or a leaf of one centre."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def stars(edges: DataFrame, name: str = "stars") -> DataFrame:
    """a, b: every node but the smallest of its component, and that smallest node, for edges (i, j).

    Alternating large and small stars (Kiveris et al., 2014): every round links each node's
    neighbours to their smallest, until all edges are stars. A node's neighbours are never
    gathered: minima are aggregates, and rewiring is a join on them, where the edges of a node
    that holds a thousandth of them or more are dealt by a salt. Each round is a written table.
    """
    current = written(edges.where("i <> j").select(F.greatest("i", "j").alias("a"), F.least("i", "j").alias("b")).distinct(), name)
    while not _is_stars(current):
        n = current.count()
        both = symmetric(current.select(F.col("a").alias("i"), F.col("b").alias("j"), F.lit(0).alias("s")), "s").select(F.col("src").alias("a"), F.col("dst").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = written(hot_join(both.where("b > a"), low, "a", "b", total=n).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), name)
        # Small stars: b < a in every edge now.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = hot_join(large, least, "a", "b", total=n).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        after = written(pairs.where("a <> b").distinct(), name)
        discard(current, large)
        current = after
    return current


def components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """node, comp: the smallest node that edges (i, j) reach. Nodes without edges are
    components of their own.
    """
    current = stars(edges)
    found = current.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    if nodes is None:
        return found.unionByName(found.select(F.col("comp").alias("node")).distinct().withColumn("comp", F.col("node")))
    # A centre is its own component, as is a node without edges.
    return nodes.select("node").join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def numbered_groups(found: DataFrame) -> DataFrame:
    """node, group_id: components numbered 1.. by their smallest node. Only the distinct
    component ids are ranked: sorted over all partitions, counted, and given offsets.
    """
    ids = written(found.select("comp").distinct().orderBy("comp").withColumn("part", F.spark_partition_id()), "numbers")
    sizes = ids.groupBy("part").count()
    offsets = sizes.withColumn("offset", F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).select("part", F.coalesce("offset", F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy("comp")
    ranked = ids.withColumn("n", F.row_number().over(within)).join(offsets, "part").select("comp", (F.col("n") + F.col("offset")).alias("group_id"))
    return found.join(ranked, "comp").select("node", "group_id")


def group_members(groups: DataFrame, name: str = "site") -> DataFrame:
    """group_id, members in order."""
    return groups.groupBy("group_id").agg(F.array_sort(F.collect_list(name)).alias("members"))


def group_sizes(groups: DataFrame, top: int | None = 25) -> DataFrame:
    """group_id and size, the largest first."""
    sizes = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("size"), "group_id")
    return sizes.limit(top) if top else sizes


def group_edges(links: DataFrame, groups: DataFrame, group_id: int, limit: int | None = None) -> DataFrame:
    """The links inside one group, with their scores and rules."""
    inside = groups.where(F.col("group_id") == group_id).select("node")
    out = links.join(inside.withColumnRenamed("node", "i"), "i", "left_semi").join(inside.withColumnRenamed("node", "j"), "j", "left_semi").orderBy("i", "j")
    return out.limit(limit) if limit else out


def mono_pair(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(False)) & F.coalesce(b, F.lit(False))

"""Exact deduplication with DataFrame operations only.

A group of copies may hold a third of all rows, so no group meets in one task before it
has shrunk. (1) Each map task combines its copies: a group is a digest, a salt and the whole
text, with the ids of its members. Groups are merged on all three. Only the most frequent
texts have salts, as many as the square root of their copies, so a salted group has about as
many members as the text has salts. (2) The salt winners of a frequent text are merged
globally on digest and whole text. (3) The winner goes back to the salted groups, again on
digest and whole text. Every row then is a member of its group: texts travel once, and no
stage goes by a digest alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts of more copies than HOT have salts; if there are more such texts than MOST, the most
#: frequent ones, so no unsalted group has more than a part in MOST of all rows.
HOT, MOST = 1000, 10_000


def normalized(text: Column) -> Column:
    """Every run of white space as one space. Single spaces already are what they become,
    so the pattern leaves them out and the replacement rarely runs.
    """
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, most: int = MOST) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts are empty texts. A null id never stays while its group has another id; in a
    group of null ids only, all rows are marked kept and keep_id is null. Rows that repeat
    an id and a text count singly in group_size and share one decision. An empty table
    gives an empty table. Other input columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), normalized(F.col(text_col)).alias("body")).withColumn("digest", F.xxhash64("body"))
    # At most MOST rows of two numbers.
    frequent = rows.groupBy(F.col("digest").alias("hot_digest")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).orderBy(F.desc("n"), "hot_digest").limit(most)
    # Rows without an id, or of one id, are spread by their partition.
    salt = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.ceil(F.sqrt("n"))) + 1
    dealt = rows.join(F.broadcast(frequent), F.col("digest") == F.col("hot_digest"), "left").withColumn("salt", F.coalesce(salt, F.lit(0)))
    # The salt once more as an aggregate: what is asked of it later leaves the groups' plan, and so their one shuffle, as it is.
    groups = dealt.groupBy("digest", "salt", "body").agg(F.min("doc_id").alias("first"), F.collect_list(F.struct("doc_id")).alias("members"), F.max("salt").alias("dealt"))
    groups = groups.select("digest", "body", "first", "members", F.size("members").cast("long").alias("size"), "dealt")
    salted = groups.where("dealt > 0")
    winners = salted.groupBy("digest", "body").agg(F.min("first").alias("keep_id"), F.sum("size").alias("group_size"))
    # All three readers of the groups ask for the same aggregates, so they share one shuffle.
    handed = salted.join(winners, ["digest", "body"]).withColumn("keep_id", F.least("keep_id", "first"))
    whole = groups.where("dealt = 0").select("members", "body", F.col("first").alias("keep_id"), F.col("size").alias("group_size"))
    found = whole.unionByName(handed.select("members", "body", "keep_id", "group_size"))
    named = found.select(F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size", F.explode("members").alias("member"))
    return named.select(F.col("member.doc_id").alias("doc_id"), "keep_id", "group_size", F.col("member.doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY body) AS kept, sha256(body) AS text_sha256
FROM d
"""

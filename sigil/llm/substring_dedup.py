"""Substring deduplication: removes words covered by later occurrences of repeated 20-word windows,
which are the deep nodes of suffix trees (see suffix_trees).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigil.llm.repeats import CHUNK, GROUP, WORDS
from sigil.llm.suffix_trees import remove_repeated

WINDOW = 20


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, size: int = CHUNK, group: int = GROUP) -> DataFrame:
    """One row per input row: doc_id, text (the kept words, joined by one space), n_words,
    n_removed, kept_sha256. Words are runs of anything but ASCII white space. Edge cases as
    in repeats.remove_repeats(); other columns are ignored, whatever their names.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    found = remove_repeated(rows, WORDS.of(window), "doc_id", "text", size, group)
    return found.select("doc_id", "text", F.col("n_symbols").alias("n_words"), "n_removed", F.sha2("text", 256).alias("kept_sha256"))


#: Windows are numbered in order; a word goes if a later occurrence covers it.
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS a FROM documents),
w AS (SELECT doc_id, a, unnest(range(1, len(a) - {WINDOW} + 2)) AS s FROM d),
r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(a[s : s + {WINDOW} - 1], ' ') ORDER BY doc_id, s) AS n FROM w),
gone AS (SELECT DISTINCT doc_id, s + o AS s FROM (SELECT doc_id, s, unnest(range({WINDOW})) AS o FROM r WHERE n > 1)),
words AS (SELECT doc_id, unnest(a) AS word, unnest(range(1, len(a) + 1)) AS s FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY s) AS body, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, s) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(a) AS BIGINT) AS n_words, CAST(len(a) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

"""Line deduplication: windows of three consecutive lines, overlapping; later occurrences go.

Lines end at a line feed and are compared without white space at their ends. Every line
covered by a window whose three lines also start earlier (smaller document id, or earlier
in the same document) is removed; overlapping windows merge. Documents of fewer than three
lines have no window and stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigil.llm.common import free_name
from sigil.llm.repeats import GROUP, LINES, remove_repeats

WINDOW = 3
#: Lines in a chunk.
CHUNK = 1 << 13


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, size: int = CHUNK, group: int = GROUP) -> DataFrame:
    """One row per input row: doc_id, text (the kept lines), n_lines, n_removed. A null or
    empty text is one empty line. Edge cases as in repeats.remove_repeats().
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    found = remove_repeats(rows, LINES.of(window), "doc_id", "text", size, group)
    return found.select("doc_id", "text", F.col("n_symbols").alias("n_lines"), "n_removed")


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns of docs, with repeated lines taken from text_col; length_col, if
    there is one of that name, holds the new length. A document whose lines all go stays
    with an empty text.
    """
    names = {c: free_name(["n_symbols", "n_removed", *docs.columns], c) for c in docs.columns if c.lower() in ("n_symbols", "n_removed")}
    renamed = docs.withColumnsRenamed(names)
    found = remove_repeats(renamed, LINES, names.get(id_col, id_col), text_col, CHUNK, GROUP).drop("n_symbols", "n_removed")
    found = found.withColumnsRenamed({v: k for k, v in names.items()})
    if length_col in docs.columns:
        found = found.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return found.select(*docs.columns)


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
k AS (SELECT doc_id, a, list_transform(a, lambda x: regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) AS b FROM d),
w AS (SELECT doc_id, b, unnest(range(1, len(b) - {WINDOW} + 2)) AS s FROM k),
r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY b[s : s + {WINDOW} - 1] ORDER BY doc_id, s) AS n FROM w),
gone AS (SELECT DISTINCT doc_id, s + o AS s FROM (SELECT doc_id, s, unnest(range({WINDOW})) AS o FROM r WHERE n > 1)),
lines AS (SELECT doc_id, unnest(a) AS line, unnest(range(1, len(a) + 1)) AS s FROM d),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY s) AS body, count(*) AS n FROM lines ANTI JOIN gone USING (doc_id, s) GROUP BY doc_id)
SELECT d.doc_id, coalesce(body, '') AS text, CAST(len(a) AS BIGINT) AS n_lines, CAST(len(a) - coalesce(n, 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN kept USING (doc_id)
"""

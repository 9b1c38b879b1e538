"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton is built over item words and shipped to the tasks; training words stream
through it while it tracks the longest match that ends at each word. A match of at least
`window` words ends an item window; a whole item shorter than that is a window itself.

A word that no item has, or a pair of neighbours that no item has, ends every match. So
each text is cut there first, with numpy, and only stretches long enough for a window are
streamed.

Items are dealt into automata of a bounded number of words. A round broadcasts at most
ROUND_AUTOMATA of them, and a worker takes some MB of text through one after the other, so it
holds one at a time and reads each again only for the next so many MB. A benchmark of more
automata takes more rounds over the documents, each from a written table, so what is broadcast
at once is bounded whatever the benchmark's size; the driver holds one automaton's items.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from sigil.llm.common import discard, free_name, slices, small_batches, texts_of, written

WINDOW = 13
#: A document counts as contaminated if 1 / COVERAGE of its words or more are hit.
COVERAGE = 20
#: Words of the items in one automaton; a word takes up to two states of some 250 bytes each.
AUTOMATON_WORDS = 250_000
#: Automata in one round, and MB of text that go through them together if there are several.
ROUND_AUTOMATA = 8
ROUND_MB = 48

#: Lower-cases A-Z, keeps digits, letters and all bytes of characters beyond ASCII, and makes the rest spaces.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: The same words in place.
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_NORMAL).split()


class Automaton:
    """A generalised suffix automaton over word numbers, with the items of each window."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names: list[str] = []
        held: list[set[int]] = [set()]
        short: dict[int, list[int]] = {}
        pairs: set[int] = set()
        self.shortest = window
        sequences = []
        for name, words in items:
            if not words:
                continue
            sequence = [self.ids.setdefault(w, len(self.ids)) for w in words]
            number, last = len(self.names), 0
            self.names.append(name)
            sequences.append(sequence)
            self.shortest = min(self.shortest, len(sequence))
            pairs.update(a << 32 | b for a, b in itertools.pairwise(sequence))
            for word in sequence:
                last = self._extend(last, word, held)
        for number, sequence in enumerate(sequences):
            state = 0
            for i, word in enumerate(sequence):
                state = self.next[state][word]
                if i + 1 >= window:  # up the links to the state of this window
                    at = state
                    while self.length[self.link[at]] >= window:
                        at = self.link[at]
                    held[at].add(number)
            if len(sequence) < window:
                short.setdefault(state, []).append(number)
        self.items = [tuple(sorted(h)) for h in held]
        self.short = short
        #: For each state, the nearest one up its links, itself included, where a short item ends.
        self.near = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.near[state] = state if state in short else self.near[self.link[state]]
        self.pairs = np.array(sorted(pairs), np.int64)
        self.lone = {self.ids[w] for w in self.ids if self.next[0][self.ids[w]] in short and any(len(sequences[n]) == 1 for n in short[self.next[0][self.ids[w]]])}

    def _state(self, length: int, link: int, following: dict[int, int], held: list[set[int]]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        held.append(set())
        return len(self.next) - 1

    def _extend(self, last: int, word: int, held: list[set[int]]) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, word, q, held)
        new = self._state(self.length[last] + 1, 0, {}, held)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, word, q, held)
        return new

    def _clone(self, p: int, word: int, q: int, held: list[set[int]]) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]), held)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _stretches(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Where matches of two words or more can be, as [start, end), longest possible, in order."""
        known = ids >= 0
        if len(ids) < 2:
            return
        pair = ids[:-1].astype(np.int64) << 32 | ids[1:].astype(np.int64)
        at = np.searchsorted(self.pairs, pair) if len(self.pairs) else np.zeros(len(pair), int)
        joined = known[:-1] & known[1:]
        if len(self.pairs):
            joined &= self.pairs[np.minimum(at, len(self.pairs) - 1)] == pair
        else:
            joined[:] = False
        edge = np.flatnonzero(np.diff(np.concatenate(([0], joined.view(np.int8), [0]))))
        for start, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if end + 1 - start >= min(self.shortest, self.window):
                yield start, end + 1

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans [start, end) in words, merged and in order, and the numbers of the items with occurring windows."""
        ids = np.fromiter(map(self.ids.get, words, itertools.repeat(-1)), np.int32, len(words))
        found: list[tuple[int, int]] = []
        items: set[int] = set()
        if self.lone:
            for i in np.flatnonzero(np.isin(ids, list(self.lone))).tolist():
                found.append((i, i + 1))
                items.update(n for n in self.short[self.next[0][int(ids[i])]])
        for start, end in self._stretches(ids):
            state = matched = 0
            for i, word in enumerate(ids[start:end].tolist(), start):
                while state and word not in self.next[state]:
                    state = self.link[state]
                    matched = self.length[state]
                if word in self.next[state]:
                    state, matched = self.next[state][word], matched + 1
                at = state
                if matched >= self.window:
                    found.append((i + 1 - self.window, i + 1))
                    while self.length[self.link[at]] >= self.window:
                        at = self.link[at]
                    items.update(self.items[at])
                    at = self.link[at]
                # A short item ends here if its state is on the chain and its whole length is matched.
                at = self.near[at] if at else -1
                while at > 0:
                    if self.length[at] <= matched:
                        found.append((i + 1 - self.length[at], i + 1))
                        items.update(self.short[at])
                    at = self.near[self.link[at]] if self.link[at] > 0 else -1
        return merged(found), items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def automata(items: DataFrame, window: int, most_words: int) -> Iterator[Automaton]:
    """The items as automata of a bounded size; they stream to the driver one partition at a time. At least one."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text IS NOT NULL")
    part, size, made = [], 0, False
    for row in rows.toLocalIterator():
        words = words_of(row.text)
        if not words:
            continue
        if part and size + len(words) > most_words:
            yield Automaton(part, window)
            part, size, made = [], 0, True
        part.append(("" if row.item_id is None else row.item_id, words))
        size += len(words)
    if part or not made:
        yield Automaton(part, window)


def rounds(items: DataFrame, window: int, most_words: int, most: int) -> Iterator[list[Automaton]]:
    yield from map(list, itertools.batched(automata(items, window, most_words), most))


def judged(found: list[Broadcast], texts: list[str]) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
    """Of each text: number of words, merged hit spans in words, ids of the items sorted as
    strings. Of several automata a worker holds one at a time.
    """
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    names: list[set[str]] = [set() for _ in texts]
    sizes = [0] * len(texts)
    for shared in found:
        automaton = shared.value
        for k, text in enumerate(texts):
            words = words_of(text)
            own, items = automaton.spans(words)
            sizes[k] = len(words)
            spans[k] += own
            names[k].update(automaton.names[i] for i in items)
        if len(found) > 1:
            del automaton
            shared.__dict__.pop("_value", None)  # what Broadcast.value keeps
    for n, own, items in zip(sizes, spans, names, strict=True):
        yield n, merged(own), sorted(items)


def gathered(batches: Iterable[pa.RecordBatch], text: str, several: bool) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of a few MB of text; of ROUND_MB if there are several automata to read for each."""
    if not several:
        yield from slices(batches, text, mb=2)
        return
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in slices(batches, text, mb=ROUND_MB):
        held.append(batch)
        size += batch.nbytes
        if size > ROUND_MB * 1e6:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def judge(rows: DataFrame, items: DataFrame, text_col: str, columns: tuple[str, str, str], window: int, most_words: int, most: int) -> DataFrame:
    """rows with three more columns, named by `columns`: number of words, merged hit spans, sorted item ids."""
    small_batches(rows)
    context = rows.sparkSession.sparkContext
    out, held = rows, None
    schema = StructType([*rows.schema, StructField(columns[0], LongType()), StructField(columns[1], ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))), StructField(columns[2], ArrayType(StringType()))])
    for number, part in enumerate(rounds(items, window, most_words, most)):
        if number:
            before, out = held, written(out, "judged")
            discard(*([before] if before is not None else []))
            held = out
        shared = [context.broadcast(a) for a in part]
        del part

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, again=number > 0) -> Iterator[pa.RecordBatch]:
            for batch in gathered(batches, text_col, len(shared) > 1):
                found = list(judged(shared, texts_of(batch.column(text_col))))
                spans, names = [s for _, s, _ in found], [x for _, _, x in found]
                if again:
                    spans = [merged([*((s["start"], s["end"]) for s in old), *new]) for old, new in zip(batch.column(columns[1]).to_pylist(), spans, strict=True)]
                    names = [sorted({*old, *new}) for old, new in zip(batch.column(columns[2]).to_pylist(), names, strict=True)]
                kept = batch.select([c for c in batch.schema.names if c not in columns])
                more = [pa.array([n for n, _, _ in found], pa.int64()), pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], _SPANS), pa.array(names, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*kept.columns, *more], names=[*kept.schema.names, *columns])

        out = out.mapInArrow(scan, schema)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, coverage: int = COVERAGE, most_words: int = AUTOMATON_WORDS, most: int = ROUND_AUTOMATA) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated,
    and the hit spans as an array of (start, end) in words.

    Null and empty texts have no words and are clean; items without words match nothing;
    items that share an id count once. Null ids and repeated rows are kept; an empty table
    gives an empty table, an empty benchmark leaves all clean. Other columns are ignored.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    found = judge(rows, items, "text", ("n_words", "hit_spans", "names"), window, most_words, most)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    found = found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("names").cast("long").alias("n_items"), F.sha2(F.array_join("names", ","), 256).alias("items_sha256"), "hit_spans")
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", ((F.col("n_hit") > 0) & (coverage * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "hit_spans")


def cut_words(text: str, spans: Iterable[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    body = text.encode()
    at = [m.span() for m in _WORD.finditer(body)]
    kept, start = [], 0
    for first, end in spans:
        kept.append(body[start : at[first][0]])
        start = at[end - 1][1]
    return b"".join([*kept, body[start:]]).decode()


def left_of(text: str, n: int, spans: list[tuple[int, int]], window: int, coverage: int) -> str | None:
    """What stays of a text of n words: None where the hit words reach the coverage limit, else
    the text less all hit spans of at least a window.
    """
    hit = sum(e - s for s, e in spans)
    if hit and coverage * hit >= n:
        return None
    long = [(s, e) for s, e in spans if e - s >= window]
    return cut_words(text, long) if long else text


def cleaned(found: list[Broadcast], texts: list[str], window: int, coverage: int) -> list[str | None]:
    """Of each text what stays. It is judged again after a cut, as words that were apart may meet."""
    out: list[str | None] = list(texts)
    left = list(range(len(texts)))
    while left:
        after = [left_of(out[k], n, spans, window, coverage) for k, (n, spans, _) in zip(left, list(judged(found, [out[k] for k in left])), strict=True)]
        changed = [k for k, new in zip(left, after, strict=True) if new is not None and new != out[k]]
        for k, new in zip(left, after, strict=True):
            out[k] = new
        left = changed
    return out


def _replaced(batch: pa.RecordBatch, after: list[str | None], text_col: str, length_col: str | None) -> pa.RecordBatch:
    """The batch without the rows that have no text after, and with the texts after; unchanged ones stay null or as they are."""
    before = batch.column(text_col).to_pylist()
    changed = [b if a is None or a == (b or "") else a for b, a in zip(before, after, strict=True)]
    if changed != before:
        names = batch.schema.names
        batch = batch.set_column(names.index(text_col), batch.schema.field(text_col), pa.array(changed, batch.schema.field(text_col).type))
        if length_col in names:
            old = batch.column(length_col)
            size = [o if c == b else len(c) for o, b, c in zip(old.to_pylist(), before, changed, strict=True)]
            batch = batch.set_column(names.index(length_col), batch.schema.field(length_col), pa.array(size, old.type))
    return batch.filter(pa.array([a is not None for a in after], pa.bool_()))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = WINDOW, coverage: int = COVERAGE, most_words: int = AUTOMATON_WORDS, length_col: str | None = "n_chars", most: int = ROUND_AUTOMATA) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns, less their hit spans.

    A document whose hit words reach the coverage limit goes as a whole. Below it, hit spans
    of at least `window` words are cut from the text, and length_col, if there is one of
    that name, holds the new length; hits of whole items shorter than a window stay. Rows
    without such spans are unchanged. Edge cases as in decontaminate().
    """
    small_batches(docs)
    context = docs.sparkSession.sparkContext
    first = list(itertools.islice(rounds(items, window, most_words, most), 2))
    if len(first) == 1:
        shared = [context.broadcast(a) for a in first[0]]

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in gathered(batches, text_col, len(shared) > 1):
                yield _replaced(batch, cleaned(shared, texts_of(batch.column(text_col)), window, coverage), text_col, length_col)

        return docs.mapInArrow(scan, docs.schema)
    del first
    # Several rounds: all of them judge, then the spans are cut, until no text changes.
    own = docs.columns
    names = tuple(free_name(own, c) for c in ("n_words", "hit_spans", "item_names", "was_cut"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, mb=2):
            before = texts_of(batch.column(text_col))
            spans = [[(s["start"], s["end"]) for s in x] for x in batch.column(names[1]).to_pylist()]
            after = [left_of(t, n, x, window, coverage) for t, n, x in zip(before, batch.column(names[0]).to_pylist(), spans, strict=True)]
            kept = batch.select(own).append_column(names[3], pa.array([a is not None and a != t for a, t in zip(after, before, strict=True)], pa.bool_()))
            yield _replaced(kept, after, text_col, length_col)

    while True:
        found = judge(docs, items, text_col, names[:3], window, most_words, most)
        out = written(found.mapInArrow(cut, StructType([*docs.schema, StructField(names[3], BooleanType())])), "cut")
        if out.where(F.col(names[3])).isEmpty():
            return out.drop(names[3])
        docs = out.drop(names[3])


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS a FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS a FROM benchmark),
iw AS (SELECT DISTINCT item, l, array_to_string(a[s : s + l - 1], ' ') AS w FROM (SELECT item, a, least(len(a), {WINDOW}) AS l, unnest(range(1, len(a) - least(len(a), {WINDOW}) + 2)) AS s FROM b WHERE len(a) > 0)),
dw AS (SELECT doc_id, l, s, array_to_string(a[s : s + l - 1], ' ') AS w FROM (SELECT doc_id, a, l, unnest(range(1, len(a) - l + 2)) AS s FROM d CROSS JOIN (SELECT DISTINCT l FROM iw))),
m AS (SELECT doc_id, l, s, item FROM dw JOIN iw USING (l, w)),
hit AS (SELECT doc_id, count(DISTINCT s + o) AS n FROM (SELECT doc_id, s, unnest(range(l)) AS o FROM m) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(a) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
 coalesce(hit.n, 0) > 0 AND {COVERAGE} * coalesce(hit.n, 0) >= len(a) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

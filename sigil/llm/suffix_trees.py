"""Prefix-partitioned suffix trees over words, cut at the window length.

A suffix tree of all documents has a node for every word sequence that occurs with two
different continuations; below a node of `window` words or more all suffixes share a window.
The tree is built in parts, and only where it is that deep:

1. Suffixes are dealt by variable-length prefixes (repeats.Plan) into groups of a bounded size.
   Paths, digests of four prefixes of a suffix up to the window, tell which suffixes of a group
   reach the depth of a window together with another one. Only these go on.
2. The groups count the occurrences of each such path, and whether the word before it is always
   the same. A window whose word before is always the same, and which occurs as often as the
   window one word earlier, only continues that one: it belongs to the same maximal repeat.
   All others are heads: the beginnings of maximal repeats, one for each chunk that has them.
3. The heads' words themselves go to their group. Its task sorts them, takes the common prefix
   lengths of neighbours (the suffix array of the subtree), and from these the internal nodes.
   A node of `window` words is a repeat; the first of its suffixes (smallest document id, then
   smallest start) stays, all others are later. How many further words every occurrence shares
   is known from 2, so a node stands for a maximal repeat.
4. Each chunk carries a head's answer along its maximal repeat, and removes what is covered by
   later windows. Within a chunk, windows are compared by word numbers.

Copies shrink before anything is sent: a chunk sends a path once, so a passage that a third of
all documents share gives a node as many suffixes as there are chunks, at most.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sigil.llm.common import discard, tidy, written
from sigil.llm.repeats import Chunk, Paths, Symbols, _bits, _groups, _marked, _planes, _ranks, _unplanes, chunks, is_numeric, paths, place_of, plan, shared_paths, without

#: Stages of the answers that a chunk gets.
_SHARED, _OCCURRENCES, _LATER = 1, 2, 3


def common_prefix(a: Sequence[bytes], b: Sequence[bytes]) -> int:
    return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def internal_nodes(suffixes: Sequence[Sequence[bytes]], least: int = 0) -> Iterator[tuple[int, int, int]]:
    """(depth, from, to) of the internal nodes of at least that depth, of sorted suffixes: all
    intervals of neighbours whose common prefix is longer than that of the interval's borders.
    """
    open_nodes: list[tuple[int, int]] = []  # depth, from
    depths = [common_prefix(a, b) for a, b in itertools.pairwise(suffixes)]
    for at, depth in enumerate([*depths, 0], 1):
        begin = at - 1
        while open_nodes and open_nodes[-1][0] > depth:
            deeper, begin = open_nodes.pop()
            if deeper >= least:
                yield deeper, begin, at
        if depth and (not open_nodes or open_nodes[-1][0] < depth):
            open_nodes.append((depth, begin))


def _left(found: Paths) -> np.ndarray:
    """Of each of starts: 32 bits of the word before, never 0; 0 at a document's start."""
    before = np.zeros(len(found.keys), np.uint32)
    before[1:] = (found.keys[:-1] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    counts = found.chunk.counts
    before[(np.cumsum(counts) - counts)[counts > 0]] = 0
    return before[found.starts]


def _own(found: Paths) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct window of the chunk: how often it occurs, and the word before it; 0 if that varies."""
    if not len(found.heads):
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    left = _left(found)
    low, high = np.minimum.reduceat(left, found.heads), np.maximum.reduceat(left, found.heads)
    return np.diff(np.append(found.heads, len(found.starts))), np.where(low == high, low, 0).astype(np.uint32)


def _occurrences(table: pa.Table) -> pa.Table:
    """For each window of a group that a chunk sent: occurrences in all chunks, and whether the word before is always the same."""
    tidy()
    rows = table.to_pylist()
    path = np.concatenate([np.cumsum(_unplanes(r["steps"], 6), dtype=np.uint64) for r in rows])
    second = np.concatenate([np.frombuffer(r["second"], "<u8") for r in rows])
    left = np.concatenate([np.frombuffer(r["left"], "<u4") for r in rows])
    n = np.concatenate([_unplanes(r["n"], 5).astype(np.int64) for r in rows])
    sizes = [len(r["left"]) // 4 for r in rows]
    by = np.lexsort((second, path))
    head = np.concatenate(([True], (path[by][1:] != path[by][:-1]) | (second[by][1:] != second[by][:-1])))
    at = np.flatnonzero(head)
    window = np.cumsum(head) - 1
    ordered = left[by]
    low, high = np.minimum.reduceat(ordered, at), np.maximum.reduceat(ordered, at)
    total, same = np.empty(len(by), np.int64), np.empty(len(by), bool)
    total[by] = np.add.reduceat(n[by], at)[window]
    same[by] = ((low == high) & (low > 0))[window]
    cuts = np.cumsum(sizes)[:-1]
    return pa.table(
        {
            "chunk": table["chunk"],
            "grp": table["grp"],
            "bits": pa.array([np.packbits(x).tobytes() for x in np.split(same, cuts)], pa.binary()),
            "n": pa.array([_planes(x, 5) for x in np.split(total, cuts)], pa.binary()),
        }
    )


def _subtree(table: pa.Table, window: int) -> pa.Table:
    """The part of the tree below a group's prefixes: which heads come after another suffix of their node."""
    tidy()
    rows = table.to_pylist()
    ranks = _ranks([r["ids"] for r in rows], rows[0]["numeric"])
    suffixes: list[list[bytes]] = []
    order: list[tuple] = []
    sizes = []
    unpack = zstandard.ZstdDecompressor()
    for r, rank in zip(rows, ranks, strict=True):
        labels = [x.split(b" ") for x in unpack.decompress(r["labels"]).split(b"\n")]
        place = _unplanes(r["place"], 4).astype(np.int64)
        suffixes += labels
        order += zip(rank[place].tolist(), _unplanes(r["start"], 4).tolist(), itertools.repeat(r["chunk"]), place.tolist(), strict=False)
        sizes.append(len(labels))
    by = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    late = np.zeros(len(by), bool)
    for _, a, b in internal_nodes([suffixes[k] for k in by], window):
        below = by[a:b]
        late[below] = True
        late[min(below, key=order.__getitem__)] = False
    bits = [np.packbits(part).tobytes() for part in np.split(late, np.cumsum(sizes)[:-1])]
    return pa.table({"chunk": table["chunk"], "grp": table["grp"], "bits": pa.array(bits, pa.binary())})


class Repeats:
    """What a chunk knows of its windows after the groups have counted them."""

    def __init__(self, found: Paths, how, answers: pa.Table) -> None:
        self.found = found
        counted = {r["grp"]: (r["bits"], r["n"]) for r in answers.to_pylist() if r["stage"] == _OCCURRENCES}
        own, left = _own(found)
        total, same = own.copy(), left > 0
        self.elsewhere: list[tuple[int, np.ndarray]] = []
        for g, at in _marked(found, how, answers):
            if len(at):
                bits, n = counted[g]
                total[at] = _unplanes(n, 5).astype(np.int64)
                same[at] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(at)).astype(bool)
                self.elsewhere.append((g, at[total[at] > own[at]]))
        # The distinct window at each place, and whether it continues the one before.
        size = len(found.keys)
        self.first = found.starts[found.heads]
        number = np.full(size + 1, -1, np.int64)
        number[found.starts] = found.number()
        may = np.flatnonzero(same & (total > 1))
        before = number[self.first[may] - 1]
        may = may[(before >= 0) & (total[before] == total[may])]
        self.continues = np.zeros(size, bool)
        self.continues[self.first[may]] = True

    def heads(self) -> Iterator[tuple[int, np.ndarray]]:
        """(group, distinct windows) that begin a maximal repeat which other chunks have as well."""
        for g, at in self.elsewhere:
            at = at[~self.continues[self.first[at]]]
            if len(at):
                yield g, at

    def late(self, answers: pa.Table, window: int) -> np.ndarray:
        """Places of the windows that come after another one with the same words."""
        bits, found = _bits(answers, _LATER), self.found
        # The first occurrences in this chunk: heads as their subtree says; what continues, as the head.
        value = np.zeros(len(found.keys), bool)
        for g, at in self.heads():
            value[self.first[at]] = np.unpackbits(np.frombuffer(bits[g], np.uint8), count=len(at)).astype(bool)
        base = np.maximum.accumulate(np.where(self.continues, 0, np.arange(len(value)))) if len(value) else np.zeros(0, np.int64)
        value = value[base]
        out = np.ones(len(found.starts), bool)
        out[found.heads] = value[self.first]
        # All others repeat the chunk's first one, word by word.
        further = np.ones(len(found.starts), bool)
        further[found.heads] = False
        at, like = found.starts[further], self.first[found.number()[further]]
        equal = np.ones(len(at), bool)
        for k in range(window):
            equal &= found.chunk.ids[at + k] == found.chunk.ids[like + k]
        out[further] = equal
        return found.starts[out]


def _payload(found: Paths, at: np.ndarray, window: int) -> bytes:
    """The words of these distinct windows."""
    name, ids = found.chunk.texts.__getitem__, found.chunk.ids
    first = found.starts[found.heads[at]]
    labels = [b" ".join(map(name, ids[p : p + window].tolist())) for p in first.tolist()]
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(labels))


_KINDS = {"chunk": pa.int64(), "grp": pa.int64(), "numeric": pa.bool_()}


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table([pa.array(c, _KINDS.get(n, pa.binary())) for c, n in zip(columns, names, strict=True)], names=names)


def remove_repeated(docs: DataFrame, symbols: Symbols, id_col: str, text_col: str, size: int, group: int) -> DataFrame:
    """Like repeats.remove_repeats(), by suffix trees."""
    numeric, window = is_numeric(docs, id_col), symbols.window
    table = chunks(docs, symbols, id_col, text_col, size)
    how = plan(table, symbols, group)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        tidy()
        out = []
        for number, body in zip(left["chunk"].to_pylist(), left["body"], strict=True):
            found = paths(Chunk.unpack(body.as_buffer()), symbols)
            own, before = _own(found)
            for g, at in _marked(found, how, right):
                if len(at):
                    out.append((number, g, _planes(np.diff(found.distinct[at], prepend=np.uint64(0)), 6), found.second[found.starts[found.heads[at]]].tobytes(), before[at].tobytes(), _planes(own[at], 5)))
        return _table(out, ["chunk", "grp", "steps", "second", "left", "n"])

    def heads(left: pa.Table, right: pa.Table) -> pa.Table:
        tidy()
        out = []
        for number, body, ids in zip(left["chunk"].to_pylist(), left["body"], left["ids"].to_pylist(), strict=True):
            found = paths(Chunk.unpack(body.as_buffer()), symbols)
            for g, at in Repeats(found, how, right).heads():
                out.append((number, g, numeric, *place_of(found.starts[found.heads[at]], found.chunk, ids, numeric), _payload(found, at, window)))
        return _table(out, ["chunk", "grp", "numeric", "ids", "place", "start", "labels"])

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        tidy()
        out = []
        for body, rest in zip(left["body"], left["rest"], strict=True):
            found = paths(Chunk.unpack(body.as_buffer()), symbols)
            out.append(without(found.chunk, Repeats(found, how, right).late(right, window), symbols, rest))
        named = pa.concat_tables(out)
        return pa.table(named.columns, names=schema.names)

    def subtree(rows: pa.Table) -> pa.Table:
        return _subtree(rows, window)

    def answered(rows: DataFrame, stage: int, name: str) -> DataFrame:
        return written(rows.withColumn("stage", F.lit(stage)), name)

    def asked(*columns: str):
        return table.select("chunk", *columns).groupBy("chunk")

    shared = shared_paths(table, symbols, how)
    counted = asked("body").cogroup(shared.groupBy("chunk")).applyInArrow(count, "chunk long, grp long, steps binary, second binary, left binary, n binary")
    counted = answered(counted.groupBy("grp").applyInArrow(_occurrences, "chunk long, grp long, bits binary, n binary"), _OCCURRENCES, "occurrences")
    known = written(shared.withColumn("n", F.lit(None).cast("binary")).unionByName(counted), "known")
    discard(shared, counted)
    suffixes = asked("body", "ids").cogroup(known.groupBy("chunk")).applyInArrow(heads, "chunk long, grp long, numeric boolean, ids binary, place binary, start binary, labels binary")
    later = answered(suffixes.groupBy("grp").applyInArrow(subtree, "chunk long, grp long, bits binary"), _LATER, "later")
    answers = known.unionByName(later.withColumn("n", F.lit(None).cast("binary")))
    schema = StructType([*(f for f in docs.schema if f.name != text_col), StructField(text_col, StringType()), StructField("n_symbols", LongType()), StructField("n_removed", LongType())])
    done = asked("body", "rest").cogroup(answers.groupBy("chunk")).applyInArrow(apply, schema)
    return done.select(*docs.columns, "n_symbols", "n_removed")

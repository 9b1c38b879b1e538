"""Repeated windows of symbols, over documents of any size and number.

Symbols are words or lines. A window is a fixed number of consecutive symbols of one
document; of all windows with the same symbols the first one (smallest document id, then
smallest start) stays, and symbols covered by any later one are removed.

This module holds what line windows and suffix trees share, and the method for line windows,
which compares digests of whole windows:

1. Documents are written once as chunks of about CHUNK symbols, numbered within the chunk.
2. A window's path has 48 bits: 12 bits of each of four prefixes of it, the last of which is
   the window itself. Paths that begin with the same bits form a group. How many bits follows
   from the number of windows; groups that measure too large get longer prefixes, until each
   fits a task's memory.
3. Each chunk sends its distinct windows to the groups as sorted paths, in byte planes. A
   group's task sorts them; a path sent by two chunks is a repeat. Each chunk gets a bit for
   each path it sent.
4. Only windows on such paths go again, now with 64 more bits of digest and the place of the
   chunk's first occurrence; the group finds the first of all and answers with a bit.
5. Each chunk removes what is covered by later occurrences, overlapping windows merged.

Copies shrink to one path in each chunk before anything is sent, so a passage that a third
of all documents share gives a path as many rows as there are chunks, at most.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sigil.llm.common import slices, small_batches, texts_of, tidy, written

#: Symbols in a chunk (more only if one document has more), and windows in a group.
CHUNK = 1 << 19
GROUP = 1 << 21
#: Bits of a path, and bits that each of its prefixes has.
PATH = 48
_BITS = 12
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Symbols:
    """How a text becomes symbols and back, how long windows are, and the prefixes that their paths are made of."""

    name: str
    split: Callable[[str], list[bytes]]
    key: Callable[[bytes], bytes]
    glue: bytes
    window: int
    prefixes: tuple[int, int, int, int]

    def of(self, window: int) -> Symbols:
        return replace(self, window=window, prefixes=tuple(min(p, window) for p in self.prefixes[:3]) + (window,))


def words(text: str) -> list[bytes]:
    return text.encode().split()


def lines(text: str) -> list[bytes]:
    return text.encode().split(b"\n")


WORDS = Symbols("words", words, bytes, b" ", 20, (2, 4, 8, 20))
LINES = Symbols("lines", lines, bytes.strip, b"\n", 3, (1, 2, 3, 3))


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolling(symbols: np.ndarray, lengths: tuple[int, ...], base: np.uint64) -> list[np.ndarray]:
    """Polynomial digests, modulo 2**64, of the symbols from each place on, for each length (shorter at the end)."""
    done = {1: symbols}
    return [_grown(done, k, base) for k in lengths]


def _grown(done: dict[int, np.ndarray], k: int, base: np.uint64) -> np.ndarray:
    """The digests of length k, from those of two shorter lengths."""
    if k not in done:
        a = 1 << ((k - 1).bit_length() - 1)
        left, right = _grown(done, a, base), _grown(done, k - a, base)
        out = left * np.uint64(pow(int(base), k - a, 1 << 64))
        out[: max(len(out) - a, 0)] += right[a:]
        done[k] = out
    return done[k]


@dataclass
class Chunk:
    """One chunk, unpacked: symbol numbers, their texts, symbols of each document, and their ids' order."""

    ids: np.ndarray
    texts: list[bytes]
    counts: np.ndarray

    @staticmethod
    def pack(ids: np.ndarray, texts: list[bytes], counts: np.ndarray) -> bytes:
        width = 4
        planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, width).T).tobytes()
        sizes = np.fromiter(map(len, texts), np.uint32, len(texts)).tobytes()
        head = np.array([len(ids), len(texts), len(counts)], np.int64).tobytes()
        return zstandard.ZstdCompressor(level=1).compress(b"".join([head, planes, sizes, counts.astype(np.int64).tobytes(), *texts]))

    @staticmethod
    def unpack(data: bytes) -> Chunk:
        raw = zstandard.ZstdDecompressor().decompress(data)
        n, v, d = np.frombuffer(raw, np.int64, 3).tolist()
        at = 24
        ids = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T).view("<u4").ravel()
        at += 4 * n
        ends = np.cumsum(np.frombuffer(raw, np.uint32, v, at), dtype=np.int64)
        at += 4 * v
        counts = np.frombuffer(raw, np.int64, d, at)
        at += 8 * d
        texts = [raw[at + a : at + b] for a, b in zip(itertools.chain((0,), ends[:-1].tolist()), ends.tolist(), strict=False)]
        return Chunk(ids, texts, counts)


def chunks(docs: DataFrame, symbols: Symbols, id_col: str, text_col: str, size: int = CHUNK) -> DataFrame:
    """Written rows: chunk, body (packed symbols, documents by id), ids (theirs), rest (all columns
    but the text, as an Arrow stream), hist (windows by the first bits of their paths).
    """
    small_batches(docs)
    rest = [c for c in docs.columns if c != text_col]
    numeric = is_numeric(docs, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        numbers = _numbering()
        parts: list[np.ndarray] = []
        others: list[pa.RecordBatch] = []
        held = made = 0

        def out() -> pa.RecordBatch:
            table = pa.Table.from_batches(others)
            ids = table.column(id_col).to_pylist()
            ids = [_LEAST if x is None else x for x in ids] if numeric else [_text_key(x) for x in ids]
            order = sorted(range(len(ids)), key=ids.__getitem__)
            ids = [ids[i] for i in order]
            counts = np.array([len(parts[i]) for i in order], np.int64)
            stream = np.concatenate([parts[i] for i in order])
            texts = list(numbers)
            _, starts, _ = _windows(counts, symbols.window)
            first = _mix(_rolling(_digests(texts, symbols)[stream], symbols.prefixes[:1], _FIRST)[0][starts])
            hist = np.bincount((first >> np.uint64(64 - _BITS)).astype(np.int64), minlength=1 << _BITS)
            sink = pa.BufferOutputStream()
            table = table.take(pa.array(order, pa.int64())).combine_chunks()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(table)
            keys = np.array(ids, "<i8").tobytes() if numeric else b"\0".join(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([base + made]), pa.array([Chunk.pack(stream, texts, counts)], pa.binary()), pa.array([keys], pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([hist.tolist()], pa.list_(pa.int64()))],
                names=["chunk", "body", "ids", "rest", "hist"],
            )

        for batch in slices(batches, text_col, mb=4):
            begin, kept = 0, batch.select(rest)
            for row, text in enumerate(texts_of(batch.column(text_col))):
                found = symbols.split(text)
                parts.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
                held += len(found) + 1
                if held >= size:
                    others.append(kept.slice(begin, row + 1 - begin))
                    begin = row + 1
                    yield out()
                    made += 1
                    numbers, parts, others, held = _numbering(), [], [], 0
            if begin < batch.num_rows:
                others.append(kept.slice(begin))
        if parts:
            yield out()

    table = docs.mapInArrow(run, "chunk long, body binary, ids binary, rest binary, hist array<long>")
    return written(table, f"chunks-{symbols.name}", block_mb=8)


def _numbering() -> defaultdict[bytes, int]:
    """Numbers new symbols in the order they are asked for."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    return numbers


def is_numeric(docs: DataFrame, id_col: str) -> bool:
    return dict(docs.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint")


#: Stands for a null id: before all others.
_LEAST = -(1 << 63)


def _text_key(x: object) -> bytes:
    """Of an id that is no integer: hex digits, which sort as the id's UTF-8 bytes do."""
    return b"" if x is None else str(x).encode().hex().encode()


def _digests(texts: list[bytes], symbols: Symbols) -> np.ndarray:
    named = texts if symbols.key is bytes else map(symbols.key, texts)
    return np.fromiter(map(xxhash.xxh64_intdigest, named), np.uint64, len(texts))


def _windows(counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether a window starts at each place; those places; the document of each place."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    valid = np.arange(total) + window <= ends[owner] if total else np.zeros(0, bool)
    return valid, np.flatnonzero(valid), owner


@dataclass(frozen=True)
class Plan:
    """How many bits of a path name its group; and the prefixes of so many bits that get 12 bits more."""

    bits: int
    longer: tuple[tuple[int, np.ndarray], ...] = ()

    def groups(self, paths: np.ndarray) -> np.ndarray:
        """The group of each path: its prefix below a leading one, which tells the length."""

        def prefix(n: int) -> np.ndarray:
            return paths >> np.uint64(PATH - n) | np.uint64(1 << n)

        out = prefix(self.bits)
        for n, cut in self.longer:
            more = np.isin(out, cut)
            out[more] = prefix(min(n + _BITS, PATH))[more]
        return out.astype(np.int64)


def plan(table: DataFrame, symbols: Symbols, group: int = GROUP) -> Plan:
    """Prefixes so long that groups would have about `group` windows if all were alike; then
    groups are counted, and those of over twice as many get longer prefixes, until none is left
    or a prefix is a whole path. Only such groups come to the driver.
    """
    hist = _histogram(table)
    total = int(hist.sum())
    how = Plan(min(PATH, max(0, (total // group).bit_length())))
    n, last = how.bits, None
    while n < PATH and total > 2 * group:
        if n <= _BITS and last is None:  # the chunks have brought these counts along
            load = hist.reshape(1 << n, -1).sum(1)
            large = [(1 << n) + int(g) for g in np.flatnonzero(load > 2 * group)]
        else:
            large = [r.grp for r in _loads(table, symbols, how, last).where(F.col("n") > 2 * group).select("grp").collect()]
        if not large:
            break
        last = np.array(sorted(large), np.int64).view(np.uint64)
        how = Plan(how.bits, (*how.longer, (n, last)))
        n = min(n + _BITS, PATH)
    return how


def _histogram(table: DataFrame) -> np.ndarray:
    """Windows by the first bits of their paths, over all chunks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _BITS, np.int64)
        for batch in batches:
            total += batch.column("hist").flatten().to_numpy().reshape(-1, 1 << _BITS).sum(0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    out = np.zeros(1 << _BITS, np.int64)
    for row in table.select("hist").mapInArrow(add, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[row["at"]] = row.n
    return out


def _loads(table: DataFrame, symbols: Symbols, how: Plan, only: np.ndarray | None) -> DataFrame:
    """grp, n: windows by group; of all, or of the groups below the prefixes that were lengthened last."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body"):
                chunk = Chunk.unpack(body.as_buffer())
                _, starts, _ = _windows(chunk.counts, symbols.window)
                path = path_of(_digests(chunk.texts, symbols)[chunk.ids], starts, symbols)
                if only is not None:
                    path = path[np.isin(Plan(how.bits, how.longer[:-1]).groups(path).view(np.uint64), only)]
                grp, n = np.unique(how.groups(path), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grp, pa.int64()), pa.array(n, pa.int64())], names=["grp", "n"])

    return table.select("body").mapInArrow(count, "grp long, n long").groupBy("grp").agg(F.sum("n").alias("n"))


def path_of(keys: np.ndarray, starts: np.ndarray, symbols: Symbols) -> np.ndarray:
    """The paths of the windows at these places, from the symbols' digests."""
    path = np.zeros(len(starts), np.uint64)
    for digest in _rolling(keys, symbols.prefixes, _FIRST):
        path = path << np.uint64(_BITS) | _mix(digest[starts]) >> np.uint64(64 - _BITS)
    return path


@dataclass
class Paths:
    """A chunk's windows by path; windows on one path that the second digest parts are apart."""

    chunk: Chunk
    keys: np.ndarray  # digest of the symbol at each place
    starts: np.ndarray  # places of all windows, by path and then by place
    distinct: np.ndarray  # distinct paths, sorted
    heads: np.ndarray  # where each distinct path begins in starts: the chunk's first occurrence
    second: np.ndarray  # 64 further bits of the window at each place

    def number(self) -> np.ndarray:
        """Of the distinct path of each of starts."""
        return np.repeat(np.arange(len(self.heads)), np.diff(np.append(self.heads, len(self.starts))))


def paths(chunk: Chunk, symbols: Symbols) -> Paths:
    keys = _digests(chunk.texts, symbols)[chunk.ids]
    _, starts, _ = _windows(chunk.counts, symbols.window)
    path = path_of(keys, starts, symbols)
    second = _mix(_rolling(_mix(keys + _SECOND), (symbols.window,), _SECOND)[0])
    order = np.argsort(path)
    new = np.concatenate(([True], path[order][1:] != path[order][:-1]))[: len(path)]
    # Windows that share a path, a small part of all, by the further digest and then by place.
    run = np.cumsum(new) - 1
    many = np.flatnonzero(np.bincount(run, minlength=1)[run] > 1) if len(run) else run
    if len(many):
        some = order[many]
        order[many] = some[np.lexsort((some, second[starts[some]], run[many]))]
        further = second[starts[order[many]]]
        new[many] = np.concatenate(([True], (run[many][1:] != run[many][:-1]) | (further[1:] != further[:-1])))
    return Paths(chunk, keys, starts[order], path[order][new], np.flatnonzero(new), second)


def _planes(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplanes(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _groups(distinct: np.ndarray, how: Plan) -> Iterator[tuple[int, int, int]]:
    """(group, from, to) of sorted paths."""
    if len(distinct):
        grp = how.groups(distinct)
        edges = [0, *(np.flatnonzero(np.diff(grp)) + 1).tolist(), len(grp)]
        for a, b in itertools.pairwise(edges):
            yield int(grp[a]), a, b


def _shared(table: pa.Table) -> pa.Table:
    """Which paths of a group are sent by more than one chunk. A row of bits for each chunk."""
    tidy()
    steps = [_unplanes(x, 6) for x in table["steps"].to_pylist()]
    sizes = [len(s) for s in steps]
    path = np.concatenate([np.cumsum(s, dtype=np.uint64) for s in steps])
    order = np.argsort(path, kind="stable")
    ordered = path[order]
    same = ordered[1:] == ordered[:-1]
    met = np.zeros(len(path), bool)
    met[order] = np.concatenate((same, [False])) | np.concatenate(([False], same))
    bits = [np.packbits(part).tobytes() for part in np.split(met, np.cumsum(sizes)[:-1])]
    return pa.table({"chunk": table["chunk"], "grp": table["grp"], "bits": pa.array(bits, pa.binary())})


def _later(table: pa.Table) -> pa.Table:
    """Below the repeats: whether each leaf comes after another one with the same 100 bits of digest."""
    tidy()
    rows = table.to_pylist()
    ranks = _ranks([r["ids"] for r in rows], rows[0]["numeric"])
    path = np.concatenate([np.cumsum(_unplanes(r["steps"], 6), dtype=np.uint64) for r in rows])
    second = np.concatenate([np.frombuffer(r["second"], "<u8") for r in rows])
    place = [_unplanes(r["place"], 4).astype(np.int64) for r in rows]
    size = [len(p) for p in place]
    doc = np.concatenate([rank[p] for rank, p in zip(ranks, place, strict=True)])
    start = np.concatenate([_unplanes(r["start"], 4) for r in rows])
    number = np.repeat([r["chunk"] for r in rows], size)
    by = np.lexsort((np.concatenate(place), number, start, doc, second, path))
    same = (path[by][1:] == path[by][:-1]) & (second[by][1:] == second[by][:-1])
    late = np.zeros(len(by), bool)
    late[by] = np.concatenate(([False], same))
    bits = [np.packbits(part).tobytes() for part in np.split(late, np.cumsum(size)[:-1])]
    return pa.table({"chunk": table["chunk"], "grp": table["grp"], "bits": pa.array(bits, pa.binary())})


def _ranks(ids: list[bytes], numeric: bool) -> list[np.ndarray]:
    """Comparable numbers for the documents of several chunks."""
    if numeric:
        return [np.frombuffer(x, "<i8") for x in ids]
    texts = [x.split(b"\0") for x in ids]
    rank = {t: i for i, t in enumerate(sorted(set(itertools.chain.from_iterable(texts))))}
    return [np.array([rank[t] for t in part], np.int64) for part in texts]


def _bits(answers: pa.Table, stage: int) -> dict[int, bytes]:
    return {r["grp"]: r["bits"] for r in answers.to_pylist() if r["stage"] == stage}


def _marked(found: Paths, how: Plan, answers: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(group, numbers of the distinct paths that other chunks have too)."""
    bits = _bits(answers, 1)
    for g, a, b in _groups(found.distinct, how):
        yield g, a + np.flatnonzero(np.unpackbits(np.frombuffer(bits[g], np.uint8), count=b - a))


def shared_paths(table: DataFrame, symbols: Symbols, how: Plan) -> DataFrame:
    """Written: for each chunk and group, which of the chunk's paths other chunks have too, as bits."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column("chunk").to_pylist(), batch.column("body"), strict=True):
                found = paths(Chunk.unpack(body.as_buffer()), symbols)
                rows = [(number, g, _planes(np.diff(found.distinct[a:b], prepend=np.uint64(0)), 6)) for g, a, b in _groups(found.distinct, how)]
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(("chunk", "grp", "steps"), r, strict=True)) for r in rows], pa.schema([("chunk", pa.int64()), ("grp", pa.int64()), ("steps", pa.binary())]))

    sent = table.select("chunk", "body").mapInArrow(send, "chunk long, grp long, steps binary")
    shared = sent.groupBy("grp").applyInArrow(_shared, "chunk long, grp long, bits binary").withColumn("stage", F.lit(1))
    return written(shared, "shared")


def without(chunk: Chunk, late: np.ndarray, symbols: Symbols, rest: pa.Scalar) -> pa.Table:
    """The chunk's other columns with what stays of each text if all windows at these places go, and the counts."""
    cover = np.zeros(len(chunk.ids) + 1, np.int32)
    np.add.at(cover, late, 1)
    np.add.at(cover, late + symbols.window, -1)
    gone = np.cumsum(cover[:-1]) > 0
    ends = np.cumsum(chunk.counts)
    texts, removed = [], []
    name = chunk.texts.__getitem__
    for a, b in zip((ends - chunk.counts).tolist(), ends.tolist(), strict=True):
        kept = chunk.ids[a:b][~gone[a:b]]
        texts.append(symbols.glue.join(map(name, kept.tolist())))
        removed.append(b - a - len(kept))
    others = pa.ipc.open_stream(rest.as_buffer()).read_all()
    return others.append_column("text", pa.array(texts, pa.binary()).cast(pa.string())).append_column("n_symbols", pa.array(chunk.counts, pa.int64())).append_column("n_removed", pa.array(removed, pa.int64()))


def place_of(first: np.ndarray, chunk: Chunk, ids: bytes, numeric: bool) -> tuple[bytes, bytes, bytes]:
    """Of these places: the ids of their documents, each once; which of those; and the start within it."""
    ends = np.cumsum(chunk.counts)
    doc = np.searchsorted(ends, first, side="right")
    own, doc_at = np.unique(doc, return_inverse=True)
    some = np.frombuffer(ids, "<i8")[own].tobytes() if numeric else b"\0".join(np.array(ids.split(b"\0"), object)[own].tolist())
    return some, _planes(doc_at, 4), _planes(first - (ends - chunk.counts)[doc], 4)


def remove_repeats(docs: DataFrame, symbols: Symbols, id_col: str, text_col: str, size: int = CHUNK, group: int = GROUP) -> DataFrame:
    """docs with their columns, where text_col holds the symbols that stay, and two more
    columns n_symbols and n_removed. See the module for the rule and the method.

    Null texts are empty texts and stay as such. Integer ids are ordered as numbers, all others
    as text; a null id comes before all others. Rows that share an id are separate documents,
    in the order of their chunks. An empty table gives
    an empty table. Columns named n_symbols or n_removed in docs must have been renamed.
    """
    numeric = is_numeric(docs, id_col)
    table = chunks(docs, symbols, id_col, text_col, size)
    how = plan(table, symbols, group)

    def again(left: pa.Table, right: pa.Table) -> pa.Table:
        tidy()
        out = []
        for number, body, ids in zip(left["chunk"].to_pylist(), left["body"], left["ids"].to_pylist(), strict=True):
            found = paths(Chunk.unpack(body.as_buffer()), symbols)
            for g, at in _marked(found, how, right):
                if not len(at):
                    continue
                first = found.starts[found.heads[at]]
                some, doc_at, start = place_of(first, found.chunk, ids, numeric)
                out.append((number, g, numeric, some, _planes(np.diff(found.distinct[at], prepend=np.uint64(0)), 6), found.second[first].tobytes(), doc_at, start))
        columns = list(zip(*out, strict=True)) or [()] * 8
        kinds = (pa.int64(), pa.int64(), pa.bool_(), *(pa.binary(),) * 5)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["chunk", "grp", "numeric", "ids", "steps", "second", "place", "start"])

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        tidy()
        out = []
        for body, rest in zip(left["body"], left["rest"], strict=True):
            found = paths(Chunk.unpack(body.as_buffer()), symbols)
            chunk, late = found.chunk, _bits(right, 2)
            later = np.ones(len(found.starts), bool)
            later[found.heads] = False
            for g, at in _marked(found, how, right):
                if len(at):
                    bits = np.unpackbits(np.frombuffer(late[g], np.uint8), count=len(at)).astype(bool)
                    later[found.heads[at[bits]]] = True
            out.append(without(chunk, found.starts[later], symbols, rest))
        named = pa.concat_tables(out)
        return pa.table(named.columns, names=schema.names)

    shared = shared_paths(table, symbols, how)
    leaves = table.select("chunk", "body", "ids").groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(again, "chunk long, grp long, numeric boolean, ids binary, steps binary, second binary, place binary, start binary")
    late = leaves.groupBy("grp").applyInArrow(_later, "chunk long, grp long, bits binary").withColumn("stage", F.lit(2))
    late = written(late, "late")
    answers = shared.unionByName(late)
    schema = StructType([*(f for f in docs.schema if f.name != text_col), StructField(text_col, StringType()), StructField("n_symbols", LongType()), StructField("n_removed", LongType())])
    done = table.select("chunk", "body", "rest").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(apply, schema)
    return done.select(*docs.columns, "n_symbols", "n_removed")

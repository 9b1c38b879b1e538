"""Near duplicates by 64-bit SimHash within Hamming distance 3, meeting in the middle.

Fingerprints at distance 3 or less meet at a common variant when both emit variants of
about half that distance. Parity tells which half each one emits, so that no pair needs the
whole ball of radius 2 from both sides:

* Every fingerprint emits itself and its 64 neighbours. Pairs at distance 1 or 2 meet.
* Pairs at distance 3 have different parity. The odd one also emits variants with two
  flipped bits, but only with both bits in the same 32-bit half: of any three bits, two
  lie in one half, so the odd one moves along those two and the even one along the third.

That makes 65 or 1,057 variants where the whole radius-2 ball has 2,081. Equal
fingerprints emit once. Variants travel as sorted 64-bit blocks in byte planes, dealt by
their highest bits; each block is matched with numpy. Links found at a variant are
verified and reduced to a spanning forest of the task's matches before they leave it, so a
large group of near copies sends a tree and not its square. Components come from
alternating star contraction on those links (graph.stars), cut by written tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigil.llm.common import discard, free_name, hot_join, slices, small_batches, texts_of, tidy, written
from sigil.operators.graph import stars

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints whose variants one block holds, and distinct fingerprints one task of matching is planned for.
BLOCK = 2048
PER_TASK = 4096


def fingerprint(text: str, k: int = SHINGLE) -> int:
    """A bit is set if more than half of the shingle hashes have it; no words: 0."""
    words = text.encode().lower().split()
    if not words:
        return 0
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    joined = b" ".join(words)
    starts = np.cumsum(sizes + 1) - sizes - 1
    if len(words) <= k:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = (starts + sizes)[k - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(ends)].tolist(), ends, strict=True)], np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = 2 * votes > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the fingerprint as a signed long fp, one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [_signed(fingerprint(t)) for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    small_batches(docs)
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, fp long")


def _masks() -> tuple[np.ndarray, np.ndarray]:
    """Flips of even fingerprints (none, one bit) and of odd ones (and two bits of one half)."""
    one = [1 << i for i in range(64)]
    two = [1 << i | 1 << j for half in (0, 32) for i in range(half, half + 32) for j in range(i + 1, half + 32)]
    return np.array([0, *one], np.uint64), np.array([0, *one, *two], np.uint64)


EVEN, ODD = _masks()


def to_planes(values: np.ndarray) -> bytes:
    """Sorted uint64 values as differences, byte plane by byte plane: high planes are zeros, which compress away."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def parity(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values) & 1


def _emit(values: np.ndarray, shift: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(part, sorted variants, number of the flip of each) for these distinct fingerprints."""
    odd = parity(values) == 1
    variants = np.concatenate([(values[~odd][:, None] ^ EVEN).ravel(), (values[odd][:, None] ^ ODD).ravel()])
    flips = np.concatenate([np.tile(np.arange(len(EVEN), dtype=np.uint16), int((~odd).sum())), np.tile(np.arange(len(ODD), dtype=np.uint16), int(odd.sum()))])
    order = np.argsort(variants)
    variants, flips = variants[order], flips[order]
    part = (variants >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(variants), np.int64)
    edges = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(part[a]), to_planes(variants[a:b]), flips[a:b].astype("<u2").tobytes()


def _matches(blocks: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Verified links between the fingerprints that meet in these blocks: (left, right), one star per variant."""
    variants = np.concatenate([from_planes(v) for v, _ in blocks])
    flips = np.concatenate([np.frombuffer(f, "<u2") for _, f in blocks])
    order = np.argsort(variants, kind="stable")
    variants, flips = variants[order], flips[order]
    same = variants[1:] == variants[:-1]
    met = np.concatenate((same, [False])) | np.concatenate(([False], same))
    variants, flips = variants[met], flips[met]
    if not len(variants):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    fps = variants ^ ODD[flips]
    # The centre of a star is the fingerprint nearest to the variant; all others that the
    # radius allows link to it, and pairs that need two far members meet at another variant.
    near = np.minimum(flips, 65)
    order = np.lexsort((fps, near, variants))
    variants, fps = variants[order], fps[order]
    head = np.concatenate(([True], variants[1:] != variants[:-1]))
    centre = fps[np.flatnonzero(head)][np.cumsum(head) - 1]
    linked = ~head & (np.bitwise_count(centre ^ fps) <= RADIUS)
    return centre[linked], fps[linked]


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of these links: (smallest node, other node)."""
    nodes, index = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = index[: len(left)], index[len(left) :]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    other = label != np.arange(len(nodes))
    return nodes[label[other]], nodes[other]


def links(distinct: DataFrame, n: int) -> DataFrame:
    """Links (i, j) that connect the fingerprints (fp long) within the radius, as spanning forests of the tasks' matches."""
    parts = max(1, 1 << max(0, (n - 1) // PER_TASK).bit_length())
    shift = 64 - (parts - 1).bit_length()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.uint64)

        def out(values: np.ndarray) -> pa.RecordBatch:
            part, variants, flips = zip(*_emit(values, shift), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(variants, pa.binary()), pa.array(flips, pa.binary())], names=["part", "variants", "flips"])

        for batch in batches:
            held = np.concatenate([held, batch.column("fp").to_numpy().view(np.uint64)])
            while len(held) >= BLOCK:
                yield out(held[:BLOCK])
                held = held[BLOCK:]
        if len(held):
            yield out(held)
        tidy()

    def match(table: pa.Table) -> pa.Table:
        tidy()
        blocks = list(zip(table["variants"].to_pylist(), table["flips"].to_pylist(), strict=True))
        a, b = forest(*_matches(blocks))
        return pa.table({"i": pa.array(a.view(np.int64)), "j": pa.array(b.view(np.int64))})

    # A task goes through many blocks if there are more of them than a few waves of tasks.
    most = 4 * int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = distinct.repartition(min(max(1, -(-n // BLOCK)), most)).mapInArrow(emit, "part long, variants binary, flips binary")
    return sent.groupBy("part").applyInArrow(match, "i long, j long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Texts without words, null ones too, have fingerprint zero and link like any other. Ties
    are impossible: links are symmetric and component_id is the smallest id reached. Null
    ids stay as they are and never become a component_id unless all ids reached are null;
    repeated rows share their component. An empty table gives an empty table.
    """
    table = written(fingerprints(docs, id_col, text_col), "fingerprints")
    groups = written(table.groupBy("fp").agg(F.min("doc_id").alias("first")), "groups")
    tree = stars(links(groups.select("fp"), groups.count()), "components")
    # The smallest id of a component is that of its groups, whose roots are fingerprints.
    rooted = written(groups.join(tree, groups.fp == tree.a, "left").select("fp", "first", F.coalesce("b", "fp").alias("root")), "rooted")
    discard(groups, tree)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(hot_join(rooted.select("fp", "root"), smallest, "root", "fp").select("fp", "component_id"), "named")
    discard(rooted)
    found = hot_join(table, named, "fp", "doc_id")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose id is the smallest of its component, unchanged, with all their
    columns. Rows that repeat a staying id all stay; so do rows without an id.
    """
    found = near_duplicates(docs, id_col, text_col)
    gone_id = free_name(docs.columns, "gone_id")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(gone_id)).distinct()
    return docs.join(gone, docs[id_col] == F.col(gone_id), "left_anti")

"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(subclass | class, history) * P(word | subclass, history).
All are softmaxes over hashed features of the history: the unit before (bigram), the units two
and three before (skips) and the pair before (trigram). A frequent word is a subclass of its own,
so its last factor is one; the other words of a class share its last subclass, below which they are
told apart by a tree: each level is a softmax over five more bits of the word's digest, with the
word before itself, hashed, as feature. The number of levels follows from the counted vocabulary:
until a cell of the tree has some CELL words. Within a cell a word has its smoothed share; unknown
words have one share of every cell, so the probabilities of all outcomes sum to one.

Units are what features and classes are made of: the TOP most frequent training words are
units of their own, other words fall into units by their first and last letters. Classes
come from k-means over the frequent words that stand beside each unit.

All documents are written once as chunks of numbered tokens. Then, over all training rows:

1. Counts: chunks send their distinct words as sorted digests (96 bits), dealt by digest;
   every group sums them and answers each chunk with the totals of the words it sent, and with
   which of them the chunk is the first to send. With these, chunks are written once more, now
   as word numbers with units, digests and totals, so no later pass reads texts.
2. Contexts of units (a matrix of fixed size, summed by blocks), clustered on the driver; and
   the words and tokens of every cell.
3. Rounds of distributed gradient updates: tasks start from the shared weights, take
   AdaGrad steps over blocks of their tokens (a round sees every ROUNDS-th position of a
   chunk, the next round the positions after those, so that the rounds together see every
   training position once), and return what they changed; changes are averaged over the
   tasks that touched a row.
4. Scores, in numpy batches that gather only the rows of the features at hand.

Nothing depends on rows that are held out.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigil.llm.common import crc_bucket, discard, tidy, written
from sigil.llm.repeats import Chunk, Symbols, _planes, _unplanes, chunks

HELD_OUT = 10
TOP, SHAPES, ANCHORS = 2048, 2048, 64
UNITS = TOP + SHAPES
CLASSES, SUBCLASSES = 32, 32
#: Rows of the weight tables; the first three blocks of UNITS rows are not hashed.
ROWS = 1 << 15
#: Outcomes of a level below a class, words that a cell should have, and levels at most, so that
#: cells, a table that is broadcast, are a million at most.
DIGITS, CELL, LEVELS = 32, 64, 3
ROUNDS, RATE = 2, 0.3
#: Logits within this of zero are in the range of exp and of sums of its values as 32-bit numbers.
MOST = 60.0
#: Tokens in a chunk, distinct words in a counting group, tokens in a gradient step.
CHUNK = 1 << 21
GROUP = 1 << 21
BLOCK = 16_384
#: Tokens of a chunk that are looked at together, more only if a document has more.
SLICE = 1 << 18
#: Bits of the number of tokens that a task of a round takes at least: with up to TASKS tasks, and beyond.
FEW, MANY, TASKS = 20, 27, 256


def tokens(text: str) -> list[bytes]:
    """Words of the text with A-Z in lower case, then the end, which is the empty word."""
    found = text.encode().lower().split()
    found.append(b"")
    return found


TOKENS = Symbols("lm", tokens, bytes, b" ", 1, (1, 1, 1, 1))


def _keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of words, 64 and 32 bits, and the shape unit of each."""
    digest = xxhash.xxh64_intdigest
    key = np.fromiter((digest(t, 1) for t in texts), np.uint64, len(texts))
    check = np.fromiter((xxhash.xxh32_intdigest(t, 2) for t in texts), np.uint32, len(texts))
    shape = np.fromiter((xxhash.xxh32_intdigest(t[:2] + b"\0" + t[-2:], 3) for t in texts), np.uint32, len(texts)) % SHAPES
    return key, check, shape.astype(np.int64)


@dataclass
class Tokens:
    """A chunk with what the passes need: ids, documents, whether each is for training."""

    chunk: Chunk
    train: np.ndarray  # by document

    @staticmethod
    def read(body: pa.Scalar, rest: pa.Scalar) -> Tokens:
        held = pa.ipc.open_stream(rest.as_buffer()).read_all().column("held_out").to_numpy(zero_copy_only=False)
        return Tokens(Chunk.unpack(body.as_buffer()), ~held.astype(bool))

    def in_training(self) -> np.ndarray:
        return np.repeat(self.train, self.chunk.counts)

    def counts(self) -> np.ndarray:
        return np.bincount(self.chunk.ids[self.in_training()], minlength=len(self.chunk.texts))


# Counting


def _send_counts(shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("chunk", pa.int64()), ("grp", pa.int64()), ("steps", pa.binary()), ("checks", pa.binary()), ("shapes", pa.binary()), ("n", pa.binary())])
        for batch in batches:
            for number, body, rest in zip(batch.column("chunk").to_pylist(), batch.column("body"), batch.column("rest"), strict=True):
                t = Tokens.read(body, rest)
                key, check, shape = _keys(t.chunk.texts)
                order = np.lexsort((check, key))
                key, check, shape, n = key[order], check[order], shape[order], t.counts()[order]
                grp = (key >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(key), np.int64)
                edges = [0, *(np.flatnonzero(np.diff(grp)) + 1).tolist(), len(grp)]
                rows = [
                    {"chunk": number, "grp": int(grp[a]), "steps": _planes(np.diff(key[a:b], prepend=np.uint64(0)), 8), "checks": check[a:b].tobytes(), "shapes": _planes(shape[a:b], 2), "n": _planes(n[a:b], 5)}
                    for a, b in itertools.pairwise(edges)
                ]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def _sum_counts(table: pa.Table) -> pa.Table:
    """Totals of a group's words: an answer for each chunk, and one row of statistics (chunk null)."""
    rows = table.to_pylist()
    key = np.concatenate([np.cumsum(_unplanes(r["steps"], 8), dtype=np.uint64) for r in rows])
    check = np.concatenate([np.frombuffer(r["checks"], "<u4") for r in rows])
    shape = np.concatenate([_unplanes(r["shapes"], 2) for r in rows]).astype(np.int64)
    parts = [_unplanes(r["n"], 5).astype(np.int64) for r in rows]
    n = np.concatenate(parts)
    order = np.lexsort((check, key))  # stable: of equal words the first chunk comes first
    new = np.concatenate(([True], (key[order][1:] != key[order][:-1]) | (check[order][1:] != check[order][:-1])))
    word = np.cumsum(new) - 1
    total = np.bincount(word, weights=n[order]).astype(np.int64)
    each = np.empty(len(n), np.int64)
    each[order] = total[word]
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    answers = [_planes(x, 5) for x in np.split(each, cuts)]
    first = order[new]
    owned = np.zeros(len(n), bool)
    owned[first] = True
    owners = [np.packbits(x).tobytes() for x in np.split(owned, cuts)]
    known = total > 0
    by_shape = np.bincount(shape[first], weights=total, minlength=SHAPES).astype(np.int64)
    types = np.bincount(shape[first][known], minlength=SHAPES).astype(np.int64)
    best = np.lexsort((key[first], -total))[:TOP]
    best = best[total[best] > 0]
    lead = [{"key": int(key[first[i]].view(np.int64)), "shape": int(shape[first[i]]), "n": int(total[i])} for i in best.tolist()]
    return pa.table(
        {
            "chunk": pa.array([*(r["chunk"] for r in rows), None], pa.int64()),
            "grp": pa.array([*(r["grp"] for r in rows), rows[0]["grp"]], pa.int64()),
            "n": pa.array([*answers, None], pa.binary()),
            "own": pa.array([*owners, None], pa.binary()),
            "mass": pa.array([None] * len(rows) + [by_shape.tolist()], pa.list_(pa.int64())),
            "types": pa.array([None] * len(rows) + [types.tolist()], pa.list_(pa.int64())),
            "lead": pa.array([None] * len(rows) + [lead], pa.list_(pa.struct([("key", pa.int64()), ("shape", pa.int32()), ("n", pa.int64())]))),
        }
    )


COUNTED = "chunk long, grp long, n binary, own binary, mass array<long>, types array<long>, lead array<struct<key: long, shape: int, n: long>>"


# Sums of arrays of a fixed size over all tasks


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """parts: block int, data binary (float32). The sums of all blocks, one after another, on
    the driver; their size is that of the model, whatever the input's. Tasks' parts are added in
    two levels, so that no task reads those of all others.
    """

    def add(kind: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, block = np.zeros(0), 0
            for batch in batches:
                for b, data in zip(batch.column("block").to_pylist(), batch.column("data"), strict=True):
                    values = np.frombuffer(data.as_buffer(), kind)
                    total = total + values if len(total) else values.astype(np.float64)
                    block = b
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "data"])

        return run

    out = np.zeros(size)
    some = parts.withColumn("part", F.spark_partition_id() % 64).groupBy("block", F.col("part")).applyInArrow(add("<f4"), "block int, data binary")
    found = {r.block: np.frombuffer(bytes(r.data)) for r in some.groupBy("block").applyInArrow(add("<f8"), "block int, data binary").collect()}
    if found:
        out[:] = np.concatenate([found[b] for b in sorted(found)])
    return out


def _blocks(values: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    for b, part in enumerate(np.array_split(values.astype("<f4").ravel(), blocks)):
        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["block", "data"])


# The model


@dataclass
class Units:
    """Words that are units of their own, by digest, with their unit."""

    keys: np.ndarray
    numbers: np.ndarray

    def of(self, key: np.ndarray, shape: np.ndarray) -> np.ndarray:
        unit = TOP + shape
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            own = self.keys[at] == key
            unit[own] = self.numbers[at[own]]
        return unit


@dataclass
class Model:
    units: Units
    leaf: np.ndarray  # of each unit: class * SUBCLASSES + subclass
    mass: np.ndarray  # training tokens of each leaf
    types: np.ndarray  # distinct training words of each leaf
    levels: int  # of the trees below the classes' last subclasses
    cell_mass: np.ndarray  # of each cell, class after class
    cell_types: np.ndarray
    class_rows: np.ndarray  # [ROWS, CLASSES]
    class_bias: np.ndarray
    sub_rows: np.ndarray  # [ROWS, SUBCLASSES]
    sub_bias: np.ndarray  # [CLASSES, SUBCLASSES]
    word_rows: np.ndarray  # [ROWS, DIGITS], of all levels and nodes
    word_bias: list[np.ndarray]  # by level: [nodes, DIGITS], log shares; not learned
    total: int
    distinct: int


def _history(units: np.ndarray, counts: np.ndarray, start: int) -> list[np.ndarray]:
    """Units one, two and three before each token; before a document stands its start."""
    place = np.arange(len(units)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = []
    for k in (1, 2, 3):
        before = np.full(len(units), start, np.int64)
        before[k:] = units[: len(units) - k] if k < len(units) else before[k:]
        before[place < k] = start
        out.append(before)
    return out


def _before(keys: np.ndarray, counts: np.ndarray, start: int) -> np.ndarray:
    """The digest of the word before each token."""
    out = np.empty_like(keys)
    out[1:] = keys[:-1]
    out[(np.cumsum(counts) - counts)[counts > 0]] = start
    return out


def _class_features(h: list[np.ndarray]) -> np.ndarray:
    """[4, tokens] rows of the class table: bigram, two skips, trigram (hashed)."""
    pair = (h[0] * 0x9E3779B1 + h[1] * 0x85EBCA77) & 0xFFFFFFFF
    pair = ((pair ^ (pair >> 15)) * 0xC2B2AE3D & 0xFFFFFFFF) >> 8
    return np.stack([h[0], UNITS + h[1], 2 * UNITS + h[2], 3 * UNITS + pair % (ROWS - 3 * UNITS)]).astype(np.uint16)


def _sub_features(h: list[np.ndarray], classes: np.ndarray) -> np.ndarray:
    """[2, tokens] rows of the subclass table, hashed with the class: bigram and skip."""
    out = []
    for i in (0, 1):
        x = (h[i] * 0x9E3779B1 + classes * 0x85EBCA77 + i * 0x27D4EB2F) & 0xFFFFFFFF
        x = ((x ^ (x >> 15)) * 0xC2B2AE3D & 0xFFFFFFFF) >> 8
        out.append(x % ROWS)
    return np.stack(out).astype(np.uint16)


def digits_of(key: np.ndarray, level: int) -> np.ndarray:
    """The outcome of words at a level: five bits of their digests."""
    return (key >> np.uint32(5 * level)).astype(np.int64) & (DIGITS - 1)


def cells_of(classes: np.ndarray, key: np.ndarray, levels: int) -> np.ndarray:
    """The node of words below their class after so many levels."""
    node = classes
    for level in range(levels):
        node = node * DIGITS + digits_of(key, level)
    return node


def _word_features(before: np.ndarray, node: np.ndarray, level: int) -> np.ndarray:
    """[1, tokens] rows of the word table, hashed from the word before (its digest) and the node."""
    x = (before.astype(np.int64) * 0x9E3779B1 + node * 0x85EBCA77 + level * 0x27D4EB2F) & 0xFFFFFFFF
    x = ((x ^ (x >> 15)) * 0xC2B2AE3D & 0xFFFFFFFF) >> 8
    return (x % ROWS).astype(np.uint16)[None]


def _logits(rows: np.ndarray, features: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """[tokens, outcomes], of a size that exp can take; bias has one row, or one for each token."""
    z = rows.take(features[0], 0, mode="clip")
    z += bias
    more = np.empty_like(z)
    for f in features[1:]:
        z += rows.take(f, 0, out=more, mode="clip")
    # The largest of each token costs more than all else here, and a softmax needs it only where exp would leave its range.
    if len(z) and not (z.max() < MOST and z.min() > -MOST):
        z -= z.max(1, keepdims=True)
    return z


def _powers(z: np.ndarray) -> np.ndarray:
    """Replaces z by exp(z); the sums of its rows, by a product, as sums over short rows are slow."""
    return np.exp(z, out=z) @ np.ones(z.shape[1], z.dtype)


def _log_share(z: np.ndarray, gold: np.ndarray) -> np.ndarray:
    """Natural log of the softmax of z at each token's outcome."""
    wanted = z[np.arange(len(gold)), gold].astype(np.float64)
    return wanted - np.log(_powers(z))


def _segment_sums(rows: np.ndarray, order: np.ndarray, heads: np.ndarray, most: int = 96) -> tuple[np.ndarray, np.ndarray]:
    """Sums of rows[order] from each head to the next, and which head each sum is of: short segments
    come first, the longer of them before the shorter, and advance together; reduceat over rows is several times slower.
    """
    length = np.diff(np.append(heads, len(order)))
    turn = np.argsort(np.where(length > most, most + 1, most - length).astype(np.uint8), kind="stable")
    at, size = heads[turn], length[turn]
    out = rows.take(order[at], 0, mode="clip")
    n = int((size <= most).sum())
    for i in range(n, len(at)):
        out[i] = rows.take(order[at[i] : at[i] + size[i]], 0, mode="clip").sum(0)
    # How many segments have more than each number of rows.
    longer = n - np.cumsum(np.bincount(size[:n], minlength=most + 1))
    for step in range(1, most):
        k = int(longer[step])
        if not k:
            break
        out[:k] += rows.take(order[at[:k] + step], 0, mode="clip")
    return out, turn


class Trainer:
    """AdaGrad steps on one task's copy of the weights; a row has one step size for all its outcomes."""

    def __init__(self, model: Model, rate: float = RATE) -> None:
        self.model, self.rate = model, rate
        self.rows = [model.class_rows.copy(), model.sub_rows.copy(), model.word_rows.copy()]
        self.bias = [model.class_bias.copy(), model.sub_bias.copy()]
        self.seen = [np.full(len(r), 1 / r.shape[1], np.float32) for r in self.rows]
        self.bias_seen = [np.full(b.shape, 1.0, np.float32) for b in self.bias]

    def _step(self, table: int, features: np.ndarray, gold: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """A step on a table's rows; the slopes of all outcomes by token."""
        slope = _logits(self.rows[table], features, bias)
        slope *= (1 / _powers(slope))[:, None]
        slope.ravel()[np.arange(0, slope.size, slope.shape[1]) + gold] -= 1
        flat = features.ravel()
        order = np.argsort(flat, kind="stable")
        heads = np.flatnonzero(np.diff(flat[order].astype(np.int32), prepend=-1))
        grad, turn = _segment_sums(slope, np.tile(np.arange(len(gold)), len(features)).take(order), heads)
        at = flat[order[heads[turn]]]
        seen = self.seen[table]
        seen[at] += np.einsum("ij,ij->i", grad, grad) / grad.shape[1]
        grad *= (-self.rate / np.sqrt(seen[at] * 1.0))[:, None]
        grad += self.rows[table].take(at, 0)
        self.rows[table][at] = grad
        return slope

    def _step_bias(self, table: int, grad: np.ndarray) -> None:
        self.bias_seen[table] += grad * grad
        self.bias[table] -= self.rate * grad / np.sqrt(self.bias_seen[table])

    def learn(self, units: np.ndarray, keys: np.ndarray, counts: np.ndarray, start: tuple[int, int], wanted: np.ndarray) -> None:
        """Steps over the wanted tokens; keys: 32 bits of each token's digest; start: unit and key of a document's start."""
        history, leaf = _history(units, counts, start[0]), self.model.leaf[units]
        before = _before(keys, counts, start[1])
        where = np.flatnonzero(wanted)
        for a in range(0, len(where), BLOCK):
            part = where[a : a + BLOCK]
            h = [x[part] for x in history]
            classes, sub = np.divmod(leaf[part], SUBCLASSES)
            self._step_bias(0, self._step(0, _class_features(h), classes, self.bias[0]).sum(0))
            slope = self._step(1, _sub_features(h, classes), sub, self.bias[1][classes])
            order = np.argsort(classes.astype(np.uint8), kind="stable")
            heads = np.flatnonzero(np.diff(classes[order], prepend=-1))
            sums, turn = _segment_sums(slope, order, heads)
            grad = np.zeros_like(self.bias[1])
            grad[classes[order[heads[turn]]]] = sums
            self._step_bias(1, grad)
            rest = sub == SUBCLASSES - 1
            own, node, last = keys[part][rest], classes[rest], before[part][rest]
            for level in range(self.model.levels if len(own) else 0):
                digit = digits_of(own, level)
                self._step(2, _word_features(last, node, level), digit, self.model.word_bias[level][node])
                node = node * DIGITS + digit

    def changes(self) -> np.ndarray:
        """Changes of all weights, and which rows were touched, as one vector."""
        m = self.model
        pairs = zip([*self.rows, *self.bias], [m.class_rows, m.sub_rows, m.word_rows, m.class_bias, m.sub_bias], strict=True)
        touched = [(s * r.shape[1] > 1.0).astype(np.float32) for s, r in zip(self.seen, self.rows, strict=True)]
        return np.concatenate([*((new - old).ravel() for new, old in pairs), *touched, np.ones(1, np.float32)])


def apply_changes(model: Model, total: np.ndarray) -> None:
    """Adds the mean change of every row, over the tasks that touched it."""
    tasks = max(total[-1], 1.0)
    touched = np.maximum(total[-1 - 3 * ROWS : -1].reshape(3, ROWS), 1.0)
    at = 0
    for name, by in (("class_rows", touched[0][:, None]), ("sub_rows", touched[1][:, None]), ("word_rows", touched[2][:, None]), ("class_bias", tasks), ("sub_bias", tasks)):
        old = getattr(model, name)
        setattr(model, name, (old + total[at : at + old.size].reshape(old.shape) / by).astype(np.float32))
        at += old.size


def size_of_changes() -> int:
    return ROWS * (CLASSES + SUBCLASSES + DIGITS) + CLASSES + CLASSES * SUBCLASSES + 3 * ROWS + 1


def cluster(contexts: np.ndarray, mass: np.ndarray, steps: int = 25) -> np.ndarray:
    """A leaf for each unit. Classes: k-means on square roots of context shares, smoothed by
    the overall shares, weighted by mass. Subclasses: the heaviest units of a class have one each, the rest share one.
    """
    overall = contexts.sum(0) + 1.0
    shares = contexts + 20.0 * overall / overall.sum()
    points = np.sqrt(shares / shares.sum(1, keepdims=True))
    weight = np.sqrt(mass + 1.0)
    order = np.argsort(-mass, kind="stable")
    centres = points[order[:1]]
    while len(centres) < CLASSES:  # the heaviest point among the farthest
        far = ((points[:, None] - centres[None]) ** 2).sum(2).min(1) * weight
        centres = np.concatenate([centres, points[np.argmax(far)][None]])
    for _ in range(steps):
        label = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        for k in range(CLASSES):
            own = label == k
            if own.any():
                centres[k] = np.average(points[own], axis=0, weights=weight[own])
    sub = np.full(len(mass), SUBCLASSES - 1)
    for k in range(CLASSES):
        own = order[label[order] == k][: SUBCLASSES - 1]
        sub[own] = np.arange(len(own))
    return label * SUBCLASSES + sub


def fresh_model(units: Units, leaf: np.ndarray, unit_mass: np.ndarray, unit_types: np.ndarray, levels: int, cell_mass: np.ndarray, cell_types: np.ndarray, total: int, distinct: int) -> Model:
    """Without features: the shares of classes, subclasses and nodes in the training tokens."""
    n = CLASSES * SUBCLASSES
    mass, types = np.bincount(leaf, weights=unit_mass, minlength=n), np.bincount(leaf, weights=unit_types, minlength=n)
    # Every subclass and every cell has an outcome beyond the known words, so none is impossible.
    weight = mass + 0.1 * (types + 1)
    below = cell_mass + 0.1 * (cell_types + 1)
    word_bias = [np.log(below.reshape(CLASSES * DIGITS**level, DIGITS, -1).sum(2)).astype(np.float32) for level in range(levels)]
    share = np.log(weight).reshape(CLASSES, SUBCLASSES)
    bias = np.log(np.exp(share).sum(1))
    rows = [np.zeros((ROWS, k), np.float32) for k in (CLASSES, SUBCLASSES, DIGITS)]
    return Model(units, leaf, mass, types, levels, cell_mass, cell_types, rows[0], bias.astype(np.float32), rows[1], share.astype(np.float32), rows[2], word_bias, total, distinct)


def token_scores(model: Model, units: np.ndarray, keys: np.ndarray, n: np.ndarray, counts: np.ndarray, start: tuple[int, int]) -> np.ndarray:
    """log10 probability of every token; keys: 32 bits of the tokens' digests; n: their training counts."""
    leaf = model.leaf[units]
    mass, types = model.mass[leaf], model.types[leaf]
    shared = np.flatnonzero(leaf % SUBCLASSES == SUBCLASSES - 1)
    cell = cells_of(leaf[shared] // SUBCLASSES, keys[shared], model.levels)
    mass[shared], types[shared] = model.cell_mass[cell], model.cell_types[cell]
    out = np.log10((n + 0.1) / (mass + 0.1 * (types + 1)))
    history, before = _history(units, counts, start[0]), _before(keys, counts, start[1])
    for a in range(0, len(units), BLOCK):
        part = slice(a, a + BLOCK)
        h = [x[part] for x in history]
        classes, sub = np.divmod(leaf[part], SUBCLASSES)
        log = _log_share(_logits(model.class_rows, _class_features(h), model.class_bias), classes)
        log += _log_share(_logits(model.sub_rows, _sub_features(h, classes), model.sub_bias[classes]), sub)
        rest = np.flatnonzero(sub == SUBCLASSES - 1)
        own, node, last = keys[part][rest], classes[rest], before[part][rest]
        for level in range(model.levels if len(rest) else 0):
            digit = digits_of(own, level)
            log[rest] += _log_share(_logits(model.word_rows, _word_features(last, node, level), model.word_bias[level][node]), digit)
            node = node * DIGITS + digit
        out[part] += log / np.log(10)
    return out


# The operator


@dataclass
class Coded:
    """A chunk as numbers: word numbers, tokens and training flag of each document; and by word
    number the unit, 32 bits of digest, training count, and whether no chunk before has the word.
    """

    ids: np.ndarray
    counts: np.ndarray
    train: np.ndarray
    unit: np.ndarray
    key: np.ndarray
    n: np.ndarray
    own: np.ndarray

    def tokens(self) -> bytes:
        head = np.array([len(self.ids), len(self.counts)], np.int64).tobytes()
        return zstandard.ZstdCompressor(level=1).compress(b"".join([head, _planes(self.ids, 4), self.counts.astype("<i8").tobytes(), self.train.astype("u1").tobytes()]))

    def words(self) -> bytes:
        head = np.array([len(self.unit)], np.int64).tobytes()
        return zstandard.ZstdCompressor(level=1).compress(b"".join([head, self.unit.astype("<u2").tobytes(), self.key.astype("<u4").tobytes(), _planes(self.n, 5), self.own.astype("u1").tobytes()]))

    @staticmethod
    def read_words(data: pa.Scalar) -> tuple[np.ndarray, ...]:
        raw = zstandard.ZstdDecompressor().decompress(data.as_buffer())
        v = int(np.frombuffer(raw, np.int64, 1)[0])
        unit, key = np.frombuffer(raw, "<u2", v, 8), np.frombuffer(raw, "<u4", v, 8 + 2 * v)
        return unit.astype(np.int64), key, _unplanes(raw[8 + 6 * v : 8 + 11 * v], 5).astype(np.int64), np.frombuffer(raw, bool, v, 8 + 11 * v)

    @staticmethod
    def read(tokens: pa.Scalar, words: pa.Scalar) -> Coded:
        raw = zstandard.ZstdDecompressor().decompress(tokens.as_buffer())
        n, d = np.frombuffer(raw, np.int64, 2).tolist()
        ids = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, 16).reshape(4, n).T).view("<u4").ravel()
        counts = np.frombuffer(raw, "<i8", d, 16 + 4 * n)
        return Coded(ids, counts, np.frombuffer(raw, bool, d, 16 + 4 * n + 8 * d), *Coded.read_words(words))

    def in_training(self) -> np.ndarray:
        return np.repeat(self.train, self.counts)

    def in_round(self, turn: int, rounds: int) -> np.ndarray:
        """Training positions of a round; every one is in exactly one of the rounds."""
        return self.in_training() & (np.arange(len(self.ids)) % rounds == turn)

    def slices(self, most: int = SLICE) -> Iterator[tuple[slice, slice]]:
        """Tokens and documents of stretches of whole documents, of about so many tokens."""
        ends = np.concatenate(([0], np.cumsum(self.counts)))
        begin = 0
        while begin < len(self.counts):
            end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + most, side="right")) - 1)
            yield slice(int(ends[begin]), int(ends[end])), slice(begin, end)
            begin = end


def _low(key: np.ndarray) -> np.ndarray:
    """The 32 bits of a digest that words keep."""
    return (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def coded_chunks(table: DataFrame, answers: DataFrame, units: Units) -> DataFrame:
    """Written: tokens and words of each chunk as numbers (Coded), and its other columns."""

    def code(left: pa.Table, right: pa.Table) -> pa.Table:
        tidy()
        found = {r["grp"]: (r["n"], r["own"]) for r in right.to_pylist()}
        out = []
        for body, rest in zip(left["body"], left["rest"], strict=True):
            t = Tokens.read(body, rest)
            key, check, shape = _keys(t.chunk.texts)
            order = np.lexsort((check, key))
            parts = [_unplanes(found[g][0], 5).astype(np.int64) for g in sorted(found)]
            n, own = np.empty(len(key), np.int64), np.empty(len(key), bool)
            n[order] = np.concatenate(parts)
            own[order] = np.concatenate([np.unpackbits(np.frombuffer(found[g][1], np.uint8), count=len(p)).astype(bool) for g, p in zip(sorted(found), parts, strict=True)])
            coded = Coded(t.chunk.ids, t.chunk.counts, t.train, units.of(key, shape), _low(key), n, own)
            out.append((coded.tokens(), coded.words(), rest.as_py()))
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, pa.binary()) for c in columns], names=["tokens", "words", "rest"])

    found = table.select("chunk", "body", "rest").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(code, "tokens binary, words binary, rest binary")
    return written(found, "coded", block_mb=8)


def cell_counts(coded: DataFrame, leaf: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and distinct training words of every cell."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in batch.column("words"):
                unit, key, n, own = Coded.read_words(words)
                mine = np.flatnonzero(own & (n > 0) & (leaf[unit] % SUBCLASSES == SUBCLASSES - 1))
                cell, at = np.unique(cells_of(leaf[unit[mine]] // SUBCLASSES, key[mine], levels), return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(np.bincount(at, weights=n[mine], minlength=len(cell)).astype(np.int64)), pa.array(np.bincount(at, minlength=len(cell)))], names=["cell", "mass", "types"])

    mass, types = np.zeros((2, CLASSES * DIGITS**levels))
    for r in coded.select("words").mapInArrow(count, "cell long, mass long, types long").groupBy("cell").agg(F.sum("mass").alias("mass"), F.sum("types").alias("types")).toArrow().to_batches():
        at = r.column("cell").to_numpy()
        mass[at], types[at] = r.column("mass").to_numpy(), r.column("types").to_numpy()
    return mass, types


def levels_for(distinct: int) -> int:
    """Levels below the classes, so that a cell has some CELL words."""
    return min(LEVELS, max(0, round(math.log(max(distinct, 1) / (CLASSES * CELL), DIGITS))))


def fit(docs: DataFrame, rounds: int = ROUNDS, size: int = CHUNK, group: int = GROUP) -> tuple[Model, DataFrame]:
    """The model of docs (doc_id, text, held_out), learned from the rows that are not held out, and all rows as coded chunks."""
    spark = docs.sparkSession
    table = chunks(docs, TOKENS, "doc_id", "text", size)

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [int(np.frombuffer(_head(b), np.int64, 3)[1]) for batch in batches for b in batch.column("body")]
        yield pa.RecordBatch.from_arrays([pa.array([sum(n)], pa.int64())], names=["n"])

    sent = table.select("body").mapInArrow(vocabulary, "n long").agg(F.sum("n")).first()[0] or 0
    bits = max(0, (sent // group).bit_length())
    counted = table.select("chunk", "body", "rest").mapInArrow(_send_counts(64 - bits), "chunk long, grp long, steps binary, checks binary, shapes binary, n binary")
    counted = written(counted.groupBy("grp").applyInArrow(_sum_counts, COUNTED), "counts")
    answers, statistics = counted.where("chunk IS NOT NULL").select("chunk", "grp", "n", "own"), counted.where("chunk IS NULL")

    # Words, types and the most frequent words: sizes of the model, whatever the input's.
    lead = statistics.select(F.explode("lead").alias("w")).select("w.*").orderBy(F.desc("n"), "key").limit(TOP).collect()
    by_shape = statistics.select(F.posexplode(F.arrays_zip("mass", "types")).alias("shape", "x")).groupBy("shape").agg(F.sum("x.mass").alias("mass"), F.sum("x.types").alias("types")).collect()
    mass, types = np.zeros(UNITS), np.zeros(UNITS)
    for r in by_shape:
        mass[TOP + r["shape"]], types[TOP + r["shape"]] = r["mass"], r["types"]
    total, distinct = int(mass.sum()), int(types.sum())
    for i, r in enumerate(lead):
        mass[i], types[i] = r.n, 1
        mass[TOP + r.shape] -= r.n
        types[TOP + r.shape] -= 1
    keys = np.array([r.key for r in lead], np.int64).view(np.uint64)
    order = np.argsort(keys)
    units = Units(keys[order], order.astype(np.int64))
    coded = coded_chunks(table, answers, units)
    discard(table, counted)

    # Tasks grow with the tokens, whatever the partitions: each returns a copy of the weights in each round.
    shards = coded.select("tokens", "words").coalesce(max(1, min(total >> FEW, max(TASKS, total >> MANY))))
    start = start_of(units)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(UNITS * 2 * ANCHORS, np.int64)
        for batch in batches:
            for tokens_, words in zip(batch.column("tokens"), batch.column("words"), strict=True):
                t = Coded.read(tokens_, words)
                for at, documents in t.slices():
                    unit, counts = t.unit[t.ids[at]], t.counts[documents]
                    inside = np.repeat(t.train[documents], counts)
                    pair = inside[1:] & (np.diff(np.repeat(np.arange(len(counts)), counts)) == 0)
                    left, right = unit[:-1][pair], unit[1:][pair]
                    a, b = left < ANCHORS, right < ANCHORS
                    cells = np.concatenate([right[a] * 2 * ANCHORS + left[a], left[b] * 2 * ANCHORS + ANCHORS + right[b]])
                    found += np.bincount(cells, minlength=len(found))
        yield from _blocks(found, 16)

    matrix = summed(shards.mapInArrow(contexts, "block int, data binary"), UNITS * 2 * ANCHORS).reshape(UNITS, -1)
    leaf, levels = cluster(matrix, mass), levels_for(distinct)
    model = fresh_model(units, leaf, mass, types, levels, *cell_counts(coded, leaf, levels), total, distinct)

    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def learn(batches: Iterator[pa.RecordBatch], turn: int = turn, shared=shared) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(shared.value)
            for batch in batches:
                for tokens_, words in zip(batch.column("tokens"), batch.column("words"), strict=True):
                    t = Coded.read(tokens_, words)
                    wanted = t.in_round(turn, rounds)
                    for at, documents in t.slices():
                        ids = t.ids[at]
                        trainer.learn(t.unit[ids], t.key[ids], t.counts[documents], start, wanted[at])
            yield from _blocks(trainer.changes(), 32)

        apply_changes(model, summed(shards.mapInArrow(learn, "block int, data binary"), size_of_changes()))
    return model, coded


def language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, size: int = CHUNK, group: int = GROUP) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null texts are empty texts, of one token, the end. Null ids count as the empty text in
    the choice of held-out rows. Repeated rows are separate documents. Without training rows
    all words are unknown. An empty table gives an empty table.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), (crc_bucket(id_col, HELD_OUT) == 0).alias("held_out"))
    model, coded = fit(rows, rounds, size, group)
    shared, start = docs.sparkSession.sparkContext.broadcast(model), start_of(model.units)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tokens_, words, rest in zip(batch.column("tokens"), batch.column("words"), batch.column("rest"), strict=True):
                m, t = shared.value, Coded.read(tokens_, words)
                share = np.log10((t.n + 0.1) / (m.total + 0.1 * (m.distinct + 1)))
                sums = []
                for at, documents in t.slices():
                    ids, counts = t.ids[at], t.counts[documents]
                    n, heads = t.n[ids], np.cumsum(counts) - counts
                    found = token_scores(m, t.unit[ids], t.key[ids], n, counts, start)
                    sums.append([np.add.reduceat(x, heads) for x in ((n > 0).astype(np.int64), share[ids], found)])
                others = pa.ipc.open_stream(rest.as_buffer()).read_all().combine_chunks()
                columns = [others["doc_id"].combine_chunks(), others["held_out"].combine_chunks(), pa.array(t.counts, pa.int64()), *(pa.array(np.concatenate(x)) for x in zip(*sums, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
        tidy()

    kind = dict(rows.dtypes)["doc_id"]
    found = coded.mapInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def _head(body: pa.Scalar) -> bytes:
    return zstandard.ZstdDecompressor().decompressobj().decompress(body.as_buffer().to_pybytes()[: 1 << 17])[:24]


def start_of(units: Units) -> tuple[int, int]:
    """Unit and key that stand before a document: those of the end."""
    key, _, shape = _keys([b""])
    return int(units.of(key, shape)[0]), int(_low(key)[0])

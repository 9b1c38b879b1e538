"""Document quality from a linear-chain conditional random field over lines.

Every line gets features of its own bytes and of the lines before and after it. The chain
labels each line good or bad; it is fitted on a bounded number of labelled documents, each
line taking its document's label, as labels exist for documents only. So the wanted label
never changes within a chain, and what the transitions learn is how strongly neighbouring
lines speak for each other: doubtful lines follow their surroundings. A document's score is the
mean marginal probability of "good", weighted by line length, passed through a logistic
calibration fitted on the same documents. Inputs are texts only.

The fit maximises one function, the sum over documents of the chain's log likelihood divided by
the document's number of lines (so a document counts once, whatever its length), less a
quadratic penalty, by Adam over batches of lines. Documents of any length take part whole, as
chains of at most PIECE_LINES lines.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sigil.llm.common import crc_bucket, discard, slices, small_batches, texts_of, written

#: The fit uses at most so many labelled documents, those of the smallest id hashes.
SAMPLE_DOCUMENTS = 3000
#: Lines whose features are held at once, and lines of a document that form one chain in the fit.
BLOCK_LINES = 16_384
PIECE_LINES = 2048
#: Passes over the sample, lines in a step, and bytes of features that the driver holds at once.
EPOCHS, STEP_LINES, PART_BYTES = 30, 8192, 64 << 20
HELD_OUT = 5
THRESHOLD = 0.3


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Byte -> fine class (16) and coarse class (6: lower, upper, digit, space, stop, symbol)."""
    fine, coarse = np.full(256, 15, np.uint8), np.full(256, 5, np.uint8)
    groups = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\x0b\x0c", ".", ",;:", "!?", "$%&", "*#@", "|", "'\"`-", "()[]{}", "<>/\\=+~^_")
    for k, group in enumerate(groups):
        for c in group.encode():
            fine[c] = k
            coarse[c] = (0, 1, 2, 3, 4, 4, 5, 5, 5, 5, 4, 4, 5)[k]
    fine[128:192], fine[192:], coarse[128:], coarse[10] = 13, 14, 0, 3
    return fine, coarse


_FINE, _COARSE = _classes()
N_OWN = 16 + 36 + 6
#: Powers of an odd number: polynomial digests modulo 2**64.
_ODD = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


@dataclass
class Lines:
    """Own features [lines, N_OWN], bytes and word digest of each line, and lines of each document."""

    own: np.ndarray
    sizes: np.ndarray
    digest: np.ndarray
    counts: np.ndarray


def _words(data: np.ndarray, space: np.ndarray, line: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """By line: words equal to the word before them, and a digest of the words."""
    doubled, digests = np.zeros(n, np.int64), np.zeros(n, np.uint64)
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1]))) if n else np.zeros(0, np.int64)
    if not len(starts):
        return doubled, digests
    reach = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, reach)
    values = (data[starts[0] :].astype(np.uint64) + 1) * _ODD[place & 63]
    values[space[starts[0] :]] = 0
    words, owner = np.add.reduceat(values, starts - starts[0]), line[starts]
    same = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    doubled += np.bincount(owner[1:][same], minlength=n)
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    order = np.arange(len(words)) - np.repeat(heads, np.diff(np.append(heads, len(words))))
    digests[owner[heads]] = np.add.reduceat((words ^ (words >> np.uint64(29))) * _ODD[order & 63], heads)
    return doubled, digests


#: The column that says whether the line stands earlier in its document.
_AGAIN = N_OWN - 3


def line_features(raw: list[bytes]) -> Lines:
    """Of these texts; all but the column _AGAIN, which looks at a whole document."""
    counts = np.array([t.count(b"\n") + 1 for t in raw], np.int64)
    # A line's bytes run from the line end before it to its own, wherever the block begins.
    data = np.frombuffer(b"\n".join([b"", *raw, b""]) if raw else b"\n", np.uint8)
    around, data = _COARSE[data].astype(np.int64), data[1:]
    ends = np.flatnonzero(data == 10)
    n = len(ends)
    starts = np.concatenate(([0], ends[:-1] + 1)) if n else ends
    sizes = ends - starts
    line = np.repeat(np.arange(n), sizes + 1)
    fine = np.bincount(line * 16 + _FINE[data], minlength=16 * n).reshape(n, 16)
    fine[:, 15] -= 1 if n else 0  # the line's end
    pairs = np.bincount(line * 36 + around[:-1] * 6 + around[1:], minlength=36 * n).reshape(n, 36)
    spread = np.maximum(sizes, 1)[:, None]
    words = pairs.reshape(n, 6, 6)[:, 3, :].sum(1) - pairs[:, 21] + 1
    letters = fine[:, 0] + fine[:, 1] + fine[:, 14]
    doubled, digest = _words(data, around[1:] == 3, line, n)
    own = np.column_stack([fine / spread, pairs / spread, np.log1p(sizes) / 8, letters / words / 8, sizes == 0, np.zeros(n), np.log1p(words) / 6, doubled / words]).astype(np.float32)
    return Lines(own, sizes, digest, counts)


def blocks(texts: list[str], lines: int = BLOCK_LINES) -> Iterator[Lines]:
    """Features of whole texts, in blocks of at most so many lines; a longer text is spread over several."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        raw = text.encode()
        at = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
        if held and size + len(at) + 1 > lines:
            yield line_features(held)
            held, size = [], 0
        begin = 0
        for k in range(lines - 1, len(at), lines):
            yield line_features([raw[begin : at[k]]])
            begin = int(at[k]) + 1
        held.append(raw[begin:])
        size += (len(at) + 1) % lines or lines
    if held:
        yield line_features(held)


def again(digest: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which lines stand earlier in their document, word by word."""
    owner = np.repeat(np.arange(len(counts)), counts).astype(np.uint64)
    _, first, back = np.unique(digest ^ (owner * _ODD[1]), return_index=True, return_inverse=True)
    return (first[back] != np.arange(len(digest))) & (sizes > 0)


def emissions(own_side: np.ndarray, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log odds of "good" for each line from own_side [lines, 3], products of the lines' own features with
    the weights of the line itself, of the line after it and of the line before it.
    """
    inner = np.ones(len(own_side) + 1, bool)  # inner[t]: lines t - 1 and t are of one chain
    inner[np.concatenate(([0], np.cumsum(counts)))] = False
    up = own_side[:, 0].astype(np.float64) + weights[-1]
    up[1:] += own_side[:-1, 1] * inner[1:-1]
    up[:-1] += own_side[1:, 2] * inner[1:-1]
    return up + weights[-3] * ~inner[:-1] + weights[-2] * ~inner[1:]


def _forward(unary: np.ndarray, trans: np.ndarray, begin: np.ndarray, length: np.ndarray, carry: np.ndarray) -> np.ndarray:
    """Forward messages of pieces that lie one after another; carry is what each one's first line gets
    from before. All pieces advance together: step t handles those longer than t.
    """
    order = np.argsort(-length, kind="stable")
    first, ranked = begin[order], length[order]
    out = unary.copy()
    out[begin] += carry
    steps = int(ranked[0]) if len(ranked) else 0
    active = np.searchsorted(-ranked, -np.arange(steps + 1), side="left")
    for t in range(1, steps):
        at = first[: active[t]] + t
        before = out[at - 1]
        out[at] += np.logaddexp(before[:, :1] + trans[0], before[:, 1:] + trans[1])
    return out


def messages(unary: np.ndarray, trans: np.ndarray, counts: np.ndarray, piece: int = 256) -> np.ndarray:
    """Forward messages of whole chains. A long chain is cut into pieces, whose effect on both
    states is found for all at once, then composed in order; so the steps are few for any length.
    """
    parts = -(-counts // piece)
    chain_of = np.repeat(np.arange(len(counts)), parts)
    number = np.arange(len(chain_of)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(np.cumsum(counts) - counts, parts) + number * piece
    length = np.minimum(piece, counts[chain_of] - number * piece)
    carry = np.zeros((len(begin), 2))
    if len(parts) and parts.max() > 1:
        last = begin + length - 1
        through = np.stack([_forward(unary, trans, begin, length, np.broadcast_to(trans[s], carry.shape))[last] for s in (0, 1)], 1)
        end = _forward(unary, trans, begin, length, carry)[last]  # right for first pieces
        order = np.argsort(number, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(number[order])) + 1)[1:]:
            before = end[some - 1]
            carry[some] = np.logaddexp(before[:, :1] + trans[0], before[:, 1:] + trans[1])
            end[some] = np.logaddexp(before[:, :1] + through[some, 0], before[:, 1:] + through[some, 1])
    return _forward(unary, trans, begin, length, carry)


def chain(unary: np.ndarray, trans: np.ndarray, counts: np.ndarray, weight: np.ndarray | None = None, piece: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Marginals [lines, 2] and summed pair marginals [2, 2], weighted by line, of chains that lie one after another."""
    forward = messages(unary, trans, counts, piece)
    backward = messages(unary[::-1], trans.T, counts[::-1], piece)[::-1]  # with the line's own part
    total = np.logaddexp(*(forward + backward - unary).T)
    marginal = np.exp(forward + backward - unary - total[:, None])
    inner = np.ones(len(unary), bool)
    inner[np.cumsum(counts) - counts] = False
    at = np.flatnonzero(inner)  # every line but a chain's first
    share = np.ones(len(at)) if weight is None else weight[at]
    pair = np.array([[(share * np.exp(forward[at - 1, i] + trans[i, j] + backward[at, j] - total[at])).sum() for j in (0, 1)] for i in (0, 1)])
    return marginal, pair


@dataclass
class Model:
    """Weights of "good" against "bad" by feature, transitions, and the logistic calibration."""

    weights: np.ndarray
    trans: np.ndarray
    scale: float
    shift: float

    def sides(self) -> np.ndarray:
        """[N_OWN, 3]: weights of a line's own features for itself, the line after and the line before it."""
        return np.stack([self.weights[:N_OWN], self.weights[N_OWN : 2 * N_OWN], self.weights[2 * N_OWN : 3 * N_OWN]], 1)

    def means(self, texts: list[str]) -> np.ndarray:
        """Of each text the mean marginal of "good". Memory: some 150 bytes a line, and one block's features."""
        sides = self.sides()
        some = [(b.own @ sides, b.sizes, b.digest) for b in blocks(texts)]
        products, sizes, digest = (np.concatenate(x) for x in zip(*some, strict=True))
        counts = np.array([t.count("\n") + 1 for t in texts], np.int64)
        products[again(digest, sizes, counts)] += sides[_AGAIN]
        up = emissions(products, self.weights, counts)
        marginal, _ = chain(np.stack([np.zeros_like(up), up], 1), self.trans, counts)
        weight = np.maximum(sizes, 1).astype(float)
        starts = np.cumsum(counts) - counts
        return np.add.reduceat(marginal[:, 1] * weight, starts) / np.add.reduceat(weight, starts)

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.scale * _logit(self.means(texts)) + self.shift, -50, 50)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class Piece:
    """A stretch of a labelled document: own features, bytes by line, label, and lines of the whole document."""

    document: int
    own: np.ndarray
    sizes: np.ndarray
    label: int
    lines: int


class Fit:
    """Adam on the weighted log likelihood, and the documents' means for the calibration."""

    def __init__(self, documents: int, rate: float = 0.1, decay: float = 1e-3) -> None:
        self.documents, self.rate, self.decay, self.steps = documents, rate, decay, 0
        self.model = Model(np.zeros(3 * N_OWN + 3), np.zeros((2, 2)), 1.0, 0.0)
        self.moments = np.zeros((2, 3 * N_OWN + 7))

    def gradient(self, batch: list[Piece]) -> tuple[np.ndarray, float]:
        """Of the mean negative log likelihood of the batch's documents; and how many documents' worth of lines it has."""
        model, counts = self.model, np.array([len(p.own) for p in batch])
        own = np.concatenate([p.own for p in batch])
        up = emissions(own @ model.sides().astype(np.float32), model.weights, counts)
        share = np.repeat([1 / p.lines for p in batch], counts)
        gold = np.repeat([p.label for p in batch], counts)
        marginal, pair = chain(np.stack([np.zeros_like(up), up], 1), model.trans, counts, share)
        inner = np.ones(len(own) + 1, bool)
        inner[np.concatenate(([0], np.cumsum(counts)))] = False
        off = ((marginal[:, 1] - gold) * share).astype(np.float32)
        slope = np.concatenate([own.T @ off, own[:-1].T @ (off[1:] * inner[1:-1]), own[1:].T @ (off[:-1] * inner[1:-1]), [(off * ~inner[:-1]).sum(), (off * ~inner[1:]).sum(), off.sum()]])
        wanted = np.bincount(gold[inner[:-1]], weights=share[inner[:-1]], minlength=2)
        size = share.sum()
        return np.concatenate([slope, (pair - np.diag(wanted)).ravel()]) / size, size

    def step(self, batch: list[Piece]) -> None:
        grad, _ = self.gradient(batch)
        values = np.concatenate([self.model.weights, self.model.trans.ravel()])
        grad += self.decay * values / len(values)
        self.steps += 1
        self.moments[0] = 0.9 * self.moments[0] + 0.1 * grad
        self.moments[1] = 0.99 * self.moments[1] + 0.01 * grad**2
        rate = self.rate / (1 + self.steps / 100)
        values = values - rate * self.moments[0] / (1 - 0.9**self.steps) / (np.sqrt(self.moments[1] / (1 - 0.99**self.steps)) + 1e-8)
        self.model.weights, self.model.trans = values[:-4], np.clip(values[-4:].reshape(2, 2), -4, 4)

    def calibrate(self, pieces: Iterable[Piece]) -> Model:
        good, weight, label = np.zeros(self.documents), np.zeros(self.documents), np.zeros(self.documents)
        model = self.model
        for p in pieces:
            up = emissions(p.own @ model.sides().astype(np.float32), model.weights, np.array([len(p.own)]))
            marginal, _ = chain(np.stack([np.zeros_like(up), up], 1), model.trans, np.array([len(up)]))
            long = np.maximum(p.sizes, 1)
            good[p.document] += marginal[:, 1] @ long
            weight[p.document] += long.sum()
            label[p.document] = p.label
        seen = weight > 0
        scale, shift = _logistic(_logit(good[seen] / weight[seen]), label[seen])
        return Model(model.weights.astype(np.float32), model.trans, scale, shift)


def batches_of(pieces: Iterable[Piece], lines: int = STEP_LINES) -> Iterator[list[Piece]]:
    held: list[Piece] = []
    for p in pieces:
        held.append(p)
        if sum(len(x.own) for x in held) >= lines:
            yield held
            held = []
    if held:
        yield held


def constant(good: int, all_: int) -> Model:
    """A model without features: the smoothed share of good documents."""
    return Model(np.zeros(3 * N_OWN + 3, np.float32), np.zeros((2, 2)), 0.0, float(np.log((good + 1) / (all_ - good + 1))))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Scale and shift by damped Newton steps, with smoothed targets (Platt)."""
    good = y.sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    beta, design = np.array([0.5, 0.0]), np.stack([x, np.ones_like(x)], 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -50, 50)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(hessian, design.T @ (p - target) + 1e-3 * beta), -1, 1)
    return float(max(beta[0], 1e-3)), float(beta[1])


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts as rows of pieces with their features."""
    for batch in batches:
        for number, label, text in zip(batch.column("number").to_pylist(), batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
            lines, begin = text.count("\n") + 1, 0
            digest, sizes = (np.concatenate(x) for x in zip(*((b.digest, b.sizes) for b in blocks([text])), strict=True))
            repeated = again(digest, sizes, np.array([lines]))
            for block in blocks([text], PIECE_LINES):
                end = begin + len(block.own)
                block.own[:, _AGAIN] = repeated[begin:end]
                row = {"number": number, "begin": begin, "label": label, "lines": lines, "own": block.own.astype("<f4").tobytes(), "sizes": block.sizes.astype("<i8").tobytes()}
                yield pa.RecordBatch.from_pylist([row], pa.schema([("number", pa.int64()), ("begin", pa.int64()), ("label", pa.int64()), ("lines", pa.int64()), ("own", pa.binary()), ("sizes", pa.binary())]))
                begin = end


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE_DOCUMENTS, epochs: int = EPOCHS, part_bytes: int = PART_BYTES) -> Model:
    """Fits on labelled rows outside the held-out fifth. Null ids, null labels and labels
    other than 0 and 1 are left out; of several labels of a document the smallest counts, of
    several texts the smallest. Features are made by the tasks and written; the driver reads
    them in parts of bounded size, once an epoch if there are several.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_bucket("doc_id", HELD_OUT) != 0))
        .groupBy(F.col("doc_id").alias("sampled_id"))
        .agg(F.min("quality").cast("long").alias("label"))
        .orderBy(F.xxhash64("sampled_id"), "sampled_id")
        .limit(most)
    )
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    joined = rows.join(F.broadcast(chosen), rows.doc_id == chosen.sampled_id).groupBy("sampled_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    small_batches(docs)
    # At most `most` rows are numbered, in one order whatever the partitions.
    order = Window.orderBy(F.xxhash64("sampled_id"), "sampled_id")
    texts = written(joined, "sample")
    numbered = texts.join(F.broadcast(numbers_of(texts, order)), "sampled_id").select("number", "label", "text")
    pieces = written(numbered.mapInArrow(_cut, "number long, begin long, label long, lines long, own binary, sizes binary"), "pieces")
    stats = pieces.agg(F.count_distinct("number"), F.sum(F.length("own"))).first()
    good = pieces.where("begin = 0").agg(F.sum("label")).first()[0] or 0
    documents, size = stats[0], stats[1] or 0
    if not 0 < good < documents:
        discard(texts, pieces)
        return constant(good, documents)
    # A part has every so-many-th document, in order.
    parts = -(-size // part_bytes)
    held: tuple[int, list[Piece]] = (-1, [])

    def part(k: int) -> list[Piece]:
        nonlocal held
        if held[0] != k:
            held = (-1, [])
            found = pieces.where(F.col("number") % parts == k).orderBy("number", "begin").toArrow()
            held = (k, [Piece(r["number"], np.frombuffer(r["own"], "<f4").reshape(-1, N_OWN), np.frombuffer(r["sizes"], "<i8"), r["label"], r["lines"]) for r in found.to_pylist()])
        return held[1]

    work = Fit(documents)
    for _ in range(epochs):
        for k in range(parts):
            for batch in batches_of(part(k)):
                work.step(batch)
    model = work.calibrate(itertools.chain.from_iterable(part(k) for k in range(parts)))
    discard(texts, pieces)
    return model


def numbers_of(texts: DataFrame, order: WindowSpec) -> DataFrame:
    return texts.select("sampled_id").withColumn("number", F.row_number().over(order).cast("long") - 1)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted. Null texts are empty texts;
    null ids and repeated rows are scored like all others; an empty table gives an empty table.
    """
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, mb=1):
            values = shared.value.scores(texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(values, pa.float64()), pa.array((values >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(docs[id_col].alias("doc_id"), (crc_bucket(id_col, HELD_OUT) == 0).alias("held_out"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score the threshold or more, unchanged, with all their columns."""
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, mb=1):
            yield batch.filter(pa.array(shared.value.scores(texts_of(batch.column(text_col))) >= threshold))

    return docs.mapInArrow(run, docs.schema)

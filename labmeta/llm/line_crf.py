"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Features of the line and of its neighbours weigh for either label, and weights of label pairs
tie neighbouring lines together. Forward and backward passes give each line's probability of being good, and a
document's score is their mean, weighted by line length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labmeta.llm.held import lean
from labmeta.llm.wordhash import hash_words, runs, utf8

#: Labelled documents that the weights are learned from at most, lines of each learning chain, and learning steps.
LEARNING_DOCS, CHAIN, STEPS = 4_000, 400, 250
_RATE, _DECAY = 0.05, 1e-4
#: Lines that a product is made for at a time, when weights are learned.
_AT_ONCE = 1 << 14
_KINDS = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "wide": range(128, 256), "exclaim": b"!",
    "odd": b"*$%#&@^~_+=\\", "bar": b"|", "bracket": b"<>{}[]()", "stop": b".,;:?", "quote": b"\"'`-/",
}
_STEPS = (0.0, 0.01, 0.03, 0.08, 0.2, 0.5)
_LENGTHS = (1, 20, 80, 250, 800)


def own_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the lines themselves (0 or 1, one row a line), lengths of the lines, and where each text's lines begin.

    Lines are parted by 0x0A; every text has one at least, so a null or empty text has one empty line.
    """
    data, offsets = utf8(column)
    breaks = np.flatnonzero(data == 10)
    # A line ends at each break and at each text's end.
    ends = np.concatenate([breaks, offsets[1:]])
    text = np.concatenate([np.searchsorted(offsets, breaks, side="right") - 1, np.arange(len(column))])
    order = np.lexsort((ends, text))
    ends, text = ends[order], text[order]
    first = np.searchsorted(text, np.arange(len(column) + 1))
    starts = np.empty_like(ends)
    starts[1:] = ends[:-1] + 1
    starts[first[:-1]] = offsets[:-1]
    length = ends - starts

    def per_line(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[ends] - sums[starts]

    least = np.maximum(length, 1)
    shares = [per_line(np.isin(data, np.frombuffer(bytes(kind), np.uint8))) / least for kind in _KINDS.values()]
    hashes, at = hash_words(data, np.append(starts, len(data)), fold=True)
    # words of a line: those that begin in it
    at = np.append(at[:-1], len(hashes))
    words = np.diff(at)
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    twice = np.zeros(len(hashes), bool)
    twice[2:] = hashes[2:] == hashes[:-2]

    def per_words(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[at[1:]] - sums[at[:-1]]) / np.maximum(words, 1)

    shares += [per_words(same), per_words(same | twice)]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes)])
    line = sums[at[1:]] - sums[at[:-1]]
    again = np.zeros(len(line), bool)
    again[1:] = (line[1:] == line[:-1]) & (words[1:] > 0)
    mean = length / np.maximum(words, 1)
    own = [np.ones(len(length), bool)]
    own += [s > step for s in shares for step in _STEPS]
    own += [length >= x for x in _LENGTHS] + [mean > x for x in (3, 5, 8, 12, 20)] + [again]
    return np.stack(own, 1), length, first


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``own_features``, with the features of the line before and of the line after in the same row."""
    own, length, first = own_features(column)
    own = own.astype(np.float32)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.concatenate([own, before, after], 1), length, first


def _passes(unary: np.ndarray, pair: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities of label 1 as odds, and the sum of the expected label pairs.

    ``unary``: the weight of label 1 over label 0 of each line. All chains move one line a step, the longest first.
    """
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    heads, counts = first[:-1][order], counts[order]
    forward, backward = np.zeros((len(unary), 2)), np.zeros((len(unary), 2))
    forward[heads, 1] = unary[heads]
    active = np.searchsorted(-counts, -np.arange(1, counts[0] if len(counts) else 1), side="left")
    for t, n in enumerate(active, 1):
        at = heads[:n] + t
        last = forward[at - 1]
        for y in (0, 1):
            forward[at, y] = np.logaddexp(last[:, 0] + pair[0, y], last[:, 1] + pair[1, y])
        forward[at, 1] += unary[at]
    for t in range(len(active), 0, -1):
        at = heads[: active[t - 1]] + t
        zero, one = backward[at, 0], backward[at, 1] + unary[at]
        for y in (0, 1):
            backward[at - 1, y] = np.logaddexp(zero + pair[y, 0], one + pair[y, 1])
    both = forward + backward
    odds = both[:, 1] - both[:, 0]
    inner = np.ones(len(unary), bool)
    inner[first[1:] - 1] = False
    at = np.flatnonzero(inner)
    total = np.logaddexp(both[at, 0], both[at, 1])
    expected = np.zeros((2, 2))
    for x in (0, 1):
        for y in (0, 1):
            value = forward[at, x] + pair[x, y] + backward[at + 1, y] + (unary[at + 1] if y else 0)
            expected[x, y] = np.exp(value - total).sum()
    return odds, expected


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class _Lines:
    """Lines of many texts, by their own features only, a byte each; neighbours' are read from their rows.

    Texts are gone through in blocks of bounded bytes, and products are made for some lines at a time.
    """

    def __init__(self, column: pa.Array):
        blocks, counts = [], [np.zeros(1, np.int64)]
        for a, b in runs(np.diff(utf8(column)[1])):
            own, _, first = own_features(column.slice(a, b - a))
            blocks.append(own)
            counts.append(np.diff(first))
        self.first = np.cumsum(np.concatenate(counts))
        self.own = np.concatenate(blocks)
        #: Whether a line has one after it in its text.
        self.followed = np.ones(len(self.own), bool)
        self.followed[self.first[1:] - 1] = False

    def _slices(self) -> Iterator[slice]:
        return (slice(a, a + _AT_ONCE) for a in range(0, len(self.own), _AT_ONCE))

    def weigh(self, w: np.ndarray) -> np.ndarray:
        """``features @ w`` for the rows of ``line_features``."""
        parts = w.reshape(3, -1).T
        sums = np.concatenate([self.own[x] @ parts for x in self._slices()])
        out = sums[:, 0]
        out[1:] += np.where(self.followed[:-1], sums[:-1, 1], 0)
        out[:-1] += np.where(self.followed[:-1], sums[1:, 2], 0)
        return out

    def gather(self, values: np.ndarray) -> np.ndarray:
        """``features.T @ values``."""
        each = np.zeros((3, len(values)))
        each[0] = values
        each[1, :-1] = np.where(self.followed[:-1], values[1:], 0)  # a line is the one before the next
        each[2, 1:] = np.where(self.followed[:-1], values[:-1], 0)
        return sum(each[:, x] @ self.own[x] for x in self._slices()).ravel()


def learn_weights(column: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features and of label pairs, by gradient ascent on the conditional likelihood.

    Every line of a text has the text's label. Each text weighs the same. Long texts are cut into chains.
    """
    lines = _Lines(column)
    first = lines.first
    counts = np.diff(first)
    line_label = np.repeat(labels, counts).astype(float)
    weight = np.repeat(1 / counts, counts)
    cuts = [np.arange(a, b, CHAIN) for a, b in zip(first[:-1], first[1:], strict=True)]
    first = np.append(np.concatenate(cuts), first[-1])
    inner = np.ones(len(line_label), bool)
    inner[first[1:] - 1] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (line_label[at].astype(int), line_label[at + 1].astype(int)), 1)
    w, pair = np.zeros(3 * lines.own.shape[1]), np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(pair), np.zeros_like(pair)]
    for step in range(1, STEPS + 1):
        odds, expected = _passes(lines.weigh(w), pair, first)
        slopes = (lines.gather((line_label - _sigmoid(odds)) * weight) / len(labels), (seen - expected) / max(len(at), 1))
        for i, (value, slope) in enumerate(((w, slopes[0]), (pair, slopes[1]))):
            slope = slope - _DECAY * value
            m, v = moments[2 * i], moments[2 * i + 1]
            m += 0.1 * (slope - m)
            v += 0.01 * (slope**2 - v)
            value += _RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w, pair


def scores(column: pa.Array, w: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Length-weighted means of the lines' probabilities of being good."""
    lengths = np.diff(utf8(column)[1])
    out = []
    for a, b in runs(lengths):
        features, length, first = line_features(column.slice(a, b - a))
        odds, _ = _passes(features @ w, pair, first)
        weight = np.maximum(length, 1e-9)
        out.append(np.add.reduceat(_sigmoid(odds) * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]))
    return np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0)


@lean
def _learner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches), pa.schema([("text", pa.string()), ("label", pa.int32())]))
    if table.num_rows:
        text = table.column("text").combine_chunks()
        w, pair = learn_weights(text, table.column("label").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([w.tolist()]), pa.array([pair.ravel().tolist()])], ["w", "pair"])


def learn(docs: DataFrame, labels: DataFrame, most: int = LEARNING_DOCS) -> tuple[np.ndarray, np.ndarray] | None:
    """Weights from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, label``); None without a labelled document.

    Of the labels, ``most`` at most are used, those of the smallest id hashes: the classifier's only bound, which makes
    learning one small task whatever the number of labels. They are chosen on the labels alone and sent to the documents.
    """
    labels = labels.filter("label is not null and doc_id is not null").select(F.col("doc_id").alias("_id"), F.col("label").cast("int"))
    chosen = labels.orderBy(F.xxhash64("_id"), "label").limit(most)
    rows = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "label").repartition(1)
    found = rows.mapInArrow(_learner, "w array<double>, pair array<double>").first()
    return (np.array(found["w"]), np.array(found["pair"]).reshape(2, 2)) if found else None


def _scorer(weights: tuple[np.ndarray, np.ndarray] | None):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = scores(batch.column("text"), *weights) if weights else np.full(batch.num_rows, 0.5)
            names = [*batch.schema.names, "score"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names)

    return run


def with_quality(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """``docs`` with a column ``score`` of 0 to 1, from whole texts; no shuffle.

    A null or empty text is one empty line. Without weights every score is 0.5. A column ``score`` of the input is
    replaced.
    """
    docs = docs.drop("score")
    return docs.mapInArrow(_scorer(weights), T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))

"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A random walk over a word sequence (CGK embedding) turns edit distance into Hamming distance: at each step it emits the
current word and moves on or stays, by a coin tossed from the step and the word. After an edit two walks fall into step
again after a while. Every word of a text starts a window of an item's size; its walk is that of all items' windows there, which
only end at different steps. Bit sampling hashes a few steps of a walk. A window is a candidate for an item if any of many
such samples agree, and only steps are sampled at which the item's walk has not ended. A walk covers few words, so an item is
sampled along its whole length, from a word in every ``EVERY``: edits in one part leave the others to be found by. Candidates are verified by exact
edit distance over whole words, around every place where a match near the window can begin.

Items whose share of edits allows one at most are searched exactly: without an edit by the hash of all their words, with
one by the hashes of their halves, of which one is whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labmeta.llm.held import lean
from labmeta.llm.wordhash import SPACE, Block, hash_words, mix, rolled, runs, utf8

SIMILARITY = 0.8
#: Walks, their steps that are sampled, samples in all, and steps of a sample, which are ``GAP`` apart at least. Measured: 0.97
#: of random matches with as many edits as are allowed have a sample that agrees, and 0.99 of those with half as many.
WALKS, LENGTH, SAMPLES, STEPS, GAP = 4, 24, 48, 3, 3
#: Words from one start of an item's walks to the next: as many as a walk covers on average.
EVERY = LENGTH // 2
#: Window starts whose walks are made at once, and pairs of a window and an item that are looked at at once.
TOGETHER, PAIRS = 1 << 14, 1 << 17
#: Items are sent to tasks in parts of about so many characters, one pass over the documents each.
PART_CHARS = 8_000_000
_KEEP = SPACE.copy()
_KEEP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_U = np.uint64
_COINS = mix(np.arange(1, WALKS * LENGTH + 1, dtype=np.uint64)).reshape(WALKS, LENGTH) | _U(1)


def _spots() -> np.ndarray:
    """The steps of each sample, ascending; sample ``i`` is of walk ``i % WALKS``."""
    draw, out = 0, []
    while len(out) < SAMPLES:
        shares = mix(np.arange(draw, draw + STEPS, dtype=np.uint64) + _U(1 << 40)) >> _U(11)
        own = np.sort((shares / float(1 << 53) * LENGTH).astype(np.int64))
        draw += STEPS
        if (np.diff(own) >= GAP).all():
            out.append(own)
    return np.array(out)


SPOTS = _spots()


def allowed_edits(words: int, similarity: float = SIMILARITY) -> int:
    """Word edits that leave a similarity of ``similarity`` or more."""
    return int((1 - similarity) * words + 1e-9)


def plain_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes without ASCII marks, A-Z as a-z; words of marks only vanish."""
    keep = _KEEP[data]
    sums = np.concatenate([[0], np.cumsum(keep)])
    return hash_words(data[keep], sums[offsets], fold=True)


def _table(keys: np.ndarray, item: np.ndarray, shift: np.ndarray | None = None) -> Table:
    order = np.argsort(keys, kind="stable")
    distinct, first = np.unique(keys[order], return_index=True)
    bits = min(22, max(10, int(64 * len(keys)).bit_length()))
    seen = np.zeros(1 << bits, bool)
    seen[distinct >> _U(64 - bits)] = True
    at = np.zeros(len(keys), np.int64) if shift is None else shift[order]
    return Table(distinct, np.append(first, len(order)), item[order], at, seen, _U(64 - bits))


@dataclass
class Table:
    """Keys of items: the item of each, and how far into the item the key begins."""

    keys: np.ndarray
    places: np.ndarray
    item: np.ndarray
    at: np.ndarray
    seen: np.ndarray
    low: np.uint64

    def look_up(self, keys: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Items, where their keys stand, and how far into the item, of all ``keys`` at ``starts`` that are known; ``PAIRS`` at
        most at once."""
        maybe = np.flatnonzero(self.seen[keys >> self.low])
        spot = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        real = self.keys[spot] == keys[maybe]
        maybe, spot = maybe[real], spot[real]
        count = self.places[spot + 1] - self.places[spot]
        for first, last in runs(count, PAIRS):
            n, own = count[first:last], spot[first:last]
            pick = np.repeat(self.places[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield self.item[pick], np.repeat(starts[maybe[first:last]], n), self.at[pick]


@dataclass
class Items:
    """Items' ids, words and allowed edits. ``exact``: by a number of words, the items or halves of that size; ``sampled``: one
    table for each sample, of items that allow two edits or more."""

    ids: list[int | None]
    words: list[np.ndarray]
    edits: np.ndarray
    exact: dict[int, Table]
    sampled: list[Table | None]


def prepare(ids: list[int | None], texts: list[str | None], similarity: float = SIMILARITY) -> Items:
    """Items with their tables. An item without a word is never found."""
    hashes, offsets = plain_words(*utf8(pa.array(texts, pa.string())))
    words = [hashes[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    edits = np.array([allowed_edits(len(w), similarity) for w in words], np.int64)
    parts: dict[int, list[tuple[int, int]]] = {}
    for i, w in enumerate(words):
        half = len(w) // 2
        cuts = {0: [(0, len(w))], 1: [(0, half), (half, len(w) - half)]}.get(int(edits[i]), [])
        for at, size in cuts:
            if size:
                parts.setdefault(size, []).append((i, at))
    exact = {}
    for size, own in parts.items():
        item, at = np.array(own).T
        begin = offsets[item] + at
        exact[size] = _table(rolled(hashes, begin, begin + size), item, at)
    long = np.flatnonzero(edits > 1)
    sampled: list[Table | None] = [None] * SAMPLES
    if len(long):
        flat, starts = _separated(hashes, offsets)
        into = [np.arange(0, len(words[i]), EVERY) for i in long]
        item, at = np.repeat(long, [len(x) for x in into]), np.concatenate(into)
        for number in range(WALKS):
            walked = walk(flat, starts[offsets[item] + at], number)
            for i in range(number, SAMPLES, WALKS):
                inside = (walked[SPOTS[i]] != 0).all(0)
                if inside.any():
                    sampled[i] = _table(sample(walked, i)[inside], item[inside], at[inside])
    return Items(list(ids), words, edits, exact, sampled)


def _separated(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words with a zero behind each text, where walks stay, and the place of each word there (and of the end)."""
    text = np.searchsorted(offsets, np.arange(len(hashes) + 1), side="right") - 1
    place = np.arange(len(hashes) + 1) + text
    flat = np.zeros(len(hashes) + len(offsets) + 1, np.uint64)
    flat[place[:-1]] = hashes
    return flat, place


def walk(flat: np.ndarray, starts: np.ndarray, number: int) -> np.ndarray:
    """Row ``j`` holds what CGK walks from ``starts`` emit at step ``j``: the word times an odd number of the step, whose
    highest bit is the coin. Equal values are equal words; zeros are beyond a text's end."""
    at = starts.copy()
    out = np.empty((LENGTH, len(at)), np.uint64)
    for step in range(LENGTH):
        np.multiply(flat[at], _COINS[number, step], out=out[step])
        at += (out[step] >> _U(63)).view(np.int64)
    return out


def sample(walked: np.ndarray, i: int) -> np.ndarray:
    """The hash of the steps of sample ``i``: each step has a multiplier of its own, so the sum does."""
    first, *rest = SPOTS[i].tolist()
    key = walked[first].copy()
    for step in rest:
        key += walked[step]
    return key


def _padded(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Rows ``flat[start:start + length]``; a zero outside ``low:high``."""
    at = starts[:, None] + np.arange(int(lengths.max()))
    inside = (at >= low[:, None]) & (at < high[:, None]) & (at < (starts + lengths)[:, None])
    return np.where(inside, flat[np.clip(at, 0, len(flat) - 1)], np.uint64(0))


def candidates(block: Block, items: Items) -> np.ndarray:
    """Rows (text, item, span): a match of the item may begin near one of the ``edits + 1`` words of the span.

    Starts are put together to spans as they come, so windows of repeated words do not add up.
    """
    found: list[np.ndarray] = []
    held = 0

    def add(item: np.ndarray, start: np.ndarray, into: np.ndarray) -> None:
        nonlocal found, held
        text = texts[start]
        # Negative where a text begins within the item, of which an edit may lack the first words.
        span = (start - into - block.offsets[text]) // (items.edits[item] + 1)
        found.append(np.unique(np.stack([text, item, span]), axis=1))
        held += found[-1].shape[1]
        if held > PAIRS:
            found = [np.unique(np.concatenate(found, axis=1), axis=1)]
            held = 0

    texts = block.texts
    for size, table in items.exact.items():
        starts, keys = block.windows(size)
        for hit in table.look_up(keys, starts):
            add(*hit)
    if any(t is not None for t in items.sampled):
        flat, place = _separated(block.hashes, block.offsets)
        for first in range(0, len(block.hashes), TOGETHER):
            starts = np.arange(first, min(first + TOGETHER, len(block.hashes)))
            for number in range(WALKS):
                walked = walk(flat, place[starts], number)
                for i in range(number, SAMPLES, WALKS):
                    if items.sampled[i] is not None:
                        for hit in items.sampled[i].look_up(sample(walked, i), starts):
                            add(*hit)
    return np.unique(np.concatenate(found, axis=1), axis=1).T if found else np.zeros((0, 3), np.int64)


def edit_ends(item: np.ndarray, lengths: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, the least edits that turn the item into some stretch of its text row, and where that ends (first)."""
    rows, width = text.shape
    places = np.arange(width + 1)
    line = np.zeros((rows, width + 1), np.int32)
    done = line.copy()
    for i in range(item.shape[1]):
        changed = np.empty_like(line)
        changed[:, 0] = i + 1
        np.minimum(line[:, :-1] + (text != item[:, i : i + 1]), line[:, 1:] + 1, out=changed[:, 1:])
        line = (np.minimum.accumulate(changed - places, 1) + places).astype(np.int32)
        last = lengths == i + 1
        done[last] = line[last]
    end = done.argmin(1)
    return done[np.arange(rows), end], end


def shared_words(item: np.ndarray, lengths: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each row, how many of the item's words stand somewhere in its text row; a word may be taken for another, never the
    other way round, so it is too many at worst."""
    rows = np.arange(len(item))[:, None]
    bits = max(10, (8 * text.shape[1]).bit_length())
    seen = np.zeros((len(item), 1 << bits), bool)
    seen[rows, (text >> _U(64 - bits)).view(np.int64)] = True
    return (seen[rows, (item >> _U(64 - bits)).view(np.int64)] & (np.arange(item.shape[1]) < lengths[:, None])).sum(1)


def matches(block: Block, items: Items) -> list[tuple[np.ndarray, ...]]:
    """``text, item, start, end, edits`` of candidates that pass the exact check (words of the text; end exclusive)."""
    rows = candidates(block, items)
    out = []
    sizes = np.array([len(w) for w in items.words])
    flat = np.concatenate(items.words) if items.words else np.zeros(0, np.uint64)
    first = np.cumsum(sizes) - sizes
    # Sorted by size, so that rows worked on together are of like length.
    rows = rows[np.argsort(sizes[rows[:, 1]], kind="stable")]
    for a, b in runs(sizes[rows[:, 1]] * 2 + 1, 100_000):
        t, i, span = rows[a:b].T
        n, edits, low, high = sizes[i], items.edits[i], block.offsets[t], block.offsets[t + 1]
        own = _padded(flat, first[i], n, first[i], first[i] + n)
        # A match begins at most ``edits`` words from a start of the span, and is at most ``edits`` longer than the item.
        begin = np.maximum(low + span * (edits + 1) - edits, low)
        until = np.minimum(low + (span + 1) * (edits + 1) + edits + n + edits, high)
        stretch = _padded(block.hashes, begin, np.maximum(until - begin, 1), low, high)
        # A match leaves all words but ``edits`` in place, so most candidates need no edit distance.
        near = shared_words(own, n, stretch) >= n - edits
        if not near.any():
            continue
        t, i, n, edits, low, begin, own, stretch = (x[near] for x in (t, i, n, edits, low, begin, own, stretch))
        cost, end = edit_ends(own, n, stretch)
        good = cost <= edits
        if good.any():
            t, i, n, low, begin, cost, end = (x[good] for x in (t, i, n, low, begin, cost, end))
            # backwards from the end, for the start
            back = np.stack([np.concatenate([row[:k][::-1], np.zeros(len(row) - k, np.uint64)]) for row, k in zip(own[good], n, strict=True)])
            rest = np.stack([np.concatenate([row[:k][::-1], np.zeros(len(row) - k, np.uint64)]) for row, k in zip(stretch[good], end, strict=True)])
            _, length = edit_ends(back, n, rest)
            length = np.minimum(length, end)
            stop = begin + end - low
            out.append((t, i, stop - length, stop, cost))
    return out


def _search(items: Items, keep: tuple[str, ...] = ()):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for first, last in runs(np.diff(offsets)):
                low, high = offsets[first], offsets[last]
                block = Block(first, *plain_words(data[low:high], offsets[first : last + 1] - low))
                found = matches(block, items)
                if not found:
                    continue
                text, item, start, end, edits = map(np.concatenate, zip(*found, strict=True))
                order = np.lexsort((end, start, edits, item, text))  # the best of each text and item comes first
                text, item, start, end, edits = (x[order] for x in (text, item, start, end, edits))
                best = np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]))
                text, item, start, end, edits = (x[best] for x in (text, item, start, end, edits))
                size = np.array([len(items.words[i]) for i in item])
                row = pa.array(block.first + text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(row), pa.array([items.ids[k] for k in item.tolist()], pa.int64()),
                     pa.array(start.astype(np.int64)), pa.array(end.astype(np.int64)), pa.array(edits.astype(np.int64)),
                     pa.array(1 - edits / size), *(batch.column(k).take(row) for k in keep)],
                    ["doc_id", "item_id", "start_word", "end_word", "edits", "similarity", *keep],
                )

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, item_id, start_word, end_word, edits, similarity``: the best match of each document and item.

    Words are compared without ASCII marks and with A-Z folded; a match needs ``1 - edits / item words`` of ``similarity`` or
    more. Items that allow one edit at most are all found; of the others those that share a sample with a window (see the
    module), which exact copies always do. Null and empty texts match nothing, items without a word are not found. Items
    without an id, or with a repeated one, are items of their own. Equal rows each give their matches; of other columns,
    those named in ``keep`` come with the match; no shuffle of documents. Of equal matches the first in the text is told.

    Items go to the tasks with the code, in parts of bounded size: a large benchmark takes several passes.
    """
    items = benchmark.select(F.col("item_id").cast("bigint"), "text").filter("text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = size // PART_CHARS + 1
    docs = docs.select(F.col("doc_id").cast("bigint"), "text", *keep)
    schema = "doc_id bigint, item_id bigint, start_word bigint, end_word bigint, edits bigint, similarity double"
    schema += "".join(f", {docs.schema[k].name} {docs.schema[k].dataType.simpleString()}" for k in keep)
    found = None
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        prepared = prepare([r["item_id"] for r in rows], [r["text"] for r in rows], similarity)
        hits = docs.mapInArrow(_search(prepared, keep), schema)
        found = hits if found is None else found.unionByName(hits)
    return found

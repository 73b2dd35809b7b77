"""Repeated byte strings by column-wise construction of the suffix order of many pieces at once.

The collection is not whole texts (those would need as many rounds as the longest has bytes) but pieces that can share a
repeat. Every window of ``size`` bytes picks an anchor, the ``size // 2`` bytes within it of the least hash (the last of equal
ones), so equal windows have equal anchors at equal distances. Neighbouring windows with one anchor make a *piece*. Anchors
that occur once end there; where all pieces of an anchor are equal, all their windows repeat. The other anchors' pieces,
each distinct one once and with its number, are lined up at the anchor and built column by column from the right: a round
inserts one symbol of every piece. The symbols before the suffixes, in suffix order, are the round's Burrows-Wheeler column; a
stable sort by symbol within an anchor gives the next order, and common prefixes follow from the minima of the last round's
between two suffixes of one symbol. Neighbours with a common prefix of ``size`` hold the same window.

Rounds are bounded by ``size + size // 2``. The state between steps is in files that are written and read in sequence: the
pieces sorted by anchor (Spark's sorted shuffle) and the shared anchors (Parquet in the shared folder).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labmeta.llm.held import lean
from labmeta.llm.wordhash import mix, rolled, runs, utf8
from labmeta.sources.tables import shared_folder

#: Bytes worked on at once; longer texts are cut into overlapping parts.
BLOCK_BYTES = 1 << 20
#: Pieces in one construction, and occurrences beyond which an anchor's pieces are split by what their windows share.
TOGETHER, HOT = 4096, 2000
#: Window starts in a split part.
PART = 25
#: No symbol: before and after a piece. It is in no common prefix.
_NONE = 256
_LOW = np.uint64((1 << 21) - 1)
_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64))
_U = np.uint64


def _windowed_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` keys from each place on."""
    step = 1
    while 2 * step <= width:
        keys = np.minimum(keys[:-step], keys[step:])
        step *= 2
    return np.minimum(keys[: len(keys) - (width - step)], keys[width - step :]) if width > step else keys


def pieces_of(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Text, anchor place, first and last window start (places in ``data``), anchor hash, hash of the piece's bytes and place.

    ``data`` may hold ``2**21`` bytes at most. Texts shorter than a window have no pieces.
    """
    half = size // 2
    n = len(data)
    if n < size:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.view(_U), none.view(_U)
    values = _SYMBOLS[data]
    places = np.arange(n - half + 1)
    hashes = rolled(values, places, places + half)
    keys = (hashes & ~_LOW) | (_LOW - places.astype(_U))
    least = _windowed_minimum(keys, size - half + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    starts = np.flatnonzero(places[: len(least)] + size <= ends)
    picked = (_LOW - (least[starts] & _LOW)).astype(np.int64)
    heads = np.flatnonzero(np.append(True, picked[1:] != picked[:-1])) if len(starts) else starts
    tails = np.append(heads[1:], len(starts)) - 1
    at, first, last = picked[heads], starts[heads], starts[tails]
    shape = ((at - first) << 32 | (at - last)).astype(_U)
    whole = mix(rolled(values, first, last + size) ^ mix(shape))
    return np.searchsorted(offsets, first, side="right") - 1, at, first, last, hashes[at], whole


def _blocks(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int, int, int]]:
    """First and last text, and the bytes, of blocks; a long text comes in several that share ``size - 1`` bytes."""
    for first, last in runs(np.diff(offsets), BLOCK_BYTES):
        low, high = int(offsets[first]), int(offsets[last])
        if high - low <= BLOCK_BYTES:
            yield first, last, low, high
        else:
            for at in range(low, high - size + 1, BLOCK_BYTES):
                yield first, last, at, min(at + BLOCK_BYTES + size - 1, high)


def _anchors(size: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for first, last, low, high in _blocks(data, offsets, size):
                bounds = np.clip(offsets[first : last + 1], low, high) - low
                text, at, start, end, anchor, whole = pieces_of(data[low:high], bounds, size)
                if not len(text):
                    continue
                # Equal pieces of one text make one row with all their places.
                order = np.lexsort((at, whole, anchor, text))
                same = np.logical_and.reduce([x[order][1:] == x[order][:-1] for x in (text, anchor, whole)])
                heads = np.flatnonzero(np.append(True, ~same))
                one = order[heads]
                place = at[order] + (low - offsets[first + text[order]])
                row = pa.array(first + text[one])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[one].view(np.int64)), pa.array(whole[one].view(np.int64)), batch.column("d1").take(row),
                     batch.column("d2").take(row),
                     pa.ListArray.from_arrays(np.append(heads, len(order)).astype(np.int32), place.astype(np.int32)),
                     pa.array((at - start)[one].astype(np.int32)), pa.array((at - end)[one].astype(np.int32))],
                    ["anchor", "piece", "d1", "d2", "places", "back", "least"],
                )

    return run


def _fetch(size: int):
    """Texts with the pieces asked of them → parts of pieces: the whole piece, or for hot anchors one part for each range of
    ``PART`` window starts, keyed by the bytes that all windows of the range share (unequal ones have no window in common)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "part", "anchor", "piece", "n", "back", "least", "bytes")
        for batch in batches:
            for text, asked in zip(batch.column("text"), batch.column("asked").to_pylist(), strict=True):
                data = text.as_py().encode()
                out: list[tuple] = []
                held = 0
                for x in asked:
                    at = x["place"]
                    for key, part, back, least in _parts(data, at, x, size):
                        own = data[at - back : at - least + size]
                        out.append((key, part, x["anchor"], x["piece"], x["n"], back, least, own))
                        held += len(own) + 64
                    if held > BLOCK_BYTES:
                        yield _batch(names, out)
                        out, held = [], 0
                if out:
                    yield _batch(names, out)

    return run


def _hash(data: bytes, *shape: int) -> int:
    values = _SYMBOLS[np.frombuffer(data, np.uint8)]
    own = rolled(values, np.array([0]), np.array([len(values)]))
    for x in shape:
        own = mix(own ^ mix(np.array([x & 0xFFFFFFFFFFFFFFFF], _U)))
    return int(own.view(np.int64)[0])


def _parts(data: bytes, at: int, asked: dict, size: int) -> Iterator[tuple[int, int, int, int]]:
    if not asked["hot"]:
        yield asked["anchor"], asked["piece"], asked["back"], asked["least"]
        return
    for low in range(asked["least"] // PART * PART, asked["back"] + 1, PART):
        high = low + PART - 1
        back, least = min(high, asked["back"]), max(low, asked["least"])
        key = _hash(data[at - low : at - high + size], asked["anchor"], low)
        yield key, _hash(data[at - back : at - least + size], back, least), back, least


def _batch(names: tuple[str, ...], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    types = [pa.binary() if n == "bytes" else pa.int32() if n in ("back", "least") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], list(names))


def insert_column(symbols: np.ndarray, group: np.ndarray, order: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One round: put each piece's next symbol before its suffix.

    ``symbols`` of all pieces, the group of each place in the order (groups stay together), the pieces in suffix
    order, and the common prefix of each with the one before it. Returns the new order and common prefixes.
    """
    column = symbols[order]  # the Burrows-Wheeler column
    keys = group * (_NONE + 1) + column
    moved = np.argsort(keys, kind="stable")
    keys = keys[moved]
    new = np.zeros(len(order) + 1, common.dtype)
    joined = np.flatnonzero((keys[1:] == keys[:-1]) & (column[moved[1:]] != _NONE)) + 1
    if len(joined):
        low, high = moved[joined - 1] + 1, moved[joined] + 1
        least = common[high - 1]
        far = np.flatnonzero(high - low > 1)
        if len(far):
            ranges = np.empty(2 * len(far), np.int64)
            ranges[::2], ranges[1::2] = low[far], high[far]
            least[far] = np.minimum.reduceat(common, ranges)[::2]
        new[joined] = least + 1
    return order[moved], new


def repeated_starts(pieces: list[bytes], back: np.ndarray, least: np.ndarray, n: np.ndarray, group: np.ndarray, size: int) -> np.ndarray:
    """For each piece and each distance before the anchor, whether the window from there repeats. Groups are consecutive.

    ``pieces[i]`` holds the bytes from ``back[i]`` before the anchor to the end of the window ``least[i]`` before it, and
    stands for ``n[i]`` equal ones.
    """
    count, reach = len(pieces), int(back.max())
    width = reach - int(least.min()) + size
    symbols = np.full((width, count), _NONE, np.int64)
    first = reach - back
    for i, data in enumerate(pieces):
        symbols[first[i] : first[i] + len(data), i] = np.frombuffer(data, np.uint8)
    order, common = np.arange(count), np.zeros(count + 1, np.int32)
    found = np.zeros((count, reach + 1), bool)
    for c in range(width - 1, -1, -1):
        order, common = insert_column(symbols[c], group, order, common)
        if c <= reach - int(least.min()):
            equal = np.flatnonzero(common[:-1] >= size)
            found[order[equal], reach - c] = True
            found[order[equal - 1], reach - c] = True
    distance = np.arange(reach + 1)
    inside = (distance >= least[:, None]) & (distance <= back[:, None])
    return (found | (n > 1)[:, None]) & inside


def _construct(size: int):
    """Pieces sorted by key → runs of repeated window starts. Groups are put together up to ``TOGETHER`` pieces."""

    def judged(rows: pa.Table) -> pa.RecordBatch:
        keys = rows.column("key").to_numpy()
        group = np.cumsum(np.append(False, keys[1:] != keys[:-1]))
        back, least, n = (rows.column(k).to_numpy() for k in ("back", "least", "n"))
        found = repeated_starts(rows.column("bytes").to_pylist(), back, least, n, group, size)
        edges = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, low = np.nonzero(edges == 1)
        high = np.nonzero(edges == -1)[1] - 1
        take = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [rows.column("key").combine_chunks().take(take), rows.column("part").combine_chunks().take(take),
             pa.array(high.astype(np.int32)), pa.array(low.astype(np.int32))],
            ["key", "part", "from_back", "to_back"],
        )

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows >= TOGETHER:
                keys = held.column("key").to_numpy()
                last = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
                if last:
                    yield judged(held.slice(0, last))
                    held = held.slice(last).combine_chunks()
        if held is not None:
            yield judged(held)

    return run


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            removed, spans, kept = [], [], []
            for i, found in enumerate(batch.column("spans")):
                own = data[offsets[i] : offsets[i + 1]]
                rows = found.values
                if rows is None or not len(rows):
                    removed.append(0)
                    spans.append(0)
                    kept.append(own.tobytes())
                    continue
                places = rows.field("places")
                at = places.flatten().to_numpy()
                times = np.diff(places.offsets.to_numpy())
                first = at - np.repeat(rows.field("from_back").to_numpy(), times)
                end = at - np.repeat(rows.field("to_back").to_numpy(), times) + size
                cover = np.zeros(len(own) + 1, np.int32)
                np.add.at(cover, first, 1)
                np.add.at(cover, end, -1)
                gone = np.cumsum(cover)[:-1] > 0
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                kept.append(own[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def remove_repeated_bytes(docs: DataFrame, size: int = 400) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: each text's UTF-8 bytes without those of repeated strings.

    A string of ``size`` bytes (4 at least) of one document repeats if it starts anywhere else, in the same document or
    another, later or earlier; all its places go, so of two copies neither stays. ``n_spans`` counts maximal removed
    runs. ``kept`` is binary, since a cut may fall inside a character. Strings are judged on the input. A null text is
    empty; shorter texts stay whole. Equal rows are documents of their own. A null id is a document too. An empty table gives an
    empty result. Other columns of the input are ignored.
    """
    if size < 4:
        raise ValueError("a repeated string needs 4 bytes at least")
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    # Equal texts have equal results, so a text is told by 128 bits of its hash.
    texts = docs.select(F.col("doc_id").cast("bigint"), text.alias("text"), F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(size), text).alias("d2"))
    digest = ["d1", "d2"]
    rows = texts.filter(F.octet_length("text") >= size).mapInArrow(
        _anchors(size), "anchor bigint, piece bigint, d1 bigint, d2 bigint, places array<int>, back int, least int"
    )
    verdict = (
        rows.groupBy("anchor")
        .agg(F.sum(F.size("places")).alias("total"), F.min("piece").alias("_low"), F.max("piece").alias("_high"))
        .filter("total > 1")
        .select("anchor", (F.col("_low") != F.col("_high")).alias("mixed"), (F.col("total") > HOT).alias("hot"))
    )
    folder = shared_folder(spark)
    # Written first: joined as it is aggregated, the rows of a hot anchor could not be split among tasks.
    verdict.write.parquet(f"{folder}/verdict")
    rows.join(spark.read.parquet(f"{folder}/verdict"), "anchor").write.option("compression", "zstd").parquet(f"{folder}/anchors")
    shared = spark.read.parquet(f"{folder}/anchors")

    mixed = shared.filter("mixed")
    one = (
        mixed.groupBy("anchor", "piece")
        .agg(
            F.sum(F.size("places")).alias("n"), F.first("hot").alias("hot"),
            F.min(F.struct("d1", "d2", F.col("places")[0].alias("place"), "back", "least")).alias("at"),
        )
        .select("anchor", "piece", "n", "hot", "at.*")
    )
    asked = one.groupBy(*digest).agg(F.collect_list(F.struct("anchor", "piece", "n", "hot", "place", "back", "least")).alias("asked"))
    # Of equal texts one answers. Its rows come from the exchange of the last join.
    answering = texts.groupBy(*digest).agg(F.min("doc_id").alias("_answers"))
    parts = (
        texts.join(asked.join(answering, digest), digest)
        .filter(F.col("doc_id").eqNullSafe(F.col("_answers")))
        .select("text", "asked")
        .mapInArrow(_fetch(size), "key bigint, part bigint, anchor bigint, piece bigint, n bigint, back int, least int, bytes binary")
    )
    distinct = parts.groupBy("key", "part").agg(
        F.sum("n").alias("n"), F.first("back").alias("back"), F.first("least").alias("least"), F.first("bytes").alias("bytes")
    )
    judged = distinct.repartition("key").sortWithinPartitions("key").mapInArrow(
        _construct(size), "key bigint, part bigint, from_back int, to_back int"
    )
    repeats = parts.select("key", "part", "anchor", "piece").join(judged, ["key", "part"])
    spans = (
        mixed.join(repeats, ["anchor", "piece"])
        .select(*digest, "places", "from_back", "to_back")
        .unionByName(
            shared.filter("not mixed").select(*digest, "places", F.col("back").alias("from_back"), F.col("least").alias("to_back"))
        )
    )
    by_text = spans.distinct().groupBy(*digest).agg(F.collect_list(F.struct("places", "from_back", "to_back")).alias("spans"))
    return texts.join(by_text, digest, "left").mapInArrow(
        _cut(size), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )

"""Substring dedup by difference-cover anchors.

Places of a text are taken modulo 13, and only places whose remainder is in the difference cover {0, 1, 3, 9} carry
an anchor, the hash of 8 words. Any two places i and j have a step d < 13 for which i + d and j + d are both covered,
so two equal windows of 20 = 8 + 13 - 1 words share an anchor at the same distance from their starts. Anchors that
occur once therefore rule out most windows; from the others the match is extended to all windows of 20 words
that contain them, and those are compared by 96-bit hashes.

Only 31 % of the places are shuffled. A hash that a batch of texts holds many times is sent once, with its other
places packed beside it, so a passage that many texts share makes one row a batch and not one row a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labmeta.llm.wordhash import blocks, mix, rolled

PERIOD = 13
COVER = (0, 1, 3, 9)
#: A document is told by its id and the hash of its text, since ids may repeat or be missing; places hold its number in that order.
_PLACE = np.dtype([("num", "<i8"), ("pos", "<i4")])
_NO_ID = -(1 << 63)
#: Anchors only rule windows out, so 52 bits do; fewer bytes are shuffled.
_ANCHOR_SHIFT = np.uint64(12)


def _places(num: np.ndarray, pos: np.ndarray) -> np.ndarray:
    out = np.empty(len(num), _PLACE)
    out["num"], out["pos"] = num, pos
    return out


def _packed(keys: list[np.ndarray], places: np.ndarray) -> tuple[np.ndarray, list]:
    """The first place (by its fields) of each distinct key, and all its other places as bytes (None: none)."""
    order = np.lexsort((places["pos"], places["num"], *reversed(keys)))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    places = places[order]
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(order))
    more = [None] * len(heads)
    for i in np.flatnonzero(tails - heads > 1):
        more[i] = places[heads[i] + 1 : tails[i]].tobytes()
    return order[heads], more


def _row(keys: list[np.ndarray], places: np.ndarray) -> pa.RecordBatch:
    """Distinct keys as rows; ``low`` is the second key."""
    at, more = _packed(keys, places)
    names = dict(zip(("key", "low"), (k[at] for k in keys), strict=False))
    columns = {n: pa.array(k.view(f"i{k.itemsize}")) for n, k in names.items()}
    columns |= {k: pa.array(places[k][at]) for k in _PLACE.names} | {"more": pa.array(more, pa.binary())}
    return pa.RecordBatch.from_pydict(columns)


def _anchors(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        covered = np.zeros(PERIOD, bool)
        covered[list(COVER)] = True
        width = size - PERIOD + 1
        for batch in batches:
            num = batch.column("num").to_numpy(zero_copy_only=False)
            found = []
            for block in blocks(batch.column("text")):
                starts, hashes = block.windows(width)
                texts = block.texts[starts]
                pos = (starts - block.offsets[texts]).astype(np.int32)
                keep = covered[pos % PERIOD] & (block.counts[texts] >= size)
                row = block.first + texts[keep]
                found.append((hashes[keep] >> _ANCHOR_SHIFT, num[row], pos[keep]))
            if found:
                keys, *places = map(np.concatenate, zip(*found, strict=True))
                yield _row([keys], _places(*places))

    return run


def _shared(keys: tuple[str, ...], all_places: bool):
    """Rows sorted by key → places of keys that occur more than once. Only one row is held between batches; ``first`` is
    what else is known of its key: whether it was returned, or the first place of its key.

    ``all_places``: every place; else every place but the first and those equal to it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            rows = table.to_batches()[0]
            same = np.ones(rows.num_rows - 1, bool)
            for k in keys:
                v = rows.column(k).to_numpy()
                same &= v[1:] == v[:-1]
            place = _places(*(rows.column(k).to_numpy() for k in _PLACE.names))
            more = rows.column("more")
            many = np.array(more.is_valid())
            extra = many.copy()
            if held is not None:
                extra[0] = False
            if all_places:
                own = many
                own[1:] |= same
                own[:-1] |= same
                if held is not None and first:
                    own[0] = False
                first = bool(own[-1])
            else:
                new = np.append(True, ~same)
                group, heads = np.cumsum(new) - 1, np.flatnonzero(new)
                best = place[heads]
                if held is not None:
                    best[0] = first
                own = place != best[group]
                if held is not None:
                    own[0] = False
                first = best[-1]
            out = [place[own]]
            for i in np.flatnonzero(extra):
                places = np.frombuffer(more[int(i)].as_py(), _PLACE)
                if not all_places:
                    places = places[places != best[group[i]]]
                out.append(places)
            held = rows.slice(rows.num_rows - 1)
            places = np.concatenate(out)
            if len(places):
                yield pa.RecordBatch.from_pydict({k: pa.array(places[k].copy()) for k in _PLACE.names})

    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column and the row of each."""
    counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), counts)


def _extended(size: int):
    """Texts with the places of their shared anchors → hashes of all windows that contain one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            num = batch.column("num").to_numpy(zero_copy_only=False)
            anchors, rows = _flat(batch.column("places"))
            found = []
            for block in blocks(batch.column("text")):
                own = slice(*np.searchsorted(rows, [block.first, block.first + len(block.counts)]))
                text = rows[own] - block.first
                at = anchors[own] + block.offsets[text]
                near = np.zeros(len(block.hashes) + 1, np.int32)
                low = np.maximum(at - PERIOD + 1, block.offsets[text])
                np.add.at(near, low, 1)
                np.add.at(near, at + 1, -1)
                starts, hashes = block.windows(size)
                keep = np.cumsum(near)[starts] > 0
                starts, hashes = starts[keep], hashes[keep]
                if len(starts):
                    # a second, independent hash: the words from the middle of the window on
                    half, other = block.windows(size // 2)
                    second = other[np.searchsorted(half, starts + size // 2)]
                    second = (second >> np.uint64(32)).astype(np.uint32)
                    texts = block.texts[starts]
                    row = block.first + texts
                    found.append((hashes, second, num[row], (starts - block.offsets[texts]).astype(np.int32)))
            if found:
                keys, low, *places = map(np.concatenate, zip(*found, strict=True))
                yield _row([keys, low], _places(*places))

    return run


def _cut(size: int):
    """Texts with the starts of repeated windows → texts without the words those windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, rows = _flat(batch.column("places"))
            words, removed, kept = [], [], []
            copy = batch.column("copy").to_pylist()
            at = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            for i, text in enumerate(batch.column("text")):
                every = (text.as_py() or "").encode().split()
                drop = starts[at[i] : at[i + 1]]
                if copy[i]:
                    left = []
                elif len(drop):
                    cover = np.zeros(len(every) + size + 1, np.int32)
                    np.add.at(cover, drop, 1)
                    np.add.at(cover, drop + size, -1)
                    keep = np.cumsum(cover)[: len(every)] == 0
                    left = [every[j] for j in np.flatnonzero(keep)]
                else:
                    left = every
                words.append(len(every))
                removed.append(len(every) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc", "n_words", "n_removed", "kept_text"],
            )

    return run


def _sequences(size: int):
    """The hashes of whole word sequences, for texts of ``size`` words or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                long = np.flatnonzero(block.counts >= size)
                ends = block.offsets[long], block.offsets[long + 1]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(pa.array(block.first + long)) for k in ("doc", "tag")),
                     pa.array(rolled(block.hashes, *ends).view(np.int64)), pa.array(rolled(mix(block.hashes), *ends).view(np.int64))],
                    ["doc", "tag", "d1", "d2"],
                )

    return run


def _copies(texts: DataFrame, size: int) -> DataFrame:
    """Documents whose whole word sequence is that of an earlier one (by id, then text hash): all their words go, and what
    they hold starts earlier in that one, so the other steps can do without them."""
    known = texts.mapInArrow(_sequences(size), "doc bigint, tag bigint, d1 bigint, d2 bigint")
    first = known.groupBy("d1", "d2").agg(F.min(F.struct("doc", "tag")).alias("first"))
    return known.join(first, ["d1", "d2"]).filter(F.struct("doc", "tag") > F.col("first")).select("doc", "tag").distinct()


def _numbered(texts: DataFrame) -> DataFrame:
    """``doc, tag, num``: the documents in order, numbered from 0.

    Ranges of the order are sorted alone and written once, since ranges are drawn from a sample; each starts after the rows of
    those before it. Only the sizes of ranges are summed in one task, and broadcast.
    """
    document = ["doc", "tag"]
    ranges = texts.select(*document).distinct().repartitionByRange(*document).sortWithinPartitions(*document).select(
        *document, F.monotonically_increasing_id().alias("_id")
    ).checkpoint()
    part = F.shiftright("_id", 33)
    sizes = ranges.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    num = F.col("_start") + F.col("_id").bitwiseAND((1 << 33) - 1)
    return ranges.withColumn("_part", part).join(F.broadcast(starts), "_part").select(*document, num.alias("num"))


def _by_text(places: DataFrame, names: DataFrame) -> DataFrame:
    return places.groupBy("num").agg(F.collect_list("pos").alias("places")).join(names, "num").drop("num")


def remove_repeats(docs: DataFrame, size: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``: each text without the words of windows that occur earlier.

    A window is ``size`` (at least 14) consecutive words of one document. It occurs earlier if the same words start in
    an earlier document or before it in the same one. Documents are ordered by id, then by a hash of the text: rows that
    share an id, or have none, but not their text are documents of their own; equal rows are one, which both stay or both go.
    Windows are judged on the input. A null text has no words; texts shorter than a window stay whole; a null id counts as the
    smallest. Other columns of the input are ignored.
    """
    if size < PERIOD + 1:
        raise ValueError(f"a window needs {PERIOD + 1} words at least")
    tag = F.xxhash64(F.coalesce("text", F.lit("")))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("doc"), tag.alias("tag"), F.col("text"))
    document = ["doc", "tag"]
    copies = _copies(texts, size)
    # Texts meet everything by id and text hash, so they are shuffled once; numbers are what anchors and windows carry.
    names = _numbered(texts)
    own = texts.join(copies, document, "left_anti").join(names, document)
    place = "num bigint, pos int"
    anchors = own.mapInArrow(_anchors(size), f"key bigint, {place}, more binary")
    shared = anchors.repartition("key").sortWithinPartitions("key").mapInArrow(_shared(("key",), True), place)
    windows = own.join(_by_text(shared, names), document, "left").mapInArrow(_extended(size), f"key bigint, low int, {place}, more binary")
    order = ("key", "low", "num", "pos")
    repeated = windows.repartition("key").sortWithinPartitions(*order).mapInArrow(_shared(order[:2], False), place)
    marked = texts.join(copies.withColumn("copy", F.lit(True)), document, "left")
    out = marked.join(_by_text(repeated, names), document, "left").mapInArrow(
        _cut(size), "doc bigint, n_words bigint, n_removed bigint, kept_text string"
    )
    return out.select(F.expr(f"nullif(doc, {_NO_ID}L)").alias("doc_id"), "n_words", "n_removed", "kept_text")

"""Best-fit packing by bin completion over a length histogram.

Which documents share a sequence depends on their lengths only, and there are at most ``capacity`` lengths. So the
counts per length (at most ``capacity`` rows, whatever the input) decide a packing plan. Best-fit decreasing over the
counts gives the first plan. If it uses more sequences than the total needs, bin completion looks for a better one: it
branches over the undominated fillings of the largest length left, adds up their waste, turns back where that leaves no
room for a better plan, and ends at a plan that fits the total or with its budget of steps. Documents then find their
place from their rank among the pieces of their length, in parallel.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from itertools import accumulate, chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labmeta.llm.held import keep

CAPACITY = 4096
END = 1
#: Words kept with their ids in one Python worker.
KNOWN_WORDS = 500_000
#: Parts of words (runs of letters or marks, digits) kept likewise.
KNOWN_UNITS = 50_000
#: Branch-and-bound nodes within one sequence, and steps between sequences beyond the first descent, after which the
#: best that is known is taken.
NODES, STEPS = 2_000, 2_000
#: A plan: ``[(length, how many), …]`` of one sequence, and the number of such sequences.
Plan = list[tuple[list[tuple[int, int]], int]]


class WordIds:
    """Token ids of words. Texts are split at ASCII white space, at which this kind of tokenizer always splits."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[bytes, int] = {}
        self.units: dict[str, list[int]] = {}
        self.flat, self.starts, self.n = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), 0

    @staticmethod
    def words(text: str) -> list[bytes]:
        """Words, with A-Z folded and a final stop or comma apart, both of which leave the ids as they are."""
        raw = text.encode()
        if b"<|" not in raw:
            raw = raw.lower()
        if _ODD.search(raw):
            return _FINAL.sub(rb" \1", raw).split()
        raw += b" "
        for mark in (b".", b","):
            for space in (b" ", b"\n"):
                raw = raw.replace(mark + space, b" " + mark + space)
        return raw.split()

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words. Words of Latin letters, digits and marks are cut into the tokenizer's own units, which go
        straight to its merge model; all others go through the whole tokenizer."""
        out: list[list[int]] = []
        odd = []
        for word in words:
            text = word.decode()
            if _PLAIN.fullmatch(text) and b"<|" not in word:
                ids = []
                for unit in _UNITS.findall(text.lower()):
                    own = self.units.get(unit)
                    if own is None:
                        own = [t.id for t in self.model.tokenize(unit.encode().decode("latin-1").translate(_BYTE_CHARS))]
                        if len(self.units) < KNOWN_UNITS:
                            self.units[unit] = own
                    ids += own
                out.append(ids)
            else:
                odd.append((len(out), text))
                out.append([])
        for (at, _), e in zip(odd, self.tokenizer.encode_batch_fast([t for _, t in odd], add_special_tokens=False), strict=True):
            out[at] = e.ids
        counts = np.fromiter(map(len, out), np.int64, len(out))
        return np.array([i for ids in out for i in ids], np.uint32), counts

    def _learn(self, words: list[bytes]) -> None:
        ids, counts = self._encode(words)
        first = self.starts[self.n]
        while self.n + len(words) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        while first + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[first : first + len(ids)] = ids
        self.starts[self.n + 1 : self.n + 1 + len(words)] = first + np.cumsum(counts)
        self.known.update(zip(words, range(self.n, self.n + len(words)), strict=True))
        self.n += len(words)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, flat, and the number of ids of each."""
        words = [self.words(t) for t in texts]
        every = [w for x in words for w in x]
        codes = np.fromiter(map(self.known.get, every, repeat(-1)), np.int64, len(every))
        lacking = np.flatnonzero(codes < 0).tolist()
        fresh = list({every[i] for i in lacking})
        if fresh and self.n < KNOWN_WORDS:
            room = KNOWN_WORDS - self.n
            self._learn(fresh[:room])
            fresh = fresh[room:]
            codes[lacking] = [self.known.get(every[i], -1) for i in lacking]
        flat, starts = self.flat, self.starts[: self.n + 1]
        lengths = np.zeros(len(every), np.int64)
        seen = codes >= 0
        begin = np.zeros(len(every), np.int64)
        begin[seen] = starts[codes[seen]]
        lengths[seen] = starts[codes[seen] + 1] - begin[seen]
        if fresh:
            ids, counts = self._encode(fresh)
            ends = np.cumsum(counts) + starts[-1]
            at = {w: i for i, w in enumerate(fresh)}
            other = np.fromiter((at[every[i]] for i in np.flatnonzero(~seen)), np.int64)
            flat = np.concatenate([flat[: starts[-1]], ids])
            begin[~seen], lengths[~seen] = (ends - counts)[other], counts[other]
        total = np.concatenate([[0], np.cumsum(lengths)])
        out = flat[np.repeat(begin - total[:-1], lengths) + np.arange(total[-1])]
        last = np.cumsum([0, *map(len, words)])
        return out, total[last[1:]] - total[last[:-1]]


_FINAL = re.compile(rb"(?<=[a-z])([.,])(?=[\x20\x09-\x0D]|$)")
_ODD = re.compile(rb"[^a-z\s][.,](?:\s|$)")
#: Latin letters without the signs among them, ASCII digits and marks but the apostrophe.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:-@\[-`{-~]+")
_UNITS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
#: The printable stand-ins for bytes in byte-level vocabularies: bytes without a glyph count up from 256.
_BYTE_CHARS = {b: 256 + i for i, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}


def _pieces(path: str, capacity: int, texts_at_once: int = 500):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = keep(("word ids", path), lambda: WordIds(path))
        for batch in batches:
            for at in range(0, batch.num_rows, texts_at_once):
                part = batch.slice(at, texts_at_once)
                ids, counts = coder.ids([t or "" for t in part.column("text").to_pylist()])
                out = {"row": [], "piece": [], "start": [], "length": [], "ids": []}
                first = 0
                for row, n in enumerate(counts):
                    own = np.append(ids[first : first + n], np.uint32(END)).astype("<u4")
                    first += n
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        data = own[start : start + capacity]
                        for k, v in zip(out, (row, piece, start, len(data), data.tobytes()), strict=True):
                            out[k].append(v)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(out["row"], pa.int64())), pa.array(out["piece"], pa.int32()),
                     pa.array(out["start"], pa.int64()), pa.array(out["length"], pa.int64()), pa.array(out["ids"], pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    return run


def tokenize(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids``: the ids of each whole text and an end mark, cut only beyond ``capacity``.

    ``ids`` holds little-endian unsigned 32-bit integers. A null or empty text is the end mark alone. ``tokenizer`` is the
    path of a tokenizer file that executors can read. Other columns of the input are ignored.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids binary"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_pieces(tokenizer, capacity), schema)


def _complete(lengths: list[int], counts: list[int], room: int) -> list[tuple[int, int]]:
    """The best filling of ``room`` from what is left (lengths descending), as (length, how many): least waste, then
    the larger lengths.

    Depth-first search that takes as many of the largest fitting length as it can, so the first leaf is the
    best-fit-decreasing filling and the first incumbent. A branch is cut if all that it can still hold leaves as much
    waste as the incumbent. A filling with room for a length that is left is dominated by the one that holds it; such
    fillings only count as prefixes of others.
    """
    best: list[tuple[int, tuple[tuple[int, int], ...]]] = [(room, ())]
    descending = [-x for x in lengths]
    held = list(accumulate((x * n for x, n in zip(reversed(lengths), reversed(counts), strict=True))))[::-1]
    nodes = NODES

    def search(at: int, room: int, taken: tuple[tuple[int, int], ...]) -> bool:
        """True: nothing better is left to find, or the node budget is used up."""
        nonlocal nodes
        nodes -= 1
        if room < best[0][0]:
            best[0] = (room, taken)
        if room == 0 or nodes <= 0:
            return True
        for i in range(max(at, bisect_left(descending, -room)), len(lengths)):
            if room - held[i] >= best[0][0]:
                return False
            for n in range(min(counts[i], room // lengths[i]), 0, -1):
                if search(i + 1, room - n * lengths[i], (*taken, (lengths[i], n))):
                    return True
        return False

    search(0, room, ())
    return list(best[0][1])


def best_fit(histogram: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing. Equal sequences are taken together, so the work does not depend on the counts.

    The fullest sequence that holds a length stays the fullest until it holds no more of it, so it takes all it can.
    """
    rooms: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    order: list[int] = []  # the keys of ``rooms``, ascending
    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        n = histogram[length]
        placed = []
        at = bisect_left(order, length)
        while n:
            new = at == len(order)
            room = capacity if new else order[at]
            each = room // length
            filling, times = ((), -(-n // each)) if new else rooms[room].pop()
            whole = min(times, n // each)
            rest = n - whole * each if whole < times else 0
            for some, number in ((each, whole), (rest, int(rest > 0)), (0, times - whole - (rest > 0))):
                if number:
                    placed.append((room - some * length, (*filling, (length, some)) if some else filling, number))
            n -= whole * each + rest
            if not new and not rooms[room]:
                del rooms[room], order[at]
        for room, filling, number in placed:
            if room not in rooms:
                rooms[room] = []
                insort(order, room)
            rooms[room].append((filling, number))
    return [(list(filling), number) for room in order for filling, number in rooms[room]]


def _fillings(lengths: list[int], counts: list[int], room: int, spare: int) -> Iterator[list[tuple[int, int]]]:
    """Fillings of ``room`` that waste ``spare`` at most, the one of least waste first. Left out are fillings with room for
    a length that is left, in place of one of theirs or beside them: they are dominated by those that hold it."""
    first = _complete(lengths, counts, room)
    if room - sum(k * n for k, n in first) <= spare:
        yield first
    descending = [-x for x in lengths]
    nodes = NODES

    def dominated(waste: int, taken: dict[int, int]) -> bool:
        for x in (0, *taken):
            for i in range(bisect_left(descending, -(x + waste)), bisect_left(descending, -x)):
                if counts[i] > taken.get(lengths[i], 0):
                    return True
        return False

    def search(at: int, room: int, taken: tuple[tuple[int, int], ...]) -> Iterator[list[tuple[int, int]]]:
        nonlocal nodes
        nodes -= 1
        if room <= spare and not dominated(room, dict(taken)):
            yield list(taken)
        for i in range(max(at, bisect_left(descending, -room)), len(lengths)):
            for n in range(min(counts[i], room // lengths[i]), 0, -1):
                if nodes <= 0:
                    return
                yield from search(i + 1, room - n * lengths[i], (*taken, (lengths[i], n)))

    for found in search(0, room, ()):
        if found != first:
            yield found


def _later(fillings: Callable[[], Iterator[list[tuple[int, int]]]]) -> Iterator[list[tuple[int, int]]]:
    """All but the first, none of which is looked for before the first of them is asked for."""
    yield from islice(fillings(), 1, None)


def _completed(histogram: dict[int, int], capacity: int, bins: int) -> Plan | None:
    """The best plan of fewer than ``bins`` sequences that bin completion finds. Equal sequences are first taken as often as
    the counts allow, then less often."""
    lengths = sorted((k for k, n in histogram.items() if n), reverse=True)
    left = {k: histogram[k] for k in lengths}
    total = sum(k * n for k, n in left.items())
    least = -(-total // capacity)
    waste, used, chosen, best = 0, 0, [], None

    def choices() -> Iterator[tuple[dict[int, int], int, int]]:
        largest = next(k for k in lengths if left[k])
        spare = lambda: (bins - 1) * capacity - total - waste
        if spare() < 0:
            return
        limit = spare()

        def fillings() -> Iterator[list[tuple[int, int]]]:
            some = [k for k in lengths if left[k] - (k == largest)]
            return _fillings(some, [left[k] - (k == largest) for k in some], capacity - largest, limit)

        seen = []
        # There may be thousands of sequences below this one before its second filling is asked for, if ever. By then what is
        # left is as it was, so the lists of lengths are made again and not held.
        for filling in chain(list(islice(fillings(), 1)), _later(fillings)):
            need = {largest: 1}
            for k, n in filling:
                need[k] = need.get(k, 0) + n
            each = capacity - sum(k * n for k, n in need.items())
            times = min(left[k] // n for k, n in need.items())
            if spare() < 0:  # a plan found below leaves no room for a better one here
                return
            if each * times > spare():
                times = spare() // each
            if times:
                seen.append((need, times, each))
                yield need, times, each
        for need, most, each in seen:
            for times in range(most - 1, 0, -1):
                if each * times <= spare():
                    yield need, times, each

    def turn_back() -> None:
        nonlocal waste, used
        need, times, each = chosen.pop()
        for k, n in need.items():
            left[k] += n * times
        waste, used = waste - each * times, used - times

    steps = 2 * len(lengths) + STEPS
    open_ = [choices()]
    while open_ and steps and bins > least:
        step = next(open_[-1], None)
        steps -= 1
        if step is None:
            open_.pop()
            if chosen:
                turn_back()
            continue
        need, times, each = step
        for k, n in need.items():
            left[k] -= n * times
        waste, used = waste + each * times, used + times
        chosen.append(step)
        if any(left.values()):
            open_.append(choices())
        else:
            if used < bins:
                bins, best = used, [(list(need.items()), times) for need, times, _ in chosen]
            turn_back()
    return best


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """``([(length, how many), …] of one sequence, number of such sequences)``: uses up the histogram (length → count).

    It never uses more sequences than best-fit decreasing. Its work and size depend on the number of different lengths,
    not on the counts.
    """
    some = [k for k, n in histogram.items() if n]
    if some and not 0 < min(some) <= max(some) <= capacity:
        raise ValueError("a length is outside the capacity")
    first = best_fit(histogram, capacity)
    bins = sum(times for _, times in first)
    if bins * capacity - sum(k * n for k, n in histogram.items()) < capacity:
        return first
    return _completed(histogram, capacity, bins) or first


def _places(chosen: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """For each length, ranges of ranks and where they go; sorted by length, then rank."""
    rows, used, sequence = [], {}, 0
    for filling, times in chosen:
        offset = 0
        for length, n in filling:  # equal lengths stand together
            rows.append((length, used.get(length, 0), n, sequence, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        sequence += times
    rows.sort()
    return dict(zip(("length", "rank", "each", "sequence", "offset"), np.array(rows, np.int64).reshape(-1, 5).T, strict=True))


def _put(places: dict[str, np.ndarray], before: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.append(np.flatnonzero(np.diff(places["length"], prepend=-1)), len(places["length"]))
        by_length = {int(places["length"][a]): slice(a, b) for a, b in zip(first[:-1], first[1:], strict=True)}
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column(before).to_numpy() + batch.column("rank").to_numpy()
            at = np.zeros(len(length), np.int64)
            for value in np.unique(length):
                own, here = by_length[int(value)], length == value
                at[here] = own.start + np.searchsorted(places["rank"][own], rank[here], side="right") - 1
            nth = rank - places["rank"][at]
            sequence = places["sequence"][at] + nth // places["each"][at]
            offset = places["offset"][at] + nth % places["each"][at] * length
            keep = [n for n in batch.schema.names if n not in ("part", "rank", before)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in keep), pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"]
            )

    return run


def _ranked():
    """Adds the task's number and, per length, the rank of a piece within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            length = batch.column("length").to_pylist()
            rank = []
            for x in length:
                rank.append(n := seen.get(x, 0))
                seen[x] = n + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(rank), pa.int32()), pa.array(rank, pa.int64())],
                [*batch.schema.names, "part", "rank"],
            )

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    The rows are checkpointed once with their rank per task and length, so that a lost executor cannot change a rank
    after the plan is made; large columns should be derived or left out before. Only counts per length reach the
    driver, and the plan's ranges (one for each length of each filling) go to the tasks.
    """
    clash = {"part", "rank", "before", "sequence_id", "offset"} & set(pieces.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are in use")
    schema = T.StructType([*pieces.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("rank", T.LongType())])
    ranked = pieces.mapInArrow(_ranked(), schema).checkpoint()
    counts = ranked.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    out = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    placed = ranked.join(before, ["length", "part"]).select(*ranked.columns, "before")
    return placed.mapInArrow(_put(_places(plan(histogram, capacity)), "before"), out)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, *columns: Column) -> DataFrame:
    """One row a piece: ``doc_id, piece, start, length``, the given columns over ``ids``, ``sequence_id, offset``.

    Whole documents stay together unless they are longer than ``capacity``; only those are cut, and only their last piece
    may be shorter. Without ``columns``, the ids themselves are returned. Null texts are empty ones; repeated rows are
    packed each; an empty table gives no rows.
    """
    pieces = tokenize(docs, tokenizer, capacity)
    return pack(pieces.select("doc_id", "piece", "start", "length", *(columns or [F.col("ids")])), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, n_tokens, doc_ids``: the packed sequences, from the rows of ``pack_documents`` with ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (
        packed.groupBy("sequence_id").agg(ordered.alias("_p"), F.sum("length").alias("n_tokens"))
        .select("sequence_id", F.aggregate("_p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"), "n_tokens",
                F.col("_p.doc_id").alias("doc_ids"))
    )

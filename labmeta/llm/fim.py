"""Fill-in-middle transformation with memoized content-defined chunks.

A rolling hash of 16 bytes cuts texts into chunks, so that equal passages in different texts give equal chunks. What a cut
needs to know of a chunk is a small summary: its line ends, its characters up to each, whether a mark lies inside, and the
bytes at its edges. A task keeps summaries by the chunk's content (a lookup compares the bytes, so no hash is trusted), and
a shared chunk is summarised once. Summaries add up: running sums of lines find the chunk that holds a cut, and
the summary finds the place within it; marks across a boundary are found from the edges. Texts are not scanned for lines.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeta.llm.held import lean
from labmeta.llm.wordhash import BLOCK_BYTES, mix, runs, utf8

#: Fixed marks of the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = (b"<P>", b"<S>", b"<M>")
#: Bytes of a chunk, at least (but for a text's last) and at most; a place ends one with a chance of 1 in ``_MASK + 1``.
LEAST, MOST, _MASK = 64, 8192, 511
#: Bytes of chunks whose summaries a task keeps.
KEPT_BYTES = 64 << 20
_WINDOW = 16
_GEAR = mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)


@dataclass(slots=True)
class Summary:
    """Of a chunk: its bytes' number and characters, the ends of its lines (bytes, and characters up to there), a mark within."""

    size: int
    chars: int
    ends: list[int]
    chars_at: list[int]
    marked: bool
    head: bytes
    tail: bytes


def summarise(chunk: bytes) -> Summary:
    data = np.frombuffer(chunk, np.uint8)
    chars = np.cumsum((data & 0xC0) != 0x80)
    ends = np.flatnonzero(data == 10)
    return Summary(
        len(chunk), int(chars[-1]), (ends + 1).tolist(), chars[ends].tolist(), any(m in chunk for m in _MARKS),
        chunk[:2], chunk[-2:],
    )


def candidates(data: np.ndarray) -> np.ndarray:
    """Places (exclusive ends) where the rolling hash of the ``_WINDOW`` bytes before is one of a chunk's end."""
    found = []
    for first in range(0, len(data), BLOCK_BYTES):
        low = max(0, first - _WINDOW + 1)
        h = _GEAR[data[low : first + BLOCK_BYTES]]
        step, base = 1, 0x9E3779B1
        while step < _WINDOW:  # the hash of 2, 4, 8, then 16 bytes
            h[step:] += h[:-step] * np.uint32(base)
            step, base = 2 * step, base * base & 0xFFFFFFFF
        ends = np.flatnonzero((h >> np.uint32(12)) & np.uint32(_MASK) == 0) + low + 1
        found.append(ends[ends > first])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def cuts(ends: list[int], start: int, end: int) -> Iterator[tuple[int, int]]:
    """The chunks of the text at ``start:end``, given the ``candidates`` around it."""
    while start < end:
        at = bisect_left(ends, start + LEAST)
        stop = min(ends[at] if at < len(ends) else end, start + MOST, end)
        yield start, stop
        start = stop


class Chunks:
    """Summaries of chunks by content; all are forgotten when they cover more than ``KEPT_BYTES``."""

    def __init__(self):
        self.known: dict[bytes, Summary] = {}
        self.held = 0

    def summary(self, chunk: bytes) -> Summary:
        own = self.known.get(chunk)
        if own is None:
            if self.held + len(chunk) > KEPT_BYTES:
                self.known.clear()
                self.held = 0
            own = self.known[chunk] = summarise(chunk)
            self.held += len(chunk)
        return own


@dataclass(slots=True)
class Text:
    """A text as the sum of its chunks' summaries."""

    parts: list[Summary]
    lines: list[int]
    size: int
    chars: int

    @classmethod
    def of(cls, parts: list[Summary]) -> Text:
        lines = list(accumulate((len(p.ends) for p in parts), initial=0))
        return cls(parts, lines, sum(p.size for p in parts), sum(p.chars for p in parts))

    @property
    def units(self) -> int:
        return self.lines[-1] + bool(self.parts and not self.parts[-1].tail.endswith(b"\n"))

    @property
    def marked(self) -> bool:
        return any(p.marked for p in self.parts) or any(
            m in a.tail + b.head for a, b in zip(self.parts, self.parts[1:]) for m in _MARKS
        )

    def end_of(self, unit: int) -> tuple[int, int]:
        """Bytes and characters up to the end of the first ``unit`` units."""
        if unit == 0:
            return 0, 0
        if unit > self.lines[-1]:
            return self.size, self.chars
        at = bisect_left(self.lines, unit) - 1
        part, line = self.parts[at], unit - self.lines[at] - 1
        before = self.parts[:at]
        return sum(p.size for p in before) + part.ends[line], sum(p.chars for p in before) + part.chars_at[line]


def transformed(data: bytes, text: Text, h: tuple[int, int, int, int], rate: int, spm: int):
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    n = text.units
    if not n or text.marked or h[2] % 100 >= rate:
        return n, "plain", None, None, data
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    (a, a_chars), (b, b_chars) = text.end_of(low), text.end_of(high)
    prefix, middle, suffix = b"<P>" + data[:a], b"<M>" + data[a:b], b"<S>" + data[b:]
    if h[3] % 100 < spm:
        return n, "spm", a_chars, b_chars - a_chars, suffix + prefix + middle
    return n, "psm", a_chars, b_chars - a_chars, prefix + suffix + middle


def _transform(rate: int, spm: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks()
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            draws = batch.column("draws").flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
            for first, last in runs(np.diff(offsets)):
                base = offsets[first]
                block = data[base : offsets[last]]
                ends, raw = candidates(block).tolist(), block.tobytes()
                rows = []
                for i in range(first, last):
                    a, b = int(offsets[i] - base), int(offsets[i + 1] - base)
                    text = Text.of([chunks.summary(raw[x:y]) for x, y in cuts(ends, a, b)])
                    rows.append(transformed(raw[a:b], text, tuple(draws[i].tolist()), rate, spm))
                n, form, prefix, middle, out = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: each whole text, cut at two line ends and reordered.

    ``n`` lines ``[^\\n]*\\n|[^\\n]+`` are the units. Four numbers drawn from ``seed`` and the id decide the cuts, the share
    ``rate`` (of 100) that is reordered at all, and the share ``spm`` whose suffix comes first. ``form`` is ``plain`` (the
    text as it is; the counts are null), ``psm`` or ``spm``. A null text is an empty one; empty texts, and texts that hold
    a mark, are plain. A null id draws as an id without digits; rows that share an id draw alike. A text without a line end
    is one unit. Repeated rows give repeated rows, an empty table none. Other columns of the input are ignored.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)])
    return docs.select(F.col("doc_id").cast("bigint"), draws.alias("draws"), F.col("text")).mapInArrow(
        _transform(rate, spm), "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. Texts with marks stay plain, so the marks of the others are their joints."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )

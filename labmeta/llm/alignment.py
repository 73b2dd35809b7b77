"""Alignment of two tokenizers' tokens, and how often their tokens meet in the corpus.

A tokenizer of the ``tokenizers`` library gives character offsets, a ``sentencepiece`` model gives the spans of its immutable
proto. Both are coarse cuts: tokens inside one multibyte character share its span, and byte-fallback tokens have empty ones.
Those are refined with the bytes that the tokens decode to. Offsets where tokens of both end cut a text into groups.

Both models start anew at a single space between two other characters, so texts are split there, equal words are aligned
once and kept. A *block* holds the texts of about ``BLOCK_BYTES``. It sends each of its distinct links once, with the number
of documents that hold it; texts carry ranks into that list. Corpus-wide counts come back block by block.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labmeta.llm.held import keep
from labmeta.llm.wordhash import runs, utf8
from labmeta.sources.tables import shared_folder

#: Bytes of text in a block (or one longer text), and words kept by a worker between blocks.
BLOCK_BYTES, KNOWN_WORDS = 8 << 20, 300_000
_SPLIT = re.compile(r"(?<=\S) (?=\S)")
#: Bits of a link; those above tell texts of a part of a block apart.
_LINK_BITS = 40
_FALLBACK = re.compile(r"<0x([0-9A-F]{2})>")
_ROW = "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, links binary, times binary"


def _byte_chars() -> dict[str, int]:
    """The printable stand-ins for bytes in byte-level vocabularies: bytes without a glyph count up from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Two tokenizers: ``a`` a byte-level file of ``tokenizers``, ``b`` a ``sentencepiece`` model that adds a space."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b)
        chars = _byte_chars()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        self.n_b = self.b.vocab_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{b} has pieces that go beyond a word, so words cannot be aligned one by one")
        fallback = [_FALLBACK.fullmatch(p) for p in pieces]
        self.b_bytes = [
            bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode() for m, p in zip(fallback, pieces, strict=True)
        ]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        if len(self.a_bytes) * self.n_b >= 1 << _LINK_BITS:
            raise ValueError("links of these two vocabularies need too many bits")

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and byte ends of both over a space and ``text``; None if their bytes are not those."""
        data = (" " + text).encode()
        left = self.a.encode(" " + text, add_special_tokens=False)
        right = self.b.encode(text, return_type="proto").pieces
        a, b = left.ids, [p.id for p in right]
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        leads = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        ends = np.append(leads, len(data))[np.fromiter([end for _, end in left.offsets], np.int64, len(a))]
        # Tokens within a character share its span; of those only the last ends where the span ends.
        a_ends = _refined(ends, np.append(ends[1:] == ends[:-1], False), self.a_sizes[a])
        # Spans lack the added space. Fallback tokens but the last of a character have empty ones.
        ends = np.fromiter([p.end for p in right], np.int64, len(b)) + 1
        b_ends = _refined(ends, np.append(False, ends[1:] == ends[:-1]), self.b_sizes[b])
        return a, a_ends, b, b_ends


def _refined(coarse: np.ndarray, unsure: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where each token ends: at the end of its span, or where that does not tell, as many bytes on as it decodes to."""
    exact = np.cumsum(sizes)
    ends = np.where(unsure, exact, coarse)
    return ends if np.array_equal(ends, exact) else exact


class Words:
    """Alignments of words: how many tokens of both, groups and links they have, their groups as text, and their links.

    A link is ``a * n_b + b``. Those of word ``i`` are ``links[starts[i]:starts[i + 1]]``.
    """

    def __init__(self, a: str, b: str):
        self.pair = Pair(a, b)
        #: Ids of both, as text before each of the four marks that can follow in ``groups``.
        ids = [*range(len(self.pair.a_bytes)), *range(self.pair.n_b)]
        self.spelled = np.array([[f"{i}{mark}" for i in ids] for mark in ("", ",", "|", ";")], object)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.text: list[str | None] = []
        self.sizes, self.links, self.starts = np.zeros((1 << 12, 4), np.int64), np.zeros(1 << 14, np.int64), np.zeros(1 << 12, np.int64)
        self.used = np.zeros(1 << 12, np.int64)

    def make_room(self) -> None:
        """Between blocks: with more than ``KNOWN_WORDS``, forget those used once; if that does not halve them, all."""
        if len(self.text) <= KNOWN_WORDS:
            return
        words, text, sizes, links, starts = list(self.known), self.text, self.sizes, self.links, self.starts
        kept = np.flatnonzero(self.used[: len(text)] > 1)
        self.clear()
        if 2 * len(kept) <= KNOWN_WORDS:
            self.known = {words[i]: at for at, i in enumerate(kept.tolist())}
            first, times = starts[kept], starts[kept + 1] - starts[kept]
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            self._add([text[i] for i in kept.tolist()], sizes[kept], links[np.repeat(first, times) + step])

    def _add(self, text: list[str | None], sizes: np.ndarray, links: np.ndarray) -> None:
        n, end = len(self.text), len(self.text) + len(text)
        while end + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
            self.used = np.concatenate([self.used, np.zeros_like(self.used)])
        first = self.starts[n]
        while first + len(links) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.links[first : first + len(links)] = links
        self.starts[n + 1 : end + 1] = first + np.cumsum(sizes[:, 3])
        self.sizes[n:end] = sizes
        self.text += text

    def learn(self, words: list[str]) -> None:
        """Align all words in one text; if tokens do not give that back, halve it until the word that does not is alone."""
        found = self.pair.tokens(" ".join(words)) if words != [""] else None
        if found is None:
            if len(words) == 1:
                self._add([None], np.zeros((1, 4), np.int64), np.zeros(0, np.int64))
            else:
                self.learn(words[: len(words) // 2])
                self.learn(words[len(words) // 2 :])
            return
        a, a_ends, b, b_ends = found
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        word_ends = np.cumsum([1 + len(w.encode()) for w in words])
        group_word = np.searchsorted(word_ends, cuts)
        if not np.array_equal(cuts[np.append(np.flatnonzero(np.diff(group_word)), len(cuts) - 1)], word_ends):
            raise ValueError("a token goes beyond a word")
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        n_a, n_b = np.bincount(a_group, minlength=len(cuts)), np.bincount(b_group, minlength=len(cuts))
        times = n_b[a_group]
        first_b = np.cumsum(n_b) - n_b
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        links = np.repeat(a, times) * self.pair.n_b + b[np.repeat(first_b[a_group], times) + step]
        per_word = lambda x: np.bincount(group_word, x, minlength=len(words)).astype(np.int64)
        sizes = np.stack([per_word(n_a), per_word(n_b), per_word(np.ones(len(cuts))), per_word(n_a * n_b)], axis=1)
        # All tokens in the order of the text, A's before B's in a group, each with the mark that follows it.
        group = np.concatenate([a_group, b_group])
        order = np.argsort(group, kind="stable")
        group, side = group[order], (order >= len(a)).astype(np.int64)
        mark = np.ones(len(order), np.int64)
        mark[:-1][side[1:] > side[:-1]] = 2
        mark[:-1][group[1:] > group[:-1]] = 3
        word = group_word[group]
        last = np.append(np.flatnonzero(np.diff(word)), len(word) - 1)
        mark[last] = 0
        spelled = self.spelled[mark, np.concatenate([a, b + len(self.pair.a_bytes)])[order]].tolist()
        ends = (last + 1).tolist()
        self._add(["".join(spelled[x:y]) for x, y in zip([0, *ends], ends)], sizes, links)

    def codes(self, words: list[str]) -> np.ndarray:
        out = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        lacking = np.flatnonzero(out < 0).tolist()
        if lacking:
            fresh = list(dict.fromkeys(words[i] for i in lacking))
            self.known.update(zip(fresh, range(len(self.text), len(self.text) + len(fresh)), strict=True))
            for first, last in runs(np.fromiter(map(len, fresh), np.int64, len(fresh)), 1 << 16):
                self.learn(fresh[first:last])
            out[lacking] = [self.known[words[i]] for i in lacking]
        self.used[: len(self.text)] += np.bincount(out, minlength=len(self.text))
        return out

    def of_texts(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Sizes and groups of each text; the text, link and number of each of their distinct links, sorted by both."""
        split = [_SPLIT.split(t) if t else [] for t in texts]
        codes = self.codes([w for s in split for w in s])
        ends = np.cumsum([0, *map(len, split)]).tolist()
        groups, whole = [], np.zeros(len(texts), bool)
        every = list(map(self.text.__getitem__, codes.tolist()))
        for i, (low, high) in enumerate(zip(ends, ends[1:])):
            parts = every[low:high]
            whole[i] = bool(parts) and None not in parts
            groups.append(";".join(parts) if whole[i] else "")
        text = np.repeat(np.arange(len(texts)), np.diff(ends))
        own = whole[text]
        text, codes = text[own], codes[own]
        sizes = np.stack([np.bincount(text, self.sizes[codes, k], minlength=len(texts)) for k in range(4)], axis=1).astype(np.int64)
        first, times = self.starts[codes], self.starts[codes + 1] - self.starts[codes]
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        keys, number = np.unique(np.repeat(text, times) << _LINK_BITS | self.links[np.repeat(first, times) + step], return_counts=True)
        return sizes, groups, keys >> _LINK_BITS, keys & (1 << _LINK_BITS) - 1, number


def _block(words: Words, texts: list[str], block: int, ids: pa.Array) -> Iterator[pa.RecordBatch]:
    """Rows of a block's texts, then one row (without sizes) with all distinct links and how many texts hold each."""
    words.make_room()
    found = []
    for first, last in runs(np.fromiter(map(len, texts), np.int64, len(texts)), 1 << 19):
        sizes, groups, text, link, number = words.of_texts(texts[first:last])
        found.append((sizes, groups, text + first, link, number))
    sizes = np.concatenate([f[0] for f in found])
    groups = [g for f in found for g in f[1]]
    text, link, number = (np.concatenate([f[k] for f in found]) for k in (2, 3, 4))
    distinct, rank, held = np.unique(link, return_inverse=True, return_counts=True)
    ends = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
    links = [packed(np.diff(rank[x:y], prepend=0)) if y > x else None for x, y in zip(ends, ends[1:])]
    times = [packed(number[x:y]) if y > x else None for x, y in zip(ends, ends[1:])]
    names = [c.split()[0] for c in _ROW.split(", ")]
    for first, last in runs(np.fromiter(map(len, groups), np.int64, len(groups)) + 16, 4 << 20):
        part = slice(first, last)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(last - first, block)), ids.slice(first, last - first), *[pa.array(sizes[part, k]) for k in range(4)],
             pa.array(groups[part], pa.string()), pa.array(links[part], pa.binary()), pa.array(times[part], pa.binary())],
            names,
        )
    nothing = pa.nulls(1, pa.int64())
    yield pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), *[nothing] * 5, pa.nulls(1, pa.string()), pa.array([distinct.tobytes()], pa.binary()),
         pa.array([held.tobytes()], pa.binary())],
        names,
    )


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as bytes: their width, then the numbers in the least of 1, 2, 4 or 8 bytes each."""
    top = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _encode(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = keep(("aligned words", a, b), lambda: Words(a, b))
        block = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        room = BLOCK_BYTES

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block, held, room
            whole = pa.Table.from_batches(held).combine_chunks()
            texts = [t or "" for t in whole.column("text").to_pylist()]
            yield from _block(words, texts, block, whole.column("doc_id").combine_chunks())
            block, held, room = block + 1, [], BLOCK_BYTES

        for batch in batches:
            lengths = np.diff(utf8(batch.column("text"))[1])
            first = 0
            while first < batch.num_rows:
                fits = int(np.searchsorted(np.cumsum(lengths[first:]), room, side="right"))
                if not fits and held:
                    yield from flush()
                    continue
                fits = max(1, fits)
                held.append(batch.slice(first, fits))
                room -= int(lengths[first : first + fits].sum())
                first += fits
        if held:
            yield from flush()

    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's list of links → one row a link."""
    for batch in batches:
        for block, links, held in zip(*(batch.column(k).to_pylist() for k in ("block", "links", "times")), strict=True):
            link, docs = np.frombuffer(links, np.int64), np.frombuffer(held, np.int64)
            for at in range(0, len(link), 200_000):
                part = link[at : at + 200_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(np.full(len(part), block)), pa.array(docs[at : at + 200_000])], ["link", "block", "docs"]
                )


def _judge(texts: pa.Table, links: pa.Table) -> pa.Table:
    """A block's texts with the corpus-wide counts of its links."""
    order = np.argsort(links.column("link").to_numpy())
    total, best = links.column("total").to_numpy()[order], links.column("best").to_numpy()[order]
    n_best, count_sum = [], []
    for own, times in zip(texts.column("links").to_pylist(), texts.column("times").to_pylist(), strict=True):
        if own is None:
            n_best.append(0)
            count_sum.append(0)
            continue
        rank, often = np.cumsum(unpacked(own)), unpacked(times)
        n_best.append(int(often[best[rank]].sum()))
        count_sum.append(int((often * total[rank]).sum()))
    texts = texts.drop_columns(["block", "links", "times"])
    return texts.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))


def align_documents(docs: DataFrame, a: str, b: str, *columns: Column) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``: how two tokenizers cut each whole text.

    ``a`` and ``b`` are paths of tokenizer files that executors can read; both encode the text after a space. ``groups`` is
    ``a1,a2|b1;a3|b2,b3``; with ``columns``, these expressions over it are returned in its place. A link is a pair of tokens
    of one group, its count the number of documents that hold it. ``n_best`` links have the highest count of their A
    token (ties included); ``count_sum`` sums the counts of all links. A text that is null or empty, or whose tokens do not
    give its bytes back, has no tokens: zeros and an empty string. Repeated rows are documents of their own and count; ids
    may be missing or repeat. An empty table gives an empty result. Other columns of the input are ignored.
    """
    from sentencepiece import SentencePieceProcessor

    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/aligned"
    columns = columns or (F.col("groups"),)
    encoded = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_encode(a, b), _ROW)
    encoded.select(*[c for c in encoded.columns if c != "groups"], F.col("n_a").isNull().alias("whole"), *columns).write.option(
        "compression", "zstd"
    ).parquet(folder)
    rows = spark.read.parquet(folder)
    spread = rows.filter("whole").select("block", "links", "times").mapInArrow(_spread, "link bigint, block bigint, docs bigint")
    counted = spread.withColumn("total", F.sum("docs").over(Window.partitionBy("link"))).withColumn(
        "token", F.expr(f"link div {SentencePieceProcessor(model_file=b).vocab_size()}")
    )
    # One row for each token of A at most, so its size is bound by that vocabulary.
    highest = counted.groupBy("token").agg(F.max("total").alias("highest"))
    known = counted.join(F.broadcast(highest), "token").select("block", "link", "total", (F.col("total") == F.col("highest")).alias("best"))
    texts = rows.filter("not whole").drop("whole")
    kept = [f for f in texts.schema if f.name not in ("block", "links", "times")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", n_best bigint, count_sum bigint"
    return texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_judge, schema)

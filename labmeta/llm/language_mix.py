"""Language identification by multilingual mixture inference.

A text is a mixture of languages: each of its byte 3-grams comes from one of them. Expectation-maximisation finds the
mixture's proportions, and the set of languages is the one with the best penalised likelihood. The n-gram counts of all
learning texts make the model.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeta.llm.wordhash import runs

#: Places that 3-grams are hashed to. The model has so many numbers for each language.
BUCKETS = 4096
#: Rounds of expectation-maximisation over all languages, and over each smaller set.
ROUNDS, SET_ROUNDS = 8, 4
#: Penalty of a language more, in units of log(number of n-grams).
PENALTY = 2.0
_SMOOTH = 0.5
_NO_ID = -(1 << 63)
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def gram_counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed 3-grams, one row a text. A-Z count as a-z, other ASCII as a space; texts begin and end with one."""
    raw = [t.encode() for t in texts]
    data = _FOLD[np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)].astype(np.uint32)
    grams = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    real = grams != 0x202020
    lengths = np.array([len(r) for r in raw]) + 1
    text = np.repeat(np.arange(len(raw)), lengths)[: len(grams)]
    # the 3-gram that lies across two texts
    real &= np.append(text[1:], text[-1:]) == text if len(text) else real
    place = (grams * np.uint32(2654435761)) >> np.uint32(32 - 12)
    flat = np.bincount(text[real] * BUCKETS + place[real], minlength=len(raw) * BUCKETS)
    return flat.reshape(len(raw), BUCKETS)


def _blocks(texts: list[str], most: int = 256) -> Iterator[list[str]]:
    for first, last in runs(np.array([len(t) for t in texts])):
        for at in range(first, last, most):
            yield texts[at : min(last, at + most)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of n-gram counts by language, of all texts of the task."""
    sums: dict[str, np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, total in sums.items():
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(place), pa.string()), pa.array(place.astype(np.int32)), pa.array(total[place])],
                ["lang", "place", "n"],
            )
        sums.clear()

    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = batch.column("text").to_pylist()
        for lang in dict.fromkeys(langs.tolist()):
            for block in _blocks([texts[i] for i in np.flatnonzero(langs == lang)]):
                sums[lang] = sums.get(lang, 0) + gram_counts(block).sum(0)
        if len(sums) > 64:
            yield from out()
    yield from out()


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages of the column ``lang`` and the log-probabilities of n-grams in each.

    All rows count; they are summed in tasks and by Spark, and a row for each language and place reaches the driver. Rows
    without a language or text teach nothing.
    """
    sums = docs.select("lang", "text").dropna().mapInArrow(_count, "lang string, place int, n bigint")
    rows = sums.groupBy("lang", "place").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(rows.column("lang").to_pylist()))
    at = {x: i for i, x in enumerate(langs)}
    counts = np.full((len(langs), BUCKETS), _SMOOTH)
    counts[[at[x] for x in rows.column("lang").to_pylist()], rows.column("place").to_numpy()] += rows.column("n").to_numpy()
    return langs, np.log(counts / counts.sum(1, keepdims=True)) if langs else counts


def _mix(text: np.ndarray, n: np.ndarray, prob: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after ``rounds`` of expectation-maximisation, and the log-likelihood before the last one.

    ``text``, ``n``, ``prob``: the text, count and probabilities by language of each n-gram of a text (grouped by text).
    """
    heads = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    some = text[heads]
    total = np.add.reduceat(n, heads)[:, None]
    value = np.zeros(len(share))
    for _ in range(rounds):
        part = prob * share[text]
        every = part.sum(1)
        value[some] = np.add.reduceat(n * np.log(every), heads)
        share = share.copy()
        share[some] = np.add.reduceat(part * (n / every)[:, None], heads) / total
    return share, value


def proportions(counts: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Language proportions of texts (rows of n-gram counts); 0 for languages outside a text's chosen set.

    The full mixture orders the languages by their share; sets are the first k of that order, and the best has the
    largest log-likelihood less ``PENALTY * k * log(n)``. An empty text has equal shares.
    """
    texts, langs = len(counts), len(logs)
    text, place = np.nonzero(counts)
    even = np.full((texts, langs), 1 / langs)
    if langs == 1 or not len(text):
        return even
    n = counts[text, place].astype(float)
    prob = np.exp(logs.T)[place]
    share, _ = _mix(text, n, prob, even, ROUNDS)
    order = np.argsort(-share, 1, kind="stable")
    rank = np.argsort(order, 1, kind="stable")
    size = np.log(np.maximum(counts.sum(1), 2))
    largest = int((share >= 0.01).sum(1).max())
    best, chosen = np.full(texts, -np.inf), even
    for k in range(1, max(largest, 1) + 1):
        start = np.where(rank < k, np.maximum(share, 1e-6), 0)
        start /= start.sum(1, keepdims=True)
        part, value = _mix(text, n, prob, start, SET_ROUNDS if k > 1 else 1)
        value = value - PENALTY * k * size
        better = value > best
        best = np.where(better, value, best)
        chosen = np.where(better[:, None], part, chosen)
    return chosen


def _predict(langs: list[str], logs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found, score, shares = [], [], []
            for block in _blocks(texts):
                share = proportions(gram_counts(block), logs) if langs else np.zeros((len(block), 0))
                for t, s in zip(block, share, strict=True):
                    if not langs or not _LETTER.search(t):
                        found.append("und")
                        score.append(0.0)
                        shares.append([])
                        continue
                    top = int(s.argmax())
                    found.append(langs[top])
                    score.append(float(min(1.0, s[top])))
                    shares.append([{"lang": langs[i], "share": float(s[i])} for i in np.flatnonzero(s >= 0.01)])
            kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.string()), pa.array(score, pa.float64()), pa.array(shares, kind)],
                ["doc_id", "lang_pred", "score", "mixture"],
            )

    return run


def identify(docs: DataFrame, learning: DataFrame) -> DataFrame:
    """``doc_id, lang_pred, score, mixture``: the main language of each whole text, its share, and the chosen set.

    ``learning`` has ``lang`` and ``text``. ``lang_pred`` is ``und`` (score 0, no set) for a null text, one without a letter,
    or if nothing was learned. Only the text of ``docs`` is used; equal rows give equal results; no shuffle.
    """
    langs, logs = learn(learning)
    schema = "doc_id bigint, lang_pred string, score double, mixture array<struct<lang: string, share: double>>"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_predict(langs, logs), schema)


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % n

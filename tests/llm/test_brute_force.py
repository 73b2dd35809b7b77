"""Probabilities by enumeration, mixtures by plain loops, and winnowing hash by hash."""

import itertools
import math
import random
import re
import struct
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from labmeta.llm import fingerprints, language_mix, line_crf, packing

SCHEMA = "doc_id bigint, text string, kept string, doc string, score string, next_text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z", "n") for i, t in rows], SCHEMA)


# Linear-chain field


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(4)
    counts = [1, 5, 3, 1, 4]
    first = np.cumsum([0, *counts])
    unary, pair = rng.normal(0, 2, first[-1]), rng.normal(0, 1, (2, 2))
    odds, expected = line_crf._passes(unary, pair, first)
    ones, pairs = np.zeros(first[-1]), np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:]):
        total, own, both = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(b - a)):
            p = math.exp(sum(unary[a + i] for i, y in enumerate(labels) if y) + sum(pair[x, y] for x, y in zip(labels, labels[1:])))
            total += p
            own += p * np.array(labels)
            for x, y in zip(labels, labels[1:]):
                both[x, y] += p
        ones[a:b] = own / total
        pairs += both / total
    assert np.allclose(line_crf._sigmoid(odds), ones) and np.allclose(expected, pairs)


def test_scores_weigh_lines_by_length():
    texts = pa.array(["short\na much longer line of words\n!!!", None, "", "one"])
    features, length, first = line_crf.line_features(texts)
    rng = np.random.default_rng(1)
    w, pair = rng.normal(0, 0.3, features.shape[1]), np.array([[0.5, -0.2], [0.1, 0.3]])
    odds, _ = line_crf._passes(features @ w, pair, first)
    p = line_crf._sigmoid(odds)
    want = [sum(p[a:b] * length[a:b]) / sum(length[a:b]) if sum(length[a:b]) else p[a] for a, b in zip(first[:-1], first[1:])]
    assert length.tolist() == [5, 27, 3, 0, 0, 3] and np.allclose(line_crf.scores(texts, w, pair), want)


def test_learned_lines_weigh_as_rows_with_their_neighbours(monkeypatch):
    monkeypatch.setattr(line_crf, "_AT_ONCE", 4)
    texts = pa.array(["short\na much longer line of words\n!!!", None, "", "one", "a\nb b b\n\n12 34\nEND", "x\ny"])
    features, _, first = line_crf.line_features(texts)
    rng = np.random.default_rng(2)
    w, values = rng.normal(0, 1, features.shape[1]), rng.normal(0, 1, len(features))
    lines = line_crf._Lines(texts)
    assert lines.first.tolist() == first.tolist()
    assert np.allclose(lines.weigh(w), features @ w) and np.allclose(lines.gather(values), features.T @ values)


def test_learning_holds_little_beside_the_texts():
    text = pa.array(["\n".join(f"line {i} of {j}, with some words" for i in range(100)) for j in range(400)])
    labels = np.arange(400) % 2
    steps, line_crf.STEPS = line_crf.STEPS, 1
    tracemalloc.start()
    try:
        line_crf.learn_weights(text, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        line_crf.STEPS = steps
    # 40,000 lines of 252 features: 40 MB as a matrix of floats, and more to make it.
    assert peak < 40e6


# Language mixtures


def plain_proportions(grams, logs):
    """The same steps for one text in plain loops."""
    langs = len(logs)
    n = sum(grams.values())
    if langs == 1 or not n:
        return [1 / langs] * langs

    def rounds(share, times):
        value = 0.0
        for _ in range(times):
            value = sum(c * math.log(sum(math.exp(logs[i][g]) * share[i] for i in range(langs))) for g, c in grams.items())
            new = [0.0] * langs
            for g, c in grams.items():
                parts = [math.exp(logs[i][g]) * share[i] for i in range(langs)]
                for i in range(langs):
                    new[i] += c * parts[i] / sum(parts)
            share = [x / n for x in new]
        return share, value

    share, _ = rounds([1 / langs] * langs, language_mix.ROUNDS)
    order = sorted(range(langs), key=lambda i: -share[i])
    best, chosen = -math.inf, None
    for k in range(1, max(1, sum(x >= 0.01 for x in share)) + 1):
        start = [max(share[i], 1e-6) if i in order[:k] else 0.0 for i in range(langs)]
        start = [x / sum(start) for x in start]
        part, value = rounds(start, language_mix.SET_ROUNDS if k > 1 else 1)
        value -= language_mix.PENALTY * k * math.log(max(n, 2))
        if value > best:
            best, chosen = value, part
    return chosen


def test_mixtures_equal_plain_loops():
    rng = random.Random(6)
    alphabets = ["abcd", "abef", "xyz", "éèa"]
    learned = [language_mix.gram_counts(["".join(rng.choice(a + " ") for _ in range(400))])[0] + 0.5 for a in alphabets]
    logs = np.log(np.array([x / x.sum() for x in learned]))
    texts = ["".join(rng.choice(a + " ") for _ in range(rng.randrange(1, 90))) for a in alphabets for _ in range(5)]
    texts += [a + b for a, b in zip(texts[::3], texts[7::2])] + ["", "123", "a", texts[0] * 9]
    counts = language_mix.gram_counts(texts)
    for text, row, got in zip(texts, counts, language_mix.proportions(counts, logs), strict=True):
        folded = bytes(language_mix._FOLD[x] for x in f" {text} ".encode())
        grams = Counter(folded[i : i + 3] for i in range(len(folded) - 2))
        grams.pop(b"   ", None)
        assert row.sum() == grams.total()
        if not grams:
            continue  # no letter, so no language is told
        assert np.allclose(got, plain_proportions(dict(zip(np.flatnonzero(row).tolist(), row[row > 0].tolist())), logs), atol=1e-9)


def test_languages_of_nothing_and_ties(spark):
    empty = frame(spark, []).selectExpr("doc_id", "text", "kept as lang")
    assert language_mix.identify(empty, empty).count() == 0
    docs = spark.createDataFrame([(1, "aaa"), (1, "aaa"), (None, None), (2, "12 34"), (3, "")], "doc_id bigint, text string")
    twins = spark.createDataFrame([("aaa aaa", "one"), ("aaa aaa", "two"), (None, "three"), ("bbb", None)], "text string, lang string")
    got = sorted((str(r["doc_id"]), r["lang_pred"]) for r in language_mix.identify(docs, twins).collect())
    # Of languages that fit alike, the first by name.
    assert got == [("1", "one"), ("1", "one"), ("2", "und"), ("3", "und"), ("None", "und")]
    assert {r["lang_pred"] for r in language_mix.identify(docs, twins.limit(0)).collect()} == {"und"}


# Winnowing


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def winnowed(text, k=fingerprints.GRAM, window=fingerprints.WINDOW):
    """(hash, place) of the least hash of each window, the last of equal ones."""
    words = [signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in WORD.findall(text)]
    if not words:
        return []
    grams = []
    for i in range(max(len(words) - k, 0) + 1):
        h = 42
        for w in words[i : i + k]:
            h = xxhash.xxh64_intdigest(struct.pack("<q", w), seed=h)
        grams.append(h >> 25)
    kept = set()
    for i in range(max(len(grams) - window, 0) + 1):
        own = range(i, min(i + window, len(grams)))
        at = min(own, key=lambda j: (grams[j], -j))
        kept.add((grams[at], at))
    return sorted(kept, key=lambda x: x[1])


@pytest.mark.parametrize("vocabulary", [3, 200])
def test_winnowing_keeps_what_a_plain_loop_keeps(spark, vocabulary):
    rng = random.Random(vocabulary)
    text = lambda n: "".join(f"w{rng.randrange(vocabulary)}{rng.choice([' ', chr(10), chr(9) + ' ', chr(0xA0)])}" for _ in range(n))
    rows = [(i, text(n)) for i, n in enumerate([0, 1, 3, 4, 5, 14, 15, 16, 40, 300, 3000])] + [(50, None), (None, text(30)), (3, text(9)), (3, text(9))]
    last = (1 << fingerprints.PLACE_BITS) - 1
    got = Counter()
    for r in fingerprints.fingerprints(frame(spark, rows)).collect():
        kept = sorted(((v >> fingerprints.PLACE_BITS, last - v % (1 << fingerprints.PLACE_BITS)) for v in r["fingerprint"]), key=lambda x: x[1])
        got[r["doc_id"], tuple(kept)] += 1
    assert got == Counter((i, tuple(winnowed(t or ""))) for i, t in rows)


def test_likeness_is_the_share_of_common_hashes(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(60))) for i in range(9)] + [(None, None), (20, ""), (21, "a b c")]
    order = sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0], reverse=True)
    out = {r["doc_id"]: r for r in fingerprints.compared_with_edits(frame(spark, rows)).collect()}

    def like(a, b):
        x, y = ({h for h, _ in winnowed(t)} for t in (a, b))
        return len(x & y) / len(x | y) if x | y else 1.0

    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        assert out[i]["edited"] == edited
        assert out[i]["near_next"] == pytest.approx(like(t, following)) and out[i]["near_edited"] == pytest.approx(like(t, edited))


def test_fingerprints_of_nothing(spark):
    assert fingerprints.fingerprints(frame(spark, [])).count() == 0
    assert fingerprints.compared_with_edits(frame(spark, [])).count() == 0


# Packing


@pytest.mark.parametrize("seed", [5, 130, 7])
def test_a_better_plan_found_below_ends_the_search_above(seed):
    # With the first two, a plan found deep down left no room where the search went on.
    rng = random.Random(seed)
    capacity = rng.choice([60, 100, 200])
    low = rng.choice([1, capacity // 5, capacity // 4])
    histogram = {k: rng.randrange(1, 4) for k in range(low, rng.randrange(low + 2, capacity))}
    found = packing.plan(histogram, capacity)
    used = Counter()
    for filling, times in found:
        assert sum(k * n for k, n in filling) <= capacity
        for k, n in filling:
            used[k] += n * times
    assert used == histogram
    total = sum(k * n for k, n in histogram.items())
    assert -(-total // capacity) <= sum(n for _, n in found) <= sum(n for _, n in packing.best_fit(histogram, capacity))

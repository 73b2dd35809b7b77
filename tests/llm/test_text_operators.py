"""Text operators against plain Python on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from labmeta.llm import decontam, fingerprints, gated_lm, language_mix, line_crf, near_dedup, packing, secret_scan
from labmeta.llm import substring_dedup, token_rollup
from labmeta.llm.queries import tokenizer
from labmeta.sources.tables import shared_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, part string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, "x", "y") for i, t in rows], SCHEMA)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = words(rng, 120)
    near = [*base[:60], "other", *base[61:]]
    long = words(rng, 6000)
    rows = [
        (7, " ".join(base)), (3, " ".join(near)), (9, " ".join(base)), (9, " ".join(base)), (1, None), (2, ""), (4, " \t\n"),
        (5, "one two"), (6, "One\tTWO"), (10, " ".join(long)), (11, " ".join([*words(rng, 5), *base[10:60], *words(rng, 9)])),
        (12, " ".join(["same"] * 90)), (None, "lonely text without an id"), (13, " ".join(long[:4000])),
    ]
    return rows


def removed(rows, size=20):
    first, places = {}, {}
    key = lambda i: -(1 << 63) if i is None else i
    for i, t in rows:
        w = WORD.findall(t or "")
        for p in range(len(w) - size + 1):
            s = tuple(w[p : p + size])
            first[s] = min(first.get(s, (key(i), p)), (key(i), p))
    for i, t in rows:
        w = WORD.findall(t or "")
        cut = {q for p in range(len(w) - size + 1) if first[tuple(w[p : p + size])] < (key(i), p) for q in range(p, p + size)}
        places[i] = (len(w), len(cut), " ".join(x for q, x in enumerate(w) if q not in cut))
    return places


def test_substring_dedup(spark, texts):
    out = substring_dedup.remove_repeats(frame(spark, texts)).collect()
    want = removed(texts)
    assert len(out) == len(texts)
    for r in out:
        assert (r.n_words, r.n_removed, r.kept_text) == want[r.doc_id]
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_substring_dedup_tells_texts_of_one_id_apart(spark):
    rng = random.Random(12)
    passage = words(rng, 50, 9000)
    with_it = lambda k: " ".join([*words(rng, k, 9000), *passage, *words(rng, 30, 9000)])
    clean = lambda: " ".join(words(rng, 200, 9000))
    rows = [(None, with_it(100)), (None, with_it(100)), (None, clean()), (3, with_it(40)), (3, clean()), (4, clean())]
    rows += [(6, rows[5][1]), (6, clean()), (6, rows[5][1])]
    out = substring_dedup.remove_repeats(frame(spark, rows)).collect()
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in out)
    want = [(0, 180, 0), (0, 180, 50), (0, 200, 0), (3, 120, 50), (3, 200, 0), (4, 200, 0), (6, 200, 0), (6, 200, 200), (6, 200, 200)]
    assert got == want
    kept = {r.kept_text for r in out}
    assert all(rows[i][1] in kept for i in (2, 4, 5, 7))


def shingles(text, size):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


@pytest.mark.parametrize("size,num", [(3, 85), (5, 80)])
def test_near_duplicates(spark, texts, size, num):
    rng = random.Random(size)
    base = words(rng, 200)
    rows = texts + [(100 + k, " ".join("v%d" % k if j == 3 * k else x for j, x in enumerate(base))) for k in range(40)]
    sets = {i: shingles(t, size) for i, t in rows if i is not None}
    comp = {i: i for i in sets}
    for _ in range(len(sets)):
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
        if all(comp[comp[a]] == comp[a] for a in comp):
            break
    out = near_dedup.near_duplicates(frame(spark, rows), size, num, 100).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), comp[r.doc_id], comp[r.doc_id] == r.doc_id)
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0


def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer

    rows = [(i, t) for i, t in texts if i is not None and i != 9] + [(20 + k, "It's the. don't! 12.5 É<|endoftext|>" * k) for k in range(30)]
    coder = Tokenizer.from_file(tokenizer())
    packed = packing.pack_documents(frame(spark, rows), tokenizer()).cache()
    pieces = {(r.doc_id, r.piece): r for r in packed.collect()}
    for i, t in rows:
        ids = [*coder.encode(t or "", add_special_tokens=False).ids, packing.END]
        data = b"".join(x.to_bytes(4, "little") for x in ids)
        own = [pieces[i, k] for k in range(-(-len(ids) // 4096))]
        assert b"".join(bytes(p.ids) for p in own) == data and [p.start for p in own] == list(range(0, len(ids), 4096))
    seqs = {}
    for r in pieces.values():
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in pieces.values())
    assert len(seqs) <= -(-total // 4096) + 1
    full = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in full) == 4 * total
    assert packing.pack_documents(frame(spark, []), tokenizer()).count() == 0


def test_plan_uses_up_the_histogram():
    rng = random.Random(1)
    for _ in range(20):
        histogram = {rng.randrange(1, 65): rng.randrange(1, 2000) for _ in range(30)}
        used = {}
        n = 0
        for filling, times in packing.plan(histogram, 64):
            assert sum(k * c for k, c in filling) <= 64
            n += times
            for k, c in filling:
                used[k] = used.get(k, 0) + c * times
        assert used == histogram
        room: dict[int, int] = {}  # best-fit decreasing: room left -> sequences
        bins = 0
        for length in sorted(histogram, reverse=True):
            for _ in range(histogram[length]):
                fit = min((r for r, k in room.items() if k and r >= length), default=None)
                if fit is None:
                    bins += 1
                    fit = 64
                else:
                    room[fit] -= 1
                room[fit - length] = room.get(fit - length, 0) + 1
        assert n <= bins * 1.01 + 1
    assert packing.plan({1: 5000}, 4096) == [([(1, 4096)], 1), ([(1, 904)], 1)]


def test_near_duplicates_compare_texts_not_ids(spark):
    import corpus_pipeline

    rng = random.Random(8)
    near = lambda t, at: " ".join("changed" if i == at else w for i, w in enumerate(t.split()))
    a, b, c, d = (" ".join(words(rng, 90, 5000)) for _ in range(4))
    rows = [(5, a), (5, b), (3, near(a, 0)), (None, c), (7, c), (8, near(c, 89)), (None, d), (None, near(d, 0)), (9, near(d, 89)), (None, None), (4, "")]
    docs = frame(spark, rows)
    out = {(r.doc_id, r.text_hash): r for r in near_dedup.near_duplicates(docs, 5, 80, 100, with_hash=True).collect()}
    hashes = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    got = [(out[i, hashes[i, t]].component_id, out[i, hashes[i, t]].kept) for i, t in rows]
    assert got[:6] == [(3, False), (5, True), (3, True), (None, True), (None, False), (None, False)]
    assert sorted(got[6:8]) == [(None, False), (None, True)] and got[8:] == [(None, False), (None, True), (4, True)]
    whole = docs.withColumn("n_chars", F.length("text").cast("bigint"))
    left = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, whole, "").collect()]
    assert len(left) == 6 and {(5, b), (3, near(a, 0)), (None, c), (None, None), (4, "")} < set(left)


def bins_of(chosen, histogram, capacity):
    used = {}
    for filling, times in chosen:
        assert times > 0 and sum(k * c for k, c in filling) <= capacity
        for k, c in filling:
            used[k] = used.get(k, 0) + c * times
    assert used == {k: n for k, n in histogram.items() if n}
    return sum(times for _, times in chosen)


def test_plan_is_never_worse_than_best_fit_decreasing():
    for times in (1, 1000):
        histogram = {k: n * times for k, n in {15: 1, 14: 1, 13: 1, 12: 1, 11: 2, 8: 1, 4: 1}.items()}
        assert bins_of(packing.plan(histogram, 30), histogram, 30) <= 3 * times
    rng = random.Random(6)
    better = 0
    for _ in range(150):
        capacity = rng.choice([20, 30, 64])
        items = [rng.randrange(capacity // 6, capacity // 2 + 2) for _ in range(rng.randrange(4, 11))]
        rooms = []
        for x in sorted(items, reverse=True):
            fit = min((r for r in rooms if r >= x), default=None)
            if fit is not None:
                rooms.remove(fit)
            rooms.append((capacity if fit is None else fit) - x)
        histogram = {x: items.count(x) for x in items}

        def fits(left, rooms):
            return not left or any(
                fits(left[1:], [*rooms[:i], r - left[0], *rooms[i + 1 :]]) for i, r in enumerate(rooms) if r >= left[0] and r not in rooms[:i]
            )

        best = next(n for n in range(1, 12) if fits(sorted(items, reverse=True), [capacity] * n))
        assert bins_of(packing.best_fit(histogram, capacity), histogram, capacity) == len(rooms)
        assert bins_of(packing.plan(histogram, capacity), histogram, capacity) == best
        better += best < len(rooms)
    assert better  # some of them need the search


def test_secret_ledger(spark):
    key, hexes = "AKIA" + "Q" * 16, "0123456789abcdef" * 3
    rows = [(1, f"é password: '{hexes}' x"), (2, f"é password: '{hexes}' x"), (3, None), (4, ""), (5, f"token=short {key}"),
            (5, f"token=short {key}"), (None, "API_KEY = abcdefgh12"), (6, "secret=\"token\":\"abcdefgh\"")]
    root = shared_folder(spark)
    docs = frame(spark, rows)
    out = {r.doc_id: [(s.start, s.end, s.kind) for s in r.found] for r in secret_scan.secrets_of(docs, root).collect()}
    assert out[1] == out[2] == [(2, 2 + 11 + 48, "assign"), (13, 61, "hex")] and out[3] == out[4] == []
    assert out[5] == [(12, 32, "access")] and out[None] == [(0, 20, "assign")] and out[6] == []
    ledger = secret_scan.Ledger(spark, shared_folder(spark)).scan("a", secret_scan.addressed(docs))
    assert ledger.read(secret_scan.RULES).count() == 6 - 1 + 1 - 1
    more = secret_scan.addressed(frame(spark, [*rows, (8, "new text")]))
    again = ledger.scan("b", more)
    assert spark.read.parquet(f"{again.root}/b").count() == 1  # only the unseen blob
    assert again.scan("b", more) == again
    masked = {r.doc_id: r.text for r in secret_scan.masked(docs, shared_folder(spark)).collect()}
    assert masked[1] == "é [SECRET]' x" and masked[3] is None and masked[5] == "token=short [SECRET]"


def test_leaks(spark):
    rng = random.Random(5)
    items = [(k, " ".join(words(rng, 40, 5000))) for k in range(5)] + [(9, None), (10, "a b")]
    edited = items[1][1].split()
    for at in (3, 11, 19, 27, 35):
        edited[at] = "changed"
    del edited[14]
    edited.insert(22, "more")
    bad = items[2][1].split()
    for at in range(0, 40, 4):
        bad[at] = "changed"
    around = lambda ws: " ".join([*words(rng, 50, 5000), *ws, *words(rng, 30, 5000)])
    docs = [(0, around(items[0][1].upper().replace(" ", ", ").split())), (1, around(edited)), (2, around(bad)), (3, None), (4, ""), (5, around([]))]
    found = {(r.doc_id, r.item_id): (r.edits, r.end_word - r.start_word) for r in decontam.leaks(
        frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert found == {(0, 0): (0, 40), (1, 1): (7, 40)}
    assert decontam.leaks(frame(spark, docs), spark.createDataFrame([], "item_id bigint, text string")).count() == 0


def test_fingerprints(spark, texts):
    rows = [(i, t) for i, t in texts if i != 9]
    out = fingerprints.compared_with_edits(frame(spark, rows)).collect()
    order = sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0], reverse=True)
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        r = next(x for x in out if x.doc_id == i)
        assert (r.n_chars, r.edited) == (len(t), t[: len(t) - half] + following[:half])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        n = len(WORD.findall(t))
        places = [fingerprints.PLACE_BITS and (1 << 24) - 1 - v % (1 << 24) for v in r.kept]
        grams = max(n - fingerprints.GRAM + 1, 1) if n else 0
        # every window of hashes has a kept place
        for s in range(max(grams - fingerprints.WINDOW + 1, 1 if grams else 0)):
            assert any(s <= p < s + fingerprints.WINDOW for p in places)
    same = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(frame(spark, texts)).collect()}
    assert same[7] == same[9] != same[3]


def test_rollup(spark):
    root = shared_folder(spark)
    docs = frame(spark, [(1, "a b c"), (2, "a1 b"), (3, None), (None, "x")])
    up = token_rollup.counted(docs).withColumn("op", F.lit("upsert"))
    first = token_rollup.Rollup(spark, root).apply(1, up)
    change = token_rollup.counted(frame(spark, [(1, "a"), (2, "q"), (8, "never seen")]))
    change = change.withColumn("op", F.when(F.col("doc_id") == 1, "upsert").otherwise("delete"))
    twice = first.apply(2, change).apply(2, change)
    got = {r.version: (r.n_docs, r.n_tokens, r.n_chars) for r in twice.totals().collect()}
    assert got == {"words-1": (3, 2, 2), "pieces-1": (3, 2, 2)}
    assert {r.version: r.n_tokens for r in first.totals().collect()} == {"words-1": 6, "pieces-1": 7}


def test_rollup_counts_every_row_without_an_id(spark):
    docs = frame(spark, [(1, "a b"), (None, "x"), (None, "x"), (None, "y z")])
    up = token_rollup.counted(docs).withColumn("op", F.lit("upsert"))
    rollup = token_rollup.Rollup(spark, shared_folder(spark)).apply(1, up).apply(1, up)
    rollup = rollup.apply(2, token_rollup.counted(frame(spark, [(None, "x"), (1, "c")])).withColumn("op", F.lit("delete")))
    assert {r.version: (r.n_docs, r.n_tokens) for r in rollup.totals().collect()} == {"words-1": (3, 4), "pieces-1": (3, 4)}
    assert rollup.states().count() == 0


def test_rollup_counts_every_row_of_a_repeated_id(spark):
    docs = token_rollup.counted(frame(spark, [(1, "a b"), (1, "c"), (1, "c"), (2, "d"), (2, "e")]).withColumn("lang", F.col("text")))
    rollup = token_rollup.Rollup(spark, shared_folder(spark)).apply(1, docs.withColumn("op", F.lit("upsert")))
    total = lambda r: {x.version: (x.n, x.t) for x in r.totals().groupBy("version").agg(F.sum("n_docs").alias("n"), F.sum("n_tokens").alias("t")).collect()}
    assert total(rollup)["words-1"] == (5, 6)
    change = docs.filter("text is not null").withColumn("op", F.when(F.col("doc_id") == 1, "delete").otherwise("upsert"))
    twice = rollup.apply(2, change).apply(2, change).apply(3, change.filter("doc_id = 2").limit(1))
    assert total(twice)["words-1"] == (1, 1)


def test_language_and_quality(spark):
    rng = random.Random(2)
    make = lambda parts, n: " ".join(rng.choice(parts) + rng.choice(parts) for _ in range(n))
    one, two = ["sch", "und", "ein", "ich"], ["eau", "oux", "lle", "que"]
    learning = spark.createDataFrame([(make(one, 50), "de") for _ in range(20)] + [(make(two, 50), "fr") for _ in range(20)] + [(None, "en"), ("x", None)], "text string, lang string")
    docs = frame(spark, [(1, make(one, 40)), (2, make(two, 40)), (3, make(one, 60) + " " + make(two, 30)), (4, None), (5, "12 !"), (6, "")])
    out = {r.doc_id: r for r in language_mix.identify(docs, learning).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3, 4, 5, 6)] == ["de", "fr", "de", "und", "und", "und"]
    assert len(out[3].mixture) == 2 and 0.55 < out[3].score < 0.8
    assert language_mix.identify(docs, learning.limit(0)).filter("lang_pred <> 'und'").count() == 0
    good = [(k, "\n".join(make(one, 12) + "." for _ in range(4))) for k in range(60)]
    bad = [(100 + k, "\n".join(make(one, 12).upper().replace(" ", "!! ") for _ in range(4))) for k in range(60)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in good + bad if i % 3], "doc_id bigint, label int")
    weights = line_crf.learn(frame(spark, good + bad), labels)
    scored = {r.doc_id: r.score for r in line_crf.with_quality(frame(spark, good + bad + [(500, None), (501, "")]), weights).collect()}
    assert all((scored[i] >= 0.3) == (i < 100) for i, _ in good + bad) and 0 <= scored[500] == scored[501] <= 1
    assert line_crf.learn(frame(spark, good), labels.limit(0)) is None


def test_near_duplicates_propose_pairs_once(spark, monkeypatch):
    # Proposals were made twice, once for the texts of a group and once for its pairs, with all shuffles before them.
    rng = random.Random(5)
    rows = [(k, " ".join(words(rng, 60, 900))) for k in range(30)]
    rows += [(100 + k, f"{rows[k][1]} and{k}") for k in range(10)] + [(200 + k, rows[k][1]) for k in range(10)]
    made, real = spark.sparkContext.accumulator(0), near_dedup._forests

    def counted(*a):
        run = real(*a)

        def task(batches):
            for batch in run(batches):
                made.add(len(set(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("tree").to_pylist(), strict=True))))
                yield batch

        return task

    monkeypatch.setattr(near_dedup, "_forests", counted)
    out = {r.doc_id: r for r in near_dedup.near_duplicates(frame(spark, rows), 3, 80, 100).collect()}
    assert all(out[100 + k].component_id == out[200 + k].component_id == k for k in range(10))
    assert sum(r.kept for r in out.values()) == 30
    assert 10 <= made.value <= 10 * near_dedup.TREES


def test_language_model(spark, texts):
    import math
    from collections import Counter

    rows = [(i, t) for i, t in texts if i != 9]
    docs = frame(spark, rows)
    out = {r.doc_id: r for r in gated_lm.score_documents(docs, F.col("doc_id") % 2 == 0).collect()}
    tokens = {i: [*WORD.findall((t or "").lower()), "\n"] for i, t in rows}
    c = Counter(w for i, ws in tokens.items() if i is not None and i % 2 == 0 for w in ws)
    n = sum(c.values())
    for i, ws in tokens.items():
        r = out[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (len(c) + 1))) for w in ws), rel_tol=1e-9)
        assert r.score < 0
    none = gated_lm.score_documents(docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in none)


@pytest.mark.parametrize("frequent", [0, 40])
def test_language_model_scores_rows_not_ids(spark, monkeypatch, frequent):
    import math
    from collections import Counter

    monkeypatch.setattr(gated_lm, "FREQUENT", frequent)
    rng = random.Random(4)
    rows = [(k, " ".join(words(rng, 60, 90))) for k in range(8)]
    rows += [rows[3], rows[3], (5, "other words under one id"), (None, "w1 w2 first"), (None, "w3 second second"), (None, None)]
    learned = Counter()
    for i, t in rows:
        if i is not None and i % 2:
            learned.update([*(t or "").split(), "\n"])
    n = sum(learned.values())
    want = []
    for _, t in rows:
        ws = [*(t or "").split(), "\n"]
        base = sum(math.log10((learned[w] + 0.1) / (n + 0.1 * (len(learned) + 1))) for w in ws)
        want.append((len(ws), sum(learned[w] > 0 for w in ws), round(base, 6)))
    out = gated_lm.score_documents(frame(spark, rows), F.col("doc_id") % 2 == 1).collect()
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out) == sorted(want)
    assert len({round(r.score, 6) for r in out if r.doc_id == 3}) == 1


def test_language_model_learns_all_words_from_all_rows(spark, monkeypatch):
    # Far down in the vocabulary, a word foretells the next one: only weights of their own can tell.
    rng = random.Random(11)
    pairs = [(f"a{k}", f"b{k}") for k in range(1500)]
    text = lambda: " ".join(w for _ in range(60) for w in rng.choice(pairs))
    rows = [(k, text()) for k in range(1200)]
    docs = frame(spark, rows).repartition(4)
    seen = spark.sparkContext.accumulator(0)
    real = gated_lm.Learner.learn

    def counted(self, codes, *rest):
        seen.add(int((codes == -2).sum()))
        return real(self, codes, *rest)

    monkeypatch.setattr(gated_lm.Learner, "learn", counted)
    fit = gated_lm._fit
    monkeypatch.setattr(gated_lm, "_fit", lambda *a: _with_learner(fit(*a), counted))
    out = gated_lm.score_documents(docs, F.col("doc_id") % 4 != 0).collect()
    assert seen.value == 900
    left_out = [r for r in out if r.doc_id % 4 == 0]
    assert len(out) == 1200 and sum(r.score for r in left_out) > sum(r.base_score for r in left_out) * 0.93
    vocab = gated_lm.vocabulary(gated_lm.word_counts(docs), 1200)
    assert vocab.words == 3000 and vocab.word_classes == 55


def test_language_model_sends_weights_and_vocabulary_once(spark, monkeypatch):
    # Weights went to all executors before the first round too, and stayed there; each function had a vocabulary of its own.
    import os

    rng = random.Random(3)
    docs = frame(spark, [(k, " ".join(words(rng, 30, 200))) for k in range(40)])
    asked, fit, score, rare = [], gated_lm._fit, gated_lm._score, gated_lm._rare
    monkeypatch.setattr(gated_lm, "_fit", lambda *a: asked.append(a[:2]) or fit(*a))
    monkeypatch.setattr(gated_lm, "_score", lambda *a: asked.append(a) or score(*a))
    monkeypatch.setattr(gated_lm, "_rare", lambda *a: asked.append((None, *a)) or rare(*a))
    assert len(gated_lm.score_documents(docs, F.col("doc_id") % 4 != 0).collect()) == 40
    assert len(asked) == gated_lm.ROUNDS + 2 and len({id(a[1]) for a in asked}) == 1
    assert asked[0][0] is None and not os.path.exists(asked[1][0]._path) and os.path.exists(asked[2][0]._path)


def test_language_model_scores_late_steps_together(monkeypatch):
    # Output probabilities were computed for every 16 steps, however few texts were left: a long text paid for each class each time.
    import numpy as np

    rng = np.random.default_rng(2)
    counts = np.sort(rng.integers(2, 90, 60))[::-1]
    classes = np.arange(60) // 8
    vocab = gated_lm.Vocabulary({b"w%d" % i: i for i in range(60)}, counts, classes, np.searchsorted(classes, np.arange(9)), 1, 5000, 61, 9, np.ones(gated_lm.SHAPES), np.ones(gated_lm.SHAPES))
    model = gated_lm.Model(vocab)
    model.w["o"] += rng.normal(0, 0.5, model.w["o"].shape).astype(np.float32)
    model.w["c"] += rng.normal(0, 0.5, model.w["c"].shape).astype(np.float32)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 70, n)) for n in (700, 3, 0, 40, 1)]
    codes, kinds, ids, offsets, _ = gated_lm.encode(texts, vocab)
    real, calls = gated_lm.output_logs, []
    monkeypatch.setattr(gated_lm, "output_logs", lambda *a: calls.append(len(a[2])) or real(*a))
    found = gated_lm.network_logs(model, codes, kinds, ids, offsets)
    assert calls == [len(codes)]
    monkeypatch.setattr(gated_lm, "AT_ONCE_SCORED", 50)
    assert np.allclose(found, gated_lm.network_logs(model, codes, kinds, ids, offsets), rtol=1e-6) and sum(calls[1:]) == len(codes) and len(calls) > 10
    log_p = lambda x: x - x.max() - np.log(np.exp(x - x.max()).sum())
    for k in range(len(texts)):
        h, last, want = np.zeros((1, gated_lm.HIDDEN), np.float32), model.end, 0.0
        for j in range(offsets[k], offsets[k + 1]):
            h = model.step(h, np.array([last]))[0]
            want += log_p(h[0] @ model.w["c"] + model.w["cb"])[kinds[j]]
            if codes[j] >= 0:
                own = slice(int(vocab.bounds[kinds[j]]), int(vocab.bounds[kinds[j] + 1]))
                want += log_p(model.w["o"][own] @ h[0] + model.w["ob"][own])[codes[j] - own.start]
            last = ids[j]
        assert np.isclose(found[k], want, rtol=1e-4)


def _with_learner(run, learn):
    def task(batches):
        gated_lm.Learner.learn = learn
        yield from run(batches)

    return task


def test_leaks_go_by_rows_not_ids(spark, monkeypatch):
    import corpus_pipeline

    rng = random.Random(9)
    item = " ".join(words(rng, 40, 5000))
    leaking = lambda k: " ".join([*words(rng, k, 5000), item, "end"])
    rows = [(None, leaking(20)), (None, "clean words"), (None, None), (1, leaking(30)), (1, "clean under id 1"), (2, leaking(9)), (3, "")]
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    docs = frame(spark, rows).withColumn("n_chars", F.length("text").cast("bigint"))
    left = {(r.doc_id, r.text) for r in corpus_pipeline.benchmark_leaks(spark, docs, "").collect()}
    assert left == {(None, "clean words"), (None, None), (1, "clean under id 1"), (3, "")}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, kept, sf).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns == docs.columns and 0 < after.count() <= kept.count()
        kept = after
    assert not any(secret_scan.find_spans(r.text or "") for r in kept.collect())
    out = corpus_pipeline.run(spark, sf)
    assert out.select("doc_id").distinct().count() == kept.count()
    assert hashlib.sha256(b"").hexdigest()

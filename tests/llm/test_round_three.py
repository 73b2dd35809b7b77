"""Token alignment, fill-in-middle and column-wise suffix dedup against plain Python, with nulls, ties and odd texts."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from labmeta.llm import alignment, column_suffix, decontam, fim, secret_scan, token_rollup
from labmeta.sources.tables import shared_folder

#: Extra columns with names that the operators use themselves.
SCHEMA = (
    "doc_id bigint, text string, lang string, d1 string, anchor string, n string, form string, output string, draws string, "
    "block string, links string, total string, groups string, spans string"
)
A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * 12) for i, t in rows], SCHEMA)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(n))


# Fill-in-middle

LINES = re.compile(r"[^\n]*\n|[^\n]+")


def reordered(i, text, rate, spm):
    text = text or ""
    units = LINES.findall(text)
    n = len(units)
    h = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return i, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm:
        return i, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return i, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def lined():
    rng = random.Random(5)
    rows = [(None, "without\nan id"), (1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "one line"), (6, "a <P> mark\nb"), (6, "a\nb\nc\n")]
    shared = "\n".join(prose(rng, 8) for _ in range(60))
    rows += [(7 + i, f"{prose(rng, i)}\n{shared}\n{prose(rng, 5)}") for i in range(30)]
    rows += [(40, "x" * 70_000), (41, "\n".join(prose(rng, 3) for _ in range(20_000))), (6, "a\nb\nc\n"), (42, "<\nP>\r\n<S")]
    return rows


@pytest.mark.parametrize("rate, spm", [(100, 50), (60, 0)])
def test_fill_in_middle(spark, lined, rate, spm):
    out = fim.fill_in_middle(frame(spark, lined), rate=rate, spm=spm)
    got = out.withColumn("text", fim.restored(out["output"], out["form"])).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted([tuple(r[:6]) for r in got], key=key) == sorted([reordered(i, t, rate, spm) for i, t in lined], key=key)
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((i, t or "") for i, t in lined)


def test_fill_in_middle_of_nothing(spark):
    assert fim.fill_in_middle(frame(spark, [])).count() == 0


def test_summaries_add_up_however_a_text_is_cut():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(["a", "é", "\n", "<", "P", ">", "<P", "S>", "中"]) for _ in range(rng.randrange(1, 60)))
        data = text.encode()
        at = [0]
        while at[-1] < len(data):  # as with chunks, only the last may be short
            at.append(min(len(data), at[-1] + rng.randrange(4, 12)))
        whole = fim.Text.of([fim.summarise(data[x:y]) for x, y in zip(at, at[1:])])
        units = LINES.findall(text)
        assert whole.units == len(units)
        assert whole.marked == bool(re.search("<[PSM]>", text))
        for k in range(len(units) + 1):
            assert whole.end_of(k) == (len("".join(units[:k]).encode()), len("".join(units[:k])))


def test_chunks_depend_on_content_and_are_summarised_once():
    rng = random.Random(4)
    shared = prose(rng, 4000).encode()
    chunks = fim.Chunks()
    sizes = []
    for start in (b"", b"other words " * 9):
        data = start + shared
        ends = fim.candidates(np.frombuffer(data, np.uint8)).tolist()
        parts = list(fim.cuts(ends, 0, len(data)))
        assert b"".join(data[x:y] for x, y in parts) == data
        for x, y in parts:
            chunks.summary(data[x:y])
        sizes.append((len(parts), len(chunks.known)))
    assert sizes[1][1] - sizes[0][1] < 5 < sizes[0][0]


# Token alignment

ODD = [
    (None, "a text without an id"), (1, None), (2, ""), (3, " "), (4, "  two  spaces \n\n and\ttabs "), (5, "<|endoftext|> <s> </s> <0x0A> <unk>"),
    (6, "é中𝔘 🙂🙂 ﬁ naïve"), (7, "low line ▁ here"), (7, "low line ▁ here"), (8, "same words"), (8, "same words"), (9, "same words again, same words"),
    (10, " nbsp　wide   line"), (11, "x" * 3000), (12, "\x00\x01 control"), (13, "don't can't 12,345.67 é"), (14, "𝔘"),
]


def plain_alignment(rows):
    pair = alignment.Pair(A, B)
    found, count = [], Counter()
    for _, text in rows:
        a = pair.a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = pair.b.encode(text) if text else []
        ends = []
        for ids, table in ((a, pair.a_bytes), (b, pair.b_bytes)):
            data = [table[i] for i in ids]
            ends.append(np.cumsum([len(x) for x in data]).tolist() if b"".join(data) == (" " + (text or "")).encode() else None)
        if not text or None in ends:
            found.append(None)
            continue
        parts, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(cut) + 1, ends[1].index(cut) + 1
            parts.append((a[i:x], b[j:y]))
            i, j = x, y
        links = [(x, y) for p, q in parts for x in p for y in q]
        found.append((a, b, parts, links))
        count.update(set(links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (i, _), f in zip(rows, found, strict=True):
        if f is None:
            out.append((i, 0, 0, 0, 0, "", 0, 0))
            continue
        a, b, parts, links = f
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in parts)
        out.append((i, len(a), len(b), len(parts), len(links), text, sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links)))
    return out


def test_alignment(spark):
    rng = random.Random(8)
    rows = ODD + [(100 + i, prose(rng, 60)) for i in range(20)] + [(200, "the same long text. " * 500)]
    got = alignment.align_documents(frame(spark, rows), A, B).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"
    )
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, plain_alignment(rows)))


def test_alignment_of_nothing(spark):
    assert alignment.align_documents(frame(spark, []), A, B).count() == 0
    only = alignment.align_documents(frame(spark, [(1, None), (2, "")]), A, B).collect()
    assert {(r["doc_id"], r["n_a"], r["n_links"], r["groups"]) for r in only} == {(1, 0, 0, ""), (2, 0, 0, "")}


def test_words_are_forgotten_without_loss(monkeypatch):
    rng = random.Random(3)
    texts = [prose(rng, 30) for _ in range(60)]
    monkeypatch.setattr(alignment, "KNOWN_WORDS", 40)
    small, fresh = alignment.Words(A, B), alignment.Words(A, B)
    for i in range(0, 60, 10):
        small.make_room()
        for x, y in zip(small.of_texts(texts[i : i + 10]), fresh.of_texts(texts[i : i + 10]), strict=True):
            assert np.array_equal(x, y)


def test_refined_ends():
    pair = alignment.Pair(A, B)
    for text in ("é中𝔘 🙂🙂x", "naïve 𝔘𝔘", "a"):
        a, a_ends, b, b_ends = pair.tokens(text)
        assert a_ends.tolist() == np.cumsum([len(pair.a_bytes[i]) for i in a]).tolist()
        assert b_ends.tolist() == np.cumsum([len(pair.b_bytes[i]) for i in b]).tolist()


# Column-wise suffix dedup


def cut_repeats(rows, size):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[p : p + size] for p in range(len(b) - size + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - size + 1):
            if count[b[p : p + size]] > 1:
                gone[p : p + size] = True
        gone = gone[: len(b)]
        spans = int((gone & ~np.append(False, gone[:-1])).sum())
        out.append((i, len(b), int(gone.sum()), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.fixture(scope="module")
def repeating():
    rng = random.Random(11)
    base = prose(rng, 120)
    passage = prose(rng, 14)
    rows = [(1, None), (2, ""), (3, "short"), (4, base), (5, base), (5, base), (None, prose(rng, 30)), (None, prose(rng, 30) + passage)]
    rows += [(10 + i, f"{prose(rng, 20)} {passage} {prose(rng, 20)}") for i in range(12)]
    rows += [(30 + i, base[: 200 + i] + "#" + base[201 + i :]) for i in range(8)]
    rows += [(40, "ab" * 400), (41, "x" * 300), (42, "中" * 100 + "é" * 90), (43, passage[:40]), (44, passage[:39]), (45, base[50:300] * 2)]
    rows += [(50 + i, "".join(rng.choice("ab") for _ in range(200))) for i in range(10)]
    return rows


@pytest.mark.parametrize("hot", [2000, 2])
def test_repeated_bytes(spark, repeating, monkeypatch, hot):
    monkeypatch.setattr(column_suffix, "HOT", hot)
    got = column_suffix.remove_repeated_bytes(frame(spark, repeating), 40).collect()
    row = lambda r: (str(r[0]), *r[1:4], bytes(r[4]))
    assert sorted(map(row, got)) == sorted(map(row, cut_repeats(repeating, 40)))


def test_repeated_bytes_of_nothing(spark):
    assert column_suffix.remove_repeated_bytes(frame(spark, [])).count() == 0
    only = column_suffix.remove_repeated_bytes(frame(spark, [(1, None), (2, "a" * 399)])).collect()
    assert {(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in only} == {(1, 0, 0, 0), (2, 399, 0, 0)}


def test_every_window_has_an_anchor_in_parts_of_long_texts(monkeypatch):
    monkeypatch.setattr(column_suffix, "BLOCK_BYTES", 300)
    rng = random.Random(6)
    part = prose(rng, 60)
    texts = [prose(rng, 100) + part + prose(rng, 10), part + "q", "ab" * 500]
    batch = pa.RecordBatch.from_pydict({"text": texts, "d1": [0, 1, 2], "d2": [0, 1, 2]})
    found = defaultdict(set)
    seen = Counter()
    for out in column_suffix._anchors(40)(iter([batch])):
        for r in out.to_pylist():
            data = texts[r["d1"]].encode()
            for at in r["places"]:
                for distance in range(r["least"], r["back"] + 1):
                    window = data[at - distance : at - distance + 40]
                    assert len(window) == 40
                    seen[r["d1"], at - distance] += 1
                    found[window].add((r["anchor"], distance))
    assert all((i, p) in seen for i, t in enumerate(texts) for p in range(len(t.encode()) - 39))
    assert all(len(anchors) == 1 for anchors in found.values())


def test_columns_give_the_suffix_order():
    rng = random.Random(7)
    group = np.array([0] * 30 + [1] * 20 + [2])
    pieces = ["".join(rng.choice("ab") for _ in range(12)) for _ in group]
    order, common = np.arange(len(group)), np.zeros(len(group) + 1, np.int32)
    for c in range(11, -1, -1):
        order, common = column_suffix.insert_column(np.array([ord(p[c]) for p in pieces]), group, order, common)
        suffixes = [(int(group[i]), pieces[i][c:]) for i in order]
        assert suffixes == sorted(suffixes)
        for k in range(1, len(order)):
            (g, x), (h, y) = suffixes[k - 1 : k + 1]
            same = next((n for n, (p, q) in enumerate(zip(x, y)) if p != q), len(x)) if g == h else 0
            assert common[k] == same


# Restarts


def test_a_new_ledger_over_a_folder_knows_its_batches(spark):
    root = shared_folder(spark)
    docs = frame(spark, [(1, "password = hunter2hunter2"), (2, "plain"), (3, None)])
    secret_scan.Ledger(spark, root).scan("a", secret_scan.addressed(docs))
    again = secret_scan.Ledger(spark, root)
    assert again.batches == ("a",) and again.read(secret_scan.RULES).count() == 3
    more = again.scan("b", secret_scan.addressed(docs.unionByName(frame(spark, [(4, "new")]))))
    assert spark.read.parquet(f"{root}/b").count() == 1
    assert secret_scan.Ledger(spark, root).batches == more.batches == ("a", "b")


def test_a_new_rollup_over_a_folder_goes_on(spark):
    root = shared_folder(spark)
    docs = lambda *rows: token_rollup.counted(frame(spark, rows).withColumn("source", F.lit("s"))).withColumn("op", F.lit("upsert"))
    token_rollup.Rollup(spark, root).apply(1, docs((1, "a b"), (2, "c")))
    token_rollup.Rollup(spark, root).apply(2, docs((1, "a"), (3, None)))
    token_rollup.Rollup(spark, root).apply(2, docs((1, "a"), (3, None)))
    last = token_rollup.Rollup(spark, root)
    assert last.batches == (1, 2)
    got = {r["version"]: (r["n_docs"], r["n_tokens"]) for r in last.totals().collect()}
    assert got == {"words-1": (3, 2), "pieces-1": (3, 2)}
    assert last.states().filter("version = 'words-1'").agg(F.sum("n_tokens")).first()[0] == 2


def test_empty_tables_have_empty_ledgers_and_rollups(spark):
    assert secret_scan.secrets_of(frame(spark, []), shared_folder(spark)).count() == 0
    empty = token_rollup.counted(frame(spark, []).withColumn("source", F.lit("s"))).withColumn("op", F.lit("upsert"))
    assert token_rollup.Rollup(spark, shared_folder(spark)).apply(1, empty).totals().count() == 0


# Decontamination


def least_edits(item, text):
    """The fewest word edits that turn ``item`` into some stretch of ``text``."""
    line = [0] * (len(text) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(text):
            new.append(min(line[j] + (x != y), line[j + 1] + 1, new[j] + 1))
        line = new
    return min(line)


def edited(rng, item, edits):
    out = list(item)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = f"x{rng.randrange(9999)}"
        elif kind == 1:
            out.insert(at, f"x{rng.randrange(9999)}")
        elif len(out) > 1:
            del out[at]
    return out


def test_leaks_against_all_edit_distances(spark):
    rng = random.Random(12)
    word = lambda: f"w{int(rng.paretovariate(0.7))}"
    sizes = [1, 2, 3, 4, 5, 6, 7, 9, 10, 12, 14, 20, 30, 40, 60, 90]
    items = [(k, [f"i{k}x{j}" if j % 4 == 0 else word() for j in range(n)]) for k, n in enumerate(sizes)]
    items.append((None, [f"n{j}" for j in range(12)]))
    items.append((3, [f"again{j}" for j in range(4)]))
    docs = []
    for d in range(200):
        _, item = items[d % len(items)]
        edits = rng.randrange(decontam.allowed_edits(len(item)) + 2)
        docs.append((d, [word() for _ in range(rng.randrange(30))] + edited(rng, item, edits) + [word() for _ in range(rng.randrange(30))]))
    got = decontam.leaks(
        frame(spark, [(i, " ".join(w)) for i, w in docs] + [(None, " ".join(items[9][1])), (1000, None), (1001, "")]),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(77, None), (78, ""), (79, "...")], "item_id bigint, text string"),
    ).collect()
    found = Counter((r["doc_id"], r["item_id"], r["edits"]) for r in got)
    want, short = Counter(), Counter()
    for i, text in docs:
        for k, item in items:
            n = least_edits(item, text)
            if n <= decontam.allowed_edits(len(item)):
                want[i, k, n] += 1
                if decontam.allowed_edits(len(item)) < 2:
                    short[i, k, n] += 1
    assert not short - found, "items of few edits are all found"
    inside = Counter({k: v for k, v in found.items() if k[0] is not None})
    assert {k[:2] for k in inside} <= {k[:2] for k in want}
    assert sum((inside & want).values()) >= 0.95 * sum(want.values())
    assert (None, 9, 0) in found


def test_samples_tell_unlike_windows_apart_and_repeated_words_add_little():
    rng = random.Random(13)
    items = decontam.prepare([0, 1], [" ".join(f"a{rng.randrange(300)}" for _ in range(40)), "same " * 200])
    block = decontam.Block(0, *decontam.plain_words(*decontam.utf8(pa.array([" ".join(f"a{rng.randrange(300)}" for _ in range(5000))]))))
    assert len(decontam.candidates(block, items)) < 50
    block = decontam.Block(0, *decontam.plain_words(*decontam.utf8(pa.array(["same " * 8000]))))
    rows = decontam.candidates(block, items)
    assert 0 < len(rows) < 8000 / 20 and (rows[:, 1] == 1).all()
    assert any((edits == 0).any() for *_, edits in decontam.matches(block, items))


def test_items_are_sampled_along_their_whole_length(spark):
    rng = random.Random(14)
    item = [f"w{j}" for j in range(120)]
    # All the edits that are allowed stand at the beginning, or at the end.
    head, tail = ([f"x{j}" for j in range(24)] + item[24:], item[:-24] + [f"x{j}" for j in range(24)])
    pad = lambda: [f"p{rng.randrange(1000)}" for _ in range(50)]
    docs = [(k, " ".join(pad() + text + pad())) for k, text in enumerate((item, head, tail, item[24:]))]
    got = decontam.leaks(frame(spark, docs), spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.edits) for r in got} == {(0, 0), (1, 24), (2, 24), (3, 24)}


def test_shared_words_are_never_too_few():
    rng = np.random.default_rng(15)
    text = decontam.mix(rng.integers(1, 40, (50, 30)).astype(np.uint64))
    item = decontam.mix(rng.integers(1, 40, (50, 12)).astype(np.uint64))
    lengths = rng.integers(1, 13, 50)
    real = [sum(w in set(t) for w in row[:n].tolist()) for row, n, t in zip(item, lengths, text.tolist(), strict=True)]
    assert (decontam.shared_words(item, lengths, text) >= np.array(real)).all()

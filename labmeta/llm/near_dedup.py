"""MinHash near-dedup by an LSH forest.

Each text's set of word shingles gets a MinHash signature, cut into one key for each of several trees. A tree is its
keys in sorted order; texts that share a prefix of the key form a region. The shortest prefix is chosen so that a pair
at the threshold shares it in some tree but for one case in about 100,000. A region that is crowded is taken at a
greater depth, so candidates there are the neighbours with the longest common prefixes.

Candidates are confirmed on full shingle sets, in two rounds. The first confirms a spanning forest of each group's most
similar pairs, which joins large groups of copies with about one check a text. The second compares, at the shortest
prefix, all pairs that are not in one component yet. So a crowded region costs neither all pairs nor lost links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labmeta.llm.held import lean
from labmeta.llm.wordhash import Block, rolled, blocks, mix

TREES, DEPTH = 16, 6
HASHES = TREES * DEPTH
#: A region of more texts is taken at a greater depth, in the first round also in blocks of about this size.
CROWD = 128
#: Blocks of the second round; two of them are compared in one group.
BLOCK = 512
_MISS = 2e-5
_NO_ID = -(1 << 63)
_FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def prefix_depth(threshold: float) -> int:
    """The greatest depth at which a pair at the threshold shares no prefix in any tree with a chance of 2e-5 at most."""
    fitting = [d for d in range(1, DEPTH + 1) if (1 - threshold**d) ** TREES <= _MISS]
    return max(fitting, default=1)


def shingle_sets(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a block's texts, sorted within each text, and where each text's begin.

    A text with fewer words than ``size`` has one shingle of all its words; one without words has none.
    """
    starts, hashes = block.windows(size)
    texts = block.texts[starts]
    short = np.flatnonzero((block.counts > 0) & (block.counts < size))
    if len(short):
        hashes = np.concatenate([hashes, rolled(block.hashes, block.offsets[short], block.offsets[short + 1])])
        texts = np.concatenate([texts, short])
    order = np.lexsort((hashes, texts))
    hashes, texts = hashes[order], texts[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    hashes, texts = hashes[new], texts[new]
    return hashes, np.searchsorted(texts, np.arange(len(block.counts) + 1))


def _signatures(size: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text"), fold=True):
                hashes, offsets = shingle_sets(block, size)
                n = np.diff(offsets)
                some = n > 0
                heads = offsets[:-1][some]
                signs = np.zeros((len(n), HASHES), np.uint16)
                first, second = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                if len(heads):
                    for i, factor in enumerate(_FACTORS):
                        least = np.minimum.reduceat(hashes * factor, heads)
                        signs[some, i] = mix(least).astype(np.uint16)
                    first[some] = np.add.reduceat(mix(hashes), heads)
                    second[some] = np.add.reduceat(mix(hashes ^ _FACTORS[0]), heads)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(block.first, len(n)) for k in ("row", "text_hash")), pa.array(n.astype(np.int64)),
                     pa.array(first.view(np.int64)), pa.array(second.view(np.int64)),
                     pa.array([s.tobytes() for s in signs], pa.binary())],
                    ["row", "text_hash", "n", "d1", "d2", "sign"],
                )

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that hold whole groups, from rows sorted by ``at``."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        keys = table.column("at").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _forest(pairs: np.ndarray, likeness: np.ndarray) -> list[int]:
    """A spanning forest of the most similar pairs, as indexes."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i in np.argsort(-likeness, kind="stable").tolist():
        a, b = top(int(pairs[i, 0])), top(int(pairs[i, 1]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append(i)
    return out


def _arrays(table: pa.Table) -> dict[str, np.ndarray]:
    rows = {k: table.column(k).to_numpy() for k in table.schema.names if k not in ("sign", "text")}
    rows["sign"] = np.frombuffer(b"".join(table.column("sign").to_pylist()), np.uint16).reshape(-1, HASHES)
    return rows


def _pairs_within(at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows with the same ``at`` (sorted), in arrays of bounded size."""
    heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    sizes = np.diff(np.append(heads, len(at)))
    for size in np.unique(sizes[sizes > 1]).tolist():
        some = heads[sizes == size]
        if size <= 2 * CROWD:
            left, right = np.triu_indices(size, 1)
            step = max(1, 1_000_000 // size**2)
            for k in range(0, len(some), step):
                starts = some[k : k + step, None]
                yield (starts + left).ravel(), (starts + right).ravel()
        else:  # row by row
            for start in some.tolist():
                for a in range(start, start + size - 1):
                    b = np.arange(a + 1, start + size)
                    yield np.full(len(b), a), b


def _likely(rows: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, cut: float, num: int, den: int) -> tuple:
    """The pairs of different parts whose set sizes allow a link and whose signatures agree in a share ``cut``."""
    n, part, signs = rows["n"], rows["part"], rows["sign"]
    low, high = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
    keep = (part[a] != part[b]) & (den * low >= num * high)
    a, b = a[keep], b[keep]
    shares = [(signs[a[i : i + 20_000]] == signs[b[i : i + 20_000]]).mean(1) for i in range(0, len(a), 20_000)]
    share = np.concatenate(shares or [np.zeros(0)])
    good = share >= cut
    return a[good], b[good], share[good]


def _first_tree(rows: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """The first tree in which each pair shares a prefix of ``depth``."""
    keys = rows["sign"].reshape(-1, TREES, DEPTH)[:, :, :depth]
    out = np.zeros(len(a), np.int64)
    for i in range(0, len(a), 20_000):
        out[i : i + 20_000] = (keys[a[i : i + 20_000]] == keys[b[i : i + 20_000]]).all(2).argmax(1)
    return out


def _block_pair(rows: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The group in which a pair is confirmed: its region and the two blocks that its texts fall in."""
    blocks = rows["blocks"][a].astype(np.uint64)
    i, j = (mix(rows["doc"][x].view(np.uint64)) % blocks for x in (a, b))
    i, j = np.minimum(i, j), np.maximum(i, j)
    return mix(mix(rows["region"][a].view(np.uint64)) + i * blocks + j).view(np.int64)


def _forests(cut: float, num: int, den: int):
    """Groups of rows → of each group, a spanning forest of its likely pairs: one pair a text at most."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            rows = _arrays(table)
            for a, b in _pairs_within(rows["at"]):
                a, b, share = _likely(rows, a, b, cut, num, den)
                # row indexes differ between groups, so one forest serves all of them
                chosen = _forest(np.stack([a, b], 1), share)
                a, b = a[chosen], b[chosen]
                if len(a):
                    doc = rows["doc"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (np.minimum(doc[a], doc[b]), np.maximum(doc[a], doc[b]), rows["tree"][a], rows["at"][a])],
                        ["a", "b", "tree", "group"],
                    )

    return run


def _once(rows: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of two own texts of a block, or of an own one and a guest. Guests are never of the region's largest part, so
    a pair of two texts that are guests to each other is taken in the block of the smaller id."""
    own, main, doc = rows["own"], rows["main"], rows["doc"]
    x, y = np.where(own[a], a, b), np.where(own[a], b, a)
    keep = own[x] & (own[y] | main[x] | (doc[x] < doc[y]))
    return a[keep], b[keep]


def _open_groups(cut: float, num: int, den: int, depth: int):
    """Blocks of regions → which texts each pair of blocks needs, for likely pairs that no earlier tree shares.

    Texts are returned, not pairs: a block pair has two blocks of texts at most, however many pairs they make.
    """

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            rows = _arrays(table)
            found = []
            for a, b in _pairs_within(rows["at"]):
                a, b, _ = _likely(rows, *_once(rows, a, b), cut, num, den)
                keep = _first_tree(rows, a, b, depth) == rows["tree"][a]
                a, b = a[keep], b[keep]
                if len(a):
                    group = _block_pair(rows, a, b)
                    found.append(np.unique(np.stack([np.append(group, group), np.append(a, b)], 1), axis=0))
            if found:
                group, row = np.unique(np.concatenate(found), axis=0).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group.copy()), *(pa.array(rows[k][row]) for k in ("tree", "region", "blocks", "doc", "part"))],
                    ["at", "tree", "region", "blocks", "doc", "part"],
                )

    return run


def _confirm_groups(size: int, cut: float, num: int, den: int, depth: int):
    """Block pairs with signatures and texts → their likely pairs at or over ``num / den`` on full sets."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            rows = _arrays(table)
            sets: list[np.ndarray] = []
            for block in blocks(table.column("text").combine_chunks(), fold=True):
                hashes, offsets = shingle_sets(block, size)
                sets += [hashes[offsets[i] : offsets[i + 1]].copy() for i in range(len(offsets) - 1)]
            left, right = [], []
            for a, b in _pairs_within(rows["at"]):
                a, b, _ = _likely(rows, a, b, cut, num, den)
                keep = (_first_tree(rows, a, b, depth) == rows["tree"][a]) & (_block_pair(rows, a, b) == rows["at"][a])
                for x, y in zip(a[keep].tolist(), b[keep].tolist(), strict=True):
                    if _linked(sets[x], sets[y], num, den):
                        left.append(rows["doc"][x])
                        right.append(rows["doc"][y])
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return den * common >= num * (len(both) - common)


def _confirm(size: int, num: int, den: int):
    """Rows ``group, a, b, text`` sorted by group, its texts (``b`` null) first → its pairs at or over ``num / den``."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        current = None
        for batch in batches:
            group, a, b = (batch.column(k).to_pylist() for k in ("group", "a", "b"))
            left, right = [], []
            for block in blocks(batch.column("text"), fold=True):
                hashes, offsets = shingle_sets(block, size)
                for i in range(len(offsets) - 1):
                    row = block.first + i
                    if group[row] != current:
                        current = group[row]
                        sets.clear()
                    if b[row] is None:
                        sets[a[row]] = hashes[offsets[i] : offsets[i + 1]].copy()
                        continue
                    if _linked(sets[a[row]], sets[b[row]], num, den):
                        left.append(a[row])
                        right.append(b[row])
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` whose full shingle sets reach ``num / den``.

    A pair that several trees propose is confirmed in the first of them, in its group, which holds each text once.
    """
    pairs = pairs.groupBy("a", "b").agg(F.min(F.struct("tree", "group")).alias("first")).select("a", "b", "first.group")
    held = pairs.select("group", F.explode(F.array("a", "b")).alias("doc")).distinct().join(texts, "doc")
    rows = held.select("group", F.col("doc").alias("a"), F.lit(None).cast("bigint").alias("b"), "text")
    rows = rows.unionByName(pairs.withColumn("text", F.lit(None).cast("string")))
    sorted_rows = rows.repartition("group").sortWithinPartitions("group", "b", "a")
    return sorted_rows.mapInArrow(_confirm(size, num, den), "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for all nodes of the links ``a, b``.

    Alternating large-star and small-star steps; each is a few joins and aggregates, and every round is checkpointed.
    Nodes of many links are never gathered: minima are aggregated and joined back.
    """

    def kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
        edges = edges.checkpoint()
        return edges, tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, known = kept(pairs.distinct())
    while known[0]:
        few = known[0] // 20_000 + 2  # as many tasks as the links need, not as many as the documents do
        edges = edges.coalesce(few)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.coalesce(few).distinct().coalesce(few)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a").coalesce(few)
        up, across = joined.select("a", F.col("m").alias("b")), joined.filter("b > m")
        small = up.unionByName(across.select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct().coalesce(few)
        edges, now = kept(small)
        if now == known:
            break
        known = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def joined_components(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` (``node, component``) after more ``links``: components of components, and of nodes not in ``parts``."""
    end = lambda c: parts.select(F.col("node").alias(c), F.col("component").alias(f"{c}_part"))
    named = links.join(end("a"), "a", "left").join(end("b"), "b", "left").select(
        "a", "b", F.coalesce("a_part", "a").alias("x"), F.coalesce("b_part", "b").alias("y")
    ).checkpoint()
    top = components(named.select(F.col("x").alias("a"), F.col("y").alias("b")))
    top = top.select(F.col("node").alias("component"), F.col("component").alias("top"))
    fresh = named.select(F.explode(F.array(F.struct("a", "x"), F.struct(F.col("b").alias("a"), F.col("y").alias("x")))).alias("e"))
    fresh = fresh.select(F.col("e.a").alias("node"), F.col("e.x").alias("component"))
    every = parts.unionByName(fresh).distinct()
    return every.join(top, "component", "left").select("node", F.coalesce("top", "component").alias("component"))


def _kept(rows: DataFrame, each: int = 20_000) -> DataFrame:
    """``rows``, computed once; they are read in as many tasks as they need, not as many as the shuffle had partitions."""
    rows = rows.checkpoint()
    return rows.coalesce(rows.count() // each + 2)


def _prefix(key: str, depth: int):
    return F.substring(key, 1, 2 * depth)


def _regions(reps: DataFrame, depth: int) -> DataFrame:
    """``tree, key, region, doc, n_here``: texts that share a prefix of ``depth`` with another one in that tree."""
    trees = F.explode(F.array(*[
        F.struct(F.lit(t).alias("tree"), F.substring("sign", 1 + 2 * DEPTH * t, 2 * DEPTH).alias("key"))
        for t in range(TREES)
    ]))
    rows = reps.select("doc", trees.alias("t")).select("doc", "t.tree", "t.key", _prefix("t.key", depth).alias("region"))
    many = rows.groupBy("tree", "region").agg(F.count("*").alias("n_here")).filter("n_here > 1")
    return rows.join(many, ["tree", "region"])


def linked_parts(sets: DataFrame, places: DataFrame, texts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """``node, component`` of all pairs of ``sets`` (``doc, n, sign``) at or over ``num / den``. ``places`` (``doc, row,
    text_hash``) names a text of each set, to be found in ``texts`` (``row, text_hash, text``, in which rows may repeat)."""
    threshold = num / den
    depth = prefix_depth(threshold)
    cut = threshold - 4 * (threshold * (1 - threshold) / HASHES) ** 0.5
    regions = _kept(_regions(sets.select("doc", "sign"), depth))
    near = texts.join(places.join(regions.select("doc").distinct(), "doc"), ["row", "text_hash"])
    near = _kept(near.dropDuplicates(["row", "text_hash"]).select("doc", "text"), 2_000)
    here = F.xxhash64("tree", "region")
    # Round 1: crowded regions at greater depths, and in blocks where even whole keys are crowded.
    deeper = regions.filter(F.col("n_here") > CROWD)
    groups = regions.filter(F.col("n_here") <= CROWD).select("doc", "tree", here.alias("at"))
    for d in range(depth + 1, DEPTH + 1):
        sub = deeper.withColumn("region", _prefix("key", d)).drop("n_here")
        counts = sub.groupBy("tree", "region").agg(F.count("*").alias("n_here"))
        sub = sub.join(counts, ["tree", "region"])
        groups = groups.unionByName(sub.filter(f"n_here between 2 and {CROWD}").select("doc", "tree", here.alias("at")))
        deeper = sub.filter(F.col("n_here") > CROWD)
    block = F.pmod(F.xxhash64("doc", "tree"), F.ceil(F.col("n_here") / CROWD))
    groups = groups.unionByName(deeper.select("doc", "tree", F.xxhash64("tree", "region", block).alias("at")))

    def grouped(rows: DataFrame, *columns: str) -> DataFrame:
        rows = rows.join(sets, "doc").select("at", "doc", "n", "part", "tree", *columns, "sign")
        return rows.repartition("at").sortWithinPartitions("at", "doc")

    first = _kept(grouped(groups.withColumn("part", F.col("doc"))).mapInArrow(
        _forests(cut, num, den), "a bigint, b bigint, tree int, group bigint"
    ))
    links = confirmed(first, near, size, num, den).checkpoint()
    # Round 2: what shares a region at the shortest prefix and is not joined yet.
    parts = components(links).checkpoint()
    member = _kept(regions.select("tree", here.alias("region"), "doc", "n_here").join(
        parts, F.col("doc") == F.col("node"), "left"
    ).select("tree", "region", "doc", "n_here", F.coalesce("component", "doc").alias("part")))
    split = member.groupBy("tree", "region", "part").agg(F.count("*").alias("n")).groupBy("tree", "region").agg(
        F.max_by("part", "n").alias("largest"), F.count("*").alias("n_parts")
    ).filter("n_parts > 1").drop("n_parts")
    open_ = member.join(split, ["tree", "region"]).withColumn("blocks", F.ceil(F.col("n_here") / BLOCK).cast("int"))
    open_ = open_.withColumn("home", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    guest = (F.col("part") != F.col("largest")) & (F.col("blocks") > 1)
    open_ = open_.withColumn("block", F.explode(F.when(guest, everywhere).otherwise(F.array("home")))).select(
        F.xxhash64("tree", "region", "block").alias("at"), "doc", "part", (F.col("home") == F.col("block")).alias("own"),
        (F.col("part") == F.col("largest")).alias("main"), "tree", "region", "blocks",
    )
    needed = grouped(open_, "own", "main", "region", "blocks").mapInArrow(
        _open_groups(cut, num, den, depth), "at bigint, tree int, region bigint, blocks int, doc bigint, part bigint"
    ).distinct()
    second = grouped(needed.join(near, "doc"), "region", "blocks", "text").mapInArrow(
        _confirm_groups(size, cut, num, den, depth), "a bigint, b bigint"
    )
    return joined_components(parts, second)


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, with_hash: bool = False) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id, kept``: one row for each row of ``docs``.

    Two texts are linked if ``den`` times their common distinct shingles of ``size`` words (A-Z folded) is at least ``num``
    times all of them. ``component_id`` is the smallest id reachable, ``class_id`` the smallest id with exactly the same
    set. A text with fewer words than ``size`` has one shingle; a null text or one without words has none, is linked with
    nothing and kept. Rows are told apart by id and text: rows may share an id or have none, equal ones share all values, and
    of each component the rows of the smallest id are kept, of these those of one text. A null id counts as the smallest.
    Other columns are ignored; ``with_hash`` adds ``text_hash`` (``xxhash64`` of the text, a null one as empty).

    Sets, not ids, are compared: their 64-bit digest ``d1`` is the node of the forest.
    """
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.col("text"),
    )
    schema = "row bigint, text_hash bigint, n bigint, d1 bigint, d2 bigint, sign binary"
    sets = texts.mapInArrow(_signatures(size), schema).checkpoint()
    key = ["d1", "d2", "row", "text_hash"]
    classes = _kept(sets.filter("n > 0").groupBy("d1", "d2").agg(F.min(F.struct("row", "text_hash")).alias("first")))
    places = classes.select(F.col("d1").alias("doc"), "first.row", "first.text_hash")
    reps = sets.join(classes.select("d1", "d2", "first.*"), key, "left_semi").dropDuplicates(key)
    parts = linked_parts(_kept(reps.select(F.col("d1").alias("doc"), "n", "sign")), places, texts, size, num, den)
    parts = parts.withColumnRenamed("node", "d1").join(classes.select("d1", "first"), "d1")
    top = parts.groupBy("component").agg(F.min("first").alias("top"))
    named = classes.join(parts.join(top, "component").select("d1", "top"), "d1", "left")
    named = named.select("d1", "d2", "first", F.coalesce("top", "first").alias("top"))
    out = sets.drop("sign").join(named, ["d1", "d2"], "left")
    class_id = F.when(F.col("n") > 0, F.col("first.row")).otherwise(F.col("row"))
    component = F.when(F.col("n") > 0, F.col("top.row")).otherwise(F.col("row"))
    kept = (F.col("n") == 0) | ((F.col("row") == F.col("top.row")) & (F.col("text_hash") == F.col("top.text_hash")))
    clean = lambda c: F.nullif(c, F.lit(_NO_ID))
    return out.select(
        clean(F.col("row")).alias("doc_id"), F.col("n").alias("n_shingles"), clean(class_id).alias("class_id"),
        clean(component).alias("component_id"), kept.alias("kept"), *(["text_hash"] if with_hash else []),
    )

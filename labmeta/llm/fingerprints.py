"""Document fingerprints by winnowing, in column expressions only.

A text's words are hashed, every ``k`` consecutive words give one rolling hash, and of every ``window`` consecutive
hashes the smallest is kept, the rightmost of equal ones, with its place. So any match of ``window + k - 1`` words or
more shares at least one kept hash, and none shorter than ``k`` words is seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM = 4
WINDOW = 12
#: Bits of a place within a kept value; the rest holds the hash.
PLACE_BITS = 24
_NO_ID = -(1 << 63)
#: Documents of one range of ids, and the most ranges there are.
RANGE_DOCS, RANGES = 2_000, 4_096


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Adds ``out``, the kept hashes of ``text`` with their places: longs ``hash * 2**24 + (2**24 - 1 - place)``.

    Since the place counts down, the smallest value of a window is its smallest hash at the rightmost place. A word is a
    run without ASCII white space. A text of 1 to ``k`` words has one hash, of all its words; with fewer hashes than a
    window, the smallest of all is kept; an empty or null text keeps none. In a text of over 16 million words, places
    start again from 0. The steps are columns of their own so that each is computed once.
    """
    last = (1 << PLACE_BITS) - 1
    own = df.columns
    parts = F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+")
    df = df.select(*own, F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w)).alias("__words"))
    size = F.size("__words")
    grams = F.transform(
        F.sequence(F.lit(0), F.greatest(size - F.lit(k), F.lit(0))),
        lambda i: F.shiftleft(F.shiftrightunsigned(F.xxhash64(*[F.get("__words", i + j) for j in range(k)]), 25), PLACE_BITS)
        + (F.lit(last) - i % F.lit(1 << PLACE_BITS)),
    )
    none = F.expr("cast(array() as array<bigint>)")
    df = df.select(*own, F.when(size > 0, grams).otherwise(none).alias("__grams"))
    kept = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("__grams") - F.lit(window - 1), F.lit(1))),
        lambda i: F.array_min(F.slice("__grams", i, F.lit(window))),
    )
    return df.select(*own, F.when(F.size("__grams") > 0, F.array_distinct(kept)).otherwise(none).alias(out))


def hashes(kept: str) -> Column:
    """The distinct hashes of kept values, without their places."""
    return F.array_distinct(F.transform(kept, lambda v: F.shiftright(v, PLACE_BITS)))


def likeness(a: str, b: str) -> Column:
    """The share of hashes that two sets have in common (0 to 1); 1.0 for two empty sets."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, F.lit(1.0)).otherwise(common / every)


def as_text(kept: str) -> Column:
    """``hash:place`` of all kept values in order of place, comma-joined; hashes in hexadecimal."""
    last = (1 << PLACE_BITS) - 1
    one = lambda v: F.concat(
        F.hex(F.shiftright(v, PLACE_BITS)), F.lit(":"), (F.lit(last) - v % F.lit(1 << PLACE_BITS)).cast("string")
    )
    return F.array_join(F.transform(kept, one), ",")


def _ranges(ids: DataFrame) -> list[int]:
    """Splits of the ids into ranges of about ``RANGE_DOCS`` documents, ascending, ``RANGES - 1`` of them at most."""
    n = min(RANGES, ids.count() // RANGE_DOCS + 1)
    if n == 1:
        return []
    splits = ids.agg(F.percentile_approx("doc", [i / n for i in range(1, n)], 10_000)).first()[0]
    return sorted(set(splits or []))


def _range_of(doc: Column, splits: list[int], step: int = 64) -> Column:
    """How many splits are smaller than ``doc``, found in two steps of up to 64 comparisons."""
    if not splits:
        return F.lit(0)
    coarse = F.size(F.filter(F.lit(splits[step - 1 :: step]), lambda s: s < doc)) if len(splits) >= step else F.lit(0)
    fine = F.get(F.array(*[F.lit(splits[i : i + step]) for i in range(0, len(splits), step)]), coarse)
    return coarse * step + F.coalesce(F.size(F.filter(fine, lambda s: s < doc)), F.lit(0))


def with_next(docs: DataFrame, *columns: str) -> DataFrame:
    """Adds ``next_<column>`` from the next row by descending ``doc``; after the last comes the first.

    Rows of one id are ordered by text. Rows are dealt to ranges of ids, each sorted by itself; the first row of a range
    is also put, as a mark, behind the last row of the range before it, so no range looks into another. Only the
    ranges' splits and largest ids (``RANGES`` at most) pass through the driver.
    """
    splits = _ranges(docs.select("doc"))
    tagged = docs.withColumn("__range", _range_of(F.col("doc"), splits)).withColumn("__mark", F.lit(0))
    tops = tagged.groupBy("__range").agg(F.max("doc").alias("top")).orderBy(F.desc("__range")).collect()
    if not tops:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    before = {tops[(i + 1) % len(tops)]["top"]: r["__range"] for i, r in enumerate(tops)}
    pairs = [F.lit(x) for top, at in before.items() for x in (top, at)]
    marks = docs.filter(F.col("doc").isin(list(before))).withColumn(
        "__range", F.element_at(F.create_map(*pairs), F.col("doc"))
    ).withColumn("__mark", F.lit(1))
    order = Window.partitionBy("__range").orderBy("__mark", F.desc("doc"), "text")
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    return tagged.unionByName(marks).select(*docs.columns, "__mark", *following).filter("__mark = 0").drop("__mark")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc, text``: a null text is an empty one, a null id counts as the smallest."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("doc"), F.coalesce("text", F.lit("")).alias("text")
    )


def fingerprints(docs: DataFrame, k: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``doc_id, fingerprint``: kept hashes and places (see ``with_fingerprint``) of each whole text.

    One row for each row of the input, equal rows included; other columns are ignored; no shuffle.
    """
    kept = with_fingerprint(keyed(docs), "text", "kept", k, window)
    return kept.select(F.expr(f"nullif(doc, {_NO_ID}L)").alias("doc_id"), F.col("kept").alias("fingerprint"))


def compared_with_edits(docs: DataFrame, k: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of each text and of an edited one whose last half is the start of the next document's text.

    ``doc_id, n_chars, edited, kept, edited_kept, near_edited, near_next``. The text moves once, with its kept hashes,
    to the task that holds the next document. With one document, the next one is itself.
    """
    known = with_next(with_fingerprint(keyed(docs), "text", "kept", k, window), "text", "kept")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = known.select("doc", n.cast("bigint").alias("n_chars"), "kept", "next_kept", edited.alias("edited"))
    rows = with_fingerprint(rows, "edited", "edited_kept", k, window)
    rows = rows.select(
        "*", hashes("kept").alias("__a"), hashes("edited_kept").alias("__b"), hashes("next_kept").alias("__c")
    )
    return rows.select(
        F.expr(f"nullif(doc, {_NO_ID}L)").alias("doc_id"), "n_chars", "edited", "kept", "edited_kept",
        likeness("__a", "__b").alias("near_edited"), likeness("__a", "__c").alias("near_next"),
    )

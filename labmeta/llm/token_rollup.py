"""Token counts as delta-maintained rollups.

A batch of changes (inserts, revisions, deletes of documents) becomes signed rows: what a document counted before is
taken off, what it counts now is added. Signed rows are summed per source, language and tokenizer version before
they are stored, so totals are sums of small batch folders and no document is counted again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labmeta.llm.batches import commit, committed

GROUP = ("source", "lang", "version")
COUNTS = ("n_docs", "n_tokens", "n_chars")
TOTALS = "source string, lang string, version string, n_docs bigint, n_tokens bigint, n_chars bigint"
STATES = f"doc_id bigint, {TOTALS}, batch bigint, live boolean"


def word_tokens(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("bigint")


def piece_tokens(text: Column) -> Column:
    """ASCII letter runs, single digits, and runs of anything else but white space."""
    return F.regexp_count(text, F.lit(r"[A-Za-z]+|[0-9]|[^A-Za-z0-9\x20\x09-\x0D]+")).cast("bigint")


VERSIONS: dict[str, Callable[[Column], Column]] = {"words-1": word_tokens, "pieces-1": piece_tokens}


def counted(docs: DataFrame, versions: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """``doc_id, source, lang, text`` (its hash), ``n_chars`` and a column of token counts for each version; a null text
    counts 0. Counting comes before any shuffle, so texts are never moved."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "source", "lang", F.xxhash64(text).alias("text"),
        F.char_length(text).cast("bigint").alias("n_chars"), *[f(text).alias(v) for v, f in (versions or VERSIONS).items()],
    )


@dataclass
class Rollup:
    """Batches below ``root``: ``totals/<batch>`` (signed sums) and ``states/<batch>`` (what each changed document counts now).

    A batch is applied against the batches before it, written under its own number, states first, and then committed below
    ``root``. Applying it again writes the same rows to the same place, so a retry after a failure, or a repeated delivery,
    changes nothing. A new object over the same folder, as after a restart, knows all batches that were committed.
    """

    spark: SparkSession
    root: str
    batches: tuple[int, ...] | None = None

    def __post_init__(self):
        if self.batches is None:
            self.batches = tuple(sorted(int(b) for b in committed(self.spark, self.root)))

    def _read(self, kind: str, schema: str, batches: tuple[int, ...]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{kind}/{b}" for b in batches])

    def states(self, before: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """What each document and version counts, after all batches or those before one; of ``keys`` (``_id, _v``) only,
        which are picked before earlier states of a document are told from later ones."""
        own = tuple(b for b in self.batches if before is None or b < before)
        latest = Window.partitionBy("doc_id", "version").orderBy(F.desc("batch"))
        rows = self._read("states", STATES, own)
        if keys is not None:
            rows = rows.join(keys, (F.col("doc_id") == F.col("_id")) & (F.col("version") == F.col("_v")), "left_semi")
        if len(own) > 1:
            rows = rows.withColumn("_n", F.rank().over(latest)).filter("_n = 1").drop("_n")
        return rows.filter("live").drop("batch", "live")

    def apply(self, batch: int, changes: DataFrame, versions: Sequence[str] | None = None) -> Rollup:
        """Apply ``changes``, rows of ``counted`` with ``op`` (``upsert`` or ``delete``).

        An upsert of a known document is a revision; a delete of an unknown one changes nothing; a null text counts 0. Of
        rows that share an id in one batch, all count together as what the id counts now; a delete among them wins. Null sources and languages are
        groups of their own.

        Rows without an id are documents of their own that no later row can name: each upsert adds to the totals, without a
        state, and a delete of them changes nothing.
        """
        versions = [c for c in changes.columns if c in (versions or VERSIONS)]
        deleted = F.col("op") == "delete"
        counted = changes.filter("doc_id is not null").withColumn("_d", F.max(deleted).over(Window.partitionBy("doc_id")))
        counted = counted.filter(deleted | ~F.col("_d"))
        per = F.explode(F.array(*[F.struct(F.lit(v).alias("version"), F.col(f"`{v}`").alias("n_tokens")) for v in versions]))
        measures = ("source", "lang", "v.version", F.lit(1).cast("bigint").alias("n_docs"), "v.n_tokens", "n_chars")
        nameless = changes.filter("doc_id is null and op <> 'delete'").withColumn("v", per).select(*measures)
        now = counted.withColumn("v", per).select("doc_id", *measures, (~deleted).alias("live"))
        now = now.groupBy("doc_id", *GROUP, "live").agg(*[F.sum(c).alias(c) for c in COUNTS]).select(
            "doc_id", *GROUP, *COUNTS, F.lit(batch).cast("bigint").alias("batch"), "live"
        )
        now.write.mode("overwrite").parquet(f"{self.root}/states/{batch}")
        now = self._read("states", STATES, (batch,))
        keys = now.select(F.col("doc_id").alias("_id"), F.col("version").alias("_v"))
        gone = self.states(batch, keys)
        added = now.filter("live").select(*GROUP, *COUNTS)
        taken = gone.select(*GROUP, *[(-F.col(c)).alias(c) for c in COUNTS])
        sums = added.unionByName(taken).unionByName(nameless).groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in COUNTS])
        sums.write.mode("overwrite").parquet(f"{self.root}/totals/{batch}")
        commit(self.spark, self.root, str(batch))
        return Rollup(self.spark, self.root, tuple(sorted({*self.batches, batch})))

    def totals(self) -> DataFrame:
        """``source, lang, version, n_docs, n_tokens, n_chars`` of all live documents; groups without one are left out."""
        rows = self._read("totals", TOTALS, self.batches)
        return rows.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in COUNTS]).filter("n_docs > 0")

"""Secret scans over an incremental blob ledger.

Every version of a text is addressed by its content. The ledger holds which blobs were scanned under which rule
version, and what was found. A scan reads only blobs that the rule version has not seen, each once, however many paths
or versions hold it; findings are then joined back to all paths.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmeta.llm.batches import commit, committed
from labmeta.llm.held import lean

#: Kinds in the order in which spans of one start are listed. Group 2 of the first must have 8 characters or more.
KINDS = ("assign", "access", "hex")
MORE_KINDS = ("pem",)
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/= \t\r\n]+-----END [A-Z ]*PRIVATE KEY-----")
_NAMES = (b"passw", b"secret", b"token", b"apikey", b"api_key")
RULES = "2"


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` by start, then kind as listed, in code points.

    Patterns that take a minimum directly find what the open-ended pattern finds, since those runs cannot overlap.
    """
    found = []
    raw = text.encode().lower()
    if any(n in raw for n in _NAMES):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    if "-----BEGIN " in text:
        found += [(m.start(), m.end(), "pem") for m in _PEM.finditer(text)]
    order = (*KINDS, *MORE_KINDS)
    return sorted(found, key=lambda s: (s[0], order.index(s[2]), s[1]))


_FOUND = "array<struct<start: int, end: int, kind: string>>"


@lean
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    for batch in batches:
        found = [
            [{"start": s, "end": e, "kind": k} for s, e, k in find_spans(t.as_py() or "")] for t in batch.column("text")
        ]
        yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(found, spans)], ["blob", "found"])


LEDGER = f"blob string, rules string, found {_FOUND}"


@dataclass
class Ledger:
    """Scanned ``(blob, rule version)`` pairs with their findings, as Parquet folders below ``root``, one for each batch.

    A batch is written whole under its own name, then committed below ``root``; only committed batches are read. One that
    was cut off is made good by repeating it. A new object over the same folder, as after a restart, knows all that were committed.
    """

    spark: SparkSession
    root: str
    batches: tuple[str, ...] | None = None

    def __post_init__(self):
        if self.batches is None:
            self.batches = committed(self.spark, self.root)

    def read(self, rules: str) -> DataFrame:
        if not self.batches:
            return self.spark.createDataFrame([], LEDGER)
        paths = [f"{self.root}/{b}" for b in self.batches]
        return self.spark.read.schema(LEDGER).parquet(*paths).filter(F.col("rules") == rules)

    def scan(self, batch: str, versions: DataFrame, rules: str = RULES) -> Ledger:
        """Scan what ``versions`` (``path, blob, text``) holds that this rule version has not seen; returns the new ledger.

        Distinct blobs are found on their addresses alone, and each is scanned at the smallest path that holds it, so
        a text with very many copies is never gathered anywhere. Texts move once, to the join with that list.
        """
        known = self.read(rules).select("blob").distinct() if batch not in self.batches else None
        if known is None:
            return self
        names = versions.select("blob", "path")
        at = names.groupBy("blob").agg(F.min("path").alias("path")).join(known, "blob", "left_anti")
        texts = versions.select("path", "blob", "text").join(
            at.select("path", F.col("blob").alias("_blob")), "path", "inner"
        ).filter(F.col("blob") == F.col("_blob"))
        found = texts.select("blob", "text").mapInArrow(_scan, f"blob string, found {_FOUND}")
        # rows of one path and text
        found = found.dropDuplicates(["blob"]).select("blob", F.lit(rules).alias("rules"), "found")
        found.write.mode("overwrite").parquet(f"{self.root}/{batch}")
        commit(self.spark, self.root, batch)
        return Ledger(self.spark, self.root, (*self.batches, batch))


def addressed(docs: DataFrame) -> DataFrame:
    """``path, blob, text``: a null text is the empty one, a null id is a path of its own."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("path"), F.sha2(text, 256).alias("blob"),
        text.alias("text"),
    )


def secrets_of(docs: DataFrame, root: str, rules: str = RULES, ledger: Ledger | None = None) -> DataFrame:
    """``doc_id, found``: one row for each row of ``docs``, with the spans of its text (an empty list without any).

    Only blobs that the ledger lacks are scanned. Repeated rows share a blob and each get its findings; other columns of
    the input are ignored; an empty table gives no rows.
    """
    ledger = ledger or Ledger(docs.sparkSession, root)
    versions = addressed(docs)
    ledger = ledger.scan(f"batch-{len(ledger.batches)}", versions, rules)
    findings = ledger.read(rules).filter(F.size("found") > 0).select("blob", "found").dropDuplicates(["blob"])
    return versions.select("path", "blob").join(findings, "blob", "left").select(
        F.expr(f"nullif(path, {-(1 << 63)}L)").alias("doc_id"),
        F.coalesce("found", F.expr(f"cast(array() as {_FOUND})")).alias("found"),
    )


MASK = "[SECRET]"


def mask(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by ``MASK``."""
    out, last = [], 0
    for start, end in sorted(spans):
        if start >= last:
            out += [text[last:start], MASK]
        last = max(last, end)
    return "".join(out) + text[last:]


@lean
def _masker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            mask(text, [(s["start"], s["end"]) for s in found]) if found else text
            for text, found in zip(batch.column("text").to_pylist(), batch.column("_found").to_pylist(), strict=True)
        ]
        names = [n for n in batch.schema.names if n != "_found"]
        columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays(columns, names)


def masked(docs: DataFrame, root: str, rules: str = RULES, ledger: Ledger | None = None) -> DataFrame:
    """``docs`` with all secrets in ``text`` masked. Other columns and rows without secrets stay as they are."""
    ledger = ledger or Ledger(docs.sparkSession, root)
    ledger = ledger.scan(f"batch-{len(ledger.batches)}", addressed(docs), rules)
    findings = ledger.read(rules).filter(F.size("found") > 0).dropDuplicates(["blob"])
    findings = findings.select(F.col("blob").alias("_blob"), F.col("found").alias("_found"))
    joined = docs.join(findings, F.sha2(F.coalesce(F.col("text"), F.lit("")), 256) == F.col("_blob"), "left").drop("_blob")
    return joined.mapInArrow(_masker, docs.schema)

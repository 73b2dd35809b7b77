"""Warehouse → resource table: changed rows, documents, create or update, load log, deprecation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeta.functions.text import comparable_json
from labmeta.operators.enrich import answered_headers, distinct_uris
from labmeta.operators.align import require_present
from labmeta.operators.graph import apply_upsert, deprecate, has_type, vanished
from labmeta.operators.linked import DOCUMENT_TYPES, Linking, link_rows
from labmeta.schemas import TABLES
from labmeta.sources.tables import SENT, SENT_SCHEMA, Warehouse

# Parents before children.
SYNC_ORDER = (
    "research_study", "research_subject", "session", "device", "acquisition", "acquisition_object",
    "questionnaire_list", "questionnaire_item_list", "questionnaire", "questionnaire_response_list",
    "questionnaire_response",
)


def row_digest(df: DataFrame, documents: Sequence[str] = ()) -> Column:
    """A digest of all columns of a row; of ``documents`` neither spacing nor the order of keys counts."""
    columns = [comparable_json(F.col(c)).alias(c) if c in documents else F.col(c) for c in df.columns]
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def changed_between(wh: Warehouse, name: str, old: int, new: int) -> DataFrame:
    """Rows of version ``new`` that are not the same in version ``old``, by URI and digest.

    Only partitions whose files differ are read. No time is compared, so rows that were published late with an early
    time are found, and a row that was written again as it was is not.
    """
    uri, documents = TABLES[name].uri, TABLES[name].documents
    before, after = (wh.manifest(name, v) for v in (old, new))
    parts = {p for p in after if after[p] != before.get(p)}
    rows = wh.read(name, new, parts)
    if not any(p in before for p in parts):
        return rows
    stored = wh.read(name, old, parts)
    known = stored.select(F.col(uri).alias("_uri"), row_digest(stored, documents).alias("_digest"))
    return rows.join(known, (F.col(uri) == F.col("_uri")) & (row_digest(rows, documents) == F.col("_digest")), "left_anti")


def sent_versions(wh: Warehouse) -> dict[str, int]:
    """The version of each table that the resources were last made from; one row a table and sync."""
    return {r["table"]: r["version"] for r in wh.read(SENT).groupBy("table").agg(F.max("version").alias("version")).collect()}


def changed_rows(wh: Warehouse, name: str, old: int, new: int) -> DataFrame:
    """Rows of ``name`` to send: those that changed between two versions and can be a resource."""
    table = TABLES[name]
    changed = changed_between(wh, name, old, new)
    if name == "acquisition_object":
        return require_present(changed, "dicom_header", "non_dicom_header", any_of=True)
    if name == "questionnaire_response_list":
        # A header counts once it has an answer, which may come after the header's own change was sent.
        unsent = wh.read(name, new).join(
            wh.read("resources").select(F.col("resource_uri").alias(table.uri)), table.uri, "left_anti"
        )
        return answered_headers(changed.unionByName(unsent).distinct(), wh.read("questionnaire_response"))
    return require_present(changed, table.uri)


def sync_resources(wh: Warehouse, linking: Linking = Linking()) -> DataFrame:
    """Send all rows that changed since the last sync in one upsert, then log the versions sent and, by type, the newest update.

    Only partitions of the resource table that a document falls into are read and written. If the upsert fails nothing is
    logged, and the next run sends the same rows again.
    """
    sent = sent_versions(wh)
    versions = {t: wh.version(t) for t in SYNC_ORDER}
    moved = [t for t in SYNC_ORDER if versions[t] > sent.get(t, 0)]
    if versions["questionnaire_response"] > sent.get("questionnaire_response", 0) and "questionnaire_response_list" not in moved:
        moved.append("questionnaire_response_list")
    if not moved:
        return wh.read("resources")
    frames = [link_rows(changed_rows(wh, t, sent.get(t, 0), versions[t]), t, TABLES[t].uri, linking) for t in moved]
    documents = wh.staged(reduce(DataFrame.unionByName, frames))
    base = wh.version("resources")
    parts = wh.parts_of("resources", documents)
    resources = wh.read("resources", base)
    if parts:
        merged = apply_upsert(documents, wh.read("resources", base, parts))
        resources = wh.publish("resources", merged, key=("resource_uri",), parts=parts, base=base)
    marks = reduce(
        DataFrame.unionByName,
        [
            wh.read(t, versions[t])
            .agg(F.max("_updatedat").alias("last_success_load_ts"))
            .select(F.lit(TABLES[t].resource_type).alias("resource_type"), "last_success_load_ts")
            for t in moved
        ],
    ).filter("last_success_load_ts is not null")
    wh.append("load_log", marks)
    wh.append(SENT, wh.spark.createDataFrame([(t, versions[t]) for t in moved], SENT_SCHEMA))
    return resources


def deprecate_vanished(wh: Warehouse) -> DataFrame:
    """One pass over all managed types: resources whose URI left the warehouse become deprecated. Only partitions that
    hold such a resource are written."""
    live = reduce(DataFrame.unionByName, [distinct_uris(wh.read(t), TABLES[t].uri) for t in SYNC_ORDER])
    managed = reduce(
        lambda a, b: a | b, [has_type(TABLES[t].resource_type, TABLES[t].type_regex) for t in SYNC_ORDER]
    )
    base = wh.version("resources")
    parts = wh.parts_of("resources", vanished(wh.read("resources", base).filter(managed), live))
    if not parts:
        return wh.read("resources", base)
    merged = deprecate(wh.read("resources", base, parts), live, managed)
    return wh.publish("resources", merged, key=("resource_uri",), parts=parts, base=base)


assert set(SYNC_ORDER) == set(DOCUMENT_TYPES)

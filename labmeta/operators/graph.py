"""Resource table: create or update, deprecate, type filters and reachability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Frames of ``reachable`` that are read one by one before they are written as one.
_FRAMES = 4
RESOURCE_SCHEMA = "resource_uri string, resource_types array<string>, body string, _rev int, deprecated boolean"


def empty_resources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RESOURCE_SCHEMA)


def plan_upsert(documents: DataFrame, resources: DataFrame) -> DataFrame:
    """``CREATE`` for unknown URIs, ``UPDATE`` at the stored revision for known ones, with the new revision."""
    stored = resources.select(F.col("resource_uri").alias("_uri"), F.col("_rev").alias("_stored_rev"))
    known = F.col("_stored_rev").isNotNull()
    return (
        documents.join(stored, F.col("resource_uri") == F.col("_uri"), "left")
        .withColumns(
            {
                "action": F.when(known, F.lit("UPDATE")).otherwise(F.lit("CREATE")),
                "new_rev": F.coalesce(F.col("_stored_rev") + 1, F.lit(1)).cast("int"),
            }
        )
        .drop("_uri")
    )


def apply_upsert(documents: DataFrame, resources: DataFrame) -> DataFrame:
    """Next state of the resource table; resources without a new document stay as they are, a deprecated one that is sent
    again is live again."""
    new = documents.select(
        F.col("resource_uri").alias("_uri"), F.col("resource_types").alias("_types"), F.col("body").alias("_body")
    )
    changed = F.col("_uri").isNotNull()
    return resources.join(new, F.col("resource_uri") == F.col("_uri"), "full").select(
        F.coalesce("_uri", "resource_uri").alias("resource_uri"),
        F.when(changed, F.col("_types")).otherwise(F.col("resource_types")).alias("resource_types"),
        F.when(changed, F.col("_body")).otherwise(F.col("body")).alias("body"),
        F.when(F.col("resource_uri").isNull(), F.lit(1))
        .when(changed, F.col("_rev") + 1)
        .otherwise(F.col("_rev"))
        .cast("int")
        .alias("_rev"),
        F.when(changed, F.lit(False)).otherwise(F.coalesce("deprecated", F.lit(False))).alias("deprecated"),
    )


def has_type(name: str, regex: bool = False) -> Column:
    """Exact resource type, or a case-insensitive pattern over the types."""
    if regex:
        return F.exists("resource_types", lambda t: t.rlike(f"(?i){name}"))
    return F.array_contains("resource_types", name)


def of_type(resources: DataFrame, name: str, regex: bool = False) -> DataFrame:
    return resources.filter(has_type(name, regex))


def not_deprecated(df: DataFrame, resources: DataFrame | None = None, uri: str = "resource_uri") -> DataFrame:
    """Without ``resources``: rows flagged as live. With it: rows whose URI is a live resource; a row that is no resource
    yet is not one."""
    if resources is None:
        return df.filter(~F.coalesce(F.col("deprecated"), F.lit(False)))
    live = not_deprecated(resources).select(F.col("resource_uri").alias("_live"))
    return df.join(live, F.col(uri) == F.col("_live"), "left_semi")


def vanished(resources: DataFrame, live_uris: DataFrame) -> DataFrame:
    """Live resources whose URI is no longer in the warehouse."""
    return not_deprecated(resources).join(live_uris.select("resource_uri"), "resource_uri", "left_anti")


def deprecate(resources: DataFrame, live_uris: DataFrame, in_scope: Column | None = None) -> DataFrame:
    """Set ``deprecated`` on vanished resources, optionally only on those that match ``in_scope``."""
    live = live_uris.select(F.col("resource_uri").alias("_live")).distinct()
    gone = F.col("_live").isNull()
    if in_scope is not None:
        gone = gone & in_scope
    flags = F.coalesce(F.col("deprecated"), F.lit(False)) | gone
    return resources.join(live, F.col("resource_uri") == F.col("_live"), "left").select(
        *[flags.alias(c) if c == "deprecated" else F.col(c) for c in resources.columns]
    )


def reachable(edges: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """All (root, node) pairs joined by one or more edges (columns ``s`` and ``o``).

    Each round extends only the pairs found in the round before. Every round is checkpointed in the shared
    folder, so a lost executor costs one round and the plan does not grow; so is what was found, after every ``_FRAMES``
    rounds, so that not many frames are read again. Cycles end by themselves. Give ``roots``: all pairs grow with the square
    of a chain. For items with an index path use ``reachable_items``.
    """
    steps = edges.select(F.col("s").alias("_s"), F.col("o").alias("_o")).distinct()
    start = steps if roots is None else steps.join(
        roots.select(F.col(roots.columns[0]).alias("_root")).distinct(), F.col("_s") == F.col("_root"), "left_semi"
    )
    frontier = start.select(F.col("_s").alias("root"), F.col("_o").alias("node")).checkpoint()
    found, frames = frontier, 1
    while not frontier.isEmpty():
        longer = frontier.join(steps, F.col("node") == F.col("_s")).select("root", F.col("_o").alias("node")).distinct()
        frontier = longer.join(found, ["root", "node"], "left_anti").checkpoint()
        found, frames = found.unionByName(frontier), frames + 1
        if frames == _FRAMES:
            found, frames = found.checkpoint(), 1
    return found


def index_prefixes(index: Column) -> Column:
    """The paths above an index path, nearest last: ``0.2.1`` has ``0`` and ``0.2``. A path of one part has none."""
    parts = F.split(index, "\\.")
    return F.transform(
        F.slice(F.sequence(F.lit(0), F.size(parts)), 2, F.size(parts) - 1),
        lambda n: F.array_join(F.slice(parts, 1, n), "."),
    )


def reachable_items(items: DataFrame, response: str, item: str, index: str) -> DataFrame:
    """(root, node) pairs of nested items: each response or item with every item below it.

    The index path holds an item's ancestors, so nothing is iterated. A response reaches each of its items as it stands; an
    item explodes the paths above its own and meets the items at these in one join, on response and path, so the items of one
    large response spread. Rows without a response, item or index are in no pair; items that share a path both reach what
    is below it.
    """
    rows = items.select(F.col(response).alias("_response"), F.col(item).alias("node"), F.col(index).alias("_index")).dropna()
    above = rows.select("_response", "node", F.explode(index_prefixes(F.col("_index"))).alias("_above"))
    owner = rows.select(F.col("_response").alias("_owner_response"), F.col("_index").alias("_owner_index"), F.col("node").alias("root"))
    nested = above.join(owner, (F.col("_response") == F.col("_owner_response")) & (F.col("_above") == F.col("_owner_index")))
    return rows.select(F.col("_response").alias("root"), "node").unionByName(nested.select("root", "node")).distinct()

"""Newly landed rows → delta → next snapshot, once per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from labmeta.plans.loaders import load_table
from labmeta.schemas import TABLES
from labmeta.sources.tables import Warehouse


def ingest_stream(
    wh: Warehouse,
    name: str,
    landed: DataFrame,
    proc_dt: Callable[[int], str],
    checkpoint: str,
    scope_columns: Sequence[str] | None = None,
) -> StreamingQuery:
    """Process all files landed since the last run, then stop.

    Rows of a batch are inserted or updated by key, and all other stored rows stay. With ``scope_columns`` each batch
    must hold the complete current rows of the scopes (such as studies) it mentions: what a scope lacks is deleted.
    A batch replayed after a failure finds its own rows stored and changes nothing, so the load is effectively
    exactly-once.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        scope = batch.select(*(scope_columns or TABLES[name].key)).distinct()
        load_table(wh, name, batch, proc_dt(batch_id), scope=scope)

    return (
        landed.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

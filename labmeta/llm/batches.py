"""Which batches below a folder are complete, so that a restart, or another object over the same folder, knows them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def committed(spark: SparkSession, root: str) -> tuple[str, ...]:
    """The names of all complete batches, one small row each; none if there is no batch yet."""
    try:
        rows = spark.read.schema("batch string").parquet(f"{root}/commits").distinct().collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return ()
    return tuple(sorted(r["batch"] for r in rows))


def commit(spark: SparkSession, root: str, batch: str) -> None:
    """Note that a batch is written. Once more for the same batch changes nothing."""
    spark.createDataFrame([(batch,)], "batch string").coalesce(1).write.mode("append").parquet(f"{root}/commits")

"""Documents to packed training sequences: quality, near-duplicates, benchmark leaks, secrets, packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labmeta.llm import decontam, line_crf, near_dedup, packing, secret_scan
from labmeta.llm.queries import ACCEPTED, quality_weights, tokenizer
from labmeta.llm.registry import table
from labmeta.sources.tables import shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _row_key(text: Column) -> list[Column]:
    """A document's id as text (a null id counts as one) and the hash of its text: ids repeat, or are missing."""
    return [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), text.alias("_text")]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model accepts."""
    scored = line_crf.with_quality(docs.select(*COLUMNS), quality_weights(spark, sf_dir, docs))
    return scored.filter(F.col("score") >= ACCEPTED).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id; of equal rows, one."""
    kept = near_dedup.near_duplicates(docs, size=5, num=80, den=100, with_hash=True).filter("kept")
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    joined = docs.select(*COLUMNS, *_row_key(text)).join(kept.select(*_row_key(F.col("text_hash"))).distinct(), ["_id", "_text"], "left_semi")
    # Rows are partitioned by both keys for the join, so finding equal ones moves no text again.
    return joined.dropDuplicates(["_id", "_text"]).select(*COLUMNS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; of rows that share an id or have none, only those that hold one go."""
    text = F.sha2(F.col("text"), 256)
    found = decontam.leaks(docs.withColumn("text_hash", text), table(spark, sf_dir, "benchmark"), keep=("text_hash",))
    leaking = found.select(*_row_key(F.col("text_hash"))).distinct()
    keyed = docs.select(*COLUMNS, *_row_key(F.coalesce(text, F.lit(""))))
    return keyed.join(leaking, ["_id", "_text"], "left_anti").select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets masked in their texts, and their new number of characters."""
    return secret_scan.masked(docs.select(*COLUMNS), shared_folder(spark)).withColumn(
        "n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's ids in the training sequences."""
    return packing.pack_documents(docs, tokenizer(), packing.CAPACITY, F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("benchmark_leaks", benchmark_leaks), ("secrets", secrets),
    ("packed", packed),
]
#: The stages hold learned weights, approximate search and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

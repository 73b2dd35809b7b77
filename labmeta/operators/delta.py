"""Incremental load: classify each key, give new rows a URI, keep revisions, replace a scope."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeta.functions.keys import DELIMITER, random_uri, surrogate_uri
from labmeta.functions.text import comparable_json
from labmeta.schemas import AUDIT, OPTION_TYPES

INSERT, UPDATE, DELETE, NOCHANGE = "INSERT", "UPDATE", "DELETE", "NOCHANGE"


class DuplicateKeyError(ValueError):
    pass


def match_keys(df: DataFrame, other: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on ``columns`` where nulls match each other."""
    side = other.select([F.col(c).alias(f"_match_{c}") for c in columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_match_{c}")) for c in columns])
    return df.join(side, same, how)


def duplicate_groups(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row. Counted before the shuffle, so a hot key stays small."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def assert_unique_key(df: DataFrame, key: Sequence[str], shown: int = 20) -> None:
    """Only hashes of keys are shuffled; keys themselves are compared if a hash comes twice."""
    if not duplicate_groups(df.select(F.xxhash64(*key).alias("_hash")), ["_hash"]).limit(1).collect():
        return
    found = duplicate_groups(df, key).limit(shown).collect()
    if found:
        raise DuplicateKeyError(f"duplicate keys {tuple(key)}: {[tuple(r) for r in found]}")


def drop_all_copies(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key appears once (nulls match each other): one aggregate, no window.

    A key that appears once has one value per column, so ``first`` returns that row.
    """
    rest = [c for c in df.columns if c not in key]
    counted = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.first(c).alias(c) for c in rest]
    )
    return counted.filter("_copies = 1").select(*df.columns)


def keep_copies(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key appears more than once."""
    return match_keys(df, duplicate_groups(df, key), key, "left_semi")


def classify_delta(
    prev: DataFrame,
    curr: DataFrame,
    key: Sequence[str],
    uri: str,
    derived: Sequence[str] = (),
    wide: Sequence[str] = (),
    check: bool = True,
    documents: Sequence[str] = (),
) -> DataFrame:
    """Label every key ``INSERT``, ``UPDATE``, ``DELETE`` or ``NOCHANGE``.

    One full join on null-safe keys. ``prev`` carries ``uri`` and the audit columns; they come from it
    whenever the key was known. Value columns come from ``curr`` (null for ``DELETE``). ``derived``
    columns are not compared. ``wide`` text columns of ``prev`` are compared by SHA-256, so the stored
    text itself is not shuffled. ``documents`` are JSON texts, compared (by SHA-256, too) without regard to spacing and the
    order of keys; a row without a change takes the text of ``curr``. ``check`` raises on a duplicate key on either side; the check reads and
    shuffles key columns only. A caller that publishes through ``Warehouse.publish`` may turn it off,
    because the publish step checks the written rows.
    """
    key = list(key)
    kept = [uri, *AUDIT]
    values = [c for c in prev.columns if c not in key and c not in kept and c not in derived]
    missing = [c for c in [*key, *values] if c not in curr.columns]
    if missing:
        raise ValueError(f"new rows lack the columns {missing}")
    if check:
        sides = prev.select(F.lit("prev").alias("_side"), *key).unionByName(
            curr.select(F.lit("curr").alias("_side"), *key)
        )
        assert_unique_key(sides, ["_side", *key])

    def compared(c: str) -> Column:
        text = comparable_json(F.col(c)) if c in documents else F.col(c)
        return F.sha2(text, 256) if c in wide or c in documents else text

    old = prev.select(
        *[F.col(c).alias(f"_prev_{i}") for i, c in enumerate(key)],
        *[compared(c).alias(f"_old_{c}") for c in values],
        *[F.col(c).alias(f"_kept_{c}") for c in [*kept, *derived]],
        F.lit(True).alias("_in_prev"),
    )
    new = curr.select(
        *key,
        *values,
        *[(F.col(c) if c in curr.columns else F.lit(None)).alias(c) for c in derived],
        F.lit(True).alias("_in_curr"),
    )
    same_key = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_prev_{i}")) for i, c in enumerate(key)])
    same_values = F.lit(True)
    for c in values:
        same_values = same_values & compared(c).eqNullSafe(F.col(f"_old_{c}"))
    in_prev, in_curr = F.col("_in_prev").isNotNull(), F.col("_in_curr").isNotNull()
    action = (
        F.when(~in_prev, INSERT).when(~in_curr, DELETE).when(same_values, NOCHANGE).otherwise(UPDATE)
    )
    out = {c: F.when(in_curr, F.col(c)).otherwise(F.col(f"_prev_{i}")) for i, c in enumerate(key)}
    out.update({c: F.col(c) for c in values})
    out.update({c: F.col(f"_kept_{c}") for c in kept})
    out.update({c: F.when(in_prev & in_curr & same_values, F.col(f"_kept_{c}")).otherwise(F.col(c)) for c in derived})
    return new.join(old, same_key, "full").select(
        *[out[c].alias(c) for c in prev.columns], action.alias("delta_action")
    )


def apply_delta(
    delta: DataFrame,
    proc_dt: str | Column,
    uri: str,
    base: str,
    salt_columns: Sequence[str] = (),
    salt: str = "",
    delimiter: str = DELIMITER,
    generate: bool = True,
    uri_when: Column | None = None,
) -> DataFrame:
    """Rows to store: inserts get audit values and a URI, updates a new revision, deletes are left out.

    With no ``salt_columns`` the URI is random. ``uri_when`` limits which inserted rows get one.
    """
    now = proc_dt if isinstance(proc_dt, Column) else F.to_timestamp_ntz(F.lit(proc_dt))
    action = F.col("delta_action")
    inserted = action == INSERT
    if generate:
        fresh = surrogate_uri(base, salt_columns, salt, delimiter) if salt_columns else random_uri(base)
        wants_uri = inserted if uri_when is None else inserted & F.coalesce(uri_when, F.lit(False))
        uri_value = F.when(wants_uri, fresh).otherwise(F.col(uri))
    else:
        uri_value = F.col(uri)
    computed = {
        uri: uri_value,
        "_createdat": F.when(inserted, now).otherwise(F.col("_createdat")),
        "_updatedat": F.when(action.isin(INSERT, UPDATE), now).otherwise(F.col("_updatedat")),
        "_rev": F.when(inserted, F.lit(1))
        .when(action == UPDATE, F.col("_rev") + 1)
        .otherwise(F.col("_rev"))
        .cast("int"),
    }
    return delta.filter(action != DELETE).select(
        *[computed[c].alias(c) if c in computed else F.col(c) for c in delta.columns if c != "delta_action"]
    )


def is_option_type(question_type: Column | None = None) -> Column:
    """True for question types whose options are resources of their own."""
    c = F.col("question_type") if question_type is None else question_type
    return c.isin(*OPTION_TYPES)


def replace_scope(target: DataFrame, load: DataFrame, scope: Column | DataFrame) -> DataFrame:
    """``target`` without the rows in scope, plus ``load`` (which may be empty).

    ``scope`` is a predicate on ``target``, or a frame of key values whose rows are replaced.
    """
    if isinstance(scope, DataFrame):
        outside = match_keys(target, scope, scope.columns, "left_anti")
    else:
        outside = target.filter(~F.coalesce(scope, F.lit(False)))
    return outside.unionByName(load)

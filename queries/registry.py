"""Registry and SQL building blocks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labmeta.operators.answers import Naming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

NAMING = Naming("urn:lab:", "pepper")
PROC_DT = "2024-06-01 00:00:00"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ts(text: str) -> Column:
    return F.to_timestamp_ntz(F.lit(text))


def uri_sql(*parts: str, base: str = "urn:lab:", salt: str = "pepper") -> str:
    """SQL of a surrogate URI over the given SQL expressions."""
    escaped = [
        rf"replace(replace(coalesce(cast({p} as varchar), ''), '\', '\\'), '|', '\|')" for p in parts
    ]
    seed = f"concat_ws('|', {', '.join(escaped)}, '{salt}')"
    shape = r"'^(.{8})(.{4}).(.{3}).(.{3})(.{12}).*$', '\1-\2-4\3-8\4-\5'"
    return f"('{base}' || regexp_replace(sha256({seed}), {shape}))"


def classify_sql(prev: str, curr: str, key: Sequence[str], values: Sequence[str], uri: str) -> str:
    """SQL of a delta: ``prev`` and ``curr`` are SELECTs."""
    on = " and ".join(f"c.{k} is not distinct from p.{k}" for k in key)
    same = " and ".join(f"c.{v} is not distinct from p.{v}" for v in values)
    keys = ", ".join(f"case when c.is_curr then c.{k} else p.{k} end as {k}" for k in key)
    vals = ", ".join(f"c.{v} as {v}" for v in values)
    return f"""
      with p as (select *, true as is_prev from ({prev})), c as (select *, true as is_curr from ({curr}))
      select {keys}, {vals}, p.{uri} as {uri}, p._createdat as _createdat, p._updatedat as _updatedat, p._rev as _rev,
        case when p.is_prev is null then 'INSERT' when c.is_curr is null then 'DELETE'
             when {same} then 'NOCHANGE' else 'UPDATE' end as delta_action
      from c full join p on {on}"""


def apply_sql(classified: str, columns: Sequence[str], uri: str, new_uri: str) -> str:
    cols = ", ".join(columns)
    return f"""
      select {cols},
        case when delta_action = 'INSERT' then {new_uri} else {uri} end as {uri},
        case when delta_action = 'INSERT' then timestamp '{PROC_DT}' else _createdat end as _createdat,
        case when delta_action in ('INSERT', 'UPDATE') then timestamp '{PROC_DT}' else _updatedat end as _updatedat,
        cast(case when delta_action = 'INSERT' then 1 when delta_action = 'UPDATE' then _rev + 1 else _rev end as integer) as _rev
      from ({classified}) where delta_action <> 'DELETE'"""

"""Schema alignment, row filters and projection helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labmeta.functions.text import empty_to_null, nan_to_null
from labmeta.schemas import ID_TYPE


def cast_keep_null(c: Column, to: T.DataType | str, via_double: bool = False) -> Column:
    """Cast that keeps nulls. ``via_double`` reads decimal text such as ``3.0`` into a whole number."""
    return (c.cast("double") if via_double else c).cast(to)


def _cast_field(df: DataFrame, field: T.StructField) -> Column:
    source = df.schema[field.name].dataType
    via_double = isinstance(field.dataType, T.IntegralType) and isinstance(source, T.StringType)
    return cast_keep_null(F.col(field.name), field.dataType, via_double).alias(field.name)


def align_to_schema(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Cast the columns that ``schema`` declares; other columns pass through untouched.

    With ``strict`` the column set must equal the schema, and the result has the schema's column order.
    """
    declared = {f.name: f for f in schema}
    if strict:
        if set(df.columns) != set(declared):
            missing = sorted(set(declared) - set(df.columns))
            extra = sorted(set(df.columns) - set(declared))
            raise ValueError(f"columns differ from the declared structure: missing {missing}, extra {extra}")
        return df.select([_cast_field(df, f) for f in schema])
    return df.select([_cast_field(df, declared[c]) if c in declared else F.col(c) for c in df.columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns: cast those present, add the missing ones as null, drop the rest."""
    return df.select(
        [
            _cast_field(df, f) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def blanks_to_null(df: DataFrame, blanks: Sequence[str] = ("",), columns: Sequence[str] | None = None) -> DataFrame:
    """Blank texts become null in every string column, or in the listed ones."""
    names = {
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)
    }
    return df.select([empty_to_null(F.col(c), blanks).alias(c) if c in names else F.col(c) for c in df.columns])


def nans_to_null(df: DataFrame) -> DataFrame:
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select([nan_to_null(F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def scope_filter(
    df: DataFrame, study: str | None = None, subject: str | None = None, session: str | None = None,
    id_type: str = ID_TYPE,
) -> DataFrame:
    """Rows of one study and optionally one subject and one session."""
    df = df.filter(F.col("research_study_id_type") == id_type)
    for column, value in (
        ("research_study_id", study), ("research_subject_id", subject), ("session_id", session),
    ):
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def nonempty_docs(df: DataFrame, column: str = "xnat_custom_fields") -> DataFrame:
    """Rows whose document is present and not ``{}``."""
    return df.filter(F.col(column) != "{}")


def require_present(df: DataFrame, *columns: str, any_of: bool = False) -> DataFrame:
    """Rows where every listed column (or, with ``any_of``, at least one) is not null."""
    present = F.lit(not any_of)
    for c in columns:
        present = (present | F.col(c).isNotNull()) if any_of else (present & F.col(c).isNotNull())
    return df.filter(present)


def project(
    df: DataFrame,
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
    constants: Mapping[str, object] | None = None,
) -> DataFrame:
    """Drop, rename and add constant columns in one step; constants replace columns of the same name."""
    rename, constants = dict(rename or {}), dict(constants or {})
    kept = [
        F.col(c).alias(rename.get(c, c))
        for c in df.columns
        if c not in drop and rename.get(c, c) not in constants
    ]
    return df.select(*kept, *[F.lit(v).alias(k) for k, v in constants.items()])

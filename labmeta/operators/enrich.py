"""Lookups, set operations and small aggregates.

No join carries a broadcast hint: Spark broadcasts a side only while its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges beyond it, splitting hot keys (AQE).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeta.schemas import SESSION_SUBJECT_TYPE, SUBJECT_TYPES


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    take: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Add the ``take`` columns of ``dim``, replacing stale ones of the same name in ``df``."""
    left = df.drop(*[c for c in take if c not in on])
    right = dim.select(*[F.col(c).alias(f"_dim_{c}") if c in on else F.col(c) for c in [*on, *take]])
    same = [
        F.col(c).eqNullSafe(F.col(f"_dim_{c}")) if null_safe else F.col(c) == F.col(f"_dim_{c}") for c in on
    ]
    return left.join(right, same, how).drop(*[f"_dim_{c}" for c in on])


def lookup_study(df: DataFrame, study: DataFrame) -> DataFrame:
    return lookup(
        df, study, ["research_study_id"],
        ["research_study_uri", "research_study_title", "research_study_id_type"],
    )


def lookup_subject(df: DataFrame, subject: DataFrame) -> DataFrame:
    return lookup(df, subject, ["research_study_id", "research_subject_id"], ["research_subject_uri"])


def lookup_session(df: DataFrame, session: DataFrame) -> DataFrame:
    return lookup(df, session, ["research_study_id", "research_subject_id", "session_id"], ["session_uri"])


def lookup_device(df: DataFrame, device: DataFrame, how: str = "inner") -> DataFrame:
    """Manufacturer and name may be null and then match a device without them."""
    return lookup(df, device, ["device_manufacturer", "device_name"], ["device_uri"], how, null_safe=True)


def lookup_form(df: DataFrame, forms: DataFrame) -> DataFrame:
    """Form attributes by study, data type and form uuid."""
    return lookup(
        df, forms, ["research_study_id", "xnat_data_type", "questionnaire_uuid"],
        ["questionnaire_uri", "questionnaire_name", "questionnaire_title", "subject_type"],
    )


QUESTION_ATTRIBUTES = (
    "questionnaire_name", "questionnaire_title", "questionnaire_uri", "subject_type", "group_uri",
    "question_label", "question_type", "question_description", "questionnaire_item_uri", "required_flag",
)


def lookup_questions(df: DataFrame, questions: DataFrame) -> DataFrame:
    """The attributes of every question of a row's form, by study, data type and form uuid: one row a question. A form
    without questions has none."""
    return lookup(
        df, questions, ["research_study_id", "xnat_data_type", "questionnaire_uuid"],
        ["question_id", "group_id", *QUESTION_ATTRIBUTES],
    )


def options_to_questions(questions: DataFrame, options: DataFrame) -> DataFrame:
    """Every question with its options; a question without options keeps one row with null option columns."""
    on = ["research_study_id", "xnat_data_type", "questionnaire_uuid", "group_id", "question_id"]
    return lookup(
        questions, options, on, ["answer_option_code", "answer_option_display"], how="left", null_safe=True
    )


def subject_type_of(data_type: Column) -> Column:
    mapped = F.lit(SESSION_SUBJECT_TYPE)
    for key, value in SUBJECT_TYPES.items():
        mapped = F.when(data_type == key, F.lit(value)).otherwise(mapped)
    return mapped


def union_resource_types(study: DataFrame, subject: DataFrame, session: DataFrame) -> DataFrame:
    """Studies, subjects and sessions as answering subjects of forms."""

    def side(df: DataFrame, prefix: str, data_type: Column, cf: bool) -> DataFrame:
        return df.select(
            "research_study_id",
            data_type.alias("xnat_data_type"),
            F.col(f"{prefix}_uri").alias("response_subject_uri"),
            F.col(f"{prefix}_id").alias("response_subject_id"),
            subject_type_of(data_type).alias("response_subject_type"),
            *(["xnat_custom_fields"] if cf else []),
        )

    frames = [
        (study, "research_study", F.lit("xnat:projectData")),
        (subject, "research_subject", F.lit("xnat:subjectData")),
        (session, "session", F.col("session_type")),
    ]
    cf = all("xnat_custom_fields" in df.columns for df, _, _ in frames)
    parts = [side(df, prefix, dt, cf) for df, prefix, dt in frames]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Append frames; a column missing from one side is null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*columns).distinct() if columns else df.distinct()


def answered_headers(headers: DataFrame, answers: DataFrame) -> DataFrame:
    """Response headers that have at least one answer."""
    return headers.join(answers.select("questionnaire_response_uri"), "questionnaire_response_uri", "left_semi")


def max_scalar(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    grouped = df.groupBy(by) if by else df.groupBy()
    return grouped.agg(F.max(column).alias(f"max_{column}"))


def count_rows(**frames: DataFrame) -> DataFrame:
    """One row per named frame with its number of rows."""
    out = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def distinct_uris(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("resource_uri")).filter("resource_uri is not null").distinct()


def changed_since(df: DataFrame, log: DataFrame, resource_type: str, default: str = "1990-01-01 00:00:00") -> DataFrame:
    """Rows updated after the last logged load of ``resource_type``; an empty log selects all rows.

    The mark is a one-row aggregate read as a scalar subquery, evaluated once before the scan.
    """
    mark = log.filter(F.col("resource_type") == resource_type).agg(
        F.coalesce(F.max("last_success_load_ts"), F.to_timestamp_ntz(F.lit(default)))
    )
    return df.filter(F.col("_updatedat") > mark.scalar())

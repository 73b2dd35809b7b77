"""Cohort queries: studies, subjects, sessions and scans picked by form answers and scan headers."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmeta.functions.text import label_column
from labmeta.operators.graph import not_deprecated

# Answers of these types sit one step below the plain value.
CODED_TYPES = ("selectboxes", "xnatSelect")


def equals(c: Column, text: str) -> Column:
    return c == text


def contains(c: Column, text: str) -> Column:
    return F.contains(c, F.lit(text))


def starts_with(c: Column, text: str) -> Column:
    return F.startswith(c, F.lit(text))


def not_at_second_position(c: Column, text: str) -> Column:
    """True unless ``text`` is first found at offset 1."""
    return F.instr(c, text) != 2


def study_subject_session_scan(
    study: DataFrame,
    subject: DataFrame,
    session: DataFrame,
    scan: DataFrame,
    scan_object: DataFrame | None = None,
    described_only: bool = False,
) -> DataFrame:
    """Inner pattern study → subject → session → scan [→ scan object]."""
    sub = subject.select("research_study_uri", "research_subject_uri", F.col("research_subject_id").alias("subject_id"))
    stu = study.select("research_study_uri", F.col("research_study_id").alias("study_id"))
    ses = session.select("research_subject_uri", "session_uri", "session_id")
    acq = scan.select(
        "session_uri", "acquisition_uri", "acquisition_id", F.col("series_description").alias("acquisition_description")
    )
    if described_only:
        acq = acq.filter("acquisition_description is not null")
    out = (
        acq.join(ses, "session_uri").join(sub, "research_subject_uri").join(stu, "research_study_uri")
    )
    if scan_object is not None:
        out = out.join(
            scan_object.select("acquisition_uri", "dicom_header", "non_dicom_header"), "acquisition_uri"
        )
    return out


def any_value(include_coded: bool = False) -> Column:
    """Text of a plain answer; coded answers are null unless asked for."""
    coded = F.coalesce(F.col("question_type").isin(*CODED_TYPES), F.lit(False))
    plain = F.when(~coded, F.col("response_text"))
    return F.when(coded, F.col("response_code_display")).otherwise(plain) if include_coded else plain


def optional_answer(
    df: DataFrame,
    answers: DataFrame,
    subject: str,
    label: str,
    column: str | None = None,
    resources: DataFrame | None = None,
    include_coded: bool = False,
) -> DataFrame:
    """Add the answer to one question of the resource in ``subject``; null without one.

    Several different answers give several rows. Equal answers are made one before the join, which leaves
    the distinct result unchanged and keeps a much-repeated answer from multiplying rows.
    """
    column = column or label_column(label)
    given = answers.filter(F.col("question_label") == label)
    if resources is not None:
        given = not_deprecated(given, resources, "questionnaire_response_item_uri")
    side = (
        given.select(F.col("response_subject_uri").alias("_subject"), any_value(include_coded).alias(column))
        .filter(F.col(column).isNotNull())
        .distinct()
    )
    return df.join(side, F.col(subject) == F.col("_subject"), "left").drop("_subject")


def answers_by_subject(
    answers: DataFrame, labels: Collection[str], resources: DataFrame | None = None, include_coded: bool = False
) -> DataFrame:
    """One row for each resource with an answer to one of the questions: ``_subject`` and the distinct (label, value) pairs.

    One scan, one semi-join with the live resources, one aggregate that is combined before it is shuffled.
    """
    given = answers.filter(F.col("question_label").isin(*labels))
    if resources is not None:
        given = not_deprecated(given, resources, "questionnaire_response_item_uri")
    return (
        given.select("response_subject_uri", "question_label", any_value(include_coded).alias("_value"))
        .filter("response_subject_uri is not null and _value is not null")
        .groupBy(F.col("response_subject_uri").alias("_subject"))
        .agg(F.collect_set(F.struct(F.col("question_label").alias("label"), F.col("_value").alias("value"))).alias("_given"))
    )


def _values_of(label: str) -> Column:
    return F.transform(F.filter("_given", lambda g: g["label"] == label), lambda g: g["value"])


def optional_answers(
    df: DataFrame,
    answers: DataFrame,
    questions: Mapping[str, Sequence[str]],
    resources: DataFrame | None = None,
    include_coded: bool = False,
) -> DataFrame:
    """Add one column for each question: the answer of the resource in its subject column, or null.

    ``questions``: subject column → question labels. Several different answers give several rows, equal ones one. All
    questions are answered from one scan of the answers; subject columns share its shuffle.
    """
    side = answers_by_subject(answers, sorted({x for own in questions.values() for x in own}), resources, include_coded)
    for subject, labels in questions.items():
        df = df.join(side, F.col(subject) == F.col("_subject"), "left").drop("_subject")
        for label in labels:
            df = df.select("*", F.explode_outer(_values_of(label)).alias(label_column(label)))
        df = df.drop("_given")
    return df


def header_value(key: str) -> Column:
    """Value of one header property: from the field map, else from the DICOM dump by description."""
    fields = F.from_json("non_dicom_header", "map<string,string>")
    dump = F.from_json("dicom_header", "array<struct<tag1: string, desc: string, value: string>>")
    named = F.filter(dump, lambda e: e["desc"] == key)
    return F.coalesce(F.try_element_at(fields, F.lit(key)), F.try_element_at(named, F.lit(-1))["value"])


def select_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def bindings_to_table(results: DataFrame, variables: Sequence[str], body: str = "body") -> DataFrame:
    """Rows from query-result JSON; a variable without a binding is null. A cut-off body is an error."""
    parsed = F.from_json(body, "results struct<bindings: array<map<string, struct<value: string>>>>", {"mode": "FAILFAST"})
    rows = results.select(F.explode(parsed["results"]["bindings"]).alias("b"))
    return rows.select([F.try_element_at("b", F.lit(v))["value"].alias(v) for v in variables])

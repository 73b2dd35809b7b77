"""The four cohort queries over the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labmeta.operators.cohort import (
    contains, equals, header_value, optional_answers, select_distinct, starts_with, study_subject_session_scan,
)
from labmeta.sources.tables import Warehouse


def _pattern(wh: Warehouse, with_object: bool = False, described_only: bool = False) -> DataFrame:
    return study_subject_session_scan(
        wh.read("research_study"),
        wh.read("research_subject"),
        wh.read("session"),
        wh.read("acquisition"),
        wh.read("acquisition_object") if with_object else None,
        described_only,
    )


def _with_answers(wh: Warehouse, df: DataFrame, questions: dict[str, list[str]]) -> DataFrame:
    return optional_answers(df, wh.read("questionnaire_response"), questions, resources=wh.read("resources"))


def by_scan_name(
    wh: Warehouse, scan: str, gender: str, language: str, step: str, training: str
) -> DataFrame:
    df = _with_answers(
        wh,
        _pattern(wh, described_only=True),
        {
            "research_subject_uri": ["Gender", "Primary Language", "Musical Training"],
            "session_uri": ["Analysis Steps"],
        },
    ).filter(
        equals(F.col("acquisition_id"), scan)
        & equals(F.col("Gender"), gender)
        & equals(F.col("Primary___Language"), language)
        & contains(F.col("Analysis___Steps"), step)
        & equals(F.col("Musical___Training"), training)
    )
    return select_distinct(
        df,
        ["study_id", "subject_id", "session_id", "acquisition_id", "acquisition_description",
         "Gender", "Primary___Language", "Musical___Training", "Analysis___Steps"],
    )


def by_manufacturer(wh: Warehouse, manufacturer: str, eye: str, history: str) -> DataFrame:
    scans = _pattern(wh, with_object=True).withColumn("device_manufacturer", header_value("bids:Manufacturer"))
    df = _with_answers(
        wh,
        scans.filter(equals(F.col("device_manufacturer"), manufacturer)),
        {"research_subject_uri": ["Eye Dominance", "Psychiatric History"]},
    ).filter(
        equals(F.col("Eye___Dominance"), eye) & starts_with(F.col("Psychiatric___History"), history)
    )
    return select_distinct(
        df,
        ["study_id", "subject_id", "session_id", "acquisition_id", "device_manufacturer",
         "Eye___Dominance", "Psychiatric___History"],
    )


def by_power_line(
    wh: Warehouse, frequency: str, race: str, eye: str, institute: str, grant: str
) -> DataFrame:
    scans = _pattern(wh, with_object=True).withColumn("powerLineFrequency", header_value("bids:powerLineFrequency"))
    df = _with_answers(
        wh,
        scans.filter(F.col("powerLineFrequency").isNotNull()),
        {
            "research_study_uri": ["Institute", "Grant ID"],
            "research_subject_uri": ["Eye Dominance", "Psychiatric History", "Race"],
        },
    ).filter(
        equals(F.col("powerLineFrequency"), frequency)
        & equals(F.col("Race"), race)
        & equals(F.col("Eye___Dominance"), eye)
        & equals(F.col("Institute"), institute)
        & equals(F.col("Grant___ID"), grant)
    )
    return select_distinct(
        df,
        ["study_id", "subject_id", "session_id", "acquisition_id", "powerLineFrequency", "Institute",
         "Grant___ID", "Eye___Dominance", "Psychiatric___History", "Race"],
    )


def by_device_type(wh: Warehouse, type_: str, stimuli: str, response: str) -> DataFrame:
    subjects = wh.read("research_subject").select(
        "research_study_uri", F.col("research_subject_id").alias("subject_id")
    )
    studies = wh.read("research_study").select("research_study_uri", F.col("research_study_id").alias("study_id"))
    df = _with_answers(
        wh,
        subjects.join(studies, "research_study_uri"),
        {"research_study_uri": ["Institute", "Responses", "Stimuli", "Type"]},
    ).filter(
        equals(F.col("Type"), type_) & equals(F.col("Stimuli"), stimuli) & contains(F.col("Responses"), response)
    )
    return select_distinct(df, ["study_id", "subject_id", "Institute", "Responses", "Stimuli", "Type"])

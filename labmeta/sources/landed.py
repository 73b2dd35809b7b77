"""Readers of landed raw files.

A landing job drops what the imaging server returned. Projects and subjects are XML documents. Everything else
is JSON Lines, one envelope per line: the identifiers of the request and the returned ``body``, as nested
JSON or as text. Lines are split across tasks, so one large study does not land in one task. Nothing is
inferred: every reader passes its schema. A cut-off line, document or body fails the read: if its rows just went
missing, the next load would delete them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labmeta.functions.text import decode_entities, header_keys, join_date_time, json_or_default
from labmeta.operators.align import blanks_to_null
from labmeta.schemas import FIELD_MAP_SESSIONS, ID_TYPE, UMBRELLA_SESSION

# Element, attribute and field names of the landed documents.
PROJECT_FIELDS = ("_ID", "_active", "xnat:name", "xnat:description", "xnat:acquisition_site", "xnat:custom_fields")
SUBJECT_FIELDS = ("_label", "_project", "xnat:custom_fields")
SCAN_FIELDS = {
    "acquisition_id": "xnat:imagescandata/id",
    "acquisition_type": "xnat:imagescandata/type",
    "acquisition_modality": "xnat:imagescandata/modality",
    "acquisition_insert_date": "xnat:imagescandata/meta/insert_date",
    "acquisition_last_modified": "xnat:imagescandata/meta/last_modified",
    "acquisition_start_date": "xnat:imagescandata/start_date",
    "acquisition_start_time": "xnat:imagescandata/starttime",
    "acquisition_object_quality": "xnat:imagescandata/quality",
    "device_manufacturer": "xnat:imagescandata/scanner/manufacturer",
    "device_name": "xnat:imagescandata/scanner/model",
    "series_description": "xnat:imagescandata/series_description",
}

#: Input that cannot be read is an error.
STRICT = {"mode": "FAILFAST"}


#: Characters without a meaning in texts, between values that are decoded together and in the place of a null.
_BETWEEN, _NULL = "\ue001", "\ue002"


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _xml(spark: SparkSession, path: str, tag: str, fields: Sequence[str], lines: bool) -> DataFrame:
    """XML documents, one per file, or with ``lines`` one per line of files that are split across tasks."""
    reader = spark.read.format("xml").option("rowTag", tag).option("multiLine", not lines).options(**STRICT)
    return reader.schema(_strings(fields)).load(path)


def read_envelopes(spark: SparkSession, path: str, ids: Sequence[str]) -> DataFrame:
    """JSON Lines with the given identifier fields and ``body`` as raw JSON text."""
    return spark.read.schema(_strings([*ids, "body"])).options(**STRICT).json(path)


def read_projects(spark: SparkSession, path: str, src_system: str, lines: bool = False) -> DataFrame:
    df = _xml(spark, path, "xnat:Project", PROJECT_FIELDS, lines)
    return blanks_to_null(
        df.select(
            F.lit(src_system).alias("src_system"),
            F.col("_ID").alias("research_study_id"),
            F.lit(ID_TYPE).alias("research_study_id_type"),
            F.col("`xnat:name`").alias("research_study_title"),
            F.col("`xnat:description`").alias("research_study_description"),
            F.col("`xnat:acquisition_site`").alias("research_study_site"),
            F.col("_active").alias("research_study_status"),
            json_or_default(F.col("`xnat:custom_fields`")).alias("xnat_custom_fields"),
        )
    )


def read_subjects(spark: SparkSession, path: str, src_system: str, lines: bool = False) -> DataFrame:
    df = _xml(spark, path, "xnat:Subject", SUBJECT_FIELDS, lines)
    return blanks_to_null(
        df.select(
            F.lit(src_system).alias("src_system"),
            F.col("_label").alias("research_subject_id"),
            F.col("_project").alias("research_study_id"),
            json_or_default(F.col("`xnat:custom_fields`")).alias("xnat_custom_fields"),
        )
    )


def is_session_type(c: Column) -> Column:
    return F.contains(c, F.lit("Session")) & (c != UMBRELLA_SESSION)


def _one_record_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines of one record each, in folders ``project=<id>``: ``session_type`` and ``record``.

    Any line can be read alone, so files are split however large a study is, and a filter on the study reads its folder only.
    """
    schema = T.StructType([*_strings(["session_type"]), T.StructField("record", T.MapType(T.StringType(), T.StringType())), *_strings(["project"])])
    return spark.read.schema(schema).options(**STRICT).json(path).select("project", "session_type", F.col("record").alias("m"))


def _typed_records(spark: SparkSession, path: str, by_record: bool = False) -> DataFrame:
    """Records of all session types with the lower-cased type prefix taken off their field names."""
    if by_record:
        landed = _one_record_lines(spark, path)
    else:
        landed = read_envelopes(spark, path, ["project", "session_type"]).filter(is_session_type(F.col("session_type")))
        landed = landed.select("project", "session_type", F.explode(F.from_json("body", "array<map<string,string>>", STRICT)).alias("m"))
    records = landed.filter(is_session_type(F.col("session_type"))).withColumnRenamed("project", "research_study_id")
    prefix = F.concat(F.lower("session_type"), F.lit("/"))
    return records.withColumn(
        "m",
        F.transform_keys(
            "m", lambda k, _: F.when(F.startswith(k, prefix), F.substring(k, F.length(prefix) + 1, F.length(k))).otherwise(k)
        ),
    )


def _field(name: str) -> Column:
    return F.try_element_at("m", F.lit(name))


def _session_columns(src_system: str) -> list[Column]:
    return [
        F.lit(src_system).alias("src_system"),
        F.col("research_study_id"),
        F.lit(ID_TYPE).alias("research_study_id_type"),
        _field("subject_label").alias("research_subject_id"),
        _field("label").alias("session_id"),
        _field("ID").alias("accession_id"),
        F.col("session_type"),
        join_date_time(_field("date"), _field("time")).alias("session_date"),
    ]


def read_sessions(spark: SparkSession, path: str, src_system: str, by_record: bool = False) -> DataFrame:
    """``by_record``: one record a line, below a folder for each study; else one line for each study and session type."""
    return blanks_to_null(
        _typed_records(spark, path, by_record).select(
            *_session_columns(src_system), json_or_default(_field("custom_fields")).alias("xnat_custom_fields")
        )
    )


def read_scans(spark: SparkSession, path: str, src_system: str, by_record: bool = False) -> DataFrame:
    """``by_record``: as for ``read_sessions``."""
    return blanks_to_null(
        _typed_records(spark, path, by_record).select(
            *_session_columns(src_system),
            *[_field(source).alias(name) for name, source in SCAN_FIELDS.items()],
            json_or_default(_field("custom_fields"), None).alias("xnat_custom_fields"),
        )
    )


def read_dicom_dump(spark: SparkSession, path: str) -> DataFrame:
    """Per scan the tag list as JSON text."""
    df = read_envelopes(spark, path, ["project", "session_id", "acquisition_id"])
    return df.select(
        F.col("project").alias("research_study_id"),
        "session_id",
        "acquisition_id",
        F.from_json("body", "ResultSet struct<Result: string>", STRICT)["ResultSet"]["Result"].alias("dicom_header"),
    )


def read_scan_fields(spark: SparkSession, path: str) -> DataFrame:
    """Per scan the field map, reduced to the header keys, entities in its values decoded, as JSON text.

    The body is parsed first, so a value may hold any entity. Only a body whose own quotes are entities is decoded as a whole.
    """
    df = read_envelopes(spark, path, ["project", "subject_id", "session_id", "acquisition_id"])
    body = F.col("body")
    whole = F.when(F.try_parse_json(body).isNull(), decode_entities(F.when(F.try_parse_json(body).isNull(), body))).otherwise(body)
    parsed = F.from_json(whole, "items array<struct<data_fields: map<string,string>>>", STRICT)
    fields = header_keys(parsed["items"][0]["data_fields"])
    # All values of a scan are decoded as one text, so that one call per scan goes to Python.
    held = F.transform(F.map_values(fields), lambda v: F.coalesce(v, F.lit(_NULL)))
    decoded = F.split(decode_entities(F.array_join(held, _BETWEEN)), _BETWEEN)
    values = F.transform(decoded, lambda v: F.nullif(v, F.lit(_NULL)))
    fields = F.when(F.size(fields) == 0, fields).otherwise(F.map_from_arrays(F.map_keys(fields), values))
    return df.select(
        F.col("project").alias("research_study_id"),
        F.col("subject_id").alias("research_subject_id"),
        "session_id",
        "acquisition_id",
        F.to_json(fields).alias("non_dicom_header"),
    )


def read_forms(spark: SparkSession, path: str) -> DataFrame:
    """Form documents by study and data type; data types that may carry forms only."""
    df = read_envelopes(spark, path, ["project", "xnat_data_type"])
    allowed = F.col("xnat_data_type").isin("xnat:projectData", "xnat:subjectData") | is_session_type(F.col("xnat_data_type"))
    return df.filter(allowed).select(F.col("project").alias("research_study_id"), "xnat_data_type", "body")


def route_headers(scans: DataFrame, dicom: DataFrame, fields: DataFrame) -> DataFrame:
    """Scans with their header: a field map for some session types, a DICOM dump for all others."""
    on_dump = ["research_study_id", "session_id", "acquisition_id"]
    on_map = ["research_study_id", "research_subject_id", "session_id", "acquisition_id"]
    mapped = F.col("session_type").isin(*FIELD_MAP_SESSIONS)
    return (
        scans.join(dicom.select(*on_dump, F.col("dicom_header").alias("_dump")), on_dump, "left")
        .join(fields.select(*on_map, F.col("non_dicom_header").alias("_map")), on_map, "left")
        .withColumns(
            {
                "dicom_header": F.when(~F.coalesce(mapped, F.lit(False)), F.col("_dump")),
                "non_dicom_header": F.when(mapped, F.col("_map")),
            }
        )
        .drop("_dump", "_map")
    )


def configured_projects(df: DataFrame, config: DataFrame) -> DataFrame:
    """Rows of the configured projects."""
    projects = config.select(F.col("xnat_project_id").alias("research_study_id"))
    return df.join(projects, "research_study_id", "left_semi")

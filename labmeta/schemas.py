"""Warehouse tables: columns, natural keys, URI columns and declared types."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

AUDIT = ("_createdat", "_updatedat", "_rev")
ID_TYPE = "xnat_project_id"

# Form subject type by document type; every session type maps to nidm:Session.
SUBJECT_TYPES = {
    "xnat:projectData": "fhir:ResearchStudy",
    "xnat:subjectData": "fhir:ResearchSubject",
}
SESSION_SUBJECT_TYPE = "nidm:Session"
# Question types by role.
OPTION_TYPES = ("select", "xnatSelect", "radio", "selectboxes")
FORM_GROUP_TYPES = ("container", "tree", "datamap", "datagrid", "editgrid")
ANSWER_GROUP_TYPES = ("columns", "container", "tree", "datagrid", "editgrid", "datamap")
# Session types whose scan header is a field map; all others carry a DICOM dump.
FIELD_MAP_SESSIONS = ("fif:megEegSessionData", "edf:ecogSessionData", "et:eyetrackerSessionData")
UMBRELLA_SESSION = "xnat:imageSessionData"
OBJECT_SALT = "Acquisition_object_salt"


def spark_type(declared: str, column: str = "") -> T.DataType:
    """Spark type of a declared column type."""
    declared = declared.lower()
    if declared == "integer":
        return T.IntegerType() if column == "_rev" else T.LongType()
    if declared in ("text", "blob"):
        return T.StringType()
    if declared == "datetime":
        return T.TimestampNTZType()
    if declared == "bool" or (declared == "numeric" and "flag" in column):
        return T.BooleanType()
    if declared in ("float4", "float8", "numeric"):
        return T.DoubleType()
    raise ValueError(f"no Spark type for {declared!r} (column {column!r})")


# The columns of each table with their declared types, in order.
COLUMNS: dict[str, list[tuple[str, str]]] = {
    "xnat_config": [
        ("xnat_project_id", "text"),
        ("last_successful_load_ts", "datetime"),
    ],
    "load_log": [
        ("resource_type", "text"),
        ("last_success_load_ts", "datetime"),
    ],
    "research_study": [
        ("src_system", "text"),
        ("research_study_id", "text"),
        ("research_study_id_type", "text"),
        ("research_study_title", "text"),
        ("research_study_uri", "text"),
        ("research_study_site", "text"),
        ("research_study_category", "text"),
        ("research_study_description", "text"),
        ("research_study_start_date", "datetime"),
        ("research_study_end_date", "datetime"),
        ("research_study_principal_investigator", "text"),
        ("research_study_status", "text"),
        ("xnat_custom_fields", "text"),
    ],
    "research_subject": [
        ("src_system", "text"),
        ("research_study_id", "text"),
        ("research_study_id_type", "text"),
        ("research_study_title", "text"),
        ("research_study_uri", "text"),
        ("research_subject_uri", "text"),
        ("research_subject_id", "text"),
        ("xnat_custom_fields", "text"),
    ],
    "session": [
        ("src_system", "text"),
        ("research_study_id", "text"),
        ("research_study_id_type", "text"),
        ("research_study_title", "text"),
        ("research_study_uri", "text"),
        ("research_subject_id", "text"),
        ("research_subject_uri", "text"),
        ("session_uri", "text"),
        ("session_id", "text"),
        ("session_type", "text"),
        ("session_date", "datetime"),
        ("accession_id", "text"),
        ("xnat_custom_fields", "text"),
    ],
    "acquisition": [
        ("src_system", "text"),
        ("research_study_id", "text"),
        ("research_study_id_type", "text"),
        ("research_study_title", "text"),
        ("research_study_uri", "text"),
        ("research_subject_id", "text"),
        ("session_id", "text"),
        ("session_type", "text"),
        ("acquisition_uri", "text"),
        ("acquisition_id", "text"),
        ("acquisition_type", "text"),
        ("acquisition_insert_date", "datetime"),
        ("acquisition_last_modified", "datetime"),
        ("acquisition_object_quality", "text"),
        ("device_manufacturer", "text"),
        ("device_name", "text"),
        ("session_date", "datetime"),
        ("research_subject_uri", "text"),
        ("session_uri", "text"),
        ("device_uri", "text"),
        ("accession_id", "text"),
        ("acquisition_start_date", "text"),
        ("acquisition_start_time", "text"),
        ("series_description", "text"),
        ("xnat_custom_fields", "text"),
        ("acquisition_modality", "text"),
    ],
    "acquisition_object": [
        ("src_system", "text"),
        ("research_study_id", "text"),
        ("research_study_id_type", "text"),
        ("research_study_title", "text"),
        ("research_study_uri", "text"),
        ("research_subject_id", "text"),
        ("session_id", "text"),
        ("session_type", "text"),
        ("acquisition_uri", "text"),
        ("acquisition_id", "text"),
        ("acquisition_type", "text"),
        ("acquisition_insert_date", "datetime"),
        ("acquisition_last_modified", "datetime"),
        ("acquisition_object_quality", "text"),
        ("device_manufacturer", "text"),
        ("device_name", "text"),
        ("session_date", "datetime"),
        ("research_subject_uri", "text"),
        ("session_uri", "text"),
        ("device_uri", "text"),
        ("accession_id", "text"),
        ("acquisition_start_date", "text"),
        ("acquisition_start_time", "text"),
        ("series_description", "text"),
        ("xnat_custom_fields", "text"),
        ("dicom_header", "text"),
        ("acquisition_object_uri", "text"),
        ("non_dicom_header", "text"),
        ("dummy_field", "text"),
    ],
    "device": [
        ("src_system", "text"),
        ("device_uri", "text"),
        ("device_manufacturer", "text"),
        ("device_name", "text"),
    ],
    "questionnaire_list": [
        ("src_system", "text"),
        ("research_study_id", "text"),
        ("research_study_id_type", "text"),
        ("research_study_title", "text"),
        ("research_study_uri", "text"),
        ("questionnaire_uri", "text"),
        ("questionnaire_name", "text"),
        ("questionnaire_title", "text"),
        ("subject_type", "text"),
        ("questionnaire_uuid", "text"),
        ("xnat_data_type", "text"),
    ],
    "questionnaire_item_list": [
        ("src_system", "text"),
        ("research_study_id", "text"),
        ("research_study_id_type", "text"),
        ("research_study_title", "text"),
        ("research_study_uri", "text"),
        ("question_id", "text"),
        ("question_label", "text"),
        ("question_type", "text"),
        ("questionnaire_item_uri", "text"),
        ("questionnaire_name", "text"),
        ("questionnaire_title", "text"),
        ("questionnaire_uri", "text"),
        ("required_flag", "numeric"),
        ("question_description", "text"),
        ("group_id", "text"),
        ("group_uri", "text"),
        ("enable_when_question", "text"),
        ("enable_when_operator", "text"),
        ("enable_when_answer", "text"),
        ("validate", "text"),
        ("repeats_flag", "numeric"),
        ("questionnaire_uuid", "text"),
        ("subject_type", "text"),
        ("xnat_data_type", "text"),
    ],
    "questionnaire": [
        ("src_system", "text"),
        ("research_study_id", "text"),
        ("research_study_id_type", "text"),
        ("research_study_title", "text"),
        ("research_study_uri", "text"),
        ("questionnaire_name", "text"),
        ("questionnaire_title", "text"),
        ("questionnaire_uri", "text"),
        ("question_id", "text"),
        ("question_label", "text"),
        ("question_type", "text"),
        ("required_flag", "text"),
        ("questionnaire_item_uri", "text"),
        ("answer_option_code", "text"),
        ("answer_option_display", "text"),
        ("questionnaire_item_answer_option_uri", "text"),
        ("question_description", "text"),
        ("group_id", "text"),
        ("group_uri", "text"),
        ("questionnaire_uuid", "text"),
        ("subject_type", "text"),
        ("xnat_data_type", "text"),
    ],
    "questionnaire_response_list": [
        ("src_system", "text"),
        ("research_study_id", "text"),
        ("research_study_id_type", "text"),
        ("research_study_title", "text"),
        ("research_study_uri", "text"),
        ("questionnaire_uri", "text"),
        ("questionnaire_label", "text"),
        ("response_subject_uri", "text"),
        ("response_subject_id", "text"),
        ("questionnaire_response_uri", "text"),
        ("questionnaire_uuid", "text"),
        ("response_subject_type", "text"),
        ("subject_type", "text"),
        ("xnat_data_type", "text"),
    ],
    "questionnaire_response": [
        ("src_system", "text"),
        ("research_study_id", "text"),
        ("research_study_id_type", "text"),
        ("research_study_title", "text"),
        ("research_study_uri", "text"),
        ("questionnaire_uri", "text"),
        ("questionnaire_label", "text"),
        ("response_subject_uri", "text"),
        ("response_subject_id", "text"),
        ("response_text", "text"),
        ("question_type", "text"),
        ("questionnaire_item_uri", "text"),
        ("question_label", "text"),
        ("response_code", "text"),
        ("response_code_display", "text"),
        ("response_code_uri", "text"),
        ("questionnaire_response_uri", "text"),
        ("questionnaire_response_item_uri", "text"),
        ("question_group_id", "text"),
        ("question_group_uri", "text"),
        ("response_group_uri", "text"),
        ("question_id", "text"),
        ("required_flag", "numeric"),
        ("response_list_group_uri", "text"),
        ("response_index_in_list", "text"),
        ("questionnaire_uuid", "text"),
        ("response_subject_type", "text"),
        ("subject_type", "text"),
        ("xnat_data_type", "text"),
    ],
}


@dataclass(frozen=True)
class Table:
    """``derived`` columns are recomputed after the delta and left out of its comparison;
    ``wide`` text columns are compared by digest so that the stored side need not be shuffled. ``documents`` are JSON texts,
    whose spacing and order of keys do not count in a comparison."""

    name: str
    key: tuple[str, ...] = ()
    uri: str | None = None
    resource_type: str | None = None
    type_regex: bool = False
    derived: tuple[str, ...] = ()
    wide: tuple[str, ...] = ()
    documents: tuple[str, ...] = ()
    audit: bool = True
    schema: T.StructType = field(init=False)

    def __post_init__(self):
        fields = []
        for name, declared in COLUMNS[self.name]:
            fields.append(T.StructField(name, spark_type(declared, name)))
        if self.audit:
            for name, declared in zip(AUDIT, ("datetime", "datetime", "integer")):
                fields.append(T.StructField(name, spark_type(declared, name)))
        object.__setattr__(self, "schema", T.StructType(fields))


_STUDY_KEY = ("research_study_id", "research_study_id_type")
_SCAN_KEY = ("src_system", "research_subject_id", *_STUDY_KEY, "session_id", "acquisition_id")

TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table("xnat_config", audit=False),
        Table("load_log", audit=False),
        Table(
            "research_study",
            key=_STUDY_KEY,
            uri="research_study_uri",
            resource_type="fhir:ResearchStudy",
            wide=("xnat_custom_fields",),
            documents=("xnat_custom_fields",),
        ),
        Table(
            "research_subject",
            key=("src_system", "research_subject_id", *_STUDY_KEY),
            uri="research_subject_uri",
            resource_type="fhir:ResearchSubject",
            wide=("xnat_custom_fields",),
            documents=("xnat_custom_fields",),
        ),
        Table(
            "session",
            key=("src_system", "research_subject_id", *_STUDY_KEY, "accession_id"),
            uri="session_uri",
            resource_type="nidm:Session",
            wide=("xnat_custom_fields",),
            documents=("xnat_custom_fields",),
        ),
        Table(
            "acquisition",
            key=_SCAN_KEY,
            uri="acquisition_uri",
            resource_type="nidm:Acquisition",
            wide=("xnat_custom_fields",),
            documents=("xnat_custom_fields",),
        ),
        Table(
            "acquisition_object",
            key=(*_SCAN_KEY, "dummy_field"),
            uri="acquisition_object_uri",
            resource_type="nidm:AcquisitionObject",
            wide=("xnat_custom_fields", "dicom_header", "non_dicom_header"),
            documents=("xnat_custom_fields", "dicom_header", "non_dicom_header"),
        ),
        Table(
            "device",
            key=("src_system", "device_manufacturer", "device_name"),
            uri="device_uri",
            resource_type="fhir:Device",
        ),
        Table(
            "questionnaire_list",
            key=(*_STUDY_KEY, "questionnaire_name", "questionnaire_uuid", "xnat_data_type", "subject_type"),
            uri="questionnaire_uri",
            resource_type="fhir:Questionnaire",
        ),
        Table(
            "questionnaire_item_list",
            key=(*_STUDY_KEY, "questionnaire_name", "group_id", "question_id", "subject_type", "xnat_data_type"),
            uri="questionnaire_item_uri",
            resource_type="sdo:Question",
            derived=("group_uri",),
        ),
        Table(
            "questionnaire",
            key=(
                *_STUDY_KEY, "questionnaire_uuid", "group_id", "question_id", "answer_option_code",
                "subject_type", "xnat_data_type",
            ),
            uri="questionnaire_item_answer_option_uri",
            resource_type="ItemAnswerOption",
            type_regex=True,
        ),
        Table(
            "questionnaire_response_list",
            key=(*_STUDY_KEY, "questionnaire_uuid", "response_subject_uri"),
            uri="questionnaire_response_uri",
            resource_type="fhir:QuestionnaireResponse",
        ),
        Table(
            "questionnaire_response",
            # The group URI follows from the group path and the index, so the path stands for it in the key.
            key=(
                *_STUDY_KEY, "questionnaire_label", "response_subject_uri", "question_id", "response_code",
                "question_group_id", "response_list_group_uri", "response_index_in_list", "xnat_data_type",
            ),
            uri="questionnaire_response_item_uri",
            resource_type="QuestionnaireResponseItemComponent",
            type_regex=True,
            derived=("response_group_uri",),
            wide=("response_text",),
        ),
    )
}

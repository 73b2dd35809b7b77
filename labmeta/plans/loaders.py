"""Warehouse loaders: landed rows → lookups → delta → URI and revision → next snapshot.

Every loader is one plan for all landed studies. ``scope`` is a frame with the landed studies' ids: only
those rows of the stored table are compared and replaced. Without it the whole table is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labmeta.operators import answers as A
from labmeta.operators import enrich as E
from labmeta.operators import forms as Fm
from labmeta.operators.align import blanks_to_null, conform, nonempty_docs
from labmeta.operators.delta import apply_delta, classify_delta, is_option_type, match_keys
from labmeta.functions.text import BLANK_ANSWERS
from labmeta.schemas import OBJECT_SALT, TABLES
from labmeta.sources import landed as L
from labmeta.sources.tables import Warehouse


def load_table(
    wh: Warehouse,
    name: str,
    rows: DataFrame,
    proc_dt: str,
    scope: DataFrame | None = None,
    after: Callable[[DataFrame], DataFrame] | None = None,
    uri_when=None,
) -> DataFrame:
    """Compare ``rows`` with the stored table, apply the delta and publish. An empty load empties its scope.

    A scope with study ids reads and writes the partitions of these studies only, and the load must keep to them. The load
    fails if another writer commits the table in between.
    """
    table = TABLES[name]
    base = wh.version(name)
    stored = wh.read(name, base, wh.scoped_parts(name, scope))
    prev = stored if scope is None else match_keys(stored, scope, scope.columns, "left_semi")
    delta = classify_delta(
        prev, conform(rows, table.schema), table.key, table.uri, table.derived, table.wide, check=False,
        documents=table.documents,
    )
    load = apply_delta(
        delta, proc_dt, table.uri, wh.naming.base, table.key, wh.naming.salt, wh.naming.delimiter, uri_when=uri_when
    )
    staged = None
    if after is not None:
        # ``after`` joins the load with itself, so it is written once and read back. It finds the derived columns anew.
        none = {c: F.lit(None).cast(table.schema[c].dataType) for c in table.derived}
        staged = wh.new_folder()
        load = after(wh.staged(load.withColumns(none), staged))
    published = wh.publish(name, load, base=base) if scope is None else wh.replace(name, load, scope, base)
    if staged is not None:
        wh.discard(staged)
    return published


def load_studies(
    wh: Warehouse, path: str, proc_dt: str, scope: DataFrame | None = None, lines: bool = False
) -> DataFrame:
    """``lines``: one XML document per line instead of one per file."""
    return load_table(wh, "research_study", L.read_projects(wh.spark, path, wh.src_system, lines), proc_dt, scope)


def load_subjects(
    wh: Warehouse, path: str, proc_dt: str, scope: DataFrame | None = None, lines: bool = False
) -> DataFrame:
    rows = E.lookup_study(L.read_subjects(wh.spark, path, wh.src_system, lines), wh.read("research_study"))
    return load_table(wh, "research_subject", rows, proc_dt, scope)


def load_sessions(
    wh: Warehouse, path: str, proc_dt: str, scope: DataFrame | None = None, by_record: bool = False
) -> DataFrame:
    """``by_record``: landed with one record a line."""
    rows = L.read_sessions(wh.spark, path, wh.src_system, by_record)
    rows = E.lookup_subject(E.lookup_study(rows, wh.read("research_study")), wh.read("research_subject"))
    return load_table(wh, "session", rows, proc_dt, scope)


def load_devices(
    wh: Warehouse, path: str, proc_dt: str, scope: DataFrame | None = None, by_record: bool = False
) -> DataFrame:
    """Devices of the landed scans; under a scope also those that stored scans of other studies use."""
    columns = ["src_system", "device_manufacturer", "device_name"]
    scans = L.configured_projects(L.read_scans(wh.spark, path, wh.src_system, by_record), wh.read("xnat_config"))
    rows = E.distinct_rows(scans, columns)
    if scope is not None:
        elsewhere = match_keys(wh.read("acquisition"), scope, scope.columns, "left_anti").select("device_uri")
        used = wh.read("device").join(elsewhere, "device_uri", "left_semi")
        rows = E.distinct_rows(rows.unionByName(used.select(*columns)), columns)
    return load_table(wh, "device", rows, proc_dt)


def load_scans(
    wh: Warehouse, path: str, proc_dt: str, scope: DataFrame | None = None, require_device: bool = True,
    by_record: bool = False,
) -> DataFrame:
    """``require_device=False`` keeps scans whose device is not in the device table."""
    rows = L.read_scans(wh.spark, path, wh.src_system, by_record)
    rows = E.lookup_subject(E.lookup_study(rows, wh.read("research_study")), wh.read("research_subject"))
    rows = E.lookup_session(rows, wh.read("session"))
    rows = E.lookup_device(rows, wh.read("device"), "inner" if require_device else "left")
    return load_table(wh, "acquisition", rows, proc_dt, scope)


def load_scan_objects(
    wh: Warehouse, dicom_path: str, fields_path: str, proc_dt: str, scope: DataFrame | None = None
) -> DataFrame:
    scans = wh.read("acquisition")
    if scope is not None:
        scans = match_keys(scans, scope, scope.columns, "left_semi")
    rows = L.route_headers(
        scans.drop("_createdat", "_updatedat", "_rev"),
        L.read_dicom_dump(wh.spark, dicom_path),
        L.read_scan_fields(wh.spark, fields_path),
    ).withColumn("dummy_field", F.lit(OBJECT_SALT))
    return load_table(wh, "acquisition_object", rows, proc_dt, scope)


def load_forms(wh: Warehouse, path: str, proc_dt: str, scope: DataFrame | None = None) -> DataFrame:
    rows = Fm.list_forms(L.read_forms(wh.spark, path)).withColumn("src_system", F.lit(wh.src_system))
    return load_table(wh, "questionnaire_list", E.lookup_study(rows, wh.read("research_study")), proc_dt, scope)


def load_questions(wh: Warehouse, path: str, proc_dt: str, scope: DataFrame | None = None) -> DataFrame:
    forms = wh.read("questionnaire_list").drop("_createdat", "_updatedat", "_rev")
    rows = Fm.questions_with_form(forms, Fm.flatten_questions(L.read_forms(wh.spark, path)))
    return load_table(
        wh, "questionnaire_item_list", rows, proc_dt, scope, after=Fm.assign_form_group_uri
    )


def load_options(wh: Warehouse, path: str, proc_dt: str, scope: DataFrame | None = None) -> DataFrame:
    questions = wh.read("questionnaire_item_list").drop("_createdat", "_updatedat", "_rev")
    if scope is not None:
        questions = match_keys(questions, scope, scope.columns, "left_semi")
    rows = E.options_to_questions(questions, Fm.flatten_options(L.read_forms(wh.spark, path)))
    return load_table(wh, "questionnaire", rows, proc_dt, scope, uri_when=is_option_type())


def answering_subjects(wh: Warehouse, scope: DataFrame | None = None) -> DataFrame:
    frames = [wh.read(t) for t in ("research_study", "research_subject", "session")]
    if scope is not None:
        frames = [match_keys(f, scope, scope.columns, "left_semi") for f in frames]
    return E.union_resource_types(*frames)


def load_response_headers(wh: Warehouse, proc_dt: str, scope: DataFrame | None = None) -> DataFrame:
    forms = wh.read("questionnaire_list").drop("_createdat", "_updatedat", "_rev")
    subjects = answering_subjects(wh, scope).drop("xnat_custom_fields")
    return load_table(wh, "questionnaire_response_list", A.subject_x_form(subjects, forms), proc_dt, scope)


def answer_rows(
    documents: DataFrame, options: DataFrame, forms: DataFrame, headers: DataFrame, naming: A.Naming,
) -> DataFrame:
    """Answers of all subjects with question, option, form and header attributes."""
    flat = A.flatten_answers(documents, naming=naming)
    joined = A.keep_selected(A.join_answers(flat, A.form_questions(options, forms)))
    joined = A.datamap_answers(A.maybe_active(joined), A.datamap_questions(options, forms))
    active = A.drop_inactive(joined).drop("multiselect")
    return blanks_to_null(A.attach_headers(active, headers), BLANK_ANSWERS)


def load_answers(
    wh: Warehouse, proc_dt: str, scope: DataFrame | None = None, levels: Sequence[str] | None = None
) -> DataFrame:
    """Answers of studies, subjects and sessions in one load, or of some of these ``levels`` (subject types) only.

    Documents are read and opened once. Stored answers of other studies and levels are neither
    grouped nor replaced.
    """
    subjects = answering_subjects(wh, scope)
    if levels is not None:
        subjects = subjects.filter(F.col("response_subject_type").isin(*levels))
        studies = wh.read("research_study") if scope is None else scope
        level = F.explode(F.array(*[F.lit(x) for x in levels])).alias("response_subject_type")
        scope = studies.select("research_study_id", level).distinct()
    rows = answer_rows(
        nonempty_docs(subjects),
        wh.read("questionnaire"),
        wh.read("questionnaire_list"),
        wh.read("questionnaire_response_list"),
        wh.naming,
    )
    stored = wh.read("questionnaire_response", parts=wh.scoped_parts("questionnaire_response", scope))
    rows = A.reuse_list_uri(A.answers_in_scope(stored, subjects), rows)
    return load_table(wh, "questionnaire_response", rows, proc_dt, scope, after=A.assign_group_uri)


def load_all(wh: Warehouse, landing: str, proc_dt: str, scope: DataFrame | None = None) -> None:
    """Parents before children. ``landing`` holds projects, subjects, sessions, scans, dicom, fields, forms."""
    load_studies(wh, f"{landing}/projects", proc_dt, scope)
    load_subjects(wh, f"{landing}/subjects", proc_dt, scope)
    load_sessions(wh, f"{landing}/sessions", proc_dt, scope)
    load_devices(wh, f"{landing}/scans", proc_dt, scope)
    load_scans(wh, f"{landing}/scans", proc_dt, scope)
    load_scan_objects(wh, f"{landing}/dicom", f"{landing}/fields", proc_dt, scope)
    load_forms(wh, f"{landing}/forms", proc_dt, scope)
    load_questions(wh, f"{landing}/forms", proc_dt, scope)
    load_options(wh, f"{landing}/forms", proc_dt, scope)
    load_response_headers(wh, proc_dt, scope)
    load_answers(wh, proc_dt, scope)

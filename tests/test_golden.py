import json

import pytest
from pyspark.sql import functions as F

import lab_fixture
from labmeta.operators.answers import Naming
from labmeta.plans import cohorts, loaders, sync
from labmeta.schemas import TABLES
from labmeta.sources.tables import Warehouse, shared_folder


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    landing = lab_fixture.land(tmp_path_factory.mktemp("landing"))
    wh = Warehouse(spark, shared_folder(spark), Naming("urn:lab:", "secret"))
    wh.append("xnat_config", spark.createDataFrame([(s,) for s in lab_fixture.STUDIES], "xnat_project_id string")
              .withColumn("last_successful_load_ts", F.lit(None).cast("timestamp_ntz")))
    loaders.load_all(wh, landing, "2024-01-01 00:00:00")
    sync.sync_resources(wh)
    return wh, landing


def rows(df, *columns):
    return {tuple(r) for r in df.select(*columns).distinct().collect()}


def test_table_sizes(loaded):
    wh, _ = loaded
    expected = {
        "research_study": 3, "research_subject": 5, "session": 6, "acquisition": 7, "acquisition_object": 7,
        "device": 6 - 1, "questionnaire_list": 15,
    }
    assert {t: wh.read(t).count() for t in expected} == expected


def test_cohort_by_scan_name(loaded):
    found = cohorts.by_scan_name(loaded[0], "FingerLoc", "male", "Afrikaans", "preprocessing", "yes")
    assert rows(found, "study_id", "subject_id", "session_id") == {("study2", "NB002", "NB002_ECOG_1")}


def test_cohort_by_manufacturer(loaded):
    found = cohorts.by_manufacturer(loaded[0], "EYELINK", "right", "depression")
    assert rows(found, "study_id", "subject_id", "session_id") == {("study1", "NA002", "NA002_ET_1")}


def test_cohort_by_power_line(loaded):
    found = cohorts.by_power_line(loaded[0], "50", "asian", "right", "University of Birmingham", "TWCF0389")
    assert rows(found, "study_id", "subject_id", "session_id") == {("study1", "NA001", "NA001_MEEG_1")}


def test_cohort_by_device_type(loaded):
    found = cohorts.by_device_type(loaded[0], "intercranial_sensor", "VisualStims", "ButtonPress")
    assert rows(found, "study_id", "subject_id") == {
        ("study1", "NA001"), ("study1", "NA002"), ("study2", "NB001"), ("study2", "NB002"),
    }


def test_answers_of_one_subject(loaded):
    got = rows(
        loaded[0].read("questionnaire_response").filter("response_subject_id = 'NB002' and questionnaire_uuid = 'form-subject'"),
        "question_id", "question_group_id", "response_text", "response_index_in_list", "response_code",
    )
    assert got == {
        ("form-subject", None, None, "0", None),
        ("gender", "form-subject", "male", "0.0", "Male"),
        ("language", "form-subject", "Afrikaans", "0.1", None),
        ("music", "form-subject", "yes", "0.2", "Yes"),
        ("eye", "form-subject", "left", "0.3", "L"),
        ("history", "form-subject", None, "0.4", None),
        ("race", "form-subject", "white", "0.5", None),
        ("hobbies", "form-subject", None, "0.6", None),
        ("hobbies", "form-subject", "chess", "0.6.0", "Chess"),
        ("extra", "form-subject", None, "0.7", None),
        ("shoe size", "form-subject.extra", "43", "0.7.0", None),
    } - {("hobbies", "form-subject", None, "0.6", None)}


def test_group_uri_points_to_the_same_subject(loaded):
    answers = loaded[0].read("questionnaire_response")
    child = answers.filter("question_id = 'step'").alias("c")
    owner = answers.filter("question_id = 'steps'").alias("o")
    joined = child.join(owner, F.col("c.response_group_uri") == F.col("o.questionnaire_response_item_uri"))
    assert joined.filter("c.response_subject_uri <> o.response_subject_uri").count() == 0
    assert joined.count() == child.count() == 5


def test_every_key_and_uri_is_unique(loaded):
    for name, table in TABLES.items():
        if not table.key:
            continue
        df = loaded[0].read(name)
        assert df.count() > 0
        assert df.groupBy(*table.key).count().filter("count > 1").count() == 0
        uris = df.filter(F.col(table.uri).isNotNull())
        assert uris.select(table.uri).distinct().count() == uris.count(), name


def test_documents_are_json_and_complete(loaded):
    wh = loaded[0]
    resources = wh.read("resources").collect()
    assert all(json.loads(r["body"])["@id"] == r["resource_uri"] for r in resources)
    assert {r["_rev"] for r in resources} == {1}
    mr = wh.read("acquisition_object").filter("dicom_header is not null").first()
    doc = json.loads(next(r["body"] for r in resources if r["resource_uri"] == mr["acquisition_object_uri"]))
    assert doc["Modality"] == "MR2" and doc["(0009,0010)"] == "x"
    assert doc["@context"][2] == {"Modality": "DICOM:0008_0070", "(0009,0010)": "DICOM:0009_0010"}


def test_answers_of_one_level_and_study_load_alone(loaded, spark):
    wh, _ = loaded
    answers = lambda: {tuple(r) for r in wh.read("questionnaire_response").collect()}
    before, files = answers(), wh.manifest("questionnaire_response")
    scope = spark.createDataFrame([("study1",)], "research_study_id string")
    loaders.load_answers(wh, "2024-02-01 00:00:00", scope, ["fhir:ResearchSubject"])
    assert answers() == before
    assert sum(files[p] != x for p, x in wh.manifest("questionnaire_response").items()) == 1
    wh.clean()
    assert answers() == before


def test_second_run_changes_nothing_then_a_change_moves_one_revision(loaded, spark, tmp_path):
    wh, landing = loaded
    loaders.load_all(wh, landing, "2024-02-01 00:00:00")
    for name, table in TABLES.items():
        if table.key:
            assert rows(wh.read(name), "_rev", "_updatedat").__len__() == 1, name
    before = {r["resource_uri"]: r["_rev"] for r in wh.read("resources").collect()}
    sync.sync_resources(wh)
    assert {r["resource_uri"]: r["_rev"] for r in wh.read("resources").collect()} == before

    subjects = dict(lab_fixture.SUBJECTS)
    del subjects[("study3", "NC001")]
    subjects[("study1", "NA001")] = lab_fixture.subject_answers(eye="left", race="asian")
    changed = lab_fixture.land(tmp_path / "second", subjects=subjects)
    loaders.load_all(wh, changed, "2024-03-01 00:00:00")
    sync.sync_resources(wh)
    sync.deprecate_vanished(wh)
    assert rows(wh.read("research_subject"), "research_subject_id", "_rev") == {
        ("NA001", 2), ("NA002", 1), ("NB001", 1), ("NB002", 1),
    }
    gone = wh.read("resources").filter("deprecated").collect()
    assert any('"fhir:ResearchSubject"' in r["body"] and "NC001" in r["body"] for r in gone)
    assert cohorts.by_power_line(
        wh, "50", "asian", "right", "University of Birmingham", "TWCF0389"
    ).count() == 0

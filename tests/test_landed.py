"""Input that cannot be read fails, and loads of a part leave the rest alone."""

import pytest
from pyspark.sql import functions as F

import lab_fixture
from labmeta.operators.answers import Naming
from labmeta.operators.cohort import bindings_to_table
from labmeta.plans import loaders
from labmeta.sources import landed as L
from labmeta.sources.tables import Warehouse, shared_folder

CUT = '{"project": "P", "session_type": "lab:aSessionData", "session_id": "s", "body": '
BAD = {
    "cut-off line": CUT,
    "bad body": CUT + '"{\\"ResultSet\\": [1"}',
}


@pytest.mark.parametrize("line", BAD.values(), ids=BAD)
@pytest.mark.parametrize("name", ["read_sessions", "read_scans", "read_dicom_dump", "read_scan_fields"])
def test_unreadable_json_fails(spark, tmp_path, name, line):
    (tmp_path / "part.json").write_text(line + "\n")
    reader = getattr(L, name)
    args = ("lab",) if name in ("read_sessions", "read_scans") else ()
    with pytest.raises(Exception, match="(?i)malformed"):
        reader(spark, str(tmp_path), *args).collect()


@pytest.mark.parametrize("name", ["Project", "Subject"])
def test_cut_off_xml_fails(spark, tmp_path, name):
    (tmp_path / "part.xml").write_text(f'<xnat:{name} ID="P" label="S" xmlns:xnat="http://example.org/xnat"><xnat:name>x</xnat:')
    reader = L.read_projects if name == "Project" else L.read_subjects
    with pytest.raises(Exception, match="(?i)malformed|xml"):
        reader(spark, str(tmp_path), "lab").collect()


def test_cut_off_results_fail(spark):
    results = spark.createDataFrame([('{"results": {"bindings": [',)], "body string")
    with pytest.raises(Exception, match="(?i)malformed"):
        bindings_to_table(results, ["a"]).collect()


def test_scoped_load_keeps_devices_of_other_studies(spark, tmp_path):
    landing = lab_fixture.land(tmp_path / "landing")
    wh = Warehouse(spark, shared_folder(spark), Naming("urn:lab:", "secret"))
    wh.append("xnat_config", spark.createDataFrame([(s,) for s in lab_fixture.STUDIES], "xnat_project_id string")
              .withColumn("last_successful_load_ts", F.lit(None).cast("timestamp_ntz")))
    loaders.load_studies(wh, f"{landing}/projects", "2024-01-01 00:00:00")
    loaders.load_subjects(wh, f"{landing}/subjects", "2024-01-01 00:00:00")
    loaders.load_sessions(wh, f"{landing}/sessions", "2024-01-01 00:00:00")
    loaders.load_devices(wh, f"{landing}/scans", "2024-01-01 00:00:00")
    loaders.load_scans(wh, f"{landing}/scans", "2024-01-01 00:00:00")
    before = {tuple(r) for r in wh.read("device").collect()}
    study = wh.read("acquisition").select("research_study_id").distinct().orderBy("research_study_id").limit(1)
    part = f"{tmp_path}/part"
    lines = spark.read.text(f"{landing}/scans").filter(F.get_json_object("value", "$.project") == study.first()[0])
    lines.write.text(part)
    loaders.load_devices(wh, part, "2024-02-01 00:00:00", study)
    assert {tuple(r) for r in wh.read("device").collect()} == before


def test_json_lands_compressed_and_splits(spark, tmp_path, monkeypatch):
    """Landed lines take less room than their text, and no compressed file, which is one task, grows with the table."""
    from queries import storage

    monkeypatch.setitem(storage.COMPRESSED, "maxRecordsPerFile", 300)
    rows = spark.range(0, 1000, 1, 2).select(
        F.lit("lab:aSessionData").alias("session_type"), F.col("id").cast("string").alias("project"),
        F.concat(F.lit('[{"subject_label":"'), "id", F.lit('","xnat:imagescandata/type":"T"}]')).alias("body"),
    )
    conf = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    whole = storage.land_json(spark, rows, "lines")
    records = storage.land_records(spark, rows, "records", F.concat(F.lit("=%/"), F.col("project") % 3))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == conf
    for path, text in ((whole, "project"), (records, "record")):
        lines = spark.read.text(path).select("value", F.input_file_name().alias("file"))
        assert lines.count() == 1000 and lines.filter(F.contains("value", F.lit(f'"{text}":'))).count() == 1000
        files = lines.groupBy("file").count().collect()
        assert all(r["file"].endswith(".gz") and r["count"] <= 300 for r in files)
    scans = L.read_scans(spark, records, "lab", by_record=True)
    assert scans.select("research_study_id", "research_subject_id", "acquisition_type").distinct().count() == 1000

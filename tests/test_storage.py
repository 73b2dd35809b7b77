"""Versions of tables: what a write touches, who wins, and what a sync sends."""

import os
import re

import pytest
from pyspark.sql import functions as F

from labmeta.operators import cohort, delta, graph, linked
from labmeta.operators.align import conform
from labmeta.operators.answers import Naming, assign_group_uri, flatten_answers
from labmeta.operators.forms import flatten_questions, list_forms
from labmeta.plans import loaders, sync
from labmeta.schemas import TABLES
from labmeta.sources import landed as L
from labmeta.sources.tables import ConcurrentWriteError, Warehouse, shared_folder


@pytest.fixture
def wh(spark):
    return Warehouse(spark, shared_folder(spark), Naming("urn:lab:", "secret"))


def subjects(spark, studies, prefix="s", document="{}"):
    rows = [("lab", f"{prefix}{i}", study, "xnat_project_id", document) for study in studies for i in range(3)]
    names = "src_system string, research_subject_id string, research_study_id string, research_study_id_type string, xnat_custom_fields string"
    return spark.createDataFrame(rows, names)


def scope(spark, *studies):
    return spark.createDataFrame([(s,) for s in studies], "research_study_id string")


def files(wh, table):
    """All data files of the newest version, by partition, with the time of their last change."""
    found = {}
    for part, folders in wh.manifest(table).items():
        names = [f"{x}/{n}" for x in folders for n in os.listdir(x.removeprefix("file:")) if n.endswith(".parquet")]
        found[part] = {n: os.stat(n.removeprefix("file:")).st_mtime_ns for n in names}
    return found


def test_a_scoped_load_touches_its_study_only(spark, wh):
    loaders.load_table(wh, "research_subject", subjects(spark, ["a", "b/c=%", "d"]), "2024-01-01 00:00:00")
    before = files(wh, "research_subject")
    assert len(before) == 3
    loaders.load_table(wh, "research_subject", subjects(spark, ["b/c=%"], "t"), "2024-02-01 00:00:00", scope(spark, "b/c=%"))
    after = files(wh, "research_subject")
    assert sum(after[p] == before[p] for p in before) == 2
    got = {(r["research_study_id"], r["research_subject_id"]) for r in wh.read("research_subject").collect()}
    assert got == {(s, f"s{i}") for s in "ad" for i in range(3)} | {("b/c=%", f"t{i}") for i in range(3)}
    assert wh.read("research_subject", 1).filter("research_subject_id like 't%'").count() == 0


def test_an_empty_load_empties_its_study_and_foreign_rows_fail(spark, wh):
    loaders.load_table(wh, "research_subject", subjects(spark, ["a", "b", None]), "2024-01-01 00:00:00")
    loaders.load_table(wh, "research_subject", subjects(spark, ["a"]).limit(0), "2024-02-01 00:00:00", scope(spark, "a"))
    assert {r[0] for r in wh.read("research_subject").select("research_study_id").distinct().collect()} == {"b", None}
    loaders.load_table(wh, "research_subject", subjects(spark, [None]).limit(1), "2024-02-01 00:00:00", scope(spark, None))
    assert wh.read("research_subject").filter("research_study_id is null").count() == 1
    with pytest.raises(ValueError, match="beyond the partitions"):
        loaders.load_table(wh, "research_subject", subjects(spark, ["a", "b"]), "2024-03-01 00:00:00", scope(spark, "a"))
    assert wh.version("research_subject") == 3


def test_an_append_leaves_files_and_is_folded_after_many(spark, wh):
    wh.most_appends = 3
    row = lambda i: spark.createDataFrame([(f"t{i}",)], "resource_type string").withColumn(
        "last_success_load_ts", F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    )
    seen = {}
    for i in range(3):
        wh.append("load_log", row(i))
        now = files(wh, "load_log")[""]
        assert seen.items() <= now.items() and len(now) > len(seen)
        seen = now
    wh.append("load_log", row(3))
    assert len(wh.manifest("load_log")[""]) == 1 and wh.read("load_log").count() == 4


def test_of_two_writers_the_second_fails(spark, wh):
    other = Warehouse(spark, wh.root, wh.naming)
    load = lambda w, study, base: w.replace(
        "research_subject", conform(subjects(spark, [study]), TABLES["research_subject"].schema), scope(spark, study), base
    )
    load(wh, "a", 0)
    with pytest.raises(ConcurrentWriteError):
        load(other, "b", 0)
    assert {r[0] for r in other.read("research_subject").select("research_study_id").distinct().collect()} == {"a"}
    load(other, "b", other.version("research_subject"))
    assert wh.read("research_subject").count() == 6


def test_a_commit_that_was_cut_off_is_an_error(spark, wh):
    loaders.load_table(wh, "research_subject", subjects(spark, ["a"]), "2024-01-01 00:00:00")
    file = f"{wh.root}/_versions/research_subject/{2:012d}.json".removeprefix("file:")
    with open(file, "w") as f:
        f.write('{"x": ["/some')
    with pytest.raises(ValueError, match="died"):
        wh.read("research_subject")
    assert wh.read("research_subject", 1).count() == 3


def test_a_sync_writes_changed_buckets_and_brings_back_what_returns(spark, wh):
    base = [s for s in "abcdefgh"]
    loaders.load_table(wh, "research_subject", subjects(spark, base), "2024-01-01 00:00:00")
    sync.sync_resources(wh)
    before, version = files(wh, "resources"), wh.version("resources")
    sync.sync_resources(wh)
    assert wh.version("resources") == version
    # Earlier in time than what was sent, so only the snapshots tell.
    loaders.load_table(wh, "research_subject", subjects(spark, ["z"]).limit(1), "2023-01-01 00:00:00", scope(spark, "z"))
    sync.sync_resources(wh)
    after = files(wh, "resources")
    assert wh.read("resources").count() == 25 and sum(before.get(p) != after[p] for p in after) == 1

    loaders.load_table(wh, "research_subject", subjects(spark, ["z"]).limit(0), "2024-02-01 00:00:00", scope(spark, "z"))
    sync.deprecate_vanished(wh)
    assert wh.read("resources").filter("deprecated").count() == 1
    version = wh.version("resources")
    sync.deprecate_vanished(wh)
    assert wh.version("resources") == version
    loaders.load_table(wh, "research_subject", subjects(spark, ["z"]).limit(1), "2024-03-01 00:00:00", scope(spark, "z"))
    sync.sync_resources(wh)
    back = wh.read("resources").filter("_rev = 2").collect()
    assert len(back) == 1 and not back[0]["deprecated"]


def test_other_spacing_and_key_order_is_no_change(spark, wh):
    loaders.load_table(wh, "research_subject", subjects(spark, ["a"], document='{"x": 1, "y": [1, 2]}'), "2024-01-01 00:00:00")
    sync.sync_resources(wh)
    loaders.load_table(wh, "research_subject", subjects(spark, ["a"], document='{"y":[1,2],"x":1}'), "2024-02-01 00:00:00")
    assert {r["_rev"] for r in wh.read("research_subject").collect()} == {1}
    sync.sync_resources(wh)
    assert {r["_rev"] for r in wh.read("resources").collect()} == {1}
    loaders.load_table(wh, "research_subject", subjects(spark, ["a"], document='{"y":[2,1],"x":1}'), "2024-03-01 00:00:00")
    assert {r["_rev"] for r in wh.read("research_subject").collect()} == {2}


def test_only_live_resources_count(spark):
    rows = spark.createDataFrame([("live",), ("gone",), ("unsent",), (None,)], "uri string")
    known = spark.createDataFrame([("live", False), ("gone", True)], "resource_uri string, deprecated boolean")
    assert [r[0] for r in graph.not_deprecated(rows, known, "uri").collect()] == ["live"]


def test_all_answers_come_from_one_scan(spark, tmp_path):
    names = "response_subject_uri string, questionnaire_response_item_uri string, question_label string, question_type string, response_text string, response_code_display string"
    given = [("s1", "a1", "Q 1", "textfield", "x", None), ("s1", "a2", "Q 1", "textfield", "y", None), ("s1", "a3", "Q 1", "textfield", "x", None),
             ("v1", "a4", "Q 2", None, "z", None), ("s2", "a5", "Q 3", "selectboxes", "hidden", "shown"), (None, "a6", "Q 1", None, "lost", None)]
    spark.createDataFrame(given, names).write.parquet(f"{tmp_path}/answers")
    answers = spark.read.parquet(f"{tmp_path}/answers")
    rows = spark.createDataFrame([("s1", "v1"), ("s2", "v2"), (None, "v1")], "subject string, visit string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = cohort.optional_answers(rows, answers, {"subject": ["Q 1", "Q 3"], "visit": ["Q 2"]})
        got = sorted(map(str, (tuple(r) for r in out.collect())))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted(map(str, [("s1", "v1", "x", None, "z"), ("s1", "v1", "y", None, "z"), ("s2", "v2", None, None, None), (None, "v1", None, None, "z")]))
    final = plan.split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet|Scan parquet", final)) == 1, plan


def test_a_form_body_that_is_cut_off_fails(spark):
    names = "research_study_id string, xnat_data_type string, body string"
    for body in ('{"components": [{"title": "A", "components": [', '{"components": [{"title": "A", "components": 3}]}', "no json"):
        docs = spark.createDataFrame([("p", "xnat:subjectData", body)], names)
        for operator in (list_forms, flatten_questions):
            with pytest.raises(Exception, match="(?i)malformed"):
                operator(docs).collect()


def test_values_may_hold_quotes_as_entities(spark, tmp_path):
    line = (
        '{"project": "P", "subject_id": "u", "session_id": "s", "acquisition_id": "%s", "body": {"items": [{"data_fields": '
        '{"parameters/bids_A": "say &quot;x&quot; &amp; &#92;", "other": "&lt;", "parameters/gnmd_B": %s}}]}}'
    )
    (tmp_path / "part.json").write_text("\n".join([line % ("1", '"plain"'), line % ("2", "null"), line % ("3", '""')]) + "\n")
    got = {r["acquisition_id"]: r["non_dicom_header"] for r in L.read_scan_fields(spark, str(tmp_path)).collect()}
    head = '{"bids:A":"say \\"x\\" & \\\\"'
    assert got["1"] == head + ',"gnmd:B":"plain"}' and got["2"] in (head + "}", head + ',"gnmd:B":null}') and got["3"] == head + ',"gnmd:B":""}'


def test_staged_answers_equal_those_in_one_plan(spark):
    deep = '{"a": ' * 14 + '"x"' + "}" * 14
    docs = spark.createDataFrame([("1", deep), ("2", '{"k": [1, {"b": true, "c": false}], "n": null}'), ("3", None), ("4", "{}")], "response_subject_uri string, xnat_custom_fields string")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(flatten_answers(docs, folder=shared_folder(spark))) == rows(flatten_answers(docs))


def test_links_of_nested_documents(spark):
    body = (
        '{"@context": [{"x": {"@id": "no"}}], "@id": "n", "p": {"@id": "a", "q": [{"@id": "b"}, {"r": {"@id": "c"}}, "text"]}, '
        '"@reverse": {"up": {"@id": "l", "@reverse": {"top": [{"@id": "o1"}, {"@id": "o2"}]}}}, "v": {"@type": "t", "deep": {"@id": "d"}}, "w": {"@id": "a"}}'
    )
    docs = spark.createDataFrame([(body,), (None,), ('{"@id": "alone"}',)], "body string")
    got = {tuple(r) for r in linked.document_edges(docs).collect()}
    assert got == {
        ("n", "p", "a"), ("a", "q", "b"), ("a", "q/r", "c"), ("l", "up", "n"), ("o1", "top", "l"), ("o2", "top", "l"),
        ("n", "v/deep", "d"), ("n", "w", "a"),
    }
    deep = '{"@id": "x"' + ', "p": {"@id": "x"' * 40 + "}" * 41
    assert linked.document_edges(spark.createDataFrame([(deep,)], "body string")).collect() == [("x", "p", "x")]
    with pytest.raises(Exception, match="(?i)json"):
        linked.document_edges(spark.createDataFrame([('{"@id": ',)], "body string")).collect()


def test_items_reach_what_their_index_is_above(spark):
    items = [("r", "i0", "0"), ("r", "i1", "0.1"), ("r", "i2", "0.1.2"), ("r", "i10", "0.10"), ("q", "j", "0.1.5"), (None, "k", "0"), ("r", "m", None)]
    got = {tuple(r) for r in graph.reachable_items(spark.createDataFrame(items, "r string, i string, x string"), "r", "i", "x").collect()}
    assert got == {
        ("r", "i0"), ("r", "i1"), ("r", "i2"), ("r", "i10"), ("q", "j"), ("i0", "i1"), ("i0", "i2"), ("i0", "i10"), ("i1", "i2"),
    }


def test_old_versions_are_forgotten(spark, wh):
    loaders.load_table(wh, "research_subject", subjects(spark, ["a", "b"]), "2024-01-01 00:00:00")
    loaders.load_table(wh, "research_subject", subjects(spark, ["a"], "t"), "2024-02-01 00:00:00", scope(spark, "a"))
    loaders.load_table(wh, "research_subject", subjects(spark, ["a"], "u"), "2024-03-01 00:00:00", scope(spark, "a"))
    wh.forget("research_subject", 3)
    got = {(r["research_study_id"], r["research_subject_id"][0]) for r in wh.read("research_subject").collect()}
    assert got == {("a", "u"), ("b", "s")} and wh.version("research_subject") == 3
    root = f"{wh.root}/research_subject".removeprefix("file:")
    assert sorted(len([p for p in os.listdir(f"{root}/{x}") if p.startswith("part=")]) for x in os.listdir(root)) == [1, 1]
    wh.append("load_log", spark.createDataFrame([("x", None)], "resource_type string, last_success_load_ts timestamp_ntz"))
    wh.append("load_log", spark.createDataFrame([("y", None)], "resource_type string, last_success_load_ts timestamp_ntz"))
    wh.forget("load_log", 2)
    assert wh.read("load_log").count() == 2


def test_a_load_leaves_neither_staged_rows_nor_shuffles(spark, wh):
    # Both stayed: a load's disk was the sum of all its shuffles, of all loads before it and of their staged rows.
    import time

    def shuffles():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (found.apply(i).getName() for i in range(found.size()))
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffles(), spark.conf.get(setting)
    names = "research_study_id string, questionnaire_label string, response_subject_uri string, question_id string, question_group_id string, response_index_in_list string, question_type string, response_text string"
    rows = [(f"S{k % 3}", "Form", f"s{k}", *x) for k in range(30) for x in (("box", None, "0", "container", None), ("name", "box", "0.0", "textfield", f"n{k}"))]
    load = lambda rows, when: loaders.load_table(
        wh, "questionnaire_response", conform(spark.createDataFrame(rows, names), TABLES["questionnaire_response"].schema), when, after=assign_group_uri
    )
    load(rows, "2024-01-01 00:00:00")
    stored = load([(*r[:-1], "changed") if r[3] == "name" and r[2] == "s7" else r for r in rows], "2024-02-01 00:00:00").collect()
    boxes = {r.response_subject_uri: r.questionnaire_response_item_uri for r in stored if r.question_id == "box"}
    assert len(stored) == 60 and all(r.response_group_uri == (boxes[r.response_subject_uri] if r.question_id == "name" else None) for r in stored)
    assert sorted(r.response_subject_uri for r in stored if r._rev == 2) == ["s7"]
    assert os.listdir(f"{wh.root}/_staged".removeprefix("file:")) == []
    assert spark.conf.get(setting) == was
    ended = time.time() + 20
    while len(shuffles() - before) > 1 and time.time() < ended:  # the one of collect() above may stay
        time.sleep(0.2)
    assert len(shuffles() - before) <= 1


def test_keys_are_compared_where_hashes_repeat(spark, monkeypatch):
    # Whole keys were shuffled for the check of every load.
    real, asked = delta.duplicate_groups, []
    monkeypatch.setattr(delta, "duplicate_groups", lambda df, key: asked.append(list(key)) or real(df, key))
    keys = [("a", None), ("b", "c"), ("c", "b"), (None, None)]
    frame = lambda rows: spark.createDataFrame(rows, "x string, y string")
    delta.assert_unique_key(frame(keys), ["x", "y"])
    assert asked == [["_hash"]]
    delta.assert_unique_key(frame([*keys, (None, "a")]), ["x", "y"])  # nulls add nothing to a hash
    assert asked[1:] == [["_hash"], ["x", "y"]]
    for again in (("b", "c"), (None, None)):
        with pytest.raises(delta.DuplicateKeyError, match="None" if again[0] is None else "'b', 'c', 2"):
            delta.assert_unique_key(frame([*keys, again]), ["x", "y"])

import json
import re

import pytest
from pyspark.sql import functions as F

from labmeta.operators import answers as A

DOCS = {
    "empty": {},
    "nested": {"f": {"q": "x", "g": {"h": {"deep": 1}}}},
    "lists": {"f": {"l": ["A", "Open", "{", "[", "true", True, False, None, 1.5, [], {}, [[1], {"k": "v"}]]}},
    "boxes": {"f": {"b": {"one": True, "two": False, "three": True}, "zero": 0, "one": 1, "t": "true", "s": "{not", "B": "BOOLEAN"}},
    "order": {"zz": 1, "aa": {"b": 2, "a": "Apple"}, "mm": [3], "O": "O", "top": True, "n": None},
    "escaped": {"f": {"u": "{x", "v": "A|B\\C", "w": "\"quoted\"", "e": "é"}},
}


def expected(doc):
    """Brute force over one parsed document: (question, path, text, index, ticked)."""
    out = []

    def text(v):
        return None if v is None else v if isinstance(v, str) else json.dumps(v)

    def visit(var, value, index, path):
        if isinstance(value, dict):
            out.append((var, path, None, index, False))
            below = var if path is None else f"{path}.{var}"
            for i, (k, v) in enumerate(value.items()):
                if v is True:
                    out.append((var, path, k, f"{index}.{i}", True))
                elif v is not False:
                    visit(k, v, f"{index}.{i}", below)
        elif isinstance(value, list):
            for i, v in enumerate(value):
                visit(var, v, f"{index}.{i}", path)
        else:
            out.append((var, path, text(value), index, False))

    for i, (k, v) in enumerate(doc.items()):
        visit(k, v, str(i), None)
    return sorted(out, key=str)


def frame(spark, docs, ascii_=False):
    return spark.createDataFrame(
        [(k, json.dumps(v, ensure_ascii=ascii_)) for k, v in docs.items()] + [("missing", None)],
        "response_subject_uri string, xnat_custom_fields string",
    )


@pytest.mark.parametrize("ascii_", [False, True])
def test_flatten_equals_brute_force(spark, ascii_):
    rows = A.flatten_answers(frame(spark, DOCS, ascii_)).collect()
    columns = ("question_id", "question_group_id", "response_text", "response_index_in_list", "multiselect")
    for name, doc in DOCS.items():
        got = sorted((tuple(r[c] for c in columns) for r in rows if r["response_subject_uri"] == name), key=str)
        assert got == expected(doc), name
    assert not [r for r in rows if r["response_subject_uri"] == "missing"]


def test_list_uris_differ_by_subject_and_item(spark):
    docs = {"s1": {"f": [1, 2]}, "s2": {"f": [1, 2]}}
    rows = A.flatten_answers(frame(spark, docs), naming=A.Naming("u:", "salt")).collect()
    assert len({r["response_list_group_uri"] for r in rows}) == 4
    other = A.flatten_answers(frame(spark, docs), naming=A.Naming("u:", "pepper")).collect()
    assert not {r["response_list_group_uri"] for r in rows} & {r["response_list_group_uri"] for r in other}


@pytest.mark.parametrize("levels", [1, 2, 9, 10, 11, 23])
def test_every_level_is_opened(spark, levels):
    doc = 1
    for _ in range(levels):
        doc = {"q": doc}
    flat = A.flatten_answers(frame(spark, {"deep": doc, "flat": {"a": "}}{[\\\"["}}))
    assert flat.filter("response_subject_uri = 'deep'").count() == levels
    assert [r["response_text"] for r in flat.filter("question_id = 'a'").collect()] == ["}}{[\\\"["]


@pytest.mark.parametrize("text", ["[1,2]", '{"a": 1', "word", "3"])
def test_unreadable_document_fails(spark, text):
    docs = spark.createDataFrame([("s", text)], "response_subject_uri string, xnat_custom_fields string")
    with pytest.raises(Exception, match="not a JSON object"):
        A.flatten_answers(docs).count()


def test_reuse_list_uri_raises_on_several(spark):
    schema = "response_subject_uri string, questionnaire_label string, question_id string, question_group_id string, response_index_in_list string, response_list_group_uri string"
    stored = spark.createDataFrame([("s", "f", "q", None, "0.1", "old1"), ("s", "f", "q2", None, "0.2", "old2")], schema)
    new = spark.createDataFrame([("s", "f", "q", None, "0.1", "new1"), ("s", "f", "q9", None, "0.1", "new9")], schema)
    got = {r["question_id"]: r["response_list_group_uri"] for r in A.reuse_list_uri(stored, new).collect()}
    assert got == {"q": "old1", "q9": "new9"}
    with pytest.raises(Exception, match="several stored list URIs"):
        A.reuse_list_uri(stored.unionByName(stored.limit(1)), new).collect()


def test_group_uris_meet_by_a_hash_of_all_keys_and_by_each_key(spark):
    columns = "study {}, form string, subject string, question_id string, question_group_id string, response_index_in_list string, question_type string, questionnaire_response_item_uri string"
    scope = ("study", "form", "subject")
    groups = [
        (1, None, "s1", "box", None, "0", "container", "urn:1"), (None, "f", "s1", "box", None, "0", "container", "urn:2"),
        (1, None, "s1", "box", None, "0", "container", "urn:1"), (1, "f", "s2", "é", "box", "0.\n", "datagrid", "urn:3"),
        (1, "f", "s2", "text", None, "0", "textfield", "urn:no group"),
    ]
    rows = [
        (1, None, "s1", "a", "box", "0.1", "textfield", None), (None, "f", "s1", "b", "box", "0.7", "textfield", None),
        (1, "f", "s1", "c", "box", "0.1", "textfield", None), (1, "f", "s2", "d", "box.é", "0.\n.3", "textfield", None),
        (1, None, "s1", "e", "box", "0.1.2", "textfield", None), (1, None, "s1", "f", None, "0", "textfield", None),
        (1, None, "s1", "g", "box", None, "textfield", None),
    ]
    want = {"a": "urn:1", "b": "urn:2", "c": None, "d": "urn:3", "e": None, "f": None, "g": None}
    answers = spark.createDataFrame(rows, columns.format("int"))
    for kind in ("int", "bigint"):  # equal numbers of unlike types have unlike hashes
        found = A.assign_group_uri(answers, spark.createDataFrame(groups, columns.format(kind)), scope)
        got = [(r.question_id, r.response_group_uri) for r in found.collect()]
        assert len(got) == len(rows) and dict(got) == want
    joined = found._jdf.queryExecution().optimizedPlan().toString()
    assert joined.index("_owner_hash") < joined.index("_owner_path")


def test_group_uris_are_found_with_one_shuffle_of_the_answers(spark):
    # Answers were dealt by all keys, group answers twice more.
    columns = "research_study_id string, questionnaire_uuid string, response_subject_uri string, question_id string, question_group_id string, response_index_in_list string, question_type string, questionnaire_response_item_uri string, response_group_uri string"
    rows = []
    for s in ("s1", "s2", None):
        rows += [
            ("S", "f", s, "box", None, "0", "container", f"urn:{s}:box", "stale"), ("S", "f", s, "grid", "box", "0.1", "datagrid", f"urn:{s}:grid", "stale"),
            ("S", "f", s, "cell", "box.grid", "0.1.0", "textfield", f"urn:{s}:cell", "stale"), ("S", "f", s, "lost", "box.grid", "0.2.0", None, None, "stale"),
            ("S", "f", s, "no index", "box", None, "container", f"urn:{s}:none", "stale"),
        ]
    rows += rows[:2] + [("S", None, "s1", "cell", "box.grid", "0.1.0", "textfield", None, None), ("S", "f", "s2", "grid", "box", "0.1", "tree", None, None)]
    answers = spark.createDataFrame(rows, columns)
    found = A.assign_group_uri(answers)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join " not in plan
    got = sorted((r.response_subject_uri or "-", r.questionnaire_uuid or "-", r.question_id, r.response_group_uri or "-") for r in found.collect())
    want = []
    for s, copies, cells in (("s1", 2, ["urn:s1:grid"]), ("s2", 1, ["urn:s2:grid", "-"]), ("None", 1, ["urn:None:grid"])):
        own = [("box", "-")] * copies + [("grid", f"urn:{s}:box")] * (2 if s == "s2" else copies)
        own += [("cell", u) for u in cells] + [("lost", "-"), ("no index", "-")]
        want += [("-" if s == "None" else s, "f", *x) for x in own]
    assert got == sorted([*want, ("s1", "-", "cell", "-")])
    assert found.columns == answers.columns


def test_stored_list_uris_are_grouped_and_joined_after_one_shuffle(spark):
    schema = "response_subject_uri string, questionnaire_label string, question_id string, question_group_id string, response_index_in_list string, response_list_group_uri string"
    stored = [("a", None, "q", None, "0.1", "old1"), (None, "a", "q", None, "0.1", "old2"), ("s", "f", "q", "p", "0.2", "old3"), ("s", "f", "q", "p", None, "x"), ("s", "f", "q", "p", None, "y")]
    new = [("a", None, "q", None, "0.1", "new1"), (None, "a", "q", None, "0.1", "new2"), (None, "a", "q", "0.1", None, "new3"), ("s", "f", "q", "p", "0.2", "new4"),
           ("s", "f", "q", "p", "0.2", "new5"), ("s", "f", "q", "p", None, "new6"), (None, None, None, None, None, None)]
    found = A.reuse_list_uri(spark.createDataFrame(stored, schema), spark.createDataFrame(new, schema))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 2
    assert sorted(str(r.response_list_group_uri) for r in found.collect()) == ["None", "new3", "new6", "old1", "old2", "old3", "old3"]
    other = spark.createDataFrame([("1", "f", "q", None, "0.1", "old")], schema).withColumn("response_subject_uri", F.col("response_subject_uri").cast("int"))
    same = spark.createDataFrame([("1", "f", "q", None, "0.1", "new")], schema).withColumn("response_subject_uri", F.col("response_subject_uri").cast("bigint"))
    assert [r.response_list_group_uri for r in A.reuse_list_uri(other, same).collect()] == ["old"]


def test_top_level_answers_are_not_dealt_to_one_task_by_their_missing_path(spark):
    columns = "src_system string, research_study_id string, xnat_data_type string, question_id string, question_group_id string, questionnaire_label string"
    joined = spark.createDataFrame(
        [("lab", "S", "t", "f", None, "Form"), ("lab", "S", "t", "map", "f", "Form"), (None, "S", "t", "typed", "f.map", None), (None, "S", "t", "f.map", None, None),
         (None, None, "t", "typed", "f.map", None), (None, "S", "t", "x", "gone", None), (None, "S", "t", None, None, None), (None, "S", "t", None, "f.map", None)],
        columns,
    )
    maps = spark.createDataFrame([("lab", "S", "t", "f.map", "Form"), ("lab", None, "t", "f.map", "No study"), ("lab", "S", "t", None, "No path")], columns.replace("question_id string, ", ""))
    rows = lambda df: sorted(tuple(map(str, r)) for r in df.select("question_id", "question_group_id", "questionnaire_label").collect())
    found = A.datamap_answers(joined, maps)
    assert re.search(r"hashpartitioning\(.*coalesce\(question_group_id#\d+, question_id#\d+\)", found._jdf.queryExecution().executedPlan().toString())
    kept = [("None", "f.map", "Form"), ("f", "None", "Form"), ("map", "f", "Form"), ("typed", "f.map", "Form"), ("typed", "f.map", "No study")]
    assert rows(found) == sorted([*kept, ("None", "None", "None"), ("f.map", "None", "None"), ("x", "gone", "None")])
    assert rows(A.drop_inactive(found)) == sorted(kept)
    assert rows(A.maybe_active(joined)) == sorted([("None", "f.map", "None"), ("f", "None", "Form"), ("map", "f", "Form"), *[("typed", "f.map", "None")] * 2, ("x", "gone", "None")])
    assert rows(A.drop_inactive(A.datamap_answers(A.maybe_active(joined), maps))) == sorted(kept)

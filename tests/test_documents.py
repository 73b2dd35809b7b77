import json

import pytest

from labmeta.operators import answers as A
from labmeta.operators import forms as Fm


def answered(spark, text):
    docs = spark.createDataFrame([("s", text)], "response_subject_uri string, xnat_custom_fields string")
    return A.flatten_answers(docs)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_answers_are_opened_in_one_pass(spark):
    """F4, F6, F8, F11: no row goes through the levels below or above its own."""
    text = json.dumps({"q": {"q": {"q": {"q": {"q": [1, {"q": 2}]}}}}})
    df = answered(spark, text)
    assert plan(df).count("MapInArrow") == 1 and "Generate" not in plan(df)
    assert df.count() == 7


def test_forms_are_opened_in_one_pass(spark):
    """items are read without the items inside them, once."""
    item = {"key": "leaf", "label": "é \"x\"\n", "type": "textfield", "validate": {"max": 5, "x": 1.50, "s": "5"}}
    for i in range(30):
        item = {"key": f"k{i}", "type": "container", "components": [item, None]}
    body = {"components": [{"title": "Form", "components": [item, {"columns": [{"components": [{"key": "c", "type": "t"}]}]}]}]}
    docs = spark.createDataFrame([("S", "t", json.dumps(body))], "research_study_id string, xnat_data_type string, body string")
    df = Fm.flatten_questions(docs)
    assert plan(df).count("MapInArrow") == 1
    rows = {r["question_id"]: r for r in df.collect()}
    assert len(rows) == 32 and rows["c"]["group_id"] is None and rows["k29"]["group_id"] is None
    leaf = rows["leaf"]
    assert leaf["group_id"] == ".".join(f"k{i}" for i in reversed(range(30)))
    assert leaf["question_label"] == "é \"x\"\n" and leaf["validate"] == '{"max":5,"x":1.5,"s":"5"}'


def test_a_form_with_a_broken_tree_fails(spark):
    body = '{"components":[{"title":"F","components":[{"key":"a","components":"no list"}]}]}'
    docs = spark.createDataFrame([("S", "t", body)], "research_study_id string, xnat_data_type string, body string")
    with pytest.raises(Exception, match="not a list"):
        Fm.flatten_questions(docs).collect()


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"a": 1.50, "b": 1e3, "c": -0, "d": 1E400, "f": {"x": 1.50, "y": -0.0, "z": 1e-7}}', ["1.5", "1000.0", "0", '"Infinity"', None, "1.5", "-0.0", "1.0E-7"]),
        ("{'a': 'it\\'s', \"b\": \"o'c\", 'c': 'x\"y'}", ["it's", "o'c", 'x"y']),
        ('{"a": "\\ud800", "o": {"b": "\\ud83d\\ude00"}}', ["?", None, "😀"]),
        (' {"a": 1, "a": 2} tail', ["1", "2"]),
        ('{"a": NaN, "o": {"n": NaN}}', ['"NaN"', None, "NaN"]),
        (" null ", []),
    ],
)
def test_odd_documents(spark, text, expected):
    rows = sorted(answered(spark, text).collect(), key=lambda r: r["response_index_in_list"])
    assert [r["response_text"] for r in rows] == expected


def test_parts_are_dealt_to_all_cores(spark, tmp_path):
    """a table in one small file is not one task."""
    from queries.documents import linked_acquisition_objects

    part = [(i, f"Brand#{i}", "SMALL", i) for i in range(50)]
    spark.createDataFrame(part, "p_partkey long, p_brand string, p_type string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    df = linked_acquisition_objects(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and df.count() == 50

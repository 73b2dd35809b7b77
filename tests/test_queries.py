"""A cross-section of the registered queries against DuckDB at the smallest scale; ``compare.py`` runs all."""

import pytest

import compare
from queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "delta_classify", "delta_apply", "replace_scope_status", "keep_repeated", "changed_rows_since", "align_types",
    "stripped_html", "lookup_chain", "flatten_lines", "answers_with_questions", "flatten_questions", "form_group_uri",
    "linked_acquisition_objects", "linked_answers", "optional_answers", "cohort", "reachable_pairs", "read_subjects",
    "upsert_resources", "streamed_devices", "flatten_deep_answers", "flatten_deep_forms", "flatten_options", "replace_one_study",
    "synced_resources", "load_log", "cohort_by_scan_name", "cohort_by_power_line", "question_edges", "answer_document_edges",
    "reachable_items", "existing_answers", "delta_json_documents", "lookup_questions", "read_scans_by_record",
    "numbered_in_index_order",
]


@pytest.fixture(scope="module")
def con():
    return compare.connection(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    assert compare.compare(spark, con, name, SF) is None

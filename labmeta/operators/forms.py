"""Form definitions: forms, questions, options and group URIs from nested component trees."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labmeta.functions.documents import TYPED, json_object, json_text, scalar_text, walk_documents
from labmeta.functions.text import join_path
from labmeta.operators.enrich import subject_type_of
from labmeta.schemas import FORM_GROUP_TYPES

_OPTIONS = "array<struct<label: string, value: string>>"
_ITEM = (
    "key string, label string, type string, description string, validate string, conditional string, "
    f"multiple string, data struct<values: {_OPTIONS}>, values {_OPTIONS}"
)
#: A form body that cannot be read is an error: if its forms just went missing, the next load would delete them.
STRICT = {"mode": "FAILFAST"}


def top_forms(documents: DataFrame) -> DataFrame:
    """One row per top component of each form document: its JSON, title and uuid (the first child's key).

    ``documents`` has research_study_id, xnat_data_type and body.
    """
    top = documents.select(
        "research_study_id",
        "xnat_data_type",
        F.explode(F.from_json("body", "components array<string>", STRICT)["components"]).alias("form"),
    )
    parsed = top.withColumn("f", F.from_json("form", "title string, components array<string>", STRICT))
    return parsed.select(
        "research_study_id",
        "xnat_data_type",
        F.get_json_object(F.col("f.components")[0], "$.key").alias("questionnaire_uuid"),
        F.col("f.title").alias("title"),
        "form",
    )


def list_forms(documents: DataFrame) -> DataFrame:
    return top_forms(documents).select(
        "research_study_id",
        "questionnaire_uuid",
        F.col("title").alias("questionnaire_name"),
        F.col("title").alias("questionnaire_title"),
        "xnat_data_type",
        subject_type_of(F.col("xnat_data_type")).alias("subject_type"),
    )


def _add_items(add: Callable[[tuple], None], form: str, _: None) -> None:
    """Add (group path, JSON text without the items inside) of every item of a form."""

    def below(node: tuple) -> tuple[list | None, list | None, dict]:
        own = dict(node)
        found = own.pop("components", None), own.pop("columns", None)
        if any(x is not None and type(x) is not list for x in found):
            raise ValueError("the components or columns of a form item are not a list")
        return *found, own

    open_ = [(None, item) for item in below(json_object(form, "a form is not a JSON object", TYPED))[0] or ()]
    while open_:
        path, item = open_.pop()
        if item is None:
            continue
        if type(item) is not tuple:
            raise ValueError("a form item is not a JSON object")
        components, columns, own = below(item)
        add((path, json_text(tuple(own.items()))))
        if components is None:
            open_ += [(path, x) for x in columns or ()]
            continue
        key = own.get("key")
        if key is not None:
            key = json_text(key) if type(key) in (tuple, list) else scalar_text(key)
            path = key if path is None else f"{path}.{key}"
        open_ += [(path, x) for x in components]


def walk_items(documents: DataFrame) -> DataFrame:
    """Every item of every form with its group path, in one pass over the forms and without a shuffle.

    Below ``components`` the path grows by the item's key; below ``columns``, and below items without a
    key, it stays. Forms are walked in Arrow batches, each once and down to any depth; what an item itself holds is read
    from its text without the items inside, so that no text is read once for each level around it.
    """
    ids = ["research_study_id", "xnat_data_type", "questionnaire_uuid"]
    none = F.lit(None).cast("string")
    nodes = walk_documents(top_forms(documents), ids, F.col("form"), none, "group_id string, item string", _add_items)
    return nodes.select(*ids, "group_id", F.from_json("item", _ITEM, STRICT).alias("i")).filter(F.col("i.key").isNotNull())


def flatten_questions(documents: DataFrame) -> DataFrame:
    """One row per item with a key."""
    i = F.col("i")
    conditional = F.from_json(i["conditional"], "when string, eq string")
    return walk_items(documents).select(
        "research_study_id",
        "xnat_data_type",
        "questionnaire_uuid",
        "group_id",
        F.lit(None).cast("string").alias("group_uri"),
        i["key"].alias("question_id"),
        i["label"].alias("question_label"),
        i["description"].alias("question_description"),
        i["type"].alias("question_type"),
        F.coalesce(F.get_json_object(i["validate"], "$.required").cast("boolean"), F.lit(False)).alias("required_flag"),
        conditional["when"].alias("enable_when_question"),
        F.when(i["conditional"].isNotNull(), F.lit("eq")).alias("enable_when_operator"),
        conditional["eq"].alias("enable_when_answer"),
        F.coalesce(i["validate"], F.lit("{}")).alias("validate"),
        F.coalesce(i["multiple"].cast("boolean"), F.lit(False)).alias("repeats_flag"),
    )


def flatten_options(documents: DataFrame) -> DataFrame:
    """One row per answer option. The option's label is its code and its value is its display text."""
    i = F.col("i")
    options = F.when(i["data"].isNotNull(), i["data"]["values"]).otherwise(i["values"])
    return walk_items(documents).select(
        "research_study_id",
        "xnat_data_type",
        "questionnaire_uuid",
        "group_id",
        i["key"].alias("question_id"),
        F.inline(options).alias("answer_option_code", "answer_option_display"),
    )


def questions_with_form(forms: DataFrame, questions: DataFrame) -> DataFrame:
    """Questions of each form row, matched on study, data type and form uuid."""
    return forms.join(questions, ["research_study_id", "xnat_data_type", "questionnaire_uuid"], "inner")


def assign_form_group_uri(items: DataFrame) -> DataFrame:
    """Give each question the URI of the group-type question that its group path names."""
    ids = ["research_study_id", "xnat_data_type", "questionnaire_uuid"]
    groups = items.filter(F.col("question_type").isin(*FORM_GROUP_TYPES)).select(
        *[F.col(c).alias(f"_group_{c}") for c in ids],
        join_path(F.col("group_id"), F.col("question_id")).alias("_group_path"),
        F.col("questionnaire_item_uri").alias("_group_item_uri"),
    )
    same = F.col("group_id") == F.col("_group_path")
    for c in ids:
        same = same & F.col(c).eqNullSafe(F.col(f"_group_{c}"))
    joined = items.join(groups, same, "left")
    return joined.select(
        *[F.col("_group_item_uri").alias("group_uri") if c == "group_uri" else F.col(c) for c in items.columns]
    )

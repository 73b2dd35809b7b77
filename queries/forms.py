"""Form-definition queries: one form document per part, with groups, columns, options and conditions."""

from pyspark.sql import functions as F

from labmeta.operators import forms as Fm
from labmeta.sources.tables import spread
from queries.registry import query, table


def part_documents(spark, d):
    p = spread(table(spark, d, "part"))
    required = F.when(F.col("p_size") > 20, "true").otherwise("false")
    body = F.concat(
        F.lit('{"components":[{"title":"Form '), F.col("p_partkey"),
        F.lit('","components":[{"key":"f'), F.col("p_partkey"), F.lit('","label":"Part","type":"container","components":['),
        F.lit('{"key":"brand","label":"'), F.col("p_name"), F.lit('","type":"select","description":"'), F.col("p_type"),
        F.lit('","validate":{"required":'), required, F.lit('},"conditional":{"when":"size","eq":"'), F.col("p_size"),
        F.lit('"},"data":{"values":[{"label":"Brand","value":"'), F.col("p_brand"), F.lit('"},{"label":"Other","value":"other"}]}},'),
        F.lit('{"type":"columns","columns":[{"components":[{"key":"size","label":"Size","type":"radio","multiple":true,'),
        F.lit('"values":[{"label":"'), F.col("p_size"), F.lit('","value":"s'), F.col("p_size"), F.lit('"}]}]}]},'),
        F.lit('{"key":"grid","label":"Grid","type":"datagrid","components":[{"key":"cell","label":"Cell","type":"textfield"}]}'),
        F.lit("]}]}]}"),
    )
    return p.select(
        F.col("p_brand").alias("research_study_id"), F.lit("xnat:subjectData").alias("xnat_data_type"), body.alias("body")
    )


@query(
    """select p_brand as research_study_id, 'f' || p_partkey as questionnaire_uuid, 'Form ' || p_partkey as questionnaire_name,
      'Form ' || p_partkey as questionnaire_title, 'xnat:subjectData' as xnat_data_type, 'fhir:ResearchSubject' as subject_type from part"""
)
def list_forms(spark, d):
    return Fm.list_forms(part_documents(spark, d))


def _question(key, label, type_, path, description="null", required="false", when=None, validate="'{}'", repeats="false"):
    text = lambda x: "cast(null as varchar)" if x in (None, "null") else x
    operator = "'eq'" if when else "cast(null as varchar)"
    answer = "cast(p_size as varchar)" if when else "cast(null as varchar)"
    return f"""select p_brand as research_study_id, 'xnat:subjectData' as xnat_data_type, 'f' || p_partkey as questionnaire_uuid,
      {text(path)} as group_id, cast(null as varchar) as group_uri, {key} as question_id, {label} as question_label,
      {text(description)} as question_description, '{type_}' as question_type, {required} as required_flag,
      {text(when)} as enable_when_question, {operator} as enable_when_operator, {answer} as enable_when_answer,
      {validate} as validate, {repeats} as repeats_flag from part"""


_F = "'f' || p_partkey"
QUESTIONS_SQL = " union all ".join(
    [
        _question(_F, "'Part'", "container", None),
        _question(
            "'brand'", "p_name", "select", _F, "p_type", "p_size > 20", "'size'",
            """'{"required":' || (p_size > 20) || '}'""",
        ),
        _question("'size'", "'Size'", "radio", _F, repeats="true"),
        _question("'grid'", "'Grid'", "datagrid", _F),
        _question("'cell'", "'Cell'", "textfield", _F + " || '.grid'"),
    ]
)


@query(QUESTIONS_SQL)
def flatten_questions(spark, d):
    """Path grows below components, stays below columns and below items without a key."""
    return Fm.flatten_questions(part_documents(spark, d))


@query(
    f"""select p_brand as research_study_id, 'xnat:subjectData' as xnat_data_type, {_F} as questionnaire_uuid, {_F} as group_id,
      question_id, code as answer_option_code, display as answer_option_display from (
      select *, 'brand' as question_id, 'Brand' as code, p_brand as display from part
      union all select *, 'brand', 'Other', 'other' from part
      union all select *, 'size', cast(p_size as varchar), 's' || p_size from part)"""
)
def flatten_options(spark, d):
    return Fm.flatten_options(part_documents(spark, d))


@query(
    """select cast(o_orderkey as varchar) as research_study_id, 'k' as question_id, 'container' as question_type,
      case when i > 0 then 'k' || repeat('.k', cast(i - 1 as integer)) end as group_id
      from (select o_orderkey, unnest(range(3 + o_orderkey % 18)) as i from orders)"""
)
def flatten_deep_forms(spark, d):
    """Forms of 3 to 20 nested groups."""
    depth = (3 + F.col("o_orderkey") % 18).cast("int")
    body = F.concat(
        F.lit('{"components":[{"title":"Form","components":['),
        F.repeat(F.lit('{"key":"k","label":"Group","type":"container","components":['), depth), F.repeat(F.lit("]}"), depth),
        F.lit("]}]}"),
    )
    forms = spread(table(spark, d, "orders")).select(
        F.col("o_orderkey").cast("string").alias("research_study_id"), F.lit("xnat:subjectData").alias("xnat_data_type"), body.alias("body")
    )
    return Fm.flatten_questions(forms).select("research_study_id", "question_id", "question_type", "group_id")


@query(
    f"""select questionnaire_uuid, question_id, group_id, case when group_id is null then null
      when contains(group_id, '.') then 'urn:' || questionnaire_uuid || ':grid' else 'urn:' || questionnaire_uuid || ':' || group_id end as group_uri
      from ({QUESTIONS_SQL})"""
)
def form_group_uri(spark, d):
    """Each question points to the group question that its path names."""
    items = Fm.flatten_questions(part_documents(spark, d)).withColumn(
        "questionnaire_item_uri", F.concat(F.lit("urn:"), "questionnaire_uuid", F.lit(":"), "question_id")
    )
    return Fm.assign_form_group_uri(items).select("questionnaire_uuid", "question_id", "group_id", "group_uri")

"""Lookup and set-operation queries. Nations stand for studies, customers for subjects, orders for sessions,
order lines for scans and suppliers for devices."""

from pyspark.sql import functions as F

from labmeta.operators import answers as A
from labmeta.operators import enrich as E
from labmeta.operators import forms as Fm
from labmeta.sources import landed as L
from queries.registry import query, table


def study(spark, d):
    n = table(spark, d, "nation")
    return n.select(
        F.col("n_nationkey").alias("research_study_id"),
        F.concat(F.lit("urn:study:"), "n_nationkey").alias("research_study_uri"),
        F.col("n_name").alias("research_study_title"),
        F.lit("xnat_project_id").alias("research_study_id_type"),
    )


def subject(spark, d):
    c = table(spark, d, "customer")
    return c.select(
        F.col("c_nationkey").alias("research_study_id"),
        F.col("c_custkey").alias("research_subject_id"),
        F.concat(F.lit("urn:subject:"), "c_custkey").alias("research_subject_uri"),
    )


def session(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("session_id"), F.col("o_custkey").alias("research_subject_id"))
    ids = subject(spark, d).select("research_study_id", "research_subject_id")
    return o.join(ids, "research_subject_id").select(
        "research_study_id", "research_subject_id", "session_id", F.concat(F.lit("urn:session:"), "session_id").alias("session_uri")
    )


@query(
    """select c_custkey, 'urn:study:' || n_nationkey as research_study_uri, n_name as research_study_title,
      'xnat_project_id' as research_study_id_type, n_nationkey as research_study_id
      from customer join nation on c_nationkey = n_nationkey"""
)
def lookup_study(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("research_study_id"), F.lit("stale").alias("research_study_title"))
    return E.lookup_study(c, study(spark, d))


@query(
    """select l_orderkey, l_linenumber, 'urn:study:' || n_nationkey as research_study_uri, 'urn:subject:' || c_custkey as research_subject_uri,
      'urn:session:' || o_orderkey as session_uri
      from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"""
)
def lookup_chain(spark, d):
    """Scans to study, subject and session."""
    ids = session(spark, d).select("research_study_id", "research_subject_id", "session_id")
    scans = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("session_id"), "l_linenumber").join(ids, "session_id")
    out = E.lookup_session(E.lookup_subject(E.lookup_study(scans, study(spark, d)), subject(spark, d)), session(spark, d))
    return out.select(
        F.col("session_id").alias("l_orderkey"), "l_linenumber", "research_study_uri", "research_subject_uri", "session_uri"
    )


DEVICE_SQL = """with dev as (select distinct nullif(p_brand, 'Brand#2') as maker, p_type as model from part where p_size > 10)
  select p_partkey, nullif(p_brand, 'Brand#2') as device_manufacturer, p_type as device_name,
    'urn:device:' || coalesce(maker, '') || ':' || model as device_uri
  from part {0} join dev on nullif(p_brand, 'Brand#2') is not distinct from maker and p_type is not distinct from model"""


def _parts_and_devices(spark, d):
    p = table(spark, d, "part")
    maker = F.nullif(F.col("p_brand"), F.lit("Brand#2"))
    dev = p.filter("p_size > 10").select(maker.alias("device_manufacturer"), F.col("p_type").alias("device_name")).distinct()
    uri = F.concat(F.lit("urn:device:"), F.coalesce("device_manufacturer", F.lit("")), F.lit(":"), "device_name")
    return p.select("p_partkey", maker.alias("device_manufacturer"), F.col("p_type").alias("device_name")), dev.withColumn("device_uri", uri)


@query(DEVICE_SQL.format("inner"))
def lookup_device(spark, d):
    """A missing manufacturer matches a device without one."""
    return E.lookup_device(*_parts_and_devices(spark, d))


@query(DEVICE_SQL.format("left"))
def lookup_device_optional(spark, d):
    return E.lookup_device(*_parts_and_devices(spark, d), "left")


def form_list(spark, d):
    """One form per (nation, market segment)."""
    c = table(spark, d, "customer").select("c_nationkey", "c_mktsegment").distinct()
    return c.select(
        F.col("c_nationkey").alias("research_study_id"),
        F.lit("xnat:subjectData").alias("xnat_data_type"),
        F.col("c_mktsegment").alias("questionnaire_uuid"),
        F.concat(F.lit("urn:form:"), "c_nationkey", F.lit(":"), "c_mktsegment").alias("questionnaire_uri"),
        F.col("c_mktsegment").alias("questionnaire_name"),
        F.col("c_mktsegment").alias("questionnaire_title"),
        F.lit("fhir:ResearchSubject").alias("subject_type"),
    )


@query(
    """select c_custkey, c_nationkey as research_study_id, c_mktsegment as questionnaire_uuid, 'xnat:subjectData' as xnat_data_type,
      'urn:form:' || c_nationkey || ':' || c_mktsegment as questionnaire_uri, c_mktsegment as questionnaire_name,
      c_mktsegment as questionnaire_title, 'fhir:ResearchSubject' as subject_type from customer"""
)
def lookup_form(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey",
        F.col("c_nationkey").alias("research_study_id"),
        F.col("c_mktsegment").alias("questionnaire_uuid"),
        F.lit("xnat:subjectData").alias("xnat_data_type"),
    )
    return E.lookup_form(c, form_list(spark, d))


@query(
    """select c_nationkey as research_study_id, c_mktsegment as questionnaire_uuid, 'xnat:subjectData' as xnat_data_type, c_custkey as question_id,
      nullif(c_mktsegment, 'BUILDING') as group_id, c_name as question_label, 'urn:item:' || c_custkey as questionnaire_item_uri,
      c_acctbal < 0 as required_flag from customer"""
)
def lookup_questions(spark, d):
    """Every question of each form, by study, data type and form uuid."""
    c = table(spark, d, "customer")
    uuid = F.col("c_mktsegment")
    none = F.lit(None).cast("string")
    questions = c.select(
        F.col("c_nationkey").alias("research_study_id"), F.lit("xnat:subjectData").alias("xnat_data_type"), uuid.alias("questionnaire_uuid"),
        F.col("c_custkey").alias("question_id"), F.nullif(uuid, F.lit("BUILDING")).alias("group_id"), F.col("c_name").alias("question_label"),
        F.concat(F.lit("urn:item:"), "c_custkey").alias("questionnaire_item_uri"), (F.col("c_acctbal") < 0).alias("required_flag"),
        *[none.alias(x) for x in E.QUESTION_ATTRIBUTES if x not in ("question_label", "questionnaire_item_uri", "required_flag")],
    )
    forms = form_list(spark, d).select("research_study_id", "xnat_data_type", "questionnaire_uuid")
    return E.lookup_questions(forms, questions).select(
        "research_study_id", "questionnaire_uuid", "xnat_data_type", "question_id", "group_id", "question_label", "questionnaire_item_uri",
        "required_flag",
    )


@query(
    """with f as (select distinct c_nationkey, c_mktsegment from customer)
    select c.c_nationkey as research_study_id, c_custkey as response_subject_id, 'urn:subject:' || c_custkey as response_subject_uri,
      'fhir:ResearchSubject' as response_subject_type, 'xnat:subjectData' as xnat_data_type, f.c_mktsegment as questionnaire_uuid,
      'urn:form:' || f.c_nationkey || ':' || f.c_mktsegment as questionnaire_uri, f.c_mktsegment as questionnaire_label,
      f.c_mktsegment as questionnaire_title, 'fhir:ResearchSubject' as subject_type
    from customer c join f on f.c_nationkey = c.c_nationkey"""
)
def subject_x_form(spark, d):
    """One response header per subject and form of its study."""
    subjects = subject(spark, d).select(
        "research_study_id",
        F.lit("xnat:subjectData").alias("xnat_data_type"),
        F.col("research_subject_uri").alias("response_subject_uri"),
        F.col("research_subject_id").alias("response_subject_id"),
        F.lit("fhir:ResearchSubject").alias("response_subject_type"),
    )
    return A.subject_x_form(subjects, form_list(spark, d))


@query(
    """select cast(n_nationkey as varchar) as research_study_id, 'xnat:projectData' as xnat_data_type, 'urn:study:' || n_nationkey as response_subject_uri,
      cast(n_nationkey as varchar) as response_subject_id, 'fhir:ResearchStudy' as response_subject_type from nation
    union all select cast(c_nationkey as varchar), 'xnat:subjectData', 'urn:subject:' || c_custkey, cast(c_custkey as varchar), 'fhir:ResearchSubject' from customer
    union all select cast(c_nationkey as varchar), 'lab:' || o_orderstatus || 'Session', 'urn:session:' || o_orderkey, cast(o_orderkey as varchar), 'nidm:Session'
      from orders join customer on o_custkey = c_custkey"""
)
def union_resource_types(spark, d):
    text = lambda df, *cols: df.select([F.col(c).cast("string") if c in cols else F.col(c) for c in df.columns])
    types = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("session_id"), F.concat(F.lit("lab:"), "o_orderstatus", F.lit("Session")).alias("session_type")
    )
    sessions = session(spark, d).join(types, "session_id")
    return E.union_resource_types(
        text(study(spark, d), "research_study_id"),
        text(subject(spark, d), "research_study_id", "research_subject_id"),
        text(sessions, "research_study_id", "session_id"),
    )


@query(
    """select cast(c_custkey as bigint) as key, c_name as name, c_mktsegment as segment, cast(null as varchar) as brand from customer
    union all select p_partkey, p_name, null, p_brand from part"""
)
def union_by_name(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    p = table(spark, d, "part").select(F.col("p_brand").alias("brand"), F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))
    return E.union_by_name(c, p)


@query("select distinct p_brand, p_type from part")
def distinct_pairs(spark, d):
    return E.distinct_rows(table(spark, d, "part"), ["p_brand", "p_type"])


@query(
    """select c_custkey, 'urn:response:' || c_custkey as questionnaire_response_uri from customer
       where exists (select 1 from orders where o_custkey = c_custkey)"""
)
def answered_headers(spark, d):
    uri = lambda c: F.concat(F.lit("urn:response:"), c).alias("questionnaire_response_uri")
    headers = table(spark, d, "customer").select("c_custkey", uri("c_custkey"))
    return E.answered_headers(headers, table(spark, d, "orders").select(uri("o_custkey")))


@query("select event_type, max(ts) as max_ts from events group by event_type")
def newest_by_type(spark, d):
    return E.max_scalar(table(spark, d, "events"), "ts", "event_type")


@query(
    """select 'orders' as name, count(*) as row_count from orders union all select 'lines', count(*) from lineitem
    union all select 'without_lines', count(*) from orders where o_orderkey not in (select l_orderkey from lineitem)"""
)
def counted_sides(spark, d):
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    rest = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left_anti")
    return E.count_rows(orders=orders, lines=lines, without_lines=rest)


@query("select distinct nullif(o_orderpriority, '5-LOW') as resource_uri from orders where o_orderpriority <> '5-LOW'")
def distinct_uris(spark, d):
    o = table(spark, d, "orders").select(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("uri"))
    return E.distinct_uris(o, "uri")


@query(
    """select o_orderkey, o_custkey as research_study_id from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')"""
)
def configured_projects(spark, d):
    config = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("xnat_project_id"))
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("research_study_id"))
    return L.configured_projects(orders, config)


@query(
    """with q as (select p_partkey, p_brand, p_name from part), o as (select distinct p_brand, p_type from part where p_size > 25)
    select p_partkey as questionnaire_uuid, q.p_brand as question_id, p_name as question_label, 'S' as research_study_id, 'T' as xnat_data_type,
      cast(null as varchar) as group_id, o.p_type as answer_option_code, lower(o.p_type) as answer_option_display
    from q left join (select p_partkey as k, p_brand as b, p_type from part where p_size > 25) o on o.k = p_partkey and o.b = q.p_brand"""
)
def options_to_questions(spark, d):
    """Questions keep one row when they have no option; the group path, null here, takes part in the match."""
    ids = [
        F.lit("S").alias("research_study_id"), F.lit("T").alias("xnat_data_type"),
        F.col("p_partkey").alias("questionnaire_uuid"), F.lit(None).cast("string").alias("group_id"), F.col("p_brand").alias("question_id"),
    ]
    p = table(spark, d, "part")
    questions = p.select(*ids, F.col("p_name").alias("question_label"))
    options = p.filter("p_size > 25").select(
        *ids, F.col("p_type").alias("answer_option_code"), F.lower("p_type").alias("answer_option_display")
    )
    return E.options_to_questions(questions, options)


@query(
    """select f.c_nationkey as research_study_id, 'xnat:subjectData' as xnat_data_type, f.c_mktsegment as questionnaire_uuid,
      'urn:form:' || f.c_nationkey || ':' || f.c_mktsegment as questionnaire_uri, f.c_mktsegment as questionnaire_name,
      f.c_mktsegment as questionnaire_title, 'fhir:ResearchSubject' as subject_type, c_name as question_id
    from (select distinct c_nationkey, c_mktsegment from customer) f
    join customer c on c.c_nationkey = f.c_nationkey and c.c_mktsegment = f.c_mktsegment"""
)
def questions_with_form(spark, d):
    questions = table(spark, d, "customer").select(
        F.col("c_nationkey").alias("research_study_id"), F.lit("xnat:subjectData").alias("xnat_data_type"),
        F.col("c_mktsegment").alias("questionnaire_uuid"), F.col("c_name").alias("question_id"),
    )
    return Fm.questions_with_form(form_list(spark, d), questions)


@query(
    """select l_linestatus || l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey as uri, case l_linestatus when 'O' then '0' else '0.1' end as response_index_in_list,
      row_number() over (order by case l_linestatus when 'O' then '0' else '0.1' end,
        l_linestatus || l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey) as row_number from lineitem"""
)
def numbered_in_index_order(spark, d):
    """Two index paths shared by all rows: their places in the whole order."""
    key = F.concat("l_linestatus", F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    line = table(spark, d, "lineitem").select(
        key.alias("uri"), F.when(F.col("l_linestatus") == "O", "0").otherwise("0.1").alias("response_index_in_list")
    )
    return A.numbered_in_index_order(line, "uri")


@query(
    """select l_orderkey, l_linenumber, l_orderkey || '.' || l_linenumber || '.' || l_partkey as response_index_in_list from lineitem"""
)
def answers_in_index_order(spark, d):
    line = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey").alias("response_index_in_list")
    )
    return A.in_index_order(line)

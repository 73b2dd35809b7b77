"""Linked-data queries. The documents are compared as text, so their SQL writes the members in the same order."""

import json

from pyspark.sql import functions as F

from labmeta.operators import linked as Li
from labmeta.sources.tables import spread
from queries.registry import query, table

# Vocabulary addresses that documents carry, written out here so that the SQL does not take them from the code.
CTX = "https://bluebrain.github.io/nexus/contexts/metadata.json"
FHIR = {"fhir": "http://hl7.org/fhir/", "rdfs": "http://www.w3.org/2000/01/rdf-schema#"}
PROV_TR = {"prov": "https://www.w3.org/TR/prov-o/"}
SCHEMA_ORG = {"sdo": "https://schema.org/"}
ACTIVITY = {
    "dcterms": "http://purl.org/dc/terms/",
    "prov": "http://www.w3.org/ns/prov#",
    "sio": "http://semanticscience.org/resource/",
    "nidm": "http://purl.org/nidash/nidm#",
}
HEADER_TERMS = {
    "DICOM": "http://uri.interlex.org/dicom/uris/terms/",
    "bids": "https://wolfborg.github.io/nidm/bids.html#",
    "gnmd": "https://genemede.github.io/genemede_glossary.html#",
}


def _context(*terms):
    merged = {k: v for t in terms for k, v in t.items()}
    return json.dumps([CTX, merged], separators=(",", ":"))


def q(expr):
    """SQL for an expression as a JSON string."""
    return f"cast(to_json(cast({expr} as varchar)) as varchar)"


def member(name, text):
    """SQL for one optional member followed by a comma; ``text`` is SQL for its JSON or null."""
    return f"""coalesce('"{name}":' || ({text}) || ',', '')"""


def ref(expr):
    return f"""('{{"@id":' || {q(expr)} || '}}')"""


def value(expr, type_=None):
    head = f'"@type":"{type_}",' if type_ else ""
    return f"""('{{{head}"fhir:value":' || {q(expr)} || '}}')"""


def doc(context, *members):
    """SQL for a whole document; the comma after the last member goes."""
    return f"""'{{"@context":{context},' || rtrim({' || '.join(members)}, ',') || '}}'"""


NATIONS = """(select n_nationkey, n_name, r_name, nullif(r_name, 'ASIA') as site, case when n_nationkey > 12 then 'active' end as status,
  case when n_nationkey > 5 then '2020-01-01 00:00:00' end as started, case when n_nationkey < 20 then '2021-01-01 00:00:00' end as ended,
  'urn:study:' || n_nationkey as uri from nation join region on n_regionkey = r_regionkey)"""
PERIOD = f"""case when started is not null or ended is not null then '{{"@type":"fhir:Period"' ||
  coalesce(',"fhir:Period.start":' || {value('started', 'fhir:dateTime')}, '') ||
  coalesce(',"fhir:Period.end":' || {value('ended', 'fhir:dateTime')}, '') || '}}' end"""

@query(
    f"""select uri as resource_uri, {doc(
        _context(FHIR, PROV_TR),
        member("@id", q("uri")), member("@type", "'[" + '"fhir:ResearchStudy","prov:Activity"' + "]'"), member("rdfs:label", q("n_name")),
        member("fhir:ResearchStudy.identifier", f'''
          '{{"@type":"fhir:Identifier","fhir:Identifier.value":' || {value("n_name")} ||
          ',"fhir:Identifier.type":{{"@type":"fhir:CodeableConcept","fhir:CodeableConcept.text":{{"fhir:value":"xnat_project_id"}}}},'
          || '"fhir:Identifier.system":{{"@type":"fhir:uri","fhir:value":"urn:lab:imaging-server"}}}}' '''),
        member("fhir:ResearchStudy.title", value("n_name", "fhir:string")),
        member("fhir:ResearchStudy.site", f'''
          case when site is not null then '{{"@type":"fhir:Reference","fhir:Reference.display":' || {value("site")} || '}}' end'''),
        member("fhir:ResearchStudy.description", value("r_name", "fhir:markdown")),
        member("fhir:ResearchStudy.period", PERIOD),
        member("fhir:ResearchStudy.status", value("status", "fhir:code")),
    )} as body from {NATIONS}"""
)
def linked_studies(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    none = F.lit(None).cast("string")
    when = lambda c, text: F.when(c, F.to_timestamp_ntz(F.lit(text)))
    rows = n.select(
        F.concat(F.lit("urn:study:"), "n_nationkey").alias("research_study_uri"),
        F.col("n_name").alias("research_study_id"), F.lit("xnat_project_id").alias("research_study_id_type"),
        F.col("n_name").alias("research_study_title"), F.nullif(F.col("r_name"), F.lit("ASIA")).alias("research_study_site"),
        none.alias("research_study_category"), F.col("r_name").alias("research_study_description"),
        when(F.col("n_nationkey") > 5, "2020-01-01 00:00:00").alias("research_study_start_date"),
        when(F.col("n_nationkey") < 20, "2021-01-01 00:00:00").alias("research_study_end_date"),
        none.alias("research_study_principal_investigator"),
        F.when(F.col("n_nationkey") > 12, "active").alias("research_study_status"),
    )
    return Li.link_rows(rows, "research_study", "research_study_uri").select("resource_uri", "body")


@query(
    f"""select 'urn:subject:' || c_custkey as resource_uri, {doc(
        _context(FHIR),
        member("@id", q("'urn:subject:' || c_custkey")), member("@type", "'" + '"fhir:ResearchSubject"' + "'"), member("rdfs:label", q("c_name")),
        member("fhir:ResearchSubject.identifier", f'''
          '{{"@type":"fhir:Identifier","fhir:Identifier.value":' || {value("c_name")} ||
          ',"fhir:Identifier.system":{{"@type":"fhir:uri","fhir:value":"urn:lab:imaging-server"}}}}' '''),
        member("fhir:ResearchSubject.study", f'''
          '{{"@type":"fhir:Reference","fhir:Reference.reference":' || {value("'urn:study:' || c_nationkey")} ||
          ',"fhir:Reference.type":{{"fhir:value":"http://hl7.org/fhir/ResearchStudy"}},"fhir:link":' || {ref("'urn:study:' || c_nationkey")} || '}}' '''),
    )} as body from customer"""
)
def linked_subjects(spark, d):
    rows = table(spark, d, "customer").select(
        F.concat(F.lit("urn:subject:"), "c_custkey").alias("research_subject_uri"), F.col("c_name").alias("research_subject_id"),
        F.concat(F.lit("urn:study:"), "c_nationkey").alias("research_study_uri"),
    )
    return Li.link_rows(rows, "research_subject", "research_subject_uri").select("resource_uri", "body")


@query(
    f"""select 'urn:session:' || o_orderkey as resource_uri, {doc(
        _context(FHIR, ACTIVITY),
        member("@id", q("'urn:session:' || o_orderkey")), member("@type", "'[" + '"prov:Activity","nidm:Session"' + "]'"),
        member("rdfs:label", q("o_orderkey")), member("dcterms:identifier", q("o_orderkey")), member("dcterms:Identifier", q("o_orderkey")),
        member("dcterms:isPartOf", ref("'urn:status:' || o_orderstatus")),
        member("prov:qualifiedAssociation", f'''
          '{{"@type":"prov:Association","prov:agent":' || {ref("'urn:subject:' || o_custkey")} || ',"prov:hadRole":{{"@id":"sio:Subject"}}}}' '''),
        member("prov:startedAtTime", q("case when o_orderstatus <> 'P' then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end")),
        member("prov:wasAssociatedWith", ref("'urn:subject:' || o_custkey")),
    )} as body from orders"""
)
def linked_sessions(spark, d):
    rows = table(spark, d, "orders").select(
        F.concat(F.lit("urn:session:"), "o_orderkey").alias("session_uri"), F.col("o_orderkey").cast("string").alias("session_id"),
        F.concat(F.lit("urn:status:"), "o_orderstatus").alias("research_study_uri"),
        F.concat(F.lit("urn:subject:"), "o_custkey").alias("research_subject_uri"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("session_date"),
    )
    return Li.link_rows(rows, "session", "session_uri").select("resource_uri", "body")


DEV = "case when l_returnflag <> 'N' then 'urn:device:' || l_suppkey end"
SUB = "'urn:subject:' || l_partkey"
LABEL = "'Session - ' || l_orderkey || '; Acquisition Scan ID - ' || l_linenumber"


@query(
    f"""select 'urn:scan:' || l_orderkey || ':' || l_linenumber as resource_uri, {doc(
        _context(FHIR, ACTIVITY),
        member("@id", q("'urn:scan:' || l_orderkey || ':' || l_linenumber")), member("@type", "'[" + '"prov:Activity","nidm:Acquisition"' + "]'"),
        member("rdfs:label", q(LABEL)), member("dcterms:identifier", q("l_linenumber")),
        member("dcterms:description", q("nullif(l_linestatus, 'O')")),
        member("dcterms:isPartOf", ref("'urn:session:' || l_orderkey")),
        member("prov:startedAtTime", q('''strftime(l_shipdate, '%Y-%m-%d') || case when l_linestatus = 'O' then ' 10:00:00' else '' end''')),
        member("nidm:hadAcquisitionModality", q("l_returnflag")),
        member("prov:wasAssociatedWith", f"'[' || {ref(SUB)} || coalesce(',' || {ref(DEV)}, '') || ']'"),
        member("prov:qualifiedAssociation", f'''
          '[{{"@type":"prov:Association","prov:agent":' || {ref(SUB)} || ',"prov:hadRole":{{"@id":"sio:SIO_000399"}},"rdfs:comment":"{Li.SUBJECT_COMMENT}"}}' ||
          coalesce(',{{"@type":"prov:Association","prov:agent":' || {ref(DEV)} || ',"prov:hadRole":{{"@id":"sio:SIO_000956"}},"rdfs:comment":"{Li.DEVICE_COMMENT}"}}', '') || ']' '''),
    )} as body from lineitem"""
)
def linked_acquisitions(spark, d):
    rows = spread(table(spark, d, "lineitem")).select(
        F.concat_ws(":", F.lit("urn:scan"), "l_orderkey", "l_linenumber").alias("acquisition_uri"),
        F.col("l_orderkey").cast("string").alias("session_id"), F.col("l_linenumber").cast("string").alias("acquisition_id"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("series_description"),
        F.concat(F.lit("urn:session:"), "l_orderkey").alias("session_uri"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("acquisition_start_date"),
        F.when(F.col("l_linestatus") == "O", "10:00:00").alias("acquisition_start_time"),
        F.col("l_returnflag").alias("acquisition_modality"),
        F.concat(F.lit("urn:subject:"), "l_partkey").alias("research_subject_uri"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("urn:device:"), "l_suppkey")).alias("device_uri"),
    )
    return Li.link_rows(rows, "acquisition", "acquisition_uri").select("resource_uri", "body")


def part_objects(spark, d):
    """Scan objects with a DICOM dump (one name repeated, one unknown) or a field map or none."""
    p = spread(table(spark, d, "part"))
    dump = F.concat(
        F.lit('[{"tag1":"(0008,0060)","desc":"Modality","value":"'), "p_type",
        F.lit('"},{"tag1":"(0009,0010)","desc":"?","value":"'), "p_size",
        F.lit('"},{"tag1":"(0008,0070)","desc":"Modality","value":"'), "p_brand", F.lit('"}]'),
    )
    fields = F.concat(F.lit('{"bids:Brand":"'), "p_brand", F.lit('","gnmd:Size":"'), "p_size", F.lit('"}'))
    return p.select(
        F.concat(F.lit("urn:object:"), "p_partkey").alias("acquisition_object_uri"),
        F.lit("S").alias("session_id"), F.col("p_partkey").cast("string").alias("acquisition_id"),
        F.concat(F.lit("urn:scan:"), "p_partkey").alias("acquisition_uri"),
        F.when(F.col("p_size") > 10, "usable").alias("acquisition_object_quality"),
        F.when(F.col("p_type").isin("ECONOMY", "SMALL", "PROMO"), dump).alias("dicom_header"),
        F.when(F.col("p_type").isin("LARGE", "MEDIUM"), fields).alias("non_dicom_header"),
    )


_DICOM = "p_type in ('ECONOMY', 'SMALL', 'PROMO')"
_MAPPED = "p_type in ('LARGE', 'MEDIUM')"


@query(
    f"""select 'urn:object:' || p_partkey as resource_uri, '{{"@context":{_context(FHIR, ACTIVITY, HEADER_TERMS)[:-1]},' ||
      case when {_DICOM} then '{{"(0009,0010)":"DICOM:0009_0010","Modality":"DICOM:0008_0070"}}' else '{{}}' end || '],' || rtrim({' || '.join([
        member("@id", q("'urn:object:' || p_partkey")), member("@type", "'[" + '"prov:Entity","nidm:AcquisitionObject"' + "]'"),
        member("rdfs:label", q("'Session - S; Acquisition Scan ID - ' || p_partkey")),
        member("prov:wasGeneratedBy", ref("'urn:scan:' || p_partkey")),
        member("nidm:AcquisitionObjectQuality", q("case when p_size > 10 then 'usable' end")),
        member("(0009,0010)", q(f"case when {_DICOM} then p_size end")),
        member("Modality", q(f"case when {_DICOM} then p_brand end")),
        member("bids:Brand", q(f"case when {_MAPPED} then p_brand end")),
        member("gnmd:Size", q(f"case when {_MAPPED} then p_size end")),
    ])}, ',') || '}}' as body from part"""
)
def linked_acquisition_objects(spark, d):
    """Header entries become properties; a repeated name keeps its last value, an unknown one goes by its tag."""
    rows = part_objects(spark, d)
    return Li.link_rows(rows, "acquisition_object", "acquisition_object_uri").select("resource_uri", "body")


@query(
    f"""select 'urn:device:' || s_suppkey as resource_uri, {doc(
        _context(FHIR, PROV_TR),
        member("@id", q("'urn:device:' || s_suppkey")), member("@type", "'[" + '"fhir:Device"' + "]'"),
        member("rdfs:label", q("s_name || ' ' || coalesce(model, 'None')")),
        member("fhir:Device.manufacturer", value("s_name", "fhir:string")),
        member("fhir:Device.deviceName", f'''
          '{{"fhir:Device.deviceName.name":' || {value("model", "fhir:string")} ||
          ',"fhir:Device.deviceName.type":{{"@type":"fhir:code","fhir:value":"user-friendly-name"}}}}' '''),
    )} as body from (select *, case when s_nationkey > 8 then 'model "' || s_nationkey || '"' end as model from supplier)"""
)
def linked_devices(spark, d):
    model = F.when(F.col("s_nationkey") > 8, F.concat(F.lit('model "'), "s_nationkey", F.lit('"')))
    rows = table(spark, d, "supplier").select(
        F.concat(F.lit("urn:device:"), "s_suppkey").alias("device_uri"), F.col("s_name").alias("device_manufacturer"), model.alias("device_name")
    )
    return Li.link_rows(rows, "device", "device_uri").select("resource_uri", "body")


@query(
    f"""select 'urn:form:' || p_partkey as resource_uri, {doc(
        _context(FHIR, PROV_TR),
        member("@id", q("'urn:form:' || p_partkey")), member("@type", "'[" + '"fhir:Questionnaire","prov:Entity"' + "]'"),
        member("rdfs:label", q("p_name")), member("fhir:Questionnaire.name", value("p_name", "fhir:string")),
        member("fhir:Questionnaire.identifier", f'''
          '{{"@type":"fhir:Identifier","fhir:Identifier.value":' || {value("p_name", "fhir:string")} || '}}' '''),
        member("fhir:Questionnaire.title", value("p_name", "fhir:string")),
        member("fhir:Questionnaire.subjectType", value("p_type", "fhir:code")),
        member("prov:wasGeneratedBy", ref("'urn:study:' || p_brand")),
    )} as body from part"""
)
def linked_forms(spark, d):
    rows = table(spark, d, "part").select(
        F.concat(F.lit("urn:form:"), "p_partkey").alias("questionnaire_uri"), F.col("p_name").alias("questionnaire_name"),
        F.col("p_name").alias("questionnaire_title"), F.col("p_type").alias("subject_type"),
        F.concat(F.lit("urn:study:"), "p_brand").alias("research_study_uri"),
    )
    return Li.link_rows(rows, "questionnaire_list", "questionnaire_uri").select("resource_uri", "body")


_QI = "fhir:Questionnaire.item"


@query(
    f"""select 'urn:item:' || p_partkey as resource_uri, {doc(
        _context(FHIR, SCHEMA_ORG, PROV_TR),
        member("@id", q("'urn:item:' || p_partkey")),
        member("@type", "'[" + '"fhir:QuestionnaireItemComponent","prov:Entity","sdo:Question"' + "]'"), member("rdfs:label", q("p_partkey")),
        member("@reverse", f'''case when p_size > 25 then '{{"{_QI}.item":' || {ref("'urn:group:' || p_brand")} || '}}'
          else '{{"{_QI}":' || {ref("'urn:form:' || p_type")} || '}}' end'''),
        member(f"{_QI}.linkId", value("p_partkey", "fhir:string")), member(f"{_QI}.text", value("p_name", "fhir:string")),
        member(f"{_QI}.type", value("p_type", "fhir:code")),
        member(f"{_QI}.required", f"""'{{"@type":"fhir:boolean","fhir:value":' || (p_size > 40) || '}}'"""),
        member(f"{_QI}.enableWhen", f'''case when p_size < 20 then '{{"{_QI}.enableWhen.question":' || {value("p_brand", "fhir:string")} ||
          ',"{_QI}.enableWhen.operator":{{"@type":"fhir:code","fhir:value":"eq"}},"{_QI}.enableWhen.answerString":' || {value("p_size", "fhir:string")} || '}}' end'''),
        member("sdo:description", q("nullif(p_type, 'PROMO')")),
    )} as body from part"""
)
def linked_questions(spark, d):
    p = table(spark, d, "part")
    size = F.col("p_size")
    rows = p.select(
        F.concat(F.lit("urn:item:"), "p_partkey").alias("questionnaire_item_uri"), F.col("p_partkey").cast("string").alias("question_id"),
        F.when(size > 25, F.concat(F.lit("urn:group:"), "p_brand")).alias("group_uri"),
        F.concat(F.lit("urn:form:"), "p_type").alias("questionnaire_uri"), F.col("p_name").alias("question_label"),
        F.col("p_type").alias("question_type"), (size > 40).alias("required_flag"),
        F.when(size < 20, F.col("p_brand")).alias("enable_when_question"), F.when(size < 20, F.lit("eq")).alias("enable_when_operator"),
        F.when(size < 20, size.cast("string")).alias("enable_when_answer"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("question_description"),
    )
    return Li.link_rows(rows, "questionnaire_item_list", "questionnaire_item_uri").select("resource_uri", "body")


@query(
    f"""select 'urn:option:' || p_partkey as resource_uri, {doc(
        _context(FHIR),
        member("@id", q("'urn:option:' || p_partkey")),
        member("@type", "'" + '"fhir:QuestionnaireItemComponent.QuestionnaireItemAnswerOptionComponent"' + "'"), member("rdfs:label", q("p_brand")),
        member("@reverse", f'''
          '{{"{_QI}.answerOption":' || {ref("'urn:item:' || p_type")} || '}}' '''),
        member(f"{_QI}.answerOption.valueCoding", f'''
          '{{"@type":"fhir:Coding","fhir:Coding.code":' || {value("p_brand", "fhir:code")} || ',"fhir:Coding.display":' || {value("p_name")} || '}}' '''),
    )} as body from part where p_size > 5"""
)
def linked_options(spark, d):
    """Options without a URI are not resources."""
    rows = table(spark, d, "part").select(
        F.when(F.col("p_size") > 5, F.concat(F.lit("urn:option:"), "p_partkey")).alias("questionnaire_item_answer_option_uri"),
        F.col("p_brand").alias("answer_option_code"), F.col("p_name").alias("answer_option_display"),
        F.concat(F.lit("urn:item:"), "p_type").alias("questionnaire_item_uri"),
    )
    return Li.link_rows(rows, "questionnaire", "questionnaire_item_answer_option_uri").select("resource_uri", "body")


@query(
    f"""select 'urn:response:' || o_orderkey as resource_uri, {doc(
        _context(FHIR, PROV_TR),
        member("@id", q("'urn:response:' || o_orderkey")), member("@type", "'[" + '"fhir:QuestionnaireResponse","prov:Entity"' + "]'"),
        member("rdfs:label", q("'Response for ' || o_orderpriority")),
        member("fhir:QuestionnaireResponse.Questionnaire", ref("'urn:form:' || o_orderpriority")),
        member("fhir:QuestionnaireResponse.status", value("'completed'", "fhir:code")),
        member("fhir:QuestionnaireResponse.subject", f'''
          '{{"@type":"fhir:Reference","fhir:Reference.reference":' || {value("'urn:subject:' || o_custkey", "fhir:string")} ||
          ',"fhir:link":' || {ref("'urn:subject:' || o_custkey")} || '}}' '''),
        member("prov:wasGeneratedBy", ref("'urn:study:' || o_orderstatus")),
    )} as body from orders"""
)
def linked_responses(spark, d):
    rows = table(spark, d, "orders").select(
        F.concat(F.lit("urn:response:"), "o_orderkey").alias("questionnaire_response_uri"), F.col("o_orderpriority").alias("questionnaire_label"),
        F.concat(F.lit("urn:form:"), "o_orderpriority").alias("questionnaire_uri"),
        F.concat(F.lit("urn:subject:"), "o_custkey").alias("response_subject_uri"),
        F.concat(F.lit("urn:study:"), "o_orderstatus").alias("research_study_uri"),
    )
    return Li.link_rows(rows, "questionnaire_response_list", "questionnaire_response_uri").select("resource_uri", "body")


_QR = "fhir:QuestionnaireResponse.item"
_TYPE = "case event_type when 'click' then 'selectboxes' when 'view' then 'datetime' when 'error' then 'url' when 'signup' then null else 'textfield' end"
_TEXT = "case when value >= 5 then props end"
ANSWER_JSON = f"""case when {_TEXT} is null then null
  when event_type = 'click' then '{{"{_QR}.answer.valueCoding":{{"@type":"fhir:Coding","fhir:code":' || {value("'c' || user_id", "fhir:code")} ||
    ',"fhir:display":' || {value("'d' || user_id", "fhir:string")} || '}}}}'
  when event_type = 'view' then '{{"{_QR}.answer.valueDateTime":' || {value(_TEXT, "fhir:dateTime")} || '}}'
  when event_type = 'error' then '{{"{_QR}.answer.valueUrl":' || {value(_TEXT, "fhir:url")} || '}}'
  else '{{"{_QR}.answer.valueString":' || {value(_TEXT)} || '}}' end"""


def event_answers(spark, d):
    e = table(spark, d, "events")
    t = F.col("event_type")
    kind = F.when(t == "click", "selectboxes").when(t == "view", "datetime").when(t == "error", "url").when(t == "purchase", "textfield")
    uri = lambda name, c: F.concat(F.lit(f"urn:{name}:"), c)
    return e.select(
        "event_id", kind.alias("question_type"), F.when(F.col("value") >= 5, F.col("props")).alias("response_text"),
        F.concat(F.lit("c"), "user_id").alias("response_code"), F.concat(F.lit("d"), "user_id").alias("response_code_display"),
        uri("answer", "event_id").alias("questionnaire_response_item_uri"),
        F.when(t.isin("click", "view"), uri("group", "user_id")).alias("response_group_uri"),
        F.when(t.isin("click", "error"), uri("list", "event_id")).alias("response_list_group_uri"),
        uri("response", "user_id").alias("questionnaire_response_uri"), F.lit("Form").alias("questionnaire_label"),
        F.when(t != "view", F.lit("box")).alias("question_group_id"), t.alias("question_id"), t.alias("question_label"),
        F.when(t != "signup", uri("item", t)).alias("questionnaire_item_uri"), F.lit("urn:study").alias("research_study_uri"),
    )


@query(f"select event_id, {ANSWER_JSON} as answer from events")
def typed_answers(spark, d):
    """String, coding, dateTime or url by question type."""
    return event_answers(spark, d).select("event_id", F.to_json(Li.typed_answer()).alias("answer"))


_GROUP, _LIST, _RESP = "'urn:group:' || user_id", "'urn:list:' || event_id", "'urn:response:' || user_id"


@query(
    f"""select 'urn:answer:' || event_id as resource_uri, {doc(
        _context(FHIR, PROV_TR),
        member("@id", q("'urn:answer:' || event_id")), member("@type", "'[" + '"fhir:QuestionnaireResponseItemComponent","prov:Entity"' + "]'"),
        member("rdfs:label", q("'Response for Form'")),
        member("@reverse", f'''case event_type
          when 'click' then '{{"{_QR}.item":{{"@id":' || {q(_LIST)} || ',"@reverse":{{"{_QR}.item":' || {ref(_GROUP)} || '}}}}}}'
          when 'error' then '{{"{_QR}.item":{{"@id":' || {q(_LIST)} || ',"@reverse":{{"{_QR}":' || {ref(_RESP)} || '}}}}}}'
          when 'view' then '{{"{_QR}.item":' || {ref(_GROUP)} || '}}'
          else '{{"{_QR}":' || {ref(_RESP)} || '}}' end'''),
        member(f"{_QR}.linkId", value("case when event_type <> 'view' then 'box.' else '' end || event_type")),
        member(f"{_QR}.definition", ref("case when event_type <> 'signup' then 'urn:item:' || event_type end")),
        member(f"{_QR}.text", value("event_type")),
        member(f"{_QR}.answer", ANSWER_JSON),
        member("prov:wasGeneratedBy", ref("'urn:study'")),
    )} as body from events"""
)
def linked_answers(spark, d):
    """All four parent links: list in group, group, list, response."""
    rows = event_answers(spark, d)
    return Li.link_rows(rows, "questionnaire_response", "questionnaire_response_item_uri").select("resource_uri", "body")

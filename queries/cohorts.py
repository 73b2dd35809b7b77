"""Cohort and graph queries. Nations are studies, customers subjects, orders sessions, order lines scans and
events the subjects' answers."""

from pyspark.sql import functions as F

from labmeta.operators import cohort as Co
from labmeta.operators import graph as G
from labmeta.operators import linked as Li
from labmeta.plans import cohorts
from queries import documents
from queries.documents import event_answers
from queries.registry import query, table


def lab(spark, d):
    uri = lambda name, c: F.concat(F.lit(f"urn:{name}:"), c)
    n, c, o, l = (table(spark, d, t) for t in ("nation", "customer", "orders", "lineitem"))
    study = n.select(uri("study", "n_nationkey").alias("research_study_uri"), F.col("n_name").alias("research_study_id"))
    subject = c.select(
        uri("study", "c_nationkey").alias("research_study_uri"), uri("subject", "c_custkey").alias("research_subject_uri"),
        F.col("c_name").alias("research_subject_id"), F.col("c_mktsegment").alias("segment"),
    )
    session = o.select(
        uri("subject", "o_custkey").alias("research_subject_uri"), uri("session", "o_orderkey").alias("session_uri"),
        F.col("o_orderkey").alias("session_id"),
    )
    scan_uri = F.concat_ws(":", F.lit("urn:scan"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    scan = l.select(
        uri("session", "l_orderkey").alias("session_uri"), scan_uri.alias("acquisition_uri"),
        F.col("l_linenumber").cast("string").alias("acquisition_id"), F.nullif(F.col("l_returnflag"), F.lit("N")).alias("series_description"),
    )
    return study, subject, session, scan


def scan_headers(spark, d):
    """One header per scan: a field map when the line is open, else a DICOM dump."""
    l = table(spark, d, "lineitem").dropDuplicates(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    open_ = F.col("l_linestatus") == "O"
    fields = F.concat(F.lit('{"bids:Manufacturer":"M'), F.col("l_suppkey"), F.lit('"}'))
    dump = F.concat(
        F.lit('[{"tag1":"(0008,0070)","desc":"bids:Manufacturer","value":"M'), F.col("l_suppkey"), F.lit('"}]')
    )
    return l.select(
        F.concat_ws(":", F.lit("urn:scan"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("acquisition_uri"),
        F.when(~open_, dump).alias("dicom_header"), F.when(open_, fields).alias("non_dicom_header"),
    )


def answers(spark, d):
    e = table(spark, d, "events")
    return e.select(
        F.concat(F.lit("urn:subject:"), "user_id").alias("response_subject_uri"),
        F.concat(F.lit("urn:answer:"), "event_id").alias("questionnaire_response_item_uri"),
        F.col("event_type").alias("question_label"),
        F.when(F.col("event_type") == "error", "selectboxes").alias("question_type"),
        F.when(F.col("value") >= 60, "high").otherwise("low").alias("response_text"),
        F.when(F.col("value") >= 60, "coded high").otherwise("coded low").alias("response_code_display"),
    )


CHAIN = """lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"""


@query(
    f"""select n_name as study_id, c_name as subject_id, o_orderkey as session_id, cast(l_linenumber as varchar) as acquisition_id,
      l_returnflag as acquisition_description from {CHAIN} where l_returnflag <> 'N'"""
)
def study_subject_session_scan(spark, d):
    out = Co.study_subject_session_scan(*lab(spark, d), described_only=True)
    return out.select("study_id", "subject_id", "session_id", "acquisition_id", "acquisition_description")


def _answer_sql(label, text="case when value >= 60 then 'high' else 'low' end"):
    return f"(select distinct user_id, {text} as answer from events where event_type = '{label}')"


@query(
    f"""select c_custkey, a.answer as click, b.answer as "view", cast(null as varchar) as error from customer
      left join {_answer_sql('click')} a on a.user_id = c_custkey left join {_answer_sql('view')} b on b.user_id = c_custkey"""
)
def optional_answers(spark, d):
    """One column per question; several answers give several rows; coded answers are not plain values."""
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("urn:subject:"), "c_custkey").alias("uri"))
    out = Co.optional_answers(c, answers(spark, d), {"uri": ["click", "view", "error"]})
    return out.drop("uri")


@query(
    f"""select c_custkey, a.answer as error from customer
      left join {_answer_sql('error', "case when value >= 60 then 'coded high' else 'coded low' end")} a on a.user_id = c_custkey"""
)
def optional_coded_answers(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("urn:subject:"), "c_custkey").alias("uri"))
    return Co.optional_answer(c, answers(spark, d), "uri", "error", include_coded=True).drop("uri")


@query(
    f"""select distinct n_name as study_id, c_name as subject_id, o_orderkey as session_id, cast(l_linenumber as varchar) as acquisition_id,
      a.answer as click, b.answer as "view"
      from {CHAIN} left join {_answer_sql('click')} a on a.user_id = c_custkey left join {_answer_sql('view')} b on b.user_id = c_custkey
      where l_linenumber = 3 and a.answer = 'high' and starts_with(b.answer, 'lo') and contains(c_mktsegment, 'B')"""
)
def cohort(spark, d):
    """Pattern, optional answers, text predicates, distinct."""
    study, subject, session, scan = lab(spark, d)
    pattern = Co.study_subject_session_scan(
        study, subject.filter(Co.contains(F.col("segment"), "B")), session, scan
    )
    out = Co.optional_answers(pattern, answers(spark, d), {"research_subject_uri": ["click", "view"]}).filter(
        Co.equals(F.col("acquisition_id"), "3") & Co.equals(F.col("click"), "high") & Co.starts_with(F.col("view"), "lo")
    )
    return Co.select_distinct(out, ["study_id", "subject_id", "session_id", "acquisition_id", "click", "view"])


@query(
    f"""select distinct c_name as subject_id, o_orderkey as session_id, cast(l_linenumber as varchar) as acquisition_id, 'M' || l_suppkey as device_manufacturer
      from {CHAIN} where l_suppkey = 7"""
)
def scans_by_header(spark, d):
    """Scan header equals a value, whether it came as a field map or as a DICOM dump."""
    objects = scan_headers(spark, d).withColumn("device_manufacturer", Co.header_value("bids:Manufacturer"))
    study, subject, session, scan = lab(spark, d)
    found = objects.filter("device_manufacturer = 'M7'").select("acquisition_uri", "device_manufacturer")
    out = Co.study_subject_session_scan(study, subject, session, scan).join(found, "acquisition_uri")
    return Co.select_distinct(out, ["subject_id", "session_id", "acquisition_id", "device_manufacturer"])


def resources(spark, d):
    """Resource rows from parts; large ones are deprecated."""
    p = table(spark, d, "part")
    return p.select(
        F.concat(F.lit("urn:part:"), "p_partkey").alias("resource_uri"),
        F.array(F.concat(F.lit("lab:"), "p_type"), F.lit("prov:Entity")).alias("resource_types"),
        F.col("p_name").alias("body"), (F.col("p_partkey") % 5 + 1).cast("int").alias("_rev"), (F.col("p_size") > 40).alias("deprecated"),
    )


@query("select 'urn:part:' || p_partkey as resource_uri from part where p_size <= 40")
def live_resources(spark, d):
    return G.not_deprecated(resources(spark, d)).select("resource_uri")


@query(
    """select l_orderkey, l_partkey from lineitem where l_partkey not in (select p_partkey from part where p_size > 40)"""
)
def rows_of_live_resources(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", F.concat(F.lit("urn:part:"), "l_partkey").alias("uri"))
    return G.not_deprecated(rows, resources(spark, d), "uri").drop("uri")


@query(
    """select 'urn:part:' || p_partkey as resource_uri, p_type = 'PROMO' as exact from part where p_type = 'PROMO' or regexp_matches(p_type, '(?i)sma|larg')"""
)
def resources_of_type(spark, d):
    """Exact type or case-insensitive pattern over the types."""
    r = resources(spark, d)
    exact = G.of_type(r, "lab:PROMO").select("resource_uri", F.lit(True).alias("exact"))
    return exact.unionByName(G.of_type(r, "sma|larg", regex=True).select("resource_uri", F.lit(False).alias("exact")))


@query(
    """select event_id, event_type as kind, cast(user_id as varchar) as user_name, case when value >= 60 then props end as extra from events
    union all select event_id, 'second', null, null from events"""
)
def bindings_to_table(spark, d):
    """Query-result JSON to columns; a variable without a binding is null."""
    e = table(spark, d, "events")
    binding = F.to_json(
        F.struct(
            F.struct(F.lit("literal").alias("type"), F.col("event_id").cast("string").alias("value")).alias("event_id"),
            F.struct(F.col("event_type").alias("value")).alias("kind"),
            F.struct(F.col("user_id").cast("string").alias("value")).alias("user_name"),
            F.when(F.col("value") >= 60, F.struct(F.col("props").alias("value"))).alias("extra"),
        )
    )
    second = F.concat(F.lit('{"event_id":{"value":"'), F.col("event_id"), F.lit('"},"kind":{"value":"second"}}'))
    body = F.concat(
        F.lit('{"head":{"vars":["event_id","kind","user_name","extra"]},"results":{"bindings":['), binding, F.lit(","), second, F.lit("]}}")
    )
    out = Co.bindings_to_table(e.select(body.alias("body")), ["event_id", "kind", "user_name", "extra"])
    return out.withColumn("event_id", F.col("event_id").cast("bigint"))


@query(
    """select 'urn:session:' || o_orderkey as s, 'prov:wasAssociatedWith' as p, 'urn:subject:' || o_custkey as o from orders
    union all select 'urn:session:' || o_orderkey, 'dcterms:isPartOf', 'urn:study:' || o_orderstatus from orders where o_orderstatus <> 'P'"""
)
def resource_edges(spark, d):
    rows = table(spark, d, "orders").select(
        F.concat(F.lit("urn:session:"), "o_orderkey").alias("session_uri"), F.concat(F.lit("urn:subject:"), "o_custkey").alias("research_subject_uri"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("urn:study:"), "o_orderstatus")).alias("research_study_uri"),
    )
    return Li.edges(rows, "session_uri", Li.LINKS["session"])


ANSWER_EDGES = """with e as (select *, 'urn:answer:' || event_id as child, 'urn:response:' || user_id as resp,
    case when event_type in ('click', 'view') then 'urn:group:' || user_id end as grp,
    case when event_type in ('click', 'error') then 'urn:list:' || event_id end as lst from events)
  select distinct coalesce(grp, resp) as s,
    'fhir:QuestionnaireResponse.item' || case when grp is not null then '.item' else '' end as p, coalesce(lst, child) as o from e
  union all select lst, 'fhir:QuestionnaireResponse.item.item', child from e where lst is not null"""


@query(ANSWER_EDGES)
def answer_edges(spark, d):
    """Response or group → [list element →] answer."""
    return Li.answer_edges(event_answers(spark, d))


CLOSURE_EDGES = """select 'R' || n_regionkey as s, 'N' || n_nationkey as o from nation
  union all select 'N' || c_nationkey, 'C' || c_custkey from customer union all select 'C' || o_custkey, 'O' || o_orderkey from orders"""


@query(
    f"""with recursive edge as ({CLOSURE_EDGES}), pair as (select s as root, o as node from edge
      union select pair.root, edge.o from pair join edge on pair.node = edge.s) select root, node from pair"""
)
def reachable_pairs(spark, d):
    """All pairs joined by one or more edges."""
    n, c, o = (table(spark, d, t) for t in ("nation", "customer", "orders"))
    edge = lambda df, a, ac, b, bc: df.select(F.concat(F.lit(a), ac).alias("s"), F.concat(F.lit(b), bc).alias("o"))
    edges = (
        edge(n, "R", "n_regionkey", "N", "n_nationkey")
        .unionByName(edge(c, "N", "c_nationkey", "C", "c_custkey"))
        .unionByName(edge(o, "C", "o_custkey", "O", "o_orderkey"))
    )
    return G.reachable(edges)


class Tables:
    """The given tables under the names that the cohort plans read."""

    def __init__(self, spark, d):
        study, subject, session, scan = lab(spark, d)
        answers, resources = lab_answers(spark, d)
        self.tables = {
            "research_study": study, "research_subject": subject, "session": session, "acquisition": scan,
            "acquisition_object": lab_headers(spark, d), "questionnaire_response": answers, "resources": resources,
        }

    def read(self, name):
        return self.tables[name]


def lab_headers(spark, d):
    """Headers with a manufacturer and, unless the line's flag is N, a power-line frequency."""
    l = table(spark, d, "lineitem").dropDuplicates(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    maker = F.concat(F.lit("M"), "l_suppkey")
    hertz = F.when(F.col("l_returnflag") == "A", "60").when(F.col("l_returnflag") == "R", "50")
    fields = F.to_json(F.struct(maker.alias("bids:Manufacturer"), hertz.alias("bids:powerLineFrequency")))
    entry = lambda tag, desc, value: F.struct(F.lit(tag).alias("tag1"), F.lit(desc).alias("desc"), value.alias("value"))
    dump = F.to_json(
        F.filter(
            F.array(entry("(0008,0070)", "bids:Manufacturer", maker), entry("(0009,0001)", "bids:powerLineFrequency", hertz)),
            lambda e: e["value"].isNotNull(),
        )
    )
    open_ = F.col("l_linestatus") == "O"
    return l.select(
        F.concat_ws(":", F.lit("urn:scan"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("acquisition_uri"),
        F.when(~open_, dump).alias("dicom_header"), F.when(open_, fields).alias("non_dicom_header"),
    )


def lab_answers(spark, d):
    """Answers of customers, events (several a customer), orders and nations; events below 5 are no resources yet, those
    above 180 deprecated."""
    n, c, o, e = (table(spark, d, t) for t in ("nation", "customer", "orders", "events"))

    def answers(df, name, key, subject, label, text):
        return df.select(
            F.concat(F.lit(f"urn:{name}:"), subject).alias("response_subject_uri"),
            F.concat_ws(":", F.lit("urn:answer"), label, key).alias("questionnaire_response_item_uri"),
            label.alias("question_label"), F.lit("textfield").alias("question_type"), text.alias("response_text"),
            F.lit(None).cast("string").alias("response_code_display"),
        )

    high, kind = F.col("value") >= 60, F.col("event_type")
    of = lambda name, yes, no: (F.lit(name), F.when(high, yes).otherwise(no))
    kinds = {
        "click": of("Musical Training", "yes", "no"), "view": of("Eye Dominance", "right", "left"),
        "purchase": of("Psychiatric History", "depression, mild", "none"), "signup": of("Race", "asian", "white"),
    }
    label, text = F.lit("Unused"), F.lit("x")
    for event, (name, given) in kinds.items():
        label, text = F.when(kind == event, name).otherwise(label), F.when(kind == event, given).otherwise(text)
    region, key = F.col("n_regionkey"), F.col("n_nationkey")
    frames = [
        answers(c, "subject", F.col("c_custkey"), "c_custkey", F.lit("Gender"),
                F.when(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), "male").otherwise("female")),
        answers(c, "subject", F.col("c_custkey"), "c_custkey", F.lit("Primary Language"),
                F.when(F.col("c_nationkey") < 12, "Afrikaans").otherwise("Dutch")),
        answers(o, "session", F.col("o_orderkey"), "o_orderkey", F.lit("Analysis Steps"),
                F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("preprocessing "), "o_orderpriority")).otherwise("none")),
        answers(n, "study", key, "n_nationkey", F.lit("Institute"), F.concat(F.lit("Institute "), region)),
        answers(n, "study", key, "n_nationkey", F.lit("Grant ID"), F.concat(F.lit("G"), region)),
        answers(n, "study", key, "n_nationkey", F.lit("Type"), F.when(region != 4, "sensor").otherwise("camera")),
        answers(n, "study", key, "n_nationkey", F.lit("Stimuli"), F.when(region < 3, "VisualStims").otherwise("Audio")),
        answers(n, "study", key, "n_nationkey", F.lit("Responses"), F.when(key < 20, "ButtonPress and voice").otherwise("voice")),
    ]
    every = answers(e, "subject", F.col("event_id"), "user_id", label, text)
    for f in frames:
        every = every.unionByName(f)
    resource = lambda df, gone: df.select(F.col("questionnaire_response_item_uri").alias("resource_uri"), gone.alias("deprecated"))
    sent = resource(answers(e.filter("value >= 5 and value <= 180"), "subject", F.col("event_id"), "user_id", label, text), F.lit(False))
    sent = sent.unionByName(resource(answers(e.filter("value > 180"), "subject", F.col("event_id"), "user_id", label, text), F.lit(True)))
    for f in frames:
        sent = sent.unionByName(resource(f, F.lit(False)))
    return every, sent


def _event_sql(event, yes, no):
    return f"(select distinct user_id, case when value >= 60 then '{yes}' else '{no}' end as a from events where event_type = '{event}' and value >= 5 and value <= 180)"


_TRAINING, _EYE = _event_sql("click", "yes", "no"), _event_sql("view", "right", "left")
_HISTORY, _RACE = _event_sql("purchase", "depression, mild", "none"), _event_sql("signup", "asian", "white")


@query(
    f"""select distinct n_name as study_id, c_name as subject_id, o_orderkey as session_id, cast(l_linenumber as varchar) as acquisition_id,
      l_returnflag as acquisition_description, 'male' as "Gender", 'Afrikaans' as "Primary___Language", t.a as "Musical___Training",
      'preprocessing ' || o_orderpriority as "Analysis___Steps"
      from {CHAIN} join {_TRAINING} t on t.user_id = c_custkey
      where l_returnflag <> 'N' and l_linenumber = 3 and c_mktsegment in ('BUILDING', 'FURNITURE') and c_nationkey < 12
        and o_orderstatus = 'F' and t.a = 'yes'"""
)
def cohort_by_scan_name(spark, d):
    return cohorts.by_scan_name(Tables(spark, d), "3", "male", "Afrikaans", "preprocessing", "yes")


@query(
    f"""select distinct n_name as study_id, c_name as subject_id, o_orderkey as session_id, cast(l_linenumber as varchar) as acquisition_id,
      'M' || l_suppkey as device_manufacturer, e.a as "Eye___Dominance", h.a as "Psychiatric___History"
      from {CHAIN} join {_EYE} e on e.user_id = c_custkey join {_HISTORY} h on h.user_id = c_custkey
      where l_suppkey = 7 and e.a = 'right' and starts_with(h.a, 'depression')"""
)
def cohort_by_manufacturer(spark, d):
    return cohorts.by_manufacturer(Tables(spark, d), "M7", "right", "depression")


@query(
    f"""select distinct n_name as study_id, c_name as subject_id, o_orderkey as session_id, cast(l_linenumber as varchar) as acquisition_id,
      '50' as "powerLineFrequency", 'Institute ' || n_regionkey as "Institute", 'G' || n_regionkey as "Grant___ID", e.a as "Eye___Dominance",
      h.a as "Psychiatric___History", r.a as "Race"
      from {CHAIN} join {_EYE} e on e.user_id = c_custkey left join {_HISTORY} h on h.user_id = c_custkey join {_RACE} r on r.user_id = c_custkey
      where l_returnflag = 'R' and n_regionkey = 1 and e.a = 'right' and r.a = 'asian'"""
)
def cohort_by_power_line(spark, d):
    return cohorts.by_power_line(Tables(spark, d), "50", "asian", "right", "Institute 1", "G1")


@query(
    """select distinct n_name as study_id, c_name as subject_id, 'Institute ' || n_regionkey as "Institute", 'ButtonPress and voice' as "Responses",
      'VisualStims' as "Stimuli", 'sensor' as "Type" from customer join nation on c_nationkey = n_nationkey where n_regionkey < 3 and n_nationkey < 20"""
)
def cohort_by_device_type(spark, d):
    return cohorts.by_device_type(Tables(spark, d), "sensor", "VisualStims", "ButtonPress")


@query(
    """select case when p_size > 25 then 'urn:group:' || p_brand else 'urn:form:' || p_type end as s,
      'fhir:Questionnaire.item' || case when p_size > 25 then '.item' else '' end as p, 'urn:item:' || p_partkey as o from part"""
)
def question_edges(spark, d):
    """Form or group → question, from the reverse links of the documents."""
    return Li.document_edges(documents.linked_questions(spark, d))


@query(
    """select 'urn:item:' || p_type as s, 'fhir:Questionnaire.item.answerOption' as p, 'urn:option:' || p_partkey as o from part where p_size > 5"""
)
def option_edges(spark, d):
    return Li.document_edges(documents.linked_options(spark, d))


@query(
    """select 'urn:answer:' || event_id as s, 'fhir:QuestionnaireResponse.item.definition' as p, 'urn:item:' || event_type as o
      from events where event_type <> 'signup'"""
)
def answer_definition_edges(spark, d):
    return Li.document_edges(documents.linked_answers(spark, d)).filter("p like '%.definition'")


@query(
    f"""select 'urn:answer:' || event_id as s, 'fhir:QuestionnaireResponse.item.definition' as p, 'urn:item:' || event_type as o
      from events where event_type <> 'signup'
    union all select 'urn:answer:' || event_id, 'prov:wasGeneratedBy', 'urn:study' from events
    union all select s, p, o from ({ANSWER_EDGES})"""
)
def answer_document_edges(spark, d):
    """Every link of an answer's document: owner, list element, question and study."""
    return Li.document_edges(documents.linked_answers(spark, d))


@query(
    """with kept as (select * from (values ('dcterms:isPartOf'), ('prov:wasAssociatedWith'), ('prov:qualifiedAssociation/prov:agent'),
        ('prov:qualifiedAssociation/prov:hadRole')) v(p))
      select 'urn:session:' || o_orderkey as s, p, case p when 'dcterms:isPartOf' then 'urn:study:' || o_orderstatus
        when 'prov:qualifiedAssociation/prov:hadRole' then 'sio:Subject' else 'urn:subject:' || o_custkey end as o from orders, kept"""
)
def session_document_edges(spark, d):
    """Links through objects without an id of their own are joined to one path."""
    rows = table(spark, d, "orders").select(
        F.concat(F.lit("urn:session:"), "o_orderkey").alias("session_uri"), F.concat(F.lit("urn:subject:"), "o_custkey").alias("research_subject_uri"),
        F.concat(F.lit("urn:study:"), "o_orderstatus").alias("research_study_uri"), F.col("o_orderkey").cast("string").alias("session_id"),
        F.col("o_orderdate").alias("session_date"),
    )
    return Li.document_edges(Li.link_rows(rows, "session", "session_uri"))


@query(
    """with recursive line as (select distinct l_orderkey, l_linenumber from lineitem),
    edge as (select 'R' || o_custkey as s, 'I' || o_orderkey as o from orders
      union all select 'I' || o_orderkey, 'I' || o_orderkey || '.' || l_linenumber from line join orders on l_orderkey = o_orderkey),
    pair as (select s as root, o as node from edge union select pair.root, edge.o from pair join edge on pair.node = edge.s)
    select root, node from pair"""
)
def reachable_items(spark, d):
    """Customers' orders with their lines: each response and item with all items below it."""
    o, l = table(spark, d, "orders"), table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    response = F.concat(F.lit("R"), "o_custkey").alias("response")
    item = lambda path: [F.concat(F.lit("I"), path).alias("item"), path.alias("path")]
    top = o.select(response, *item(F.col("o_orderkey").cast("string")))
    below = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(response, *item(F.concat_ws(".", "o_orderkey", "l_linenumber")))
    return G.reachable_items(top.unionByName(below), "response", "item", "path")

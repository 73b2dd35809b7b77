"""Delta queries. Both versions hold every row of the table: the new one has some keys renamed (old key
deleted, new key inserted) and some values changed."""

from pyspark.sql import functions as F

from labmeta.functions.keys import random_uri, surrogate_uri, uri_from_seed
from labmeta.operators.delta import (
    apply_delta, classify_delta, drop_all_copies, duplicate_groups, is_option_type, keep_copies, match_keys, replace_scope,
)
from labmeta.operators.enrich import changed_since
from queries.registry import NAMING, PROC_DT, apply_sql, classify_sql, query, table, ts, uri_sql


def _audit(key):
    return [
        ts("2020-01-01 00:00:00").alias("_createdat"),
        ts("2020-01-02 00:00:00").alias("_updatedat"),
        (F.col(key) % 3 + 1).cast("int").alias("_rev"),
    ]


def _audit_sql(key):
    return (
        f"timestamp '2020-01-01' as _createdat, timestamp '2020-01-02' as _updatedat, cast({key} % 3 + 1 as integer) as _rev"
    )


CUSTOMER_KEY, CUSTOMER_VALUES = ["c_custkey", "segment"], ["c_name", "c_acctbal"]
CUSTOMER_PREV = f"""select c_custkey, nullif(c_mktsegment, 'MACHINERY') as segment, c_name, c_acctbal,
  'urn:old:' || c_custkey as customer_uri, {_audit_sql('c_custkey')} from customer"""
CUSTOMER_CURR = """select c_custkey,
  case when c_mktsegment = 'BUILDING' then 'HOUSE' else nullif(c_mktsegment, 'MACHINERY') end as segment,
  c_name, case when c_acctbal < 0 then null else c_acctbal end as c_acctbal from customer"""


def customer_versions(spark, d):
    c = table(spark, d, "customer")
    old_segment = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    new_segment = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("HOUSE")).otherwise(old_segment)
    prev = c.select(
        "c_custkey", old_segment.alias("segment"), "c_name", "c_acctbal",
        F.concat(F.lit("urn:old:"), "c_custkey").alias("customer_uri"), *_audit("c_custkey"),
    )
    curr = c.select(
        "c_custkey", new_segment.alias("segment"), "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal")
    )
    return prev, curr


CUSTOMER_DELTA = classify_sql(CUSTOMER_PREV, CUSTOMER_CURR, CUSTOMER_KEY, CUSTOMER_VALUES, "customer_uri")


@query(CUSTOMER_DELTA)
def delta_classify(spark, d):
    return classify_delta(*customer_versions(spark, d), CUSTOMER_KEY, "customer_uri")


@query(apply_sql(CUSTOMER_DELTA, CUSTOMER_KEY + CUSTOMER_VALUES, "customer_uri", uri_sql(*CUSTOMER_KEY)))
def delta_apply(spark, d):
    delta = classify_delta(*customer_versions(spark, d), CUSTOMER_KEY, "customer_uri")
    return apply_delta(delta, PROC_DT, "customer_uri", NAMING.base, CUSTOMER_KEY, NAMING.salt)


@query(
    f"""with first_load as ({apply_sql(CUSTOMER_DELTA, CUSTOMER_KEY + CUSTOMER_VALUES, "customer_uri", uri_sql(*CUSTOMER_KEY))})
    select c_custkey, segment, customer_uri, _rev, 'NOCHANGE' as delta_action from first_load"""
)
def delta_rerun(spark, d):
    """The same input again: every key is unchanged and keeps its URI and revision."""
    prev, curr = customer_versions(spark, d)
    stored = apply_delta(
        classify_delta(prev, curr, CUSTOMER_KEY, "customer_uri"), PROC_DT, "customer_uri", NAMING.base, CUSTOMER_KEY, NAMING.salt
    )
    again = classify_delta(stored, curr, CUSTOMER_KEY, "customer_uri", check=False)
    return again.select("c_custkey", "segment", "customer_uri", "_rev", "delta_action")


@query(
    f"""select c_custkey, c_name, {uri_sql("c_custkey")} as customer_uri, timestamp '{PROC_DT}' as _createdat,
      timestamp '{PROC_DT}' as _updatedat, cast(1 as integer) as _rev from customer"""
)
def delta_empty_base(spark, d):
    """Nothing stored yet: every key is an insert."""
    curr = table(spark, d, "customer").select("c_custkey", "c_name")
    schema = "c_custkey long, c_name string, customer_uri string, _createdat timestamp_ntz, _updatedat timestamp_ntz, _rev int"
    delta = classify_delta(spark.createDataFrame([], schema), curr, ["c_custkey"], "customer_uri")
    return apply_delta(delta, PROC_DT, "customer_uri", NAMING.base, ["c_custkey"], NAMING.salt)


SUPPLIER_PREV = f"""select s_suppkey, nullif(s_nationkey, 3) as nation, s_acctbal, 'urn:old:' || s_suppkey as supplier_uri,
  {_audit_sql('s_suppkey')} from supplier"""
SUPPLIER_CURR = """select s_suppkey, nullif(nullif(s_nationkey, 3), 7) as nation,
  case when s_acctbal > 5000 then 5000 else s_acctbal end as s_acctbal from supplier"""


def supplier_versions(spark, d):
    s = table(spark, d, "supplier")
    nation = F.nullif(F.col("s_nationkey"), F.lit(3))
    prev = s.select(
        "s_suppkey", nation.alias("nation"), "s_acctbal", F.concat(F.lit("urn:old:"), "s_suppkey").alias("supplier_uri"),
        *_audit("s_suppkey"),
    )
    curr = s.select("s_suppkey", F.nullif(nation, F.lit(7)).alias("nation"), F.least("s_acctbal", F.lit(5000.0)).alias("s_acctbal"))
    return prev, curr


@query(classify_sql(SUPPLIER_PREV, SUPPLIER_CURR, ["s_suppkey", "nation"], ["s_acctbal"], "supplier_uri"))
def delta_null_keys(spark, d):
    """A null key part matches a null key part only."""
    return classify_delta(*supplier_versions(spark, d), ["s_suppkey", "nation"], "supplier_uri")


ORDERS_PREV = f"""select o_orderkey, nullif(o_orderpriority, '5-LOW') as priority, o_orderstatus, o_totalprice,
  'urn:old:' || o_orderkey as order_uri, {_audit_sql('o_orderkey')} from orders"""
ORDERS_CURR = """select o_orderkey, nullif(case when o_orderpriority = '2-HIGH' then '1-URGENT' else o_orderpriority end, '5-LOW') as priority,
  case when o_orderdate < timestamp '1996-01-01' then 'F' else o_orderstatus end as o_orderstatus, o_totalprice from orders"""


def order_versions(spark, d):
    o = table(spark, d, "orders")
    priority = F.col("o_orderpriority")
    prev = o.select(
        "o_orderkey", F.nullif(priority, F.lit("5-LOW")).alias("priority"), "o_orderstatus", "o_totalprice",
        F.concat(F.lit("urn:old:"), "o_orderkey").alias("order_uri"), *_audit("o_orderkey"),
    )
    moved = F.when(priority == "2-HIGH", F.lit("1-URGENT")).otherwise(priority)
    status = F.when(F.col("o_orderdate") < ts("1996-01-01 00:00:00"), F.lit("F")).otherwise(F.col("o_orderstatus"))
    curr = o.select(
        "o_orderkey", F.nullif(moved, F.lit("5-LOW")).alias("priority"), status.alias("o_orderstatus"), "o_totalprice"
    )
    return prev, curr


ORDERS_DELTA = classify_sql(ORDERS_PREV, ORDERS_CURR, ["o_orderkey", "priority"], ["o_orderstatus", "o_totalprice"], "order_uri")


@query(f"select delta_action, count(*) as n from ({ORDERS_DELTA}) group by delta_action")
def delta_counts(spark, d):
    delta = classify_delta(*order_versions(spark, d), ["o_orderkey", "priority"], "order_uri")
    return delta.groupBy("delta_action").agg(F.count(F.lit(1)).alias("n"))


DOC_PREV = f"select doc_id, source, text, 'urn:old:' || doc_id as doc_uri, {_audit_sql('doc_id')} from documents"
DOC_CURR = "select doc_id, source, case when lang = 'de' then text || '!' else text end as text from documents"


@query(classify_sql(DOC_PREV, DOC_CURR, ["doc_id"], ["source", "text"], "doc_uri"))
def delta_wide_text(spark, d):
    """Long texts are compared whole, by digest; the stored text is not shuffled."""
    docs = table(spark, d, "documents")
    prev = docs.select("doc_id", "source", "text", F.concat(F.lit("urn:old:"), "doc_id").alias("doc_uri"), *_audit("doc_id"))
    text = F.when(F.col("lang") == "de", F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    curr = docs.select("doc_id", "source", text.alias("text"))
    return classify_delta(prev, curr, ["doc_id"], "doc_uri", wide=["text"])


TYPE_SQL = """case p_type when 'ECONOMY' then 'select' when 'SMALL' then 'radio' when 'MEDIUM' then 'selectboxes'
  when 'LARGE' then 'xnatSelect' else 'textfield' end"""
PART_PREV = f"""select p_partkey, p_name, {TYPE_SQL} as question_type, p_retailprice, 'urn:old:' || p_partkey as part_uri,
  {_audit_sql('p_partkey')} from part"""
PART_CURR = f"""select p_partkey, case when p_size > 40 then 'big ' || p_name else p_name end as p_name, {TYPE_SQL} as question_type,
  case when p_size < 5 then 0 else p_retailprice end as p_retailprice from part"""
PART_KEY = ["p_partkey", "p_name"]
PART_DELTA = classify_sql(PART_PREV, PART_CURR, PART_KEY, ["question_type", "p_retailprice"], "part_uri")


def part_delta(spark, d):
    p = table(spark, d, "part")
    t = F.col("p_type")
    kind = (
        F.when(t == "ECONOMY", "select").when(t == "SMALL", "radio").when(t == "MEDIUM", "selectboxes")
        .when(t == "LARGE", "xnatSelect").otherwise("textfield").alias("question_type")
    )
    prev = p.select("p_partkey", "p_name", kind, "p_retailprice", F.concat(F.lit("urn:old:"), "p_partkey").alias("part_uri"), *_audit("p_partkey"))
    name = F.when(F.col("p_size") > 40, F.concat(F.lit("big "), "p_name")).otherwise(F.col("p_name"))
    price = F.when(F.col("p_size") < 5, F.lit(0.0)).otherwise(F.col("p_retailprice"))
    curr = p.select("p_partkey", name.alias("p_name"), kind, price.alias("p_retailprice"))
    return classify_delta(prev, curr, PART_KEY, "part_uri")


PART_COLUMNS = PART_KEY + ["question_type", "p_retailprice"]


@query(
    apply_sql(
        PART_DELTA, PART_COLUMNS, "part_uri",
        f"case when question_type in ('select', 'xnatSelect', 'radio', 'selectboxes') then {uri_sql(*PART_KEY)} end",
    )
)
def delta_options(spark, d):
    """Only option-type questions get a URI."""
    return apply_delta(
        part_delta(spark, d), PROC_DT, "part_uri", NAMING.base, PART_KEY, NAMING.salt, uri_when=is_option_type()
    )


@query(apply_sql(PART_DELTA, PART_COLUMNS, "part_uri", "null"))
def delta_without_uri(spark, d):
    """URI generation switched off."""
    return apply_delta(part_delta(spark, d), PROC_DT, "part_uri", NAMING.base, PART_KEY, NAMING.salt, generate=False)


@query(
    """select * from orders where o_orderstatus <> 'F'
    union all select o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2, o_orderdate, o_orderpriority from orders
      where o_orderstatus = 'F'"""
)
def replace_scope_status(spark, d):
    orders = table(spark, d, "orders")
    load = orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return replace_scope(orders, load, F.col("o_orderstatus") == "F")


@query("select * from customer where c_nationkey not in (select n_nationkey from nation where n_regionkey = 1)")
def replace_scope_empty_load(spark, d):
    """An empty load empties its scope."""
    customer, nation = table(spark, d, "customer"), table(spark, d, "nation")
    scope = nation.filter("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    nothing = spark.createDataFrame([], customer.schema)
    return replace_scope(customer, nothing, scope)


@query("select sha256(text) as digest, count(*) as copies from documents group by 1 having count(*) > 1")
def duplicate_keys(spark, d):
    """Texts held by several documents. The digest of the whole text is the key, so texts are not shuffled."""
    docs = table(spark, d, "documents").select(F.sha2("text", 256).alias("digest"))
    return duplicate_groups(docs, ["digest"])


@query(
    """select any_value(doc_id) as doc_id, digest, any_value(lang) as lang from
       (select doc_id, sha256(text) as digest, lang from documents) group by digest having count(*) = 1"""
)
def drop_copies(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"), "lang")
    return drop_all_copies(docs, ["digest"])


@query(
    """with x as (select doc_id, sha256(text) as digest, lang from documents)
       select * from x where digest in (select digest from x group by digest having count(*) > 1)"""
)
def keep_repeated(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"), "lang")
    return keep_copies(docs, ["digest"])


@query(f"select *, {uri_sql('c_custkey', 'c_name', 'nullif(c_mktsegment, $$BUILDING$$)')} as uri from customer")
def surrogate_uris(spark, d):
    c = table(spark, d, "customer")
    parts = [F.col("c_custkey"), F.col("c_name"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))]
    return c.select("*", surrogate_uri(NAMING.base, parts, NAMING.salt).alias("uri"))


SEED_SHAPE = r"regexp_replace(sha256(text), '^(.{8})(.{4}).(.{3}).(.{3})(.{12}).*$', '\1-\2-4\3-8\4-\5')"


@query(f"select doc_id, 'urn:lab:' || {SEED_SHAPE} as uri from documents")
def seed_uris(spark, d):
    return table(spark, d, "documents").select("doc_id", uri_from_seed(NAMING.base, F.col("text")).alias("uri"))


@query("select count(*) as n, count(*) as well_formed from customer")
def random_uris(spark, d):
    """Random values cannot be compared; their number and form can."""
    shape = "^urn:lab:[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    drawn = table(spark, d, "customer").select(random_uri(NAMING.base).alias("uri"))
    return drawn.agg(F.count("uri").alias("n"), F.count_if(F.col("uri").rlike(shape)).alias("well_formed"))


CHANGED_SQL = """
  with log as (select event_type as resource_type, min(ts) + interval 10 day as last_success_load_ts from events group by event_type)
  select event_id, ts as _updatedat, user_id, event_type from events
  where ts > coalesce((select max(last_success_load_ts) from log where resource_type = '{0}'), timestamp '1990-01-01')"""


def _event_log(spark, d):
    events = table(spark, d, "events")
    log = events.groupBy(F.col("event_type").alias("resource_type")).agg(
        (F.min("ts") + F.expr("interval 10 days")).alias("last_success_load_ts")
    )
    return events.select("event_id", F.col("ts").alias("_updatedat"), "user_id", "event_type"), log


@query(CHANGED_SQL.format("click"))
def changed_rows_since(spark, d):
    return changed_since(*_event_log(spark, d), "click")


@query(CHANGED_SQL.format("never logged"))
def changed_rows_first_load(spark, d):
    return changed_since(*_event_log(spark, d), "never logged")


@query(
    """select o_orderkey, o_custkey from orders o where exists
       (select 1 from customer c where c.c_custkey = o.o_custkey and nullif(c.c_mktsegment, 'MACHINERY') is not distinct from null)"""
)
def match_null_keys(spark, d):
    """Semi-join where a null key matches a null key."""
    customer = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment")
    )
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.lit(None).cast("string").alias("segment"))
    return match_keys(orders, customer, ["o_custkey", "segment"], "left_semi").select("o_orderkey", "o_custkey")


@query(
    """select event_id, case when event_type = 'view' and value >= 60 and user_id <> 1 then 'UPDATE' else 'NOCHANGE' end as delta_action,
      case event_type when 'click' then '{ "k": ' || (props ->> '$.k') || ',"user":[' || user_id || ',  1 ]}'
        when 'view' then '{"user": [' || case when value >= 60 then '1, ' || user_id else user_id || ', 1' end || '], "k": ' || (props ->> '$.k') || '}'
        else '{"user": [' || user_id || ', 1], "k": ' || (props ->> '$.k') || '}' end as doc from events"""
)
def delta_json_documents(spark, d):
    """Spacing and the order of keys are no change, the order of a list is."""
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k"))
    doc = F.concat(F.lit('{"user": ['), "user_id", F.lit(', 1], "k": '), "k", F.lit("}"))
    moved = F.concat(F.lit('{ "k": '), "k", F.lit(',"user":['), "user_id", F.lit(",  1 ]}"))
    turned = F.concat(F.lit('{"user": [1, '), "user_id", F.lit('], "k": '), "k", F.lit("}"))
    prev = e.select("event_id", doc.alias("doc"), F.concat(F.lit("urn:"), "event_id").alias("uri"), *_audit("event_id"))
    kind = F.col("event_type")
    curr = e.select("event_id", F.when(kind == "click", moved).when((kind == "view") & (F.col("value") >= 60), turned).otherwise(doc).alias("doc"))
    return classify_delta(prev, curr, ["event_id"], "uri", documents=["doc"]).select("event_id", "delta_action", "doc")

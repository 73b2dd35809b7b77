"""Projection, filter and scalar-function queries."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from labmeta.functions import text as X
from labmeta.operators import align as Al
from labmeta.operators import cohort as Co
from labmeta.sources.tables import spread
from queries.registry import query, table

LINE_SCHEMA = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.LongType()),
        T.StructField("l_discount", T.DoubleType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
        T.StructField("open_flag", T.BooleanType()),
    ]
)


@query(
    """select l_orderkey, l_linenumber, cast(l_quantity as bigint) as l_quantity, l_discount,
      l_shipdate, l_linestatus = 'O' as open_flag, l_returnflag from lineitem"""
)
def align_types(spark, d):
    """Text columns to declared types; decimal text reads into a whole number, extra columns pass through."""
    line = table(spark, d, "lineitem")
    texts = line.select(
        F.col("l_orderkey").cast("string"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(".0")).alias("l_linenumber"),
        F.col("l_quantity").cast("string"),
        F.col("l_discount").cast("string"),
        F.col("l_shipdate").cast("string"),
        F.when(F.col("l_linestatus") == "O", "true").otherwise("false").alias("open_flag"),
        "l_returnflag",
    )
    return Al.align_to_schema(texts, LINE_SCHEMA)


@query("select p_partkey, p_name, p_size, cast(null as varchar) as p_note from part")
def conform_strict(spark, d):
    """Missing columns become null, then the column set must equal the declared one."""
    schema = T.StructType.fromDDL("p_partkey bigint, p_name string, p_size int, p_note string")
    return Al.align_to_schema(Al.conform(table(spark, d, "part"), schema), schema, strict=True)


@query(
    """select l_orderkey, cast(floor(l_quantity) as bigint) as whole_quantity, nullif(l_returnflag, 'N') as flag from lineitem"""
)
def cast_keeps_null(spark, d):
    line = table(spark, d, "lineitem")
    return line.select(
        "l_orderkey",
        Al.cast_keep_null(F.col("l_quantity").cast("string"), "bigint", via_double=True).alias("whole_quantity"),
        Al.cast_keep_null(F.nullif(F.col("l_returnflag"), F.lit("N")), "string").alias("flag"),
    )


@query(
    """select event_id, nullif(event_type, 'click') as event_type, case when user_id % 2 = 0 then props end as props from events"""
)
def blanks_become_null(spark, d):
    e = table(spark, d, "events").select(
        "event_id",
        F.when(F.col("event_type") == "click", F.lit("")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("user_id") % 2 == 0, F.col("props"))
        .when(F.col("user_id") % 3 == 0, F.lit("[]")).otherwise(F.lit("['']")).alias("props"),
    )
    return Al.blanks_to_null(e, X.BLANK_ANSWERS)


@query("select event_id, case when value >= 10 then value end as value from events")
def nans_become_null(spark, d):
    e = table(spark, d, "events")
    value = F.when(F.col("value") >= 10, F.col("value")).otherwise(F.lit(float("nan")))
    return Al.nans_to_null(e.select("event_id", value.alias("value")))


@query(
    """select o_orderkey, case when o_orderstatus = 'O' then null else o_orderdate + interval 7 hour end as started from orders"""
)
def joined_date_time(spark, d):
    o = table(spark, d, "orders")
    date = F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", X.join_date_time(date, F.lit("07:00:00")).alias("started"))


@query(
    """select event_id, case when event_type = 'view' then '{}' else props end as doc,
      case when event_type = 'view' then '{}' else '{"k":' || cast(json_extract(props, '$.k') as varchar) || '}' end as canonical
      from events"""
)
def json_documents(spark, d):
    """Empty documents get the default; two texts of one document share their canonical form."""
    e = table(spark, d, "events")
    doc = X.json_or_default(F.when(F.col("event_type") != "view", F.col("props")))
    return e.select("event_id", doc.alias("doc"), X.canonical_json(doc).alias("canonical"))


@query(
    """select p_partkey, 'bids:Brand' as key, p_brand as value from part
    union all select p_partkey, 'gnmd:Size', cast(p_size as varchar) from part"""
)
def header_keys_kept(spark, d):
    p = table(spark, d, "part")
    fields = F.create_map(
        F.lit("parameters/bids_Brand"), F.col("p_brand"),
        F.lit("parameters/gnmd_Size"), F.col("p_size").cast("string"),
        F.lit("quality"), F.col("p_type"),
    )
    return p.select("p_partkey", F.explode(X.header_keys(fields)).alias("key", "value"))


@query("select o_orderkey, o_orderpriority from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT'")
def scope_of_rows(spark, d):
    """Study and subject predicates reach the Parquet scan."""
    o = table(spark, d, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.col("o_orderstatus").alias("research_study_id"),
        F.col("o_orderpriority").alias("research_subject_id"),
        F.lit("xnat_project_id").alias("research_study_id_type"),
    )
    return Al.scope_filter(o, study="F", subject="1-URGENT").select("o_orderkey", "o_orderpriority")


@query("select event_id, props from events where event_type not in ('view', 'click')")
def documents_not_empty(spark, d):
    e = table(spark, d, "events")
    doc = F.when(F.col("event_type") == "view", F.lit("{}")).when(F.col("event_type") != "click", F.col("props"))
    return Al.nonempty_docs(e.select("event_id", doc.alias("props")), "props")


@query(
    r"""select doc_id, replace(text, '\', '\\') as backslashes,
      regexp_replace(text, '\r\n|\r|\n', '\\r', 'g') as newlines from documents"""
)
def escaped_text(spark, d):
    docs = table(spark, d, "documents")
    return docs.select(
        "doc_id", X.escape_backslash(F.col("text")).alias("backslashes"), X.escape_newlines(F.col("text")).alias("newlines")
    )


TOKENS = (
    r"(?is)<!--.*?(?:-->|\z)|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)|<[!?][^>]*(?:>|\z)"
    r"""|</?[a-z](?:"[^"]*"|''[^'']*''|[^''">]+)*(?:>|\z)|[^<]+|<"""
)
# The entities that the pages hold.
DECODED = "tok"
for _entity, _char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&"), ("&amp", "&")):
    DECODED = f"replace({DECODED}, '{_entity}', '{_char if _char != '&' else chr(1)}')"
DECODED = f"replace({DECODED}, chr(1), '&')"


@query(
    rf"""with tokens as (
      select page_id, unnest(t) as tok, generate_subscripts(t, 1) as i
      from (select page_id, regexp_extract_all(html, '{TOKENS}') as t from pages)),
    kept as (
      select page_id, i, case when not starts_with(tok, '<') or tok = '<' then {DECODED}
        when regexp_matches(tok, '(?i)^<(script|style)\b')
          then regexp_extract(tok, '(?is)^<(?:script|style)\b[^>]*>(.*)</(?:script|style)\s*>$', 1)
        else '' end as txt from tokens)
    select p.page_id, coalesce(string_agg(txt, '' order by i), '') as text
    from pages p left join kept k on p.page_id = k.page_id group by p.page_id"""
)
def stripped_html(spark, d):
    return spread(table(spark, d, "pages")).select("page_id", X.strip_html(F.col("html")).alias("text"))


@query("select n_nationkey as key, n_name as label, 'study' as kind, 1 as version from nation")
def projected(spark, d):
    n = table(spark, d, "nation").withColumn("kind", F.lit("old"))
    return Al.project(
        n, drop=["n_regionkey"], rename={"n_nationkey": "key", "n_name": "label"}, constants={"kind": "study", "version": 1}
    )


@query(
    """select l_orderkey, l_linenumber, cast(l_orderkey as varchar) as top,
      l_orderkey || '.' || l_linenumber as parent from lineitem"""
)
def parent_of_index(spark, d):
    line = table(spark, d, "lineitem")
    index = F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey")
    parent = X.parent_index(index)
    return line.select("l_orderkey", "l_linenumber", X.parent_index(parent).alias("top"), parent.alias("parent"))


@query(
    """select p_partkey, p_name = 'red bolt' as same, contains(p_name, 'bolt') as holds, starts_with(p_name, 'red') as begins,
      instr(p_name, 'ed') <> 2 as not_second from part"""
)
def text_predicates(spark, d):
    name = F.col("p_name")
    return table(spark, d, "part").select(
        "p_partkey",
        Co.equals(name, "red bolt").alias("same"),
        Co.contains(name, "bolt").alias("holds"),
        Co.starts_with(name, "red").alias("begins"),
        Co.not_at_second_position(name, "ed").alias("not_second"),
    )


@query(
    """select p_partkey, 'DICOM:' || lpad(cast(p_size as varchar), 4, '0') || '_' || lpad(substr(p_brand, 7), 4, '0') as term from part"""
)
def tag_terms(spark, d):
    p = table(spark, d, "part")
    tag = F.format_string("(%s,%s)", F.lpad(F.col("p_size").cast("string"), 4, "0"), F.lpad(F.substring("p_brand", 7, 9), 4, "0"))
    return p.select("p_partkey", X.tag_to_term(tag).alias("term"))


@query(
    """select doc_id, quality, toxic from labels where (case when quality = 1 then 1 end) is not null or (case when toxic = 1 then 1 end) is not null"""
)
def rows_with_target(spark, d):
    one = table(spark, d, "labels").withColumns(
        {"_q": F.when(F.col("quality") == 1, 1), "_t": F.when(F.col("toxic") == 1, 1)}
    )
    return Al.require_present(one, "_q", "_t", any_of=True).drop("_q", "_t")

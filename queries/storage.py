"""Source, sink and load queries. Landed files are written by Spark from the given tables into a new folder
below the session's shared folder, then read back by the library's readers."""

from pyspark.sql import functions as F

from labmeta.operators import graph as G
from labmeta.plans import loaders, sync
from labmeta.sources import landed as L
from labmeta.sources.tables import Warehouse, append_rows, overwrite_partitions, shared_folder
from labmeta.streaming.ingest import ingest_stream
from queries.cohorts import resources
from queries.deltas import supplier_versions
from queries.registry import NAMING, PROC_DT, SQL, query, table, uri_sql


def land_text(spark, df, name):
    path = f"{shared_folder(spark)}/{name}"
    df.write.text(path)
    return path


#: JSON Lines repeat their field names in every line, so they land compressed. A compressed file is read by one task, so
#: it ends after so many lines.
COMPRESSED = {"compression": "gzip", "maxRecordsPerFile": 100_000}
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def land_json(spark, df, name):
    path = f"{shared_folder(spark)}/{name}"
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.options(**COMPRESSED).text(path)
    return path


def project_files(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    xml = F.concat(
        F.lit('<xnat:Project ID="'), F.col("n_nationkey"), F.lit('" active="1" xmlns:xnat="http://example.org/xnat"><xnat:name>'),
        F.col("n_name"), F.lit(" &amp; more</xnat:name>"),
        F.when(F.col("r_name") == "ASIA", F.lit("<xnat:description></xnat:description>"))
        .otherwise(F.concat(F.lit("<xnat:description>"), "r_name", F.lit("</xnat:description>"))),
        F.lit('<xnat:custom_fields>{"a": "'), F.col("r_name"), F.lit('"}</xnat:custom_fields></xnat:Project>'),
    )
    return land_text(spark, n.select(xml.alias("value")), "projects")


@query(
    """select 'lab' as src_system, cast(n_nationkey as varchar) as research_study_id, 'xnat_project_id' as research_study_id_type,
      n_name || ' & more' as research_study_title, nullif(r_name, 'ASIA') as research_study_description, cast(null as varchar) as research_study_site,
      '1' as research_study_status, '{"a": "' || r_name || '"}' as xnat_custom_fields
      from nation join region on n_regionkey = r_regionkey"""
)
def read_projects(spark, d):
    return L.read_projects(spark, project_files(spark, d), "lab", lines=True)


def subject_files(spark, d):
    c = table(spark, d, "customer")
    fields = F.when(
        F.col("c_mktsegment") != "BUILDING",
        F.concat(F.lit('<xnat:custom_fields>{"segment": "'), "c_mktsegment", F.lit('"}</xnat:custom_fields>')),
    ).otherwise(F.lit(""))
    xml = F.concat(
        F.lit('<xnat:Subject label="'), F.col("c_name"), F.lit('" project="'), F.col("c_nationkey"),
        F.lit('" xmlns:xnat="http://example.org/xnat"><xnat:group>g</xnat:group>'), fields, F.lit("</xnat:Subject>"),
    )
    return land_text(spark, c.select(xml.alias("value")), "subjects")


_CF = """case when c_mktsegment = 'BUILDING' then '{}' else '{"segment": "' || c_mktsegment || '"}' end"""


@query(
    f"""select 'lab' as src_system, c_name as research_subject_id, cast(c_nationkey as varchar) as research_study_id, {_CF} as xnat_custom_fields from customer"""
)
def read_subjects(spark, d):
    return L.read_subjects(spark, subject_files(spark, d), "lab", lines=True)


_SESSION_TYPE = "case o_orderstatus when 'F' then 'Lab:AlphaSessionData' when 'O' then 'lab:betaSessionData' else 'xnat:imageSessionData' end"


def session_files(spark, d):
    o = table(spark, d, "orders")
    status = F.col("o_orderstatus")
    type_ = F.when(status == "F", "Lab:AlphaSessionData").when(status == "O", "lab:betaSessionData").otherwise("xnat:imageSessionData")
    prefix = F.concat(F.lower(type_), F.lit("/"))
    record = F.map_from_arrays(
        F.array(
            F.lit("subject_label"), F.lit("ID"), F.concat(prefix, F.lit("label")), F.concat(prefix, F.lit("date")),
            F.concat(prefix, F.lit("time")), F.concat(prefix, F.lit("custom_fields")),
        ),
        F.array(
            F.col("o_custkey").cast("string"), F.concat(F.lit("ACC"), "o_orderkey"), F.col("o_orderkey").cast("string"),
            F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")), F.lit("01:02:03"),
            F.when(F.col("o_orderpriority") == "2-HIGH", F.lit('{"p":"high"}')).otherwise(F.lit("")),
        ),
    )
    return land_json(
        spark, o.select(F.col("o_orderpriority").alias("project"), type_.alias("session_type"), F.array(record).alias("body")), "sessions"
    )


@query(
    f"""select 'lab' as src_system, o_orderpriority as research_study_id, 'xnat_project_id' as research_study_id_type, cast(o_custkey as varchar) as research_subject_id,
      cast(o_orderkey as varchar) as session_id, 'ACC' || o_orderkey as accession_id, {_SESSION_TYPE} as session_type,
      case when o_orderpriority <> '5-LOW' then o_orderdate + interval '1 hour 2 minutes 3 seconds' end as session_date,
      case when o_orderpriority = '2-HIGH' then '{{"p":"high"}}' else '{{}}' end as xnat_custom_fields
      from orders where o_orderstatus <> 'P'"""
)
def read_sessions(spark, d):
    """Type prefixes come off the field names; the umbrella type is left out."""
    return L.read_sessions(spark, session_files(spark, d), "lab")


def scan_files(spark, d):
    l = table(spark, d, "lineitem")
    s = lambda c: F.col(c).cast("string")
    values = {
        "subject_label": s("l_partkey"), "ID": s("l_orderkey"), "lab:alphasessiondata/label": s("l_orderkey"),
        "lab:alphasessiondata/date": F.date_format("l_shipdate", "yyyy-MM-dd"), "lab:alphasessiondata/time": F.lit("00:00:00"),
        **{f"xnat:imagescandata/{k}": v for k, v in {
            "id": s("l_linenumber"), "type": F.col("l_returnflag"), "modality": F.col("l_linestatus"), "meta/insert_date": F.lit("2020-01-01"),
            "meta/last_modified": F.lit("2020-01-02"), "start_date": F.date_format("l_shipdate", "yyyy-MM-dd"), "starttime": F.lit("10:00:00"),
            "quality": F.lit(""), "scanner/manufacturer": s("l_suppkey"), "scanner/model": F.when(F.col("l_returnflag") == "N", "").otherwise("X"),
            "series_description": F.lit("series"),
        }.items()},
    }
    record = F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*values.values()))
    rows = l.select(F.lit("P").alias("project"), F.lit("lab:alphaSessionData").alias("session_type"), F.array(record).alias("body"))
    return land_json(spark, rows, "scans")


@query(
    """select 'lab' as src_system, 'P' as research_study_id, 'xnat_project_id' as research_study_id_type, cast(l_partkey as varchar) as research_subject_id,
      cast(l_orderkey as varchar) as session_id, cast(l_orderkey as varchar) as accession_id, 'lab:alphaSessionData' as session_type, l_shipdate as session_date,
      cast(l_linenumber as varchar) as acquisition_id, l_returnflag as acquisition_type, l_linestatus as acquisition_modality,
      '2020-01-01' as acquisition_insert_date, '2020-01-02' as acquisition_last_modified, strftime(l_shipdate, '%Y-%m-%d') as acquisition_start_date,
      '10:00:00' as acquisition_start_time, cast(null as varchar) as acquisition_object_quality, cast(l_suppkey as varchar) as device_manufacturer,
      case when l_returnflag <> 'N' then 'X' end as device_name, 'series' as series_description, cast(null as varchar) as xnat_custom_fields from lineitem"""
)
def read_scans(spark, d):
    return L.read_scans(spark, scan_files(spark, d), "lab")


def land_records(spark, rows, name, study):
    """Envelopes of one record each as one record a line, below a folder for each study.

    A task keeps the files of some studies open at once, so that it does not sort, and spill, its rows by study first.
    """
    path = f"{shared_folder(spark)}/{name}"
    record = F.struct("session_type", F.from_json("body", "array<map<string,string>>")[0].alias("record"))
    before = spark.conf.get(_OPEN_FILES, None)
    spark.conf.set(_OPEN_FILES, "32")
    try:
        rows.select(study.alias("project"), F.to_json(record).alias("value")).write.options(**COMPRESSED).partitionBy("project").text(path)
    finally:
        spark.conf.unset(_OPEN_FILES) if before is None else spark.conf.set(_OPEN_FILES, before)
    return path


@query(SQL["read_sessions"])
def read_sessions_by_record(spark, d):
    """As ``read_sessions``, from one record a line."""
    landed = L.read_envelopes(spark, session_files(spark, d), ["project", "session_type"])
    return L.read_sessions(spark, land_records(spark, landed, "session-records", F.col("project")), "lab", by_record=True)


@query(SQL["read_scans"].replace("'P' as research_study_id", "'0' || l_returnflag || '=%/x' as research_study_id"))
def read_scans_by_record(spark, d):
    """One record a line, below a folder for each study, whose id may hold any character."""
    landed = L.read_envelopes(spark, scan_files(spark, d), ["project", "session_type"])
    flag = F.regexp_extract("body", '"xnat:imagescandata/type":"([^"]*)"', 1)
    return L.read_scans(spark, land_records(spark, landed, "scan-records", F.concat(F.lit("0"), flag, F.lit("=%/x"))), "lab", by_record=True)


def dicom_files(spark, d):
    p = table(spark, d, "part")
    tags = F.array(F.struct(F.lit("(0008,0060)").alias("tag1"), F.lit("Modality").alias("desc"), F.col("p_type").alias("value")))
    body = F.struct(F.struct(tags.alias("Result")).alias("ResultSet"))
    return land_json(
        spark,
        p.select(F.col("p_brand").alias("project"), F.lit("s").alias("session_id"), F.col("p_partkey").cast("string").alias("acquisition_id"), body.alias("body")),
        "dicom",
    )


_DUMP = """'[{"tag1":"(0008,0060)","desc":"Modality","value":"' || p_type || '"}]'"""


@query(
    f"""select p_brand as research_study_id, 's' as session_id, cast(p_partkey as varchar) as acquisition_id, {_DUMP} as dicom_header from part"""
)
def read_dicom_dump(spark, d):
    return L.read_dicom_dump(spark, dicom_files(spark, d))


def field_files(spark, d):
    p = table(spark, d, "part")
    fields = F.create_map(
        F.lit("parameters/bids_Brand"), F.concat("p_brand", F.lit(" &amp; co")), F.lit("parameters/gnmd_Size"), F.col("p_size").cast("string"),
        F.lit("quality"), F.lit("usable"),
    )
    body = F.struct(F.array(F.struct(fields.alias("data_fields"))).alias("items"))
    return land_json(
        spark,
        p.select(
            F.col("p_brand").alias("project"), F.col("p_name").alias("subject_id"), F.lit("s").alias("session_id"),
            F.col("p_partkey").cast("string").alias("acquisition_id"), body.alias("body"),
        ),
        "fields",
    )


_MAP = """'{"bids:Brand":"' || p_brand || ' & co","gnmd:Size":"' || p_size || '"}'"""


@query(
    f"""select p_brand as research_study_id, p_name as research_subject_id, 's' as session_id, cast(p_partkey as varchar) as acquisition_id,
      {_MAP} as non_dicom_header from part"""
)
def read_scan_fields(spark, d):
    return L.read_scan_fields(spark, field_files(spark, d))


@query(
    f"""select cast(p_partkey as varchar) as acquisition_id, case when p_type not in ('ECONOMY', 'SMALL', 'LARGE') then {_DUMP} end as dicom_header,
      case when p_type in ('ECONOMY', 'SMALL', 'LARGE') then {_MAP} end as non_dicom_header from part"""
)
def route_headers(spark, d):
    """Three session types take the field map, all others the DICOM dump."""
    t = F.col("p_type")
    kind = (
        F.when(t == "ECONOMY", "fif:megEegSessionData").when(t == "SMALL", "edf:ecogSessionData")
        .when(t == "LARGE", "et:eyetrackerSessionData").otherwise("xnat:mrSessionData")
    )
    scans = table(spark, d, "part").select(
        F.col("p_brand").alias("research_study_id"), F.col("p_name").alias("research_subject_id"), F.lit("s").alias("session_id"),
        F.col("p_partkey").cast("string").alias("acquisition_id"), kind.alias("session_type"),
    )
    dicom = L.read_dicom_dump(spark, dicom_files(spark, d))
    fields = L.read_scan_fields(spark, field_files(spark, d))
    return L.route_headers(scans, dicom, fields).select("acquisition_id", "dicom_header", "non_dicom_header")


@query(
    """select p_brand as research_study_id, 'xnat:subjectData' as xnat_data_type, '{"components":[{"title":"' || p_name || '"}]}' as body from part where p_size > 5"""
)
def read_forms(spark, d):
    p = table(spark, d, "part")
    body = F.struct(F.array(F.struct(F.col("p_name").alias("title"))).alias("components"))
    kind = F.when(F.col("p_size") > 5, "xnat:subjectData").otherwise("xnat:imageSessionData")
    path = land_json(spark, p.select(F.col("p_brand").alias("project"), kind.alias("xnat_data_type"), body.alias("body")), "forms")
    return L.read_forms(spark, path)


@query("select l_orderkey, l_linenumber, l_shipdate from lineitem where l_returnflag = 'R' and l_suppkey = 5")
def scan_table(spark, d):
    """Three columns are read and both predicates reach the scan."""
    return table(spark, d, "lineitem").filter("l_returnflag = 'R' and l_suppkey = 5").select("l_orderkey", "l_linenumber", "l_shipdate")


@query("select c_custkey as key, c_name as name from customer union all select s_suppkey, s_name from supplier")
def append_rows_twice(spark, d):
    path = f"{shared_folder(spark)}/appended"
    append_rows(table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")), path)
    append_rows(table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), path)
    return spark.read.parquet(path)


@query(
    """select o_orderkey, o_orderstatus, case when o_orderstatus = 'F' then o_totalprice * 2 else o_totalprice end as o_totalprice from orders"""
)
def overwrite_scope_partitions(spark, d):
    """Only the partitions of the load are replaced."""
    path = f"{shared_folder(spark)}/partitioned"
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    overwrite_partitions(orders, path, ["o_orderstatus"])
    overwrite_partitions(orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2), path, ["o_orderstatus"])
    return spark.read.schema("o_orderkey bigint, o_totalprice double, o_orderstatus string").parquet(path)


@query(
    """select event_type as resource_type, max(ts) as last_success_load_ts from events group by event_type
    union all select event_type, max(ts) + interval 1 day from events where user_id > 20 group by event_type"""
)
def load_log(spark, d):
    """Two appended loads."""
    wh = Warehouse(spark, shared_folder(spark), NAMING)
    events = table(spark, d, "events")
    marks = lambda df, t: df.groupBy(F.col("event_type").alias("resource_type")).agg(t.alias("last_success_load_ts"))
    wh.append("load_log", marks(events, F.max("ts")))
    wh.append("load_log", marks(events.filter("user_id > 20"), F.max("ts") + F.expr("interval 1 day")))
    return wh.read("load_log")


def _segment_subjects(spark, d):
    """Customers as subjects of their nation, with their segment as a document."""
    return table(spark, d, "customer").select(
        F.lit("lab").alias("src_system"), F.col("c_nationkey").cast("string").alias("research_study_id"),
        F.lit("xnat_project_id").alias("research_study_id_type"), F.col("c_name").alias("research_subject_id"),
        F.concat(F.lit('{"a": 1, "segment": "'), "c_mktsegment", F.lit('"}')).alias("xnat_custom_fields"), "c_acctbal", "c_mktsegment",
    )


@query(
    f"""select c_name as research_subject_id, cast(c_nationkey as varchar) as research_study_id,
      case when c_nationkey = 7 and c_mktsegment = 'BUILDING' then '{{"segment": "HOUSE"}}' else '{{"a": 1, "segment": "' || c_mktsegment || '"}}' end as xnat_custom_fields,
      cast(case when c_nationkey = 7 and c_mktsegment = 'BUILDING' then 2 else 1 end as integer) as _rev,
      case when c_nationkey = 7 and c_mktsegment = 'BUILDING' then timestamp '2024-07-01' else timestamp '{PROC_DT}' end as _updatedat
      from customer where c_nationkey <> 7 or c_acctbal >= 0"""
)
def replace_one_study(spark, d):
    """All studies, then one of them again: some subjects gone, some changed. Only its partition is written."""
    wh = Warehouse(spark, shared_folder(spark), NAMING, "lab")
    rows = _segment_subjects(spark, d)
    loaders.load_table(wh, "research_subject", rows, PROC_DT)
    one = rows.filter("research_study_id = '7'").select("research_study_id").distinct()
    text = F.when(F.col("c_mktsegment") == "BUILDING", '{"segment": "HOUSE"}').otherwise(F.col("xnat_custom_fields"))
    again = rows.filter("research_study_id = '7' and c_acctbal >= 0").withColumn("xnat_custom_fields", text)
    loaders.load_table(wh, "research_subject", again, "2024-07-01 00:00:00", scope=one)
    return wh.read("research_subject").select("research_subject_id", "research_study_id", "xnat_custom_fields", "_rev", "_updatedat")


@query(
    f"""select {uri_sql("'lab'", "c_name", "c_nationkey", "'xnat_project_id'")} as resource_uri, '"rdfs:label":"' || c_name || '"' as label,
      cast(case when c_nationkey < 10 and c_mktsegment = 'BUILDING' and not (c_nationkey = 3 and c_acctbal < 0) then 2 else 1 end as integer) as _rev, c_nationkey = 3 and c_acctbal < 0 as deprecated
      from customer"""
)
def synced_resources(spark, d):
    """Studies below 10, sync; the others later with an earlier time, sync; nothing new, sync; documents with other spacing and
    order of keys, sync; some changes and subjects gone, sync."""
    wh = Warehouse(spark, shared_folder(spark), NAMING, "lab")
    rows = _segment_subjects(spark, d).withColumn("n", F.col("research_study_id").cast("int"))

    def run(part, proc_dt):
        scope = rows.filter(part).select("research_study_id").distinct()
        return lambda df: (loaders.load_table(wh, "research_subject", df.filter(part), proc_dt, scope=scope), sync.sync_resources(wh))

    run("n < 10", "2024-06-01 00:00:00")(rows)
    run("n >= 10", "2024-01-01 00:00:00")(rows)
    sync.sync_resources(wh)
    spaced = F.concat(F.lit('{ "segment" :"'), "c_mktsegment", F.lit('",  "a":1}'))
    run("n < 10", "2024-07-01 00:00:00")(rows.withColumn("xnat_custom_fields", spaced))
    changed = F.when(F.col("c_mktsegment") == "BUILDING", "{}").otherwise(spaced)
    run("n < 10", "2024-08-01 00:00:00")(rows.filter("n <> 3 or c_acctbal >= 0").withColumn("xnat_custom_fields", changed))
    sync.deprecate_vanished(wh)
    label = F.regexp_extract("body", '"rdfs:label":"[^"]*"', 0).alias("label")
    return wh.read("resources").select("resource_uri", label, "_rev", "deprecated")


_SUBJECT_URI = uri_sql("'lab'", "c_name", "c_nationkey", "'xnat_project_id'")


@query(
    f"""select c_name as research_subject_id, cast(c_nationkey as varchar) as research_study_id, n_name || ' & more' as research_study_title,
      {uri_sql('c_nationkey', "'xnat_project_id'")} as research_study_uri, {_SUBJECT_URI} as research_subject_uri, {_CF} as xnat_custom_fields,
      timestamp '{PROC_DT}' as _createdat, timestamp '{PROC_DT}' as _updatedat, cast(1 as integer) as _rev
      from customer join nation on c_nationkey = n_nationkey"""
)
def loaded_subjects(spark, d):
    """Landed XML to the subject table, twice; the second load changes nothing."""
    wh = Warehouse(spark, shared_folder(spark), NAMING, "lab")
    projects, subjects = project_files(spark, d), subject_files(spark, d)
    loaders.load_studies(wh, projects, PROC_DT, lines=True)
    loaders.load_subjects(wh, subjects, PROC_DT, lines=True)
    loaders.load_subjects(wh, subjects, "2024-07-01 00:00:00", lines=True)
    return wh.read("research_subject").select(
        "research_subject_id", "research_study_id", "research_study_title", "research_study_uri", "research_subject_uri",
        "xnat_custom_fields", "_createdat", "_updatedat", "_rev",
    )


@query(
    f"""select s_name as device_name, cast(s_nationkey as varchar) as device_manufacturer, {uri_sql("'lab'", 's_nationkey', 's_name')} as device_uri,
      cast(1 as integer) as _rev from supplier"""
)
def streamed_devices(spark, d):
    """Landed files picked up by a stream that ends when all are loaded."""
    folder = shared_folder(spark)
    wh = Warehouse(spark, f"{folder}/warehouse", NAMING, "lab")
    s = table(spark, d, "supplier").select(
        F.lit("lab").alias("src_system"), F.col("s_nationkey").cast("string").alias("device_manufacturer"), F.col("s_name").alias("device_name")
    )
    s.write.parquet(f"{folder}/landed")
    stream = spark.readStream.schema(s.schema).parquet(f"{folder}/landed")
    ingest_stream(wh, "device", stream, lambda _: PROC_DT, f"{folder}/progress", ["device_manufacturer"]).awaitTermination()
    return wh.read("device").select("device_name", "device_manufacturer", "device_uri", "_rev")


@query(
    f"""select s_name as device_name, cast(s_nationkey as varchar) as device_manufacturer, {uri_sql("'lab'", 's_nationkey', 's_name')} as device_uri,
      cast(1 as integer) as _rev from supplier"""
)
def streamed_devices_two_runs(spark, d):
    """Two runs that each land a part of every manufacturer's devices; the second keeps what the first stored."""
    folder = shared_folder(spark)
    wh = Warehouse(spark, f"{folder}/warehouse", NAMING, "lab")
    s = table(spark, d, "supplier").select(
        F.lit("lab").alias("src_system"), F.col("s_nationkey").cast("string").alias("device_manufacturer"), F.col("s_name").alias("device_name")
    )
    first = F.pmod(F.xxhash64("device_name"), F.lit(2)) == 0
    for rows in (s.filter(first), s.filter(~first)):
        rows.write.mode("append").parquet(f"{folder}/landed")
        stream = spark.readStream.schema(s.schema).parquet(f"{folder}/landed")
        ingest_stream(wh, "device", stream, lambda _: PROC_DT, f"{folder}/progress").awaitTermination()
    return wh.read("device").select("device_name", "device_manufacturer", "device_uri", "_rev")


def _documents(curr):
    return curr.select(
        F.concat(F.lit("urn:s:"), "s_suppkey", F.coalesce("nation", F.lit(-1))).alias("resource_uri"),
        F.array(F.lit("lab:Supplier")).alias("resource_types"), F.col("s_acctbal").cast("bigint").cast("string").alias("body"),
    )


def _stored(prev):
    return _documents(prev).select(
        "*", F.lit(3).cast("int").alias("_rev"), F.lit(False).alias("deprecated")
    )


_OLD = "(select 'urn:s:' || s_suppkey || coalesce(nullif(s_nationkey, 3), -1) as uri, cast(trunc(s_acctbal) as bigint) as body from supplier)"
_NEW = """(select 'urn:s:' || s_suppkey || coalesce(nullif(nullif(s_nationkey, 3), 7), -1) as uri,
  cast(trunc(case when s_acctbal > 5000 then 5000 else s_acctbal end) as bigint) as body from supplier)"""


@query(
    f"""select n.uri as resource_uri, case when o.uri is null then 'CREATE' else 'UPDATE' end as action,
      cast(case when o.uri is null then 1 else 4 end as integer) as new_rev from {_NEW} n left join {_OLD} o on n.uri = o.uri"""
)
def upsert_plan(spark, d):
    prev, curr = supplier_versions(spark, d)
    return G.plan_upsert(_documents(curr), _stored(prev)).select("resource_uri", "action", "new_rev")


@query(
    f"""select coalesce(n.uri, o.uri) as resource_uri, cast(coalesce(n.body, o.body) as varchar) as body,
      cast(case when o.uri is null then 1 when n.uri is null then 3 else 4 end as integer) as _rev, false as deprecated
      from {_NEW} n full join {_OLD} o on n.uri = o.uri"""
)
def upsert_resources(spark, d):
    prev, curr = supplier_versions(spark, d)
    return G.apply_upsert(_documents(curr), _stored(prev)).drop("resource_types")


_LIVE = "(select distinct l_partkey from lineitem where l_returnflag = 'R' and l_quantity < 3)"


def _live(spark, d):
    line = table(spark, d, "lineitem").filter("l_returnflag = 'R' and l_quantity < 3")
    return line.select(F.concat(F.lit("urn:part:"), "l_partkey").alias("resource_uri"))


@query(
    f"""select 'urn:part:' || p_partkey as resource_uri, p_size > 40 or (p_partkey not in {_LIVE} and p_type in ('PROMO', 'SMALL')) as deprecated from part"""
)
def deprecate_vanished(spark, d):
    """Resources of the managed types that left the warehouse become deprecated; others stay."""
    managed = G.has_type("lab:PROMO") | G.has_type("small", regex=True)
    return G.deprecate(resources(spark, d), _live(spark, d), managed).select("resource_uri", "deprecated")


@query(f"select 'urn:part:' || p_partkey as resource_uri from part where p_size <= 40 and p_partkey not in {_LIVE}")
def vanished_resources(spark, d):
    return G.vanished(resources(spark, d), _live(spark, d)).select("resource_uri")

import datetime as dt

import pytest
from pyspark.sql import functions as F

from labmeta.functions import keys as K
from labmeta.functions import text as X
from labmeta.operators import align, delta, graph
from labmeta.schemas import TABLES, spark_type
from labmeta.sources.tables import Warehouse, shared_folder

PREV = "k1 string, k2 string, v string, uri string, _createdat timestamp_ntz, _updatedat timestamp_ntz, _rev int"
OLD = dt.datetime(2020, 1, 1)


def versions(spark, prev, curr):
    return (
        spark.createDataFrame([(*r, f"urn:{i}", OLD, OLD, 1) for i, r in enumerate(prev)], PREV),
        spark.createDataFrame(curr, "k1 string, k2 string, v string"),
    )


def actions(df):
    return {(r["k1"], r["k2"]): r["delta_action"] for r in df.collect()}


def test_classify_null_keys_and_values(spark):
    prev, curr = versions(
        spark,
        [("a", None, "x"), ("b", "1", "x"), ("c", "1", None), ("d", "1", "x"), ("e", "1", "x")],
        [("a", None, "x"), ("b", "1", None), ("c", "1", None), ("e", None, "x"), ("f", "1", "x")],
    )
    got = actions(delta.classify_delta(prev, curr, ["k1", "k2"], "uri"))
    assert got == {
        ("a", None): "NOCHANGE", ("b", "1"): "UPDATE", ("c", "1"): "NOCHANGE", ("d", "1"): "DELETE",
        ("e", "1"): "DELETE", ("e", None): "INSERT", ("f", "1"): "INSERT",
    }


@pytest.mark.parametrize("wide", [(), ("v",)])
def test_apply_keeps_uri_and_counts_revisions(spark, wide):
    prev, curr = versions(spark, [("a", "1", "x"), ("b", "1", "x")], [("a", "1", "y"), ("b", "1", "x"), ("c", None, "z")])
    out = delta.apply_delta(
        delta.classify_delta(prev, curr, ["k1", "k2"], "uri", wide=wide), "2024-01-01 00:00:00", "uri", "u:", ["k1", "k2"], "s"
    )
    rows = {r["k1"]: r for r in out.collect()}
    new = dt.datetime(2024, 1, 1)
    assert (rows["a"]["uri"], rows["a"]["_rev"], rows["a"]["_createdat"], rows["a"]["_updatedat"], rows["a"]["v"]) == ("urn:0", 2, OLD, new, "y")
    assert (rows["b"]["uri"], rows["b"]["_rev"], rows["b"]["_updatedat"]) == ("urn:1", 1, OLD)
    assert rows["c"]["_rev"] == 1 and rows["c"]["uri"].startswith("u:") and rows["c"]["_createdat"] == new


def test_empty_sides(spark):
    prev, curr = versions(spark, [], [("a", "1", "x")])
    assert actions(delta.classify_delta(prev, curr, ["k1", "k2"], "uri")) == {("a", "1"): "INSERT"}
    prev, curr = versions(spark, [("a", "1", "x")], [])
    gone = delta.classify_delta(prev, curr, ["k1", "k2"], "uri")
    assert actions(gone) == {("a", "1"): "DELETE"}
    assert delta.apply_delta(gone, "2024-01-01 00:00:00", "uri", "u:", ["k1"]).count() == 0


def test_duplicates_raise_with_and_without_base(spark):
    for base in ([], [("a", None, "x")]):
        prev, curr = versions(spark, base, [("a", None, "x"), ("a", None, "x")])
        with pytest.raises(delta.DuplicateKeyError):
            delta.classify_delta(prev, curr, ["k1", "k2"], "uri")


def test_publish_is_atomic_and_checks_keys(spark):
    wh = Warehouse(spark, shared_folder(spark))
    rows = spark.createDataFrame([("lab", "u1", "m", None)], "src_system string, device_uri string, device_manufacturer string, device_name string")
    device = align.conform(rows, TABLES["device"].schema)
    wh.publish("device", device)
    with pytest.raises(delta.DuplicateKeyError):
        wh.publish("device", device.unionByName(device))
    assert wh.version("device") == 1 and wh.read("device").count() == 1
    wh.replace("device", device.limit(0), F.col("device_manufacturer") == "m")
    assert wh.version("device") == 2 and wh.read("device").count() == 0


def test_uri_is_stable_and_escapes_the_delimiter(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a", None), ("a", None)], "x string, y string")
    uris = [r[0] for r in df.select(K.surrogate_uri("u:", ["x", "y"], "s")).collect()]
    assert len(set(uris)) == 3 and uris[2] == uris[3]


def test_align_raises_on_bad_number_and_structure(spark):
    schema = TABLES["load_log"].schema
    with pytest.raises(ValueError, match="missing"):
        align.align_to_schema(spark.createDataFrame([("a",)], "resource_type string"), schema, strict=True)
    number = spark.createDataFrame([("1.0", "keep"), (None, "x")], "_rev string, extra string")
    out = align.align_to_schema(number, TABLES["device"].schema)
    assert [tuple(r) for r in out.collect()] == [(1, "keep"), (None, "x")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        align.align_to_schema(spark.createDataFrame([("one",)], "_rev string"), TABLES["device"].schema).collect()
    with pytest.raises(ValueError):
        spark_type("decimal")


def test_strip_html(spark):
    pages = [
        ("<p>a &lt;b&gt; &eacute;&#233;</p><!-- no --><script>if (a < b && c) { x('</p>') }</script>", "a <b> éé" + "if (a < b && c) { x('</p>') }"),
        ('<!DOCTYPE html><a title="x > y">t</a> 1 < 2', "t 1 < 2"),
        ("", ""),
        ("text<br", "text"),
    ]
    df = spark.createDataFrame(pages, "html string, want string")
    assert [r["got"] for r in df.select(X.strip_html(F.col("html")).alias("got")).collect()] == [w for _, w in pages]


def test_escapes(spark):
    df = spark.createDataFrame([("a\\b\r\nc\rd\ne",)], "t string")
    row = df.select(X.escape_backslash(F.col("t")).alias("b"), X.escape_newlines(F.col("t")).alias("n")).first()
    assert row["b"] == "a\\\\b\r\nc\rd\ne" and row["n"] == "a\\b\\rc\\rd\\re"


def test_bad_json_raises(spark):
    df = spark.createDataFrame([("{bad",)], "t string")
    with pytest.raises(Exception, match="not valid JSON"):
        df.select(X.json_or_default(F.col("t"))).collect()


def test_reachable_handles_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "d")], "s string, o string")
    assert {tuple(r) for r in graph.reachable(edges).collect()} == {(x, y) for x in "abc" for y in "abc"} | {("d", "d")}
    roots = spark.createDataFrame([("a",)], "r string")
    assert {r["node"] for r in graph.reachable(edges, roots).collect()} == {"a", "b", "c"}

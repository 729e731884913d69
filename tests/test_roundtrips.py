"""Texts with quotes, tabs and line breaks through the CSV and YAML sinks; span edges; null-safe merge."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintwise.operators import careers, graph
from stintwise.plans import registry
from stintwise.session import scratch_path
from stintwise.sources import csv as csv_io
from stintwise.sources import documents
from tests.conftest import SF001

HARD = ["a\nb", 'say "x"', "it's", "tab\there", " lead and trail ", "a,b;c", "back\\slash \\n", '"', "#x: [y]", "é 日本 😀",
        "line\n\n", "\x85next\u2028line", "- item", "null", "0x1f", "NO", "c:\\\"d"]
SCHEMA = "id bigint, text string"


def _rows(spark):
    return spark.createDataFrame([*enumerate(HARD), (100, None), (101, "")], SCHEMA)


def test_csv_text_round_trip(spark):
    path = scratch_path(spark, "csv")
    csv_io.write_csv(_rows(spark), path)
    got = {r.id: r.text for r in csv_io.read_csv(spark, path, SCHEMA).collect()}
    # a CSV cell without text is null
    assert got == {r.id: r.text or None for r in _rows(spark).collect()}


def test_yaml_text_round_trip(spark):
    path = scratch_path(spark, "yaml")
    fields = {"id": F.col("id").cast("string"), "text": documents.yaml_quote(F.col("text"))}
    documents.write_yaml(documents.yaml_map_document(_rows(spark), fields), path)
    got = {r.id: r.text for r in documents.read_documents(spark, path, T.StructType.fromDDL(SCHEMA)).collect()}
    assert got == {r.id: r.text for r in _rows(spark).collect()}


def test_span_edges_equal_the_edges_of_the_pairs(spark, toy):
    s = careers.shared_spans(toy)
    edges = graph.span_graph_edges(careers.debuts(toy, s), s)
    pairs = graph.graph_edges(careers.debuts(toy, s), careers.transfers_with_midseason(toy, s), careers.breaks(toy, True, s))
    assert sorted(map(str, edges.collect())) == sorted(map(str, pairs.collect()))
    plan = graph.span_edges_transfer(s)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "Inner" not in plan


def test_merge_is_idempotent_with_null_keys(spark):
    g = spark.createDataFrame([("a", None, 1), (None, None, None), ("b", "c", 2)], "src string, dst string, year int")
    assert graph.merge_graph(g, g).count() == 3
    assert graph.merge_added(g, spark.createDataFrame([("a", None, 1), ("x", None, 1)], g.schema)).count() == 1


def test_graph_merge_query_merges_all_edges(spark, monkeypatch):
    sides = []
    merge = graph.merge_graph
    monkeypatch.setattr(graph, "merge_graph", lambda old, new, on: (sides.append((old, new)), merge(old, new, on))[1])
    merged = registry.QUERIES["graph_merge"](spark, SF001)
    old, new = sides[0]
    assert old.exceptAll(new).count() == 0 and old.count() > 0
    assert new.exceptAll(merged).count() == 0 and merged.exceptAll(new).count() == 0
    assert {r.type for r in new.select("type").distinct().collect()} == {
        "DEBUT", "TRANSFER_OUT", "TRANSFER_IN", "BREAK", "RETURN"}

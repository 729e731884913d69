"""Operators on small hand-made inputs, checked against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintwise.operators import careers, graph, normalise, schema
from stintwise.schemas import APPEARANCES, SEASON_ENTRY
from stintwise.session import scratch_path
from stintwise.sources import documents


def test_dense_id_matches_sorted_order(spark):
    rows = [(random.Random(7).randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    got = normalise.with_dense_id(df, ["k", "v"], num_partitions=5).collect()
    want = {(k, v): i for i, (k, v) in enumerate(sorted(rows))}
    assert sorted(r["id"] for r in got) == list(range(500))
    assert all(want[(r["k"], r["v"])] == r["id"] for r in got)


def test_explode_child_skips_null_and_empty(spark):
    df = spark.createDataFrame([("a", ["x", "y"]), ("b", None), ("c", []), ("d", ["z"])],
                               "id string, names array<string>")
    got = [tuple(r) for r in normalise.explode_child(df, "id", "names", "pid", item="name")
           .orderBy("id").collect()]
    assert got == [(0, "a", "x"), (1, "a", "y"), (2, "d", "z")]


def test_chain_edges_and_dedupe(spark):
    chain = [("m", 1985, 2005), ("t", 2006, 2019), ("a", 2020, None)]
    item = "array<struct<constructorId:string,yearFrom:int,yearTo:int>>"
    df = spark.createDataFrame([("m", chain), ("t", chain), ("a", chain), ("f", None)],
                               f"id string, chain {item}")
    uniq = normalise.dedupe_chains(df, "id", "chain")
    assert [r["chain_id"] for r in uniq.collect()] == ["a"]
    edges = normalise.chain_edges(uniq, "chain", "constructorId", ["yearFrom", "yearTo"],
                                  from_col="f", to_col="t").orderBy("_pos").collect()
    assert [(r["f"], r["t"], r["yearTo"]) for r in edges] == [
        (None, "m", 2005), ("m", "t", 2019), ("t", "a", None)]


def test_flatten_prefers_inline_and_defaults(spark):
    entry = {"entrantId": "e", "constructorId": "c", "driverId": "d", "rounds": None,
             "constructors": [{"constructorId": "x", "driverId": "y", "rounds": "1"}]}
    df = spark.createDataFrame([(2000, entry)], T.StructType([
        T.StructField("year", T.IntegerType()), T.StructField("entry", SEASON_ENTRY)]))
    got = [tuple(r) for r in normalise.flatten_entries(df).collect()]
    assert got == [(2000, "e", "c", "d", False, False)]


def test_yaml_documents_one_per_file_and_streams(spark, tmp_path):
    (tmp_path / "a.yml").write_text("id: a\ncode: 'NA'\nn: 1\n")
    (tmp_path / "b.yml").write_text("---\nid: b\ncode: NO\nn: 2\n---\nid: c\nn: 3\n")
    docs = documents.read_documents(spark, str(tmp_path), T.StructType([
        T.StructField("id", T.StringType()), T.StructField("code", T.StringType()),
        T.StructField("n", T.IntegerType())]))
    got = sorted((r["id"], r["code"], r["n"]) for r in docs.collect())
    # An unquoted NO is a YAML boolean, as with the reference's safe_load.
    assert got == [("a", "NA", 1), ("b", "false", 2), ("c", None, 3)]


def test_discover_and_strict_record(spark, tmp_path):
    (tmp_path / "1.yml").write_text("id: a\nx: 1\n")
    (tmp_path / "2.yml").write_text("id: b\ny: 2\nx: 3\n")
    docs = documents.read_document_maps(spark, str(tmp_path))
    keys = schema.key_list(schema.discover_keys(docs, ["_path", "_doc"]))
    assert keys == ["id", "x", "y"]
    assert schema.key_list(schema.widest_keys(docs, ["_path", "_doc"])) == ["id", "y", "x"]
    rec = schema.project_record(docs, keys).orderBy("id").collect()
    assert [tuple(r) for r in rec] == [("a", "1", None), ("b", "3", "2")]
    with pytest.raises(Exception, match="lacks key"):
        schema.project_record(docs, keys, on_missing="error").collect()
    missing = [tuple(r) for r in schema.missing_keys(docs.withColumn("i", F.col("doc.id")), keys, "i")
               .collect()]
    assert missing == [("a", "y")]


def test_case_select(spark):
    df = spark.createDataFrame([(1, "x")], "driverID int, Name string")
    assert schema.case_select(df, ["driverId", "NAME"]).columns == ["driverId", "NAME"]


def _random_appearances(spark, seed, n=400):
    rnd = random.Random(seed)
    rows = [(rnd.randint(2000, 2012), f"e{rnd.randint(0, 3)}",
             rnd.choice(["A", "B", "C", "D", None]), rnd.choice(["d1", "d2", "d3", "d4", None]),
             rnd.choice([True, True, True, False, None]), rnd.choice([True, False]))
            for _ in range(n)]
    return rows, spark.createDataFrame(rows, APPEARANCES)


def _brute_breaks(rows, midseason):
    act = [r for r in rows if r[4] is True]
    spans = {}
    for y, _, c, d, _, _ in act:
        if y is None:
            continue
        f, l_ = spans.get((d, c), (y, y))
        spans[(d, c)] = (min(f, y), max(l_, y))
    items = [(d, c, f, l_) for (d, c), (f, l_) in spans.items()]
    trans = set()
    for (d1, c1, f1, l1), (d2, c2, f2, l2) in itertools.product(items, items):
        if d1 is None or d1 != d2:
            continue
        if midseason:
            ok = c1 is not None and c2 is not None and c1 != c2 and (l1 == f2 - 1 or l1 == f2)
        else:
            ok = l1 == f2 - 1
        if ok and c2 is not None:
            trans.add((d2, c2, f2))
    gaps = [(d1, c1, l1, c2, f2, f2 - l1) for (d1, c1, f1, l1), (d2, c2, f2, l2)
            in itertools.product(items, items)
            if d1 is not None and d1 == d2 and l1 < f2 - 1 and (d2, c2, f2) not in trans]
    near = [g for g in gaps if g[3] is not None and g[5] == min(
        h[5] for h in gaps if (h[0], h[3], h[4]) == (g[0], g[3], g[4]))]
    return set(near), {g for g in near if g[1] is not None and g[5] == min(
        h[5] for h in near if (h[0], h[1], h[2]) == (g[0], g[1], g[2]))}


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("midseason", [False, True])
def test_breaks_match_brute_force_with_nulls(spark, seed, midseason):
    rows, a = _random_appearances(spark, seed)
    near, brk = _brute_breaks(rows, midseason)
    assert {tuple(r) for r in careers.breaks(a, midseason).collect()} == brk
    got_near = [tuple(r) for r in careers.breaks_nearest_return(a, midseason).collect()]
    assert len(got_near) == len(set(got_near)) and set(got_near) == near


def test_properties(spark):
    _, a = _random_appearances(spark, 9, 800)
    t = careers.transfers_consecutive(a)
    assert t.filter(F.col("transfer_in") != F.col("transfer_out") + 1).count() == 0
    b = careers.breaks(a)
    assert b.filter(F.col("gap") < 2).count() == 0
    assert b.exceptAll(careers.gap_pairs(a)).count() == 0
    edges = graph.graph_edges(careers.debuts(a), careers.transfers_with_midseason(a),
                              careers.breaks(a, True))
    assert graph.merge_graph(edges, edges).exceptAll(edges).count() == 0
    assert graph.merge_graph(edges, edges).count() == edges.count()


def test_season_yaml_roundtrip(spark):
    path = scratch_path(spark, "season-test")
    sample = """- entrantId: e1
  constructorId: c1
  drivers:
  - driverId: d1
    rounds: 1-3
  - driverId: d2
    rounds:
    testDriver: true
- entrantId: e2
  constructors:
  - constructorId: c2
    driverId: d3
    rounds: 1
"""
    spark.createDataFrame([(1999, sample)], "year int, yaml string").write.partitionBy("year") \
        .text(path)
    got = sorted(tuple(r) for r in documents.read_season_documents(
        spark, path, pattern="*/*.txt").collect())
    assert got == [(1999, "e1", "c1", "d1", True, False), (1999, "e1", "c1", "d2", False, True),
                   (1999, "e2", "c2", "d3", True, False)]


def test_chain_that_revisits_an_id(spark):
    chain = [("sauber", 1993, 2005), ("bmw-sauber", 2006, 2010), ("sauber", 2011, 2018),
             ("alfa-romeo", 2019, 2023), ("kick-sauber", 2024, None)]
    item = "array<struct<constructorId:string,yearFrom:int,yearTo:int>>"
    df = spark.createDataFrame([(c[0], chain) for c in chain], f"id string, chain {item}")
    uniq = normalise.dedupe_chains(df, "id", "chain")
    edges = [(r["f"], r["t"]) for r in normalise.chain_edges(
        uniq, "chain", "constructorId", from_col="f", to_col="t").orderBy("_pos").collect()]
    assert edges == [(None, "sauber"), ("sauber", "bmw-sauber"), ("bmw-sauber", "sauber"),
                     ("sauber", "alfa-romeo"), ("alfa-romeo", "kick-sauber")]


def test_season_output_ordered_by_year(spark):
    path = scratch_path(spark, "season-order")
    rows = [(y, f"- entrantId: e{y}\n  constructorId: c\n  driverId: d\n  rounds: 1")
            for y in (2010, 1999, 2005)]
    spark.createDataFrame(rows, "year int, yaml string").write.partitionBy("year").text(path)
    got = [r["year"] for r in documents.read_season_documents(
        spark, path, pattern="*/*.txt", ordered=True).collect()]
    assert got == [1999, 2005, 2010]


def test_year_from_path(spark):
    from stintwise.functions import year_from_path
    df = spark.createDataFrame([("s3://b/seasons/1998/entrants.yml",), ("/x/year=2001/part-0.txt",),
                                ("/x/misc/readme.yml",)], "p string")
    assert [r[0] for r in df.select(year_from_path("p")).collect()] == [1998, 2001, None]


def test_merge_graph_adds_only_absent_edges(spark):
    cols = "src_label string, src string, type string, dst_label string, dst string, year int"
    existing = spark.createDataFrame([("Driver", "a", "DEBUT", "Team", "x", 2000),
                                      ("Team", "x", "BREAK", "Driver", "a", 2003)], cols)
    new = spark.createDataFrame([("Driver", "a", "DEBUT", "Team", "x", 2000),
                                 ("Driver", "a", "RETURN", "Team", "y", 2006),
                                 ("Driver", "a", "RETURN", "Team", "y", 2006)], cols)
    merged = sorted(tuple(r) for r in graph.merge_graph(existing, new).collect())
    assert merged == sorted([("Driver", "a", "DEBUT", "Team", "x", 2000),
                             ("Team", "x", "BREAK", "Driver", "a", 2003),
                             ("Driver", "a", "RETURN", "Team", "y", 2006)])
    nodes = sorted(tuple(r) for r in graph.graph_nodes(graph.merge_graph(existing, new)).collect())
    assert nodes == [("Driver", "a"), ("Team", "x"), ("Team", "y")]


def test_send_batches_reaches_every_edge_once(spark):
    _, a = _random_appearances(spark, 4, 600)
    edges = graph.graph_edges(careers.debuts(a), careers.transfers_with_midseason(a),
                              careers.breaks(a, True))
    batches = graph.edge_batches(edges, graph.EDGE_COLUMNS, size=7)
    sent_rows = spark.sparkContext.accumulator(0)
    sent_batches = spark.sparkContext.accumulator(0)

    def open_sink():
        def send(batch, rows):
            assert len(rows) <= 7 and set(rows[0]) == set(graph.EDGE_COLUMNS)
            sent_rows.add(len(rows))
            sent_batches.add(1)
        return send

    graph.send_batches(batches, open_sink)
    assert sent_rows.value == edges.count()
    assert sent_batches.value == batches.count()


def test_repeated_appearances_keep_their_number(spark):
    """Counts above one block of copies come back as that many rows, and nulls of the flag count too."""
    once = [(2000, "e", "A", "d1", True, False), (2000, "e", "B", "d1", None, False), (2003, "e", "A", "d2", True, False)]
    a = spark.createDataFrame(once, APPEARANCES)
    many = a.crossJoin(spark.range(9001)).drop("id")
    got = {tuple(r) for r in careers.retirements(many).groupBy("driverId", "constructorId", "retirement_year").count().collect()}
    assert got == {("d1", "A", 2000, 9001), ("d1", "B", 2000, 9001)}
    e = careers.yearly_entries(many)
    assert e.count() == 3
    got = {tuple(r) for r in careers.debuts(e, careers.spans(e)).groupBy("driverId", "constructorId").count().collect()}
    assert got == {("d1", "A", 9001), ("d1", "B", 9001), ("d2", "A", 9001)}


@pytest.mark.parametrize("size, n", [(1, 5), (7, 500), (500, 499), (64, 0)])
def test_batches_are_consecutive_and_do_not_depend_on_layout(spark, size, n):
    rows = [(f"k{i * 37 % max(n, 1) % 50}", i) for i in range(n)]
    want = sorted(rows)
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "k string, v long").repartition(parts)
        got = {r["batch"]: [tuple(x) for x in r["rows"]] for r in graph.edge_batches(df, ["k"], size).collect()}
        assert got == {b: want[b * size:(b + 1) * size] for b in range(-(-n // size))}


def test_dense_ids_do_not_depend_on_layout(spark):
    df = spark.createDataFrame([(i % 3, i % 7, str(i)) for i in range(200)], "a long, b long, c string")
    ids = [sorted(tuple(r) for r in normalise.with_dense_id(x, ["a"]).collect())
           for x in (df.repartition(1), df.repartition(5, "c").orderBy("c"))]
    assert ids[0] == ids[1]

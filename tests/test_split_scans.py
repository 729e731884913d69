"""Large YAML files cut at document and item borders, the stored graph, and loads that go on."""

import glob
import os

import pytest
from pyspark.sql import types as T

from stintwise.operators import graph, graph_store
from stintwise.session import scratch_path
from stintwise.sources import documents
from stintwise.streaming import career_stream, read_career_state

ROW = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("text", T.StringType())])


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _file(tmp_path, name, text):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def _same(split, whole):
    assert sorted(map(tuple, split.drop("_doc").collect())) == sorted(map(tuple, whole.drop("_doc").collect()))
    in_order = lambda df: [r.id for r in df.orderBy("_path", "_doc").collect()]
    assert in_order(split) == in_order(whole)


@pytest.mark.parametrize("head", ["", "---\n", "\n\n---\n", "%YAML 1.1\n---\n", "# note\n--- # first\n"])
def test_a_stream_is_split_at_its_documents(spark, tmp_path, small_splits, head):
    docs = [f"id: {i}\ntext: |\n  ---\n  line of {i}\n  --- more\n" + f"# {'x' * (i % 50)}\n" for i in range(200)]
    path = _file(tmp_path, "all.yml", head + "---\n".join(docs) + "...\n")
    split = documents.read_documents(spark, path, ROW)
    assert documents.document_text(spark, path, documents.DOCUMENT_MARK).rdd.getNumPartitions() > 5
    assert documents.document_text(spark, path).rdd.getNumPartitions() == 1
    assert split.count() == 200
    _same(split, documents.read_documents(spark, path, ROW, whole=True))


def test_documents_without_markers_empty_ones_and_crlf(spark, tmp_path):
    for name, text in {"one": "id: 1\ntext: a", "empty": "", "blank": "\n\n", "gaps": "---\n---\nid: 1\n---\n---\nid: 2\n",
                       "crlf": "id: 1\r\n---\r\nid: 2\r\n",
                       "tags": "id: 1\n...\n%YAML 1.1\n%TAG ! tag:x,2000:\n---\nid: 2\n",
                       "looks": "id: 1\n---x: 5\ntext: b\n---\nid: 2\n"}.items():
        path = _file(tmp_path, f"{name}.yml", text)
        split, whole = (documents.read_documents(spark, path, ROW, whole=w) for w in (False, True))
        assert list(map(tuple, split.orderBy("_doc").collect())) == list(map(tuple, whole.orderBy("_doc").collect())), name


def test_a_split_inside_a_document_fails_with_a_hint(spark, tmp_path, small_splits):
    path = _file(tmp_path, "odd.yml", "".join(f"k{i}: {'v' * 300}\n---x{i}: 1\n" for i in range(20)))
    with pytest.raises(Exception, match="whole=True"):
        documents.read_document_maps(spark, path).collect()
    assert documents.read_document_maps(spark, path, whole=True).count() == 1


def _season(n):
    text = ""
    for i in range(n):
        text += (f"- entrantId: e{i}\n  constructorId: c{i % 7}\n  drivers:\n  - driverId: d{i % 11}\n    rounds: 1-{i}\n"
                 f"  - driverId: d{i % 13}\n    rounds:\n    testDriver: true\n" if i % 3 else
                 f"- entrantId: e{i}\n  constructors:\n  - constructorId: c{i % 5}\n    driverId: d{i}\n    rounds: [1, 2]\n")
    return text


@pytest.mark.parametrize("head", ["", "---\n", "# season\n"])
def test_a_season_is_split_at_its_items(spark, tmp_path, small_splits, head):
    _file(tmp_path, "2001/entrants.yml", head + _season(150))
    _file(tmp_path, "2002/entrants.yml", head + _season(3))
    pattern = f"{tmp_path}/*/entrants.yml"
    assert documents.document_text(spark, pattern, documents.ITEM_MARK).rdd.getNumPartitions() > 5
    split = documents.read_season_documents(spark, str(tmp_path), ordered=True).collect()
    assert split == documents.read_season_documents(spark, str(tmp_path), ordered=True, whole=True).collect()
    assert len(split) > 200


def test_anchors_and_lists_below_a_map_ask_for_whole_files(spark, tmp_path):
    _file(tmp_path, "2001/entrants.yml", "- &a\n  entrantId: e\n  constructorId: c\n  driverId: d\n  rounds: 1\n- *a\n")
    _file(tmp_path / "map", "2001/entrants.yml", "entrants:\n- entrantId: e\n- entrantId: f\n")
    for root in (tmp_path, tmp_path / "map"):
        with pytest.raises(Exception, match="whole=True"):
            documents.read_season_documents(spark, str(root)).collect()
    assert documents.read_season_documents(spark, str(tmp_path), whole=True).count() == 2


def _edges(spark, rows):
    return spark.createDataFrame([("Driver", s, k, "Team", d, y) for s, k, d, y in rows],
                                 "src_label string, src string, type string, dst_label string, dst string, year int")


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_merge_touches_only_partitions_that_gain_rows(spark):
    path = scratch_path(spark, "store").removeprefix("file://")
    first = [(f"d{i}", "DEBUT", f"t{i % 3}", 2000) for i in range(40)]
    assert graph_store.merge_edges(path, _edges(spark, first + first)) == 40
    before = _files(path)
    assert graph_store.merge_edges(path, _edges(spark, first)) == 0
    assert _files(path) == before
    assert graph_store.merge_edges(path, _edges(spark, [*first, ("d1", "RETURN", "t1", 2001), ("d2", "DEBUT", "t9", 2000)])) == 2
    after = _files(path)
    assert before.items() <= after.items() and len(after) == len(before) + 2
    got = {(r.src, r.type, r.dst, r.year) for r in graph_store.read_edges(spark, path).collect()}
    assert got == {*first, ("d1", "RETURN", "t1", 2001), ("d2", "DEBUT", "t9", 2000)}
    assert graph_store.merge_edges(path, _edges(spark, [("", "", "", 0)]).limit(0)) == 0


def test_a_merge_reads_only_touched_partitions(spark):
    path = scratch_path(spark, "store").removeprefix("file://")
    graph_store.merge_edges(path, _edges(spark, [(f"d{i}", k, "t", 1) for i in range(30) for k in ("DEBUT", "BREAK")]))
    one = graph_store._stored(spark, path).where("type = 'DEBUT' AND bucket IN (1, 2)")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_a_load_goes_on_where_it_stopped(spark, tmp_path):
    edges = _edges(spark, [(f"d{i:03}", "DEBUT", "t", i) for i in range(100)])
    batches = graph.edge_batches(edges, ["src"], size=7)
    log, ledger, broken = tmp_path / "log", str(tmp_path / "ledger"), tmp_path / "broken"
    log.mkdir(), broken.touch()
    log, broken = str(log), str(broken)

    def open_sink():
        import os
        import uuid

        def send(batch, rows):
            if batch == 9 and os.path.exists(broken):
                raise OSError("the client went away")
            with open(f"{log}/{batch}-{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(r["src"] for r in rows))

        return send

    with pytest.raises(Exception, match="went away"):
        graph_store.send_batches_once(batches, open_sink, ledger)
    sent = len(os.listdir(log))
    assert 0 < sent < 15
    os.rename(broken, broken + "-mended")
    receipts = graph_store.send_batches_once(batches, open_sink, ledger)
    assert receipts.count() == 15 - sent
    assert sorted(int(f.split("-")[0]) for f in os.listdir(log)) == list(range(15))     # each batch once
    got = sorted(x for f in os.listdir(log) for x in open(f"{log}/{f}").read().split("\n"))
    assert got == [f"d{i:03}" for i in range(100)]
    assert graph_store.send_batches_once(batches, open_sink, ledger).count() == 0


def test_career_state_after_two_batches_equals_a_rebuild(spark, tmp_path):
    from stintwise.operators import careers

    src, state, ckpt = str(tmp_path / "src"), str(tmp_path / "state"), str(tmp_path / "ckpt")
    for years in ((2001, 2002), (2004,)):
        for y in years:
            _file(tmp_path / "src", f"{y}/entrants.yml", _season(y % 10 * 9))
        career_stream(spark, src, state, ckpt, available_now=True).awaitTermination(120)
    e = read_career_state(spark, state)
    assert len(glob.glob(f"{state}/batch=*")) == 2
    a = documents.read_season_documents(spark, src)
    s, full = careers.shared_spans(e), careers.shared_spans(a)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(s) == rows(full)
    assert rows(careers.debuts(e, s)) == rows(careers.debuts(a)) != []
    assert rows(careers.retirements_announced(e, e)) == rows(careers.retirements_announced(a))
    assert rows(careers.transfers_with_midseason(e, s)) == rows(careers.transfers_with_midseason(a, full)) != []


def test_splittable_csv_keeps_every_text(spark, tmp_path, small_splits):
    from stintwise.sources import csv

    texts = [None, "", " ", "\\N", "\\", "\\n", "a\nb", "a\r\nb\\", '"q", "r"', "\\b\n\\r", "é,\t;", "#x", "x" * 900]
    rows = [(i, t, None if i % 2 else i) for i, t in enumerate(texts * 10)]
    schema = "id int, `a text` string, n int"
    csv.write_split_csv(spark.createDataFrame(rows, schema).coalesce(1), str(tmp_path / "t"))
    got = csv.read_split_csv(spark, str(tmp_path / "t"), schema)
    assert got.rdd.getNumPartitions() > 5
    assert sorted(map(tuple, got.collect())) == rows


def test_large_counts_are_dealt_out_and_small_ones_stay(spark, monkeypatch):
    from stintwise.operators import careers

    monkeypatch.setattr(careers, "_BLOCK", 10)
    rows = spark.createDataFrame([("a", 3), ("b", 10), ("c", 11), ("d", 25), (None, 1)], "driverId string, _n bigint")
    got = careers._each(rows, "driverId").groupBy("driverId").count().collect()
    assert {r[0]: r[1] for r in got} == {"a": 3, "b": 10, "c": 11, "d": 25, None: 1}

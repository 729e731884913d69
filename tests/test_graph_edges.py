"""Edges straight from spans against the edges of the pair relations."""

import random

import pytest

from stintwise.operators import careers, graph
from stintwise.schemas import APPEARANCES
from tests.test_plans import plan_text


def _rows(seed, n=500, drivers=60, teams=6, years=12):
    rnd = random.Random(seed)
    pick = lambda kind, k: None if rnd.random() < 0.06 else f"{kind}{rnd.randrange(k)}"
    return [(None if rnd.random() < 0.04 else 1990 + rnd.randrange(years), "e", pick("c", teams), pick("d", drivers),
             rnd.choice([True, True, True, False, None]), False) for _ in range(n)]


@pytest.mark.parametrize("seed,years,teams", [(1, 12, 6), (2, 5, 3), (3, 25, 8), (4, 9, 2)])
def test_edges_from_spans_are_those_of_the_pairs(spark, seed, years, teams):
    a = spark.createDataFrame(_rows(seed, years=years, teams=teams), APPEARANCES)
    s = careers.shared_spans(a)
    d = careers.debuts(a, s)
    got = [tuple(r) for r in graph.span_graph_edges(d, s).select(*graph.EDGE_COLUMNS).collect()]
    pairs = graph.graph_edges(d, careers.transfers_with_midseason(a, s), careers.breaks(a, True, s))
    want = [tuple(r) for r in pairs.select(*graph.EDGE_COLUMNS).collect()]
    assert sorted(got) == sorted(want) and {r[2] for r in got} == {"DEBUT", "TRANSFER_OUT", "TRANSFER_IN", "BREAK", "RETURN"}


def test_spans_are_shuffled_for_years_and_drivers_only(spark):
    """Few shuffles per span: the plan's exchanges are those of the debuts, the years and the one join."""
    a = spark.createDataFrame(_rows(5), APPEARANCES)
    s = careers.shared_spans(a)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(graph.span_graph_edges(careers.debuts(a, s), s), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("Exchange hashpartitioning" in line for line in text.splitlines()) <= 8


def test_a_stored_merge_deduplicates_its_rows_once(spark, monkeypatch):
    from stintwise.operators import graph_store
    from stintwise.session import scratch_path

    made = []
    plain = graph.merge_added

    def recorded(*args, **options):
        made.append(plain(*args, **options))
        return made[-1]

    monkeypatch.setattr(graph_store, "merge_added", recorded)
    rows = [("Driver", f"d{i % 7}", "DEBUT", "Team", "t", 1) for i in range(20)]
    new = spark.createDataFrame(rows, "src_label string, src string, type string, dst_label string, dst string, year int")
    path = scratch_path(spark, "once")
    assert [graph_store.merge_edges(path, new) for _ in range(2)] == [7, 0]
    assert "Aggregate" not in made[-1]._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate" not in made[-1]._jdf.queryExecution().analyzed().toString()


def test_listed_batches_do_not_reach_the_sender(spark, tmp_path, monkeypatch):
    from stintwise.operators import graph_store

    rows = [(b, [(f"d{b}-{i}", None if i % 2 else i, [i]) for i in range(3)]) for b in (0, 1, 999, 1000, 2500)]
    batches = spark.createDataFrame(rows, "batch bigint, rows array<struct<src string, year int, more array<int>>>")
    ledger, target = str(tmp_path / "ledger"), str(tmp_path / "out")
    client = graph_store.folder_client(target)
    assert graph_store.send_batches_once(batches, client, ledger).count() == 5
    got = spark.read.schema("src string, year int, more array<int>").json(target).collect()
    assert sorted(tuple(r) for r in got) == sorted(x for _, part in rows for x in part)
    (tmp_path / "ledger" / "0" / "1").unlink()
    again = graph_store.send_batches_once(batches, client, ledger)
    assert [tuple(r) for r in again.collect()] == [(1, 3)]
    # what is written comes from a filter by number below the sender
    made, plain = [], graph_store.materialize
    monkeypatch.setattr(graph_store, "materialize", lambda df, name: made.append(df) or plain(df, name))
    assert graph_store.send_batches_once(batches, client, ledger).count() == 0
    plan = plan_text(made[0], "simple")
    assert plan.index("MapInArrow") < plan.index("Filter") < plan.index("ArrowEvalPython")

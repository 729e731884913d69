"""The driver contract: entry() smoke run and a stable schema per query."""

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["driverId", "const_out", "transfer_out", "const_in", "transfer_in"]
    assert df.count() > 0


def test_registry_is_complete():
    qs, oracle = entry.queries(), entry.oracle_sql()
    assert set(qs) - set(entry.ROWS_ONLY) == set(oracle)
    for name in ["debuts", "retirements_announced", "transfers_with_midseason", "breaks",
                 "graph_edges", "graph_nodes", "flatten_entries", "chain_dedupe", "dense_id",
                 "discover_keys", "doc_scan", "season_scan", "csv_roundtrip", "career_tables"]:
        assert name in qs


def test_schema_stable_across_calls(spark):
    from tests.conftest import SF001
    q = entry.queries()["breaks"]
    assert q(spark, SF001).schema == q(spark, SF001).schema

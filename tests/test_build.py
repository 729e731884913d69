"""build_all on a toy source tree shaped like the reference's YAML data."""

import os

import pytest

from stintwise.plans.build import build_all
from stintwise.session import scratch_path

SOURCE = os.path.join(os.path.dirname(__file__), "data", "source")


def read(spark, path):
    return spark.read.option("header", True).csv(path)


@pytest.fixture(scope="module")
def built(spark):
    return build_all(spark, SOURCE, scratch_path(spark, "build-all"))


def test_tables_written(built):
    for name in ["continents", "countries", "circuits", "previous_circuits_names", "drivers",
                 "drivers_relationships", "constructors", "rebranding_history", "driversAllYears",
                 "transferGraph/debuts", "transferGraph/retirements", "transferGraph/transfers",
                 "transferGraph/breaks", "graph/nodes", "graph/edges"]:
        assert name in built, name


def test_literal_codes_stay_text(spark, built):
    rows = {r["id"]: r for r in read(spark, built["continents"]).collect()}
    assert rows["north-america"]["code"] == "NA"
    countries = {r["id"]: r for r in read(spark, built["countries"]).collect()}
    assert countries["norway"]["alpha2Code"] == "NO"
    assert countries["united-states-of-america"]["demonym"] is None


def test_circuit_children(spark, built):
    c = read(spark, built["circuits"])
    assert "previousNames" not in c.columns and c.count() == 2
    names = sorted((r["id"], r["circuitId"], r["previousName"])
                   for r in read(spark, built["previous_circuits_names"]).collect())
    assert names == [("0", "monza", "Monza Old"), ("1", "monza", "Monza Older")]


def test_driver_relationships(spark, built):
    rel = sorted(tuple(r) for r in read(spark, built["drivers_relationships"]).collect())
    assert rel == [("0", "d1", "d2", "SIBLING"), ("1", "d2", "d1", "SIBLING")]
    d = {r["id"]: r for r in read(spark, built["drivers"]).collect()}
    assert d["d2"]["name"] == "Driver Two, Jr." and d["d1"]["dateOfBirth"] == "1990-01-02"


def test_rebranding_chain_once(spark, built):
    rows = sorted((r[0] or "", r[1], r[2], r[3] or "")
                  for r in read(spark, built["rebranding_history"]).collect())
    assert rows == [("", "minardi", "1985", "2005"), ("minardi", "toro-rosso", "2006", "2019"),
                    ("toro-rosso", "alphatauri", "2020", "")]


def test_season_flatten(spark, built):
    got = sorted(tuple(r) for r in read(spark, built["driversAllYears"]).collect())
    assert got == sorted([
        ("2019", "e1", "c1", "d1", "true", "false"), ("2019", "e1", "c1", "d2", "false", "true"),
        ("2019", "e2", "c2", "d3", "true", "false"), ("2020", "e2", "c2", "d1", "true", "false"),
        ("2020", "e1", "c1", "d3", "true", "false"), ("2023", "e1", "c3", "d1", "true", "false"),
        ("2023", "e1", "c3", "d2", "true", "false")])


def test_career_outputs(spark, built):
    transfers = sorted(tuple(r) for r in read(spark, built["transferGraph/transfers"]).collect())
    assert transfers == [("d1", "c1", "2019", "c2", "2020"), ("d3", "c2", "2019", "c1", "2020")]
    breaks = [tuple(r) for r in read(spark, built["transferGraph/breaks"]).collect()]
    assert breaks == [("d1", "c2", "2020", "c3", "2023")]
    edges = read(spark, built["graph/edges"])
    assert edges.count() == edges.dropDuplicates().count() > 0


def test_nested_list_absent_everywhere(spark, tmp_path):
    (tmp_path / "constructors").mkdir()
    (tmp_path / "constructors" / "a.yml").write_text("id: a\nname: A\n")
    out = build_all(spark, str(tmp_path), scratch_path(spark, "build-no-chain"))
    assert read(spark, out["constructors"]).count() == 1
    assert read(spark, out["rebranding_history"]).count() == 0


def test_graph_import_tables(spark, built):
    nodes = read(spark, built["graph/import/nodes"])
    rels = read(spark, built["graph/import/relationships"])
    assert nodes.columns == ["id:ID", "name", ":LABEL"]
    assert rels.columns == [":START_ID", ":END_ID", ":TYPE", "year:int"]
    ids = {r[0] for r in nodes.collect()}
    assert {r[0] for r in rels.collect()} | {r[1] for r in rels.collect()} <= ids
    assert ("Driver:d1", "Team:c3", "RETURN", "2023") in {tuple(r) for r in rels.collect()}


def test_cluster_conf_sizes_partitions():
    from stintwise.session import STATUS_BYTES, cluster_conf
    conf = cluster_conf(100 * 2**40, 8000)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    partitions = int(conf["spark.sql.shuffle.partitions"])
    assert partitions == 100 * 2**40 // 8 // (256 << 20)
    scan_tasks = 100 * 2**40 // int(conf["spark.sql.files.maxPartitionBytes"])
    assert scan_tasks * partitions / 8 <= STATUS_BYTES
    assert conf["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert int(cluster_conf(1 << 20, 16)["spark.sql.shuffle.partitions"]) == 32


@pytest.mark.parametrize("entry, lacks", [
    ("- entrantId: e1\n  constructorId: c1\n  driverId: d1\n", "rounds"),
    ("- entrantId: e1\n", "constructors"),
    ("- entrantId: e1\n  constructorId: c1\n", "drivers"),
    ("- entrantId: e1\n  constructors:\n  - constructorId: c1\n    drivers:\n    - driverId: d1\n", "rounds"),
    ("- entrantId: e1\n  constructors:\n  - driverId: d1\n    rounds: 1\n", "constructorId"),
    ("- constructorId: c1\n  driverId: d1\n  rounds: 1\n", "entrantId"),
])
def test_strict_seasons_fail_on_incomplete_entries(spark, tmp_path, entry, lacks):
    from stintwise.sources.documents import read_season_documents
    whole = "- entrantId: e0\n  constructorId: c0\n  drivers:\n  - driverId: d0\n    rounds:\n"
    (tmp_path / "2001").mkdir()
    (tmp_path / "2001" / "entrants.yml").write_text(whole)
    got = [tuple(r) for r in read_season_documents(spark, str(tmp_path), strict=True).collect()]
    assert got == [(2001, "e0", "c0", "d0", False, False)]
    (tmp_path / "2001" / "entrants.yml").write_text(whole + entry)
    with pytest.raises(Exception, match=f"lacks {lacks}"):
        read_season_documents(spark, str(tmp_path), strict=True).collect()
    assert read_season_documents(spark, str(tmp_path)).count() == 2


def test_ordered_seasons_keep_year_path_and_place(spark, tmp_path):
    from stintwise.sources.documents import read_season_documents
    want = []
    for year in (998, 1001, 2000):
        (tmp_path / str(year)).mkdir()
        for file in ("a.yml", "b.yml"):
            text = ""
            for i in range(40):
                text += f"- entrantId: e{i}\n  constructorId: c\n  drivers:\n"
                for d in ("z", "a"):
                    text += f"  - driverId: {d}{file[0]}\n    rounds: 1\n"
                    want.append((year, f"e{i}", d + file[0]))
            (tmp_path / str(year) / file).write_text(text)
    rows = read_season_documents(spark, str(tmp_path), pattern="*/*.yml", ordered=True)
    assert [(r.year, r.entrantId, r.driverId) for r in rows.collect()] == want


def test_absent_datasets_are_named(spark, tmp_path):
    (tmp_path / "continents").mkdir()
    (tmp_path / "continents" / "a.yml").write_text("id: a\ncode: AA\n")
    with pytest.warns(UserWarning, match="not built: .*circuits.*seasons"):
        build_all(spark, str(tmp_path), scratch_path(spark, "absent"))


def test_command_line_build(spark, capsys):
    from stintwise.__main__ import main
    main(["build", SOURCE, scratch_path(spark, "cli-build")])
    assert '"transferGraph/breaks"' in capsys.readouterr().out


def test_fact_table_partitioned_by_year(spark, built):
    from stintwise.sources.tables import read_fact_table
    a = read_fact_table(spark, built["appearances"])
    assert a.columns == ["year", "entrantId", "constructorId", "driverId", "tookPart", "testDriver"]
    assert sorted(r[0] for r in a.select("year").distinct().collect()) == [2019, 2020, 2023]
    files = [r[0] for r in spark.read.format("binaryFile").load(built["appearances"])
             .select("path").collect()]
    assert files and all("/year=" in f for f in files)


def test_strict_build_fails_on_missing_key(spark, tmp_path):
    (tmp_path / "continents").mkdir()
    (tmp_path / "continents" / "a.yml").write_text("id: a\ncode: AA\n")
    (tmp_path / "continents" / "b.yml").write_text("id: b\n")
    with pytest.raises(Exception, match="lacks key"):
        build_all(spark, str(tmp_path), scratch_path(spark, "strict"), strict=True)
    out = build_all(spark, str(tmp_path), scratch_path(spark, "lenient"))
    rows = {r["id"]: r["code"] for r in read(spark, out["continents"]).collect()}
    assert rows == {"a": "AA", "b": None}


def test_column_order_follows_documents(spark, built):
    assert read(spark, built["continents"]).columns == ["id", "code", "name", "demonym"]
    assert read(spark, built["countries"]).columns == [
        "id", "alpha2Code", "alpha3Code", "name", "demonym", "continentId"]
    assert read(spark, built["circuits"]).columns == [
        "id", "name", "fullName", "type", "latitude", "longitude"]

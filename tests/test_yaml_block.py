"""The line reader of block records against the YAML library, and the files of written seasons."""

import glob
import random

import pytest
import yaml

from stintwise.plans import registry
from stintwise.session import scratch_path
from stintwise.sources import documents
from stintwise.sources import nested_bindings as nb
from tests.conftest import SF001

SIMPLE = [
    '- entrantId: "1"\n  constructorId: "2"\n  driverId: "3"\n  rounds: \n  testDriver: true\n',
    '- entrantId: "1"\n  constructors:\n  - constructorId: "2"\n    drivers:\n    - driverId: "3"\n      rounds: "A"\n'
    '    - driverId: "4"\n      rounds:\n  - constructorId: "5"\n    driverId: "6"\n    rounds: "N"\n',
    '- a:\n    - b: 1\n      c:\n        d: false\n    - b: -2\n  e: 0\n- a: "x: - y # z"\n',
    '---\nid: 12\ntext: "q\\"\\\\ \\n\\t\\r\\b\\f \\u00e9\\u0085 \u00e9 \U0001f600 "\n', 'a:\nb:\n- c: 1\nd: 2\n', 'a: 1\na: 2',
]
OTHER = ["- a: b\n", "a: 1 # note\n", "a: 'x'\n", 'a: "x\n  y"\n', 'a: "\\x41"\n', "- &k\n  a: 1\n", "a: 010\n", "a: 1_0\n", "a: 1.5\n",
         "yes: 1\n", "a: {b: 1}\n", "a: yes\n", "a: 1\n\nb: 2\n", "a: 1\r\n", "---\n", "a: !!str 1\n", "? a\n", "- - a: 1\n"]
WRONG = ["a: 1\n  b: 2\n", "- a: 1\nb: 2\n", "a:\n  b: 1\n c: 2\n", "a: 1\n- b: 2\n", '- a: "\\ud83d"\n', '- a: "x" y\n', "a: \t1\tb: 2\n"]


def test_block_records_are_what_the_library_reads():
    read = documents.block_reader()
    for text in SIMPLE:
        assert read(text) == yaml.safe_load(text) is not None, text
    for text in [*OTHER, *WRONG]:
        assert read(text) is None, text


def test_cut_and_mixed_block_lines_are_read_as_the_library_does():
    read, rnd = documents.block_reader(), random.Random(3)
    lines = [f"{' ' * k}{x}" for k in (0, 2, 4) for x in
             ("- a: 1", 'b: "x"', "c:", "- d:", "a: true", 'e: ""', "- f: word", "g: 2")]
    taken = 0
    for _ in range(20_000):
        text = "\n".join(rnd.choice(lines) for _ in range(rnd.randint(1, 6))) + "\n"
        got = read(text)
        if got is not None:
            assert got == yaml.safe_load(text), text
            taken += 1
    assert taken > 200


def test_records_of_registered_queries_need_no_library(spark):
    """Each written record is in block form; nothing but speed depends on it."""
    read = documents.block_reader()
    seasons = nb.season_yaml(nb.season_entries(spark, SF001)).select("yaml")
    texts = documents.yaml_map_document(registry.table(spark, SF001, "documents"), {
        "doc_id": documents.F.col("doc_id").cast("string"), "text": documents.yaml_quote(documents.F.col("text"))})
    for r in seasons.limit(500).collect() + texts.collect():
        assert read(r.yaml) == yaml.safe_load(r.yaml) is not None


@pytest.mark.parametrize("tasks", [1, 12])
def test_a_season_has_few_files_whatever_its_tasks(spark, tasks):
    rows = [(y, f'- entrantId: "{y}-{i}"') for y in (2001, 2002) for i in range(3_000)]
    path = scratch_path(spark, "few-files").removeprefix("file://")
    documents.write_yaml(spark.createDataFrame(rows, "year int, yaml string").repartition(tasks), path, partition_by="year")
    assert len(glob.glob(f"{path}/*/*.txt")) == 2
    assert sorted(spark.read.text(path).select("year", "value").collect()) == sorted(rows)


def test_a_worker_takes_few_records_at_a_time(spark, monkeypatch):
    """An Arrow batch of many records becomes Python strings piece by piece, with the same result."""
    frame = spark.createDataFrame([("p", 0, f'id: {i}\n') for i in range(300)], "_path string, _start bigint, _text string").coalesce(1)
    whole = documents.parse_yaml(frame, mark=documents.DOCUMENT_MARK).collect()
    monkeypatch.setattr(documents, "PARSE_ROWS", 7)
    assert documents.parse_yaml(frame, mark=documents.DOCUMENT_MARK).collect() == whole


def test_quoted_scalars_read_back_whatever_they_hold(spark):
    texts = [None, "", "plain", "plain\n", 'a"b', "a\\b", "é", "\x7f\x85 ", "~ !#[]", "tab\t", "\U0001f600"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        documents.F.concat(documents.F.lit("t: "), documents.yaml_quote(documents.F.col("t"))).alias("y")).collect()
    assert [yaml.safe_load(r.y)["t"] for r in rows] == texts
    assert [documents.block_reader()(r.y)["t"] for r in rows] == texts


def test_numbered_seasons_are_parsed_once(spark, tmp_path):
    (tmp_path / "2001").mkdir()
    (tmp_path / "2001" / "entrants.yml").write_text('- entrantId: "e"\n  constructorId: "c"\n  driverId: "d"\n  rounds: "1"\n' * 50)
    parsed = spark.sparkContext.accumulator(0)
    plain = documents.parse_yaml

    def counted(files, items=False, mark=None):
        rows = plain(files, items, mark)

        def count(batches):
            for b in batches:
                parsed.add(b.num_rows)
                yield b
        return rows.mapInArrow(count, rows.schema)

    documents.parse_yaml = counted
    try:
        got = documents.read_season_documents(spark, str(tmp_path), position="place").collect()
    finally:
        documents.parse_yaml = plain
    assert sorted(r.place for r in got) == list(range(50)) and parsed.value == 50

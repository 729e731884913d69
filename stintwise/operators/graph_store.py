"""A stored edge table that is merged in place (GR-6), and a load that can go on where it stopped (GR-7).

Edges lie as parquet, partitioned by relationship type and by a hash of the source.  A
merge reads only the partitions that its new rows fall into and adds files to those that
gain a row; all other files stay as they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintwise.operators.graph import EDGE_COLUMNS, merge_added
from stintwise.session import materialize, scratch_path

EDGE_SCHEMA = "src_label string, src string, dst_label string, dst string, year int, type string, bucket int"
BUCKETS = 64


def _bucketed(edges: DataFrame, buckets: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64("src"), F.lit(buckets).cast("long")).cast("int")
    return edges.select(*EDGE_COLUMNS).withColumn("bucket", bucket)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows with their bucket; none if nothing is stored yet."""
    try:
        return spark.read.schema(EDGE_SCHEMA).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EDGE_SCHEMA)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """The stored edges."""
    return _stored(spark, path).select(*EDGE_COLUMNS)


def merge_edges(path: str, new: DataFrame, buckets: int = BUCKETS) -> int:
    """GR-6 into storage: add the edges of ``new`` that are not stored yet; returns how many.

    ``new`` is evaluated once.  Which (type, bucket) partitions it touches is at most
    types x ``buckets`` pairs; the stored side of the anti-join is filtered by them, so other
    partitions are not read.  A source with very many edges is one bucket but many join
    keys (all columns), and the write is rebalanced, so it is spread over tasks and files.
    A merge that fails leaves no row (the job's commit is the last step), and one that is
    repeated adds nothing.  One merge at a time: two at once may both add a row.
    """
    spark = new.sparkSession
    rows = materialize(_bucketed(new, buckets).dropDuplicates(EDGE_COLUMNS), "merge-new")
    touched = [(r["type"], r["bucket"]) for r in rows.select("type", "bucket").distinct().collect()]
    if not touched:
        return 0
    by_type: dict[str, list[int]] = {}
    for kind, bucket in touched:
        by_type.setdefault(kind, []).append(bucket)
    here = F.lit(False)
    for kind, found in sorted(by_type.items()):
        here = here | ((F.col("type") == kind) & F.col("bucket").isin(sorted(found)))
    added = materialize(merge_added(_stored(spark, path).where(here), rows, EDGE_COLUMNS, unique=True), "merge-added")
    count = added.count()
    if count:
        added.hint("rebalance", "type", "bucket").write.mode("append").partitionBy("type", "bucket").parquet(path)
    return count


def send_batches_once(batches: DataFrame, open_sink, ledger: str) -> DataFrame:
    """GR-7 with a ledger: batches that the ledger lists are not sent again; returns this run's receipts.

    ``batches`` has ``batch`` and ``rows`` (``graph.edge_batches``: the same edges give the same
    batches).  ``open_sink()`` runs once per task and returns ``send(batch, rows)``, rows as a
    list of dicts, and optionally a ``close`` attribute.  After each batch the task writes
    one small file ``<ledger>/<batch // 1000>/<batch>`` to shared storage, so a retried task, a second
    attempt of a whole job and a speculative copy that comes later skip what was sent.
    A task that dies between the client's answer and that file sends one batch
    again; ``batch`` is a key by which a client can refuse it.  ``ledger`` is a URI (or
    path) that ``pyarrow.fs`` opens on every executor.

    Batches that are listed when a task comes to them are left out by their number, before
    their rows go to a Python worker; the others are looked up once more when it is their turn.
    """

    @F.arrow_udf("boolean")
    def unsent(numbers: pa.Array) -> pa.Array:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(ledger) if "://" in ledger else (fs.LocalFileSystem(), ledger)
        found = store.get_file_info([f"{root.rstrip('/')}/{n // 1000}/{n}" for n in numbers.to_pylist()])
        return pa.array([f.type != fs.FileType.File for f in found], pa.bool_())

    def send_all(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(ledger) if "://" in ledger else (fs.LocalFileSystem(), ledger)
        send, made = None, set()
        try:
            for part in parts:
                numbers, lists = part.column("batch").to_pylist(), part.column("rows")
                sent = []
                for i, number in enumerate(numbers):
                    folder = f"{root.rstrip('/')}/{number // 1000}"
                    if store.get_file_info(f"{folder}/{number}").type == fs.FileType.File:
                        continue
                    if send is None:
                        send = open_sink()
                    columns = lists[i].values            # row by row, scalars cost most of the time
                    rows = [dict(zip(columns.type.names, r)) for r in zip(*(c.to_pylist() for c in columns.flatten()))]
                    send(number, rows)
                    if folder not in made:
                        store.create_dir(folder, recursive=True)
                        made.add(folder)
                    with store.open_output_stream(f"{folder}/{number}") as f:
                        f.write(str(len(rows)).encode())
                    sent.append((number, len(rows)))
                yield pa.RecordBatch.from_pydict({"batch": pa.array([n for n, _ in sent], pa.int64()),
                                                  "rows": pa.array([k for _, k in sent], pa.int64())})
        finally:
            close = getattr(send, "close", None)
            if close is not None:
                close()

    rest = batches.select("batch", "rows").where(unsent("batch"))
    return materialize(rest.mapInArrow(send_all, "batch bigint, rows bigint"), "receipts")


def folder_client(uri: str):
    """An ``open_sink`` that stores every batch as one file of JSON lines under ``uri``, replacing it if it is there."""

    def open_sink():
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
        store.create_dir(root, recursive=True)
        to_json = json.JSONEncoder(ensure_ascii=False).encode

        def send(batch: int, rows: list[dict]) -> None:
            with store.open_output_stream(f"{root.rstrip('/')}/{batch}.json") as f:
                f.write("".join(to_json(r) + "\n" for r in rows).encode())

        return send

    return open_sink


def new_ledger(spark: SparkSession) -> str:
    """A ledger folder under the shared directory."""
    return scratch_path(spark, "ledger")


__all__ = ["read_edges", "merge_edges", "send_batches_once", "folder_client", "new_ledger"]

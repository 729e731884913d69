"""Sharding: a uniform shuffle by a hypergeometric communication matrix.

Three steps, all bounded per task:

1. every input partition is counted, and the number of its rows that go to each
   *cell* is drawn from the exact (multivariate hypergeometric) law.  A cell is
   a run of at most ``cell_rows`` output slots of one shard, fewer where the mean
   row is so long that they would pass ``cell_bytes``, so the target sizes
   are exact and no task holds more than a cell (which Spark sorts, spilling);
2. every partition permutes its own rows and deals them to the cells by that
   row of the matrix;
3. the rows are exchanged by cell, and each cell orders its rows at random.

Together these give a uniform random order of the whole table cut into shards
whose row counts differ by at most one.  The matrix is never held whole: the
partitions form the leaves of a binary tree, a node splits its cell counts
between its two halves with a generator seeded by the node, and a task draws
only the nodes on the path to its own partition.

Whole rows are exchanged, texts included, and ``write_shards`` writes them as files
that ``read_shards`` reads back.  The rows' places are read from a table written once to the shared folder, so a
recomputed task sees the same partitions, counts and order.

Defined cases: a null text has no bytes (size 1, crc32 0); equal texts are
independent rows, dealt by themselves (this law keeps no groups together);
repeated rows and null keys each get a slot of their own; fewer rows than shards
leave the last shards empty; an empty table gives an empty result.  Further
columns of the input are carried along; columns named like the results (``shard``,
``slot``) or the working columns (``_at``, ``_cell``, ``_rank``, ``_first``, ``_to``, ``_bytes``) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stintwise.llm.common import without
from stintwise.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row within the partition below


def shard_cells(rows: int, shards: int, cell_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard, first slot and size of every cell; shard sizes differ by at most one."""
    sizes = np.full(shards, rows // shards, dtype=np.int64)
    sizes[: rows % shards] += 1
    shard, first, size = [], [], []
    for s, n in enumerate(sizes):
        parts = max(1, -(-int(n) // cell_rows))
        edges = np.linspace(0, n, parts + 1).astype(np.int64)
        shard += [s] * parts
        first += edges[:-1].tolist()
        size += np.diff(edges).tolist()
    return np.array(shard), np.array(first, np.int64), np.array(size, np.int64)


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, take: int) -> int:
    """One exact draw; numpy's sampler takes populations below 1e9, larger ones are inverted here."""
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, take))
    n = float(good + bad)
    mean = take * (good / n)
    sd = max(1.0, (mean * (bad / n) * ((n - take) / (n - 1))) ** 0.5)
    lo = max(0, take - bad, int(mean - 14 * sd))
    hi = min(good, take, int(mean + 14 * sd) + 1)      # beyond 14 deviations: under 1e-40
    k = np.arange(lo, hi, dtype=np.float64)
    steps = np.log(good - k) + np.log(take - k) - np.log(k + 1) - np.log(bad - take + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    law = np.cumsum(np.exp(logs - logs.max()))
    return lo + int(np.searchsorted(law, rng.random() * law[-1], side="right"))


def _split(rng: np.random.Generator, cells: np.ndarray, take: int) -> np.ndarray:
    """How many of ``take`` rows drawn without replacement fall in each cell."""
    out = np.zeros_like(cells)
    left = int(cells.sum())
    for i, c in enumerate(cells):
        if take <= 0:
            break
        left -= int(c)
        out[i] = _hypergeometric(rng, int(c), left, take) if c and left else min(int(c), take)
        take -= int(out[i])
    return out


def matrix_row(sums: np.ndarray, cells: np.ndarray, part: int, seed: int) -> np.ndarray:
    """Rows that partition ``part`` sends to each cell; ``sums`` are cumulated partition sizes."""
    lo, hi, have = 0, len(sums) - 1, cells.copy()
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = _split(np.random.default_rng([seed, lo, hi]), have, int(sums[mid] - sums[lo]))
        if part < mid:
            hi, have = mid, left
        else:
            lo, have = mid, have - left
    return have


def shuffle_to_shards(df: DataFrame, shards: int = 8, cell_rows: int = 1 << 16, seed: int = 17,
                      cell_bytes: int = 32 << 20) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (gapless from 0 in each shard), uniformly shuffled.

    One task holds one cell; tasks are numbered by shard and first slot.
    """
    df = without(df, "shard", "slot", "_at", "_cell", "_rank", "_first", "_to", "_bytes")
    size_of = reduce(add, (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("bigint")
                           for c in df.columns), F.lit(0).cast("bigint"))
    placed = materialize(df.withColumn("_bytes", size_of).withColumn("_at", F.monotonically_increasing_id()),
                         "shard-rows", compression="zstd")
    part = F.shiftrightunsigned(F.col("_at"), _ROW_BITS)
    # One row per input partition: its number, its row count and its bytes.
    parts = (placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("b"))
             .orderBy("p").collect())
    total = sum(r.n for r in parts)
    mean = max(1, sum(r.b for r in parts) // max(1, total))
    shard, first, size = shard_cells(total, shards, max(1, min(cell_rows, cell_bytes // mean)))
    numbers = np.array([r.p for r in parts], np.int64)
    sums = np.concatenate([[0], np.cumsum([r.n for r in parts])]).astype(np.int64)

    # Only the rows' places go through Python; the rows themselves wait in the JVM.
    @F.pandas_udf("cell int, shard int, first bigint")
    def deal(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        dealt: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.to_numpy()
            cell = np.empty(len(at), np.int32)
            own = at >> _ROW_BITS
            for p in np.unique(own):
                if p not in dealt:
                    dealt.clear()
                    i = int(np.searchsorted(numbers, p))
                    row = np.repeat(np.arange(len(size), dtype=np.int32), matrix_row(sums, size, i, seed))
                    dealt[p] = np.random.default_rng([seed, 1, i]).permutation(row)
                mine = own == p
                cell[mine] = dealt[p][at[mine] & ((1 << _ROW_BITS) - 1)]
            yield pd.DataFrame({"cell": cell, "shard": shard[cell].astype(np.int32), "first": first[cell]})

    rows = placed.drop("_bytes").withColumn("_to", deal("_at"))
    rows = rows.select("*", F.col("_to.cell").alias("_cell")).repartitionById(len(size), F.col("_cell"))
    order = Window.partitionBy("_cell").orderBy(F.xxhash64(F.lit(seed), F.col("_at")), "_at")
    return rows.withColumn("_rank", F.row_number().over(order) - 1).select(
        *[F.col(f"`{c}`") for c in df.columns], F.col("_to.shard").alias("shard"),
        (F.col("_to.first") + F.col("_rank")).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write ``shard=<n>`` folders of parquet files, rows in slot order within and across files.

    ``sharded`` comes from ``shuffle_to_shards``, whose tasks follow the slots: each writes its cell
    as one file, and the rows are not exchanged again.
    """
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path, compression="zstd")


def read_shards(sharded: DataFrame, path: str) -> DataFrame:
    """What ``write_shards`` wrote of ``sharded``, read back."""
    return sharded.sparkSession.read.schema(sharded.schema).parquet(path).select(
        *[F.col(f"`{c}`") for c in sharded.columns])


def size_and_crc(docs: DataFrame, key: str = "doc_id", text: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``size`` (UTF-8 bytes plus one), ``text_crc32`` and ``more`` of every row; null texts are empty."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key), (F.octet_length(t) + 1).cast("bigint").alias("size"),
                       F.crc32(t.cast("binary")).alias("text_crc32"), *more)

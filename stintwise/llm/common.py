"""Small helpers shared by the operators: Arrow slices, byte views, word hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes [\x09-\x0D\x20] separate words everywhere in this subpackage.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE_KEYS = np.random.default_rng(20240607).integers(1, _MASK, 256, dtype=np.uint64, endpoint=True)
_powers: dict[int, np.ndarray] = {}


def table(spark, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns whose names an operator gives to its results."""
    return df.drop(*[c for c in df.columns if c.lower() in names])


def id_hash(doc_id: Column) -> Column:
    """crc32 of the id's decimal text (null ids count as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def slices(batches: Iterable[pa.RecordBatch], text: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows holding about ``max_bytes`` of text.

    A run always holds at least one row, so a text of any length is passed whole.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        cut = np.cumsum(size, dtype=np.int64) // max_bytes
        edges = np.flatnonzero(np.diff(cut)) + 1
        start = 0
        for end in [*edges.tolist(), batch.num_rows]:
            if end > start:
                yield batch.slice(start, end - start)
            start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column as one array, and row offsets (nulls are empty)."""
    arr = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64)[arr.offset:arr.offset + n + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            np.cumprod(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (exclusive) and row numbers of the white-space separated words."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    solid = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:n]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | edge[1:n]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(offsets, starts, side="right") - 1


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte span; equal spans have equal hashes in any row or process."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    n = len(data)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_KEYS[data] * _power(_BASE, n), out=sums[1:])
        h = (sums[ends] - sums[starts]) * _power(_BASE_INV, n + 1)[starts]
        h += (ends - starts).astype(np.uint64)
    return mix(h)

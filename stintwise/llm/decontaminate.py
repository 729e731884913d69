"""Benchmark decontamination by the q-gram lemma.

An occurrence of a benchmark text of m bytes with at most k edits shares at least
``m + 1 - (k + 1) q`` q-grams with it, all within k + 1 neighbouring diagonals (text
position minus benchmark position).  So:

1. every position of a text is looked up in the benchmark's q-grams (one hash per
   position, a small table first, then exact 64-bit hashes);
2. positions in parts of the text that hold too few hits for any item are left out
   (pigeonhole over blocks of ``BLOCK`` positions);
3. the other hits are counted by item and diagonal band; bands are ``2 (k + 1)`` wide
   and start every ``k + 1`` diagonals, so any k + 1 neighbouring ones lie in one band;
4. bands that meet the bound are verified by a banded alignment, which gives the span
   and its edits.

Texts are compared as bytes with A-Z and the Latin-1 capitals lower-cased and runs of
white space as one space; spans are byte offsets in the text as given.

The benchmark is broadcast in blocks of at most ``block_bytes`` of text; a larger one is
searched in several passes over the documents, so what is broadcast is always bounded.
No pass shuffles.

Defined cases: null and empty texts match nothing; benchmark texts shorter than q bytes
match nothing (they cannot be told from chance), null ones neither; repeated benchmark
rows are reported each; a text with several occurrences of an item gives a row for
each that is apart; long texts are searched whole; an empty table on either side gives no match.
``matches`` ignores further columns, ``clean`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stintwise.llm.common import _SPACE, mix, slices, text_bytes

Q = 12
ERROR_RATE = 0.05           # edits allowed for each byte of a benchmark text
BLOCK = 64
_TABLE_BITS = 22


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with single spaces, their row offsets, and each byte's place in ``data``."""
    low = data.copy()
    caps = (low >= 65) & (low <= 90)
    if len(low) > 1:     # the capitals of Latin-1 are C3 80 to C3 9E, but for C3 97
        caps[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    low[caps] += 32
    space = _SPACE[low]
    low[space] = 32
    keep = np.ones(len(low), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    inner = offsets[(offsets > 0) & (offsets < len(low))]
    keep[inner] = True
    place = np.flatnonzero(keep)
    return low[place], np.searchsorted(place, offsets), place


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q bytes at each position."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    with np.errstate(over="ignore"):
        return mix(eight[:n] * np.uint64(0x9E3779B97F4A7C15) + eight[Q - 8:Q - 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F))


def budget(m: int, rate: float = ERROR_RATE) -> int:
    """Edits allowed for an item of m bytes, so that the bound on shared q-grams is at least 1; -1: no search."""
    return min(int(rate * m), m // Q - 1)


def banded_alignment(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int,
                     anchored: bool = False) -> tuple[int, int] | None:
    """Least edits of ``item`` in ``text`` on diagonals ``low`` to ``high``, and the text position after it.

    The occurrence starts anywhere in the band, or at 0 if ``anchored``.  None: more than ``most`` edits.
    """
    width, far = high - low + 1, most + 1
    lane = np.arange(width)
    at = low + lane                               # text positions before item byte i, per diagonal
    inside = (at >= 0) & (at <= len(text))
    row = np.where(inside, 0 if not anchored else np.abs(at), far).astype(np.int64)
    if anchored:
        row = np.where((at >= 0) & inside, at, far)
    for byte in item:
        at = at + 1
        before = np.clip(at - 1, 0, len(text) - 1)
        swap = row + (text[before] != byte)
        swap[(at - 1 < 0) | (at > len(text))] = far
        drop = np.append(row[1:] + 1, far)        # item byte left out: next diagonal, same text position
        row = np.minimum(swap, drop)
        row[(at < 0) | (at > len(text))] = far
        row = np.minimum.accumulate(row - lane) + lane        # text bytes put in
        row = np.minimum(row, far)
        if row.min() >= far:
            return None
    end = int(np.argmin(row))
    return int(row[end]), int(low + end + len(item))


@dataclass
class Index:
    """The q-grams of some benchmark texts."""

    ids: list
    items: list[np.ndarray]
    edits: np.ndarray          # budget of each item
    bound: np.ndarray          # q-grams that an occurrence must share
    grams: np.ndarray          # different hashes, sorted
    first: np.ndarray          # start of each hash's postings
    item: np.ndarray
    place: np.ndarray
    small: np.ndarray          # table by a hash's top bits
    block_hits: int            # hits that some block of any occurrence must hold
    reach: int                 # blocks that an occurrence may span

    @classmethod
    def build(cls, ids: list, texts: list[str], rate: float = ERROR_RATE) -> Index | None:
        kept = []
        for i, t in zip(ids, texts):
            raw = np.frombuffer((t or "").strip().encode(), np.uint8)
            low, _, _ = normalised(raw, np.array([0, len(raw)]))
            if budget(len(low), rate) >= 0:
                kept.append((i, low))
        if not kept:
            return None
        items = [x for _, x in kept]
        size = np.array([len(x) for x in items])
        edits = np.array([budget(int(m), rate) for m in size])
        bound = size + 1 - (edits + 1) * Q
        hashes = [gram_hashes(x) for x in items]
        flat = np.concatenate(hashes)
        item = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes])
        by = np.argsort(flat, kind="stable")
        grams, first = np.unique(flat[by], return_index=True)
        small = np.zeros(1 << _TABLE_BITS, bool)
        small[grams >> np.uint64(64 - _TABLE_BITS)] = True
        spans = (size + edits) // BLOCK + 2
        return cls([i for i, _ in kept], items, edits, bound, grams, np.append(first, len(flat)), item[by], place[by],
                   small, int(max(1, (-(-bound // spans)).min())), int(spans.max()))

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text positions with a benchmark q-gram and the gram's number, in parts dense enough to matter."""
        h = gram_hashes(data)
        at = np.flatnonzero(self.small[h >> np.uint64(64 - _TABLE_BITS)])
        number = np.searchsorted(self.grams, h[at])
        number[number == len(self.grams)] = 0
        row_end = offsets[np.searchsorted(offsets, at, side="right")]
        ok = (self.grams[number] == h[at]) & (at + Q <= row_end)
        at, number = at[ok], number[ok]
        blocks = np.bincount(at // BLOCK, minlength=1)
        full = np.flatnonzero(blocks >= self.block_hits)
        near = np.zeros(len(blocks) + 1, np.int64)
        np.add.at(near, np.maximum(full - self.reach, 0), 1)
        np.add.at(near, np.minimum(full + self.reach + 1, len(blocks)), -1)
        ok = (np.cumsum(near) > 0)[at // BLOCK]
        return at[ok], number[ok]

    def candidates(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item, band) that meet the bound; the band starts at diagonal ``band * (k + 1)``."""
        at, number = self.hits(data, offsets)
        n = self.first[number + 1] - self.first[number]
        posting = np.repeat(self.first[number], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at, item = np.repeat(at, n), self.item[posting]
        row = np.searchsorted(offsets, at, side="right") - 1
        step = self.edits[item] + 1
        # diagonals count from the row's start; band b covers b * step up to (b + 2) * step
        band = np.floor_divide(at - offsets[row] - self.place[posting], step)
        keys = np.stack([np.concatenate([row, row]), np.concatenate([item, item]), np.concatenate([band, band - 1])])
        by = np.lexsort(keys[::-1])
        keys = keys[:, by]
        new = np.ones(keys.shape[1], bool)
        new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, keys.shape[1]))
        keys = keys[:, start]
        return keys[:, count >= self.bound[keys[1]]].T.tolist()

    def search(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, object, int, int, int]]:
        """(row, item id, start, end, edits) of every occurrence; byte offsets in the row's text."""
        low, rows, place = normalised(data, offsets)
        out: list[tuple[int, object, int, int, int]] = []
        done: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for row, i, band in self.candidates(low, rows):
            item, k = self.items[i], int(self.edits[i])
            text = low[rows[row]:rows[row + 1]]
            begin = band * (k + 1) - k                       # one more step on either side
            end = (band + 2) * (k + 1) - 1 + k
            lo = max(0, begin)
            part = text[lo:max(lo, end + len(item) + k)]
            exact = part.tobytes().find(item.tobytes())
            if exact >= 0:
                span, edits = (lo + exact, lo + exact + len(item)), 0
            else:
                got = banded_alignment(item, part, begin - lo, end - lo, k) if len(part) else None
                if got is None:
                    continue
                edits, stop = got
                back = banded_alignment(item[::-1], part[:stop][::-1], -k, k, k, anchored=True)
                span = (lo + (stop - back[1] if back else max(0, stop - len(item))), lo + stop)
            if any(span[0] < e and s < span[1] for s, e in done.setdefault((row, i), [])):
                continue
            done[row, i].append(span)
            at = place[rows[row]:rows[row + 1]]
            out.append((row, self.ids[i], int(at[span[0]] - offsets[row]), int(at[span[1] - 1] + 1 - offsets[row]), edits))
        return out


def _indexes(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[Index]:
    """Indexes of the benchmark, each over at most ``block_bytes`` of text (or one item)."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col(item).alias("i"), F.col(text).cast("string").alias("t"))
    for r in rows.where("t is not null").toLocalIterator():
        if ids and size + len(r.t.encode()) > block_bytes:
            if index := Index.build(ids, texts):
                yield index
            ids, texts, size = [], [], 0
        ids.append(r.i)
        texts.append(r.t)
        size += len(r.t.encode())
    if ids and (index := Index.build(ids, texts)):
        yield index


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
            item_text: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """``key``, ``item``, ``start``, ``end``, ``edits`` of every occurrence of a benchmark text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    schema = (f"`{key}` {rows.schema[key].dataType.simpleString()}, "
              f"`{item}` {benchmark.schema[item].dataType.simpleString()}, start bigint, end bigint, edits int")
    out = spark.createDataFrame([], schema)
    item_type = to_arrow_type(benchmark.schema[item].dataType)
    for index in _indexes(benchmark, item, item_text, block_bytes):
        shared = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "_text"):
                got = shared.value.search(*text_bytes(batch.column("_text")))
                if got:
                    at, ids, start, end, edits = zip(*got)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(key).take(pa.array(at)), pa.array(ids, item_type), pa.array(start, pa.int64()),
                         pa.array(end, pa.int64()), pa.array(edits, pa.int32())], [key, item, "start", "end", "edits"])

        out = out.unionByName(rows.mapInArrow(search, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
          item_text: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark text."""
    spark = docs.sparkSession
    for index in _indexes(benchmark, item, item_text, block_bytes):
        shared = spark.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text):
                hit = np.zeros(batch.num_rows, bool)
                hit[[m[0] for m in shared.value.search(*text_bytes(batch.column(text)))]] = True
                yield batch.filter(pa.array(~hit))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs

"""Hierarchical multi-length packing of tokenised documents.

Each task packs the documents of its own partition; nothing is shuffled.  Windows
have the sizes of the tiers, all powers of two.  A document first gives whole
windows of the largest tier; the rest is routed to the smallest tier that holds it.
A tier's windows are packed longest document first, and the gap that is left in a
window is filled from shorter tiers: first with whole documents (best fit), then with
the head of one that is cut, whose rest goes back to its tier.  Windows that cannot be
filled in a block of ``block_tokens`` go back to the queues for the next block.  The
tail of a partition is cut at its binary digits, so every sequence is a power of two
long and none is padded; at most 12 short sequences per partition come of it.

Sequences are dealt to step groups of about ``step_tokens``, always the next longest to
the group with the fewest tokens, so the groups of a block differ by less than a window.

Token ids come from the library, word by word: the tokenizer's patterns never match
white space and its normaliser never joins characters across it, so a text's ids are
its words' ids in order.  Texts that hold ``<|`` (special strings) are encoded whole.
The words' ids are cached per worker, up to ``cache_entries``.

Defined cases: a null or empty text is the end id alone; repeated rows and equal ids are
packed row by row; long texts are cut, never shortened; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import os
import re
import uuid
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintwise.llm.common import slices

TIERS = (512, 1024, 2048, 4096)
_ENDED = re.compile(rb"([a-z]+)([^\sa-z0-9'\x80-\xff]+)")


class WordIds:
    """Ids of texts under a tokenizer file, through a bounded cache of words (ids as uint16 bytes)."""

    def __init__(self, path: str, cache_entries: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.cache: dict[bytes, bytes] = {}
        self.cache_entries = cache_entries

    def _encode(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(g.ids, np.uint16).tobytes() for g in got]

    def _learn(self, words: set[bytes]) -> None:
        cache = self.cache
        # A word of ASCII letters with marks at its end is two pre-tokens: letters, marks.
        ended = {w: m.groups() for w in words if (m := _ENDED.fullmatch(w))}
        whole = {w for w in words if w not in ended}
        whole |= {part for parts in ended.values() for part in parts}
        whole = [w for w in whole if w not in cache]
        cache.update(zip(whole, self._encode([w.decode() for w in whole])))
        for w, (stem, marks) in ended.items():
            cache[w] = cache[stem] + cache[marks]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without special tokens added."""
        # The normaliser lower-cases; doing it for A-Z first makes fewer different words.
        split = [None if "<|" in t else t.encode().lower().split() for t in texts]
        new = {w for ws in split if ws for w in ws if w not in self.cache}
        if len(self.cache) + len(new) > self.cache_entries:
            self.cache = {}
            new = {w for ws in split if ws for w in ws}
        if new:
            self._learn(new)
        get = self.cache.__getitem__
        return [np.frombuffer(self._encode([t])[0] if ws is None else b"".join(map(get, ws)), np.uint16)
                for t, ws in zip(texts, split)]


_loaded: dict[str, WordIds] = {}


def _word_ids(path: str, call: str) -> WordIds:
    if call not in _loaded:
        _loaded.clear()
        _loaded[call] = WordIds(path)
    return _loaded[call]


class Packer:
    """Packs pieces (document number, start, length) of one partition into windows."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        if any(t & (t - 1) for t in tiers):
            raise ValueError("tiers must be powers of two")
        self.tiers = sorted(tiers)
        # Per tier: pieces sorted by length, as (length, document, start).
        self.queues: dict[int, list[tuple[int, int, int]]] = {t: [] for t in self.tiers}
        self.waiting = 0
        self.done: list[list[tuple[int, int, int]]] = []      # windows of (document, start, length)

    def _route(self, doc: int, start: int, length: int) -> None:
        if length:
            tier = next(t for t in self.tiers if t >= length)
            insort(self.queues[tier], (length, doc, start))
            self.waiting += length

    def add(self, doc: int, length: int) -> None:
        """Take a document of ``length`` ids."""
        start, top = 0, self.tiers[-1]
        while length - start >= top:
            self.done.append([(doc, start, top)])
            start += top
        self._route(doc, start, length - start)

    def _take(self, tier: int, at: int) -> tuple[int, int, int]:
        piece = self.queues[tier].pop(at)
        self.waiting -= piece[0]
        return piece

    def _best_fit(self, gap: int) -> tuple[int, int, int] | None:
        """The longest waiting piece of at most ``gap`` ids."""
        for tier in reversed(self.tiers):
            queue = self.queues[tier]
            at = bisect_right(queue, (gap, float("inf"), 0)) if queue and queue[0][0] <= gap else 0
            if at:
                return self._take(tier, at - 1)
        return None

    def _longest_below(self, tier: int) -> tuple[int, int, int] | None:
        for t in reversed([t for t in self.tiers if t <= tier]):
            if self.queues[t]:
                return self._take(t, -1)
        return None

    def pack(self) -> None:
        """Fill windows of every tier, longest first; what fills no window waits."""
        open_: list[list[tuple[int, int, int]]] = []
        for tier in reversed(self.tiers):
            while self.queues[tier]:
                length, doc, start = self._take(tier, -1)
                window, gap = [(doc, start, length)], tier - length
                while gap:
                    piece = self._best_fit(gap)
                    if piece is None:
                        piece = self._longest_below(tier)
                        if piece is None:
                            break
                        n, d, s = piece
                        self._route(d, s + gap, n - gap)
                        piece = (gap, d, s)
                    window.append((piece[1], piece[2], piece[0]))
                    gap -= piece[0]
                (self.done if not gap else open_).append(window)
        for window in open_:
            for doc, start, length in window:
                self._route(doc, start, length)

    def finish(self) -> None:
        """Pack the rest: whole largest windows, then windows at the binary digits of what is left."""
        self.pack()
        pieces = [(d, s, n) for t in reversed(self.tiers) for n, d, s in reversed(self.queues[t])]
        left = sum(n for _, _, n in pieces)
        self.queues, self.waiting = {t: [] for t in self.tiers}, 0
        while left:
            size = min(self.tiers[-1], 1 << (left.bit_length() - 1))
            left -= size
            window = []
            while size:
                d, s, n = pieces.pop(0)
                used = min(n, size)
                window.append((d, s, used))
                size -= used
                if used < n:
                    pieces.insert(0, (d, s + used, n - used))
            self.done.append(window)


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """A group for each window: the next longest goes to the group with the fewest tokens."""
    groups = [(0, g) for g in range(max(1, -(-sum(sizes) // step_tokens)))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        tokens, g = heapq.heappop(groups)
        out[i] = g
        heapq.heappush(groups, (tokens + sizes[i], g))
    return out


def pack_documents(docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text",
                   tiers: tuple[int, ...] = TIERS, block_tokens: int = 1 << 21, step_tokens: int = 8 * 4096) -> DataFrame:
    """One row per piece, in sequence order within a task.

    ``key``, ``start`` (ids of the document before it), ``length``, ``ids`` (binary,
    little-endian unsigned 32-bit), ``doc_tokens`` (with ``end_id``), ``sequence_id``,
    ``offset`` (place in the sequence), ``window`` (length of the sequence), ``step_group``.
    """
    rows = docs.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    kind = rows.schema[key].dataType.simpleString()
    call = uuid.uuid4().hex

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _word_ids(path, call)
        packer = Packer(tiers)
        ids: dict[int, np.ndarray] = {}
        names: dict[int, object] = {}
        unused: dict[int, int] = {}       # ids of a document that are in no window yet
        total: dict[int, int] = {}
        base = TaskContext.get().partitionId() << 40
        sequences = steps = seen = 0
        key_type = None

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequences, steps
            windows, packer.done = packer.done, []
            groups = step_groups([sum(n for _, _, n in w) for w in windows], step_tokens)
            for lo in range(0, len(windows), 512):
                out = []
                for w, g in zip(windows[lo:lo + 512], groups[lo:lo + 512]):
                    size, offset = sum(n for _, _, n in w), 0
                    for doc, start, n in w:
                        out.append((names[doc], start, n, ids[doc][start:start + n].astype("<u4").tobytes(), total[doc],
                                    base + sequences, offset, size, base + steps + g))
                        offset += n
                        unused[doc] -= n
                        if not unused[doc]:
                            del ids[doc], names[doc], unused[doc], total[doc]
                    sequences += 1
                cols = list(zip(*out))
                i64 = pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], key_type), pa.array(cols[1], i64), pa.array(cols[2], i64),
                     pa.array(cols[3], pa.binary()), *(pa.array(c, i64) for c in cols[4:])],
                    [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "window", "step_group"])
            steps += max(groups, default=-1) + 1

        held = 0
        for batch in slices(batches, "_text"):
            key_type = batch.schema.field(key).type
            for name, doc in zip(batch.column(key).to_pylist(), coder.ids(batch.column("_text").to_pylist())):
                ids[seen], names[seen] = np.append(doc, np.uint16(end_id)), name
                unused[seen] = total[seen] = len(doc) + 1
                packer.add(seen, len(doc) + 1)
                held += len(doc) + 1
                seen += 1
            if held >= block_tokens:
                packer.pack()
                yield from flush()
                held = packer.waiting
        packer.finish()
        if packer.done:
            yield from flush()

    return rows.mapInArrow(pack, f"`{key}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
                                 "sequence_id bigint, offset bigint, window bigint, step_group bigint")


def piece_digests(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``ids_crc32`` (unsigned, of the little-endian 32-bit ids) in place of ``ids``."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")

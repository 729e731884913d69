"""Token counts: map-side two-tier lookup of pre-token lengths.

Tier one is a broadcast table ``pre-token -> number of tokens`` of the most
frequent pre-tokens, counted over all documents: every task keeps a Misra-Gries
summary of a fixed number of counters, and summaries, one row each, are merged as a
tree; tier two is a cache in every Python worker that encodes a missed pre-token
once.  A document's count is the sum over its pre-tokens, so no exchange has a
pre-token as its key.

Pre-tokens are cut so that the sum is exact.  The model's pieces never hold a
line feed and never hold a space mark after another character, so merges cannot
cross a line feed or the start of a run of spaces; ``Pretokens`` checks both
properties when it loads a model and refuses models without them.

Defined cases: null and empty texts have 0 bytes and 0 tokens; any length is
counted whole; repeated rows are counted row by row; an empty table gives an
empty result; further input columns are not passed on.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from stintwise.llm.common import slices

MARK = "▁"
_UNIT = re.compile(r" ?[^ \n]+|\n| +[^ \n]*")


class Pretokens:
    """Lengths of pre-tokens under one sentencepiece model.

    Tier one (``frequent``) stays; tier two takes the misses of this process and
    is emptied when it holds ``cache_entries``.
    """

    def __init__(self, path: str, frequent: dict[str, int] | None = None, cache_entries: int = 400_000):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        plain = (norm.add_dummy_prefix and not norm.remove_extra_whitespaces
                 and not norm.precompiled_charsmap and proto.trainer_spec.byte_fallback
                 and not proto.trainer_spec.treat_whitespace_as_suffix)
        if not plain or any("\n" in p.piece or re.search(f"[^{MARK}]{MARK}", p.piece)
                            or p.type == model_pb2.ModelProto.SentencePiece.USER_DEFINED for p in proto.pieces):
            raise ValueError(f"{path}: pre-token lengths do not add up under this model")
        self.known = dict(frequent or {})
        self.frequent, self.most = frequent or {}, cache_entries + len(self.known)

    def lengths(self, units: list[str]) -> list[int]:
        """Tokens of each pre-token, by the library.

        A pre-token is cut out by encoding it in a place where it stands alone:
        after the space mark that the model puts first, or after a line feed.
        """
        def framed(u: str) -> tuple[str, str]:
            if u[0] == " " and u.strip(" "):
                return u[1:], ""
            return ("a" + u, "a") if u[0] == " " else ("\n" + u, "\n")

        frames = [framed(u) for u in units]
        size = {f: len(self.model.encode(f, num_threads=1)) for f in ("", "a", "\n")}
        got = self.model.encode([whole for whole, _ in frames], num_threads=1)
        return [len(g) - size[f] for g, (_, f) in zip(got, frames)]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        units: list[str] = []
        ends = []
        for text in texts:
            if text:
                units += pretokens(text)
            ends.append(len(units))
        missing = [u for u in set(units) if u not in self.known]
        if missing:
            if len(self.known) + len(missing) > self.most:
                self.known = dict(self.frequent)
                missing = [u for u in set(units) if u not in self.known]
            self.known.update(zip(missing, self.lengths(missing)))
        sums = np.zeros(len(units) + 1, np.int64)
        np.cumsum(np.fromiter(map(self.known.__getitem__, units), np.int64, len(units)), out=sums[1:])
        return np.diff(sums[np.array([0, *ends])])


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text, in order, with their leading spaces."""
    return _UNIT.findall(" " + text.replace(MARK, " "))


_loaded: dict[str, Pretokens] = {}


def _counter(path: str, broadcast, call: str) -> Pretokens:
    """One ``Pretokens`` per worker process and call, so its cache outlives the task."""
    if call not in _loaded:
        _loaded.clear()
        _loaded[call] = Pretokens(path, broadcast.value)
    return _loaded[call]


class Summary:
    """Misra-Gries counts of pre-tokens: at most ``counters`` stay at a cut.

    A count is never above the true one, and below it by less than all
    occurrences seen, in merged summaries too, over ``counters``.
    """

    def __init__(self, counters: int, unit_chars: int):
        self.seen: Counter[str] = Counter()
        self.counters, self.unit_chars = counters, unit_chars

    def cut(self) -> None:
        """Drop what is too long; beyond the bound, take the first count that finds no place from all others."""
        kept = {u: n for u, n in self.seen.items() if len(u) <= self.unit_chars}
        if len(kept) > self.counters:
            over = len(kept) - self.counters - 1
            less = int(np.partition(np.fromiter(kept.values(), np.int64, len(kept)), over)[over])
            kept = {u: n - less for u, n in kept.items() if n > less}
        self.seen = Counter(kept)

    def batch(self) -> pa.RecordBatch:
        self.cut()
        return pa.RecordBatch.from_pydict({"units": pa.array([list(self.seen)], pa.list_(pa.string())),
                                           "counts": pa.array([list(self.seen.values())], pa.list_(pa.int64()))})


def pretoken_summary(docs: DataFrame, text: str = "text", counters: int = 1 << 17, unit_chars: int = 32,
                     fan: int = 32, cut_chars: int = 1 << 24) -> dict[str, int]:
    """Summary of the pre-tokens of at most ``unit_chars`` characters over all rows.

    A task holds its own counters and reads the summaries of up to ``fan`` others one by one;
    the driver gets the last one, of at most ``counters`` entries.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, read = Summary(counters, unit_chars), 0
        for batch in slices(batches, text):
            for t in batch.column(text).to_pylist():
                own.seen.update(pretokens(t or ""))
                read += len(t or "")
                if read > cut_chars or len(own.seen) > 4 * counters:
                    own.cut()
                    read = 0
        yield own.batch()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Summary(counters, unit_chars)
        for batch in batches:
            for units, counts in zip(batch.column("units"), batch.column("counts")):
                own.seen.update(dict(zip(units.as_py(), counts.as_py())))
                own.cut()
        yield own.batch()

    kind = "units array<string>, counts array<bigint>"
    parts = docs.rdd.getNumPartitions()
    rows = docs.select(text).mapInArrow(count, kind)
    while parts > 1:
        parts = -(-parts // fan)
        rows = rows.repartition(parts).mapInArrow(merge, kind)
    total: Counter[str] = Counter()
    for r in rows.collect():        # one row, none of an empty table
        total.update(dict(zip(r.units, r.counts)))
    return total


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", entries: int = 1 << 16,
                     unit_chars: int = 32) -> dict[str, int]:
    """Lengths of the pre-tokens most frequent over all documents.

    At most ``entries`` pre-tokens of at most ``unit_chars`` characters, so the
    table stays under 16 MB.  The summary has twice as many counters.  The table
    only saves work: a pre-token that it lacks is encoded by the worker, with the
    same result.
    """
    total = pretoken_summary(docs, text, 2 * entries, unit_chars)
    units = sorted((u for u, n in total.items() if n > 1), key=lambda u: (-total[u], u))[:entries]
    return dict(zip(units, Pretokens(path).lengths(units)))


def token_counts(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id",
                 limit: int = 4096, frequent: dict[str, int] | None = None) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    if frequent is None:
        frequent = frequent_lengths(rows, path, "_text")
    table = spark.sparkContext.broadcast(frequent)
    call = uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _counter(path, table, call)
        for batch in slices(batches, "_text"):
            texts = pc.fill_null(batch.column("_text"), "")
            n = pa.array(lengths.counts(texts.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pc.binary_length(texts).cast(pa.int64()), n, pc.greater(n, limit)],
                [key, "n_bytes", "n_tokens", "over_limit"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(count, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")

"""Quality classifier: a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own and its neighbours' features; the
length-weighted marginals of a document's lines (forward-backward) are its quality.
Features come from the text alone, computed for all lines of an Arrow slice at once:
shares of character classes, word lengths, repeated words and lines.

The model is fitted in the driver on a bounded sample of labelled rows: about
``sample_docs`` documents, chosen by a hash of their id, of at most
``sample_lines`` lines each.  A training document gives its label to all its lines.
Scoring reads every text whole, in one pass without a shuffle.

Defined cases: a null or empty text is one empty line and gets a score like any other;
repeated rows are scored row by row; null labels are not learned from; with no labelled
row, or only one class, the score is the share of good rows (0.5 without any); an empty
table gives an empty result; further columns are passed on, a column ``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintwise.llm.common import free_name, id_hash, slices, span_hash, text_bytes, without, words

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:?",
    "bang": b"!",
    "symbol": b"#$%&*+=@^_~\\/<>{}[]()\"'",
    "bar": b"|",
}
NAMES = ("length", "words", *(f"{c}_share" for c in _CLASSES), "other_share", "word_length", "short_words",
         "long_words", "repeat_next", "distinct_words", "repeated_line", "ends_stop", "ends_symbol", "caps_first",
         "empty")
WIDTH = 3 * len(NAMES) + 3      # own, previous and next line, first, last, constant


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, row numbers and byte lengths of all lines of some texts, in order."""
    n, rows = len(data), len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    owner = np.concatenate([np.arange(rows), np.searchsorted(offsets, breaks, side="right") - 1])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    ends = np.append(starts[1:] - 1, n)
    last = np.append(owner[1:] != owner[:-1], True)
    ends[last] = offsets[owner[last] + 1]
    length = ends - starts
    size = np.maximum(length, 1)

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(n + 1, np.int32)
        np.cumsum(flags, out=sums[1:])
        return (sums[ends] - sums[starts]).astype(np.float64)

    out = {"length": np.log1p(length)}
    rest = length.astype(np.float64)
    for name, members in _CLASSES.items():
        flag = np.zeros(256, bool)
        flag[list(members)] = True
        got = count(flag[data])
        out[f"{name}_share"] = got / size
        rest -= got
    ws, we, _ = words(data, offsets)
    line = np.searchsorted(starts, ws, side="right") - 1
    # of rows with equal starts (empty texts) the last one holds the word
    n_words = np.bincount(line, minlength=len(starts)).astype(np.float64)
    rest -= np.maximum(n_words - 1, 0)
    out["other_share"] = rest / size
    out["words"] = np.log1p(n_words)
    some = np.maximum(n_words, 1)
    width = we - ws
    out["word_length"] = np.bincount(line, width, minlength=len(starts)) / some
    out["short_words"] = np.bincount(line, width <= 3, minlength=len(starts)) / some
    out["long_words"] = np.bincount(line, width >= 12, minlength=len(starts)) / some
    h = span_hash(data, ws, we)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    out["repeat_next"] = np.bincount(line, again, minlength=len(starts)) / some
    keys = np.sort((line.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    distinct = np.bincount((keys[first] >> np.uint64(40)).astype(np.int64), minlength=len(starts))[: len(starts)]
    out["distinct_words"] = np.where(n_words > 0, distinct / some, 1.0)
    whole = span_hash(data, starts, ends)
    by = np.lexsort((whole, owner))
    same = (whole[by][1:] == whole[by][:-1]) & (owner[by][1:] == owner[by][:-1])
    twin = np.zeros(len(starts), bool)
    twin[by[1:]] |= same
    twin[by[:-1]] |= same
    out["repeated_line"] = (twin & (length > 0)).astype(np.float64)
    tail = data[np.maximum(ends - 1, 0)] if n else np.zeros(len(starts), np.uint8)
    head = data[np.minimum(starts, n - 1)] if n else np.zeros(len(starts), np.uint8)
    filled = length > 0
    out["ends_stop"] = (filled & np.isin(tail, list(b".?!"))).astype(np.float64)
    out["ends_symbol"] = (filled & np.isin(tail, list(_CLASSES["symbol"] + b"|"))).astype(np.float64)
    out["caps_first"] = (filled & (head >= 65) & (head <= 90)).astype(np.float64)
    out["empty"] = (~filled).astype(np.float64)
    return np.stack([out[name] for name in NAMES], axis=1), owner, length


def with_neighbours(x: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features, first- and last-line flags, a constant."""
    n, k = x.shape
    out = np.zeros((n, WIDTH))
    out[:, :k] = x
    follows = owner[1:] == owner[:-1]
    out[1:, k:2 * k][follows] = x[:-1][follows]
    out[:-1, 2 * k:3 * k][follows] = x[1:][follows]
    out[0, 3 * k] = out[-1, 3 * k + 1] = 1
    out[1:, 3 * k] = ~follows
    out[:-1, 3 * k + 1] = ~follows
    out[:, 3 * k + 2] = 1
    return out


class Chains:
    """Lines of several documents laid out by position, longest document first."""

    def __init__(self, owner: np.ndarray):
        """``owner``: row number of each line, ascending, every row with at least one line."""
        counts = np.bincount(owner)
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        t = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.active = np.searchsorted(-counts[order], -np.arange(counts.max()), side="left")
        self.first = np.concatenate([[0], np.cumsum(self.active)])
        self.at = self.first[t] + place[owner]       # line -> place in the layout

    def marginals(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(line is good), and the expected counts of label pairs summed over lines.

        ``unary``: log odds of good for each line; ``pair``: 2 x 2 log weights.
        """
        u = np.empty(len(unary))
        u[self.at] = unary
        node = np.stack([np.exp(-np.logaddexp(0, u)), np.exp(-np.logaddexp(0, -u))], axis=1)
        move = np.exp(pair - pair.max())
        alpha = np.empty_like(node)
        a = None
        for t, k in enumerate(self.active):
            lo = self.first[t]
            a = node[lo:lo + k] * (a[:k] @ move if t else 1.0)
            a /= a.sum(axis=1, keepdims=True)
            alpha[lo:lo + k] = a
        pairs = np.zeros((2, 2))
        beta = None
        post = np.empty_like(node)
        for t in range(len(self.active) - 1, -1, -1):
            lo, k = self.first[t], self.active[t]
            b = np.ones((k, 2))
            if t + 1 < len(self.active):
                nxt, after = self.first[t + 1], self.active[t + 1]
                v = node[nxt:nxt + after] * beta
                joint = alpha[lo:lo + after, :, None] * move[None] * v[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                b[:after] = v @ move.T
                b[:after] /= b[:after].sum(axis=1, keepdims=True)
            p = alpha[lo:lo + k] * b
            post[lo:lo + k] = p / p.sum(axis=1, keepdims=True)
            beta = b
        return post[self.at, 1], pairs


@dataclass
class LineCrf:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pair: np.ndarray
    prior: float | None = None       # the constant score of a model without two classes

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Quality of each text: its lines' marginals, weighted by their length."""
        rows = len(offsets) - 1
        if self.prior is not None:
            return np.full(rows, self.prior)
        x, owner, length = line_features(data, offsets)
        unary = ((with_neighbours(x, owner) - self.mean) / self.scale) @ self.weights
        good, _ = Chains(owner).marginals(unary, self.pair)
        weight = length + 1.0
        return np.bincount(owner, good * weight, minlength=rows) / np.bincount(owner, weight, minlength=rows)


def fit(x: np.ndarray, owner: np.ndarray, label: np.ndarray, iterations: int = 400, rate: float = 0.05,
        penalty: float = 1e-3) -> LineCrf:
    """Maximum likelihood with an L2 penalty, by Adam; ``label``: 0 or 1 of each document."""
    x = with_neighbours(x, owner)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[-1], scale[scale < 1e-6] = 0.0, 1.0
    if len(set(label.tolist())) < 2:
        return LineCrf(mean, scale, np.zeros(WIDTH), np.zeros((2, 2)), float(label.mean()) if len(label) else 0.5)
    x = (x - mean) / scale
    chains, y = Chains(owner), label[owner].astype(np.float64)
    docs = len(label)
    # Lines per document vary widely, so the chain's evidence is that of all its lines.
    seen = np.zeros((2, 2))
    same = owner[1:] == owner[:-1]
    for v in (0, 1):
        seen[v, v] = float((same & (y[1:] == v)).sum())
    w, pair = np.zeros(WIDTH), np.zeros((2, 2))
    m, v2 = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
    for i in range(1, iterations + 1):
        good, pairs = chains.marginals(x @ w, pair)
        grad = np.concatenate([x.T @ (good - y) / docs + penalty * w, ((pairs - seen) / docs + penalty * pair).ravel()])
        m, v2 = 0.9 * m + 0.1 * grad, 0.999 * v2 + 0.001 * grad ** 2
        step = rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v2 / (1 - 0.999 ** i)) + 1e-8)
        w -= step[:WIDTH]
        pair -= step[WIDTH:].reshape(2, 2)
    return LineCrf(mean, scale, w, pair)


def train(docs: DataFrame, labels: DataFrame, usable: Column, key: str = "doc_id", text: str = "text",
          label: str = "quality", sample_docs: int = 6000, sample_lines: int = 2000) -> LineCrf:
    """Fit on a bounded sample of the labelled rows for which ``usable`` (over ``key``) holds."""
    pool = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & usable)
            .select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).distinct())
    n = pool.count()
    if n > sample_docs:      # about sample_docs of them, by a hash of the id
        pool = pool.where(F.pmod(F.xxhash64("_key"), F.lit(1 << 30)) < (sample_docs << 30) // n)
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    # The sample is about sample_docs rows of two numbers; an id that repeats gives one text.
    rows = rows.join(F.broadcast(pool), "_key").groupBy("_key", "_label").agg(F.min("_text").alias("_text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            x, owner, _ = line_features(*text_bytes(batch.column("_text")))
            label_of = batch.column("_label").to_numpy()
            few = np.flatnonzero(np.bincount(owner, minlength=batch.num_rows) <= sample_lines)
            edge = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_pydict({
                "label": pa.array(label_of[few], pa.int32()),
                "x": pa.array([x[edge[i]:edge[i + 1]].astype(np.float32).tobytes() for i in few], pa.binary())})

    # sorted, so that the fit does not depend on the order in which tasks end
    sample = sorted((r.label, bytes(r.x)) for r in rows.mapInArrow(features, "label int, x binary").collect())
    got = [(v, np.frombuffer(x, np.float32).reshape(-1, len(NAMES))) for v, x in sample]
    if not got:
        return fit(np.zeros((1, len(NAMES))), np.zeros(1, np.int64), np.zeros(0, np.int64))
    owner = np.repeat(np.arange(len(got)), [len(x) for _, x in got])
    return fit(np.concatenate([x for _, x in got]).astype(np.float64), owner, np.array([v for v, _ in got]))


def score(docs: DataFrame, model: LineCrf, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the quality of each text, in place of any such column."""
    docs = without(docs, "score")
    now = docs.sparkSession.sparkContext.broadcast(model)
    own = free_name(docs, "_text")
    rows = docs.withColumn(own, F.coalesce(F.col(text).cast("string"), F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, own):
            s = now.value.score(*text_bytes(batch.column(own)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(s)], [*batch.schema.names[:-1], "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, score double")


def held_out(key: Column) -> Column:
    """Rows that no model learns from: crc32 of the id's text, modulo 3, is 1."""
    return id_hash(key) % 3 == 1

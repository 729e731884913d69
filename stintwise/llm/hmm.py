"""Language-model scoring: a hidden Markov model over word symbols.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased,
then one end token; a word over 64 bytes goes by its 16-byte digest and last two bytes.  The model emits *symbols*: the ``own_words`` most frequent
training words and the end have one each, all other words share ``buckets``
symbols by a hash of their last two bytes.  Within a shared symbol a word has
probability ``(c + 1) / (N_s + V_s + 1)``, with c its training count, N_s and V_s
the symbol's tokens and distinct words; every word unseen in training has the
remaining share.  So the probability of a text is that of its symbols under the
hidden states times the words' shares, and it is exact: a scaled forward
recursion over the whole text, of any length.

Jobs, in order:

* word counts, of all rows and of the training rows: counted in every task, summed by a
  shuffle on the word and written once;
* the ``frequent_words`` most frequent training words, and as many that only other rows
  hold, are broadcast (words are short, so the table is bounded); every text is encoded
  once into symbols, with the sums over frequent words, and its rarer words with their
  counts in the text;
* the rarer words meet their training counts in a join on the word.  None of
  them is frequent, so no key of that join is hot;
* Baum-Welch: each task runs forward-backward over its texts and emits expected
  counts, which a shuffle by symbol sums; only the summed model (states x
  symbols) reaches the driver.  All training tokens are used, each text as one
  sequence: a long text is laid out in runs of ``run_tokens`` that are worked through side by
  side, with the exact forward and backward state carried over their borders;
* scoring by the forward recursion, uncut.

Defined cases: null and empty texts hold the end token only; repeated rows and
equal ids are scored row by row; null ids hash like the empty text; an empty table
gives an empty result; without training rows all symbols are equally likely.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintwise.llm.common import slices
from stintwise.session import materialize

WORD_BYTES = 64


def tokens(text: str | None) -> list[bytes]:
    """The words of a text (bytes.lower and bytes.split know ASCII only), long ones as digests."""
    out = (text or "").encode().lower().split()
    if max(map(len, out), default=0) > WORD_BYTES:
        out = [w if len(w) <= WORD_BYTES else b"\0" + hashlib.blake2b(w, digest_size=16).digest() + w[-2:] for w in out]
    return out


@dataclass(frozen=True)
class Symbols:
    """Word -> symbol number: own words first, then the end, then the shared ones."""

    own: int
    buckets: int

    @property
    def end(self) -> int:
        return self.own

    @property
    def size(self) -> int:
        return self.own + 1 + self.buckets

    def shared(self, word: bytes) -> int:
        return self.own + 1 + zlib.crc32(word[-2:]) % self.buckets


@dataclass
class Model:
    start: np.ndarray    # [states]
    move: np.ndarray     # [states, states]
    emit: np.ndarray     # [symbols, states]: P(symbol | state)


class Runs:
    """Sequences laid out by time, longest first, so that each step is one array operation."""

    def __init__(self, sequences: list[np.ndarray]):
        self.order = np.argsort([-len(s) for s in sequences], kind="stable")
        lengths = np.array([len(sequences[i]) for i in self.order])
        steps = int(lengths[0]) if len(lengths) else 0
        self.active = np.searchsorted(-lengths, -np.arange(steps), side="left")
        self.first = np.concatenate([[0], np.cumsum(self.active)])
        flat = np.concatenate([sequences[i] for i in self.order]) if steps else np.zeros(0, np.int64)
        t = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        d = np.repeat(np.arange(len(lengths)), lengths)
        self.symbol = np.empty(len(flat), np.int64)
        self.row = np.empty(len(flat), np.int64)
        at = self.first[t] + d
        self.symbol[at] = flat
        self.row[at] = d
        self.n = len(sequences)

    def forward(self, m: Model, keep: bool, enter: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Scale factors of every token, and the scaled forward variables if they are kept.

        ``enter``: each sequence's state probabilities before its first token, if not ``m.start``.
        """
        scale = np.empty(len(self.symbol))
        kept = np.empty((len(self.symbol), len(m.start)), np.float32) if keep else None
        a = m.start[None, :] if enter is None else enter[self.order]
        for t, k in enumerate(self.active):
            lo, hi = self.first[t], self.first[t] + k
            a = (a[:k] @ m.move if t else a) * m.emit[self.symbol[lo:hi]]
            s = a.sum(axis=1)
            a /= s[:, None]
            scale[lo:hi] = s
            if keep:
                kept[lo:hi] = a
        return scale, kept

    def log10(self, m: Model) -> np.ndarray:
        """log10 probability of each sequence, in the given order."""
        scale, _ = self.forward(m, keep=False)
        out = np.zeros(self.n)
        out[self.order] = np.bincount(self.row, np.log10(scale), minlength=self.n)
        return out

    def transfers(self, m: Model) -> np.ndarray:
        """Per sequence the matrix from the state before its first token to that at its last one, up to a factor."""
        states = len(m.start)
        out = np.empty((self.n, states, states))
        now = np.broadcast_to(np.eye(states), (self.n, states, states))
        for t, k in enumerate(self.active):
            lo = self.first[t]
            now = (now[:k] @ m.move if t else now) * m.emit[self.symbol[lo:lo + k]][:, None, :]
            now /= now.sum(axis=(1, 2), keepdims=True)
            out[self.order[:k]] = now
        return out

    def expected(self, m: Model, enter: np.ndarray | None = None, leave: np.ndarray | None = None,
                 heads: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions (forward-backward).

        ``enter``: as in ``forward``; ``leave``: the backward variables of each sequence's last
        token, ones if its text ends there, up to a factor; ``heads``: the sequences that begin
        a text, if not all.
        """
        scale, alpha = self.forward(m, keep=True, enter=enter)
        states = len(m.start)
        moves = np.zeros((states, states))
        ends = np.ones((self.n, states)) if leave is None else leave[self.order]
        beta = np.zeros((0, states))
        for t in range(len(self.active) - 1, -1, -1):
            lo, k = self.first[t], self.active[t]
            after = len(beta)
            # sequences whose last token this is: the posterior there sums to one
            last = ends[after:k] / (alpha[lo + after:lo + k] * ends[after:k]).sum(axis=1, keepdims=True)
            if after:
                nxt = self.first[t + 1]
                v = m.emit[self.symbol[nxt:nxt + after]] * beta / scale[nxt:nxt + after, None]
                moves += alpha[lo:lo + after].T @ v
                last = np.concatenate([v @ m.move.T, last])
            beta = last
            # alpha becomes the posterior of the state in place
            alpha[lo:lo + k] *= beta
        emits = np.stack([np.bincount(self.symbol, alpha[:, s], minlength=len(m.emit)) for s in range(states)], 1)
        starts = alpha[: self.n] if heads is None else alpha[: self.n][heads[self.order]]
        return starts.sum(axis=0, dtype=np.float64), moves * m.move, emits


def expected_counts(texts: list[np.ndarray], m: Model, run_tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of whole texts.

    A text over ``run_tokens`` symbols is laid out in runs.  Their transfer matrices, chained from
    run to run, give the exact state at every border, so the counts are those of the uncut text.
    """
    pieces = [[s[i:i + run_tokens] for i in range(0, len(s), run_tokens)] for s in texts]
    runs = [r for p in pieces for r in p]
    n = np.array([len(p) for p in pieces])
    head = np.cumsum(n) - n                     # each text's first run
    states = len(m.start)
    enter, leave = np.tile(m.start, (len(runs), 1)), np.ones((len(runs), states))
    border = np.zeros((states, states))
    split = np.flatnonzero(n > 1)
    inside = np.concatenate([np.arange(head[d], head[d] + n[d]) for d in split]) if len(split) else np.zeros(0, np.int64)
    if len(inside):
        across = dict(zip(inside.tolist(), Runs([runs[r] for r in inside]).transfers(m)))
        for d in split:
            for r in range(head[d], head[d] + n[d] - 1):
                at_end = enter[r] @ across[r]
                enter[r + 1] = at_end @ m.move / at_end.sum()
            for r in range(head[d] + n[d] - 1, head[d], -1):
                before = across[r] @ leave[r]    # backward variables ahead of run r's first token
                leave[r - 1] = m.move @ before / before.sum()
                # the move into run r: states at the end of r - 1, times the move, times what follows
                at_end = enter[r - 1] @ across[r - 1]
                joint = at_end[:, None] * m.move * before[None, :]
                border += joint / joint.sum()
    heads = np.zeros(len(runs), bool)
    heads[head] = True
    starts, moves, emits = Runs(runs).expected(m, enter, leave, heads)
    return starts, moves + border, emits


def word_counts(docs: DataFrame, text: str, held: str, flush: int = 200_000) -> DataFrame:
    """``word`` (binary), ``n`` and ``other``: counts over the rows where ``held`` is false, and over the rest."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter[bytes], Counter[bytes]] = (Counter(), Counter())

        def out() -> Iterator[pa.RecordBatch]:
            for i, name in enumerate(("n", "other")):
                size, counts = len(seen[i]), pa.array(list(seen[i].values()), pa.int64())
                zeros = pa.array(np.zeros(size, np.int64))
                yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen[i]), pa.binary()),
                                                  "n": zeros if i else counts, "other": counts if i else zeros})
                seen[i].clear()

        for batch in slices(batches, text):
            for t, i in zip(batch.column(text).to_pylist(), batch.column(held).to_pylist()):
                seen[i].update(tokens(t))
            if len(seen[0]) + len(seen[1]) > flush:
                yield from out()
        yield from out()

    return (docs.select(text, held).mapInArrow(count, "word binary, n bigint, other bigint")
            .groupBy("word").agg(F.sum("n").alias("n"), F.sum("other").alias("other")))


def _most_frequent(counts: DataFrame, limit: int, by: str = "n") -> list[tuple[bytes, int]]:
    """At most ``limit`` words with the highest counts ``by``, most frequent first.

    A histogram over steps of the logarithm gives the least count that at most
    ``limit`` words reach, so only those words come to the driver.
    """
    step = F.floor(F.log2(by) * 64)
    seen, least = 0, None
    for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect():
        seen += r.words
        if seen > limit:
            break
        least = r.step
    if least is None:
        return []
    rows = counts.where(step >= least).select("word", by).collect()
    return sorted(((bytes(r.word), r[by]) for r in rows), key=lambda r: (-r[1], r[0]))


def _symbol_totals(counts: DataFrame, own: set[bytes], symbols: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of every symbol."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(symbols.size, np.int64), np.zeros(symbols.size, np.int64)
        for batch in batches:
            words = batch.column("word").to_pylist()
            s = np.fromiter((symbols.shared(w) if w not in own else 0 for w in words), np.int64, len(words))
            c = batch.column("n").to_numpy()
            n += np.bincount(s, c, minlength=symbols.size).astype(np.int64)
            v += np.bincount(s, minlength=symbols.size)
        s = np.arange(symbols.own + 1, symbols.size)
        yield pa.RecordBatch.from_pydict({"s": pa.array(s, pa.int32()), "n": pa.array(n[s]), "v": pa.array(v[s])})

    n, v = np.zeros(symbols.size, np.int64), np.zeros(symbols.size, np.int64)
    for r in (counts.mapInArrow(totals, "s int, n bigint, v bigint")
              .groupBy("s").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()):
        n[r.s], v[r.s] = r.n, r.v
    return n, v


def _encode(rows: DataFrame, top: list[tuple[bytes, int]], symbols: Symbols, share: np.ndarray) -> DataFrame:
    """Every text as symbols, sums over its frequent words, and its rarer words.

    ``known``: tokens found in ``top`` with a count; ``base_sum``: sum of log10(c + 1) over them;
    ``class_sum``: log10 shares of words in shared symbols, without log10(c + 1) of rarer words.
    """
    spark = rows.sparkSession
    shared_top = spark.sparkContext.broadcast((
        {w: i for i, (w, _) in enumerate(top)},
        np.log10(np.array([c for _, c in top], np.float64) + 1),
        np.array([i if i < symbols.own else symbols.shared(w) for i, (w, _) in enumerate(top)], np.int64),
        np.log10(share)))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, logs, symbol_of, log_share = shared_top.value
        for batch in slices(batches, "_text"):
            syms, known, base, klass, words, counts = [], [], [], [], [], []
            for t in batch.column("_text").to_pylist():
                ws = tokens(t)
                code = np.fromiter((index.get(w, -1) for w in ws), np.int64, len(ws))
                rare = np.flatnonzero(code < 0)
                sym = np.full(len(ws) + 1, symbols.end, np.int64)
                found = code >= 0
                sym[:-1][found] = symbol_of[code[found]]
                rest = [ws[i] for i in rare]
                sym[rare] = [symbols.shared(w) for w in rest]
                hits = code[found]
                syms.append(sym.astype(np.uint16).tobytes())
                known.append(int(np.count_nonzero(logs[hits])))
                base.append(float(logs[hits].sum()))
                klass.append(float(logs[hits[hits >= symbols.own]].sum() - log_share[sym].sum()))
                tally = Counter(rest)
                words.append(list(tally))
                counts.append(list(tally.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("_held"), pa.array([len(s) // 2 for s in syms], pa.int64()),
                 pa.array(syms, pa.binary()), pa.array(known, pa.int64()), pa.array(base), pa.array(klass),
                 pa.array(words, pa.list_(pa.binary())), pa.array(counts, pa.list_(pa.int64()))],
                ["_key", "_held", "n_tokens", "syms", "known", "base_sum", "class_sum", "words", "counts"])

    coded = rows.mapInArrow(encode, f"_key {kinds['_key']}, _held boolean, n_tokens bigint, syms binary, known bigint, "
                                    "base_sum double, class_sum double, words array<binary>, counts array<bigint>")
    # The row number is fixed by the written table.
    return materialize(coded.withColumn("_row", F.monotonically_increasing_id()), "hmm-coded")


def _blocks(batches: Iterator[pa.RecordBatch], max_tokens: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows regrouped to blocks of about ``max_tokens`` symbols, across Arrow batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in slices(batches, "syms", 2 * max_tokens):
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column("syms"))).as_py() or 0
        if size >= 2 * max_tokens:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _first_model(symbol_counts: np.ndarray, states: int, seed: int) -> Model:
    rng = np.random.default_rng(seed)
    emit = (symbol_counts + 0.5)[:, None] * rng.gamma(1.0, size=(len(symbol_counts), states))
    move = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
    return Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def baum_welch(coded: DataFrame, model: Model, iterations: int, run_tokens: int) -> Model:
    """Expectation-maximisation over all rows of ``coded`` (column ``syms``)."""
    spark = coded.sparkSession
    for _ in range(iterations):
        now = spark.sparkContext.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = now.value
            starts, moves, emits = np.zeros(len(m.start)), np.zeros(m.move.shape), np.zeros(m.emit.shape)
            for block in _blocks(batches):
                texts = [np.frombuffer(b, np.uint16).astype(np.int64) for b in block.column("syms").to_pylist()]
                a, b, c = expected_counts(texts, m, run_tokens)
                starts, moves, emits = starts + a, moves + b, emits + c
            used = np.flatnonzero(emits.any(axis=1))
            rows = [starts, *moves, *emits[used]]
            names = [-1, *range(-2, -2 - len(moves), -1), *used.tolist()]
            yield pa.RecordBatch.from_pydict({"what": pa.array(names, pa.int32()),
                                              "sums": pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))})

        parts = coded.select("syms").mapInArrow(expect, "what int, sums array<double>")
        total = parts.groupBy("what").agg(*[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(len(model.start))])
        starts, moves, emits = np.zeros(model.start.shape), np.zeros(model.move.shape), np.zeros(model.emit.shape)
        for r in total.collect():       # states + symbols + 1 rows
            to, i = (emits, r[0]) if r[0] >= 0 else (moves, -2 - r[0])
            if r[0] == -1:
                starts[:] = r[1:]
            else:
                to[i] = r[1:]
        starts, moves, emits = starts + 1, moves + 1, emits + 0.1
        model = Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))
        now.unpersist()
    return model


def score_texts(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", states: int = 8,
                own_words: int = 2048, buckets: int = 1024, frequent_words: int = 1 << 17, iterations: int = 4,
                run_tokens: int = 1024, seed: int = 5) -> DataFrame:
    """Train on the rows where ``held_out`` is false; score all rows.

    Returns ``key``, ``held_out``, ``n_tokens``, ``n_known`` (tokens seen in training),
    ``train_tokens``, ``base_score`` (add-one unigram log10 probability) and ``score``
    (log10 probability under the hidden Markov model).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"),
                       F.coalesce(held_out, F.lit(False)).alias("_held"))
    train = rows.where(~F.col("_held"))
    everywhere = materialize(word_counts(rows, "_text", "_held"), "hmm-counts")
    counts = everywhere.where("n > 0")
    ends = train.count()
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = size.n + ends, size.v + (1 if ends else 0)

    top = _most_frequent(counts, frequent_words)
    symbols = Symbols(min(own_words, len(top)), buckets)
    tokens_in, words_in = _symbol_totals(counts, {w for w, _ in top[:symbols.own]}, symbols)
    share = np.ones(symbols.size)               # denominators of the words' shares
    share[symbols.own + 1:] = (tokens_in + words_in + 1)[symbols.own + 1:]
    # words of other rows alone count 0; with them in the table none of the rarer words is frequent anywhere
    strange = _most_frequent(everywhere.where("n = 0"), frequent_words, by="other")
    coded = _encode(rows, top + [(w, 0) for w, _ in strange], symbols, share)

    symbol_counts = tokens_in.astype(np.float64)
    symbol_counts[:symbols.own] = [c for _, c in top[:symbols.own]]
    symbol_counts[symbols.end] = ends
    if ends:
        model = baum_welch(coded.where(~F.col("_held")), _first_model(symbol_counts, states, seed),
                           iterations, run_tokens)
    else:
        model = Model(np.full(states, 1 / states), np.full((states, states), 1 / states),
                      np.full((symbols.size, states), 1 / symbols.size))

    # Rarer words: one row per text and word, joined to the counts.
    rare = (coded.select("_row", F.explode(F.arrays_zip("words", "counts")).alias("w"))
            .select("_row", F.col("w.words").alias("word"), F.col("w.counts").alias("m")))
    rare = (rare.join(counts, "word")
            .groupBy("_row").agg(F.sum(F.col("m") * F.log10(F.col("n") + 1)).alias("rare_sum"),
                                 F.sum("m").alias("rare_known")))
    final = spark.sparkContext.broadcast(model)
    kind = coded.schema["_key"].dataType.simpleString()
    names = ["_row", "_key", "_held", "n_tokens", "known", "base_sum", "class_sum"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            texts = [np.frombuffer(b, np.uint16).astype(np.int64) for b in block.column("syms").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in names),
                                              pa.array(Runs(texts).log10(final.value))], [*names, "path"])

    scored = coded.select(*names, "syms").mapInArrow(
        score, f"_row bigint, _key {kind}, _held boolean, n_tokens bigint, known bigint, base_sum double, "
               "class_sum double, path double")
    own_part = F.coalesce("rare_sum", F.lit(0.0))
    end_log = float(np.log10(ends + 1))
    return scored.join(rare, "_row", "left").select(
        F.col("_key").alias(key), F.col("_held").alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + (1 if ends else 0)).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base_sum") + own_part + end_log
         - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (F.col("path") + F.col("class_sum") + own_part).alias("score"))

"""Approximate nearest neighbours by inner product: inverted lists with an adaptive dimension scan.

Inner products are searched as distances: a vector x becomes (x, sqrt(M^2 - |x|^2)) with M
the largest norm, a query q becomes (q, 0); then the nearest vector has the largest
inner product.  The vectors are rotated by one random orthogonal matrix, so the first
columns of a rotated difference estimate its whole length.

1. Centres: k-means over a sample of vectors, in the driver.  There are ``sqrt(n) / 2`` lists for n
   vectors, and the sample holds ``rows_per_list`` vectors for each and ``sample_rows`` at least; it is
   bounded by ``most_sample_rows``, so beyond about 4 million vectors (with the defaults) the lists grow
   longer, not more.  Every vector, of the sample or not, is filed in the list of its nearest centre; a list is cut
   into blocks of about ``block_rows``, so a list that holds a third of all vectors is spread.
2. A query probes its ``probes`` nearest lists.  Queries of a block are cut too, and each
   (list, vector block, query block) is one unit of work, sorted and streamed in a task.
3. Within a unit, candidates are scanned in blocks of ``columns`` rotated columns.  After each
   block a hypothesis test compares the partial distance with the query's bar, the k-th best
   distance so far: a candidate whose partial distance is too long for its whole one to be
   shorter, but with a small error probability, is abandoned.  The nearest lists, those that
   hold a query's first k candidates, are scanned first, from an open bar; the others
   start at the bar that these left.
4. The survivors' scores are computed from the original vectors in double precision; each
   unit gives its best k, and a window over those gives the query's best k.

``probes`` comes from the same sample, for tables of any size: the least number of lists at which the
sample's own queries find ``target`` of their true neighbours.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold null or
non-finite components take no part; equal scores are ranked by the smaller id; the
candidates are all rows but those of the query's own id, repeated rows each; a query id that
repeats asks once, with its least vector; a query probes further lists until they hold k
candidates; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintwise.session import materialize

QUERIES = 64                # queries scanned together


@dataclass
class Lists:
    """What a task needs to file a vector: rotation, largest norm, centres."""

    rotation: np.ndarray      # [d + 1, d + 1]
    longest: float
    centres: np.ndarray       # rotated

    def rotate(self, x: np.ndarray, query: bool) -> np.ndarray:
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest ** 2 - (x * x).sum(axis=1), 0))
        return np.column_stack([x, extra]) @ self.rotation

    def nearest(self, y: np.ndarray, n: int) -> np.ndarray:
        """Numbers of each rotated row's ``n`` nearest centres, nearest first."""
        d = (self.centres ** 2).sum(axis=1)[None, :] - 2 * y @ self.centres.T
        if n >= d.shape[1]:
            return np.argsort(d, axis=1, kind="stable")
        best = np.argpartition(d, n - 1, axis=1)[:, :n]
        return np.take_along_axis(best, np.argsort(np.take_along_axis(d, best, 1), axis=1, kind="stable"), 1)


def _kmeans(y: np.ndarray, n: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    # equal vectors count once, so a common one cannot fill the centres
    y = np.unique(y, axis=0)
    centres = y[rng.choice(len(y), min(n, len(y)), replace=False)]
    for _ in range(rounds):
        near = np.concatenate([np.argmin((centres ** 2).sum(1) - 2 * part @ centres.T, axis=1)
                               for part in np.array_split(y, -(-len(y) // 4096))])
        count = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, y[:, c], minlength=len(centres)) for c in range(y.shape[1])], axis=1)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def fit_lists(sample: np.ndarray, longest: float, lists: int, k: int, target: float, seed: int) -> tuple[Lists, int]:
    """Centres, and the least number of probes that finds ``target`` of the sample's neighbours."""
    rng = np.random.default_rng(seed)
    d = sample.shape[1] + 1
    rotation, _ = np.linalg.qr(rng.normal(size=(d, d)))
    made = Lists(rotation, longest, np.zeros((1, d)))
    y = made.rotate(sample, query=False)
    made.centres = _kmeans(y, lists, rng)
    asked = rng.choice(len(sample), min(256, len(sample)), replace=False)
    scores = sample[asked] @ sample.T
    scores[np.arange(len(asked)), asked] = -np.inf
    true = np.argsort(-scores, axis=1, kind="stable")[:, :min(k, len(sample) - 1)]
    if true.shape[1] == 0:
        return made, len(made.centres)
    home = made.nearest(y, 1)[:, 0]
    order = made.nearest(made.rotate(sample[asked], query=True), len(made.centres))
    depth = np.empty_like(order)
    np.put_along_axis(depth, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), axis=1)
    needed = np.sort(np.take_along_axis(depth, home[true], axis=1).ravel()) + 1
    return made, int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)])


class Columns:
    """Rotated vectors of one unit as contiguous blocks of columns, with each block's squared lengths."""

    def __init__(self, vectors: np.ndarray, width: int):
        self.rows, self.dims = vectors.shape
        self.edges = [*range(0, self.dims, width), self.dims]
        self.blocks = [np.ascontiguousarray(vectors[:, c:e], np.float32) for c, e in zip(self.edges, self.edges[1:])]
        self.squares = [np.einsum("ij,ij->i", b, b) for b in self.blocks]
        self.longest = float(sum(self.squares).max()) if self.rows else 0.0


def scan(queries: np.ndarray, bars: np.ndarray, vectors: Columns, k: int, strictness: float, own: np.ndarray,
         chunk: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of queries (rotated) and of the vectors that may be among their ``k`` nearest, chunk by chunk.

    ``bars``: squared distances beyond which a vector is none of them; ``own[i, j]``: vector j is query i itself.
    """
    q = queries.astype(np.float32)
    bars = bars.astype(np.float32)
    best = np.full((len(q), k), np.inf, np.float32)
    # distances are sums of single-precision products: what is this close counts as equal
    slack = (1e-5 * (np.einsum("ij,ij->i", q, q) + vectors.longest)).astype(np.float32)
    blocks = list(zip(vectors.edges, vectors.edges[1:], vectors.blocks, vectors.squares))
    lengths = [np.einsum("ij,ij->i", q[:, c:e], q[:, c:e]) for c, e, _, _ in blocks]
    for lo in range(0, vectors.rows, chunk):
        hi = min(vectors.rows, lo + chunk)
        live = ~own[:, lo:hi]
        part = np.zeros(live.shape, np.float32)
        who = None                               # None: all pairs of the chunk; later the live pairs alone
        for (c, upto, block, squares), length in zip(blocks, lengths):
            # The whole distance is about part * d / upto; its relative error shrinks with 1 / sqrt(upto).
            short = np.float32(upto / vectors.dims * (1 + strictness / np.sqrt(upto)) ** 2)
            last = upto == vectors.dims
            if who is None:
                part += squares[lo:hi] + length[:, None] - 2 * (q[:, c:upto] @ block[lo:hi].T)
                live &= part <= ((bars if last else bars * short) + slack)[:, None]
                if not last and np.count_nonzero(live) < live.size // 8:
                    who, which = np.nonzero(live)
                    part = part[who, which]
            elif len(who):
                x = block[lo + which]
                part = part + squares[lo + which] + length[who] - 2 * np.einsum("ij,ij->i", x, q[who, c:upto])
                go = part <= (bars if last else bars * short)[who] + slack[who]
                who, which, part = who[go], which[go], part[go]
        if who is None:
            who, which = np.nonzero(live)
            part = part[who, which]
        if not len(who):
            continue
        # the k-th best of what was kept so far lowers the bar
        met = np.unique(who)
        found = np.full((len(met), hi - lo), np.inf, np.float32)
        found[np.searchsorted(met, who), which] = part
        best[met] = np.partition(np.concatenate([best[met], found], axis=1), k - 1, axis=1)[:, :k]
        bars[met] = np.minimum(bars[met], best[met, k - 1])
        # ties with the k-th best stay: the exact scores and ids decide
        ok = part <= bars[who] + slack[who]
        yield who[ok], lo + which[ok]


def best_scores(who: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of every query's ``k`` best rows, by score and then by id."""
    order = np.lexsort((ids, -scores, who))
    first = np.searchsorted(who[order], who[order], side="left")
    return order[np.arange(len(order)) - first < k]


def _usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (array of double) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    rows = rows.select(F.col(key).cast("bigint").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.where(F.forall("v", fine) & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def nearest(rows: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
            lists: int | None = None, sample_rows: int = 8192, target: float = 0.97, block_rows: int = 8192,
            query_rows: int = 1024, columns: int = 16, strictness: float = 2.1, seed: int = 11,
            rows_per_list: int = 32, most_sample_rows: int = 1 << 15) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest found for every query row.

    ``is_query`` is a condition over the column ``id``.
    """
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = _usable(rows, key, vector)
    widths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if widths is None:
        return empty
    n, d = widths.n, widths.d
    rows = rows.where(F.size("v") == d)
    longest = rows.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()[0]
    if lists is None:
        lists = max(1, min(int(np.sqrt(n) / 2), most_sample_rows // rows_per_list))
    sample_rows = min(most_sample_rows, max(sample_rows, rows_per_list * lists))
    part = (sample_rows << 30) // n
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < part) if n > sample_rows else rows
    # about sample_rows vectors; a repeated id counts once, so the bound holds whatever repeats
    got = sample.groupBy("id").agg(F.min("v").alias("v")).orderBy("id").toArrow()
    if not got.num_rows:
        return empty
    made, probes = fit_lists(_matrix(got.column("v").combine_chunks()), longest, lists, k, target, seed)
    lists = len(made.centres)
    shared = spark.sparkContext.broadcast(made)
    filed_schema = "id bigint, v array<double>, y array<double>, first boolean, list int"

    def filed(batch: pa.RecordBatch, y: np.ndarray, at: np.ndarray, first: np.ndarray, lists_: np.ndarray) -> pa.RecordBatch:
        at = pa.array(at)
        ys = pa.FixedSizeListArray.from_arrays(pa.array(y.ravel()), y.shape[1]).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("v").take(at), ys.take(at),
                                           pa.array(first), pa.array(lists_.astype(np.int32))],
                                          ["id", "v", "y", "first", "list"])

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y = shared.value.rotate(_matrix(batch.column("v")), query=False)
                yield filed(batch, y, np.arange(len(y)), np.ones(len(y), bool), shared.value.nearest(y, 1)[:, 0])

    vectors = materialize(rows.mapInArrow(file, filed_schema), "ann-vectors")
    held = np.zeros(lists, np.int64)
    for r in vectors.groupBy("list").agg(F.count(F.lit(1)).alias("c")).collect():      # one row per list
        held[r.list] = r.c

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # few rows at a time: each becomes a row per list
        for batch in (b.slice(lo, 256) for b in batches for lo in range(0, b.num_rows, 256)):
            y = shared.value.rotate(_matrix(batch.column("v")), query=True)
            near = shared.value.nearest(y, lists)
            # first: the lists that hold the query's own rows and k more
            before = np.cumsum(held[near], axis=1) - held[near]
            first = before < k + batch.column("n").to_numpy()[:, None]
            at, depth = np.nonzero(first | (np.arange(lists) < probes))
            yield filed(batch, y, at, first[at, depth], near[at, depth])

    queries = rows.where(is_query).groupBy("id").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("n")).mapInArrow(ask, filed_schema)
    queries = materialize(queries, "ann-queries")
    piece = max(1, (1 << 22) // d)          # pairs scored at a time

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces():
            for b in batches:
                if not b.num_rows:
                    continue
                names_ = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("list", "i", "j")], axis=1)
                edge = np.flatnonzero((names_[1:] != names_[:-1]).any(axis=1)) + 1
                for lo, hi in zip([0, *edge], [*edge, len(names_)]):
                    p = b.slice(lo, hi - lo)
                    yield tuple(names_[lo]), (p.column("asks").to_numpy(zero_copy_only=False), p.column("id").to_numpy(),
                                              _matrix(p.column("v")), _matrix(p.column("y")), p.column("bar").to_numpy())

        for _, group in groupby(pieces(), key=lambda p: p[0]):
            asks, ids, v, y, bar = (np.concatenate(c) for c in zip(*(p for _, p in group)))
            vid, vv, vy = ids[~asks], v[~asks], Columns(y[~asks], columns)
            asking = np.flatnonzero(asks)
            for q in np.split(asking, range(QUERIES, len(asking), QUERIES)):
                rows_: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                # the k-th best inner product as a squared distance
                bars = longest ** 2 + (y[q] * y[q]).sum(axis=1) - 2 * bar[q]
                for who, which in scan(y[q], bars, vy, k, strictness, ids[q][:, None] == vid):
                    for lo in range(0, len(who), piece):
                        a, b = who[lo:lo + piece], which[lo:lo + piece]
                        rows_.append((a, vid[b], (vv[b] * v[q[a]]).sum(axis=1)))
                if rows_:
                    who, cand, score = (np.concatenate(c) for c in zip(*rows_))
                    top = best_scores(who, cand, score, k)
                    yield pa.RecordBatch.from_pydict({"query_id": pa.array(ids[q][who[top]], pa.int64()),
                                                      "vec_id": pa.array(cand[top], pa.int64()),
                                                      "score": pa.array(score[top], pa.float64())})

    blocks = lambda c, most: F.ceil(F.col(c) / F.lit(float(most))).cast("int")
    own = lambda c: F.pmod(F.xxhash64("id", F.col("list")), F.col(c).cast("bigint")).cast("int")
    names = ["list", "i", "j", "asks", "id", "v", "y", "bar"]
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def searched(asking: DataFrame) -> DataFrame:
        """Every unit's best rows for the (query, list) rows of ``asking``, whose ``bar`` is an inner product."""
        plan = (vectors.groupBy("list").agg(F.count(F.lit(1)).alias("c"))
                .join(asking.groupBy("list").agg(F.count(F.lit(1)).alias("q")), "list")
                .select("list", blocks("c", block_rows).alias("vb"), blocks("q", query_rows).alias("qb")))
        # one row per list, at most `lists`
        plan = F.broadcast(plan)
        units = (vectors.join(plan, "list").withColumn("i", own("vb")).withColumn("bar", F.lit(0.0))
                 .withColumn("j", F.explode(F.expr("sequence(0, qb - 1)"))).withColumn("asks", F.lit(False)))
        asked = (asking.join(plan, "list").withColumn("j", own("qb"))
                 .withColumn("i", F.explode(F.expr("sequence(0, vb - 1)"))).withColumn("asks", F.lit(True)))
        units = (units.select(names).unionByName(asked.select(names))
                 .repartition("list", "i", "j").sortWithinPartitions("list", "i", "j", "asks", "id"))
        return units.mapInArrow(search, "query_id bigint, vec_id bigint, score double")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = searched(queries.where("first").withColumn("bar", F.lit(float("-inf"))))
    near = materialize(best(near).select("query_id", "vec_id", "score"), "ann-near")
    # a query that has further lists has found k rows by now
    bars = near.groupBy(F.col("query_id").alias("id")).agg(F.min("score").alias("bar"))
    far = searched(queries.where("not first").join(bars, "id"))
    return best(near.unionByName(far)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

"""MinHash near-dedup: ProbMinHash signatures, banding, exact verification, classes.

Texts are weighted sets of five-word shingles (a shingle's weight is its count).  Every
shingle sends a Poisson process of arrivals to the registers of a signature; a register
keeps its first arrival.  Arrivals are made in rounds, in order of time for each shingle,
and a shingle stops once its time is past the text's last register.  Two registers agree
with the probability Jaccard similarity of the two sets.

1. Equal texts become one node.  Signatures are made in one pass over all texts.
2. Bands of a signature give bucket keys.  In a bucket every node is compared with the
   bucket's least node only (on signatures); buckets whose nodes then lie in different
   groups compare the nodes outside their largest group with all their nodes, in blocks.
   So every pair that shares a bucket is either in one group already or compared.
3. The groups are candidates.  Within a group the texts' exact similarities decide the
   links, in tasks bounded by rows and shingles; a large group is first linked within
   random blocks, then the nodes outside its largest class meet all others in blocks.
   Pairs that are already connected are not computed, so links stay linear in nodes.
4. Classes are the connected components of the verified links.

Pairs are never expanded within a group, and nothing but counts reaches the driver.

Defined cases: a null text is an empty text; texts with fewer than five words are one
shingle of all their words; texts without words are only in a class with equal texts;
equal texts (repeated rows too) are in one class; the class id is the least ``doc_id`` in
the class (null ids last; null if there is no other); an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintwise.llm.common import free_name, mix, slices, span_hash, text_bytes, words
from stintwise.llm.components import components
from stintwise.session import materialize

SHINGLE = 5
REGISTERS = 128
BAND = 4                    # registers in a band: 32 bands
SIMILARITY = 0.8
SLACK = 0.14                # 4 standard deviations of an estimate from 128 registers at 0.8
_ID_BITS = np.uint64(44)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, 44-bit id and count of every different shingle, sorted by row and id."""
    low = data.copy()
    caps = (low >= 65) & (low <= 90)
    low[caps] += 32
    starts, ends, row = words(low, offsets)
    h = span_hash(low, starts, ends)
    n = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(n) - n
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), count)
    at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    code = np.zeros(len(owner), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(SHINGLE):
            inside = i < n[owner]
            word = h[np.minimum(at + i, max(len(h) - 1, 0))] if len(h) else code
            code = mix(code * np.uint64(3) + np.where(inside, word, np.uint64(0)) + np.uint64(1))
    # rows of a slice fit 20 bits
    keys = np.sort((owner.astype(np.uint64) << _ID_BITS) | (code >> (np.uint64(64) - _ID_BITS)))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(keys)))
    keys = keys[at]
    return (keys >> _ID_BITS).astype(np.int64), keys & ((np.uint64(1) << _ID_BITS) - np.uint64(1)), weight


def signatures(row: np.ndarray, ids: np.ndarray, weight: np.ndarray, rows: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures (rows x registers, uint32) of weighted sets."""
    when = np.full(rows * registers, np.inf)
    who = np.zeros(rows * registers, np.uint32)
    live = np.arange(len(ids))
    clock = np.zeros(len(ids))
    state = mix(ids + np.uint64(0x5851F42D4C957F2D))
    while len(live):
        with np.errstate(over="ignore"):
            state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        u = ((state >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)
        clock = clock - np.log(u) / weight[live]
        with np.errstate(over="ignore"):
            register = (mix(state ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)) % np.uint64(registers)
        slot = row[live] * registers + register.astype(np.int64)
        np.minimum.at(when, slot, clock)
        won = when[slot] == clock
        who[slot[won]] = mix(ids[live[won]]) >> np.uint64(32)
        last = when.reshape(rows, registers).max(axis=1)
        go = clock < last[row[live]]
        live, clock, state = live[go], clock[go], state[go]
    return who.reshape(rows, registers)


def probability_jaccard(a_ids, a_weight, b_ids, b_weight) -> float:
    """Exact probability Jaccard similarity of two weighted sets with sorted ids."""
    place = np.searchsorted(b_ids, a_ids)
    place[place == len(b_ids)] = 0
    hit = b_ids[place] == a_ids if len(b_ids) else np.zeros(len(a_ids), bool)
    if not hit.any():
        return 0.0
    x, y = a_weight[hit].astype(np.float64), b_weight[place[hit]].astype(np.float64)
    only_a, only_b = a_weight.sum() - x.sum(), b_weight.sum() - y.sum()
    ratios, times = np.unique(y / x, return_counts=True)
    total = 0.0
    for r, t in zip(ratios, times):
        # for an element with y/x = r: 1 / sum(max(x' / x, y' / y)), up to its own y
        both = np.maximum(x * r, y).sum() + only_a * r + only_b
        total += y[y / x == r].sum() / both if t else 0.0
    return float(total)


def _most_similar(x: np.ndarray, y: np.ndarray, owner: np.ndarray, x_total: float, y_total: np.ndarray) -> np.ndarray:
    """Upper bounds of the similarity of one set with several; exact where shared elements weigh the same in both.

    ``y``: the weights of the several sets' elements, of set ``owner``; ``x``: those of the same
    elements in the one set, 0 if absent.  The sum of max(x' / x, y' / y) over all elements is at
    least that of y' / y over the other set's and of x' / x over this set's alone.
    """
    n = len(y_total)
    alone = x_total - np.bincount(owner, x, minlength=n)
    hit = x > 0
    x, y, owner = x[hit], y[hit], owner[hit]
    return np.bincount(owner, y / (y_total[owner] + alone[owner] * (y / x)), minlength=n)


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text."""
    return F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))


class _Groups:
    """Union-find over small numbers."""

    def __init__(self, labels):
        self.up = {x: x for x in labels}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _sign(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``key``, ``n`` (shingles) and ``sig`` of every row, written once."""
    kind = docs.schema["_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            row, ids, weight = shingles(*text_bytes(batch.column("_text")))
            sig = signatures(row, ids, weight, batch.num_rows)
            n = np.bincount(row, weight, minlength=batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_key"), pa.array(n), pa.array([s.tobytes() for s in sig], pa.binary())],
                ["doc_id", "key", "n", "sig"])

    signed = docs.mapInArrow(sign, f"doc_id {kind}, key binary, n bigint, sig binary")
    return materialize(signed.withColumn("row", F.monotonically_increasing_id()), "neardup-signed")


def _buckets(nodes: DataFrame) -> DataFrame:
    """``bucket``, ``node``: one row per band."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _matrix(batch.column("sig")).astype(np.uint64)
            parts = sig.reshape(len(sig), -1, BAND)
            h = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]).copy()
            for i in range(BAND):
                h = mix((h << np.uint64(1)) ^ parts[:, :, i])
            node = batch.column("node").to_numpy()
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(h.ravel().view(np.int64)),
                                              "node": pa.array(np.repeat(node, parts.shape[1]))})

    return nodes.where("n > 0").select("node", "sig").mapInArrow(bands, "bucket bigint, node bigint")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), -1)


def _alike(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs ``a``, ``b`` whose signatures agree on at least ``least`` of the registers."""
    sig = nodes.select("node", "sig")
    both = (pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (_matrix(batch.column("sa")) == _matrix(batch.column("sb"))).mean(axis=1) >= least
                yield batch.select(["a", "b"]).filter(pa.array(same))

    return both.mapInArrow(compare, "a bigint, b bigint")


def _streamed(batches: Iterator[pa.RecordBatch], keys: list[str]):
    """Rows of sorted batches, grouped by key columns."""
    def rows():
        for b in batches:
            cols = [b.column(c).to_pylist() for c in b.schema.names]
            yield from zip(*cols)
    return groupby(rows(), key=lambda r: r[:len(keys)])


def _rest_and_all(rows: DataFrame, unit: str, weight: Column, most: int) -> DataFrame:
    """Blocks that pair the rows outside a unit's largest class with all its rows.

    ``rows``: ``unit``, ``node``, ``label`` and what else is carried.  A unit of one class
    gives no row.  Returns the rows with ``i``, ``j`` (the block) and ``rest`` (side).
    """
    by = rows.groupBy(unit, "label").agg(F.count(F.lit(1)).alias("c"), F.sum(weight).alias("w"))
    top = by.groupBy(unit).agg(F.max(F.struct("c", "label")).alias("top"), F.count(F.lit(1)).alias("labels"),
                               F.sum("w").alias("w_all"), F.sum("c").alias("c_all"))
    rest = (by.join(top, unit).where(F.col("label") != F.col("top.label"))
            .groupBy(unit).agg(F.sum("w").alias("w_rest"), F.sum("c").alias("c_rest")))
    blocks = lambda w: F.ceil(F.col(w) / F.lit(float(most))).cast("int")
    plan = (top.where("labels > 1").join(rest, unit)
            .select(unit, F.col("top.label").alias("top"), F.greatest(blocks("w_all"), F.lit(1)).alias("na"),
                    F.greatest(blocks("w_rest"), F.lit(1)).alias("nr")))
    rows = rows.join(plan, unit)
    mine = lambda n: F.pmod(F.xxhash64("node"), F.col(n).cast("bigint")).cast("int")
    everyone = (rows.withColumn("i", mine("na")).withColumn("rest", F.lit(False))
                .withColumn("j", F.explode(F.expr("sequence(0, nr - 1)"))))
    outside = (rows.where(F.col("label") != F.col("top")).withColumn("j", mine("nr")).withColumn("rest", F.lit(True))
               .withColumn("i", F.explode(F.expr("sequence(0, na - 1)"))))
    return everyone.unionByName(outside.select(everyone.columns)).drop("top", "na", "nr")


def _sorted_by(rows: DataFrame, keys: list[str], then: list[str]) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys, *then)


def _links_in_buckets(members: DataFrame, nodes: DataFrame, labels: DataFrame, least: float, most: int) -> DataFrame:
    """Candidate links inside buckets that still hold nodes of different groups."""
    rows = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rows = _rest_and_all(rows.select("bucket", "node", "label"), "bucket", F.lit(1), most)
    rows = rows.join(nodes.select("node", "sig"), "node").select("bucket", "i", "j", "rest", "node", "label", "sig")
    keys = ["bucket", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for _, group in _streamed(batches, keys):
            group = list(group)
            a = [r for r in group if not r[3]]
            sig = np.frombuffer(b"".join(r[6] for r in a), np.uint32).reshape(len(a), -1) if a else None
            tied = _Groups({r[5] for r in group})
            for r in (r for r in group if r[3] and a):
                near = np.flatnonzero((sig == np.frombuffer(r[6], np.uint32)).mean(axis=1) >= least)
                for x in near:
                    if tied.join(r[5], a[x][5]):
                        out.append((r[4], a[x][4]))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out]), "b": pa.array([y for _, y in out])})
                out = []
        yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()),
                                          "b": pa.array([y for _, y in out], pa.int64())})

    return _sorted_by(rows, keys, ["rest", "node"]).mapInArrow(compare, "a bigint, b bigint")


def _verify(rows: DataFrame, keys: list[str], similarity: float, least: float) -> DataFrame:
    """Exact links within each group of ``keys``, as few as connect what is connected.

    ``rows`` also has ``rest`` (null: compare all with all; else the rest with the others),
    ``label`` (nodes of equal label are connected already), ``node``, ``sig`` and ``text``.
    """
    names = [*keys, "rest", "label", "node", "sig", "text"]
    k = len(keys)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []

        def batch_out():
            return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()),
                                               "b": pa.array([y for _, y in out], pa.int64())})

        def solve(groups: list[list[tuple]]) -> None:
            flat = [r for g in groups for r in g]
            row, ids, weight = shingles(*text_bytes(pa.array([r[k + 4] for r in flat], pa.large_string())))
            edge = np.searchsorted(row, np.arange(len(flat) + 1))
            code = np.unique(ids, return_inverse=True)[1]
            mine = np.zeros(len(code) + 1)              # the weights of one set's elements, by code
            total = np.bincount(row, weight, minlength=len(flat))
            sig = np.frombuffer(b"".join(r[k + 3] for r in flat), np.uint32).reshape(len(flat), -1)

            def bounds(i: int, others: np.ndarray) -> np.ndarray:
                size = edge[others + 1] - edge[others]
                owner = np.repeat(np.arange(len(others)), size)
                place = np.arange(len(owner)) + (edge[others] - np.cumsum(size) + size)[owner]
                return _most_similar(mine[code[place]], weight[place].astype(np.float64), owner, total[i], total[others])

            at = 0
            for g in groups:
                n = len(g)
                own = sig[at:at + n]
                root = np.unique([r[k + 1] for r in g], return_inverse=True)[1]
                split = sum(1 for r in g if not r[k]) if g[0][k] is not None else None
                for i in range(split if split is not None else 1, n):
                    upto = split if split is not None else i
                    agree = (own[:upto] == own[i]).mean(axis=1)
                    near = np.flatnonzero((agree >= least) & (root[:upto] != root[i]))
                    near = near[np.argsort(-agree[near], kind="stable")]
                    x = slice(edge[at + i], edge[at + i + 1])
                    mine[code[x]] = weight[x]
                    some = 4                            # sets looked at together; a link leaves fewer to look at
                    while len(near):
                        part, near = near[:some], near[some:]
                        for j in part[bounds(at + i, at + part) >= similarity - 1e-9]:
                            y = slice(edge[at + j], edge[at + j + 1])
                            if root[i] != root[j] and probability_jaccard(ids[x], weight[x], ids[y], weight[y]) >= similarity:
                                root[root == root[j]] = root[i]
                                out.append((g[i][k + 2], g[j][k + 2]))
                        near = near[root[near] != root[i]]
                        some = min(256, 4 * some)
                    mine[code[x]] = 0
                at += n

        held, size = [], 0
        for _, group in _streamed(batches, keys):
            seen = set()
            # a repeated row meets its node once
            group = [r for r in group if (r[k], r[k + 2]) not in seen and not seen.add((r[k], r[k + 2]))]
            held.append(group)
            size += sum(len(r[k + 4]) for r in group)
            if size > 1 << 21:
                solve(held)
                held, size = [], 0
            if len(out) > 10_000:
                yield batch_out()
                out.clear()
        solve(held) if held else None
        yield batch_out()

    return _sorted_by(rows.select(names), keys, ["rest", "node"]).mapInArrow(verify, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                    bucket_block: int = 1024, group_rows: int = 2048, group_shingles: int = 2_000_000,
                    with_keys: bool = False) -> DataFrame:
    """``doc_id`` and ``class_id`` of every row; see the module's text.

    ``with_keys`` adds ``class_key``, a number for the class, and ``text_key``.
    """
    docs = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    docs = docs.withColumn("_key", text_key(F.col("_text")))
    signed = _sign(docs)
    least = similarity - SLACK
    nodes = signed.groupBy("key").agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id"),
                                      F.first("n").alias("n"), F.first("sig").alias("sig"))
    nodes = materialize(nodes, "neardup-nodes")

    rows = _buckets(nodes)
    shared = rows.groupBy("bucket").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("c")).where("c > 1")
    members = materialize(rows.join(shared, "bucket"), "neardup-buckets")
    pairs = members.where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
    found = materialize(_alike(pairs, nodes, least), "neardup-candidates")
    groups = components(found).select(F.col("a").alias("node"), F.col("b").alias("label"))
    # A bucket of two has been compared in full.
    more = materialize(_links_in_buckets(members.where("c > 2").select("bucket", "node"), nodes, groups, least,
                                         bucket_block), "neardup-candidates")
    if not more.isEmpty():
        groups = components(found.unionByName(more)).select(F.col("a").alias("node"), F.col("b").alias("label"))

    # Members of candidate groups, the least node of each included.
    inside = groups.unionByName(groups.select(F.col("label").alias("node"), "label").distinct())
    inside = inside.withColumnRenamed("label", "comp").join(nodes, "node")
    # Tasks are bounded in rows and in shingles: a row counts by the larger share.
    share = F.greatest(F.lit(1.0), F.col("n") * F.lit(group_rows / group_shingles))
    sizes = inside.groupBy("comp").agg(F.ceil(F.sum(share) / F.lit(float(group_rows))).cast("int").alias("blocks"))
    inside = inside.join(sizes, "comp").select("comp", "blocks", "node", "key", "least_id", "sig", share.alias("share"))
    with_text = materialize(
        inside.join(docs, (F.col("key") == F.col("_key")) & F.col("least_id").eqNullSafe(F.col("_id")))
        .select("comp", "blocks", "node", "sig", "share", F.col("_text").alias("text")), "neardup-groups")

    blank = F.lit(None).cast("boolean").alias("rest")
    big = with_text.where("blocks > 1")
    rounds = [with_text.where("blocks = 1").select("comp", F.lit(0).alias("i"), blank, F.col("node").alias("label"),
                                                   "node", "sig", "text")]
    rounds += [big.select("comp", (F.pmod(F.xxhash64("node", F.lit(salt)), F.col("blocks").cast("bigint"))
                                   + salt * 1_000_000_000).cast("bigint").alias("i"),
                          blank, F.col("node").alias("label"), "node", "sig", "text") for salt in (1, 2)]
    first = rounds[0].withColumn("i", F.col("i").cast("bigint")).unionByName(rounds[1]).unionByName(rounds[2])
    links = materialize(_verify(first, ["comp", "i"], similarity, least), "neardup-links")
    classes = components(links).select(F.col("a").alias("node"), F.col("b").alias("label"))
    if not big.isEmpty():
        rest = big.join(classes, "node", "left").withColumn("label", F.coalesce("label", "node"))
        rest = _rest_and_all(rest.select("comp", "node", "label", "sig", "share", "text"), "comp",
                             F.col("share"), group_rows)
        more = materialize(_verify(rest, ["comp", "i", "j"], similarity, least), "neardup-links")
        if not more.isEmpty():
            classes = components(links.unionByName(more)).select(F.col("a").alias("node"), F.col("b").alias("label"))

    named = nodes.select("key", "node", "least_id").join(classes, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    ids = named.groupBy("label").agg(F.min("least_id").alias("class_id"))
    by_key = named.join(ids, "label").select("key", "class_id", F.col("label").alias("class_key"))
    rows = signed.select(F.col("doc_id").alias(key), "key").join(by_key, "key")
    names = [key, "class_id"] if not with_keys else [key, "class_id", "class_key", F.col("key").alias("text_key")]
    return rows.select(names)


def keep_one(docs: DataFrame, classes: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class: that of the least id, ties by the text's key; equal rows are one row.

    ``classes`` is the result of ``near_duplicates`` over the same rows, ``class_key`` included:
    a class is found by the text, so rows without an id and ids with several texts are kept once
    a class too.
    """
    mine, lead, lead_text = (free_name(docs, c) for c in ("_key", "_lead", "_lead_text"))
    texts = docs.withColumn(mine, text_key(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    # the least row of each class; a row without an id comes after those with one
    order = F.struct(F.col(key).isNull(), F.col(key), F.col("text_key"))
    leads = classes.groupBy("class_key").agg(F.min(order).alias("least"))
    leads = leads.select(F.col("least")[key].alias(lead), F.col("least.text_key").alias(lead_text))
    same = F.col(lead).eqNullSafe(F.col(key)) & (F.col(lead_text) == F.col(mine))
    return texts.join(leads, same, "left_semi").dropDuplicates([key, mine]).drop(mine)

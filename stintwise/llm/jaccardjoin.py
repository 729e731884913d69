"""N-gram Jaccard join with adaptive multi-match prefixes, and the components of its links.

A document is the set of its distinct word shingles.  Two documents link when the sizes of
their intersection and union are at least as 85 to 100 (``least``), compared in integers.

1. How often shingles occur is estimated over all documents: every task counts shingles in
   a fixed number of hash cells, and the cells are summed (``CELLS`` numbers, whatever the
   corpus).  Shingles are ordered by that estimate, rare ones first, then by their hash.
2. With the l-prefix scheme a set of n shingles keeps its first n - o + l, where o is the
   least overlap of a link.  Linked sets share at least l shingles in their l-prefixes.  Each
   document picks its own l: a longer prefix means more postings to read, but a candidate
   must then share l of them, and postings / l bounds the candidates.  The l of least
   estimated cost wins.  A pair goes by the l of its larger set, as probe; of both prefixes
   only the places count that the least overlap for their two sizes leaves.
3. Postings meet by shingle in one exchange that a worker reads in order; shingles with one
   posting end there, the others are numbered within their list.
4. A set's digest is the parity of its hashes' low bits, as many bits as it has shingles or
   some more.  Two digests differ in no more bits than the sets differ in shingles, and the sizes
   say how many those are at most in a link.  Pairs beyond that are dropped before their sets are
   fetched; no link is among them.
5. Large groups of copies are never made into pairs.  A list's heads are the ``HEADS`` documents
   with the most shared prefix shingles, so the least edited ones and much the same ones in all
   lists of a group; matches are first counted between heads and documents only, one row a
   posting and head.  Of the pairs with l matches or more each document's best is compared exactly,
   and links make classes.  After that only documents of different classes can add a link that
   matters: the other pairs with heads that are still apart, and in each list those outside its
   largest class, which meet the list where digests folded to ``NARROW`` bits leave room for a
   link; pairs with l matches or more are compared.  Every link is thus inside a class or compared.
6. Components of all links found are the components of all links.

Exact sets (64-bit shingle hashes, compared by Spark row by row) decide every link.  Documents with equal sets are one
node throughout.  The second part of step 5 looks at each pair of postings of a list, which is
quadratic where very many documents share rare shingles without being linked; rows are made
only of those pairs that their digests let pass, and Spark splits the lists.

Defined cases: null texts are empty; a text without words has an empty set, links with
nothing and is its own component; fewer words than a shingle are one shingle of all words;
repeated rows and equal sets are linked; the component id is the least ``doc_id`` among its
rows (null if none has an id); an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintwise.llm.common import mix, slices, span_hash, text_bytes, words
from stintwise.llm.components import components
from stintwise.llm.neardup import text_key
from stintwise.session import materialize

SHINGLE = 4
LEAST = (85, 100)           # intersection : union
CELLS = 1 << 18             # cells of the frequency estimate
PIECE = 1 << 12             # cells that travel together
MOST_MATCHES = 6            # the largest l
HEADS = 1                   # documents of a list that all of it is compared with first
NARROW = 256                # bits of a digest beside a posting
NARROW_WORDS = [f"d{i}" for i in range(NARROW // 64)]
SLICE = 1 << 19             # bytes of text that a worker looks at together
KEY_BITS = 25               # of the table of wanted text keys: 4 MB
VERIFY_SHARE = 4            # comparing two sets of n costs as much as reading n / 4 postings


def word_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes of every row, ascending, and the rows' offsets in them."""
    low = data.copy()
    caps = (low >= 65) & (low <= 90)
    low[caps] += 32
    starts, ends, row = words(low, offsets)
    h = span_hash(low, starts, ends)
    rows = len(offsets) - 1
    n = np.bincount(row, minlength=rows)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    edge = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(rows), count)
    at = (np.cumsum(n) - n)[owner] + np.arange(len(owner)) - edge[owner]
    code = np.zeros(len(owner), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            word = np.where(i < n[owner], h[np.minimum(at + i, max(len(h) - 1, 0))], np.uint64(0)) if len(h) else code
            code = mix(code * np.uint64(3) + word + np.uint64(1))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        code[a:b].sort()
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    return code[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=rows))]).astype(np.int64)


def cell(code: np.ndarray) -> np.ndarray:
    return (code >> np.uint64(64 - (CELLS.bit_length() - 1))).astype(np.int64)


def frequency_cells(docs: DataFrame, text: str = "_text") -> np.ndarray:
    """Documents per hash cell of a shingle, over all documents: ``CELLS`` numbers in the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in slices(batches, text, SLICE):
            total += np.bincount(cell(word_sets(*text_bytes(batch.column(text)))[0]), minlength=CELLS)
        used = np.flatnonzero(total.reshape(-1, PIECE).any(axis=1))
        yield pa.RecordBatch.from_pydict({
            "piece": pa.array(used, pa.int32()),
            "counts": pa.array([p.tobytes() for p in total.reshape(-1, PIECE)[used]], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}        # at most CELLS / PIECE entries
        for batch in batches:
            for p, c in zip(batch.column("piece").to_pylist(), batch.column("counts")):
                got = np.frombuffer(c.as_buffer(), np.int64)
                sums[p] = sums[p] + got if p in sums else got
        yield pa.RecordBatch.from_pydict({"piece": pa.array(list(sums), pa.int32()),
                                          "counts": pa.array([v.tobytes() for v in sums.values()], pa.binary())})

    kind = "piece int, counts binary"
    out = np.zeros((CELLS // PIECE, PIECE), np.int64)
    for r in docs.select(text).mapInArrow(count, kind).repartition("piece").mapInArrow(add, kind).collect():
        out[r.piece] += np.frombuffer(r.counts, np.int64)
    return out.ravel()


def estimates(cells: np.ndarray) -> np.ndarray:
    """Other documents expected to hold a shingle of each cell: its count less what cells hold on average."""
    return np.maximum(cells - cells.mean(), 0).astype(np.float32)


def adaptive_prefix(code: np.ndarray, expected: np.ndarray, most: int = MOST_MATCHES,
                    least: tuple[int, int] = LEAST) -> tuple[np.ndarray, int]:
    """The longest prefix a set of ascending hashes may need, rare shingles first, and the l it probes with."""
    n = len(code)
    here = expected[cell(code)]
    order = np.argsort(np.log2(here + 1).astype(np.uint8), kind="stable")
    overlap = -(-least[0] * n // least[1])      # shared with a set that is not larger, at least
    reach = np.arange(1, min(most, overlap) + 1)
    postings = np.cumsum(here[order], dtype=np.float64)[n - overlap + reach - 1]
    best = int(np.argmin(postings * (1 + n / VERIFY_SHARE / reach)))
    return code[order[:min(n, n - overlap + most)]], int(reach[best])


def digest(code: np.ndarray) -> bytes:
    """Parity of the hashes in each cell of their low bits: ``NARROW`` bits, doubled until there are as many as hashes."""
    width = max(NARROW, 1 << max(len(code) - 1, 0).bit_length())
    count = np.bincount((code & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((count & 1).astype(np.uint8)).tobytes()


def folded(own: bytes, size: int) -> bytes:
    """A digest as if taken with ``size`` bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(own, np.uint8).reshape(-1, size), axis=0).tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits in which two digests differ, the longer one folded; the sets differ in that many shingles or more."""
    size = min(len(a), len(b))
    return (int.from_bytes(folded(a, size), "big") ^ int.from_bytes(folded(b, size), "big")).bit_count()


def _signed(docs: DataFrame, expected, least: tuple[int, int], most: int) -> DataFrame:
    """Per row: id, text key, set key, size, l, prefix, digest and narrow digest; numbered and written once."""
    kind = docs.schema["_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = expected.value
        for batch in slices(batches, "_text", SLICE):
            code, edge = word_sets(*text_bytes(batch.column("_text")))
            keys, sizes, ell, prefix, bits = [], np.diff(edge), [], [], []
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                own = code[a:b]
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                first, reach = adaptive_prefix(own, table, most, least) if b > a else (own, 0)
                ell.append(reach)
                prefix.append(first.tobytes())
                bits.append(digest(own))
            narrow = np.frombuffer(b"".join(folded(b, NARROW // 8) for b in bits), np.int64).reshape(len(bits), -1).T.copy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_key"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(ell, pa.int32()), pa.array(prefix, pa.binary()), pa.array(bits, pa.binary()), *(pa.array(d) for d in narrow)],
                ["doc_id", "text_key", "key", "n", "l", "prefix", "digest", *NARROW_WORDS])

    kind = f"doc_id {kind}, text_key binary, key binary, n bigint, l int, prefix binary, digest binary"
    rows = docs.mapInArrow(sign, ", ".join([kind, *(f"{d} bigint" for d in NARROW_WORDS)]))
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "join-signed")


def _postings(nodes: DataFrame) -> DataFrame:
    """``token``, ``node`` and ``pos`` of the tokens in more than one prefix."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, prefix = batch.num_rows, batch.column("prefix").to_pylist()
            for a in range(0, rows, 512):
                own = prefix[a:a + 512]
                sizes = np.array([len(p) // 8 for p in own])
                which = np.repeat(np.arange(a, a + len(own)), sizes)
                pos = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(b"".join(own), np.int64)), batch.column("node").take(pa.array(which)),
                     pa.array(pos, pa.int32())], ["token", "node", "pos"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted postings without the single ones; a list may go on over any number of batches."""
        last, held = None, None                # token of the last row, and that row if it is its list's first
        for batch in batches:
            if not batch.num_rows:
                continue
            token = batch.column("token").to_numpy()
            start = np.ones(len(token), bool)
            start[1:] = token[1:] != token[:-1]
            start[0] = last is None or token[0] != last
            if held is not None and not start[0]:
                yield held
            yield batch.filter(pa.array(~start | np.append(~start[1:], False)))
            last, held = token[-1], batch.slice(len(token) - 1) if start[-1] else None

    kind = "token bigint, node bigint, pos int"
    rows = nodes.select("node", "prefix").mapInArrow(spread, kind)
    rows = rows.repartition("token").sortWithinPartitions("token")
    return materialize(rows.mapInArrow(shared, kind), "join-postings")


def _room(n: str, m: str, bits: Column, least: tuple[int, int]) -> Column:
    """Whether sets of these sizes that differ in so many shingles may link."""
    s, u = least
    return bits * (u + s) <= (F.col(n) + F.col(m)) * (u - s)


def _plausible(pairs: DataFrame, known: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs ``a``, ``b`` whose digests leave room for a link."""

    @F.arrow_udf("bigint")
    def bits(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([differing(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.int64())

    of = lambda c: known.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("digest").alias(f"d_{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    return both.where(_room("n_a", "n_b", bits("d_a", "d_b"), least)).select(*pairs.columns)


def _linked(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets link."""
    s, u = least
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("codes").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("codes").alias("sb")), "b"))
    both = both.select("a", "b", (F.size("sa") + F.size("sb")).cast("bigint").alias("total"),
                       F.size(F.array_intersect("sa", "sb")).cast("bigint").alias("joint"))
    return both.where(F.col("joint") * u >= (F.col("total") - F.col("joint")) * s).select("a", "b")


def _sets(docs: DataFrame, known: DataFrame, pairs: DataFrame) -> DataFrame:
    """``node`` and ``codes``, the whole set, of the documents in ``pairs``.

    Texts are first held against a bit table of the wanted text keys, of a fixed size, so that
    few others are shuffled while the wanted ones are few.
    """
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    named = materialize(known.join(nodes, "node", "left_semi").select("node", F.col("doc_id").alias("id"), "text_key"),
                        "join-wanted")
    place = F.expr(f"shiftright(cast(conv(hex(substring(text_key, 1, 4)), 16, 10) as bigint), {32 - KEY_BITS})")
    bits = named.select(F.shiftright(place, 6).alias("word"),
                        F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int")).alias("bit"))
    table = np.zeros(1 << (KEY_BITS - 6), np.int64)
    got = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()      # at most the table's words
    table[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    wanted = docs.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def maybe(keys: pa.Array) -> pa.Array:          # only the keys go to the worker
        key = np.frombuffer(b"".join(keys.to_pylist()), ">u4")[::4].astype(np.int64) >> (32 - KEY_BITS)
        return pa.array((wanted.value[key >> 6] >> (key & 63)) & 1 == 1)

    docs = docs.where(maybe("_key"))
    texts = (docs.join(named, (F.col("_key") == F.col("text_key")) & F.col("_id").eqNullSafe(F.col("id")))
             .groupBy("node").agg(F.first("_text").alias("_text")))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", SLICE):
            code, edge = word_sets(*text_bytes(batch.column("_text")))
            codes = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(code.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), codes], ["node", "codes"])

    return materialize(texts.mapInArrow(sets_of, "node bigint, codes array<bigint>"), "join-sets")


def _matches(some: DataFrame, rows: DataFrame, which: Column, least: tuple[int, int]) -> DataFrame:
    """Pairs with l matches or more: ``a`` (the larger set, whose l counts), ``b``, ``matches``, and ``one`` of ``some``.

    Columns of ``some`` are called ``_r`` in ``which``, the condition on a pair of postings.
    """
    s, u = least
    mine = some.select(*[F.col(c).alias(f"{c}_r") for c in some.columns])
    ahead = F.struct("n_r", "node_r") > F.struct("n", "node")
    pick = lambda yes, no: F.when(ahead, F.col(yes)).otherwise(F.col(no))
    met = (mine.join(rows, F.col("token") == F.col("token_r")).where(which)
           .where(F.least("n", "n_r") * u >= F.greatest("n", "n_r") * s)
           .select(pick("node_r", "node").alias("a"), pick("node", "node_r").alias("b"), pick("l_r", "l").alias("l"),
                   pick("n_r", "n").alias("na"), pick("n", "n_r").alias("nb"),
                   pick("pos_r", "pos").alias("pa"), pick("pos", "pos_r").alias("pb"), F.col("node_r").alias("one")))
    overlap = f"({s} * (na + nb) + {s + u - 1}) div {s + u}"            # of a link between sets of these sizes
    return (met.where(f"pa < na - {overlap} + l AND pb < nb - {overlap} + l")
            .groupBy("a", "b").agg(F.count(F.lit(1)).alias("matches"), F.min("l").alias("l"), F.min("one").alias("one"))
            .where("matches >= l").select("a", "b", "matches", "one"))


def _across(shared: DataFrame, labels: DataFrame, known: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Pairs ``a``, ``b`` of different labels with enough matches, as far as narrow digests leave room for a link."""
    rows = shared.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rows = rows.join(known.select("node", *NARROW_WORDS), "node")
    rows = materialize(rows.select("token", "node", "n", "l", "pos", "label", *NARROW_WORDS), "join-labelled")
    tops = (rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("token").agg(F.max(F.struct("c", "label"))["label"].alias("top"), F.count(F.lit(1)).alias("labels"))
            .where("labels > 1").select("token", "top"))
    rows = materialize(rows.join(tops, "token"), "join-mixed")
    bits = sum((F.bit_count(F.col(d).bitwiseXOR(F.col(f"{d}_r"))) for d in NARROW_WORDS[1:]),
               F.bit_count(F.col("d0").bitwiseXOR(F.col("d0_r"))))
    which = F.expr("label <> label_r AND (label = top OR node_r < node)") & _room("n", "n_r", bits, least)
    return _matches(rows.where("label <> top"), rows, which, least).select("a", "b")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose nodes have different labels."""
    of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return both.where(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select("a", "b")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", least: tuple[int, int] = LEAST,
                       most: int = MOST_MATCHES) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row; see the module's text."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    docs = docs.withColumn("_key", text_key(F.col("_text")))
    expected = spark.sparkContext.broadcast(estimates(frequency_cells(docs)))
    signed = _signed(docs, expected, least, most)
    nodes = materialize(signed.where("n > 0").groupBy("key").agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id")),
                        "join-nodes")
    firsts = signed.join(nodes.select(F.col("node").alias("row"), F.col("node")), "row")
    shared = _postings(firsts)
    known = materialize(firsts.select("node", "doc_id", "text_key", "n", "l", "digest", *NARROW_WORDS), "join-known")

    common = shared.groupBy("node").agg(F.count(F.lit(1)).alias("common"))
    sizes = known.select("node", "n", "l").join(common, "node")
    shared = materialize(shared.join(sizes, "node"), "join-ordered")
    first = Window.partitionBy("token").orderBy(F.desc("common"), "node")
    heads = shared.withColumn("at", F.row_number().over(first)).where(F.col("at") <= HEADS).drop("at")
    behind = F.expr("common_r < common OR (common_r = common AND node_r > node)")
    pairs = materialize(_matches(shared, heads, behind, least), "join-met")
    pairs = materialize(_plausible(pairs, known, least), "join-candidates")

    best = pairs.groupBy("one").agg(F.max(F.struct("matches", "a", "b")).alias("best")).select("best.a", "best.b")
    best = materialize(best, "join-best")
    classes = components(materialize(_linked(best, _sets(docs, known, best), least), "join-links"))
    labels = classes.toDF("node", "label")
    found = materialize(_across(shared, labels, known, least).join(pairs, ["a", "b"], "left_anti"), "join-met")
    found = materialize(_plausible(found, known, least).unionByName(_apart(pairs, labels)), "join-candidates")
    more = materialize(_linked(found, _sets(docs, known, found), least), "join-links")
    classes = components(classes.unionByName(more)).toDF("node", "label")

    named = nodes.join(classes, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    by_key = materialize(named.join(ids, "label").select("key", "component_id"), "join-classes")
    rows = signed.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), "key")
    linked = rows.where("n_shingles > 0").join(by_key, "key").select(key, "n_shingles", "component_id")
    return linked.unionByName(rows.where("n_shingles = 0").select(key, "n_shingles", F.col(key).alias("component_id")))

"""Prefix trie of conversations by van Emde Boas recursion over depth.

A node is a distinct sequence of first turns.  The range of depths is cut in half again
and again, and all halves of one size are handled in the same Spark jobs:

1. Keys of aligned blocks of 1, 2, 4, ... turns are made from the keys of their halves.
2. Downwards, each cut prefix is named: the prefix that ends at an odd multiple of a
   block size by the name of the (already named) cut above it and the key of the block
   between them.  So the upper trie of a range and the lower forests below its cut are
   built side by side, and equal prefixes have equal names without being brought together.
3. The nodes are the distinct names.  Every node gets links to its ancestors at the cuts
   above it, read off the path of its smallest member.
4. Totals are grafted: first each block sums what lies in it, block sizes doubling; then
   every cut node hands its whole total, known from the larger block, to the cut above it.

Turn rows, names, links and messages are each about twice the turns in total, whatever the
depth, in jobs that grow with the logarithm of the longest conversation.  Keys of the
shuffles are (conversation, place) or the node, where sums and minima are combined before
the exchange; a long conversation and a node that all conversations share are both spread.

Names are the first 16 bytes of SHA-256 digests.

Defined cases: turns go by ``turn``, null first, ties by the digest of role and text, so
repeated rows are turns of their own; null roles and texts are empty; rows without a
conversation id are in no conversation and stay out; a conversation without turns (which
only a caller that gives ``members`` can have) ends at the root; an empty table has no
root; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintwise.operators.normalise import with_dense_id
from stintwise.session import materialize

CHUNK_IDS = 8192            # conversation ids in one piece of a list that is hashed


def digest(*parts: Column) -> Column:
    """16 bytes that stand for binary parts, one after the other."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def place_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``steps`` (conv, depth, key, bytes) and ``members`` (conv, length) of a table of turns.

    Places come from one numbering of all rows in order, so a conversation of any length
    is sorted by many tasks.
    """
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    who = F.coalesce(F.col(role).cast("string"), F.lit(""))
    key = digest(F.octet_length(who).cast("string").cast("binary"), F.lit(":").cast("binary"),
                 who.cast("binary"), said.cast("binary"))
    turns = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), key.alias("key"),
        F.octet_length(said).cast("long").alias("bytes"))
    numbered = with_dense_id(turns, ["conv", "turn", "key"], "at")
    members = materialize(numbered.groupBy("conv").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("length")),
                          "trie-members")
    steps = numbered.join(members, "conv").select("conv", (F.col("at") - F.col("first") + 1).alias("depth"), "key", "bytes")
    return materialize(steps, "trie-steps"), members.select("conv", "length")


def shared_openings(steps: DataFrame, members: DataFrame, opening: Column, every: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``opening`` turns are those of the group's first conversation.

    Conversation c takes the first h turns (``opening``, of ``conv``) of conversation
    c - c % ``every``: all if it has fewer, none if it is not there.  Its own turns after
    its first h follow.
    """
    own = members.select("conv", "length", opening.cast("long").alias("h"),
                         (F.col("conv") - F.col("conv") % every).alias("donor"))
    givers = members.select(F.col("conv").alias("donor"), F.col("length").alias("given"))
    plan = own.join(givers, "donor", "left").select(
        "conv", "donor", "h", F.least("h", F.coalesce("given", F.lit(0))).alias("taken"),
        F.greatest(F.col("length") - F.col("h"), F.lit(0)).alias("rest"))
    plan = materialize(plan, "trie-openings")
    rest = (steps.join(plan.select("conv", "h", "taken"), "conv").where("depth > h")
            .select("conv", (F.col("depth") - F.col("h") + F.col("taken")).alias("depth"), "key", "bytes"))
    taken = (steps.withColumnRenamed("conv", "donor").join(plan.select("conv", "donor", "taken"), "donor")
             .where("depth <= taken").select("conv", "depth", "key", "bytes"))
    return (materialize(rest.unionByName(taken), "trie-steps"),
            plan.select("conv", (F.col("taken") + F.col("rest")).alias("length")))


def _blocks(steps: DataFrame, levels: int) -> list[DataFrame]:
    """Per level j: ``conv``, ``k``, ``key`` and the last turn's ``bytes`` of full blocks of 2**j turns."""
    out = [steps.select("conv", (F.col("depth") - 1).alias("k"), "key", "bytes")]
    even = F.col("k") % 2 == 0
    for _ in range(levels):
        halves = out[-1].groupBy("conv", F.expr("k div 2").alias("k2")).agg(
            F.max(F.when(even, F.col("key"))).alias("upper"), F.max(F.when(~even, F.col("key"))).alias("lower"),
            F.max(F.when(~even, F.col("bytes"))).alias("bytes"))
        whole = halves.where("lower is not null").select(
            "conv", F.col("k2").alias("k"), digest(F.col("upper"), F.col("lower")).alias("key"), "bytes")
        out.append(materialize(whole, "trie-blocks"))
    return out


def _names(blocks: list[DataFrame], members: DataFrame) -> DataFrame:
    """``conv``, ``d``, ``name``, ``bytes``: the name of every prefix of every conversation."""
    root = members.select("conv", F.lit(0).cast("long").alias("d"), F.lit(b"").alias("name"), F.lit(0).cast("long").alias("bytes"))
    known = root
    for j in reversed(range(len(blocks))):
        below = blocks[j].where("k % 2 = 0").select("conv", (F.col("k") * (1 << j)).alias("d"), "key",
                                                    F.col("bytes").alias("last"))
        step = known.join(below, ["conv", "d"]).select(
            "conv", (F.col("d") + (1 << j)).alias("d"), digest(F.col("name"), F.col("key")).alias("name"),
            F.col("last").alias("bytes"))
        known = known.unionByName(materialize(step, "trie-names"))
    return known


def _links(nodes: DataFrame, names: DataFrame, levels: int) -> DataFrame:
    """``name``, ``d``, ``j``, ``up``: each node's ancestor 2**j turns above, for each 2**j that divides its depth."""
    cuts = F.filter(F.sequence(F.lit(0), F.lit(max(levels - 1, 0))),
                    lambda j: F.col("d") % F.call_function("shiftleft", F.lit(1).cast("long"), j) == 0)
    ends = nodes.where("d > 0").select("name", "d", F.col("rep").alias("conv"), F.explode(cuts).alias("j"))
    ends = ends.withColumn("at", F.expr("d - shiftleft(1L, j)"))
    above = names.select("conv", F.col("d").alias("at"), F.col("name").alias("up"))
    return ends.join(above, ["conv", "at"]).select("name", "d", "j", "up")


def _sums(parts: DataFrame) -> DataFrame:
    return parts.groupBy("name", "d").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _graft(weights: DataFrame, links: DataFrame, levels: int) -> DataFrame:
    """``name``, ``leaves``, ``saved``: sums of ``weights`` over everything strictly below each node."""
    def lifted(rows: DataFrame, j: int) -> DataFrame:
        to = links.where(F.col("j") == j).select("name", "up")
        return rows.join(to, "name").select(F.col("up").alias("name"), (F.col("d") - (1 << j)).alias("d"), "leaves", "saved")

    # Upwards: what lies below a node inside the block that starts at it, blocks doubling.
    block = materialize(_sums(lifted(weights.where("d > 0"), 0)), "trie-block-sums")
    odd = []
    for j in range(levels):
        lower = F.expr(f"shiftright(d, {j}) % 2 = 1")
        odd.append(block.where(lower))
        block = materialize(_sums(block.where(~lower).unionByName(lifted(odd[-1], j))), "trie-block-sums")
    # Downwards: a cut's whole total is its block and the totals at the block's end.
    total = block
    for j in reversed(range(levels)):
        here = _sums(odd[j].unionByName(lifted(total.where("d > 0"), j)))
        total = total.unionByName(materialize(here, "trie-totals"))
    return total.drop("d")


def _end_digests(ends: DataFrame) -> DataFrame:
    """``name``, ``ends_sha256``: the digest of the ascending ids, comma-joined, of the conversations that end there.

    Sorted ids are first joined into pieces where they lie, in as many tasks as there are
    ranges; the pieces of one node are then hashed in order, one piece held at a time.
    """
    spark = ends.sparkSession

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, out = None, [], []

        def record():
            rows = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.int64()),
                                               pa.array(rows[2], pa.string())], ["name", "first", "ids"])

        for batch in batches:
            for n, c in zip(batch.column("name").to_pylist(), batch.column("conv").to_pylist()):
                if n != name or len(held) == CHUNK_IDS:
                    if held:
                        out.append((name, held[0], ",".join(map(str, held))))
                    name, held = n, []
                held.append(c)
                if len(out) >= 1024:
                    yield record()
                    out.clear()
        if held:
            out.append((name, held[0], ",".join(map(str, held))))
        if out:
            yield record()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state, out = None, None, []

        def record():
            return pa.RecordBatch.from_pydict({"name": pa.array([n for n, _ in out], pa.binary()),
                                               "ends_sha256": pa.array([h for _, h in out], pa.string())})

        for batch in batches:
            for n, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
                if n != name:
                    if state is not None:
                        out.append((name, state.hexdigest()))
                    name, state = n, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if len(out) >= 4096:
                yield record()
                out.clear()
        if state is not None:
            out.append((name, state.hexdigest()))
        yield record()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = (ends.repartitionByRange(n, "name", "conv").sortWithinPartitions("name", "conv")
           .mapInArrow(pieces, "name binary, first bigint, ids string"))
    return (cut.repartition("name").sortWithinPartitions("name", "first")
            .mapInArrow(hashed, "name binary, ends_sha256 string"))


def trie(steps: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node of the trie of ``steps`` (conv, depth from 1, key, bytes) and ``members`` (conv, length).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (over the subtree, (n_convs - 1) times the last turn's
    bytes) and ``ends_sha256``.
    """
    longest = members.agg(F.max("length")).first()[0] or 0
    levels = max(longest - 1, 0).bit_length()
    names = _names(_blocks(steps, levels), members)
    nodes = materialize(names.groupBy("name", "d").agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n"),
                                                       F.max("bytes").alias("bytes")), "trie-nodes")
    links = materialize(_links(nodes, names, levels), "trie-links")
    direct = links.where("j = 0")
    children = materialize(direct.groupBy(F.col("up").alias("name")).agg(F.count(F.lit(1)).alias("children")), "trie-children")
    nodes = materialize(nodes.join(children, "name", "left").select(
        "name", "d", "rep", "n", F.coalesce("children", F.lit(0)).alias("children"),
        F.when(F.col("children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("bytes")).alias("saved")), "trie-nodes")
    below = _graft(nodes.where("leaves > 0 or saved > 0").select("name", "d", "leaves", "saved"), links, levels)
    # written first, so that a node with very many children is split between tasks
    parents = materialize(direct.select("name", "up").join(nodes.select(F.col("name").alias("up"), F.col("rep").alias("parent")),
                                                           "up").select("name", "parent"), "trie-parents")
    ends = names.join(members.select("conv", F.col("length").alias("d")), ["conv", "d"]).select("name", "conv")
    none = hashlib.sha256(b"").hexdigest()
    below = below.select("name", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    return (nodes.join(below, "name", "left").join(parents, "name", "left").join(_end_digests(ends), "name", "left")
            .select(F.col("rep").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"),
                    F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                    (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                    (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))


def prefix_trie(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """The trie of a table of turns; see ``trie`` for the columns."""
    return trie(*place_turns(rows, conv, turn, role, text))

"""Connected components of a link table, as joins and aggregates over written tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stintwise.session import materialize

HELD_LINKS = 500_000


def _contracted(links: DataFrame, held: int = HELD_LINKS) -> DataFrame:
    """The links of every task as stars: each number and the least one it reaches there.

    About ``held`` links are looked at together; a hub leaves each such batch with one link.
    """

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, n = [], [], 0

        def out() -> pa.RecordBatch:
            ids, at = np.unique(np.concatenate([*a, *b]), return_inverse=True)
            x, y = np.split(at, 2)
            root = np.arange(len(ids))
            while True:
                # hook every root to the least root it is linked with, then shorten all paths
                least = root.copy()
                rx, ry = root[x], root[y]
                np.minimum.at(least, rx, ry)
                np.minimum.at(least, ry, rx)
                while True:
                    up = least[least]
                    if (up == least).all():
                        break
                    least = up
                new = least[root]
                if (new == root).all():
                    break
                root = new
            tied = root != np.arange(len(ids))
            return pa.RecordBatch.from_pydict({"a": pa.array(ids[tied]), "b": pa.array(ids[root[tied]])})

        for batch in batches:
            if not batch.num_rows:
                continue
            a.append(batch.column("a").to_numpy())
            b.append(batch.column("b").to_numpy())
            n += batch.num_rows
            if n >= held:
                yield out()
                a, b, n = [], [], 0
        if n:
            yield out()

    return links.select("a", "b").mapInArrow(contract, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """``a`` and ``b``: every linked number except a component's least, and that least number.

    ``links`` has two bigint columns ``a`` and ``b``.  Links are first made into stars within
    each task.  Then, in rounds, every number keeps the least partner it has (its parent,
    a minimum that is combined before the exchange), its other partners are linked to that
    parent, and parents give way to their own parents.  A path shrinks by half in a
    round, so rounds grow with the logarithm of the longest one; the round that finds no
    second partner and no grandparent is the last.  A hub that is a parent is one
    key of the grandparent join, with both sides read from written tables, so Spark can
    split it; a hub with many smaller partners has one link left per batch of a task.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = materialize(_contracted(links), "links")
    while True:
        parent = materialize(now.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("top")), "link-parents")
        # a number with one partner only, its parent, needs no second look
        several = parent.where("top > m").select("a", "m")
        others = now.join(several, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        up = parent.select(F.col("a").alias("m"), F.col("m").alias("mm"))
        lifted = parent.select("a", "m").join(up, "m", "left").select(
            "a", F.coalesce("mm", "m").alias("b"), F.col("mm").isNotNull().alias("moved"))
        seen = Observation()
        rows = (lifted.unionByName(others.select("a", "b", F.lit(True).alias("moved")))
                .observe(seen, F.count_if("moved").alias("moved")))
        now = materialize(rows.select("a", "b"), "links")
        if not seen.get["moved"]:
            return now

"""Nested-data normalisation: parent/child split of entity documents.

* ``with_dense_id``  NRM-3  running id from 0 in a defined order, two passes
  (range partition + checkpoint, then per-partition offsets) instead of a
  window without partitioning, which would put every row in one task.
* ``explode_child``  NRM-1/2  list column -> child table (parent key, item).
* ``chain_edges``    NRM-4  ordered list -> edges to the predecessor, computed
  inside the row with array functions (no shuffle, no window).
* ``dedupe_chains``  NRM-5  one copy of each chain shared by several owners.
* ``flatten_entries`` NRM-6..9  two optional nesting levels of season entries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintwise.functions.columns import flag_or_false, took_part
from stintwise.session import reliable_checkpoint

_LOCAL_BITS = 33  # monotonically_increasing_id = (partition id << 33) + row index


def with_dense_id(df: DataFrame, order: Sequence[str | Column], id_col: str = "id",
                  num_partitions: int | None = None) -> DataFrame:
    """NRM-3: add ``id_col`` = 0, 1, 2 ... following ``order``, ties by the other columns.

    Only rows that are equal in every column that can be sorted are interchangeable, so
    the ids do not depend on how the input is laid out.

    Rows are range-partitioned and sorted on ``order`` and checkpointed to the
    shared checkpoint folder, which fixes both partition contents and order
    (a recomputation after a lost executor sees the same rows).  The row
    counts per partition (one row per partition) give the offsets, which are
    broadcast: their size is the partition count, not the data size.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*order, *[F.col(f"`{f.name}`") for f in df.schema.fields
                       if f.name not in order and _sortable(f.dataType)]]
    ordered = reliable_checkpoint(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    return _number(ordered, id_col).drop("_pid", "_off", "_n")


def _sortable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_sortable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _sortable(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType))


def _number(ordered: DataFrame, id_col: str) -> DataFrame:
    """Row numbers of a checkpointed, ordered frame, with each partition's first number and size."""
    pid = F.spark_partition_id()
    tagged = (ordered.withColumn("_pid", pid)
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(pid.cast("long"), _LOCAL_BITS)))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", "_n",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid", "inner")
            .withColumn(id_col, F.col("_off") + F.col("_local"))
            .drop("_local"))


def numbered_batches(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """``(batch, rows)``: consecutive slices of ``size`` rows in ``order``, ties by the other columns.

    The rows of a sorted partition already lie in order, so every batch that lies within one
    partition is cut there (Arrow slices, at most one unfinished batch held); only the rows of
    batches that cross a border, under ``2 * size`` per partition, are shuffled.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*order, *[f.name for f in df.schema.fields if f.name not in order and _sortable(f.dataType)]]
    keys = [F.col(f"`{c}`") for c in order]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    ordered = reliable_checkpoint(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select(row))
    numbered = _number(ordered, "_id").withColumn("batch", F.expr(f"_id div {int(size)}"))
    first, end = F.col("_off"), F.col("_off") + F.col("_n")
    crosses = (F.col("batch") * size < first) | ((F.col("batch") + 1) * size > end)
    item = numbered.schema["_row"].dataType
    out = T.StructType([T.StructField("batch", T.LongType()), T.StructField("rows", T.ArrayType(item))])
    within = numbered.where(~crosses).select("batch", "_row").mapInArrow(_cutter(), out)
    across = (numbered.where(crosses).groupBy("batch")
              .agg(F.sort_array(F.collect_list(F.struct("_id", "_row"))).alias("_rows"))
              .select("batch", F.transform("_rows", lambda r: r["_row"]).alias("rows")))
    return within.unionByName(across)


def _cutter():
    """The function that cuts sorted rows into batches; nested, so workers get it by value."""

    def cut(batches):
        """Runs of equal ``batch`` as one row each; a run may go on in the next Arrow batch."""
        import numpy as np
        import pyarrow as pa

        def lists(ids, rows, last):
            """The runs that end in ``ids`` (all if ``last``) and the first row of the unfinished one."""
            starts = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))
            edges = [*starts.tolist(), len(ids)] if last else starts.tolist()
            if len(edges) < 2:
                return None, 0
            values = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rows)
            return pa.RecordBatch.from_arrays([pa.array(ids[edges[:-1]]), values], ["batch", "rows"]), edges[-1]

        held_ids, held_rows = np.zeros(0, np.int64), None
        for b in batches:
            if b.num_rows == 0:
                continue
            ids = np.concatenate([held_ids, b.column(0).to_numpy()])
            rows = b.column(1) if held_rows is None else pa.concat_arrays([held_rows, b.column(1)])
            made, at = lists(ids, rows, False)
            if made is not None:
                yield made
            held_ids, held_rows = ids[at:], rows.slice(at)
        if len(held_ids):
            yield lists(held_ids, held_rows, True)[0]

    return cut


def explode_child(df: DataFrame, parent_key: str, list_col: str, out_parent: str,
                  item: str | None = None, fields: dict[str, str] | None = None,
                  id_col: str = "id") -> DataFrame:
    """NRM-1 / NRM-2: child table ``(id, out_parent, item...)`` of a list column.

    A null, empty or non-list value yields no rows.  ``item`` names the output
    column of a list of scalars; ``fields`` maps output names to struct fields
    of a list of structs (a missing field gives null).  Ids run from 0 in
    (parent key, list position) order.
    """
    exploded = df.select(F.col(parent_key).alias(out_parent),
                         F.posexplode(list_col).alias("_pos", "_item"))
    if fields:
        cols = [F.col("_item").getField(src).alias(dst) for dst, src in fields.items()]
    else:
        cols = [F.col("_item").alias(item or "item")]
    child = exploded.select(out_parent, "_pos", *cols)
    return (with_dense_id(child, [out_parent, "_pos"], id_col)
            .select(id_col, out_parent, *[c for c in child.columns if c not in (out_parent, "_pos")]))


def chain_edges(df: DataFrame, chain_col: str, id_field: str, extra: Sequence[str] = (),
                from_col: str = "idFrom", to_col: str = "idTo",
                keep: Sequence[str] = ()) -> DataFrame:
    """NRM-4: each element of an ordered list becomes (predecessor id, own id, extra...).

    The first element's predecessor is null.  Works inside the row.
    """
    chain = F.col(chain_col)

    def edge(x: Column, i: Column) -> Column:
        prev = F.when(i > 0, F.element_at(chain, i.cast("int")).getField(id_field))
        return F.struct(prev.alias(from_col), x.getField(id_field).alias(to_col),
                        *[x.getField(e).alias(e) for e in extra], i.cast("bigint").alias("_pos"))

    return (df.select(*keep, F.explode(F.transform(chain, edge)).alias("_e"))
            .select(*keep, "_e.*"))


def dedupe_chains(df: DataFrame, owner: str, chain_col: str, chain_id: str = "chain_id") -> DataFrame:
    """NRM-5: one row per distinct chain, identified by its smallest owner.

    Owners of one lineage repeat the same list; grouping on the list keeps it
    once, independent of file listing order.  A hot chain is combined map-side
    (``min`` is partial), so owners of a third of all rows do not meet in one task.
    """
    return (df.filter(F.col(chain_col).isNotNull())
            .groupBy(chain_col).agg(F.min(owner).alias(chain_id))
            .select(chain_id, chain_col))


def rebranding_history(df: DataFrame, owner: str, chain_col: str) -> DataFrame:
    """Q-13: predecessor edges of every distinct chronology, each shared one once."""
    return (chain_edges(dedupe_chains(df, owner, chain_col), chain_col, "constructorId", ["yearFrom", "yearTo"],
                        from_col="constructorIdFrom", to_col="constructorIdTo")
            .select("constructorIdFrom", "constructorIdTo", "yearFrom", "yearTo"))


def flatten_entries(entries: DataFrame, entry_col: str = "entry", year_col: str = "year",
                    order_cols: Sequence[str] = ()) -> DataFrame:
    """NRM-6..9: season entries -> ``(year, entrantId, constructorId, driverId, tookPart, testDriver)``.

    Level 1: an inline ``constructorId`` or a list ``constructors``; level 2: an
    inline ``driverId`` or a list ``drivers``.  The inline form wins when both
    are given (as the reference tests the inline key first).  An empty list
    yields no rows.  ``tookPart`` is ``rounds is not null``; an absent
    ``testDriver`` is false.  With ``order_cols`` (the place of an entry) these and the
    positions on both levels, ``_c_pos`` and ``_d_pos``, are kept.
    """
    e = F.col(entry_col)
    inline_c = F.array(F.struct(e.constructorId.alias("constructorId"), e.driverId.alias("driverId"),
                                e.rounds.alias("rounds"), e.testDriver.alias("testDriver"),
                                e.drivers.alias("drivers")))
    level1 = F.when(e.constructorId.isNotNull() | e.constructors.isNull(), inline_c) \
        .otherwise(e.constructors)
    c_rows = entries.select(F.col(year_col).alias("year"), e.entrantId.alias("entrantId"),
                            *order_cols, F.posexplode(level1).alias("_c_pos", "_c"))
    c = F.col("_c")
    inline_d = F.array(F.struct(c.driverId.alias("driverId"), c.rounds.alias("rounds"),
                                c.testDriver.alias("testDriver")))
    level2 = F.when(c.driverId.isNotNull() | c.drivers.isNull(), inline_d).otherwise(c.drivers)
    d_rows = c_rows.select("year", "entrantId", c.constructorId.alias("constructorId"), *order_cols, "_c_pos",
                           F.posexplode(level2).alias("_d_pos", "_d"))
    places = [*order_cols, "_c_pos", "_d_pos"] if order_cols else []
    return d_rows.select("year", "entrantId", "constructorId",
                         F.col("_d.driverId").alias("driverId"),
                         took_part(F.col("_d.rounds")).alias("tookPart"),
                         flag_or_false(F.col("_d.testDriver")).alias("testDriver"), *places)

"""Property-graph preparation: node and edge tables of drivers and teams.

Nodes ``(label, name)``; edges ``(src_label, src, type, dst_label, dst, year)``.
MERGE semantics (create only what is missing) become ``dropDuplicates`` and,
against an existing graph, an anti-join plus union.  A graph database refuses
to MERGE on a null key, so rows with a null name or year make no node/edge.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stintwise.operators.careers import break_ends, transfer_ends
from stintwise.operators.normalise import numbered_batches

# Node labels and relationship types of the reference's graph.
DRIVER, TEAM = "Driver", "Team"
DEBUT, TRANSFER_OUT, TRANSFER_IN, BREAK, RETURN = (
    "DEBUT", "TRANSFER_OUT", "TRANSFER_IN", "BREAK", "RETURN")

EDGE_COLUMNS = ["src_label", "src", "type", "dst_label", "dst", "year"]
NODE_COLUMNS = ["label", "name"]


def _edge(src_label, src, etype, dst_label, dst, year):
    return F.struct(F.lit(src_label).alias("src_label"), F.col(src).alias("src"),
                    F.lit(etype).alias("type"), F.lit(dst_label).alias("dst_label"),
                    F.col(dst).alias("dst"), F.col(year).cast("int").alias("year"))


def _finish(edges: DataFrame) -> DataFrame:
    return (edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull()
                         & F.col("year").isNotNull())
            .dropDuplicates(EDGE_COLUMNS))


def _debut_rows(debuts: DataFrame) -> DataFrame:
    e = _edge(DRIVER, "driverId", DEBUT, TEAM, "constructorId", "debut_year")
    return debuts.select(e.alias("e")).select("e.*")


def _transfer_rows(transfers: DataFrame) -> DataFrame:
    pair = F.array(_edge(TEAM, "const_out", TRANSFER_OUT, DRIVER, "driverId", "transfer_out"),
                   _edge(DRIVER, "driverId", TRANSFER_IN, TEAM, "const_in", "transfer_in"))
    return transfers.select(F.explode(pair).alias("e")).select("e.*")


def _break_rows(breaks: DataFrame) -> DataFrame:
    pair = F.array(_edge(TEAM, "const_out", BREAK, DRIVER, "driverId", "break_year"),
                   _edge(DRIVER, "driverId", RETURN, TEAM, "const_in", "return_year"))
    return breaks.select(F.explode(pair).alias("e")).select("e.*")


def _transfer_end_rows(s: DataFrame) -> DataFrame:
    out, inn = transfer_ends(s)
    return (out.select(_edge(TEAM, "const_out", TRANSFER_OUT, DRIVER, "driverId", "transfer_out").alias("e"))
            .unionByName(inn.select(_edge(DRIVER, "driverId", TRANSFER_IN, TEAM, "const_in", "transfer_in").alias("e")))
            .select("e.*"))


def _break_end_rows(s: DataFrame) -> DataFrame:
    ends, returns = break_ends(s, midseason=True)
    return (ends.select(_edge(TEAM, "const_out", BREAK, DRIVER, "driverId", "break_year").alias("e"))
            .unionByName(returns.select(_edge(DRIVER, "driverId", RETURN, TEAM, "const_in", "return_year").alias("e")))
            .select("e.*"))


def span_edges_transfer(s: DataFrame) -> DataFrame:
    """GR-3 from spans: the edges of ``edges_transfer`` over Q-7, by semi-joins."""
    return _finish(_transfer_end_rows(s))


def span_edges_break(s: DataFrame) -> DataFrame:
    """GR-4 from spans: the edges of ``edges_break`` over Q-11, by semi-joins."""
    return _finish(_break_end_rows(s))


def _year_flags(s: DataFrame) -> DataFrame:
    """Per driver a map from year to what the edges of a span that starts or ends in it depend on.

    Whether a span has a partner of another constructor follows from the least and the
    greatest constructor that start or end near its years, so the spans meet in one
    aggregate per (driver, year) and one window per driver over distinct years.

    ``in_low``, ``in_high``: constructors of the spans that start this year or the next.
    ``out_low``, ``out_high``: of those that end this year or the one before.
    ``breaks``: spans that end this year are the start of a break; ``returns``: those that
    start this year and are no arrival of a transfer are the end of one.
    """
    c, lone = F.col("constructorId"), F.col("first_year") == F.col("last_year")
    none = F.lit(None).cast("string")
    ends = F.array(F.struct(F.col("first_year").alias("y"), c.alias("i"), none.alias("o"), F.lit(False).alias("end"),
                            F.when(lone, c).alias("one")),
                   F.struct(F.col("last_year").alias("y"), none.alias("i"), c.alias("o"), F.lit(True).alias("end"),
                            none.alias("one")))
    years = (s.select("driverId", F.explode(ends).alias("e")).select("driverId", "e.*")
             .where(F.col("y").isNotNull()).groupBy("driverId", "y")
             .agg(F.min("i").alias("i_low"), F.max("i").alias("i_high"), F.min("o").alias("o_low"),
                  F.max("o").alias("o_high"), F.max("end").alias("end"), F.max("one").alias("one")))
    w = Window.partitionBy("driverId").orderBy("y")
    last, now, soon = w.rangeBetween(-1, 0), w.rangeBetween(0, 1), w.rangeBetween
    end_year = F.when(F.col("end"), F.col("y"))
    years = years.select(
        "*", F.min("i_low").over(now).alias("in_low"), F.max("i_high").over(now).alias("in_high"),
        F.min("o_low").over(last).alias("out_low"), F.max("o_high").over(last).alias("out_high"),
        F.max(F.when(F.col("end"), F.struct(F.col("y"), F.col("o_low").isNotNull().alias("named")))).over(
            soon(Window.unboundedPreceding, -2)).alias("nearest"),
        F.min(end_year).over(soon(1, Window.unboundedFollowing)).alias("next_end"))
    # A start is no arrival if no other constructor's span ends near it; where one constructor ends, that
    # is so for its own span alone, which then starts and ends this year.
    unexplained = F.col("i_low").isNotNull() & (
        F.col("out_low").isNull() | ((F.col("out_low") == F.col("out_high")) & F.col("one").isNotNull()))
    years = years.withColumn("free", F.when(unexplained, F.col("y")))
    years = years.select("*", F.max("free").over(soon(Window.unboundedPreceding, -1)).alias("free_before"),
                         F.min("free").over(soon(2, Window.unboundedFollowing)).alias("free_after"))
    # A year's breaks return in the first such start whose latest end two years before or earlier is that year.
    flags = F.struct(
        "in_low", "in_high", "out_low", "out_high",
        F.coalesce(F.col("end") & (F.col("free_after") <= F.coalesce(F.col("next_end") + 1, F.col("free_after"))),
                   F.lit(False)).alias("breaks"),
        F.coalesce(F.col("free").isNotNull() & F.col("nearest.named")
                   & (F.coalesce(F.col("free_before") <= F.col("nearest.y") + 1, F.lit(True))),
                   F.lit(False)).alias("returns"))
    return years.groupBy("driverId").agg(F.map_from_entries(F.collect_list(F.struct("y", flags))).alias("years"))


def _span_end_rows(s: DataFrame) -> DataFrame:
    """The transfer and break edges of spans; a span is one row per (driver, constructor), so no edge comes twice."""
    c = F.col("constructorId")
    # One shuffle for both sides and every aggregate; a driver has at most one span for each constructor.
    s = s.where(F.col("driverId").isNotNull()).repartition("driverId")
    rows = s.join(_year_flags(s), "driverId")
    rows = rows.select("driverId", "constructorId", "first_year", "last_year",
                       F.element_at("years", F.col("first_year")).alias("f"),
                       F.element_at("years", F.col("last_year")).alias("l"))
    out = F.coalesce((F.col("l.in_low") != c) | (F.col("l.in_high") != c), F.lit(False))
    arrival = F.coalesce((F.col("f.out_low") != c) | (F.col("f.out_high") != c), F.lit(False))
    found = F.array(
        F.when(out, _edge(TEAM, "constructorId", TRANSFER_OUT, DRIVER, "driverId", "last_year")),
        F.when(arrival, _edge(DRIVER, "driverId", TRANSFER_IN, TEAM, "constructorId", "first_year")),
        F.when(F.col("l.breaks") & c.isNotNull(), _edge(TEAM, "constructorId", BREAK, DRIVER, "driverId", "last_year")),
        F.when(~arrival & F.col("f.returns") & c.isNotNull(), _edge(DRIVER, "driverId", RETURN, TEAM, "constructorId", "first_year")))
    return rows.select(F.explode(F.array_compact(found)).alias("e")).select("e.*")


def span_graph_edges(debuts: DataFrame, s: DataFrame) -> DataFrame:
    """GR-5 from spans: all edges without forming transfer or break pairs.

    ``s`` has one row per (driver, constructor).  Edges of different types differ and a span
    has at most one of each type, so only the debuts are deduplicated, before their labels are added.
    """
    key = ["driverId", "constructorId", "debut_year"]
    first = debuts.select(*key).dropna(subset=key).dropDuplicates(key)
    return _debut_rows(first).unionByName(_span_end_rows(s))


def edges_debut(debuts: DataFrame) -> DataFrame:
    """GR-2: (Driver)-[DEBUT {year}]->(Team)."""
    return _finish(_debut_rows(debuts))


def edges_transfer(transfers: DataFrame) -> DataFrame:
    """GR-3: (Team)-[TRANSFER_OUT]->(Driver) and (Driver)-[TRANSFER_IN]->(Team) per row."""
    return _finish(_transfer_rows(transfers))


def edges_break(breaks: DataFrame) -> DataFrame:
    """GR-4: (Team)-[BREAK]->(Driver) and (Driver)-[RETURN]->(Team) per row."""
    return _finish(_break_rows(breaks))


def graph_edges(debuts: DataFrame, transfers: DataFrame, breaks: DataFrame) -> DataFrame:
    """GR-5: all edges, each (src, type, year, dst) once: one dedupe over the union."""
    return _finish(_debut_rows(debuts).unionByName(_transfer_rows(transfers))
                   .unionByName(_break_rows(breaks)))


def graph_nodes(edges: DataFrame) -> DataFrame:
    """GR-1: every endpoint of an edge as a node, once per (label, name)."""
    ends = F.explode(F.array(F.struct(F.col("src_label").alias("label"), F.col("src").alias("name")),
                             F.struct(F.col("dst_label").alias("label"), F.col("dst").alias("name"))))
    return edges.select(ends.alias("n")).select("n.*").dropDuplicates(NODE_COLUMNS)


def merge_graph(existing: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """GR-6: MERGE ``new`` into ``existing``: keep existing, add only absent rows."""
    return existing.unionByName(merge_added(existing, new, keys))


def merge_added(existing: DataFrame, new: DataFrame, keys: list[str] | None = None, unique: bool = False) -> DataFrame:
    """The rows that a merge adds, for a sink that appends; null keys equal each other.

    With ``unique`` no key comes twice in ``new``, so it is not deduplicated once more.
    """
    keys = keys or list(existing.columns)
    n, e = (new if unique else new.dropDuplicates(keys)).alias("n"), existing.select(*keys).alias("e")
    same = [F.col(f"n.`{k}`").eqNullSafe(F.col(f"e.`{k}`")) for k in keys]
    return n.join(e, reduce(and_, same), "left_anti")


def edge_batches(df: DataFrame, order: list[str], size: int = 500) -> DataFrame:
    """GR-7: consecutive slices of ``size`` rows of any relation, one row per batch ``(batch, rows)``.

    Rows are sorted and numbered once; batches are cut where the rows lie, and only
    those that cross a partition border are shuffled.
    """
    return numbered_batches(df, order, size)


def send_batches(batches: DataFrame, open_sink) -> None:
    """GR-7 sink side: hand every batch of ``edge_batches`` to a client, from the executors.

    ``open_sink()`` runs once per partition and returns ``send(batch, rows)``
    (rows as a list of dicts) and optionally a ``close`` attribute - one
    connection per task, never one per row and never through the driver.
    """
    def run(partition):
        send = open_sink()
        try:
            for r in partition:
                send(r["batch"], [row.asDict() for row in r["rows"]])
        finally:
            close = getattr(send, "close", None)
            if close is not None:
                close()

    batches.foreachPartition(run)


def import_tables(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node and relationship tables in the header-typed layout graph bulk importers read.

    Node ids are ``label:name``, so a driver and a team of the same name stay
    distinct; the MERGE semantics are already applied (both tables deduplicated).
    """
    node_id = F.concat_ws(":", F.col("label"), F.col("name"))
    n = nodes.select(node_id.alias("id:ID"), F.col("name"), F.col("label").alias(":LABEL"))
    e = edges.select(F.concat_ws(":", "src_label", "src").alias(":START_ID"),
                     F.concat_ws(":", "dst_label", "dst").alias(":END_ID"),
                     F.col("type").alias(":TYPE"), F.col("year").alias("year:int"))
    return n, e


__all__ = ["graph_nodes", "graph_edges", "edges_debut", "edges_transfer", "edges_break",
           "span_edges_transfer", "span_edges_break", "span_graph_edges",
           "merge_graph", "merge_added", "edge_batches", "send_batches", "import_tables"]

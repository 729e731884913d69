"""Nested documents built from the flat test tables, so that the flat table
is the oracle of each normalisation operator.  Every nesting groups by a key
whose group is one natural document (a part, a conversation, an order), so no
group grows with the table.

* part documents: ``names = split(p_name, ' ')``, a null list when ``p_size < 10``.
* conversation documents: ``turns = [struct(turn, role, text)]`` per ``conv_id``.
* order chains: the first and last line of an order each own the order's chain
  of lines (``constructorId = l_suppkey``, ``yearFrom = year(l_shipdate)``,
  ``yearTo`` null for open lines) - the shape of a constructor's rebranding
  chronology.
* season entries: one entry per order, ``entrantId = o_custkey``; its lines are
  grouped by ``constructorId = s_nationkey`` with ``driverId = l_partkey``;
  inline when a level has one child, a list otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stintwise.sources.bindings import table
from stintwise.sources.documents import yaml_number, yaml_quote


def part_documents(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return p.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice",
                    F.when(F.col("p_size") >= 10, F.split("p_name", " ")).alias("names"))


def part_key_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Part rows as map documents: ``p_type`` absent for brands 1x, ``p_size`` when < 25."""
    p = table(spark, sf, "part")
    rec = F.struct(F.col("p_partkey"), F.col("p_name"), F.col("p_brand"),
                   F.when(~F.col("p_brand").like("Brand#1%"), F.col("p_type")).alias("p_type"),
                   F.when(F.col("p_size") >= 25, F.col("p_size")).alias("p_size"),
                   F.col("p_retailprice"))
    return p.select(F.col("p_partkey").alias("_doc"),
                    F.from_json(F.to_json(rec), "map<string,string>").alias("doc"))


def conversation_documents(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    return c.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def order_chains(spark: SparkSession, sf: str) -> DataFrame:
    """``(owner, chain)``: the first and the last line of each order own its chain.

    owner = orderkey * 10 + linenumber.  Two owners per chain exercise the
    dedupe (as do identical chains of different orders) while the copies grow
    linearly; both owners come from the aggregate that builds the chain, so
    no join back to the lines is needed.
    """
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey",
                                             "l_shipdate", "l_linestatus")
    y = F.year("l_shipdate").cast("int")
    item = F.struct(F.col("l_linenumber"), F.col("l_suppkey").cast("string").alias("constructorId"),
                    y.alias("yearFrom"),
                    F.when(F.col("l_linestatus") != F.lit("O"), y).alias("yearTo"))
    chains = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(item)).alias("_items"),
                                          F.min("l_linenumber").alias("_first"),
                                          F.max("l_linenumber").alias("_last"))
    key = F.col("l_orderkey") * 10
    return chains.select(
        F.explode(F.array_distinct(F.array(key + F.col("_first"), key + F.col("_last")))).alias("owner"),
        F.transform("_items", lambda x: x.dropFields("l_linenumber")).alias("chain"))


def season_entries(spark: SparkSession, sf: str) -> DataFrame:
    """``(year, entry)`` with ``entry`` shaped like ``schemas.SEASON_ENTRY``.

    Lines are hash-partitioned once by order; both nesting levels are
    ``collect_list`` aggregates over that partitioning (drivers per
    constructor, then constructors per order), so the work is linear in the
    lines and there is one shuffle.  ``orders`` is joined per order, not per line.
    """
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                             "l_returnflag", "l_linestatus")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = li.join(s, li.l_suppkey == s.s_suppkey).select(
        "l_orderkey", F.col("s_nationkey").cast("string").alias("constructorId"),
        F.struct(F.col("l_linenumber"), F.col("l_partkey").cast("string").alias("driverId"),
                 F.nullif(F.col("l_returnflag"), F.lit("R")).alias("rounds"),
                 F.when(F.col("l_linestatus") == F.lit("O"), F.lit(True)).alias("testDriver"))
        .alias("line"))
    per_constructor = (lines.repartition("l_orderkey")
                       .groupBy("l_orderkey", "constructorId")
                       .agg(F.sort_array(F.collect_list("line")).alias("_ds")))
    ds = F.transform("_ds", lambda x: x.dropFields("l_linenumber"))
    one = F.size("_ds") == 1
    constructor = F.struct(F.col("constructorId"),
                           F.when(one, ds[0].driverId).alias("driverId"),
                           F.when(one, ds[0].rounds).alias("rounds"),
                           F.when(one, ds[0].testDriver).alias("testDriver"),
                           F.when(~one, ds).alias("drivers"))
    per_order = (per_constructor.groupBy("l_orderkey")
                 .agg(F.sort_array(F.collect_list(constructor)).alias("_cons")))
    docs = per_order.join(o, per_order.l_orderkey == o.o_orderkey).select(
        F.year("o_orderdate").cast("int").alias("year"),
        F.col("o_custkey").cast("string").alias("entrantId"), "_cons")
    c = F.col("_cons")
    one_c = F.size(c) == 1
    entry = F.struct(F.col("entrantId"),
                     F.when(one_c, c[0].constructorId).alias("constructorId"),
                     F.when(one_c, c[0].driverId).alias("driverId"),
                     F.when(one_c, c[0].rounds).alias("rounds"),
                     F.when(one_c, c[0].testDriver).alias("testDriver"),
                     F.when(one_c, c[0].drivers).alias("drivers"),
                     F.when(~one_c, c).alias("constructors"))
    return docs.select("year", entry.alias("entry"))


def _kv(indent: str, key: str, value: Column) -> Column:
    return F.concat(F.lit(f"{indent}{key}: "), value)


def _driver_yaml(d: Column, indent: str, first: str) -> Column:
    """Driver fields; ``first`` is the prefix of the first line (``- `` for a list item)."""
    parts = [_kv(first, "driverId", yaml_quote(d.driverId)), _kv(indent, "rounds", yaml_quote(d.rounds))]
    test = F.when(d.testDriver.isNotNull(),
                  _kv(indent, "testDriver", F.when(d.testDriver, "true").otherwise("false")))
    return F.concat_ws("\n", *parts, test)


def _level_yaml(x: Column, indent: str, first: str) -> Column:
    """Inline driver fields or a ``drivers`` list under one constructor-level node."""
    inline = _driver_yaml(x, indent, first)
    listed = F.concat_ws("\n", F.lit(f"{first}drivers:"), F.array_join(
        F.transform(x.drivers, lambda d: _driver_yaml(d, indent + "  ", indent + "- ")), "\n"))
    return F.when(x.drivers.isNull(), inline).otherwise(listed)


def season_yaml(entries: DataFrame) -> DataFrame:
    """``(year, yaml)``: each entry as one YAML list item; a file of them is a season document."""
    e = F.col("entry")
    inline_c = F.concat_ws("\n", _kv("  ", "constructorId", yaml_quote(e.constructorId)),
                           _level_yaml(e, "  ", "  "))

    def cons_item(c: Column) -> Column:
        return F.concat_ws("\n", _kv("  - ", "constructorId", yaml_quote(c.constructorId)),
                           _level_yaml(c, "    ", "    "))

    listed_c = F.concat_ws("\n", F.lit("  constructors:"),
                           F.array_join(F.transform(e.constructors, cons_item), "\n"))
    body = F.when(e.constructors.isNull(), inline_c).otherwise(listed_c)
    return entries.select("year", F.concat_ws("\n", _kv("- ", "entrantId", yaml_quote(e.entrantId)),
                                              body).alias("yaml"))


def supplier_yaml(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    return s.select(F.concat_ws("\n", F.lit("---"),
                                _kv("", "s_suppkey", yaml_number(F.col("s_suppkey"))),
                                _kv("", "s_name", yaml_quote(F.col("s_name"))),
                                _kv("", "s_nationkey", yaml_number(F.col("s_nationkey"))),
                                _kv("", "s_acctbal", yaml_number(F.col("s_acctbal")))).alias("yaml"))


SEASON_FLAT_SQL = """
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year,
       CAST(o.o_custkey AS VARCHAR) AS entrantId,
       CAST(s.s_nationkey AS VARCHAR) AS constructorId,
       CAST(l.l_partkey AS VARCHAR) AS driverId,
       NULLIF(l.l_returnflag, 'R') IS NOT NULL AS tookPart,
       COALESCE(l.l_linestatus = 'O', FALSE) AS testDriver
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""

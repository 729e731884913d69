"""Bindings from the driver's test tables to this library's data model.

The model needs one fact table (who entered for which group in which period,
and whether they took part).  On the TPC-H-style test tables it is:

    year          = year(o_orderdate)
    entrantId     = l_suppkey
    constructorId = s_nationkey
    driverId      = o_custkey
    rounds        = nullif(l_returnflag, 'R')     -> tookPart = rounds is not null
    testDriver    = l_linestatus = 'O'

Only the needed columns are read, so the parquet scans are pruned; the two
joins are equi-joins on unique keys of ``orders`` / ``supplier`` (skew is at
most the lines of one order).  Spark broadcasts a side only when its measured
size is below ``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides
are shuffled on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintwise.schemas import APPEARANCES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def appearances(spark: SparkSession, sf_dir: str, driver_id: str | None = None) -> DataFrame:
    """The fact table; with ``driver_id`` only that driver's rows, filtered on the raw key in the scan."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_returnflag", "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if driver_id is not None:
        key = o.schema["o_custkey"].dataType
        o = o.filter((F.col("o_custkey") == F.lit(driver_id).try_cast(key))
                     & (F.col("o_custkey").cast("string") == F.lit(driver_id)))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # nullif(l_returnflag, 'R') IS NOT NULL, spelled so the filter reaches the parquet scan.
    took_part = F.col("l_returnflag").isNotNull() & (F.col("l_returnflag") != F.lit("R"))
    df = (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
          .join(s, li.l_suppkey == s.s_suppkey, "inner")
          .select(F.year("o_orderdate").cast("int").alias("year"),
                  F.col("l_suppkey").cast("string").alias("entrantId"),
                  F.col("s_nationkey").cast("string").alias("constructorId"),
                  F.col("o_custkey").cast("string").alias("driverId"),
                  took_part.alias("tookPart"),
                  (F.col("l_linestatus") == F.lit("O")).alias("testDriver")))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in APPEARANCES.fields])


# The same binding as SQL over the pre-registered views (DuckDB oracle).
APPEARANCES_SQL = """
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year,
       CAST(l.l_suppkey AS VARCHAR) AS entrantId,
       CAST(s.s_nationkey AS VARCHAR) AS constructorId,
       CAST(o.o_custkey AS VARCHAR) AS driverId,
       NULLIF(l.l_returnflag, 'R') IS NOT NULL AS tookPart,
       l.l_linestatus = 'O' AS testDriver
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""

"""The appearance fact table stored as parquet, partitioned by year.

Year partitions let ``year < (latest year)`` filters skip files, and the
columnar layout lets every relation read only the columns it uses.  The
table is written to a shared path, so it also cuts the lineage of whatever
produced it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stintwise.schemas import APPEARANCES


def write_fact_table(a: DataFrame, path: str) -> None:
    """Write appearances partitioned by year (one folder per season).

    Rows are rebalanced by year first, so a season has few files however many tasks
    made its rows; AQE splits the share of a large season over several tasks.
    """
    a.select(*APPEARANCES.fieldNames()).hint("rebalance", "year").write.mode("overwrite").partitionBy("year").parquet(path)


def read_fact_table(spark: SparkSession, path: str) -> DataFrame:
    """Read it back with the declared column order and types."""
    return spark.read.schema(APPEARANCES).parquet(path).select(*APPEARANCES.fieldNames())

"""CSV tables: the fact-table scan (SRC-3) and the sinks (SNK-1..3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintwise.schemas import (
    APPEARANCES,
    BREAK_COLUMNS,
    DEBUT_COLUMNS,
    RETIREMENT_COLUMNS,
    TRANSFER_COLUMNS,
)


# Quotes are doubled, line feeds end rows outside quotes only, and white space is kept.
_TEXT_SAFE = {"quote": '"', "escape": '"', "lineSep": "\n",
              "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
MAX_RECORDS_PER_FILE = 1_000_000


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header skipped, declared schema applied by position, malformed cell -> null.

    An empty cell is null, also where an empty text was written.  Quoted cells may
    hold line breaks.  Such files do not split, so ``write_csv``
    bounds the rows of a file.
    """
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("enforceSchema", True).options(**_TEXT_SAFE).option("multiLine", True).csv(path))


# Fixed value: the cell of a null in a splittable file; no text is written like it.
NULL_CELL = "\\N"
# What a splittable file writes for a character, in the order of writing; read back in the other order.
_ESCAPES = [("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r")]


def _each_text(df: DataFrame, change) -> DataFrame:
    return df.select(*[change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def write_split_csv(df: DataFrame, path: str) -> None:
    """A CSV folder whose rows are lines: backslashes and line breaks in texts are escaped, nulls are ``\\N``.

    Any text reads back as it was, empty ones apart from nulls, and files split, so their
    size is not bounded.
    """
    def escaped(c: Column) -> Column:
        for raw, cell in _ESCAPES:
            c = F.replace(c, F.lit(raw), F.lit(cell))
        return c

    (_each_text(df, escaped).write.options(**_TEXT_SAFE).option("nullValue", NULL_CELL)
     .csv(path, header=True, mode="overwrite"))


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """What ``write_split_csv`` wrote; a large file is read by several tasks."""
    def plain(c: Column) -> Column:
        for raw, cell in reversed(_ESCAPES):
            c = F.replace(c, F.lit(cell), F.lit(raw))
        return c

    rows = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", True)
            .options(**_TEXT_SAFE).option("nullValue", NULL_CELL).option("emptyValue", "").csv(path))
    return _each_text(rows, plain)


def read_appearances(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: the appearance fact table (header ``driverID`` and ``driverId`` both fit)."""
    return read_csv(spark, path, APPEARANCES)


def write_csv(df: DataFrame, path: str) -> None:
    """SNK-1/SNK-2: (over)write a CSV folder with a header line."""
    (df.write.options(**_TEXT_SAFE).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .csv(path, header=True, mode="overwrite"))


# Sub-folder names of the career tables.
CAREER_TABLES = {"debuts": DEBUT_COLUMNS, "retirements": RETIREMENT_COLUMNS,
                 "transfers": TRANSFER_COLUMNS, "breaks": BREAK_COLUMNS[:-1]}


def write_career_tables(tables: dict[str, DataFrame], path: str) -> dict[str, str]:
    """SNK-3: the four career tables, each as ``<path>/<name>`` with fixed columns."""
    out = {}
    for name, cols in CAREER_TABLES.items():
        target = f"{path.rstrip('/')}/{name}"
        write_csv(tables[name].select(*cols), target)
        out[name] = target
    return out

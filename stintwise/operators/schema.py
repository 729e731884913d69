"""Schema operators over map documents (``doc: map<string,string>``).

* ``discover_keys``  SCH-1  union of keys in first-seen order.
* ``widest_keys``    SCH-2  key list of the widest document (last wins ties).
* ``project_record`` SCH-3/5  one column per key, in key order; a missing key
  is null or raises.
* ``missing_keys``   SCH-3 report of (document, missing key).
* ``drop_nested``    SCH-4  parent table without its child column.
* ``case_select``    SCH-6  case-insensitive pick, renamed to the requested spelling.

The key list is schema metadata (its size is the number of distinct keys,
not of rows), so ``key_list`` may bring it to the driver to name columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def discover_keys(docs: DataFrame, order: Sequence[str], doc_col: str = "doc") -> DataFrame:
    """SCH-1: ``(key, ordinal)``, ordinal from 0 by first (document, position)."""
    exploded = docs.select(*order, F.posexplode(F.map_keys(doc_col)).alias("_pos", "key"))
    first = exploded.groupBy("key").agg(F.min(F.struct(*order, "_pos")).alias("_first"))
    # One row per distinct key: an unpartitioned window over the schema width only.
    return first.select("key", (F.row_number().over(Window.orderBy("_first")) - 1)
                        .cast("bigint").alias("ordinal"))


def widest_keys(docs: DataFrame, order: Sequence[str], doc_col: str = "doc") -> DataFrame:
    """SCH-2: ``(key, ordinal)`` of the document with most keys; the last one wins ties."""
    keys = F.map_keys(doc_col)
    widest = docs.agg(F.max_by(keys, F.struct(F.size(keys), *order)).alias("_keys"))
    return (widest.select(F.posexplode("_keys").alias("ordinal", "key"))
            .select("key", F.col("ordinal").cast("bigint").alias("ordinal")))


def key_list(keys: DataFrame) -> list[str]:
    """The discovered keys in order (bounded by the number of distinct keys)."""
    return [r["key"] for r in keys.orderBy("ordinal").select("key").collect()]


def project_record(docs: DataFrame, keys: Sequence[str], on_missing: str = "null",
                   doc_col: str = "doc", keep: Sequence[str] = ()) -> DataFrame:
    """SCH-3/SCH-5: one string column per key, in ``keys`` order.

    ``on_missing='error'`` fails the job on a document without a key (the
    reference's strict records); ``'null'`` leaves the cell null.
    """
    doc = F.col(doc_col)
    cols = []
    for k in keys:
        v = F.element_at(doc, F.lit(k)) if on_missing == "null" else F.when(
            F.map_contains_key(doc, F.lit(k)), doc.getItem(k)
        ).otherwise(F.raise_error(F.concat(F.lit(f"document lacks key '{k}': "), F.to_json(doc))))
        cols.append(v.alias(k))
    return docs.select(*keep, *cols)


def missing_keys(docs: DataFrame, keys: Sequence[str], id_col: str, doc_col: str = "doc") -> DataFrame:
    """``(id_col, key)`` for every discovered key a document lacks (row-local)."""
    wanted = F.array(*[F.lit(k) for k in keys])
    return docs.select(id_col, F.explode(F.array_except(wanted, F.map_keys(doc_col))).alias("key"))


def drop_nested(df: DataFrame, nested: str) -> DataFrame:
    """SCH-4: the parent table keeps every column but the nested child list."""
    return df.drop(nested)


def case_select(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """SCH-6: resolve each name case-insensitively and emit it in the spelling asked for."""
    lower = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(lower[n.lower()]).alias(n) for n in names])

"""From raw documents to packed training sequences, in four stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read again as the next stage's ``docs``.  All but the last stage return the
columns of ``documents``.

* quality: a line CRF is fitted on the labelled rows outside the held-out third; documents
  scored under 0.5 go;
* near_dedup: one document of each near-duplicate class stays, that of the least id
  (without any id in the class, that of the least text key);
* decontaminate: documents that hold a benchmark text go;
* pack: the rest is cut into token sequences.

Null and empty texts are scored, deduplicated (equal texts are one class) and packed like
any others; equal rows are one document to near_dedup, classes go by the text and not by the id; empty tables pass
through; further columns stay up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintwise.llm import decontaminate, linecrf, neardup, packing
from stintwise.llm.common import table
from stintwise.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF scores 0.5 or more."""
    model = linecrf.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"),
                          ~linecrf.held_out(F.col("doc_id")))
    return linecrf.score(docs, model).where("score >= 0.5").drop("score")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return neardup.keep_one(docs, neardup.near_duplicates(docs, with_keys=True))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark text."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces with the digest of their ids."""
    import public_tokenizers

    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return packing.piece_digests(pieces)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", remove_benchmark), ("pack", pack)]

# A trained classifier, signatures and a tokenizer are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

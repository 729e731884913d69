"""The registered queries of the subpackage, one per operator, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintwise.llm import (ann, chat, decontaminate, hmm, jaccardjoin, linecrf, neardup, packing, prefixtrie, sharding,
                           tokenalign, tokencount, urlrules)
from stintwise.llm.common import id_hash, table
from stintwise.session import scratch_path


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = linecrf.train(docs, table(spark, sf_dir, "labels"), ~linecrf.held_out(F.col("doc_id")))
    return linecrf.score(docs, model).select(
        "doc_id", linecrf.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(spark.createDataFrame(
        [(-7, 0, "user", hard), (-7, 1, "assistant", hard)], rows.schema))
    return chat.digests(chat.format_conversations(rows))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2)
    return packing.piece_digests(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_group")


def op5_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


GIVEN_URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
                   ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    mined = urlrules.mine_rules(urlrules.labelled_transactions(pages, table(spark, sf_dir, "labels")))
    return urlrules.judge(pages, GIVEN_URL_RULES, mined)


def op9_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(table(spark, sf_dir, "documents"), id_hash(F.col("doc_id")) % 7 == 2)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shuffle_to_shards(table(spark, sf_dir, "documents"), shards=8)
    path = scratch_path(spark, "shards")
    sharding.write_shards(placed, path)
    placed = sharding.size_and_crc(sharding.read_shards(placed, path), more=("shard", "slot"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenalign.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                            tokenizer_path("piece_bpe_32k.model"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccardjoin.jaccard_components(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps, members = prefixtrie.place_turns(table(spark, sf_dir, "conversations"))
    return prefixtrie.trie(*prefixtrie.shared_openings(steps, members, id_hash(F.col("conv")) % 9, every=5))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_line_crf_quality": op2_line_crf_quality,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_packing": op4_packing,
    "op5_prob_minhash": op5_prob_minhash,
    "op6_nearest": op6_nearest,
    "op7_token_counts": op7_token_counts,
    "op8_url_rules": op8_url_rules,
    "op9_hmm_scoring": op9_hmm_scoring,
    "op10_sharding": op10_sharding,
    "op11_token_alignment": op11_token_alignment,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {}

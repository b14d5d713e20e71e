"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliowright.llm import chat_format, cross_align, decontaminate, langid, mixing, pii, prefix_trie, simhash, substring_dedup, suffix_tree, token_store, topk, toxicity
from foliowright.llm.common import table

END_ID = 2


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.find(docs, pii.fit(docs)))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    # twice the pieces that the pipeline keeps, whose workers hold more beside them
    return token_store.store_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID, pieces=2 * token_store.PIECES)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.weighed(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
        F.round("_probability", 6).alias("probability"), F.col("_kept").alias("kept"),
    )


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digest(chat_format.format_chats(turns.unionByName(own)))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_align.align(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_pii": op2_pii,
    "op3_token_store": op3_token_store,
    "op4_mixing": op4_mixing,
    "op5_langid": op5_langid,
    "op6_toxicity": op6_toxicity,
    "op7_topk": op7_topk,
    "op8_chat_format": op8_chat_format,
    "op9_decontaminate": op9_decontaminate,
    "op10_simhash": op10_simhash,
    "op11_suffix_tree": op11_suffix_tree,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_cross_align": op13_cross_align,
    "pipeline": pipeline,
}

ORACLE = {
    "op1_substring_dedup": substring_dedup.SQL,
    "op4_mixing": mixing.sql(),
    "op7_topk": topk.SQL,
    "op8_chat_format": chat_format.SQL,
    "op9_decontaminate": decontaminate.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}

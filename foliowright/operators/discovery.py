"""Likely recognition errors: rare words close to much commoner ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliowright.functions import text
from foliowright.operators import simjoin, vocab


def with_counts(words: DataFrame, counts: DataFrame) -> DataFrame:
    """Words with their own count, 0 where they don't occur so spelled."""
    return words.join(counts, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


def _sides(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rare words, and frequent ones with their counts."""
    return vocab.rare_gates(counts).select("word"), with_counts(vocab.high_frequency(counts), counts)


def similar(counts: DataFrame) -> DataFrame:
    return simjoin.similar_words(*_sides(counts))


def candidates(counts: DataFrame) -> DataFrame:
    """(rare_word, suggested_correction, rare_count, correct_count, edit_distance)."""
    top = simjoin.closest(*_sides(counts))
    rows = top.join(counts.select("word", F.col("n").alias("rare_count")), "word").withColumn("capital", text.capitalized(F.col("near")))
    rows = rows.join(counts.select(F.col("word").alias("capital"), F.col("n").alias("capital_n")), "capital", "left")
    rows = rows.where(F.col("n") + F.coalesce("capital_n", F.lit(0)) >= 10 * F.col("rare_count"))
    return rows.select(F.col("word").alias("rare_word"), F.col("near").alias("suggested_correction"), "rare_count", F.col("n").alias("correct_count"), F.col("distance").alias("edit_distance"))


def character_patterns(found: DataFrame) -> DataFrame:
    """(wrong, meant, count) of letters that differ in place."""
    rows = found.where(F.length("rare_word") == F.length("suggested_correction")).select(F.lower("rare_word").alias("a"), F.col("suggested_correction").alias("b"))
    at = F.explode(F.sequence(F.lit(1), F.length("a"))).alias("i")
    pairs = rows.select("a", "b", at).select(F.substr("a", F.col("i"), F.lit(1)).alias("wrong"), F.substr("b", F.col("i"), F.lit(1)).alias("meant"))
    return pairs.where("wrong <> meant").groupBy("wrong", "meant").agg(F.count("*").alias("count"))


def bigram_patterns(found: DataFrame) -> DataFrame:
    """(wrong, meant, count) of different bigrams that occur equally often in the two words; how often is found once a bigram."""
    rows = found.where((F.length("rare_word") > 1) & (F.length("suggested_correction") > 1)).select(F.lower("rare_word").alias("a"), F.col("suggested_correction").alias("b"))
    gram = lambda c, i: F.substr(F.col(c), i, F.lit(2))
    grams = lambda c, name: F.inline(F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.struct(gram(c, i).alias(name), text.count_in(F.col(c), gram(c, i)).alias(f"{name}_n"))))
    pairs = rows.select("b", grams("a", "wrong")).select("wrong", "wrong_n", grams("b", "meant"))
    return pairs.where((F.col("wrong") != F.col("meant")) & (F.col("wrong_n") == F.col("meant_n"))).groupBy("wrong", "meant").agg(F.count("*").alias("count"))


def patterns(found: DataFrame, k: int = 100) -> DataFrame:
    both = character_patterns(found).unionByName(bigram_patterns(found)).groupBy("wrong", "meant").agg(F.sum("count").alias("count"))
    return both.orderBy(F.desc("count"), "wrong", "meant").limit(k)


def most_frequent(found: DataFrame, k: int = 50) -> DataFrame:
    """The k candidates that occur most often; ties by letters."""
    return found.orderBy(F.desc("rare_count"), "rare_word").limit(k)


def summary(counts: DataFrame) -> DataFrame:
    """total_words, unique_words, high_frequency_words and rare_words in one row."""
    least = F.count_distinct(F.when(F.col("n") >= 10, F.lower("word")))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_words"), F.count("*").alias("unique_words"), least.alias("high_frequency_words"), F.count_if(F.col("n") <= 3).alias("rare_words"))

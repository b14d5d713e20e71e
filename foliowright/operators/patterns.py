"""Words that contain patterns of a table: a join by the rarest letters of each pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: letters of the pieces that words and patterns meet by
GRAM = 3


def _grams(word: Column, n: int) -> Column:
    places = F.when(F.length(word) >= n, F.sequence(F.lit(1), F.length(word) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substr(word, i, F.lit(n))))


def containing(words: DataFrame, patterns: DataFrame, gram: int = GRAM, shortest: int = 1) -> DataFrame:
    """(word, pattern, ...): each distinct word with each pattern (pattern, ...) inside it, and the pattern's other columns.

    A word contains a pattern only if it contains all its pieces of `gram` letters. Each
    pattern is met at the one of them that the fewest words have (a shorter pattern at its
    whole), so that frequent letters bring no words together; what meets is then compared.
    shortest: the least length of patterns, if it is known, saves the shorter pieces of words.
    An empty or null pattern is in no word; repeated patterns each have their rows.
    """
    word, pattern = F.col("word"), F.col("pattern")
    sizes = range(max(1, min(shortest, gram)), gram + 1)
    pieces = words.where("word IS NOT NULL").select("word").distinct().select("word", F.explode(F.concat(*[_grams(word, n) for n in sizes])).alias("_gram"))
    had = pieces.groupBy("_gram").agg(F.count("*").alias("_n"))
    own = F.when(F.length(pattern) < gram, F.array(pattern)).otherwise(_grams(pattern, gram))
    distinct = patterns.where(F.length(pattern) >= shortest).select("pattern").distinct()
    at = distinct.select("pattern", F.explode(own).alias("_gram")).join(had, "_gram", "left").groupBy("pattern")
    # a piece that no word has leaves its pattern without any
    at = at.agg(F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram"))
    found = pieces.join(at, "_gram").where(word.contains(pattern)).select("word", "pattern")
    return found.join(patterns, "pattern").select("word", "pattern", *[c for c in patterns.columns if c != "pattern"])


def replaced(words: DataFrame, patterns: DataFrame, gram: int = GRAM, shortest: int = 1) -> DataFrame:
    """(word, pattern, corrected): words with the first pattern in them, by ord, replaced everywhere; patterns: (ord, pattern, replacement)."""
    first = F.min_by(F.struct("pattern", "replacement"), F.struct("ord", "pattern", "replacement"))
    rows = containing(words, patterns, gram, shortest).groupBy("word").agg(first.alias("p"))
    return rows.select("word", "p.pattern", F.replace("word", F.col("p.pattern"), F.col("p.replacement")).alias("corrected"))

"""Edit-distance joins, blocked by shared parts so that they are equi-joins without loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliowright.functions.text import bound

RADIUS = 2
#: right words up to this length meet by what is left after deletions, longer ones by pieces
SHORT = 16


def _deletions(word: Column) -> Column:
    """Hashes of the word and of what is left of it without one letter and without two."""
    size = F.length(word)
    without = lambda w, i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1))
    upto = lambda a, z: F.when(a <= z, F.sequence(a, z)).otherwise(F.array().cast("array<int>"))

    def hashed(one: Column) -> Column:
        two = F.flatten(F.transform(one, lambda x, i: F.transform(upto(i + 1, size - 1), lambda j: F.xxhash64(without(x, j)))))
        return F.array_distinct(F.concat(F.array(F.xxhash64(word)), F.transform(one, lambda x: F.xxhash64(x)), two))

    return bound(F.transform(upto(F.lit(1), size), lambda i: without(word, i)), hashed)


def _piece(word: Column, size: Column, i: int, shift: int = 0) -> Column:
    """Key of piece i (0, 1, 2) of a right word of that length, read in word at the piece's place moved by shift."""
    base = F.floor(size / 3).cast("int")
    length = base if i < 2 else size - base * 2
    start = base * i + shift
    fits = (start >= 0) & (start + length <= F.length(word)) & (size > SHORT)
    return F.when(fits, F.xxhash64(F.lit(i), size, F.substr(word, start + 1, length)))


def _own_keys(near: Column) -> Column:
    pieces = F.array(*[_piece(near, F.length(near), i) for i in range(3)])
    return F.when(F.length(near) <= SHORT, _deletions(near)).otherwise(pieces)


def _probed(words: DataFrame) -> DataFrame:
    """(word, ..., key): keys at which words meet every right word within the radius; other columns stay.

    Words are many: letters are deleted one after the other by generators, in compiled code,
    where functions of arrays would walk them. Of equal letters in a row the first one goes.
    """
    size = F.length("_lower")
    low = words.withColumn("_lower", F.lower("word"))
    short = low.where(size <= SHORT + RADIUS).select("*", F.explode(F.sequence(F.lit(0), size)).alias("_i"))
    i, j, one = F.col("_i"), F.col("_j"), F.col("_one")
    letter = lambda w, at: F.substr(w, at, F.lit(1))
    without = lambda w, at: F.concat(F.substr(w, F.lit(1), at - 1), F.substr(w, at + 1))
    short = short.where((i < 2) | (letter(F.col("_lower"), i) != letter(F.col("_lower"), i - 1)))
    # 0: no letter goes; i: letter i, and then none (i - 1) or one behind it
    short = short.withColumn("_one", F.when(i == 0, F.col("_lower")).otherwise(without(F.col("_lower"), i)))
    behind = F.sequence(F.greatest(i - 1, F.lit(0)), F.when(i == 0, F.lit(0)).otherwise(size - 1))
    short = short.select(*words.columns, "_i", "_one", F.explode(behind).alias("_j"))
    none = (i == 0) | (j == i - 1)
    short = short.where(none | (j == i) | (letter(one, j) != letter(one, j - 1)))
    short = short.select(*words.columns, F.xxhash64(F.when(none, one).otherwise(without(one, j))).alias("key"))
    long = low.where(size > SHORT - RADIUS).select(*words.columns, F.explode(_probe_pieces(F.col("_lower"))).alias("key"))
    return short.unionByName(long)


def _probe_pieces(word: Column) -> Column:
    """Keys of the pieces at which a word meets long right words.

    Of three pieces of a right word one is untouched by two edits. If it is the first such
    piece, piece i has i edits at least before it, hence at most RADIUS - i behind it, and
    its place in the word moves by no more than either side allows.
    """
    pieces = []
    for longer in range(-RADIUS, RADIUS + 1):
        for i in range(3):
            for shift in range(-i, i + 1):
                if abs(shift - longer) <= RADIUS - i:
                    pieces.append(_piece(word, F.length(word) - longer, i, shift))
    return F.array_compact(F.array(*pieces))


def _met(left: DataFrame, right: DataFrame, radius: int) -> DataFrame:
    """The pairs of similar_words(), each as often as its words meet."""
    if not 0 < radius <= RADIUS:
        raise ValueError("keys are made for a distance of up to 2")
    dealt = right.where(F.ascii("word").between(ord("a"), ord("z"))).select(F.col("word").alias("near"), "n").select("near", "n", F.explode(_own_keys(F.col("near"))).alias("key"))
    own = _probed(left.select("word"))
    lower = F.lower("word")
    close = (F.abs(F.length(lower) - F.length("near")) <= radius) & (F.abs(F.ascii(lower) - F.ascii("near")) <= radius) & (lower != F.col("near"))
    # sorted, as the keys of few words are many and would be broadcast by the size of the words
    pairs = own.join(dealt.hint("merge"), "key").where(close).withColumn("distance", F.levenshtein(lower, "near", radius))
    return pairs.where(F.col("distance").between(1, radius)).select("word", "near", F.col("distance").cast("long").alias("distance"), "n")


def similar_words(left: DataFrame, right: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(word, similar, distance, n): right words within the radius of each left word, itself excluded.

    left: distinct (word); right: lower-case distinct (word, n). Pairs differ by at most
    `radius` in the rank of the first letter, and a right word starts with a to z.

    Words meet by equal keys only: what is left of both after the deletion of up to two
    letters, or, if the right word is longer than SHORT, an untouched piece of three at about
    its place. Words made of the same syllables share pieces, whatever their number, so that
    only long words, which are few, meet by them. A word has at most 172 keys of the first
    kind and 19 of the second, whatever the vocabulary.
    """
    return _met(left, right, radius).dropDuplicates(["word", "near"])


def closest(left: DataFrame, right: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The pair of similar_words() that best() puts first for each word; summed up where words meet, without an exchange of all pairs."""
    first = F.min(F.struct("distance", (-F.col("n")).alias("fewer"), "near", "n")).alias("x")
    return _met(left, right, radius).groupBy("word").agg(first).select("word", "x.near", "x.distance", "x.n")


def best(pairs: DataFrame, k: int) -> DataFrame:
    """The k closest of each word, with rank; ties by count, then by letters."""
    rank = F.row_number().over(W.partitionBy("word").orderBy("distance", F.desc("n"), "near"))
    return pairs.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k)

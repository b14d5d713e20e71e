"""Word counts, dictionaries and validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliowright.functions import fixed, text


def word_counts(pages: DataFrame, hyphens: bool = False) -> DataFrame:
    """(word, n), case kept."""
    find = text.hyphen_words if hyphens else text.words
    # outer, as else a filter on the number of words would find them twice
    words = pages.select(F.explode_outer(find(F.col("markdown"))).alias("word")).where("word IS NOT NULL")
    return words.groupBy("word").agg(F.count("*").alias("n"))


def totals(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_words"), F.count("*").alias("unique_words"))


def high_frequency(counts: DataFrame, least: int = 10) -> DataFrame:
    """Lower-case words of which one spelling is frequent."""
    return counts.where(F.col("n") >= least).select(F.lower("word").alias("word")).distinct()


def rare(counts: DataFrame, most: int = 3) -> DataFrame:
    return counts.where(F.col("n") <= most)


def rare_gates(counts: DataFrame) -> DataFrame:
    """Rare words worth a search: of four letters or more, not all capitals."""
    return rare(counts).where((F.length("word") >= 4) & ~text.is_caps(F.col("word")))


def placed(markdown: Column) -> Column:
    """The words of a text, each with its code-point offset; within the row and in linear time."""

    def places(found: Column) -> Column:
        ends = text.running_sums(F.zip_with(F.slice(found["gaps"], F.lit(1), F.size(found["words"])), found["words"], lambda g, w: g + F.length(w)))
        return F.zip_with(found["words"], ends, lambda w, e: F.struct(w.alias("word"), (e - F.length(w)).alias("position")))

    gaps = F.transform(F.split(markdown, text.WORD, -1), F.length)
    return text.bound(F.struct(text.words(markdown).alias("words"), gaps.alias("gaps")), places)


def _tokens(pages: DataFrame, *columns: Column) -> DataFrame:
    """The columns, tok_pos, word and position of each word; all within the page's row."""
    rows = pages.select(*columns, placed(F.col("markdown")).alias("_words"))
    return rows.select(*[c for c in rows.columns if c != "_words"], F.posexplode("_words").alias("tok_pos", "t")).select("*", "t.word", "t.position").drop("t")


def token_positions(pages: DataFrame) -> DataFrame:
    """(index, tok_pos, word, position): each word and its code-point offset."""
    return _tokens(pages, F.col("index")).withColumn("tok_pos", F.col("tok_pos").cast("long"))


def token_contexts(pages: DataFrame, width: int = 50) -> DataFrame:
    """(index, position, word, context): each word and the text around it."""
    size = max(4 * width, 1)
    rows = _tokens(pages, F.col("index"), text.blocks_of(F.col("markdown"), size).alias("_blocks"))
    return rows.select("index", "position", "word", text.context(F.col("_blocks"), size, F.col("position"), width).alias("context"))


def listed_valid(word: Column) -> Column:
    """Validity from fixed lists alone: short words, kept spellings, terms, Roman numerals."""
    return (F.length(word) < 2) | F.lower(word).isin(*fixed.PRESERVED_SPELLINGS) | F.upper(word).isin(*fixed.PARLIAMENTARY_TERMS) | word.rlike("^(?:[0-9]+|[IVXLCDM]+)$")


def invalid(words: DataFrame, dictionary: DataFrame, column: str = "word") -> DataFrame:
    """The rows whose word is in no list and not in the dictionary of lower-case words."""
    rows = words.where(~listed_valid(F.col(column))).withColumn("_lower", F.lower(column))
    return rows.join(dictionary.select(F.col("word").alias("_lower")), "_lower", "left_anti").drop("_lower")


def valid(words: DataFrame, dictionary: DataFrame, column: str = "word") -> DataFrame:
    rows = words.withColumn("_lower", F.lower(column)).join(dictionary.select(F.col("word").alias("_lower"), F.lit(True).alias("_in")), "_lower", "left")
    return rows.where(listed_valid(F.col(column)) | F.col("_in")).drop("_lower", "_in")


def vocabulary(pages: DataFrame, dictionary: DataFrame, nth: int = 10, most: int = 10_000, least: int = 3) -> DataFrame:
    """(word, n): the commonest valid lower-case words of every nth page."""
    sampled = pages.where(F.col("pos") % nth == 0)
    counts = sampled.select(F.explode(text.words(F.col("markdown"))).alias("w")).groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("n"))
    return valid(counts.orderBy(F.desc("n"), "word").limit(most).where(F.col("n") >= least), dictionary)


def entities(pages: DataFrame, pages_read: int = 500, least: int = 5) -> DataFrame:
    """(speaker, n): labels that start pages, of the first pages of each volume."""
    from foliowright.functions.fixed import ENTITY

    found = pages.where(F.col("pos") < pages_read).select(F.regexp_extract("markdown", ENTITY, 0).alias("s")).where("s <> ''")
    return found.groupBy(F.rtrim("s", F.lit(".—")).alias("speaker")).agg(F.count("*").alias("n")).where(F.col("n") >= least)

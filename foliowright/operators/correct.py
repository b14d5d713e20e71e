"""Corrections: from frequencies, from confusion tables, by edits, and hybrid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliowright.functions import fixed, text
from foliowright.operators import patterns, rewrite, simjoin, vocab
from foliowright.operators.tables import side_by_side


# From frequencies --------------------------------------------------------------------


def frequency_confidence(ratio: Column, distance: Column, correct_count: Column) -> Column:
    base = F.when(ratio >= 50, F.lit(0.95)).when(ratio >= 20, F.lit(0.90)).when(ratio >= 10, F.lit(0.85)).otherwise(F.lit(0.70))
    near = base + F.when(distance == 1, F.lit(0.03)).when(distance == 2, F.lit(0.01)).otherwise(F.lit(0.0))
    return near - F.when(correct_count < 30, F.lit(0.10)).otherwise(F.lit(0.0))


def frequency_lookup(candidates: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(rare_word, correct_word, confidence): the best correction of each rare word."""
    word = F.col("rare_word")
    rows = candidates.where((word != "") & (F.col("suggested_correction") != "") & ~text.is_proper(word) & ~text.is_caps(word) & (F.col("correct_count") > 0) & (F.col("rare_count") > 0))
    rows = rows.withColumn("confidence", frequency_confidence(F.col("correct_count") / F.col("rare_count"), F.col("edit_distance"), F.col("correct_count"))).where(F.col("confidence") >= threshold)
    best = F.max_by(F.struct("suggested_correction", "confidence"), F.struct("confidence", -F.col("edit_distance"), "suggested_correction"))
    return rows.groupBy("rare_word").agg(best.alias("b")).select("rare_word", F.col("b.suggested_correction").alias("correct_word"), F.col("b.confidence").alias("confidence"))


def skipped(candidates: DataFrame) -> DataFrame:
    """skipped_proper_nouns and skipped_all_caps of a report's candidates, in one row."""
    word = F.col("rare_word")
    named = (word != "") & (F.col("suggested_correction") != "")
    proper = named & text.is_proper(word)
    return candidates.agg(F.count_if(proper).alias("skipped_proper_nouns"), F.count_if(named & ~text.is_proper(word) & text.is_caps(word)).alias("skipped_all_caps"))


def frequency_replacements(counts: DataFrame, lookup: DataFrame) -> DataFrame:
    """(word, replacement, confidence) for the spellings that occur; capitals and names stay."""
    word = F.col("word")
    open_ = counts.where(~text.is_proper(word) & ~text.is_caps(word)).select("word", F.lower("word").alias("rare_word"))
    rows = open_.join(lookup, "rare_word")
    first_upper = F.left("word", F.lit(1)).rlike("[A-Z]")
    return rows.select("word", F.when(first_upper, text.capitalized(F.col("correct_word"))).otherwise(F.col("correct_word")).alias("replacement"), "confidence").where("word <> replacement")


# From the static table ---------------------------------------------------------------


def _exact(word: Column) -> Column:
    out = F.lit(None).cast("string")
    upper = {}
    for wrong, right in fixed.CONFUSIONS:
        upper.setdefault(wrong.upper(), right.upper())
    for wrong, right in reversed([*fixed.CONFUSIONS, *((w, r) for w, r in upper.items() if w not in dict(fixed.CONFUSIONS))]):
        out = F.when(word == wrong, right).otherwise(out)
    return out


def _confused(counts: DataFrame, threshold: float) -> DataFrame:
    """(word, n, replacement, confidence) of confusion_replacements(), found once a word behind a generator: filters on them would find them again."""
    word = F.col("word")
    exact = _exact(word)
    made = F.struct(F.coalesce(exact, _inside(word)).alias("replacement"), F.when(exact.isNotNull(), F.lit(0.95)).otherwise(F.lit(0.85)).alias("confidence"))
    kept = F.filter(F.array(made), lambda x: x["replacement"].isNotNull() & (x["confidence"] >= threshold) & (x["replacement"] != word))
    return counts.select("word", "n", F.inline(kept))


def confusion_replacements(counts: DataFrame, threshold: float = 0.90) -> DataFrame:
    """(word, replacement, confidence) that reach the threshold: words of the table, as they are or in capitals, then patterns inside words."""
    return _confused(counts, threshold).select("word", "replacement", "confidence")


def confusion_report(counts: DataFrame, threshold: float = 0.90) -> DataFrame:
    """rewrite.report() of the confusion replacements, without a join: their counts are at hand."""
    return _confused(counts, threshold).select(F.col("word").alias("original"), F.col("replacement").alias("corrected"), F.col("n").alias("count"))


def table_substrings(counts: DataFrame, table: DataFrame, least: int = 3) -> DataFrame:
    """(word, corrected, confidence) like confusion_substrings, for a caller's table (ord, pattern, replacement) of any size.

    Words that are a pattern themselves, as it is or in capitals, are left out.
    """
    listed = table.select(F.col("pattern").alias("word")).unionByName(table.select(F.upper("pattern").alias("word"))).distinct()
    rows = patterns.replaced(counts.select("word").join(listed, "word", "left_anti"), table.where(F.length("pattern") >= least), shortest=least)
    return rows.select("word", "corrected", F.lit(0.85).alias("confidence"))


def _inside(word: Column) -> Column:
    """The word with the first pattern of three letters or more in it replaced, null without any."""
    out = F.lit(None).cast("string")
    for wrong, right in reversed(fixed.CONFUSIONS):
        if len(wrong) >= 3:
            out = F.when(word.contains(wrong), F.replace(word, F.lit(wrong), F.lit(right))).otherwise(out)
    return out


def confusion_substrings(counts: DataFrame) -> DataFrame:
    """(word, corrected, confidence): other words with a pattern of three letters or more inside."""
    word = F.col("word")
    rows = counts.where(_exact(word).isNull()).select("word", _inside(word).alias("corrected"))
    return rows.where("corrected IS NOT NULL").withColumn("confidence", F.lit(0.85))


# Suggestions of the dictionary detector ----------------------------------------------


def confusion_suggestions(unknown: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(word, suggestion, confidence, ord): valid words that a confused letter pair gives."""
    tried = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.when(F.col("word").contains(a), F.replace(F.col("word"), F.lit(a), F.lit(b))).alias("suggestion"), F.lit(0.85 if a.isupper() == b.isupper() else 0.75).alias("confidence"))
        for i, (a, b) in enumerate(fixed.CONFUSION_PAIRS)
    ])
    rows = unknown.select("word", F.inline(tried)).where("suggestion IS NOT NULL AND suggestion <> word")
    return vocab.valid(rows, dictionary, "suggestion").select("word", "suggestion", "confidence", "ord")


def edit_suggestions(unknown: DataFrame, vocabulary: DataFrame, k: int = 3) -> DataFrame:
    """(word, suggestion, confidence, ord): the closest vocabulary words of words of 4 to 12 letters."""
    pairs = simjoin.best(simjoin.similar_words(unknown.where(F.length("word").between(4, 12)).select("word"), vocabulary), k)
    score = F.least(F.lit(0.5) * (F.lit(1.0) - F.col("distance") / F.lit(2.0)) + F.lit(0.3), F.lit(1.0))
    return pairs.select("word", F.col("near").alias("suggestion"), score.alias("confidence"), (F.col("rank") + 99).cast("int").alias("ord"))


def suggestions(unknown: DataFrame, dictionary: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, error_types, suggestions): confusions in table order, then edits; words without any are left out."""
    both = confusion_suggestions(unknown, dictionary).unionByName(edit_suggestions(unknown, vocabulary))
    rows = both.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("ord", "suggestion", "confidence"))).alias("s"))
    types = F.when(F.get("s", F.lit(0))["ord"] < 100, F.array(F.lit("unknown_word"), F.lit("confusion_pattern"))).otherwise(F.array(F.lit("unknown_word")))
    return rows.select("word", types.alias("error_types"), F.transform("s", lambda x: F.struct(x["suggestion"].alias("word"), x["confidence"].alias("confidence"))).alias("suggestions"))


def applied(found: DataFrame, threshold: float = 0.90) -> DataFrame:
    """(word, replacement) of the first suggestions that reach the threshold, in the word's case."""
    first = F.get("suggestions", F.lit(0))
    word, new = F.col("word"), first["word"]
    cased = F.when((word == F.upper(word)) & (word != F.lower(word)), F.upper(new)).when(F.left(word, F.lit(1)).rlike("[A-Z]"), text.capitalized(new)).otherwise(new)
    return found.where(first["confidence"] >= threshold).select("word", cased.alias("replacement"))


def error_records(pages: DataFrame, found: DataFrame, width: int = 50) -> DataFrame:
    """(page_index, original_word, position, error_types, suggested_corrections, context): a record for each place of a word of suggestions()."""
    rows = rewrite.occurrences(pages, found, width)
    return rows.select(F.col("index").alias("page_index"), F.col("word").alias("original_word"), "position", "error_types", F.col("suggestions").alias("suggested_corrections"), "context")


# Hybrid ------------------------------------------------------------------------------


def hybrid_open(counts: DataFrame) -> DataFrame:
    """Words that the hybrid corrector looks at."""
    word = F.col("word")
    return counts.where((F.length("word") > 2) & ~(text.is_caps(word) & (F.length("word") > 4)))


def hybrid_invalid(counts: DataFrame, dictionary: DataFrame) -> DataFrame:
    known = dictionary.select(F.col("word").alias("known"))
    return hybrid_open(counts).join(known, F.lower("word") == F.col("known"), "left_anti").where(~F.col("word").isin(*fixed.WHITELIST))


def hybrid_confidence(counts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(word, n, suggestion, suggestion_count, edit_distance, confidence) of every invalid word with a suggestion."""
    wrong = hybrid_invalid(counts, dictionary)
    listed = dictionary.join(counts, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))
    top = simjoin.closest(wrong.select("word"), listed)
    rows = top.select("word", F.col("near").alias("suggestion"), F.col("distance").alias("edit_distance"), (F.col("n") * 2).alias("suggestion_count")).join(wrong, "word")
    s, n, d = F.col("suggestion_count"), F.col("n"), F.col("edit_distance")
    score = F.when(s >= 100, F.lit(0.4)).when(s >= 10, F.lit(0.3)).when(s >= 3, F.lit(0.2)).otherwise(F.lit(0.1))
    score = score + F.when(n == 0, F.lit(0.3)).when(n <= 2, F.lit(0.2)).when(n <= 5, F.lit(0.1)).otherwise(F.lit(0.0))
    score = score + F.when(d == 1, F.lit(0.3)).when(d == 2, F.lit(0.2)).when(d == 3, F.lit(0.1)).otherwise(F.lit(0.0))
    return rows.select("word", "n", "suggestion", s, d, F.when(s == 0, F.lit(0.0)).otherwise(score).alias("confidence"))


def hybrid_replacements(scored: DataFrame, threshold: float = 0.7) -> DataFrame:
    return scored.where((F.col("confidence") >= threshold) & (F.col("word") != F.col("suggestion"))).select("word", F.col("suggestion").alias("replacement"), "confidence")


def hybrid_summary(counts: DataFrame, dictionary: DataFrame, scored: DataFrame, threshold: float = 0.7) -> DataFrame:
    """words_checked, words_invalid, total_corrections and unique_correction_types in one row."""
    checked = hybrid_open(counts).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("words_checked"))
    wrong = hybrid_invalid(counts, dictionary).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("words_invalid"))
    made = hybrid_replacements(scored, threshold).join(counts, "word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_corrections"), F.count("*").alias("unique_correction_types"))
    parts = {c: t.select(c) for t in (checked, wrong, made) for c in t.columns}
    return side_by_side(**parts)

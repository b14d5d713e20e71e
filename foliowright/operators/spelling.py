"""Affix dictionaries: expansion as joins, validity, and ranked suggestions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliowright.functions import text
from foliowright.operators import patterns, simjoin


def _has(flags: Column, flag: str | None) -> Column:
    return F.array_contains(flags, flag) if flag else F.lit(False)


def _applied(words: DataFrame, rules: DataFrame, kind: str) -> DataFrame:
    """words (stem, word, flags, suffixed, both) with each rule of that kind that they bear and fit.

    both: whether all rules so far may go with one at the other side.
    """
    own = rules.where(F.col("kind") == kind).select("flag", "cross", "strip", "add", "more", "condition")
    rows = words.withColumn("flag", F.explode("flags")).join(own, "flag")
    word, strip = F.col("word"), F.col("strip")
    if kind == "SFX":
        fits = word.endswith(strip) & ((F.col("condition") == "") | F.rlike(word, F.concat("condition", F.lit("$"))))
        made = F.concat(F.left("word", F.length("word") - F.length("strip")), "add")
    else:
        fits = word.startswith(strip) & ((F.col("condition") == "") | F.rlike(word, F.concat(F.lit("^"), "condition")))
        made = F.concat("add", F.substr("word", F.length("strip") + 1))
    # nothing is stripped down to nothing
    rows = rows.where(fits & (F.length("word") > F.length("strip")))
    return rows.withColumn("word", made)


def expand(stems: DataFrame, rules: DataFrame, roles: dict[str, str] | None = None) -> DataFrame:
    """(word, stem, quiet): every form of the stems (stem, flags), once for each stem it comes from.

    A stem, its suffixed forms (twice, where a rule's form bears flags itself), its prefixed
    forms, and both where both rules allow it. Forms meet rules by flag; each meets as many
    as its flags have. quiet: forms that are never suggested. Forbidden words are no forms,
    whatever makes them.
    """
    roles = roles or {}
    need, forbidden = roles.get("NEEDAFFIX"), roles.get("FORBIDDENWORD")
    named = stems.where("stem IS NOT NULL AND stem <> ''").select("stem", F.coalesce("flags", F.array().cast("array<string>")).alias("flags"))
    out = named.where(~_has(F.col("flags"), forbidden))
    base = out.select("stem", F.col("stem").alias("word"), "flags", F.col("flags").alias("whole"), F.lit(True).alias("both"))
    once = _applied(base, rules, "SFX").select("stem", "word", "more", "whole", F.col("cross").alias("both"))
    once = once.withColumn("flags", F.col("more"))
    twice = _applied(once.drop("more"), rules, "SFX").select("stem", "word", F.col("more").alias("flags"), "whole", (F.col("both") & F.col("cross")).alias("both"), "more")
    suffixed = once.select("stem", "word", "flags", "whole", "both").unionByName(twice.select("stem", "word", "flags", "whole", "both"))
    bearers = base.unionByName(suffixed.select("stem", "word", F.array_union("whole", "flags").alias("flags"), "whole", "both"))
    # a form with a suffix takes a prefix only if both rules go together
    plain = F.col("word") == F.col("stem")
    prefixed = _applied(bearers.withColumn("_plain", plain), rules, "PFX").where(F.col("_plain") | (F.col("both") & F.col("cross")))
    needs = lambda c: ~_has(F.col(c), need)
    forms = base.where(needs("flags")).select("word", "stem", "whole").unionByName(suffixed.where(needs("flags")).select("word", "stem", "whole")).unionByName(prefixed.where(needs("more")).select("word", "stem", "whole"))
    quiet = _has(F.col("whole"), roles.get("NOSUGGEST"))
    forms = forms.groupBy("word", "stem").agg(F.min(quiet).alias("quiet"))
    if forbidden:
        forms = forms.join(named.where(_has(F.col("flags"), forbidden)).select(F.col("stem").alias("word")), "word", "left_anti")
    return forms


def spellings(word: Column) -> Column:
    """The forms as which a word may stand in a dictionary: itself; in small letters if it has one capital or only such; with one capital if it has only such."""
    lower = F.lower(word)
    return F.array_distinct(F.array_compact(F.array(word, F.when(text.is_caps(word) | (word == text.capitalized(word)), lower), F.when(text.is_caps(word), text.capitalized(word)))))


def check(words: DataFrame, forms: DataFrame) -> DataFrame:
    """words (word, ...) that the dictionary's forms (word) have in none of their spellings."""
    known = words.select("word").distinct().select("word", F.explode(spellings(F.col("word"))).alias("_as")).join(forms.select(F.col("word").alias("_as")).distinct(), "_as", "left_semi")
    return words.join(known.select("word").distinct(), "word", "left_anti")


def replacements(words: DataFrame, table: DataFrame) -> DataFrame:
    """(word, suggestion, ord): words with one place changed by one row of the table (ord, wrong, right)."""
    rules = table.select("ord", F.regexp_replace("wrong", r"^\^|\$$", "").alias("pattern"), "right", F.col("wrong").startswith("^").alias("_first"), F.col("wrong").endswith("$").alias("_last"))
    rows = patterns.containing(words, rules)
    word, size = F.col("word"), F.length("pattern")
    places = F.filter(F.sequence(F.lit(1), F.length("word") - size + 1), lambda i: F.substr(word, i, size) == F.col("pattern"))
    rows = rows.select("*", F.explode(places).alias("_at"))
    here = (~F.col("_first") | (F.col("_at") == 1)) & (~F.col("_last") | (F.col("_at") + size - 1 == F.length("word")))
    made = F.concat(F.left("word", F.col("_at") - 1), "right", F.substr(word, F.col("_at") + size))
    return rows.where(here).select("word", made.alias("suggestion"), "ord").where("suggestion <> word")


def _grams(word: Column, n: int) -> Column:
    return F.when(F.length(word) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(word) - (n - 1)), lambda i: F.substr(word, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def likeness(a: Column, b: Column) -> Column:
    """Shared pieces of one to three letters, over all that both have: from 0 to 1."""
    shared = sum((F.size(F.array_intersect(_grams(a, n), _grams(b, n))) for n in (1, 2, 3)), F.lit(0))
    every = sum((F.size(F.array_union(_grams(a, n), _grams(b, n))) for n in (1, 2, 3)), F.lit(0))
    return F.when(every == 0, 0.0).otherwise(shared / every)


def suggest(wrong: DataFrame, forms: DataFrame, table: DataFrame | None = None, k: int = 5) -> DataFrame:
    """(word, suggestion, rank, kind, score): up to k forms for each distinct wrong word, best first.

    First what a row of the table of replacements makes of it, in the table's order; then
    forms at one or two edits, nearer ones first and of these the likest by pieces of letters;
    ties go by letters. Quiet forms are never suggested. Suggestions take the wrong word's case.
    """
    listed = (forms.where("NOT quiet") if "quiet" in forms.columns else forms).select("word").distinct()
    given = wrong.select("word").where("word IS NOT NULL AND word <> ''").distinct()
    asked = given.select("word", F.lower("word").alias("_lower"))
    known = listed.select(F.col("word").alias("near"), F.lower("word").alias("_near"))
    found = None
    if table is not None:
        made = replacements(asked.select(F.col("_lower").alias("word")), table).select(F.col("word").alias("_lower"), F.lower("suggestion").alias("_near"), F.col("ord").alias("_ord"))
        found = asked.join(made, "_lower").join(known, "_near").select("word", "near", F.lit(0).alias("_stage"), "_ord", F.lit("replacement").alias("kind"))
    pairs = simjoin.similar_words(asked.select(F.col("_lower").alias("word")).distinct(), listed.select(F.lower("word").alias("word"), F.lit(0).cast("long").alias("n")).distinct())
    close = asked.join(pairs.select(F.col("word").alias("_lower"), F.col("near").alias("_near"), "distance"), "_lower").join(known, "_near")
    close = close.select("word", "near", F.lit(1).alias("_stage"), F.col("distance").alias("_ord"), F.lit("edit").alias("kind"))
    both = close if found is None else found.unionByName(close)
    score = likeness(F.lower("word"), F.lower("near"))
    # each form once, where it comes first; and the best k of these without a sort of all
    once = both.groupBy("word", "near").agg(F.min(F.struct("_stage", "_ord", "kind")).alias("_b"))
    ranked = F.struct(F.col("_b._stage"), F.col("_b._ord"), (-score).alias("_s"), F.col("near"), F.col("_b.kind"))
    top = once.where("near <> word").groupBy("word").agg(F.slice(F.array_sort(F.collect_set(ranked)), F.lit(1), F.lit(k)).alias("_t"))
    rows = top.select("word", F.posexplode("_t").alias("_i", "_x"))
    near, word = F.col("_x.near"), F.col("word")
    cased = F.when(text.is_caps(word), F.upper(near)).when((word == text.capitalized(word)) & (near == F.lower(near)), text.capitalized(near)).otherwise(near)
    return rows.select("word", cased.alias("suggestion"), (F.col("_i") + 1).cast("long").alias("rank"), F.col("_x.kind").alias("kind"), (-F.col("_x._s")).alias("score"))

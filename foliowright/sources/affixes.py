"""Readers of affix dictionaries: a list of stems with flags (.dic) and the rules behind the flags (.aff)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _aff_lines(spark: SparkSession, path: str) -> DataFrame:
    """(nth, f): the fields of each line of a rule file, comments aside. A rule file is small, and its order counts: it is one row."""
    whole = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("nth", "line"))
    fields = F.split(F.regexp_replace(F.regexp_replace("line", "^﻿|#.*$", ""), r"^\s+|\s+$", ""), r"\s+")
    return whole.select("nth", fields.alias("f")).where(F.get("f", F.lit(0)) != "")


def flag_kind(spark: SparkSession, path: str) -> str:
    """How flags are written: one character each ("char"), two ("long"), or numbers with commas ("num")."""
    row = _aff_lines(spark, path).where(F.get("f", F.lit(0)) == "FLAG").select(F.get("f", F.lit(1)).alias("k")).first()
    return {"long": "long", "num": "num"}.get(row.k if row else "", "char")


def flags(text: Column, kind: str) -> Column:
    """The flags that a text lists; none for null."""
    found = {
        "char": F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), "long": F.regexp_extract_all(text, F.lit("(?s).."), F.lit(0)),
        "num": F.filter(F.split(text, ","), lambda x: x != ""),
    }[kind]
    return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """(kind, flag, cross, strip, add, more, condition): prefix and suffix rules.

    kind is PFX or SFX; more are the flags that a form made by the rule bears; condition is a
    pattern for what stands at the side where the rule works, empty for any. "0" is nothing.
    """
    kind = flag_kind(spark, path)
    lines = _aff_lines(spark, path).where(F.get("f", F.lit(0)).isin("PFX", "SFX"))
    at = lambda i: F.get("f", F.lit(i))
    # a head has Y or N and a number of rules; a rule has at least what to strip and what to add
    head = F.size("f").between(4, 4) & at(2).isin("Y", "N") & at(3).rlike("^[0-9]+$")
    heads = lines.where(head).select(at(0).alias("kind"), at(1).alias("flag"), (at(2) == "Y").alias("cross"))
    added = F.split(at(3), "/", 2)
    none = lambda c: F.when(c == "0", "").otherwise(c)
    # in a condition a dash is a letter, and of the signs only [ ] ^ . are meant
    pattern = F.regexp_replace(F.coalesce(at(4), F.lit(".")), r"([-\\*+?(){}|$&])", r"\\$1")
    rules = lines.where(~head).select(
        at(0).alias("kind"), at(1).alias("flag"), none(at(2)).alias("strip"), none(F.get(added, F.lit(0))).alias("add"),
        flags(F.get(added, F.lit(1)), kind).alias("more"), F.when(pattern == ".", "").otherwise(pattern).alias("condition"),
    )
    return rules.join(heads.distinct(), ["kind", "flag"]).select("kind", "flag", "cross", "strip", "add", "more", "condition")


def read_replacements(spark: SparkSession, path: str) -> DataFrame:
    """(ord, wrong, right): the table of likely replacements, in its order; "_" is a space, ^ and $ at the ends of wrong hold it to a word's ends."""
    lines = _aff_lines(spark, path).where((F.get("f", F.lit(0)) == "REP") & (F.size("f") >= 3))
    return lines.select(F.col("nth").alias("ord"), F.get("f", F.lit(1)).alias("wrong"), F.replace(F.get("f", F.lit(2)), F.lit("_"), F.lit(" ")).alias("right"))


def read_roles(spark: SparkSession, path: str) -> dict[str, str]:
    """The flags of special roles, by name: NEEDAFFIX, FORBIDDENWORD, NOSUGGEST, KEEPCASE, as far as named."""
    names = ("NEEDAFFIX", "FORBIDDENWORD", "NOSUGGEST", "KEEPCASE")
    rows = _aff_lines(spark, path).where(F.get("f", F.lit(0)).isin(*names) & (F.size("f") >= 2)).select(F.get("f", F.lit(0)).alias("k"), F.get("f", F.lit(1)).alias("v"))
    return {r.k: r.v for r in rows.limit(len(names)).collect()}


def read_stems(spark: SparkSession, path: str, kind: str = "char") -> DataFrame:
    """(stem, flags) of a list of stems; the count in its first line and what follows white space are left out. "\\/" is a slash."""
    line = F.split(F.regexp_replace("value", "^﻿", ""), r"\t|\s+[a-z]{2}:")[0]
    rows = spark.read.text(path).select(F.regexp_replace(line, r"\s+$", "").alias("line")).where(~F.col("line").rlike(r"^\s*[0-9]*$"))
    parts = F.split("line", r"(?<!\\)/", 2)
    return rows.select(F.replace(parts[0], F.lit("\\/"), F.lit("/")).alias("stem"), flags(F.get(parts, F.lit(1)), kind).alias("flags"))

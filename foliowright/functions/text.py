"""Text functions with the reference language's rules for words, white space and lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII words between Unicode word boundaries.
WORD = r"(?<![\p{L}\p{N}_])[A-Za-z]++(?![\p{L}\p{N}_])"
#: The same with inner hyphens and apostrophes.
HYPHEN_WORD = r"(?<![\p{L}\p{N}_])[A-Za-z](?:[A-Za-z\-']*[A-Za-z])?(?![\p{L}\p{N}_])"
#: Lossless pieces: words are whole pieces.
PIECES = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"
HYPHEN_PIECES = HYPHEN_WORD + r"|[^A-Za-z]+|[A-Za-z]"
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def hyphen_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(HYPHEN_WORD), F.lit(0))


def pieces(text: Column, hyphens: bool = False) -> Column:
    return F.regexp_extract_all(text, F.lit(HYPHEN_PIECES if hyphens else PIECES), F.lit(0))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{_SPACE}+|{_SPACE}+\z", "")


def lstrip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{_SPACE}+", "")


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_SPACE}+\z", "")


def paragraphs(text: Column) -> Column:
    """Runs of lines that aren't blank, stripped."""
    lines = F.regexp_replace(text, _BREAKS, "\n")
    return F.filter(F.transform(F.split(lines, r"\n(?:[^\S\n]*+\n)++"), strip), lambda p: p != "")


def is_proper(word: Column) -> Column:
    return word.rlike("^[A-Z][a-z]+$")


def is_caps(word: Column) -> Column:
    """All capitals and longer than one letter."""
    return (F.length(word) > 1) & (word == F.upper(word)) & (word != F.lower(word))


def capitalized(word: Column) -> Column:
    return F.concat(F.upper(F.left(word, F.lit(1))), F.lower(F.substr(word, F.lit(2))))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once even where use reads it for each element of an array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, join: Callable[[Column, Column], Column], zero: int, block: int = 64) -> Column:
    """An array's integers joined (summed, or the greatest taken) up to and with each one, in time linear in the array.

    Appending to an array copies it, so that blocks are joined first and then with what precedes them.
    """
    none = F.lit(zero).cast("long")

    def walk(xs: Column) -> Column:
        start = F.struct(none.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(xs, start, lambda acc, x: F.struct(join(acc["at"], x.cast("long")).alias("at"), F.array_append(acc["out"], join(acc["at"], x.cast("long"))).alias("out")), lambda acc: acc["out"])

    def shifted(blocks: Column) -> Column:
        totals = walk(F.transform(blocks, lambda b: F.coalesce(F.get(b, F.size(b) - 1), none)))
        before = F.concat(F.array(none), totals)
        return F.flatten(F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), lambda b, t: F.transform(b, lambda x: join(t, x))))

    def blocked(xs: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(xs) - 1, F.lit(0)), F.lit(block))
        return bound(F.transform(starts, lambda i: walk(F.slice(xs, i + 1, F.lit(block)))), shifted)

    return bound(values, blocked)


def running_sums(values: Column) -> Column:
    return running(values, lambda a, b: a + b, 0)


def running_greatest(values: Column) -> Column:
    """Of integers of at least 0."""
    return running(values, F.greatest, 0)


def blocks_of(text: Column, size: int) -> Column:
    """The text cut into pieces of that many code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def context(blocks: Column, size: int, position: Column, width: int = 50) -> Column:
    """The text from width before the position to width behind it, from the text's blocks of that size, 2 * width at least."""
    start = F.greatest(position - width, F.lit(0))
    at = F.floor(start / size).cast("int")
    near = F.concat(F.get(blocks, at), F.coalesce(F.get(blocks, at + 1), F.lit("")))
    return F.substr(near, (start - at * size).cast("int") + 1, (position + width - start).cast("int"))


def count_in(text: Column, part: Column) -> Column:
    """Occurrences of part that don't overlap."""
    return ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("long")

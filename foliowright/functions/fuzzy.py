"""Sequence-similarity ratios as expressions: longest common blocks, found again left and right of each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliowright.functions.fixed import LATIN_MONTHS
from foliowright.functions.text import bound, count_in

_SPAN = "array<struct<a:int,b:int,c:int,d:int>>"


def letters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _longest(a: Column, b: Column) -> Column:
    """(k, i, j): the longest block that a[i:] and b[j:] share, the first in a, then in b; negated places, so that it is the greatest.

    Row by row of a, as long as the common run that ends at each place of b.
    """
    zero = F.lit(0)
    start = F.struct(F.transform(b, lambda _: zero).alias("row"), F.struct(zero.alias("k"), zero.alias("i"), zero.alias("j")).alias("best"), zero.alias("at"))

    def step(acc: Column, letter: Column) -> Column:
        before = F.concat(F.array(zero), F.slice(acc["row"], F.lit(1), F.size(acc["row"]) - 1))
        row = F.zip_with(b, before, lambda x, n: F.when(x == letter, n + 1).otherwise(0))

        def judged(row: Column) -> Column:
            ends = F.transform(row, lambda n, j: F.struct(n.alias("k"), (n - 1 - acc["at"]).alias("i"), (n - 1 - j).alias("j")))
            return F.struct(row.alias("row"), F.greatest(acc["best"], F.array_max(F.filter(ends, lambda e: e["k"] > 0))).alias("best"), (acc["at"] + 1).alias("at"))

        return bound(row, judged)

    return F.aggregate(a, start, step, lambda acc: acc["best"])


def matched(a: Column, b: Column) -> Column:
    """How many letters of the arrays a and b lie in common blocks: the longest one, and so on at both its sides."""
    size = lambda x: F.size(x)
    span = lambda *x: F.struct(*[v.cast("int").alias(n) for v, n in zip(x, "abcd")])
    start = F.struct(F.array(span(F.lit(0), size(a), F.lit(0), size(b))).cast(_SPAN).alias("open"), F.lit(0).alias("total"))

    def step(acc: Column, _: Column) -> Column:
        def inside(s: Column) -> Column:
            found = _longest(F.slice(a, s["a"] + 1, s["b"] - s["a"]), F.slice(b, s["c"] + 1, s["d"] - s["c"]))

            def divided(m: Column) -> Column:
                i, j = s["a"] - m["i"], s["c"] - m["j"]
                sides = F.array(span(s["a"], i, s["c"], j), span(i + m["k"], s["b"], j + m["k"], s["d"])).cast(_SPAN)
                wide = F.when(m["k"] > 0, F.filter(sides, lambda x: (x["a"] < x["b"]) & (x["c"] < x["d"]))).otherwise(F.array().cast(_SPAN))
                rest = F.slice(acc["open"], F.lit(1), F.size(acc["open"]) - 1)
                return F.struct(F.concat(rest, wide).alias("open"), (acc["total"] + m["k"]).alias("total"))

            return bound(found, divided)

        return F.when(F.size(acc["open"]) == 0, acc).otherwise(bound(F.get(acc["open"], F.size(acc["open"]) - 1), inside))

    rounds = F.sequence(F.lit(1), 2 * F.least(size(a), size(b)) + 1)
    return F.aggregate(rounds, start, step, lambda acc: acc["total"])


def ratio(a: Column, b: Column) -> Column:
    """Twice the matched letters of the texts a and b over their lengths; 1 for two empty texts. For short texts."""
    sizes = F.length(a) + F.length(b)
    return F.when(sizes == 0, F.lit(1.0)).otherwise(bound(letters(a), lambda x: bound(letters(b), lambda y: matched(x, y))) * 2.0 / sizes)


def at_most(a: Column, b: Column) -> Column:
    """An upper bound of the ratio of two texts, from their edit distance: what isn't matched is taken out of one and put into the other."""
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a) + F.length(b), F.lit(1))


def letters_at_most(text: Column, target: str) -> Column:
    """An upper bound of the ratio: letters in common, wherever they stand."""
    common = sum((F.least(count_in(text, F.lit(c)), F.lit(target.count(c))) for c in sorted(set(target))), F.lit(0))
    return common * 2.0 / (F.length(text) + len(target))


def house_like(prefix: Column) -> Column:
    """Whether upper-case text starts about like a house's heading. Blocks are searched only where the bounds allow it."""

    def like(n: int, house: str) -> Column:
        start = F.left(prefix, F.lit(n))
        return F.when(at_most(start, F.lit(house)) < 0.75, False).when(letters_at_most(start, house) < 0.75, False).otherwise(ratio(start, F.lit(house)) >= 0.75)

    return F.coalesce(like(15, "HOUSE OF LORDS") | like(17, "HOUSE OF COMMONS"), F.lit(False))


def latin_month(token: Column) -> Column:
    """Number of the closest Latin month, null if none is close; equal ratios take the later name by letters."""

    def near(month: Column) -> Column:
        close = (F.length(token) <= 3 * F.length(month)) & (F.length(month) <= 3 * F.length(token))
        return F.struct(F.when(close, F.when(at_most(month, token) >= 0.5, ratio(month, token))).alias("ratio"), month.alias("month"))

    names = F.array(*map(F.lit, LATIN_MONTHS))
    best = F.array_max(F.filter(F.transform(names, near), lambda x: x["ratio"] >= 0.5))
    return F.when(token.isNotNull(), bound(best, lambda b: F.nullif(F.array_position(names, b["month"]).cast("int"), F.lit(0))))

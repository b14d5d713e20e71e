"""Page headers, footers and words broken across pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliowright.functions import fixed, text
from foliowright.functions.fuzzy import house_like


def is_date_header(line: Column) -> Column:
    return text.strip(line).rlike(fixed.DATE_HEADER)


def is_house_header(line: Column) -> Column:
    """Exact headings by their start; others by similarity of 17 characters."""
    start = F.left(text.strip(F.upper(line)), F.lit(17))
    exact = start.startswith("HOUSE OF LORDS") | start.startswith("HOUSE OF COMMONS")
    return F.when(exact, True).when(F.length(start) < 8, False).otherwise(house_like(start))


def is_header(line: Column) -> Column:
    return is_house_header(line) | is_date_header(line)


def remove_footer(markdown: Column) -> Column:
    return text.rstrip(F.regexp_replace(markdown, f"(?iUd){fixed.FOOTER}", ""))


def extract_headers(pages: DataFrame) -> DataFrame:
    """header and markdown set from a header line with a blank line behind it."""
    # blank lines are never given back, so the matcher needn't recurse for each
    pattern = "(?sd)" + fixed.HEADER_AND_REST.replace(r"\n)*", r"\n)*+")
    # the whole text is matched only where its first line could be a header
    first = text.strip(F.split(text.lstrip(F.col("markdown")), "\n", 2)[0])
    line = F.when(is_header(first), text.strip(F.regexp_extract("markdown", pattern, 1)))
    rows = pages.withColumn("_line", line).withColumn("_is", F.coalesce(F.col("_line") == first, F.lit(False)) & (F.col("_line") != ""))
    rest = F.when(F.col("_is"), F.regexp_extract("markdown", pattern, 2)).otherwise(F.col("markdown"))
    return rows.withColumn("header", F.when(F.col("_is"), F.col("_line")).otherwise(F.col("header"))).withColumn("markdown", rest).drop("_line", "_is")


#: a page ends in a broken word
_TAIL = r"\S-\s*\z"
#: pages whose flags one group holds
BLOCK = 512


def _fragment(markdown: Column) -> Column:
    """The first letters that a page could give up; empty if it has none."""
    return F.regexp_extract(text.lstrip(markdown), r"^([a-z]{1,15})(?![a-z])", 1)


def _without(markdown: Column) -> Column:
    """A page's text without these."""

    def cut(bare: Column) -> Column:
        lead = F.left(markdown, F.length(markdown) - F.length(bare))
        rest = F.substr(bare, F.length(_fragment(bare)) + 1)
        return F.when((rest != "") & ~rest.rlike(r"\A[\s\x1c-\x1f\x85\p{Z}]"), F.concat(lead, rest)).otherwise(text.lstrip(rest))

    return text.bound(text.lstrip(markdown), cut)


def _runs(rows: DataFrame, by: list[str], order: str, sure: Column, turns: Column) -> DataFrame:
    """rows with _known (null before the first sure value) and _odd: the last sure value in order, and whether it was turned over an odd number of times since."""
    w = W.partitionBy(*by).orderBy(order)
    rows = rows.withColumn("_sure", sure).withColumn("_run", F.count("_sure").over(w))
    run = W.partitionBy(*by, "_run")
    turned = F.sum(F.when(F.col("_sure").isNull() & turns, 1).otherwise(0)).over(run.orderBy(order)) % 2 == 1
    return rows.withColumn("_odd", turned).withColumn("_known", F.max("_sure").over(run)).drop("_sure", "_run")


def broken_words(pages: DataFrame, block: int = BLOCK) -> DataFrame:
    """(volume, pos, gives, fragment): pages that give up their first letters, or get those of the next page (fragment).

    Whether a page still ends in a broken word, once it has given up its own first letters,
    follows from the page before: it is fixed, or the same, or the opposite. Such steps
    compose, so a volume is scanned on two levels. Blocks of pages are first walked alone, which
    leaves for each what its last page does as a step of its own; a second walk over the
    blocks says how each begins. Only flags and fragments are exchanged, and no task holds
    more than a block of pages or the steps of a volume's blocks.
    """
    rows = pages.select("volume", "pos", "markdown", _fragment(F.col("markdown")).alias("_fragment"))
    rows = rows.withColumn("_eligible", F.when(F.col("_fragment") != "", ~is_header(F.split(text.lstrip(F.col("markdown")), "\n", 2)[0])).otherwise(False))
    raw = F.col("markdown").rlike(_TAIL)
    flags = rows.select(
        "volume", "pos", (F.col("pos") - F.pmod("pos", F.lit(block))).alias("_block"), F.struct(F.col("_eligible").alias("eligible"), F.col("_fragment").alias("fragment")).alias("_own"),
        raw.alias("_raw"), F.when(F.col("_eligible"), _without(F.col("markdown")).rlike(_TAIL)).otherwise(raw).alias("_still"),
    )
    fixed_ = F.when(~F.col("_own.eligible") | (F.col("_raw") == F.col("_still")), F.col("_raw"))
    by = ["volume", "_block"]
    rows = _runs(flags, by, "pos", fixed_, F.col("_raw"))
    blocks = rows.groupBy(*by).agg(F.max_by(F.struct("_known", "_odd"), "pos").alias("_last"), F.min_by("_own", "pos").alias("_first"))
    known, odd = F.col("_last._known"), F.col("_last._odd")
    blocks = _runs(blocks, ["volume"], "_block", F.when(known.isNotNull(), known != odd), odd)
    after = F.coalesce("_known", F.lit(False)) != F.col("_odd")
    order = W.partitionBy("volume").orderBy("_block")
    blocks = blocks.withColumn("_after", after).select("volume", "_block", F.lag("_after", 1, False).over(order).alias("_start"), F.lead("_first").over(order).alias("_then"))
    rows = rows.join(blocks, by)
    inside = W.partitionBy(*by).orderBy("pos")
    rows = rows.withColumn("_ends", F.coalesce("_known", "_start") != F.col("_odd"))
    rows = rows.withColumn("gives", F.col("_own.eligible") & F.coalesce(F.lag("_ends").over(inside), F.col("_start")))
    rows = rows.withColumn("_next", F.coalesce(F.lead("_own").over(inside), F.col("_then")))
    gets = F.col("_ends") & F.coalesce(F.col("_next.eligible"), F.lit(False))
    return rows.select("volume", "pos", "gives", F.when(gets, F.col("_next.fragment")).alias("fragment")).where("gives OR fragment IS NOT NULL")


def join_hyphens(pages: DataFrame, block: int = BLOCK) -> DataFrame:
    """Words broken at a page's end joined with the next page's first letters.

    Places (volume, pos) are unique, as in a file. Pages meet only those places that change.
    """
    found = broken_words(pages, block).select(F.col("volume").alias("_volume"), F.col("pos").alias("_pos"), F.col("gives").alias("_gives"), F.col("fragment").alias("_gets"))
    here = F.col("volume").eqNullSafe(F.col("_volume")) & (F.col("pos") == F.col("_pos"))
    rows = pages.join(found, here, "left")
    rows = rows.withColumn("_own", F.when(F.col("_gives"), _without(F.col("markdown"))).otherwise(F.col("markdown")))
    joined = F.concat(F.regexp_replace("_own", r"-\s*\z", ""), "_gets")
    rows = rows.withColumn("markdown", F.when(F.col("_gets").isNotNull(), joined).otherwise(F.col("_own")))
    return rows.drop(*[c for c in rows.columns if c.startswith("_")])


def process(pages: DataFrame) -> DataFrame:
    """Headers out, footers off, broken words joined."""
    rows = extract_headers(pages)
    return join_hyphens(rows.withColumn("markdown", remove_footer(F.col("markdown"))))

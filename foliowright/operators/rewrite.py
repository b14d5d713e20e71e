"""Replacing words of pages by a lookup table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliowright.functions import text
from foliowright.operators import vocab


def rewrite(pages: DataFrame, lookup: DataFrame, hyphens: bool = False) -> DataFrame:
    """(volume, pos, index, markdown, n_corrections), words replaced by lookup (word, replacement).

    Only the distinct words of a page meet the lookup; what applies to a page comes back
    to it as a small map, so that its tokens are never dealt out. Rows that share a place
    share the map, which holds all their words; a word has one replacement.
    """
    find = text.hyphen_words if hyphens else text.words
    own = pages.select("volume", "pos", F.explode(F.array_distinct(find(F.col("markdown")))).alias("word"))
    found = own.join(lookup.select("word", "replacement"), "word").groupBy("volume", "pos").agg(F.map_from_entries(F.collect_set(F.struct("word", "replacement"))).alias("_map"))
    found = found.select(F.col("volume").alias("_volume"), F.col("pos").alias("_pos"), "_map")
    here = F.col("volume").eqNullSafe(F.col("_volume")) & F.col("pos").eqNullSafe(F.col("_pos"))
    rows = pages.select("volume", "pos", "index", "markdown").join(found, here, "left").drop("_volume", "_pos")
    parts = F.when(F.col("_map").isNotNull(), text.pieces(F.col("markdown"), hyphens))
    rows = rows.withColumn("_parts", parts)
    changed = F.array_join(F.transform("_parts", lambda p: F.coalesce(F.try_element_at("_map", p), p)), "")
    count = F.size(F.filter("_parts", lambda p: F.try_element_at("_map", p).isNotNull()))
    return rows.select("volume", "pos", "index", F.coalesce(changed, "markdown").alias("markdown"), F.when(F.col("_map").isNotNull(), count).otherwise(0).cast("long").alias("n_corrections"))


def report(counts: DataFrame, lookup: DataFrame) -> DataFrame:
    """(original, corrected, count), from the corpus counts."""
    return counts.join(lookup, "word").select(F.col("word").alias("original"), F.col("replacement").alias("corrected"), F.col("n").alias("count"))


def page_corrections(pages: DataFrame, lookup: DataFrame, hyphens: bool = False) -> DataFrame:
    """(volume, pos, index, original, correction, confidence, count): what rewriting does to each page."""
    find = text.hyphen_words if hyphens else text.words
    own = pages.select("volume", "pos", "index", F.explode(find(F.col("markdown"))).alias("word"))
    counts = own.groupBy("volume", "pos", "index", "word").agg(F.count("*").alias("count"))
    return counts.join(lookup, "word").select("volume", "pos", "index", F.col("word").alias("original"), F.col("replacement").alias("correction"), "confidence", "count")


def occurrences(pages: DataFrame, lookup: DataFrame, width: int | None = None) -> DataFrame:
    """(volume, pos, index, word, position, nth, ...): each place of a word of lookup (word, ...), with the lookup's other columns.

    nth counts the word's places in its page. With a width, context is the text around the
    place. Like rewrite(): a page's distinct words meet the lookup, and only its own entries
    come back, so that its other tokens never leave the page's row. A word has one row in lookup.
    """
    more = [c for c in lookup.columns if c != "word"]
    own = pages.select("volume", "pos", F.explode(F.array_distinct(text.words(F.col("markdown")))).alias("word"))
    entries = own.join(lookup.select("word", F.struct(*more).alias("_entry")), "word").groupBy("volume", "pos").agg(F.map_from_entries(F.collect_set(F.struct("word", "_entry"))).alias("_map"))
    entries = entries.select(F.col("volume").alias("_volume"), F.col("pos").alias("_pos"), "_map")
    here = F.col("volume").eqNullSafe(F.col("_volume")) & F.col("pos").eqNullSafe(F.col("_pos"))
    rows = pages.select("volume", "pos", "index", "markdown").join(entries, here).drop("_volume", "_pos")
    kept = F.filter(vocab.placed(F.col("markdown")), lambda t: F.map_contains_key("_map", t["word"]))
    size = max(4 * (width or 0), 1)

    rows = rows.withColumn("_kept", kept)
    if width is None:
        found = F.transform("_kept", lambda t: F.struct(t["word"].alias("word"), t["position"].alias("position"), F.try_element_at("_map", t["word"]).alias("e")))
    else:
        found = text.bound(text.blocks_of(F.col("markdown"), size), lambda blocks: F.transform("_kept", lambda t: F.struct(
            t["word"].alias("word"), t["position"].alias("position"), F.try_element_at("_map", t["word"]).alias("e"), text.context(blocks, size, t["position"], width).alias("context"))))
    words = F.transform("_kept", lambda t: t["word"])
    rows = rows.withColumn("_found", found).withColumn("_nth", _repeats(words))
    rows = rows.select("volume", "pos", "index", F.posexplode(F.arrays_zip("_found", "_nth")).alias("_i", "_x"))
    extra = ["context"] if width is not None else []
    return rows.select("volume", "pos", "index", "_x._found.word", "_x._found.position", F.col("_x._nth").cast("long").alias("nth"), *[F.col(f"_x._found.{c}") for c in extra], "_x._found.e.*")


def _repeats(words: Column) -> Column:
    """For each element which of its equals it is, from 1 on: by place among the sorted ones, where equals are side by side."""

    def ranked(order: Column) -> Column:
        # the place of an element less the place of its first equal, both in sorted order
        firsts = text.running_greatest(F.transform(order, lambda x, i: F.when((i == 0) | (F.get(order, i - 1)["w"] != x["w"]), i).otherwise(0)))
        nth = F.zip_with(order, F.transform(firsts, lambda f, i: i - f + 1), lambda x, n: F.struct(x["i"].alias("i"), n.alias("n")))
        return F.transform(F.array_sort(nth), lambda x: x["n"])

    return text.bound(F.array_sort(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))), ranked)


_EDIT = "array<struct<position:bigint,wide:bigint,original:string,replacement:string>>"
#: code points of the pieces that a text is cut to, and edits that one walk keeps or drops
PIECE, WALK = 256, 64


def _between(blocks: Column, start: Column, stop: Column) -> Column:
    """The text of [start, stop), from its pieces; in time linear in what is taken."""
    first = F.floor(start / PIECE)
    parts = F.slice(blocks, (first + 1).cast("int"), (F.floor((stop - 1) / PIECE) - first + 1).cast("int"))
    return F.when(stop > start, F.substr(F.array_join(parts, ""), (start - first * PIECE + 1).cast("int"), (stop - start).cast("int"))).otherwise("")


def _apart(edits: Column) -> Column:
    """Edits in order without those that begin before the end of one kept before."""
    none = F.array().cast(_EDIT)

    def one(acc: Column, e: Column) -> Column:
        free = e["position"] >= acc["end"]
        return F.struct(F.when(free, e["position"] + F.length(e["original"])).otherwise(acc["end"]).cast("long").alias("end"), F.when(free, F.array_append(acc["kept"], e)).otherwise(acc["kept"]).alias("kept"))

    def walk(acc: Column, some: Column) -> Column:
        inner = F.aggregate(some, F.struct(acc["end"].alias("end"), none.alias("kept")), one)
        return text.bound(inner, lambda x: F.struct(x["end"].alias("end"), F.array_append(acc["kept"], x["kept"]).alias("kept")))

    def cut(xs: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(xs) - 1, F.lit(0)), F.lit(WALK))
        start = F.struct(F.lit(0).cast("long").alias("end"), F.array().cast(f"array<{_EDIT}>").alias("kept"))
        return F.flatten(F.aggregate(F.transform(starts, lambda i: F.slice(xs, i + 1, F.lit(WALK))), start, walk, lambda acc: acc["kept"]))

    return text.bound(edits, cut)


def splice(pages: DataFrame, edits: DataFrame) -> DataFrame:
    """(volume, pos, index, markdown, n_corrections): pages with edits (volume, pos, position, original, replacement) made.

    Positions are code points of the text before any edit. An edit applies only where its
    original stands. Of edits that overlap the first counts: by position, then the longer
    original, then the replacement's letters; one that begins inside an edit kept before it is
    dropped. An empty original inserts. Edits meet at their page only, pages without any stay.
    """
    e = F.struct(F.col("position").cast("long").alias("position"), (-F.length("original")).cast("long").alias("wide"), "original", "replacement")
    given = edits.where("position >= 0 AND original IS NOT NULL AND replacement IS NOT NULL").groupBy("volume", "pos").agg(F.array_sort(F.collect_set(e)).cast(_EDIT).alias("_edits"))
    given = given.select(F.col("volume").alias("_volume"), F.col("pos").alias("_pos"), "_edits")
    here = F.col("volume").eqNullSafe(F.col("_volume")) & F.col("pos").eqNullSafe(F.col("_pos"))
    rows = pages.select("volume", "pos", "index", F.coalesce("markdown", F.lit("")).alias("markdown")).join(given, here, "left").drop("_volume", "_pos")
    rows = rows.withColumn("_blocks", F.when(F.col("_edits").isNotNull(), text.blocks_of(F.col("markdown"), PIECE)))
    stands = lambda x: (x["position"] + F.length(x["original"]) <= F.length("markdown")) & (_between(F.col("_blocks"), x["position"], x["position"] + F.length(x["original"])) == x["original"])
    rows = rows.withColumn("_kept", F.when(F.col("_edits").isNotNull(), _apart(F.filter("_edits", stands))))
    n = F.size("_kept")
    end = lambda i: F.when(i == 0, F.lit(0)).otherwise(text.bound(F.get("_kept", i - 1), lambda x: x["position"] + F.length(x["original"])))
    part = lambda i: F.concat(
        _between(F.col("_blocks"), end(i), F.coalesce(F.get("_kept", i)["position"], F.length("markdown"))), F.coalesce(F.get("_kept", i)["replacement"], F.lit("")))
    made = F.array_join(F.transform(F.sequence(F.lit(0), n), part), "")
    return rows.select("volume", "pos", "index", F.when(n > 0, made).otherwise(F.col("markdown")).alias("markdown"), F.coalesce(F.when(n > 0, n), F.lit(0)).cast("long").alias("n_corrections"))

"""Speeches from pages: paragraph events, carried context, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliowright.functions import fixed, text
from foliowright.functions.fuzzy import latin_month


#: places of pages that one group holds
SPAN = 256


def ordered_paragraphs(pages: DataFrame) -> DataFrame:
    """(volume, ord, pos, page, para, p): paragraphs; their reading order is that of (ord, pos, para)."""
    rows = pages.select("volume", F.coalesce("global_index", "index", F.lit(0)).cast("long").alias("ord"), F.col("pos").cast("long").alias("pos"), F.coalesce("global_index", "index").alias("page"), "markdown")
    # outer, as else a filter on the size of what is dealt out would compute it twice
    rows = rows.select("volume", "ord", "pos", "page", F.posexplode_outer(text.paragraphs(F.col("markdown"))).alias("para", "p"))
    return rows.where("para IS NOT NULL").withColumn("para", F.col("para").cast("long"))


def bare_house(p: Column) -> Column:
    which = F.regexp_extract(p, fixed.BARE_HOUSE, 1)
    return F.when(which != "", F.concat(F.lit("HOUSE OF "), F.upper(which)))


def _date_tokens(p: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.upper(p), r"[.,;:—\-]+", " "), r"[\s\x1c-\x1f\x85\p{Z}]+"), lambda t: t != "")


def _iso_date(t: Column) -> Column:
    """The ISO date of a heading's tokens, null if they have none."""
    letters = lambda x: F.regexp_replace(x, "[^A-Z]", "")
    number = lambda x: F.regexp_replace(x, r"\D", "").try_cast("long")
    numbers = F.filter(F.transform(F.filter(t, lambda x: x.rlike(r"\d")), number), lambda n: n.isNotNull())
    die = F.array_position(t, "DIE")
    after = F.nullif(letters(F.get(t, die.cast("int"))), F.lit(""))
    last = F.array_max(F.filter(F.transform(t, lambda x, i: F.when(x.rlike(r"\d"), i)), lambda i: i.isNotNull()))
    words = F.filter(F.slice(t, F.lit(1), F.coalesce(last, F.lit(0))), lambda x: x.rlike("[A-Z]") & ~x.rlike(r"\d"))
    named = F.coalesce(after, text.bound(words, lambda w: letters(F.get(w, F.size(w) - 1))))

    def month(token: Column) -> Column:
        known = F.lit(None).cast("int")
        for i, m in enumerate(fixed.LATIN_MONTHS):
            known = F.when(token == m, i + 1).otherwise(known)
        return F.coalesce(known, latin_month(token))

    def dated(n: Column) -> Column:
        token = F.when((die > 0) & (F.size(n) >= 2), F.nullif(named, F.lit("")))
        iso = lambda m: F.when(m.isNotNull(), F.format_string("%04d-%02d-%02d", F.get(n, F.size(n) - 1), m, F.get(n, F.lit(0))))
        return text.bound(text.bound(token, month), iso)

    return text.bound(numbers, dated)


def dated_heading(rows: DataFrame) -> DataFrame:
    """rows with dated_house and date_iso, set where p is a house heading with a Latin date."""
    up = F.upper("p")
    house = F.when(up.startswith("HOUSE OF LORDS"), "HOUSE OF LORDS").when(up.startswith("HOUSE OF COMMONS"), "HOUSE OF COMMONS")
    iso = text.bound(house, lambda h: F.when(h.isNotNull(), text.bound(_date_tokens(F.col("p")), _iso_date)))
    one = text.bound(iso, lambda d: F.struct(F.when(d.isNotNull(), house).alias("dated_house"), d.alias("date_iso")))
    # outer, as else a filter on the house or date would find them again, once for each value that they are made from
    return rows.select("*", F.inline_outer(F.array(one)))


# Java's matcher recurses for each round of a group that may be given back, so runs of names
# are taken as wholes. What giving names back would find is said in other words: a run of
# capitalised words whose last is Member or Members, and below a dash inside a run of names.
_SPEAKER = fixed.SPEAKER_START.replace(r"(?:\s+[A-Z][A-Za-z]+)*\s+Members?", r"(?:\s+[A-Z][A-Za-z]+)++(?<=\sMembers?)")
_HEADING = fixed.HEADING_OF_BODY.replace(")*", ")*+")
_RUN = _HEADING.removesuffix(r"\s*[—\-]\s*")


def is_title(p: Column) -> Column:
    letters = F.regexp_replace(p, "[^A-Za-z]+", "")
    return (letters != "") & (letters == F.upper(letters)) & ~p.contains("\n") & ~F.upper(p).startswith("HOUSE OF ")


def chunks(p: Column) -> Column:
    """(speaker, text) of each speaker's heading in a paragraph; what precedes the first is lost."""
    pattern = f"(?mdU)^({_SPEAKER})\\s*—"
    labels = F.regexp_extract_all(p, F.lit(pattern), F.lit(1))
    parts = F.split(p, pattern, -1)
    said = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

    def one(name: Column, part: Column) -> Column:
        label = text.strip(F.regexp_replace(text.strip(name), r"[,.;:]+\z", ""))
        return F.struct(F.when(label.endswith("."), label).otherwise(F.concat(label, F.lit("."))).alias("speaker"), text.strip(part).alias("text"))

    return F.filter(F.zip_with(labels, said, one), lambda c: c["text"] != "")


def detect_speaker(p: Column) -> Column:
    """The label at the start of a paragraph: before a dash, before a verb, or a title and a name."""
    line = text.strip(F.split(p, "\n", 2)[0])

    def label(source: Column, pattern: str) -> Column:
        found = F.rtrim(text.strip(F.regexp_extract(source, pattern, 1)), F.lit(".,;:—-"))
        generic = F.rtrim(text.strip(F.upper(found)), F.lit(".:;—-")).rlike(f"^(?:{'|'.join(fixed.NON_SPEAKERS)})")
        return F.when(source.rlike(pattern) & ~generic, found)

    # a title and all words behind it, and in these the last verb: Java's matcher would
    # recurse for each word if it had to give words back one by one
    run = F.regexp_extract(line, rf"(?is)^(?:{fixed.VERB_TITLES})(?:{fixed.FURTHER_NAME})*+.?", 0)
    last_verb = rf"(?is)^((?:{fixed.VERB_TITLES})(?:\s.*\S)?)\s+(?:{fixed.VERBS})\b"
    return F.nullif(F.coalesce(label(line, fixed.DASH_LABEL), label(run, last_verb), label(line, fixed.NAME_LABEL)), F.lit(""))


def body(p: Column) -> Column:
    """The paragraph without its speaker's heading: names up to a dash behind them, or else up to the last dash inside."""
    inner = F.regexp_extract(F.regexp_extract(p, _RUN, 0), r"(?s)^.*[A-Z][A-Za-z\.'-]+-", 0)
    return text.strip(F.when(p.rlike(_HEADING), F.regexp_replace(p, _HEADING, "")).otherwise(F.substr(p, F.length(inner) + 1)))


def events(pages: DataFrame) -> DataFrame:
    """One row for each heading, title, chunk or paragraph, in order, with what it starts and says."""
    rows = dated_heading(ordered_paragraphs(pages)).withColumn("house", bare_house(F.col("p")))
    none = F.array().cast("array<struct<speaker:string,text:string>>")
    kind = F.when(F.col("dated_house").isNotNull(), "dated").when(F.col("house").isNotNull(), "house").when(is_title(F.col("p")), "title")
    rows = rows.withColumn("kind", kind).withColumn("_c", F.when(F.col("kind").isNull(), chunks(F.col("p"))).otherwise(none))
    single = F.when(F.col("kind").isNull() & (F.size("_c") == 0), detect_speaker(F.col("p")))
    rows = rows.withColumn("_s", text.bound(single, lambda x: F.when(F.length(x) <= 80, x)))
    said = F.when(F.size("_c") > 0, F.col("_c")).otherwise(F.array(F.struct(F.col("_s").alias("speaker"), F.when(F.col("_s").isNotNull(), body(F.col("p"))).when(F.col("kind").isNull(), F.col("p")).otherwise("").alias("text"))))
    rows = rows.select("volume", "ord", "pos", "page", "para", "kind", "p", "date_iso", F.coalesce("dated_house", "house").alias("house"), F.posexplode_outer(said).alias("chunk", "c"))
    return rows.select("volume", "ord", "pos", "page", "para", F.col("chunk").cast("long").alias("chunk"), "kind", "house", "date_iso", F.when(F.col("kind") == "title", F.col("p")).alias("title"), "c.speaker", "c.text")


_AT = ("ord", "pos", "para", "chunk")


def _blocked(rows: DataFrame, span: int) -> DataFrame:
    """rows (ord, pos, ...) with the block that they are in, which ascends in reading order.

    Pages of order 0, as those without an index are, come before others of their span and are blocked by their place.
    """
    cut = lambda c: F.col(c) - F.pmod(c, F.lit(span))
    zero = F.col("ord") == 0
    return rows.withColumn("_block", F.struct(cut("ord").alias("ord"), F.when(zero, 0).otherwise(1).alias("other"), F.when(zero, cut("pos")).otherwise(F.lit(0)).alias("pos")))


def _within(rows: DataFrame) -> DataFrame:
    """Events with _opens, the segment of their block that they are in (0: begun before), and whether it says anything there."""
    by = W.partitionBy("volume", "_block")
    opens = F.coalesce(F.col("speaker").isNotNull() | F.col("kind").isin("dated", "house"), F.lit(False))
    rows = rows.withColumn("_opens", opens).withColumn("_segment", F.sum(F.col("_opens").cast("long")).over(by.orderBy(*_AT)))
    heard = F.max(F.col("text") != "").over(W.partitionBy("volume", "_block", "_segment"))
    return rows.withColumn("_heard", heard).withColumn("_last", F.max("_segment").over(by))


def _starts(rows: DataFrame) -> DataFrame:
    """What each block begins with: house, date, title, how many segments and speeches came before, and whether its last segment is heard of later.

    Blocks are summed up alone first; a walk over a volume's blocks carries the sums forward. A
    segment that a speaker opens counts as a speech if it says anything, here or up to the
    next opening in a block behind.
    """
    at = F.struct(*_AT)
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c)
    spoken = F.col("_opens") & F.col("speaker").isNotNull()
    blocks = rows.groupBy("volume", "_block").agg(
        last("house"), last("date_iso"), last("title"), F.max("_segment").alias("segments"), F.count_if(spoken & F.col("_heard")).alias("speeches"),
        F.max(spoken & ~F.col("_heard") & (F.col("_segment") == F.col("_last"))).alias("waits"), F.max((F.col("text") != "") & (F.col("_segment") == 0)).alias("early"),
    )
    order = W.partitionBy("volume").orderBy("_block")
    before, behind = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy("volume").orderBy(F.desc("_block")).rowsBetween(W.unboundedPreceding, -1)
    answer = F.when(F.col("early") | (F.col("segments") > 0), F.col("early"))
    blocks = blocks.withColumn("_later", F.col("waits") & F.coalesce(F.last(answer, ignorenulls=True).over(behind), F.lit(False)))
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    return blocks.select(
        "volume", "_block", *[F.last(c, ignorenulls=True).over(before).alias(f"_{c}") for c in ("house", "date_iso", "title")],
        so_far("segments").alias("_segments"), so_far(F.col("speeches") + F.col("_later").cast("long")).alias("_speeches"), "_later",
    )


def by_blocks(pages: DataFrame, span: int = SPAN) -> DataFrame:
    """pages dealt out by blocks of a volume, so that they are read and walked by many tasks, however few files they come from."""
    rows = pages.select("volume", F.col("pos").cast("long").alias("pos"), "index", "global_index", "markdown", F.coalesce("global_index", "index", F.lit(0)).cast("long").alias("ord"))
    return _blocked(rows, span).repartition("volume", "_block").drop("_block", "ord")


def with_context(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """Events with the running house, date and title, the segment each belongs to, and the number of the speech (nth) that a segment is.

    A scan on two levels: texts are dealt out by blocks of pages, and of a volume only its blocks' sums meet.
    Both readings of the events take the same columns (ord is made again from the page), so that one exchange serves both.
    """
    dealt = _blocked(rows, span).drop("ord").repartition("volume", "_block")
    local = _within(dealt.withColumn("ord", F.coalesce("page", F.lit(0)).cast("long")))
    rows = local.join(_starts(local), ["volume", "_block"])
    order = W.partitionBy("volume", "_block").orderBy(*_AT)
    run = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(order), F.col(f"_{c}"))
    speech = F.col("_opens") & F.col("speaker").isNotNull() & (F.col("_heard") | (F.col("_later") & (F.col("_segment") == F.col("_last"))))
    rows = rows.select(
        "*", run("house").alias("cur_house"), run("date_iso").alias("cur_date"), run("title").alias("cur_title"),
        (F.col("_segments") + F.col("_segment")).alias("segment"), (F.col("_speeches") + F.sum(speech.cast("long")).over(order)).alias("nth"),
    )
    return rows.drop(*[c for c in rows.columns if c.startswith("_")])


def sessions(rows: DataFrame) -> DataFrame:
    """Speeches: a speaker's start and what follows it up to the next start or house heading."""
    seq = F.struct(*_AT)
    first = lambda c: F.min_by(c, seq)
    said = F.col("text") != ""
    grouped = rows.groupBy("volume", "segment").agg(
        first("cur_house").alias("house"), first("cur_date").alias("date_iso"), first("cur_title").alias("debate_title"), first("speaker").alias("speaker"), first("nth").alias("nth"),
        F.array_sort(F.collect_set(F.when(said | F.col("speaker").isNotNull(), F.col("page")))).alias("pages"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(said, F.struct(*_AT, "text")))), lambda x: x["text"]), "\n\n").alias("text"),
    )
    return grouped.where("speaker IS NOT NULL AND text <> ''")


def speeches(pages: DataFrame, span: int = SPAN) -> DataFrame:
    """(volume, id, house, date_iso, debate_title, speaker, pages, text); ids count within the volume."""
    rows = sessions(with_context(events(by_blocks(pages, span)), span))
    return rows.select("volume", F.format_string("%s_speech_%06d", "volume", "nth").alias("id"), "house", "date_iso", "debate_title", "speaker", "pages", "text")

"""Readers of page documents, and the page table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliowright.functions import text

PAGE = T.StructType([
    T.StructField("index", T.LongType()), T.StructField("global_index", T.LongType()),
    T.StructField("markdown", T.StringType()), T.StructField("header", T.StringType()),
])
COLUMNS = ["volume", "pos", "index", "global_index", "markdown", "header"]


def read_pages(spark: SparkSession, path: str, volume: str = "volume") -> DataFrame:
    """Pages of JSON documents: an object with `pages`, or a bare list of pages.

    pos keeps the order of the file. A file with neither shape is an error.
    """
    raw = spark.read.text(path, wholetext=True).select(F.coalesce(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1), F.lit(volume)).alias("volume"), "value")
    is_list = F.ltrim(F.regexp_replace("value", r"\A\s+", "")).startswith("[")
    pages = F.when(is_list, F.from_json("value", T.ArrayType(PAGE))).otherwise(F.from_json("value", T.StructType([T.StructField("pages", T.ArrayType(PAGE))]))["pages"])
    checked = F.when(pages.isNull(), F.raise_error(F.lit("a document with `pages`, or a list of pages, is expected")).cast(T.ArrayType(PAGE))).otherwise(pages)
    rows = raw.select("volume", F.posexplode(checked).alias("pos", "page"))
    return rows.select("volume", F.col("pos").cast("long").alias("pos"), "page.index", "page.global_index", F.coalesce("page.markdown", F.lit("")).alias("markdown"), "page.header")


KNOWN = ("index", "global_index", "markdown", "header")


def _others(fields: Column, *known: str) -> Column:
    """Fields (a map to values) but those known, as a JSON object with their types; null if there are none."""
    fields = F.map_filter(fields, lambda k, _: ~k.isin(*known))
    return F.when(F.size(fields) > 0, F.to_json(fields))


def read_whole_pages(spark: SparkSession, path: str, volume: str = "volume") -> DataFrame:
    """Pages like read_pages(), and in `extra` every other field that a page has, as a JSON object.

    A page is read as one value of any shape, so that fields of any type come back as they
    were. Pages that aren't objects are an error.
    """
    raw = spark.read.text(path, wholetext=True).select(F.coalesce(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1), F.lit(volume)).alias("volume"), "value")
    is_list = F.regexp_replace("value", r"\A\s+", "").startswith("[")
    # pages as they are written: no value of a whole document is made
    listed = F.when(is_list, F.from_json("value", T.ArrayType(T.StringType()))).otherwise(F.from_json("value", "pages array<string>")["pages"])
    checked = F.when(listed.isNull(), F.raise_error(F.lit("a document with `pages`, or a list of pages, is expected")).cast("array<string>")).otherwise(listed)
    page = F.parse_json("page")
    rows = raw.select("volume", F.posexplode(checked).alias("pos", "page")).select("volume", F.col("pos").cast("long").alias("pos"), page.alias("_page"))
    one = lambda name, kind: F.try_variant_get("_page", f"$.{name}", kind).alias(name)
    return rows.select(
        "volume", "pos", one("index", "bigint"), one("global_index", "bigint"), F.coalesce(F.try_variant_get("_page", "$.markdown", "string"), F.lit("")).alias("markdown"),
        one("header", "string"), _others(F.col("_page").cast("map<string,variant>"), *KNOWN).alias("extra"),
    )


def read_document_fields(spark: SparkSession, path: str, volume: str = "volume") -> DataFrame:
    """(volume, extra): the fields of a document beside its pages, as a JSON object; null for a bare list.

    A field's value may be as large as Spark's variants may (128 MB), pages included.
    """
    raw = spark.read.text(path, wholetext=True).select(F.coalesce(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1), F.lit(volume)).alias("volume"), "value")
    is_list = F.regexp_replace("value", r"\A\s+", "").startswith("[")
    return raw.select("volume", F.when(~is_list, _others(F.from_json("value", "map<string,variant>"), "pages")).alias("extra"))


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lower-case words, one a line."""
    return spark.read.text(path).select(F.lower(text.strip(F.col("value"))).alias("word")).where("word <> ''").distinct()


def read_error_report(spark: SparkSession, path: str) -> DataFrame:
    """Candidates of a discovery report, with defaults for missing fields."""
    one = "array<struct<rare_word:string,suggested_correction:string,rare_count:bigint,correct_count:bigint,edit_distance:int>>"
    rows = spark.read.schema(f"error_candidates {one}").option("multiLine", True).json(path).select(F.inline("error_candidates"))
    return rows.select("rare_word", "suggested_correction", *[F.coalesce(c, F.lit(d)).alias(c) for c, d in (("rare_count", 0), ("correct_count", 0), ("edit_distance", 999))])


def from_documents(docs: DataFrame) -> DataFrame:
    """Documents as pages of volumes of 3,400."""
    volume = ((F.col("doc_id") - F.col("doc_id") % 3400) / 3400).cast("long").cast("string")
    return docs.select(volume.alias("volume"), (F.col("doc_id") % 3400).alias("pos"), F.col("doc_id").alias("index"), F.col("doc_id").alias("global_index"), F.coalesce("text", F.lit("")).alias("markdown"), F.lit(None).cast("string").alias("header"))


#: Headings, speakers, broken words and footers for pages that have none; both SQL dialects read it.
DERIVED = (
    "CASE WHEN doc_id % 5 = 2 THEN 'ment in the '"
    " WHEN doc_id % 14 = 0 THEN 'HOUSE OF LORDS, MARTIS, 4° DIE FEBRUARII, 1834.' || chr(10) || chr(10)"
    " WHEN doc_id % 14 = 1 THEN 'HOUSE OF COMMONS.' || chr(10) || chr(10)"
    " WHEN doc_id % 14 = 3 THEN 'FEBRUARY 4' || chr(10) || chr(10)"
    " WHEN doc_id % 14 = 5 THEN 'CORN LAWS.' || chr(10) || chr(10)"
    " WHEN doc_id % 14 IN (4, 6, 8) THEN 'Mr. H. HANDLEY.—'"
    " WHEN doc_id % 14 = 9 THEN 'Sir ROBERT PEEL moved ' ELSE '' END"
    " || replace(coalesce(text, ''), chr(10), chr(10) || chr(10)) ||"
    " CASE WHEN doc_id % 5 = 1 THEN ' develop-'"
    " WHEN doc_id % 5 = 0 THEN chr(10) || chr(10) || 'No. XL.—Sess. 1834.' || chr(10) || chr(10) ELSE '' END"
)


#: Misspelled headings and months, several dates and labels, names that are no speakers, and a label that is too long.
VARIED = (
    "CASE doc_id % 20"
    " WHEN 0 THEN 'HOUSE OF LORDS, MARTIS, 4° DIE FEBRUARII, 1834.' || chr(10) || chr(10)"
    " WHEN 1 THEN 'HOUSE OF COMMONS, LUNAE, 17° DIE MARTII, 1834.' || chr(10) || chr(10)"
    " WHEN 2 THEN 'HOUSE OF LOEDS.' || chr(10) || chr(10)"
    " WHEN 3 THEN 'HOUSE OF C0MMONS, 110 181001' || chr(10) || chr(10)"
    " WHEN 4 THEN 'HOUSE OF LORDS, JOVIS, 5° DIE JUII, 1834.' || chr(10) || chr(10)"
    " WHEN 5 THEN 'HOUSE OF COMMONS, VENERIS, 9° DIE MAIL, 1833.' || chr(10) || chr(10)"
    " WHEN 6 THEN 'HOUSE OF CORRECTION' || chr(10) || chr(10)"
    " WHEN 7 THEN 'HOUSES OF PARLIAMENT' || chr(10) || chr(10)"
    " WHEN 8 THEN 'Mr. HANDLEY.—' WHEN 9 THEN 'LORD ALTHORP.—' WHEN 10 THEN 'The SPEAKER.—' WHEN 11 THEN 'EARL GREY.—' WHEN 12 THEN 'Sir ROBERT PEEL.—'"
    " WHEN 13 THEN 'THE NOBLE DUKE — '"
    " WHEN 14 THEN 'Sir ' || repeat('Bartholomew ', 8) || 'moved '"
    " WHEN 15 THEN 'AGRICULTURAL DISTRESS.' || chr(10) || chr(10)"
    " WHEN 16 THEN 'House of Commons' || chr(10) || chr(10)"
    " WHEN 17 THEN 'Several Irish Members together.—'"
    " WHEN 18 THEN 'FEBRUARY 11.1' || chr(10) || chr(10) ELSE '' END"
    " || replace(coalesce(text, ''), chr(10), chr(10) || chr(10))"
)


def derived(docs: DataFrame, prefix: str = DERIVED) -> DataFrame:
    """Pages with structure, made from documents."""
    return from_documents(docs.withColumn("text", F.expr(prefix)))


def first_pages(pages: DataFrame, n: int) -> DataFrame:
    return pages.where(F.col("pos") < n)


def every_nth_page(pages: DataFrame, n: int = 10) -> DataFrame:
    return pages.where(F.col("pos") % n == 0)

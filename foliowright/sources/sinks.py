"""Writers: page documents, record lines, word lists and reports."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def document_json(pages: DataFrame, pretty: bool = True) -> DataFrame:
    """(volume, json): each volume's pages in order as one JSON document."""
    page = F.struct("pos", "index", "global_index", "markdown", "header")
    rows = pages.groupBy("volume").agg(F.array_sort(F.collect_list(page)).alias("pages"))
    listed = F.struct(F.transform("pages", lambda p: F.struct(p["index"].alias("index"), p["global_index"].alias("global_index"), p["markdown"].alias("markdown"), p["header"].alias("header"))).alias("pages"))
    return rows.select("volume", F.to_json(listed, {"pretty": "true"} if pretty else {}).alias("json"))


def write_documents(pages: DataFrame, path: str, pretty: bool = True) -> None:
    document_json(pages, pretty).write.partitionBy("volume").option("lineSep", "\n").text(path)


def write_lines(rows: DataFrame, path: str) -> None:
    """One JSON record a line, with nulls."""
    rows.write.option("ignoreNullFields", "false").json(path)


def write_word_list(words: DataFrame, path: str) -> None:
    words.select("word").distinct().orderBy("word").write.text(path)


def report_path(path: str, what: str = "report") -> str:
    """The path of a report beside a JSON file."""
    return re.sub(r"\.json$", f"-{what}.json", path)


def write_report(report: DataFrame, path: str) -> None:
    """A report's one row as a JSON document."""
    report.select(F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).coalesce(1).write.text(path)


def _with(fields: Column, extra: Column) -> Column:
    """A JSON object's text with the fields of another behind its own."""
    more = F.when(F.length(extra) > 2, F.substr(extra, F.lit(2))).otherwise("}")
    own = F.left(fields, F.length(fields) - 1)
    return F.concat(own, F.when((F.length(own) > 1) & (F.length(more) > 1), ",").otherwise(""), more)


def write_whole_documents(pages: DataFrame, path: str, documents: DataFrame | None = None) -> None:
    """Each volume as one JSON document, in as many files as tasks: path/volume=.../part-*, one after the other by name.

    pages: as read_whole_pages() gives them (`extra` may be absent); documents: (volume, extra),
    fields beside the pages. A line is a page, so no task or row holds a volume; lines are dealt
    out by ranges of (volume, place). Only the first page of each volume is met by its place,
    for the comma. A page without markdown gets an empty one; other absent fields stay absent.
    """
    extra = F.col("extra") if "extra" in pages.columns else F.lit(None).cast("string")
    page = _with(F.to_json(F.struct("index", "global_index", "markdown", "header")), extra)
    firsts = pages.groupBy("volume").agg(F.min("pos").alias("_first")).select(F.col("volume").alias("_volume"), "_first")
    rows = pages.select("volume", "pos", page.alias("_page")).join(firsts, (F.col("volume") == F.col("_volume")) & (F.col("pos") == F.col("_first")), "left")
    line = F.concat(F.when(F.col("_first").isNull(), ",").otherwise(""), "_page")
    rows = rows.select("volume", F.lit(1).alias("_part"), "pos", line.alias("value"))
    volumes = firsts.select(F.col("_volume").alias("volume"))
    if documents is None:
        volumes = volumes.withColumn("extra", F.lit(None).cast("string"))
    else:
        volumes = volumes.join(documents.select("volume", "extra"), "volume", "full")
    begin = F.concat(F.regexp_replace(_with(F.lit("{}"), F.col("extra")), r"\}\z", ""), F.when(F.length("extra") > 2, ",").otherwise(""), F.lit('"pages":['))
    ends = volumes.select("volume", F.inline(F.array(F.struct(F.lit(0).alias("_part"), F.lit(0).cast("long").alias("pos"), begin.alias("value")), F.struct(F.lit(2).alias("_part"), F.lit(0).cast("long").alias("pos"), F.lit("]}").alias("value")))))
    order = ["volume", "_part", "pos"]
    rows.unionByName(ends).repartitionByRange(*order).sortWithinPartitions(*order).select("volume", "value").write.partitionBy("volume").text(path)


def write_report_parts(head: DataFrame, lists: dict[str, tuple[DataFrame, list[Column]]], path: str) -> None:
    """A report of any length as one JSON document in parts: the folders path/000, path/001, ... by name, and in each its files by name.

    head: one row of plain fields; lists: name to (rows, order). Rows of a list are sorted by
    ranges and written a line each by as many tasks; equal rows stay. The first line of all,
    which has no comma, is number 0: the first range holds the least key.
    """
    spark, texts = head.sparkSession, {"ignoreNullFields": "false"}
    steps = [head.select(F.regexp_replace(F.to_json(F.struct("*"), texts), r"\}\z", "").alias("value")).coalesce(1)]
    say = lambda text: spark.range(1).select(F.lit(text).alias("value")).coalesce(1)
    for name, (rows, order) in lists.items():
        by = [f"_{i}" for i in range(len(order))] + ["_json"]
        lines = rows.select(F.to_json(F.struct(*rows.columns), texts).alias("_json"), *[c.alias(n) for c, n in zip(order, by)])
        lines = lines.repartitionByRange(*by).sortWithinPartitions(*by)
        numbered = lines.select("_json", F.monotonically_increasing_id().alias("_n"))
        steps += [say(f",{json.dumps(name, ensure_ascii=False)}:["), numbered.select(F.concat(F.when(F.col("_n") == 0, "").otherwise(","), "_json").alias("value")), say("]")]
    for i, step in enumerate([*steps, say("}")]):
        step.write.text(f"{path}/{i:03d}")

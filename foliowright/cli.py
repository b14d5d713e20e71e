"""Runs a pipeline over page documents: `spark-submit foliowright/cli.py STEP INPUT OUTPUT [options]`.

INPUT is a path that Spark reads (a file, a folder or a pattern of JSON documents). Documents
come out in parts with all their other fields (sinks.write_whole_documents), records and
speeches as JSON lines, reports as JSON documents.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from foliowright.operators import correct, discovery, headers, reports, rewrite, speeches, spelling, vocab  # noqa: E402
from foliowright.sources import affixes, sinks  # noqa: E402
from foliowright.sources import pages as src  # noqa: E402


def dictionary(spark: SparkSession, pages: DataFrame, args: argparse.Namespace) -> DataFrame:
    """(word) in small letters: from affix dictionaries and word lists, as far as given; else the corpus's own frequent words."""
    found = []
    for path in args.dictionary:
        aff, dic = f"{path}.aff", f"{path}.dic"
        stems = affixes.read_stems(spark, dic, affixes.flag_kind(spark, aff))
        found.append(spelling.expand(stems, affixes.read_rules(spark, aff), affixes.read_roles(spark, aff)).select(F.lower("word").alias("word")))
    found += [src.read_word_list(spark, path) for path in args.words]
    out = found[0] if found else vocab.high_frequency(vocab.word_counts(pages))
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _with_text(pages: DataFrame, made: DataFrame) -> DataFrame:
    return pages.drop("markdown").join(made.select("volume", "pos", "markdown"), ["volume", "pos"])


def _corrected(spark, pages, documents, lookup, args, counts, hyphens=False, **more) -> None:
    sinks.write_whole_documents(_with_text(pages, rewrite.rewrite(pages, lookup, hyphens)), args.output, documents)
    if args.report:
        made = rewrite.report(counts, lookup)
        values = {k: v if isinstance(v, DataFrame) else spark.range(1).select(F.lit(v)) for k, v in more.items()}
        head = reports.side_by_side(total_pages_processed=pages.agg(F.count("*")), total_corrections=made.agg(F.coalesce(F.sum("count"), F.lit(0))), unique_error_types=made.agg(F.count("*")), **values)
        sinks.write_report_parts(head, {"corrections_by_type": (made, [-F.col("count"), F.col("original"), F.col("corrected")])}, args.report)


def run_headers(spark, pages, documents, args):
    sinks.write_whole_documents(headers.process(pages), args.output, documents)


def run_discover(spark, pages, documents, args):
    counts = vocab.word_counts(pages)
    sinks.write_report_parts(*reports.discovery_parts(counts, discovery.candidates(counts)), args.output)


def run_frequency(spark, pages, documents, args):
    counts = vocab.word_counts(pages)
    found = src.read_error_report(spark, args.analysis) if args.analysis else discovery.candidates(counts)
    known = correct.frequency_lookup(found, args.threshold or 0.85)
    lookup = correct.frequency_replacements(counts, known)
    _corrected(spark, pages, documents, lookup, args, counts, confidence_threshold=args.threshold or 0.85, available_corrections=known.agg(F.count("*")))


def run_confusion(spark, pages, documents, args):
    counts = vocab.word_counts(pages)
    _corrected(spark, pages, documents, correct.confusion_replacements(counts, args.threshold or 0.90), args, counts)


def run_detect(spark, pages, documents, args):
    counts, words = vocab.word_counts(pages), dictionary(spark, pages, args)
    found = correct.suggestions(vocab.invalid(counts, words), words, vocab.vocabulary(pages, words))
    if args.report:
        sinks.write_lines(correct.error_records(pages, found), args.report)
    made = rewrite.rewrite(pages, correct.applied(found, args.threshold or 0.90))
    sinks.write_whole_documents(_with_text(pages, made), args.output, documents)


def run_hybrid(spark, pages, documents, args):
    counts = vocab.word_counts(pages, hyphens=True)
    scored = correct.hybrid_confidence(counts, dictionary(spark, pages, args))
    lookup = correct.hybrid_replacements(scored, args.threshold or 0.7)
    _corrected(spark, pages, documents, lookup, args, counts, hyphens=True)


def run_speeches(spark, pages, documents, args):
    sinks.write_lines(speeches.speeches(pages).drop("volume"), args.output)


STEPS = {"headers": run_headers, "discover": run_discover, "frequency": run_frequency, "confusion": run_confusion, "detect": run_detect, "hybrid": run_hybrid, "speeches": run_speeches}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="foliowright", description="Cleans, corrects and divides page documents.")
    out.add_argument("step", choices=STEPS)
    out.add_argument("input", help="page documents, as Spark reads paths")
    out.add_argument("output", help="folder of what comes out; it must not exist yet")
    out.add_argument("--threshold", type=float, help="least confidence of a correction that is made (each step has its own)")
    out.add_argument("--sample", type=int, help="only the first pages of each volume")
    out.add_argument("--analysis", help="a report of discover, for frequency; made anew without it")
    out.add_argument("--report", help="folder of the report (frequency, confusion, hybrid) or of the error records (detect)")
    out.add_argument("--words", action="append", default=[], help="a list of valid words, one a line; may be repeated")
    out.add_argument("--dictionary", action="append", default=[], help="an affix dictionary, without .dic and .aff; may be repeated")
    return out


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"foliowright {args.step}").getOrCreate()
    pages, documents = src.read_whole_pages(spark, args.input), src.read_document_fields(spark, args.input)
    if args.sample is not None:
        pages = src.first_pages(pages, args.sample)
    STEPS[args.step](spark, pages, documents, args)


if __name__ == "__main__":
    main()

"""Reports and statistics of a run, each one row of the fields of its JSON document.

Lists in a document are as long as the distinct words or corrections that they name, never
as the pages; for larger ones the tables that they are made from can be written as lines.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliowright.operators import discovery
from foliowright.operators.tables import side_by_side


def _list(order: list[Column], fields: list[str]) -> Column:
    """The rows of an aggregate as an array of structs in that order."""
    keyed = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)], F.struct(*fields).alias("r"))
    return F.transform(F.array_sort(F.collect_list(keyed)), lambda x: x["r"])


def _listed(rows: DataFrame, order: list[Column], fields: list[str]) -> DataFrame:
    """One row: the rows as an array of structs in that order."""
    return rows.agg(_list(order, fields).alias("list"))


def discovery_report(counts: DataFrame, found: DataFrame) -> DataFrame:
    """Totals, candidates by count, and the commonest substitutions."""
    totals = discovery.summary(counts)
    by_count = _listed(found, [-F.col("rare_count"), F.col("rare_word")], ["rare_word", "suggested_correction", "rare_count", "correct_count", "edit_distance"])
    renamed = discovery.patterns(found).withColumnRenamed("meant", "right")
    by_pattern = _listed(renamed, [-F.col("count"), F.col("wrong"), F.col("right")], ["wrong", "right", "count"])
    return side_by_side(**{c: totals.select(c) for c in totals.columns}, error_candidates=by_count, substitution_patterns=by_pattern)


def discovery_parts(counts: DataFrame, found: DataFrame) -> tuple[DataFrame, dict]:
    """(head, lists) of the discovery report for sinks.write_report_parts, whatever its length."""
    candidates = found.select("rare_word", "suggested_correction", "rare_count", "correct_count", "edit_distance")
    substitutions = discovery.patterns(found).withColumnRenamed("meant", "right").select("wrong", "right", "count")
    return discovery.summary(counts), {
        "error_candidates": (candidates, [-F.col("rare_count"), F.col("rare_word")]),
        "substitution_patterns": (substitutions, [-F.col("count"), F.col("wrong"), F.col("right")]),
    }


def correction_report(pages: DataFrame, made: DataFrame, **more) -> DataFrame:
    """Pages, corrections and each kind of them; made: (original, corrected, count) and, if known, confidence. more: further values or one-row tables."""
    fields = [c for c in ("original", "corrected", "count", "confidence") if c in made.columns]
    spark = pages.sparkSession
    extra = {k: v if isinstance(v, DataFrame) else spark.range(1).select(F.lit(v)) for k, v in more.items()}
    # what is made is read once, for all three fields
    order = [-F.col("count"), F.col("original"), F.col("corrected")]
    sums = F.coalesce(F.sum("count"), F.lit(0)).alias("total_corrections"), F.count("*").alias("unique_error_types")
    one = made.agg(F.struct(*sums, _list(order, fields).alias("corrections_by_type")))
    row = side_by_side(total_pages_processed=pages.agg(F.count("*")), **extra, _made=one)
    return row.select("total_pages_processed", "_made.total_corrections", "_made.unique_error_types", *extra, "_made.corrections_by_type")


def error_statistics(by_type: DataFrame, top: DataFrame, total: DataFrame) -> DataFrame:
    """total_errors_found, errors_by_type (a map) and top_errors."""
    kinds = by_type.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("error_type", "n")))))
    return side_by_side(total_errors_found=total, errors_by_type=kinds, top_errors=_listed(top, [-F.col("count"), F.col("original")], ["original", "suggested", "count"]))


def hybrid_report(pages: DataFrame, summary: DataFrame, top: DataFrame, seconds: float | None = None) -> DataFrame:
    """statistics, summary and top_50_corrections; seconds: the run's time, where it was taken."""
    totals = side_by_side(pages_processed=pages.agg(F.count("*")), **{c: summary.select(c) for c in summary.columns})
    took = F.lit(seconds).cast("double")
    statistics = F.struct("pages_processed", "words_checked", "words_invalid", F.col("total_corrections").alias("corrections_applied"), took.alias("processing_time"), (F.col("pages_processed") / F.nullif(took, F.lit(0.0))).alias("pages_per_second"))
    both = totals.select(statistics.alias("statistics"), F.struct("total_corrections", "unique_correction_types").alias("summary"))
    return side_by_side(statistics=both.select("statistics"), summary=both.select("summary"), top_50_corrections=_listed(top, [-F.col("count"), F.col("correction")], ["correction", "count"]))


def timed(pages: DataFrame, write) -> dict:
    """Runs write(pages) and says how many pages went through it and how fast, counted on the way."""
    from pyspark.sql import Observation

    seen = Observation()
    began = time.time()
    write(pages.observe(seen, F.count(F.lit(1)).alias("pages")))
    took = time.time() - began
    return {"pages": seen.get["pages"], "seconds": took, "pages_per_second": seen.get["pages"] / took if took else 0.0}

"""Registered queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliowright.functions import fixed, text
from foliowright.operators import correct, discovery, headers, patterns, reports, rewrite, simjoin, speeches, spelling, vocab
from foliowright.plans.oracle import ORACLE
from foliowright.sources import pages as src


class Corpus:
    """The derived tables that queries share; each is a plan, computed where it is used.

    Those that one query reads several times are kept on the executors once they are found (kept_*),
    in memory or on their disks: else each reading counts all texts' words again, as filters on words
    go below the counting and leave no exchange to share.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
        self.docs, self.benchmark = read("documents"), read("benchmark")
        self.pages, self.derived = src.from_documents(self.docs), src.derived(self.docs)

    @property
    def counts(self) -> DataFrame:
        return vocab.word_counts(self.pages)

    @property
    def hyphen_counts(self) -> DataFrame:
        return vocab.word_counts(self.pages, hyphens=True)

    @cached_property
    def kept_counts(self) -> DataFrame:
        return self.counts.localCheckpoint(eager=False)

    @cached_property
    def kept_hyphen_counts(self) -> DataFrame:
        return self.hyphen_counts.localCheckpoint(eager=False)

    @property
    def listed(self) -> DataFrame:
        return self.benchmark.select(F.explode(text.words(F.col("text"))).alias("w")).select(F.lower("w").alias("word")).distinct()

    @property
    def dictionary(self) -> DataFrame:
        return self.listed.unionByName(vocab.high_frequency(self.kept_counts)).distinct()

    @property
    def candidates(self) -> DataFrame:
        return discovery.candidates(self.kept_counts)

    @cached_property
    def kept_candidates(self) -> DataFrame:
        return self.candidates.localCheckpoint(eager=False)

    @property
    def lookup(self) -> DataFrame:
        return correct.frequency_lookup(self.candidates)

    @property
    def unknown(self) -> DataFrame:
        return vocab.invalid(self.kept_counts, self.dictionary)

    @property
    def vocabulary(self) -> DataFrame:
        return vocab.vocabulary(self.pages, self.dictionary)

    @property
    def suggestions(self) -> DataFrame:
        return correct.suggestions(self.unknown, self.dictionary, self.vocabulary)

    @property
    def hybrid(self) -> DataFrame:
        return correct.hybrid_confidence(self.kept_hyphen_counts, self.dictionary)

    @property
    def paragraphs(self) -> DataFrame:
        return speeches.ordered_paragraphs(self.derived)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
QUERIES_OF: dict[str, Callable[[Corpus], DataFrame]] = {}


def query(build: Callable[[Corpus], DataFrame]):
    QUERIES_OF[build.__name__] = build
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Corpus(spark, sf_dir))
    return build


def _confidence():
    return F.round("confidence", 2).alias("confidence")


@query
def word_frequency(c):
    return c.counts


@query
def word_frequency_topk(c):
    return c.counts.orderBy(F.desc("n"), "word").limit(100)


@query
def hyphen_word_frequency(c):
    return c.hyphen_counts


@query
def corpus_totals(c):
    return vocab.totals(c.counts)


@query
def high_frequency_dictionary(c):
    return vocab.high_frequency(c.counts)


@query
def rare_words(c):
    return vocab.rare(c.counts)


@query
def rare_word_gates(c):
    return vocab.rare_gates(c.counts)


@query
def token_offsets(c):
    return vocab.token_positions(c.pages)


@query
def token_context(c):
    return vocab.token_contexts(c.pages)


@query
def similar_words_top5(c):
    return simjoin.best(discovery.similar(c.kept_counts), 5)


@query
def error_candidates(c):
    return c.candidates


@query
def error_candidates_top50(c):
    return discovery.most_frequent(c.candidates)


@query
def substitution_char_patterns(c):
    return discovery.character_patterns(c.candidates)


@query
def substitution_bigram_patterns(c):
    return discovery.bigram_patterns(c.candidates)


@query
def substitution_top100(c):
    return discovery.patterns(c.kept_candidates)


@query
def discovery_summary(c):
    return discovery.summary(c.counts)


@query
def frequency_lookup(c):
    return c.lookup.select("rare_word", "correct_word", _confidence())


@query
def frequency_lookup_top20(c):
    return c.lookup.select("rare_word", "correct_word", _confidence()).orderBy(F.desc("confidence"), "rare_word").limit(20)


def _pages(rows: DataFrame) -> DataFrame:
    return rows.select("index", "markdown", "n_corrections")


@query
def frequency_corrected_pages(c):
    return _pages(rewrite.rewrite(c.pages, correct.frequency_replacements(c.kept_counts, c.lookup)))


@query
def frequency_report(c):
    made = correct.frequency_replacements(c.kept_counts, c.lookup)
    return rewrite.report(c.kept_counts, made).join(made.select(F.col("word").alias("original"), _confidence()), "original")


@query
def report_gates(c):
    return correct.skipped(c.candidates)


@query
def discovery_report(c):
    row = reports.discovery_report(c.kept_counts, c.kept_candidates)
    counted = F.size("error_candidates").cast("long").alias("candidates"), F.get("error_candidates", F.lit(0))["rare_word"].alias("first_candidate"), F.get("substitution_patterns", F.lit(0))["count"].alias("commonest_pattern")
    return row.select("total_words", "unique_words", "high_frequency_words", "rare_words", *counted)


@query
def frequency_run_report(c):
    made = correct.frequency_replacements(c.kept_counts, c.lookup)
    rows = rewrite.report(c.kept_counts, made)
    row = reports.correction_report(c.pages, rows, confidence_threshold=0.85, available_corrections=c.lookup.agg(F.count("*")))
    return row.select("total_pages_processed", "total_corrections", "unique_error_types", "confidence_threshold", "available_corrections")


@query
def confusion_run_report(c):
    row = reports.correction_report(c.pages, correct.confusion_report(c.kept_counts, 0.85))
    first = F.get("corrections_by_type", F.lit(0))
    return row.select("total_pages_processed", "total_corrections", "unique_error_types", first["original"].alias("first_original"), first["corrected"].alias("first_corrected"))


@query
def confusion_exact_corrected_pages(c):
    return _pages(rewrite.rewrite(c.pages, correct.confusion_replacements(c.counts)))


@query
def confusion_substring_candidates(c):
    return correct.confusion_substrings(c.counts)


@query
def confusion_report(c):
    return correct.confusion_report(c.counts)


@query
def vocabulary_sampled(c):
    return c.vocabulary.select("word", "n")


@query
def unknown_words_anti_join(c):
    return c.unknown


@query
def edit_distance_suggestions_top3(c):
    rows = correct.edit_suggestions(c.unknown, c.vocabulary)
    return rows.select("word", "suggestion", _confidence(), (F.col("ord") - 99).cast("long").alias("rank"))


@query
def error_candidate_records(c):
    said = F.array_join(F.transform("suggestions", lambda s: F.concat(s["word"], F.lit(":"), F.format_string("%.2f", s["confidence"]))), "|")
    found = c.suggestions.select("word", F.array_join("error_types", "|").alias("error_types"), said.alias("suggestions"))
    rows = rewrite.occurrences(c.pages, found)
    return rows.select(F.col("index").alias("page_index"), "position", F.col("word").alias("original_word"), "error_types", "suggestions")


@query
def error_records(c):
    said = F.array_join(F.transform("suggested_corrections", lambda s: F.concat(s["word"], F.lit(":"), F.format_string("%.2f", s["confidence"]))), "|")
    rows = correct.error_records(c.pages, c.suggestions)
    return rows.select("page_index", "original_word", "position", F.array_join("error_types", "|").alias("error_types"), said.alias("suggestions"), "context")


@query
def position_edited_pages(c):
    """A word's first place in a page gets its replacement, later places the replacement in capitals."""
    found = rewrite.occurrences(c.pages, correct.confusion_replacements(c.counts, 0.85).select("word", "replacement"))
    edits = found.select("volume", "pos", "position", F.col("word").alias("original"), F.when(F.col("nth") == 1, F.col("replacement")).otherwise(F.upper("replacement")).alias("replacement"))
    return _pages(rewrite.splice(c.pages, edits))


@query
def pattern_contained_words(c):
    """Words of the corpus with a word of the benchmark inside, the first by letters in capitals."""
    table = c.listed.where(F.length("word") >= 4).select(F.col("word").alias("ord"), F.col("word").alias("pattern"), F.upper("word").alias("replacement"))
    return patterns.replaced(c.counts, table, shortest=4)


#: rules of a small affix dictionary: kind, flag, strip, add, condition
AFFIXES = (
    ("SFX", "S", "y", "ies", "[^aeiou]y"), ("SFX", "S", "", "s", "[^sxy]"), ("SFX", "S", "", "es", "[sx]"), ("SFX", "D", "", "d", "e"), ("SFX", "D", "", "ed", "[^ey]"),
    ("PFX", "U", "", "un", ""),
)


def _forms(c):
    """Forms of the benchmark's words, whose flags go by their lengths."""
    size = F.length("word")
    flags = F.array_compact(F.array(F.lit("S"), F.when(size % 2 == 0, "D"), F.when(size % 3 == 0, "U")))
    stems = c.listed.where(size >= 4).select(F.col("word").alias("stem"), flags.alias("flags"))
    rules = stems.sparkSession.createDataFrame([(k, f, True, s, a, [], w) for k, f, s, a, w in AFFIXES], "kind string, flag string, cross boolean, strip string, add string, more array<string>, condition string")
    return spelling.expand(stems, rules)


@query
def affix_forms(c):
    return _forms(c).select("word", "stem")


@query
def affix_suggestions_top3(c):
    forms = _forms(c)
    wrong = spelling.check(c.counts.where((F.col("n") <= 3) & F.col("word").rlike("^[a-z]{5,}$")), forms)
    return spelling.suggest(wrong, forms, k=3).select("word", "suggestion", "rank", F.round("score", 6).alias("score"))


@query
def auto_applied_pages(c):
    return _pages(rewrite.rewrite(c.pages, correct.applied(c.suggestions, 0.5)))


@query
def errors_by_type(c):
    rows = c.suggestions.join(c.kept_counts, "word").select(F.explode("error_types").alias("error_type"), "n")
    return rows.groupBy("error_type").agg(F.sum("n").alias("n"))


@query
def top_errors(c):
    rows = c.suggestions.join(c.kept_counts, "word").select(F.col("word").alias("original"), F.get("suggestions", F.lit(0))["word"].alias("suggested"), F.col("n").alias("count"))
    return rows.orderBy(F.desc("count"), "original").limit(50)


@query
def error_statistics(c):
    by_word = c.suggestions.join(c.kept_counts, "word")
    total = by_word.agg(F.coalesce(F.sum("n"), F.lit(0)))
    row = reports.error_statistics(QUERIES_OF["errors_by_type"](c), QUERIES_OF["top_errors"](c), total)
    return row.select("total_errors_found", F.element_at("errors_by_type", "unknown_word").alias("unknown_words"), F.size("top_errors").cast("long").alias("top_errors"))


@query
def hybrid_page_corrections(c):
    rows = rewrite.page_corrections(c.pages, correct.hybrid_replacements(c.hybrid), hyphens=True)
    return rows.select("index", "original", "correction", _confidence(), "count")


@query
def hybrid_confidence(c):
    return c.hybrid.select("word", "n", "suggestion", "suggestion_count", "edit_distance", _confidence())


@query
def hybrid_corrected_pages(c):
    return _pages(rewrite.rewrite(c.pages, correct.hybrid_replacements(c.hybrid), hyphens=True))


@query
def hybrid_summary(c):
    return correct.hybrid_summary(c.kept_hyphen_counts, c.dictionary, c.hybrid)


@query
def hybrid_top_corrections(c):
    rows = correct.hybrid_replacements(c.hybrid).join(c.kept_hyphen_counts, "word")
    return rows.select(F.concat_ws(" → ", "word", "replacement").alias("correction"), F.col("n").alias("count")).orderBy(F.desc("count"), "correction").limit(50)


@query
def entity_counts(c):
    return vocab.entities(c.derived)


def _first_line(c: Corpus) -> DataFrame:
    return c.derived.select("index", F.split("markdown", "\n", 2)[0].alias("line"))


@query
def date_header_flag(c):
    return _first_line(c).select("index", headers.is_date_header(F.col("line")).alias("is_date"))


@query
def house_header_fuzzy(c):
    return _first_line(c).select("index", headers.is_house_header(F.col("line")).alias("is_house"))


@query
def header_extracted_pages(c):
    return headers.extract_headers(c.derived).select("index", "header", "markdown")


@query
def header_count(c):
    return headers.extract_headers(c.derived).agg(F.count("*").alias("pages"), F.count("header").alias("headers"))


@query
def footer_removed_pages(c):
    return c.derived.select("index", headers.remove_footer(F.col("markdown")).alias("markdown"))


@query
def hyphen_joined_pages(c):
    return headers.process(c.derived).select("index", "header", "markdown")


@query
def paragraphs(c):
    return c.paragraphs.select("page", "para", "p")


@query
def house_headings(c):
    return c.paragraphs.select("page", "para", speeches.bare_house(F.col("p")).alias("house")).where("house IS NOT NULL")


@query
def latin_dates(c):
    return speeches.dated_heading(c.paragraphs).where("dated_house IS NOT NULL").select("page", "para", F.col("dated_house").alias("house"), "date_iso")


@query
def debate_titles(c):
    return c.paragraphs.where(speeches.is_title(F.col("p"))).select("page", "para", F.col("p").alias("title"))


@query
def multi_speaker_chunks(c):
    rows = c.paragraphs.where(~speeches.is_title(F.col("p"))).select("page", "para", F.posexplode(speeches.chunks(F.col("p"))).alias("chunk", "x"))
    return rows.select("page", "para", F.col("chunk").cast("long").alias("chunk"), "x.speaker", "x.text")


@query
def detected_speakers(c):
    return c.paragraphs.select("page", "para", speeches.detect_speaker(F.col("p")).alias("speaker")).where("speaker IS NOT NULL")


@query
def running_context(c):
    rows = speeches.with_context(speeches.events(speeches.by_blocks(c.derived)))
    return rows.select("page", "para", "chunk", F.col("cur_house").alias("house"), F.col("cur_date").alias("date_iso"), F.col("cur_title").alias("debate_title"))


@query
def speeches_(c):
    return speeches.speeches(c.derived).drop("volume").withColumn("pages", F.array_join(F.transform("pages", lambda p: p.cast("string")), "|"))


QUERIES["speeches"] = QUERIES.pop("speeches_")


@query
def speech_pages(c):
    return speeches.speeches(c.derived).select("id", F.explode("pages").alias("page"))


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.select("index", F.length("markdown").cast("long").alias("chars"))


@query
def page_sample_first_n(c):
    return _sizes(src.first_pages(c.pages, 100))


@query
def page_sample_every_10th(c):
    return _sizes(src.every_nth_page(c.pages))


def _varied(name: str) -> None:
    """The query of that name over the varied pages."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = Corpus(spark, sf_dir)
        c.derived = src.derived(c.docs, src.VARIED)
        return QUERIES_OF[name](c)

    QUERIES[f"varied_{name.rstrip('_')}"] = build


for _name in ("entity_counts", "house_header_fuzzy", "header_extracted_pages", "latin_dates", "detected_speakers", "multi_speaker_chunks", "running_context", "speeches_"):
    _varied(_name)

__all__ = ["ORACLE", "QUERIES", "fixed"]

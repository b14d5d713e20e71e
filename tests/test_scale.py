"""Work that must not be done several times, however a query is planned."""

import pytest
from pyspark.sql import functions as F

from foliowright.operators import correct, simjoin, speeches
from foliowright.plans import registry


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dates_of_headings_are_found_once(spark):
    # a filter on the house went below the columns that it is made from, each copied into it for each use
    rows = spark.createDataFrame([("HOUSE OF LORDS, MARTIS, 3° DIE JUII, 1834.",), ("HOUSE OF LORDS, MARTIS, 3° DIE, 1834.",), ("House of Commons, 4 Mail 1834 DIE",), ("no",)], "p string")
    found = speeches.dated_heading(rows).where("dated_house IS NOT NULL").select("dated_house", "date_iso")
    plan = _plan(found)
    assert plan.count("levenshtein") == 1 and len(plan) < 50_000
    assert {tuple(r) for r in found.collect()} == {("HOUSE OF LORDS", "1834-06-03"), ("HOUSE OF COMMONS", "1834-05-04")}


def test_words_of_common_syllables_do_not_meet(spark):
    # every two words of ten letters that end alike met at their last piece, so that pairs grew with the square of the words
    words = [a + b + "keit" for a in ("bun", "gel", "mor", "tis") for b in ("fap", "dro", "lux", "wen")]
    rows = spark.createDataFrame([(w, 20) for w in words], "word string, n long")
    keys = rows.select(F.explode(simjoin._own_keys(F.col("word"))).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    assert keys.agg(F.max("n")).first()[0] <= 4
    left = spark.createDataFrame([("bunfapkeid",), ("bunfapkt",), ("gelluxkeitxx",), ("Abunfapkeit",), ("b" * 15 + "xyz",)], "word string")
    right = rows.unionByName(spark.createDataFrame([("bunfapkeis", 30), ("b" * 15 + "xy", 1), ("b" * 14 + "xy", 1)], "word string, n long"))
    want = {(r.word, r.near, r.distance, r.n) for r in simjoin.best(simjoin.similar_words(left, right), 1).drop("rank").collect()}
    assert {(r.word, r.near, r.distance, r.n) for r in simjoin.closest(left, right).collect()} == want
    assert want == {("bunfapkeid", "bunfapkeis", 1, 30), ("bunfapkt", "bunfapkeit", 2, 20), ("gelluxkeitxx", "gelluxkeit", 2, 20), ("Abunfapkeit", "bunfapkeit", 1, 20), ("b" * 15 + "xyz", "b" * 15 + "xy", 1, 1)}


@pytest.mark.parametrize("name,most", [
    ("substitution_top100", 0), ("substitution_char_patterns", 0), ("substitution_bigram_patterns", 0), ("error_candidates_top50", 0), ("report_gates", 0), ("discovery_report", 0),
    ("confusion_run_report", 1), ("hybrid_page_corrections", 1), ("hybrid_corrected_pages", 2),
])
def test_words_are_counted_once(spark, name, most):
    # beside the counts, which are kept, pages are read for what is made of them only
    assert _plan(registry.QUERIES[name](spark, "/root/testdata/sf0.001")).count("Relation [doc_id") <= most


def test_trees_learn_from_all_documents(spark, monkeypatch):
    from foliowright.llm import pii

    # candidates of 20,000 documents were drawn, whatever their number
    given = []
    monkeypatch.setattr(pii, "Trees", lambda rows, held_out: given.extend([*rows, *held_out]))
    pii.fit(spark.range(60_000).select(F.concat(F.lit("call 555-0100-"), F.col("id").cast("string"), F.lit(" now")).alias("text")))
    phone = pii.MORE_KINDS.index("phone_like")
    assert sum(r[-2] + r[-1] for r in given if r[0] == phone) == 60_000


def test_confusions_are_found_once(spark):
    # three fields of the report each found them again, twice, and joined them with the counts
    plan = _plan(registry.QUERIES["confusion_run_report"](spark, "/root/testdata/sf0.001"))
    assert plan.count("LogicalRDD") == 1 and plan.count("Join") == 0
    counts = spark.createDataFrame([("tiie", 3), ("TIIE", 2), ("the", 9), ("atiie", 1), ("iu", 4), ("xiu", 5)], "word string, n long")
    got = {tuple(r) for r in correct.confusion_report(counts, 0.85).collect()}
    assert got == {("tiie", "the", 3), ("TIIE", "THE", 2), ("atiie", "athe", 1), ("iu", "in", 4)}
    assert {r.original for r in correct.confusion_report(counts).collect()} == {"tiie", "TIIE", "iu"}


def test_deleted_letters_are_dealt_by_generators(spark):
    # functions of arrays walked each word's letters uncompiled, which took most of the join's time
    from itertools import combinations

    words = ["a", "ab", "aab", "aabbab", "Keit", "sssss", "z" * 14 + "xyz", "q" * 10 + "abcdefghij"]
    rows = spark.createDataFrame([(w, 7) for w in words], "word string, n long")
    got = simjoin._probed(rows)
    assert _plan(got).count("lambda") <= _plan(got.where(F.length("word") > 18)).count("lambda") <= 4
    keys = {w: set() for w in words}
    for r in got.collect():
        assert r.n == 7
        keys[r.word].add(r.key)
    for w in words:
        low = w.lower()
        left = {"".join(c for i, c in enumerate(low) if i not in gone) for k in range(min(2, len(low)) + 1) for gone in combinations(range(len(low)), k)}
        want = {r[0] for r in spark.createDataFrame([(x,) for x in left], "x string").select(F.xxhash64("x")).collect()}
        if len(w) <= simjoin.SHORT - simjoin.RADIUS:
            assert keys[w] == want
        else:
            assert (want <= keys[w]) == (len(w) <= simjoin.SHORT + simjoin.RADIUS)

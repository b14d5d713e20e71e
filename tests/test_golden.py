"""Worked examples of the operators' rules."""

import json

import pytest
from pyspark.sql import functions as F

from foliowright.functions import text
from foliowright.operators import correct, discovery, headers, reports, rewrite, simjoin, speeches, vocab
from foliowright.sources import pages as src
from foliowright.sources import sinks

COLUMNS = "volume string, pos long, index long, global_index long, markdown string, header string"


def make_pages(spark, texts, volume="v"):
    return spark.createDataFrame([(volume, i, i, i, t, None) for i, t in enumerate(texts)], COLUMNS)


def markdowns(rows):
    return [r.markdown for r in rows.orderBy("pos").collect()]


@pytest.mark.parametrize("line,want", [
    ("FEBRUARY 4.1", True), ("February 5, 18", True), ("February 11.1", True), ("FEBRUARY 10.", True), ("MARCH 10, 1834.", True),
    ("May I", True), ("FEBRUARY", False), ("February the 4th", False), ("FEBRUARY. 4", False),
])
def test_date_header(spark, line, want):
    assert spark.createDataFrame([(line,)], "s string").select(headers.is_date_header(F.col("s"))).first()[0] is want


def test_house_header(spark):
    lines = {"HOUSE OF COMMONS, 110 181001": True, "HOUSE OF LOEDS": True, "HOUSE OF CORRECTION": True, "The House of Lords had": True, "HOUSES OF PARLIAMENT": False, "HOUSE": False}
    rows = spark.createDataFrame([(x,) for x in lines], "s string").select("s", headers.is_house_header(F.col("s")).alias("h")).collect()
    assert {r.s: r.h for r in rows} == lines


def test_header_extraction(spark):
    first = "HOUSE OF LORDS, MARTIS, 4° DIE FEBRUARII, 1834."
    pages = make_pages(spark, [f"\n {first}\n\n\nSELECT VESTRIES BILL.\n\nOn", "HOUSE OF COMMONS.\ntext", "HOUSE OF COMMONS."])
    rows = headers.extract_headers(pages).orderBy("pos").collect()
    assert (rows[0].header, rows[0].markdown) == (first, "SELECT VESTRIES BILL.\n\nOn")
    assert [(r.header, r.markdown) for r in rows[1:]] == [(None, "HOUSE OF COMMONS.\ntext"), (None, "HOUSE OF COMMONS.")]


@pytest.mark.parametrize("given,want", [
    ("body\n\nNo. XL.—Sess. 1834.\n\n", "body"), ("body\nNo. XII.—Sezs. 1834.", "body"), ("No. XL.—Sess. 1834.", "No. XL.—Sess. 1834."), ("x   ", "x"),
])
def test_footer(spark, given, want):
    assert spark.createDataFrame([(given,)], "s string").select(headers.remove_footer(F.col("s"))).first()[0] == want


@pytest.mark.parametrize("given,want", [
    (["so develop-", "ment in the proceedings"], ["so development", "in the proceedings"]),
    (["a-", "bc-", "de"], ["abc", "-", "de"]),
    (["x-", "Upper"], ["x-", "Upper"]), (["x-", "abcdefghijklmnop q"], ["x-", "abcdefghijklmnop q"]), (["", "a"], ["", "a"]),
])
def test_hyphen_join(spark, given, want):
    assert markdowns(headers.join_hyphens(make_pages(spark, given))) == want


def test_hyphen_join_equals_a_fold(spark):
    import random
    import re

    def fold(pages):
        pages = list(pages)
        for i in range(len(pages) - 1):
            prev, cur = pages[i], pages[i + 1]
            bare = cur.lstrip()
            m, f = re.search(r"(\S+)-\s*$", prev), re.match(r"[a-z]+", bare)
            if prev and cur and m and f and len(f.group()) <= 15:
                pages[i] = prev[: m.start()] + m.group(1) + f.group()
                rest = bare[f.end() :]
                pages[i + 1] = cur[: len(cur) - len(bare)] + rest if rest and not rest[0].isspace() else rest.lstrip()
        return pages

    rng = random.Random(1)
    cases = [["".join(rng.choice(["a", "b-", "-", " ", "C", "\n"]) for _ in range(rng.randrange(6))) for _ in range(rng.randrange(1, 8))] for _ in range(300)]
    rows = spark.createDataFrame([(f"{n}", i, i, i, t, None) for n, c in enumerate(cases) for i, t in enumerate(c)], COLUMNS)
    got = {}
    for r in headers.join_hyphens(rows).orderBy("pos").collect():
        got.setdefault(int(r.volume), []).append(r.markdown)
    assert [got[n] for n in range(len(cases))] == [fold(c) for c in cases]


def run_speeches(spark, *texts):
    return [r.asDict() for r in speeches.speeches(make_pages(spark, texts)).orderBy("id").collect()]


def test_speech_context_and_sessions(spark):
    got = run_speeches(
        spark, "lost\n\nHOUSE OF LORDS, MARTIS, 4° DIE FEBRUARII, 1834.\n\nCORN LAWS.\n\nMr. H. HANDLEY.—I ask.\n\nmore", "still\n\nNOTICES OF MOTIONS.\n\nagain\n\nHouse of Commons\n\ndropped",
        "lead\nMr. A. B.—One.\nSeveral Irish Members together.—No!\n\nSir ROBERT PEEL moved it",
    )
    assert [(s["house"], s["date_iso"], s["debate_title"], s["speaker"], s["pages"], s["text"]) for s in got] == [
        ("HOUSE OF LORDS", "1834-02-04", "CORN LAWS.", "Mr. H. HANDLEY.", [0, 1], "I ask.\n\nmore\n\nstill\n\nagain"),
        ("HOUSE OF COMMONS", "1834-02-04", "NOTICES OF MOTIONS.", "Mr. A. B.", [2], "One."),
        ("HOUSE OF COMMONS", "1834-02-04", "NOTICES OF MOTIONS.", "Several Irish Members together.", [2], "No!"),
        ("HOUSE OF COMMONS", "1834-02-04", "NOTICES OF MOTIONS.", "Sir ROBERT PEEL", [2], "Sir ROBERT PEEL moved it"),
    ]
    assert got[0]["id"] == "v_speech_000001"


@pytest.mark.parametrize("p,want", [
    ("Mr. SPRING RICE presented a Bill", "Mr. SPRING"), ("Sir ROBERT PEEL moved it", "Sir ROBERT PEEL"), ("Sir JOHN said he moved", "Sir JOHN said he"), ("nobody here", None),
])
def test_detected_speaker(spark, p, want):
    assert spark.createDataFrame([(p,)], "p string").select(speeches.detect_speaker(F.col("p"))).first()[0] == want


def test_latin_months(spark):
    rows = spark.createDataFrame([("HOUSE OF LORDS, LUNAE, 3° DIE JUII, 1834.",), ("HOUSE OF LORDS, 110 181001",)], "p string")
    assert [r.date_iso for r in speeches.dated_heading(rows).collect()] == ["1834-06-03", None]


def test_words(spark):
    row = spark.createDataFrame([("café w1 a_b don't land-owners x-",)], "s string")
    assert row.select(text.words(F.col("s"))).first()[0] == ["don", "t", "land", "owners", "x"]
    assert row.select(text.hyphen_words(F.col("s"))).first()[0] == ["don't", "land-owners", "x"]
    assert row.select(F.array_join(text.pieces(F.col("s"), True), "")).first()[0] == "café w1 a_b don't land-owners x-"


def test_static_table(spark):
    counts = spark.createDataFrame([("DUEX", 1), ("AUD", 2), ("DUEXES", 3), ("the", 4)], "word string, n long")
    assert {r.word: r.replacement for r in correct.confusion_replacements(counts).collect()} == {"DUEX": "DUKE", "AUD": "AND"}
    assert {r.word: (r.corrected, r.confidence) for r in correct.confusion_substrings(counts).collect()} == {"DUEXES": ("DUKEES", 0.85)}


@pytest.mark.parametrize("ratio,distance,n,want", [(50, 1, 30, 0.98), (20, 1, 30, 0.93), (10, 2, 30, 0.86), (50, 2, 29, 0.86), (20, 1, 29, 0.83), (9, 1, 100, 0.73)])
def test_frequency_confidence(spark, ratio, distance, n, want):
    row = spark.createDataFrame([(ratio, distance, n)], "r int, d int, n int")
    assert row.select(F.round(correct.frequency_confidence(F.col("r"), F.col("d"), F.col("n")), 2)).first()[0] == want


def test_frequency_rewrite(spark):
    pages = make_pages(spark, ["The THE teh, teh.", "nothing"])
    lookup = spark.createDataFrame([("teh", "the", 0.9)], "rare_word string, correct_word string, confidence double")
    made = correct.frequency_replacements(vocab.word_counts(pages), lookup)
    rows = rewrite.rewrite(pages, made).orderBy("pos").collect()
    assert [(r.markdown, r.n_corrections) for r in rows] == [("The THE the, the.", 2), ("nothing", 0)]


def test_similar_words_equal_brute_force(spark):
    import random

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcy") for _ in range(rng.randrange(1, 7)))
    left, right = sorted({word() for _ in range(60)}), sorted({word() for _ in range(60)})
    got = {(r.word, r.near, r.distance) for r in simjoin.similar_words(spark.createDataFrame([(x,) for x in left], "word string"), spark.createDataFrame([(x, 1) for x in right], "word string, n long")).collect()}
    want = {(a, b, d) for a in left for b in right if abs(len(a) - len(b)) <= 2 and abs(ord(a[0]) - ord(b[0])) <= 2 and 1 <= (d := distance(a, b)) <= 2}
    assert got == want


def test_long_similar_words_equal_brute_force(spark):
    import random

    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))

    def edited(w):
        for _ in range(rng.randrange(0, 4)):
            i, kind = rng.randrange(len(w)), rng.randrange(3)
            w = w[:i] + ("" if kind == 0 else rng.choice("abc")) + w[i + (kind < 2):]
        return w

    right = sorted({word(n) for n in range(7, 15) for _ in range(12)})
    left = sorted({edited(w) for w in right for _ in range(6)} | {"b" * 3000, ""})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    got = {(r.word, r.near, r.distance) for r in simjoin.similar_words(spark.createDataFrame([(x,) for x in left], "word string"), spark.createDataFrame([(x, 1) for x in right], "word string, n long")).collect()}
    near = [(a, b) for a in left for b in right if a and abs(len(a) - len(b)) <= 2 and abs(ord(a[0]) - ord(b[0])) <= 2]
    assert got == {(a, b, d) for a, b in near if 1 <= (d := distance(a, b)) <= 2}


def test_running_sums_are_linear_and_right(spark):
    import itertools

    sizes = [0, 1, 63, 64, 65, 200, 50_000]
    rows = spark.createDataFrame([(list(range(n)),) for n in sizes], "xs array<int>").select(text.running_sums(F.col("xs")).alias("s"), F.size("xs").alias("n")).collect()
    assert all(r.s == list(itertools.accumulate(range(r.n))) for r in rows)


def test_places_in_long_texts(spark):
    given = [None, "", "one", "é" * 130 + " two, " + "x1 " * 60_000 + "three"]
    pages = make_pages(spark, [g or "" for g in given])
    got = sorted((r["index"], r.position, r.word, r.context) for r in vocab.token_contexts(pages).collect())
    longest = given[3]
    want = [(2, 0, "one", "one")] + [(3, p, w, longest[max(0, p - 50) : p + 50]) for p, w in ((131, "two"), (len(longest) - 5, "three"))]
    assert got == want
    assert [(r.tok_pos, r.word) for r in vocab.token_positions(pages).where("index = 3").orderBy("tok_pos").collect()] == [(0, "two"), (1, "three")]


def test_rows_that_share_a_place(spark):
    pages = make_pages(spark, ["teh cat", "ok"])
    pages = pages.union(pages).union(pages.withColumn("markdown", F.lit("other teh")).withColumn("volume", F.lit(None).cast("string")))
    made = spark.createDataFrame([("teh", "the", 0.9)], "word string, replacement string, confidence double")
    got = sorted((r.markdown, r.n_corrections) for r in rewrite.rewrite(pages, made).collect())
    assert got == [("ok", 0)] * 2 + [("other the", 1)] * 2 + [("the cat", 1)] * 2
    listed = sorted((r.original, r.correction, r["count"]) for r in rewrite.page_corrections(pages, made).collect())
    assert listed == [("teh", "the", 1)] * 2 + [("teh", "the", 2)]


@pytest.mark.parametrize("p,want", [
    ("Mr. PEEL—He \x02said\x01 so", [("Mr. PEEL.", "He \x02said\x01 so")]),
    ("An Odd Members together—Yes\nSir A. B—No", [("An Odd Members together.", "Yes"), ("Sir A. B.", "No")]),
    ("An Odd Membership—Yes", []),
    ("An" + " Odd" * 5000 + " Members—Yes", [("An" + " Odd" * 5000 + " Members.", "Yes")]),
])
def test_speaker_chunks(spark, p, want):
    row = spark.createDataFrame([(p,)], "p string").select(speeches.chunks(F.col("p")).alias("c")).first()
    assert [(c.speaker, c.text) for c in row.c] == want


@pytest.mark.parametrize("p", [
    "Sir ROBERT PEEL—said", "Sir ROBERT-PEEL said", "Mr. A.B- text", "Mr. A-b text", "Lord JOHN. R-x Y-z w", "The Earl of A-B-C of D said", "An Honourable Member—x", "plain text", "Mr.- x", "The Duke of X - y",
])
def test_body_equals_the_pattern(spark, p):
    import re

    from foliowright.functions import fixed

    assert spark.createDataFrame([(p,)], "p string").select(speeches.body(F.col("p")).alias("b")).first().b == re.sub(fixed.HEADING_OF_BODY, "", p).strip()


def test_reports(spark, tmp_path):
    import json

    counts = spark.createDataFrame([("receive", 100), ("recieve", 2), ("Recieve", 1), ("THE", 50)], "word string, n long")
    found = discovery.candidates(counts)
    path = str(tmp_path / "report")
    sinks.write_report(reports.discovery_report(counts, found), path)
    text_of = "\n".join(r.value for r in spark.read.text(path).collect())
    told = json.loads(text_of)
    assert (told["total_words"], told["rare_words"], [c["rare_word"] for c in told["error_candidates"]]) == (153, 2, ["recieve", "Recieve"])
    assert told["substitution_patterns"]
    read_back = src.read_error_report(spark, path)
    assert sorted(map(tuple, read_back.collect())) == sorted(map(tuple, found.select(*read_back.columns).collect()))
    assert tuple(correct.skipped(found).first()) == (1, 0)
    lookup = correct.frequency_lookup(read_back)
    pages = make_pages(spark, ["recieve it", "nothing"])
    made = correct.frequency_replacements(counts, lookup)
    row = reports.correction_report(pages, rewrite.report(counts, made), confidence_threshold=0.85).first()
    assert (row.total_pages_processed, row.total_corrections, row.unique_error_types, row.confidence_threshold) == (2, 2, 1, 0.85)
    summary = spark.createDataFrame([(10, 2, 2, 1)], "words_checked long, words_invalid long, total_corrections long, unique_correction_types long")
    top = spark.createDataFrame([("a → b", 2)], "correction string, count long")
    hybrid = reports.hybrid_report(pages, summary, top, 2.0).first()
    assert hybrid.statistics.pages_per_second == 1.0 and hybrid.top_50_corrections[0]["count"] == 2
    assert reports.timed(pages, lambda rows: rows.write.parquet(str(tmp_path / "out")))["pages"] == 2
    none = reports.error_statistics(spark.createDataFrame([], "error_type string, n long"), spark.createDataFrame([], "original string, suggested string, count long"), spark.range(1).select(F.lit(0))).first()
    assert (none.total_errors_found, none.errors_by_type, none.top_errors) == (0, {}, [])


def test_word_list_lines_are_stripped(spark, tmp_path):
    (tmp_path / "words.txt").write_text("alpha\t\n \u00a0Beta\n\n")
    assert sorted(r.word for r in src.read_word_list(spark, str(tmp_path / "words.txt")).collect()) == ["alpha", "beta"]


def test_static_table_threshold(spark):
    counts = spark.createDataFrame([("xtbex", 1)], "word string, n long")
    assert correct.confusion_replacements(counts).count() == 0


def test_empty_tables(spark):
    pages = spark.createDataFrame([], COLUMNS)
    assert speeches.speeches(pages).count() == 0
    assert headers.process(pages).count() == 0
    assert discovery.summary(vocab.word_counts(pages)).first().asDict() == {"total_words": 0, "unique_words": 0, "high_frequency_words": 0, "rare_words": 0}


def test_readers_and_writers(spark, tmp_path):
    page = {"index": 3, "markdown": "a\nb"}
    (tmp_path / "one.json").write_text(json.dumps({"pages": [page, {"index": 4}], "title": "t"}))
    (tmp_path / "two.json").write_text(json.dumps([page]))
    (tmp_path / "bad.json").write_text(json.dumps({"rows": []}))
    rows = src.read_pages(spark, f"{tmp_path}/one.json").orderBy("pos").collect()
    assert [(r.volume, r.pos, r["index"], r.markdown) for r in rows] == [("one", 0, 3, "a\nb"), ("one", 1, 4, "")]
    assert src.read_pages(spark, f"{tmp_path}/two.json").count() == 1
    with pytest.raises(Exception, match="list of pages"):
        src.read_pages(spark, f"{tmp_path}/bad.json").count()
    (tmp_path / "words.txt").write_text("Apple\n\n pear \napple\n")
    assert sorted(r.word for r in src.read_word_list(spark, f"{tmp_path}/words.txt").collect()) == ["apple", "pear"]
    (tmp_path / "report.json").write_text(json.dumps({"error_candidates": [{"rare_word": "a", "suggested_correction": "b"}]}, indent=1))
    assert tuple(src.read_error_report(spark, f"{tmp_path}/report.json").first()) == ("a", "b", 0, 0, 999)
    said = json.loads(sinks.document_json(make_pages(spark, ["x", "é"])).first().json)
    assert [p["markdown"] for p in said["pages"]] == ["x", "é"]
    assert sinks.report_path("a/b.json") == "a/b-report.json"


def test_stream(spark, tmp_path):
    from foliowright.streaming import pages as stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"volume": "v", "pos": 0, "markdown": "HOUSE OF COMMONS.\n\nbody\nNo. I.—Sess. 1834."}) + "\n")
    query = stream.clean(stream.read_stream(spark, f"{tmp_path}/in")).writeStream.format("memory").queryName("cleaned").start()
    query.processAllAvailable()
    query.stop()
    assert [(r.header, r.markdown) for r in spark.table("cleaned").collect()] == [("HOUSE OF COMMONS.", "body")]


def test_long_lines_of_names(spark):
    names = " NAME" * 20000
    rows = spark.createDataFrame([("Sir" + names + " moved it",), ("Sir" + names,), ("An" + " Odd" * 20000,), ("\n" * 20000 + "x",)], "p string")
    got = [r.s and len(r.s) for r in rows.select(speeches.detect_speaker(F.col("p")).alias("s")).collect()]
    assert got == [3 + len(names), 8, None, None]
    assert rows.select(speeches.chunks(F.col("p")), speeches.body(F.col("p")), text.paragraphs(F.col("p"))).count() == 4
    pages = make_pages(spark, [r.p for r in rows.collect()])
    assert headers.process(pages).count() == 4
    assert speeches.speeches(pages).count() >= 0

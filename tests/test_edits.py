"""Edits by position, patterns inside words, and records of errors."""

import random

import pytest
from pyspark.sql import functions as F

from foliowright.operators import correct, patterns, rewrite

COLUMNS = "volume string, pos long, index long, global_index long, markdown string, header string"
EDITS = "volume string, pos long, position long, original string, replacement string"


def spliced(text, edits):
    """Kept left to right, made right to left."""
    kept, end = [], 0
    for p, original, new in sorted({e for e in edits if None not in e}, key=lambda e: (e[0], -len(e[1]), e[1], e[2])):
        if p >= 0 and text[p : p + len(original)] == original and p + len(original) <= len(text) and p >= end:
            kept.append((p, original, new))
            end = p + len(original)
    for p, original, new in reversed(kept):
        text = text[:p] + new + text[p + len(original) :]
    return text, len(kept)


def test_splice_equals_plain(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["ab", "é", "😀", " ", "word", "\n"]) for _ in range(rng.choice([0, 3, 40, 600]))) for _ in range(40)] + ["", "x" * 1000]
    edits = {}
    for i, t in enumerate(texts):
        edits[i] = [(p, t[p : p + rng.randrange(4)], rng.choice(["", "NEW", "é"])) for p in (rng.randrange(len(t) + 1) for _ in range(rng.choice([0, 1, 5, 200])))]
        edits[i] += [(0, "not there", "x"), (10_000, "a", "b"), (-1, "a", "b"), (2, None, "x"), (1, "b", None)]
    edits[0] += edits[0]
    pages = spark.createDataFrame([("v", i, i, i, t, None) for i, t in enumerate(texts)] + [("w", 0, 0, 0, None, None)], COLUMNS)
    table = spark.createDataFrame([("v", i, *e) for i, es in edits.items() for e in es], EDITS)
    got = {(r["volume"], r["pos"]): (r.markdown, r.n_corrections) for r in rewrite.splice(pages, table).collect()}
    assert got.pop(("w", 0)) == ("", 0)
    for i, t in enumerate(texts):
        assert got["v", i] == spliced(t, edits[i]), i


def test_two_edits_of_one_word(spark):
    pages = spark.createDataFrame([("v", 0, 7, 7, "tho cat, tho dog", None)], COLUMNS)
    edits = spark.createDataFrame([("v", 0, 0, "tho", "the"), ("v", 0, 9, "tho", "that"), ("v", 0, 4, "cat,", "")], EDITS)
    assert rewrite.splice(pages, edits).first().asDict() == {"volume": "v", "pos": 0, "index": 7, "markdown": "the  that dog", "n_corrections": 3}


def test_occurrences(spark):
    import re

    rng = random.Random(3)
    texts = [" ".join(rng.choice(["aa", "bb", "c'c", "éa", "dd."]) for _ in range(n)) for n in (0, 1, 7, 300)]
    pages = spark.createDataFrame([("v", i, i, i, t, None) for i, t in enumerate(texts)], COLUMNS)
    lookup = spark.createDataFrame([("aa", 1, ["x"]), ("c", 2, None), ("zz", 3, [])], "word string, k int, l array<string>")
    got = sorted((r["index"], r.position, r.word, r.nth, r.k, r.context) for r in rewrite.occurrences(pages, lookup, 5).collect())
    want = []
    for i, t in enumerate(texts):
        seen = {}
        for m in re.finditer(r"\b[A-Za-z]+\b", t):
            if m.group() in ("aa", "c"):
                seen[m.group()] = seen.get(m.group(), 0) + 1
                want.append((i, m.start(), m.group(), seen[m.group()], 1 if m.group() == "aa" else 2, t[max(0, m.start() - 5) : m.start() + 5]))
    assert got == sorted(want)


@pytest.mark.parametrize("gram", [1, 3])
def test_patterns_equal_a_nested_loop(spark, gram):
    rng = random.Random(gram)
    make = lambda n: "".join(rng.choice("abé") for _ in range(rng.randrange(1, n)))
    words = sorted({make(9) for _ in range(300)}) + [None, ""]
    table = [(i, make(5), make(3)) for i in range(120)] + [(500, "", "x"), (501, None, "y"), (502, "zzz", "y")]
    table += [table[0]]
    w, p = spark.createDataFrame([(x,) for x in words], "word string"), spark.createDataFrame(table, "ord int, pattern string, replacement string")
    got = sorted((r.word, r.pattern, r.ord) for r in patterns.containing(w, p, gram).collect())
    assert got == sorted((x, q, i) for x in words if x for i, q, _ in table if q and q in x)
    firsts = {r.word: (r.pattern, r.corrected) for r in patterns.replaced(w, p, gram).collect()}
    for x in words:
        best = min(((i, q, new) for i, q, new in table if x and q and q in x), default=None)
        assert firsts.get(x) == (best and (best[1], x.replace(best[1], best[2])))


def test_ten_thousand_patterns(spark):
    words = spark.range(20_000).select(F.format_string("w%05dx", F.col("id") * 7 % 99_991).alias("word"))
    table = spark.range(10_000).select(F.col("id").alias("ord"), F.format_string("%04d", "id").alias("pattern"), F.lit("#").alias("replacement"))
    out = patterns.containing(words, table, shortest=4)
    assert out.count() == words.crossJoin(table).where("contains(word, pattern)").count()


def test_table_of_a_caller_equals_the_fixed_one(spark):
    from foliowright.functions import fixed

    words = spark.createDataFrame([(w, 1) for w in ("theu", "THEU", "wheuever", "couutry", "aud", "laudable", "thau", "thauk", "plain")], "word string, n long")
    table = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(fixed.CONFUSIONS)], "ord int, pattern string, replacement string")
    assert sorted(correct.table_substrings(words, table).collect()) == sorted(correct.confusion_substrings(words).collect())


def test_error_records_written_and_read(spark, tmp_path):
    from foliowright.sources import sinks

    pages = spark.createDataFrame([("v", 0, 4, 4, "so tiie end of tiie day", None)], COLUMNS)
    found = spark.createDataFrame([("tiie", ["unknown_word", "confusion_pattern"], [("the", 0.85)])], "word string, error_types array<string>, suggestions array<struct<word:string,confidence:double>>")
    rows = correct.error_records(pages, found)
    path = str(tmp_path / "errors")
    sinks.write_lines(rows, path)
    back = spark.read.schema(rows.schema).json(path).orderBy("position").collect()
    assert back == rows.orderBy("position").collect()
    assert [(r.page_index, r.position, r.context, r.suggested_corrections[0].word) for r in back] == [(4, 3, "so tiie end of tiie day", "the"), (4, 15, "so tiie end of tiie day", "the")]

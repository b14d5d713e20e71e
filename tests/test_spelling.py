"""Affix dictionaries: files, expansion, validity and suggestions."""

import itertools
import random
import re

import pytest

from foliowright.operators import spelling
from foliowright.sources import affixes

AFF = """# a comment
SET UTF-8
TRY esianrt
NEEDAFFIX X
FORBIDDENWORD !
NOSUGGEST Q

REP 3
REP f ph
REP ^kn n
REP shun$ tion

PFX A Y 1
PFX A 0 re . # again
PFX U N 1
PFX U 0 un [^u]

SFX B Y 3
SFX B 0 ed [^ey]
SFX B 0 d e
SFX B y ied [^aeiou]y
SFX S Y 1
SFX S 0 s .
SFX N Y 1
SFX N 0 ness/S .
SFX M N 1
SFX M 0 ment .
"""
DIC = """9
carry/AB
load/ABSU
kind/NU
phrase/S\tpo:noun
station
bad/QS
only/XS
unload/!
and\\/or
agree/M po:verb
"""


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("dictionary")
    (folder / "x.aff").write_text(AFF)
    (folder / "x.dic").write_text(DIC)
    return str(folder / "x.aff"), str(folder / "x.dic")


@pytest.fixture(scope="module")
def forms(spark, files):
    aff, dic = files
    return spelling.expand(affixes.read_stems(spark, dic, affixes.flag_kind(spark, aff)), affixes.read_rules(spark, aff), affixes.read_roles(spark, aff)).cache()


def test_golden_forms(forms):
    assert sorted({r.word for r in forms.collect()}) == sorted([
        "carry", "carried", "recarry", "recarried", "load", "loaded", "loads", "reload", "reloaded", "reloads", "kind", "kindness", "kindnesss", "unkind",
        "phrase", "phrases", "station", "bad", "bads", "onlys", "and/or", "agree", "agreement",
    ])
    assert {r.word for r in forms.where("quiet").collect()} == {"bad", "bads"}


def test_validity(spark, forms):
    words = spark.createDataFrame([(w,) for w in ("load", "Loaded", "RELOADS", "lOad", "unload", "only", "kindnesses", "Unkind", "and/or", "", None)], "word string")
    assert sorted(str(r.word) for r in spelling.check(words, forms).collect()) == sorted(["", "None", "lOad", "kindnesses", "only", "unload"])


def test_suggestions(spark, files, forms):
    table = affixes.read_replacements(spark, files[0])
    words = spark.createDataFrame([(w,) for w in ("frase", "Frase", "LOAED", "stashun", "baad", "knkind", "zzzzzz", "", None, "loadz")], "word string")
    got = {}
    for r in spelling.suggest(words, forms, table).orderBy("word", "rank").collect():
        got.setdefault(r.word, []).append((r.suggestion, r.kind))
    assert got["frase"] == [("phrase", "replacement")] and got["Frase"] == [("Phrase", "replacement")]
    assert got["stashun"] == [("station", "replacement")]
    # both at one edit; the likelier by its pieces first
    assert got["LOAED"][:2] == [("LOADED", "edit"), ("LOAD", "edit")]
    assert got["loadz"][:2] == [("load", "edit"), ("loads", "edit")] or got["loadz"][:2] == [("loads", "edit"), ("load", "edit")]
    assert "baad" not in got and "zzzzzz" not in got and "" not in got
    assert [s for s, _ in got["knkind"]] == ["kind"]


@pytest.mark.parametrize("kind,text,want", [("char", "AbÉ", ["A", "b", "É"]), ("long", "AaBb", ["Aa", "Bb"]), ("num", "1,22,1", ["1", "22"]), ("char", None, [])])
def test_flags(spark, kind, text, want):
    from pyspark.sql import functions as F

    assert spark.createDataFrame([(text,)], "t string").select(affixes.flags(F.col("t"), kind)).first()[0] == want


def test_expansion_equals_a_loop(spark):
    rng = random.Random(8)
    letters = "aby"
    rules = [(rng.choice(["PFX", "SFX"]), f, rng.random() < 0.6, rng.choice(["", "", "a", "y"]), rng.choice(["", "x", "ya"]), rng.sample("CDE", rng.randrange(2)), rng.choice(["", "a", "[^y]", "[ab]y"])) for f in "ABCDE" for _ in range(3)]
    # all rules of a flag are of one kind and cross alike, as in a file
    rules = [(next(r[0] for r in rules if r[1] == f), f, next(r[2] for r in rules if r[1] == f), *rest) for _, f, _, *rest in rules]
    stems = sorted({("".join(rng.choice(letters) for _ in range(rng.randrange(1, 5))), tuple(sorted(rng.sample("ABCDE", rng.randrange(4))))) for _ in range(40)})

    def use(word, flags, kind):
        for k, f, cross, strip, add, more, cond in rules:
            if k == kind and f in flags and len(word) > len(strip):
                if kind == "SFX" and word.endswith(strip) and re.search(f"(?:{cond})$", word):
                    yield word[: len(word) - len(strip)] + add, set(more), cross
                if kind == "PFX" and word.startswith(strip) and re.match(cond, word):
                    yield add + word[len(strip) :], set(more), cross

    want = set()
    for stem, flags in stems:
        bare = [(stem, set(), True)]
        once = [(w, m, c) for w, m, c in use(stem, flags, "SFX")]
        twice = [(w, m, c and c2) for w1, m1, c in once for w, m, c2 in use(w1, m1, "SFX")]
        want |= {(w, stem) for w, *_ in bare + once + twice}
        for w, m, c in bare + once + twice:
            for made, _, cross in use(w, set(flags) | m, "PFX"):
                if w == stem or (c and cross):
                    want.add((made, stem))
    frame = spark.createDataFrame([(s, list(f)) for s, f in stems], "stem string, flags array<string>")
    table = spark.createDataFrame(rules, "kind string, flag string, cross boolean, strip string, add string, more array<string>, condition string")
    assert {(r.word, r.stem) for r in spelling.expand(frame, table).collect()} == want
    assert list(itertools.islice(want, 1))

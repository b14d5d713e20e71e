"""Stages that return the columns of documents: clashing names, repeated ids, nulls."""

import pytest

import corpus_pipeline
from foliowright.llm import decontaminate, mixing, simhash

NAMES = ("_text", "_text2", "_nth", "_source", "_tokens", "_found", "_kept", "probability", "k", "fp", "who", "lang_pred", "score", "fingerprint", "component_id", "n_words", "contaminated", "h1", "_h1", "topic")
LONG = "one two three four five six seven eight nine ten eleven twelve"


def frame(spark, rows):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in NAMES)
    return spark.createDataFrame([(*r, "x", len(r[1] or ""), *NAMES) for r in rows], kinds)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, [(1, LONG, "en"), (2, LONG.upper(), "en"), (3, "quite another text here", "en"), (None, LONG, None), (4, None, None), (5, "", "en"), (6, "un texte autre et bref", "fr")])


def test_near_duplicates_keep_columns(spark, docs):
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "3", "4", "6", "None"]
    assert all(r[c] == c for r in rows for c in NAMES)


def test_repeated_ids_are_told_apart_by_their_texts(spark):
    rows = [(1, LONG, "en"), (2, LONG, "en"), (2, "quite another text here", "en"), (2, "quite another text here", "en"), (3, "quite another text here", "en")]
    kept = simhash.keep_one(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, LONG), (2, "quite another text here")]


def test_decontamination_keeps_columns(spark, docs):
    bench = spark.createDataFrame([(1, LONG, "x")], "item_id long, text string, hash string")
    for bound in (decontaminate.BROADCAST, 0):
        out = decontaminate.drop_contaminated(docs, bench, broadcast=bound)
        assert out.columns == docs.columns
        rows = out.collect()
        assert sorted(str(r.doc_id) for r in rows) == ["3", "4", "5", "6"]
        assert all(r[c] == c for r in rows for c in NAMES)


def test_mixing_keeps_columns(spark, docs):
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert {r[c] == c for r in out.collect() for c in NAMES} == {True}
    assert mixing.weighed(docs).columns == ["doc_id", "_source", "_lang", "_topic", "_tokens", "_probability", "_kept"]


def test_language_stage_keeps_columns(spark, docs):
    out = corpus_pipeline.keep_known_languages(spark, docs, "")
    assert out.columns == docs.columns
    rows = out.collect()
    assert not {4, 5} & {r.doc_id for r in rows}
    assert all(r[c] == c for r in rows for c in NAMES)

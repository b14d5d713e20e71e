"""The pipeline's near-duplicate stage against brute-force Jaccard similarity of word shingles."""

import random
import re

import pytest

import corpus_pipeline
from foliowright.llm import near_copies, simhash


def plain_shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_components(sets):
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = []
    for i in range(len(sets)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                pairs.append((j, i))
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(sets))], pairs


def texts():
    rng = random.Random(8)
    prose = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    out = [None, "", "one", "One", "a b c d", "a b c d e", "a b c d e f"]
    for size, copies in ((60, 6), (250, 40), (900, 8)):
        base = prose(size)
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(max(2, size // 40))):
                words[rng.randrange(size)] = f"new{rng.randrange(999)}"
            out.append(" ".join(words))
        # ends cut, so that similarities lie on both sides of the bound
        out += [" ".join(base[: size * k // 100]) for k in (75, 79, 80, 81, 85, 90)]
    boiler = prose(40)
    out += [" ".join(boiler + prose(n)) for n in (1, 2, 5, 9, 10, 11, 30, 200)]
    return out + [" ".join(prose(rng.randrange(5, 150))) for _ in range(40)]


@pytest.fixture(scope="module")
def docs(spark):
    own = texts()
    return spark.createDataFrame([(i, t) for i, t in enumerate(own)], "doc_id long, text string").repartition(3), own


def test_stage_keeps_one_of_each_component(spark, docs):
    frame, own = docs
    roots, pairs = plain_components([plain_shingles(t) for t in own])
    # the stage's rule is wider than op10's radius
    assert any(bin(simhash.fingerprint((own[i] or "").encode()) ^ simhash.fingerprint((own[j] or "").encode())).count("1") > 4 for i, j in pairs)
    kept = corpus_pipeline.keep_one_of_each(spark, frame, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted({min(i for i, r in enumerate(roots) if r == k) for k in roots})


@pytest.mark.parametrize(("crowd", "rounds"), [(3, 2), (3, 0)])
def test_crowded_shingles(spark, docs, monkeypatch, crowd, rounds):
    monkeypatch.setattr(near_copies, "ROUNDS", rounds)
    frame, own = docs
    roots, _ = plain_components([plain_shingles(t) for t in own])
    got = {r.doc_id: r.component_id for r in near_copies.near_duplicates(frame, crowd=crowd).collect()}
    assert got == {i: roots.index(k) for i, k in enumerate(roots)}


def test_no_documents(spark, docs):
    assert near_copies.near_duplicates(docs[0].where("false")).count() == 0


def test_simhash_links_come_first(spark, docs, monkeypatch):
    frame, own = docs
    asked = []
    monkeypatch.setattr(near_copies.simhash, "links", lambda fps, links=simhash.links: asked.append(fps.count()) or links(fps))
    monkeypatch.setattr(near_copies, "_few", lambda groups: spark.createDataFrame([], "a long, b long, n int, m int"))
    got = {r.doc_id: r.component_id for r in near_copies.near_duplicates(frame, crowd=10**6).collect()}
    roots, pairs = plain_components([plain_shingles(t) for t in own])
    # without the pairs of prefixes, those within the radius are still linked, and no others
    close = [p for p in pairs if bin(simhash.fingerprint((own[p[0]] or "").encode(), 5) ^ simhash.fingerprint((own[p[1]] or "").encode(), 5)).count("1") <= simhash.RADIUS]
    assert len(asked) == 1 and asked[0] > 100
    assert any(i in got and got[i] == got[j] and own[i] != own[j] for i, j in close)
    assert all(roots[i] == roots[c] for i, c in got.items())

"""Scans over one volume on two levels: the same for any block, and on many tasks."""

import random
import re

import pytest

from foliowright.functions import fuzzy
from foliowright.functions.fixed import LATIN_MONTHS
from foliowright.operators import headers, speeches

COLUMNS = "volume string, pos long, index long, global_index long, markdown string, header string"


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


@pytest.mark.parametrize("block", [1, 7, 512])
def test_one_volume_equals_a_fold(spark, block):
    rng = random.Random(block)
    pages = ["".join(rng.choice(["a", "b-", "-", " ", "C", "\n"]) for _ in range(rng.randrange(6))) if rng.random() < 0.4 else rng.choice(["ab-", "b-", "c-\n", "x y-"]) for _ in range(2500)]
    rows = spark.createDataFrame([("v", i, i, i, t, None) for i, t in enumerate(pages)], COLUMNS).repartition(5)
    got = {r.pos: r.markdown for r in headers.join_hyphens(rows, block).collect()}
    assert [got[i] for i in range(len(pages))] == fold(pages)


def random_pages(seed, n):
    rng = random.Random(seed)
    parts = ["HOUSE OF LORDS, MARTIS, 4° DIE FEBRUARII, 1834.", "HOUSE OF COMMONS.", "CORN LAWS.", "Mr. A. B.—One.", "Mr. C. D.—", "Sir ROBERT PEEL moved it", "just text", "more text here", "lead\nMr. E. F.—Two.\nMr. G. H.—Three."]
    texts = ["\n\n".join(rng.choice(parts) for _ in range(rng.choice([0, 0, 1, 1, 2, 4]))) for _ in range(n)]
    places = [rng.choice([None, i, n - i, 5]) for i in range(n)]
    return [("v" if i % 5 else "w", i, places[i], rng.choice([None, places[i]]), t, None) for i, t in enumerate(texts)]


def in_order(pages):
    """Speeches by a plain walk over one group's events, from those of a single block."""
    return sorted((r.volume, r.id, r.house, r.date_iso, r.debate_title, r.speaker, tuple(r.pages), r.text) for r in pages)


def walked(spark, rows):
    """(volume, n, house, date, title, speaker, text) by a loop over the events."""
    events = speeches.events(spark.createDataFrame(rows, COLUMNS)).collect()
    out, state = [], {}
    for e in sorted(events, key=lambda e: (e.volume, e.ord, e.pos, e.para, e.chunk)):
        s = state.setdefault(e.volume, {"house": None, "date_iso": None, "title": None, "open": None, "n": 0})
        s.update({c: e[c] for c in ("house", "date_iso", "title") if e[c] is not None})
        if e.speaker is not None:
            s["open"] = [e.volume, None, s["house"], s["date_iso"], s["title"], e.speaker, []]
            out.append(s["open"])
        elif e.kind in ("dated", "house"):
            s["open"] = None
        if s["open"] is not None and e.text:
            s["open"][6].append(e.text)
    rows = [r for r in out if r[6]]
    count = {}
    for r in rows:
        count[r[0]] = count.get(r[0], 0) + 1
        r[1], r[6] = f"{r[0]}_speech_{count[r[0]]:06d}", "\n\n".join(r[6])
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("span", [1, 3, 50, 10**9])
def test_speeches_equal_a_walk(spark, span):
    rows = random_pages(span, 240)
    got = speeches.speeches(spark.createDataFrame(rows, COLUMNS).repartition(4), span).collect()
    assert sorted(((r.volume, r.id, r.house, r.date_iso, r.debate_title, r.speaker, r.text) for r in got), key=str) == walked(spark, rows)


def test_no_task_holds_a_volume(spark):
    """Pages of one volume come out of several tasks, and texts are never sorted by volume alone."""
    rows = spark.createDataFrame([("v", i, i, i, f"Mr. A. B.—Text {i} de-", None) for i in range(2000)], COLUMNS).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for out in (speeches.with_context(speeches.events(rows), 16), headers.broken_words(headers.extract_headers(rows), 16)):
            sizes = out.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
            assert max(sizes) <= 0.6 * sum(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plan = speeches.speeches(rows)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window" in line and "text" in line:
            assert "_block" in line


def mutated(rng, word, letters):
    word = list(word)
    for _ in range(rng.randrange(6)):
        at, kind = rng.randrange(len(word) + 1), rng.random()
        if kind < 0.4 and word:
            word.pop(min(at, len(word) - 1))
        else:
            word.insert(at, rng.choice(letters))
    return "".join(word)


def test_ratio_equals_the_standard_library(spark):
    from difflib import SequenceMatcher

    from pyspark.sql import functions as F

    rng = random.Random(4)
    starts = [mutated(rng, rng.choice(["HOUSE OF LORDS", "HOUSE OF COMMONS", "HOUSE OF CORRECTION"]), "HOUSEFLRDCMN ,.")[:17] for _ in range(120)] + ["", "HOUSE", "ÉTÉ 😀 OF LORDS"]
    tokens = [mutated(rng, rng.choice(LATIN_MONTHS), "IVXUN") for _ in range(len(starts) - 3)] + ["JUII", "X" * 70, "JUNTI"]
    frame = spark.createDataFrame(list(zip(starts, tokens)), "s string, t string")
    for r in frame.select("*", fuzzy.ratio(F.col("s"), F.col("t")).alias("r"), fuzzy.house_like(F.col("s")).alias("h"), fuzzy.latin_month(F.col("t")).alias("m")).collect():
        assert r.r == SequenceMatcher(None, r.s, r.t).ratio()
        assert r.h == any(SequenceMatcher(None, r.s[:n], house).ratio() >= 0.75 for n, house in ((15, "HOUSE OF LORDS"), (17, "HOUSE OF COMMONS")))
        near = max((x for x in ((SequenceMatcher(None, m, r.t).ratio(), m) for m in LATIN_MONTHS) if x[0] >= 0.5), default=None)
        assert r.m == (near and LATIN_MONTHS.index(near[1]) + 1)


def test_no_python_in_header_and_date_plans(spark):
    rows = spark.createDataFrame([("v", 0, 0, 0, "HOUSE OF LOEDS.\n\ntext", None)], COLUMNS)
    for out in (headers.process(rows), speeches.speeches(rows)):
        assert "Python" not in out._jdf.queryExecution().executedPlan().toString()

"""Window operators against brute force: substring dedup, decontamination, SimHash."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from foliowright.llm import decontaminate, simhash, substring_dedup

RNG = random.Random(4)
VOCAB = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(60)]
PASSAGE = " ".join(RNG.choice(VOCAB) for _ in range(50))


def prose(n):
    return RNG.choice([" ", "\n", "  "]).join(RNG.choice(VOCAB) for _ in range(n))


def documents():
    out = [None, "", " \n\t ", "one", prose(34), prose(35), PASSAGE, PASSAGE, "x " + PASSAGE, prose(60) + " " + PASSAGE + " " + prose(40), " ".join(["a"] * 90), PASSAGE[: len(PASSAGE) // 2] + " q " + PASSAGE]
    long = prose(3000)
    return [*out, long, prose(20) + " " + long[300:9000] + " " + prose(5), *(prose(RNG.randrange(5, 120)) for _ in range(30))]


@pytest.fixture(scope="module")
def docs(spark):
    texts = documents()
    rows = [(i, t, "n", "s") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (6, texts[6], "n", "s"), (None, texts[9], None, None)], "doc_id long, text string, n_words string, spans string"), texts


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("hot", [1000, 0])
def test_substring_dedup(spark, docs, hot):
    frame, texts = docs
    rows = [(r.doc_id, words_of(r.text)) for r in frame.collect()]
    seen = {}
    for _, w in rows:
        for i in range(len(w) - 34):
            key = tuple(w[i : i + 35])
            seen[key] = seen.get(key, 0) + 1
    want = []
    for k, w in rows:
        gone = {i + j for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for j in range(35)}
        want.append((k, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(frame, hot_rows=hot).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(n for _, _, n, _ in got)


def brute_hits(text, items):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    w, hit, ids = find(text), set(), set()
    for k, item in items:
        v = find(item)
        n = min(10, len(v))
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                if k is not None:
                    ids.add(str(k))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("limit", [100_000, 0])
def test_decontamination(spark, docs, limit):
    frame, texts = docs
    items = [(1, PASSAGE.upper()), (22, "W3, w5!"), (3, ""), (4, None), (5, " ".join(words_of(texts[12])[100:112])), (6, PASSAGE), (6, PASSAGE), (None, "one"), (10, " ".join(["a"] * 10))]
    bench = spark.createDataFrame([(k, t, "extra") for k, t in items], "item_id long, text string, seed string")
    got = [tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in decontaminate.contamination(frame, bench, broadcast=limit).collect()]
    want = [(r.doc_id, *brute_hits(r.text, items)) for r in frame.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = decontaminate.drop_contaminated(frame, bench, broadcast=limit)
    assert kept.columns == frame.columns
    assert kept.count() == sum(not w[-1] for w in want)


def test_empty_tables(spark, docs):
    frame, _ = docs
    none, bench = frame.where("false"), spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup.remove_repeats(none).count() == 0
    assert decontaminate.contamination(none, bench).count() == 0
    assert not decontaminate.contamination(frame, bench).where("contaminated").count()
    assert simhash.near_duplicates(none).count() == 0


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


def test_simhash_documents(spark, docs):
    frame, _ = docs
    rows = frame.collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    roots = plain_components(fps)
    least = {}
    for r, k in zip(rows, roots):
        if r.doc_id is not None:
            least[k] = min(least.get(k, r.doc_id), r.doc_id)
    want = [(r.doc_id, f"{f:016x}", least.get(k)) for r, f, k in zip(rows, fps, roots)]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(frame).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(least.values()))


@pytest.mark.parametrize("limit", [4096, 3])
def test_links_within_dense_groups(spark, limit):
    rng = random.Random(limit)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for center in [rng.getrandbits(64), 0, (1 << 64) - 1]:
        for _ in range(40):
            fps.add(center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    from foliowright.llm.components import components

    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), cell_limit=limit)
    of = {r.node: r.component for r in components(edges).collect()}
    roots = plain_components(fps)
    least = {}
    for s, k in zip(signed, roots):
        least[k] = min(least.get(k, s), s)
    assert {s: of.get(s, s) for s in signed} == {s: least[k] for s, k in zip(signed, roots)}


def test_components_of_a_long_path(spark):
    from foliowright.llm.components import components

    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in components(edges).collect()} == {0}
    assert components(edges.where("false")).count() == 0


@pytest.mark.parametrize("few", [1 << 17, 9])
def test_components_of_few_edges_need_no_exchange(spark, few):
    from foliowright.llm.components import components

    held = {"spark.sql.shuffle.partitions": "30", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in held}
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60) if i % 6], "a long, b long").repartition(5)
    for k, v in held.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup(f"few {few}", "")
    try:
        of = {r.node: r.component for r in components(edges, few=few).collect()}
    finally:
        spark.sparkContext._jsc.clearJobGroup()
        for k, v in old.items():
            spark.conf.set(k, v)
    assert of == {i: (i - 1) // 6 * 6 + 1 for i in range(1, 61)}
    told = spark.sparkContext.statusTracker()
    stages = {s for j in told.getJobIdsForGroup(f"few {few}") for s in told.getJobInfo(j).stageIds}
    tasks = sum(told.getStageInfo(s).numTasks for s in stages if told.getStageInfo(s))
    # without exchanges between 30 partitions if all edges are few, and with them otherwise
    assert (tasks < 90) == (few > 9), tasks


def test_contamination_reads_few_texts_at_once(monkeypatch):
    import pyarrow as pa

    texts, sizes = ["one two three four five six seven eight nine ten " * 40 + str(i) for i in range(1500)], []
    monkeypatch.setattr(decontaminate, "scan", lambda some, kind, scan=decontaminate.scan: sizes.append(sum(map(len, some))) or scan(some, kind))
    items = pa.table({"length": pa.array([], pa.int32()), "seed": pa.array([], pa.int64()), "hash": pa.array([], pa.int64()), "item_id": pa.array([], pa.int64())})
    told = decontaminate._told(decontaminate.Index(items), pa.array(texts), 10, 4)
    assert [x["n_words"] for x in told.to_pylist()] == [401] * 1500
    assert sum(sizes) == sum(map(len, texts)) and max(sizes) <= (1 << 18) + max(map(len, texts))

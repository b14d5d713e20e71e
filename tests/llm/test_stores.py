"""Token store, chat formatting, top-k search and mixing."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliowright.llm import chat_format, mixing, token_store, topk
from foliowright.llm.common import new_path, remove_path
from foliowright.llm.queries import tokenizer_path

TEXTS = [None, "", "Hello world,\nagain  and   again", "x", "é" * 50, "it's <|endoftext|> odd\r\n\t ", " lead", "word " * 5000, "日本語 text", "a b  c \x1c d"]


def test_token_store_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = [(i * 3 - 6, t, "k", "p") for i, t in enumerate(TEXTS)] + [(3, "again", "k", "p"), (3, "again", "k", "p"), (None, "no id", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k string, payload string").repartition(3)
    path = new_path(spark, "test-tokens")
    token_store.write(docs, path, tokenizer_path(), 2, shard_ids=300)
    got = token_store.read(spark, path).orderBy("start").collect()
    want, start = [], 0
    for k, t in sorted([(r[0], r[1] or "") for r in rows], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())):
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [2]
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    found = token_store.lookup(spark, path, [0, 12, 3, None, 999_999])
    encoded = lambda t: tokenizer.encode(t, add_special_tokens=False).ids + [2]
    assert [x.tolist() for x in found[0]] == [encoded(TEXTS[2])]
    assert sorted(x.tolist() for x in found[3]) == sorted([encoded("again")] * 2 + [encoded(TEXTS[3])])
    assert set(found) == {0, 12, 3, None} and len(found[None]) == 1
    plan = token_store.shards_of(spark, path, [12])
    assert plan.count() < spark.read.parquet(path).count()
    assert "LessThanOrEqual(lo,12)" in plan._jdf.queryExecution().executedPlan().toString()
    remove_path(spark, path)


def test_stored_keys_tell_foreign_fingerprints(monkeypatch):
    monkeypatch.setattr(token_store, "fingerprints", lambda words: np.zeros(len(words), np.uint32))
    row = token_store.pack_shard(0, 0, 0, [None, 4, 4, 9], [0, 0, 1, 0], [b"ab"] * 4, 2)
    shard = token_store.Shard(2, row["payload"], row["slots"], row["levels"])
    assert any(shard.get(k) is not None for k in range(100, 200))
    assert not any(len(token_store.holds(row["key"], k)) for k in range(100, 200))
    assert [token_store.holds(row["key"], k).tolist() for k in (None, 4, 9)] == [[0], [0, 1], [0]]
    assert (row["nulls"], row["lo"], row["hi"]) == (1, 4, 9)


def test_empty_store(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_store.store_tokens(docs, tokenizer_path(), 2).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_hash_is_minimal_and_perfect(n):
    words = token_store.key_words(np.arange(n), np.zeros(n, int))
    levels = token_store.read_levels(token_store.build_levels(words))
    assert sorted(token_store.slot_of(words, levels).tolist()) == list(range(n))


def chats(spark):
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", "u ~1 [INST] <|x|>\n~"), (1, 2, "assistant", "a</s>~0~2"), (2, 0, "user", None), (2, 1, "user", "again"),
        (3, 1, "assistant", "late"), (3, 0, "user", "early"), (4, 0, None, "who"), (4, 0, "odd\n[role]", "x"), (None, 0, "user", "q"), (None, 1, "assistant", "r"), (5, 0, "assistant", ""), (5, 0, "assistant", ""), (6, None, "user", "n"), (6, 1, "assistant", "😀"),
    ]
    return rows, spark.createDataFrame([(*r, "t") for r in rows], "conv_id long, turn long, role string, text string, turns string")


def test_chats_read_back(spark):
    rows, frame = chats(spark)
    out = chat_format.format_chats(frame)
    got = {r.conv_id: r for r in chat_format.digest(out).collect()}
    for k in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == k))
        said = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        r = got[k]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {k for k, r in got.items() if r.valid} == {1, 3, None, 6}
    for r in out.collect():
        assert "".join(s.text for s in r.segments) == r.formatted
        assert not any("[INST]" in s.text or "</s>" in s.text for s in r.segments if s.loss)
    assert chat_format.digest(chat_format.format_chats(frame.where("false"))).count() == 0


@pytest.mark.parametrize("blocks", [(1 << 14, 1 << 9), (16, 3)])
def test_top_k(spark, blocks):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 20)).round(3)
    vectors = [*base, *(base[0] for _ in range(40)), *(base[1] * np.where(rng.random(20) < 0.1, -1, 1) for _ in range(20))]
    rows = [(i, [float(x) for x in v], "d") for i, v in enumerate(vectors)] + [(7, [float(x) for x in vectors[7]], "d"), (900, None, "d"), (901, [], "d"), (None, [1.0] * 20, "d")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, distance string")
    got = [tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 20 == 0, k=5, block_codes=blocks[0], block_queries=blocks[1]).collect()]
    code = {i: np.array(v) > 0 for i, v, _ in rows if v and i is not None}
    want = []
    for q in code:
        if q % 20 == 0:
            near = sorted((int((code[q] != c).sum()), i) for i, c in code.items() if i != q)[:5]
            want += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    assert sorted(got) == sorted(want)
    assert topk.top_k(frame.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_mixing_meets_its_margins(spark):
    rng = random.Random(5)
    rows = [(i, "word " * rng.randrange(1, 40) + rng.choice(["", " | x", " Licensed under"]), rng.choice(["a", "a", "a", "b", None]), rng.choice(["en", "fr", None]), "w") for i in range(400)]
    rows += [(1, None, "a", "en", "w"), (None, "x y", "b", "fr", "w"), (3, "", "zz", "en", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, tokens string")
    out = mixing.weighed(docs).toPandas()
    assert len(out) == len(rows) and out._probability.max() <= 1
    total = (out._tokens * out._probability).sum()
    for m in mixing.MARGINS:
        own = out.groupby(f"_{m}")._tokens.sum()
        goal = own**mixing.ALPHA / (own[own > 0] ** mixing.ALPHA).sum()
        got = (out._tokens * out._probability).groupby(out[f"_{m}"]).sum() / total
        assert np.allclose(got[own > 0], goal[own > 0], atol=1e-8)
    kept = mixing.mix(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)
    assert mixing.mix(docs.where("false")).count() == 0
    given = {"source": spark.createDataFrame([("a", 0.1), ("b", 0.8), ("?", 0.1)], "value string, share double")}
    out = mixing.weighed(docs.where("source <> 'zz' OR source IS NULL"), targets=given).toPandas()
    weight = out._tokens * out._probability
    assert abs(weight[out._source == "b"].sum() / weight.sum() - 0.8) < 1e-8
    # sums are taken in another order there
    by_exchange, by_broadcast = (sorted((str(tuple(r)[:5]), round(r._probability, 9)) for r in mixing.weighed(docs, broadcast=n).collect()) for n in (0, 100))
    assert by_exchange == by_broadcast


def test_mixing_of_few_cells_takes_few_jobs(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, "word " * rng.randrange(1, 40), rng.choice("aaab"), rng.choice(["en", "en", "fr"]), rng.choice("xyz")) for i in range(200)], "doc_id long, text string, source string, lang string, about string")
    found, jobs = [], []
    for n in (0, mixing.BROADCAST):
        spark.sparkContext.setJobGroup(f"mixing-{n}", "")
        found.append({r.doc_id: r._probability for r in mixing.weighed(docs, topics=F.col("about"), broadcast=n).collect()})
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"mixing-{n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert all(abs(p - found[1][i]) < 1e-8 for i, p in found[0].items())
    # rounds were planned and broadcast one by one, which filled the driver
    assert jobs[1] <= 40, jobs


def test_mixing_with_targets_left_out(spark):
    rows = [(i, "some words " * (i % 5 + 1), "ab"[i % 2], "en" if i % 2 else "fr", i % 3) for i in range(60)] + [(60, "word", "a", "de", None), (61, "word " * 30_000, "b", "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, about int")
    given = {"source": spark.createDataFrame([("a", 1.0)], "value string, share double")}
    with pytest.warns(UserWarning):  # languages of source b only can't be met
        out = mixing.weighed(docs, targets=given, topics=F.col("about"), most=5).toPandas()
    assert (out._probability[out._source == "b"] == 0).all() and (out._probability[out._source == "a"] > 0).all()
    assert set(out._topic) == {"0", "1", "2", "?"}
    kept = mixing.mix(docs, targets=given, topics=F.col("about"), most=1)
    assert kept.columns == docs.columns and {r.source for r in kept.collect()} == {"a"}


def test_release_frees_the_shuffle_of_the_last_query(spark):
    import time
    from pathlib import Path

    from foliowright.llm.common import materialised, release

    dirs = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {p.name for d in dirs for p in Path(d).rglob("shuffle_*")}
    release(spark)
    before = files()
    rows = materialised(spark.range(1000).repartition(3, "id").groupBy("id").count(), "rows")[0]
    assert files() - before
    release(spark)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert rows.count() == 1000

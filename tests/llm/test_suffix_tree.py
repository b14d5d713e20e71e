"""Scores of the suffix tree against plain counting."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from foliowright.llm import blocks, suffix_tree

KINDS = "doc_id long, text string, score string, flag string"


def words(text):
    return [*(text or "").encode().translate(suffix_tree._LOWER).split(), b""]


def plain(rows, depth, least, alpha, divergence):
    train = [words(t) for k, t in rows if zlib.crc32(str(k).encode() if k is not None else b"") % 7 != 2]
    counts = Counter(w for d in train for w in d)
    total, distinct = sum(counts.values()), len(counts)
    seen, after = Counter(), Counter()
    for d in train:
        for i in range(len(d)):
            for n in range(1, depth + 1):
                if i >= n:
                    seen[tuple(d[i - n : i])] += 1
                    after[tuple(d[i - n : i]), d[i]] += 1

    def chain(d, i):
        """(context, probability there, that of the shorter one) for each candidate context."""
        p = (counts[d[i]] + 1) / (total + 1.0 * (distinct + 1))
        out = [((), p, p)]
        for n in range(1, min(depth, i) + 1):
            c = tuple(d[i - n : i])
            if seen[c] < least:
                break
            longer = (after[c, d[i]] + alpha * p) / (seen[c] + alpha)
            out.append((c, longer, p))
            p = longer
        return out

    gains = Counter()
    for d in train:
        for i in range(len(d)):
            for c, _, shorter in chain(d, i)[1:]:
                left_out = (after[c, d[i]] - 1 + alpha * shorter) / (seen[c] - 1 + alpha)
                gains[c] += math.log(left_out / shorter) - divergence
    out = []
    for k, t in rows:
        d = words(t)
        low = high = 0.0
        for i in range(len(d)):
            states = chain(d, i)
            low += math.log10(states[0][1])
            high += math.log10([p for c, p, _ in states if not c or gains[c] > 0][-1])
        out.append((k, zlib.crc32(str(k).encode() if k is not None else b"") % 7 == 2, len(d), sum(counts[w] > 0 for w in d), total, round(low, 6), round(high, 6)))
    return sorted(out, key=str), {c for c, g in gains.items() if g > 0}, set(gains)


def texts():
    rng = random.Random(5)
    follow = {w: rng.choices(range(30), k=3) for w in range(30)}
    out = []
    for k in range(120):
        w, line = rng.randrange(30), []
        for _ in range(rng.randrange(0, 60)):
            line.append(f"W{w}" if rng.random() < 0.9 else f"odd{rng.randrange(10_000)}")
            w = rng.choice(follow[w]) if rng.random() < 0.7 else rng.randrange(30)
        out.append((k, rng.choice([" ", "\n", " \t "]).join(line)))
    copies = [(200 + i, "the same text of several words again and again " * 3) for i in range(12)]
    return out + copies + [(300, None), (301, ""), (302, "  "), (None, "w1 w2"), (7, out[7][1]), (303, "É é w1 x"), (304, "w1 " * 3000)]


@pytest.mark.parametrize("depth,size", [(1, 10**9), (2, 500), (3, 2000)])
def test_scores_equal_plain(spark, depth, size):
    rows = texts()
    want, kept, tried = plain(rows, depth, 3, 5.0, 0.5)
    assert kept and kept != tried
    frame = spark.createDataFrame([(*r, "s", "f") for r in rows], KINDS).repartition(3)
    out = suffix_tree.score(frame, depth=depth, least=3, alpha=5.0, divergence=0.5, size=size)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in out.collect()), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[i] - w[i]) < 1e-5 * max(1, abs(w[i])) for g, w in zip(got, want) for i in (5, 6))


def test_empty_and_untrained(spark):
    assert suffix_tree.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = suffix_tree.score(one, training=F.lit(False)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_held_out_texts_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    row = suffix_tree.score(docs).where("held_out").agg(F.sum("base_score").alias("b"), F.sum("score").alias("s")).first()
    assert row.s > 0.97 * row.b


def test_packing():
    import numpy as np

    a = np.array([0, 1, 255, 256, 1 << 31, (1 << 32) - 1], np.uint32)
    assert blocks.unpack(blocks.pack(a)).tolist() == a.tolist()
    assert blocks.unpack(blocks.pack(a[:0])).tolist() == []
    assert blocks.unpack_list(blocks.pack_list([b"", b"abc", b""])) == [b"", b"abc", b""] and blocks.unpack_list(blocks.pack_list([])) == []
    codes = np.sort(np.array([0, 5, 1 << 63, (1 << 64) - 1], np.uint64))
    assert blocks.unpack_codes(blocks.pack_codes(codes)).tolist() == codes.tolist()
    assert [(i, a, b) for i, a, b in blocks.cut_codes(codes, 16)] == [(0, 0, 2), (8, 2, 3), (15, 3, 4)]

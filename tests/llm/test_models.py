"""Language identification and toxicity on labelled rows, and the pipeline's stages."""

import numpy as np
from pyspark.sql import functions as F

from foliowright.llm import gru, langid, toxicity

SF = "/root/testdata/sf0.01"


def test_gru_gradients():
    rng = np.random.default_rng(0)
    u, x = rng.standard_normal((9, 3)) * 0.5, rng.standard_normal((4, 9, 2))
    weight = rng.standard_normal((4, 3, 2))
    loss = lambda x, u: (gru.run(lambda t: x[t].copy(), range(4), u, 2) * weight).sum()
    keep = []
    gru.run(lambda t: x[t].copy(), range(4), u, 2, keep)
    dx, du = gru.backward(weight, keep, u)
    for array, grad in ((x, dx), (u, du)):
        for at in [tuple(rng.integers(s) for s in array.shape) for _ in range(15)]:
            old = array[at]
            array[at] = old + 1e-6
            up = loss(x, u)
            array[at] = old - 1e-6
            assert np.isclose((up - loss(x, u)) / 2e-6, grad[at], atol=1e-5)
            array[at] = old


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "", None), (-3, "123 !!", "en"), (None, "the and with of the", None)], "doc_id long, text string, lang string")
    out = langid.identify(docs.select("doc_id", "text", "lang").unionByName(odd).withColumn("score", F.lit("x"))).toPandas()
    assert len(out) == docs.count() + 4
    assert set(out[out.doc_id < 0].lang_pred) == {"und"} and set(out[out.doc_id < 0].score) == {0.0}
    truth = docs.select("doc_id", "lang").toPandas()
    held = out[out.held_out].merge(truth, on="doc_id")
    assert (held.lang_pred == held.lang).mean() > 0.95
    assert out.score.between(0, 1).all()


def plain_probabilities(model, text):
    """One byte at a time, each piece from zero states, with the network's equations written out."""
    p, h = {k: v.astype(np.float64) for k, v in model.p.items()}, langid.HIDDEN
    squash = lambda x: 1 / (1 + np.exp(-x))
    total = np.zeros(len(model.langs))

    def states(piece, way):
        state, out = np.zeros(h), []
        for byte in piece:
            x, rec = p["x" + way][:, byte], p["u" + way] @ state
            z, r = squash(x[:h] + rec[:h]), squash(x[h : 2 * h] + rec[h : 2 * h])
            n = np.tanh(x[2 * h :] + r * rec[2 * h :])
            state = z * state + (1 - z) * n
            out.append(state)
        return out

    for a in range(0, len(text), langid.PIECE):
        lo = max(0, a - langid.EDGE)
        piece = text[lo : a + langid.PIECE + langid.EDGE]
        f, b = states(piece, "f"), states(piece[::-1], "b")[::-1]
        for i in range(a - lo, min(len(text) - lo, a - lo + langid.PIECE)):
            logits = p["of"] @ f[i] + p["ob"] @ b[i] + p["c"][:, 0]
            e = np.exp(logits - logits.max())
            total += e / e.sum()
    return total / max(len(text), 1)


def test_language_equals_plain_network_in_any_batch():
    model = langid.Model(["de", "en", "fr"])
    texts = [b"", b"a", "nineteen bytes of it".encode(), "é".encode() * 300, b"some words " * 60, bytes(range(32, 127)) * 9]
    want = [plain_probabilities(model, t) for t in texts]
    for own in (texts, texts[::-1], texts[2:3], texts[1:4]):
        got = langid.probabilities(model, own)
        for t, row in zip(own, got):
            assert np.allclose(row, want[texts.index(t)], atol=1e-4)


def test_language_gradients():
    rng, model = np.random.default_rng(4), langid.Model(["x", "y"], hidden=3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    pieces = [p for t in (b"ab", b"some longer text", b"q" * 150) for p in langid.cut(t)]
    targets = np.array([i % 2 for i in range(len(pieces))])
    grads = {}

    class Keep:
        rate = 0.0

        def __init__(self, *_):
            pass

        def step(self, p, g):
            grads.update(g)

    def loss():
        grid, holds, told = langid.as_grid(pieces)
        prob = model.labels(*model.states(grid, holds))
        own = -np.log(prob[:, targets, np.arange(len(pieces))])
        return (own * told).sum() / told.sum()

    was, gru.Adam = gru.Adam, Keep
    try:
        model.train(pieces, targets, epochs=1, batch=len(pieces), rate=0.0)
    finally:
        gru.Adam = was
    for name in ("ub", "uf", "ob", "xb", "c"):
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in model.p[name].shape)
            if name == "xb":
                at = (at[0], ord("e"))
            old, eps = model.p[name][at], 1e-5
            model.p[name][at] = old + eps
            up = loss()
            model.p[name][at] = old - eps
            down = loss()
            model.p[name][at] = old
            assert abs((up - down) / (2 * eps) - grads[name][at]) < 1e-5


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert langid.identify(docs).first().lang_pred == "und"
    assert langid.identify(docs.where("false")).count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    some = docs.join(labels.select("doc_id"), "doc_id", "left_semi").select("doc_id", "text")
    out = toxicity.toxicity(some.withColumn("score", F.lit("x")), labels, rows=500).toPandas()
    held = out[out.held_out].merge(labels.select("doc_id", "toxic").toPandas(), on="doc_id")
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert toxic.predicted.mean() > 0.8 and clean.predicted.mean() < 0.05
    assert (out.predicted == (out.score >= 0.7)).all()


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "!!"), (None, "idiot")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(40)] + [(1, None)], "doc_id long, toxic int")
    texts = spark.createDataFrame([(i, "you idiot" if i % 2 else "a fine day") for i in range(40)], "doc_id long, text string").unionByName(docs.where("doc_id IS NULL OR doc_id < 0"))
    out = toxicity.toxicity(texts, labels).collect()
    assert len(out) == 41 and all(0 <= r.score <= 1 for r in out)


def test_pipeline_stages(spark):
    import corpus_pipeline
    from test_near_copies import plain_components, plain_shingles

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        kept = out.collect()
        assert {tuple(r) for r in kept} <= {tuple(r) for r in rows.collect()}
        if name == "near_dedup":
            # the stage's rule is shingle similarity, not op10's radius
            roots, _ = plain_components([plain_shingles(r.text) for r in rows.orderBy("doc_id").collect()])
            assert len(kept) == len(set(roots))
        rows = spark.createDataFrame(kept, docs.schema)
    n = rows.count()
    last = corpus_pipeline.STAGES[-1][1](spark, rows, "/root/testdata/sf0.001")
    assert last.count() == n

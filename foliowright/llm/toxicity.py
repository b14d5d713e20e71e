"""Toxicity by a bidirectional gated recurrent network with attention over words.

Each word is read by its characters (the mean of learned byte vectors, and how much
likelier its first 4, 5 and 6 bytes are in toxic training rows) and as a word (a learned
vector of its hash, and how much likelier it is itself). The counts behind these odds
leave a row itself out while training. The network reads windows of SPAN
words, each overlapping the next by half, so that every word of every text is read;
attention pools a window's states to one logit. A document's score is that of its most
toxic window.

Trained in numpy by backpropagation through time on a bounded sample: about TRAIN_ROWS
labelled rows of each class, whole texts, chosen by a hash of the id. Per epoch each
document is learned from at its most toxic window (at first by the word odds).

Empty and null texts are one window without words. With no label of one class there is
nothing to tell apart and every score is the share of toxic rows (0 if there are none).
Rows with a null id are scored, not learned from; several labels of one id count as
toxic if any is; repeated rows are each returned; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliowright.llm import gru
from foliowright.llm.common import in_chunks, lean, text_bytes
from foliowright.llm.langid import bucket
from foliowright.llm.wordscan import CLASSES, scan

HIDDEN, SPAN, BATCH = 8, 32, 4096
BUCKETS, CHARS, WORDS = 4096, 6, 6
TRAIN_ROWS, EPOCHS, STEPS = 1000, 6, 160
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
KIND = "alnum_lower"
FOLD = CLASSES[KIND][1]


def sample(docs: DataFrame, labels: DataFrame, key: str, usable: Column, rows: int) -> list[tuple[int, bytes]]:
    """(label, text) of a bounded sample of each class."""
    known = labels.where(F.col("toxic").isNotNull() & usable).groupBy(key).agg(F.max("toxic").alias("toxic"))
    sizes = {r[0]: r[1] for r in known.groupBy(F.col("toxic") > 0).count().collect()}
    draw = F.xxhash64(F.lit("toxicity"), F.col(key)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    share = F.when(F.col("toxic") > 0, min(1.0, rows / sizes.get(True, 1))).otherwise(min(1.0, rows / sizes.get(False, 1)))
    chosen = known.where(draw < share)  # about 2 * rows keys, by construction
    found = docs.select(key, "text").join(F.broadcast(chosen), key).select(F.col("toxic").cast("int"), "text").collect()
    return sorted((int(r[0] > 0), (r[1] or "").encode()) for r in found)


def spellings(words, only: np.ndarray | None = None) -> list[np.ndarray]:
    """Hashes of the words and of their first bytes; zero where a word has no more than these."""
    pick = slice(None) if only is None else only
    starts, size = words.starts[pick], (words.ends - words.starts)[pick]
    b = FOLD[np.frombuffer(words.buf, np.uint8)]
    out, value = [words.hashes[pick]], np.zeros(len(starts), np.uint64)
    for i in range(max(PREFIXES)):
        value = value * np.uint64(257) + b[np.minimum(starts + i, len(b) - 1)].astype(np.uint64) + np.uint64(1)
        if i + 1 in PREFIXES:
            out.append(np.where(size > i + 1, value, np.uint64(0)))
    return out


class Odds:
    """Log odds of words between the classes, from the numbers of rows that hold them."""

    def __init__(self, labels: list[int], words: list[np.ndarray]):
        self.n = (labels.count(0), labels.count(1))
        self.words, at = np.unique(np.concatenate([np.unique(w) for w in words]), return_inverse=True)
        side = np.repeat(labels, [len(np.unique(w)) for w in words])
        self.df = np.stack([np.bincount(at[side == k], minlength=len(self.words)) for k in (0, 1)])
        several = self.df.sum(axis=0) > 1  # a word of one row says nothing about others
        self.words, self.df = self.words[several], self.df[:, several]

    def of(self, hashes: np.ndarray, own: int | None = None) -> np.ndarray:
        """Log odds of the words; own: the class of the row that they are from, which is left out."""
        if not len(self.words):
            return np.zeros(len(hashes), np.float32)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        seen = (self.words[at] == hashes) & (hashes != 0)
        df, n = [self.df[k][at].astype(np.float64) for k in (0, 1)], list(self.n)
        if own is not None:
            df[own] -= 1
            n[own] -= 1
        rate = [np.maximum(df[k], 0) + 0.25 for k in (0, 1)]
        odds = np.log(rate[1] / (n[1] + 1)) - np.log(rate[0] / (n[0] + 1))
        # weighed down for words of few rows
        odds *= (df[0] + df[1]) / (df[0] + df[1] + 6)
        return np.where(seen, odds, 0).astype(np.float32)


class Model:
    def __init__(self, odds: list[Odds], hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        make = lambda *shape, by=1.0: (rng.standard_normal(shape) * by).astype(np.float32)
        width = CHARS + WORDS + len(odds)
        self.odds = odds
        self.p = {
            "chars": make(CHARS, 256, by=0.3), "words": make(WORDS, BUCKETS, by=0.05),
            "xf": make(3 * hidden, width, by=width**-0.5), "xb": make(3 * hidden, width, by=width**-0.5),
            "bf": np.zeros((3 * hidden, 1), np.float32), "bb": np.zeros((3 * hidden, 1), np.float32),
            "uf": make(3 * hidden, hidden, by=hidden**-0.5), "ub": make(3 * hidden, hidden, by=hidden**-0.5),
            "att": make(1, 2 * hidden, by=0.3), "out": make(1, 2 * hidden, by=0.3), "c": np.zeros((1, 1), np.float32),
        }

    def odds_of(self, words, only: np.ndarray | None = None, own: int | None = None) -> np.ndarray:
        return np.stack([o.of(h, own) for o, h in zip(self.odds, spellings(words, only))])

    def inputs(self, words, odds: np.ndarray, only: np.ndarray):
        """Input vectors (width, n) of the words listed, and their byte counts for training."""
        p = self.p
        b = np.frombuffer(words.buf, np.uint8)
        size = (words.ends - words.starts)[only]
        at = np.repeat(words.starts[only], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        cut = np.cumsum(size) - size
        chars = np.add.reduceat(p["chars"].take(b[at], axis=1), cut, axis=1) / size if len(only) else np.zeros((CHARS, 0), np.float32)
        return np.concatenate([chars, p["words"].take((words.hashes[only] % np.uint64(BUCKETS)).astype(np.int64), axis=1), odds]).astype(np.float32), at, cut, size

    def pooled(self, grid: np.ndarray, size: np.ndarray, xf: np.ndarray, xb: np.ndarray, keep: tuple | None = None):
        """Window logits; grid (time, window) indexes columns of xf and xb, the last of them is for no word."""
        p, steps, n = self.p, range(len(grid)), grid.shape[1]
        kf, kb = keep or (None, None)
        f = gru.run(lambda t: xf.take(grid[t], axis=1), steps, p["uf"], n, kf)
        b = gru.run(lambda t: xb.take(grid[t], axis=1), steps[::-1], p["ub"], n, kb)
        both = np.concatenate([f, b], axis=1)
        e = (p["att"] @ both)[:, 0]
        e[np.arange(len(grid))[:, None] >= np.maximum(size, 1)] = -1e9
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pool = np.einsum("tn,thn->hn", a, both)
        return (p["out"] @ pool)[0] + p["c"][0, 0], both, a, pool

    def projected(self, x: np.ndarray):
        """Projections of the inputs and, behind them, of no word."""
        p = self.p
        x = np.concatenate([x, np.zeros((x.shape[0], 1), np.float32)], axis=1)
        return p["xf"] @ x + p["bf"], p["xb"] @ x + p["bb"]

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """Logit of each text's most toxic window."""
        out = np.full(len(texts), -np.inf)
        for a, b in in_chunks(texts, 1 << 19):
            words = scan(texts[a:b], KIND)
            some, inverse = np.unique(words.hashes, return_inverse=True)
            first = np.zeros(len(some), np.int64)
            first[inverse] = np.arange(len(inverse))
            x = self.inputs(words, self.odds_of(words, first), first)[0]
            xf, xb = self.projected(x)
            doc, grid, size = window_grid(words, inverse, len(some))
            for i in range(0, grid.shape[1], BATCH):
                got = self.pooled(grid[:, i : i + BATCH], size[i : i + BATCH], xf, xb)[0]
                np.maximum.at(out, a + doc[i : i + BATCH], got)
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))


def window_grid(words, inverse: np.ndarray, none: int):
    """(text, (time, window) word columns, words) of all overlapping windows of all texts."""
    n = np.diff(words.first)
    count = np.maximum(1, -(-(n - SPAN // 2) // (SPAN // 2)))
    doc = np.repeat(np.arange(len(n)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start, end = words.first[doc] + nth * (SPAN // 2), words.first[doc + 1]
    size = np.minimum(end - start, SPAN)
    at = start + np.arange(SPAN)[:, None]
    column = np.append(inverse, none)
    return doc, column[np.where(at < end, at, len(inverse))], size


def train(model: Model, labels: list[int], texts: list[bytes], epochs: int = EPOCHS, batch: int = 48, rate: float = 0.02, seed: int = 5) -> None:
    rng, p = np.random.default_rng(seed), model.p
    docs = []
    for y, t in zip(labels, texts):
        words = scan([t], KIND)
        odds = model.odds_of(words, None, y)
        _, grid, size = window_grid(words, np.arange(len(words.hashes)), len(words.hashes))
        docs.append((y, words, odds, grid, size))
    adam = gru.Adam(p, rate)
    epochs = max(epochs, -(-STEPS * batch // max(len(docs), 1)))
    for epoch in range(epochs):
        order = rng.permutation(len(docs))
        adam.rate = rate * (1 - epoch / epochs)
        for i in range(0, len(order), batch):
            picked = [docs[j] for j in order[i : i + batch]]
            xs, grids, sizes, back, base = [], [], [], [], 0
            for y, words, odds, grid, size in picked:
                x, at, cut, length = model.inputs(words, odds, np.arange(odds.shape[1]))
                if epoch < 2:
                    w = int(np.append(odds.max(axis=0), -9)[grid].max(axis=0).argmax())
                else:
                    w = int(model.pooled(grid, size, *model.projected(x))[0].argmax())
                own = grid[:, w]
                xs.append(x)
                grids.append(np.where(own < odds.shape[1], own + base, -1))
                sizes.append(size[w])
                back.append((words, at, cut, length, base))
                base += odds.shape[1]
            x = np.concatenate(xs, axis=1)
            grid, size = np.stack(grids, axis=1), np.array(sizes)
            grid[grid < 0] = base
            y = np.array([d[0] for d in picked], np.float32)
            kf, kb = [], []
            z, both, a, pool = model.pooled(grid, size, *model.projected(x), (kf, kb))
            d = (1 / (1 + np.exp(-z)) - y) / len(y)
            g = {"c": d.sum().reshape(1, 1), "out": (pool @ d)[None, :]}
            dpool = p["out"].T * d
            da = np.einsum("hn,thn->tn", dpool, both)
            de = a * (da - (a * da).sum(axis=0))
            g["att"] = np.einsum("tn,thn->h", de, both)[None, :]
            dboth = a[:, None, :] * dpool + de[:, None, :] * p["att"].T[None]
            h = p["uf"].shape[1]
            dx = np.zeros((x.shape[0], base + 1), np.float32)
            padded = np.concatenate([x, np.zeros((x.shape[0], 1), np.float32)], axis=1)
            for way, k, part in (("f", kf, dboth[:, :h]), ("b", kb, dboth[:, h:])):
                got, g["u" + way] = gru.backward(part, k, p["u" + way])
                flat, cols = got.transpose(1, 0, 2).reshape(3 * h, -1), grid.ravel()
                g["x" + way], g["b" + way] = flat @ padded[:, cols].T, flat.sum(axis=1, keepdims=True)
                add = p["x" + way].T @ flat
                for r in range(len(add)):
                    dx[r] += np.bincount(cols, add[r], minlength=base + 1)
            g["chars"], g["words"] = np.zeros_like(p["chars"]), np.zeros_like(p["words"])
            for words, at, cut, length, start in back:
                own = dx[:, start : start + len(length)]
                used = np.flatnonzero(np.abs(own).sum(axis=0))
                if not used.size:
                    continue
                b = np.frombuffer(words.buf, np.uint8)
                to = (words.hashes[used] % np.uint64(BUCKETS)).astype(np.int64)
                for r in range(WORDS):
                    np.add.at(g["words"][r], to, own[CHARS + r, used])
                place = np.concatenate([at[cut[u] : cut[u] + length[u]] for u in used])
                for r in range(CHARS):
                    g["chars"][r] += np.bincount(b[place], np.repeat(own[r, used] / length[used], length[used]), minlength=256)
            adam.step(p, g)


def all_odds(labels: list[int], texts: list[bytes]) -> list[Odds]:
    spelled = [spellings(scan([t], KIND)) for t in texts]
    return [Odds(labels, [x[k] for x in spelled]) for k in range(1 + len(PREFIXES))]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", usable: Column | None = None, rows: int = TRAIN_ROWS) -> Model | float:
    """A model, or the share of toxic rows if just one class is known."""
    found = sample(docs, labels, key, F.lit(True) if usable is None else usable, rows)
    y, texts = [x[0] for x in found], [x[1] for x in found]
    if len(set(y)) < 2:
        return float(max(y, default=0))
    model = Model(all_odds(y, texts))
    train(model, y, texts)
    return model


def score(docs: DataFrame, model: Model | float, key: str = "doc_id") -> DataFrame:
    """key and score of every document."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = text_bytes(batch.column(1))
            got = np.full(len(texts), model) if isinstance(model, float) else model.scores(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.asarray(got, np.float64))], ["k", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), "text").mapInArrow(lean(run), f"k {kind}, score double").withColumnRenamed("k", key)


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", folds: int = 3, held_out: int = 1, rows: int = TRAIN_ROWS) -> DataFrame:
    """key, held_out, score and predicted; learned from labels outside the held-out fold."""
    fold = bucket(F.col(key), folds)
    model = fit(docs, labels, key, fold != held_out, rows)
    out = score(docs, model, key)
    return out.select(key, F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

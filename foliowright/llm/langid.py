"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes in both directions, labels every byte with a distribution
over the languages learned, and a document's probabilities are the mean over all its
bytes. Texts are read in pieces of PIECE bytes with EDGE bytes of their neighbours on
either side, which are read but not labelled; so every byte of every text is labelled
once, in bounded memory. States hold still over padding: a text's probabilities depend on
the text alone and not on what is read beside it.

It is trained in numpy, by backpropagation through time, on the whole texts of a bounded
sample of labelled rows: about TRAIN_DOCS documents of each language, chosen by a hash of
the id, cut into pieces where they are read. An epoch takes all their pieces.

A null text and one without letters are `und` with score 0. Without any labelled row all
texts are `und`. Of languages equally likely the first by name is predicted. Rows with a
null id are predicted, and not learned from; repeated rows are each returned (and equally
chosen for training); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliowright.llm import gru
from foliowright.llm.common import lean, text_bytes, trim

HIDDEN, PIECE, EDGE, BATCH = 8, 112, 8, 1024
SPAN = PIECE + 2 * EDGE
TRAIN_DOCS, EPOCHS, STEPS = 100, 2, 200
UNKNOWN = "und"


def bucket(key: Column, of: int) -> Column:
    """crc32 of the key as text, modulo `of`."""
    return F.crc32(key.cast("string").cast("binary")) % of


def training_texts(docs: DataFrame, key: str, lang: str, per_lang: int, usable: Column) -> list[tuple[str, bytes]]:
    """(language, text) of a bounded sample of the usable rows with a language and a text."""
    rows = docs.where(usable & F.col(lang).isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not sizes:
        return []
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_lang / n))])
    draw = (F.xxhash64(F.lit("langid"), F.col(key)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52)))
    found = rows.where(draw < F.try_element_at(share, F.col(lang))).select(F.col(lang).cast("string").alias("l"), "text").collect()
    return sorted((r.l, r.text.encode()) for r in found)


def cut(text: bytes) -> list[tuple[bytes, int, int]]:
    """Pieces (bytes, first labelled, last labelled + 1) that label every byte once."""
    out = []
    for a in range(0, len(text), PIECE):
        lo, hi = max(0, a - EDGE), min(len(text), a + PIECE + EDGE)
        out.append((text[lo:hi], a - lo, min(len(text), a + PIECE) - lo))
    return out


def as_grid(pieces: list[tuple[bytes, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(time, batch) bytes, zero behind the end; whether a place holds a byte; whether it is labelled."""
    size, first, last = (np.array(x) for x in zip(*((len(p), a, b) for p, a, b in pieces)))
    grid = np.frombuffer(b"".join(p.ljust(SPAN, b"\0") for p, _, _ in pieces), np.uint8).reshape(len(pieces), SPAN)[:, : size.max()]
    at = np.arange(size.max())[:, None]
    return np.ascontiguousarray(grid.T), (at < size).astype(np.float32), ((at >= first) & (at < last)).astype(np.float32)


class Model:
    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        make = lambda *shape, by=1.0: (rng.standard_normal(shape) * by).astype(np.float32)
        self.langs = langs
        self.p = {
            "xf": make(3 * hidden, 256, by=0.4), "xb": make(3 * hidden, 256, by=0.4),
            "uf": make(3 * hidden, hidden, by=hidden**-0.5), "ub": make(3 * hidden, hidden, by=hidden**-0.5),
            "of": make(len(langs), hidden, by=0.3), "ob": make(len(langs), hidden, by=0.3), "c": np.zeros((len(langs), 1), np.float32),
        }

    def states(self, grid: np.ndarray, holds: np.ndarray, keep: tuple | None = None):
        n, p = grid.shape[1], self.p
        steps = range(len(grid))
        kf, kb = keep or (None, None)
        f = gru.run(lambda t: p["xf"].take(grid[t], axis=1), steps, p["uf"], n, kf)
        # backwards, padding comes first: states stay zero until a piece's own last byte
        b = gru.run(lambda t: p["xb"].take(grid[t], axis=1), steps[::-1], p["ub"], n, kb, holds)
        return f, b

    def labels(self, f: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Probabilities (time, language, batch) at every position."""
        p = self.p
        out = p["of"] @ f
        out += p["ob"] @ b
        out += p["c"]
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=1, keepdims=True)
        return out

    def sums(self, pieces: list[tuple[bytes, int, int]]) -> np.ndarray:
        """Sum of each piece's label probabilities over its labelled places (piece, language)."""
        out = np.zeros((len(pieces), len(self.langs)))
        for i in range(0, len(pieces), BATCH):
            grid, holds, told = as_grid(pieces[i : i + BATCH])
            out[i : i + BATCH] = np.einsum("tln,tn->nl", self.labels(*self.states(grid, holds)), told)
        return out

    def train(self, pieces: list[tuple[bytes, int, int]], targets: np.ndarray, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.02, seed: int = 3) -> None:
        rng, p = np.random.default_rng(seed), self.p
        adam = gru.Adam(p, rate)
        epochs = max(epochs, -(-STEPS * batch // max(len(pieces), 1)))
        for epoch in range(epochs):
            order = rng.permutation(len(pieces))
            adam.rate = rate * (1 - epoch / epochs)
            for i in range(0, len(order), batch):
                own = order[i : i + batch]
                grid, holds, told = as_grid([pieces[j] for j in own])
                kf, kb = [], []
                f, b = self.states(grid, holds, (kf, kb))
                d = self.labels(f, b)
                d[:, targets[own], np.arange(len(own))] -= 1
                d *= told[:, None, :]
                d /= told.sum()
                flat = lambda x: x.transpose(1, 0, 2).reshape(x.shape[1], -1)
                g = {"of": flat(d) @ flat(f).T, "ob": flat(d) @ flat(b).T, "c": d.sum(axis=(0, 2))[:, None]}
                dxf, g["uf"] = gru.backward(p["of"].T @ d, kf, p["uf"])
                dxb, g["ub"] = gru.backward(p["ob"].T @ d, kb, p["ub"], holds)
                hot = np.zeros((grid.size, 256), np.float32)
                hot[np.arange(grid.size), grid.ravel()] = 1
                g["xf"], g["xb"] = flat(dxf) @ hot, flat(dxb) @ hot
                adam.step(p, g)


def fit(docs: DataFrame, key: str = "doc_id", lang: str = "lang", usable: Column | None = None, train_docs: int = TRAIN_DOCS) -> Model | None:
    """A model from a bounded sample of the usable rows; None if there is nothing to learn from."""
    usable = F.lit(True) if usable is None else usable
    sample = [(k, p) for k, t in training_texts(docs, key, lang, train_docs, usable) for p in cut(t)]
    langs = sorted({k for k, _ in sample})
    if not langs:
        return None
    model = Model(langs)
    model.train([p for _, p in sample], np.array([langs.index(k) for k, _ in sample]))
    del sample
    trim()
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with lang_pred and score. Only texts go to Python, and they don't come back."""
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.arrow_udf(kind)
    @lean
    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            lang, score = [], []
            for i in range(0, len(column), 512):
                some = column.slice(i, 512)
                known, texts = some.is_valid().to_pylist(), text_bytes(some)
                prob = probabilities(model, texts)
                for k, row in zip(known, prob):
                    ok = k and len(row)
                    best = int(row.argmax()) if ok else 0
                    lang.append(model.langs[best] if ok else UNKNOWN)
                    score.append(min(1.0, float(row[best])) if ok else 0.0)
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.withColumn("_guess", guess(F.when(letters, F.col("text"))))
    return rows.select(*docs.columns, "_guess.lang_pred", "_guess.score")


def probabilities(model: Model | None, texts: list[bytes]) -> np.ndarray:
    """(text, language), the mean over each text's bytes."""
    out = np.zeros((len(texts), len(model.langs) if model else 0))
    pieces, of, many = [], [], 8 * BATCH

    def flush():
        np.add.at(out, np.array(of, np.int64), model.sums(pieces))
        pieces.clear()
        of.clear()

    if model:
        for i, t in enumerate(texts):
            own = cut(t)
            for j in range(0, len(own), many):
                pieces += own[j : j + many]
                of += [i] * len(own[j : j + many])
                if len(pieces) >= many:
                    flush()
        if pieces:
            flush()
        out /= np.maximum([[len(t)] for t in texts], 1)
    return out


def identify(docs: DataFrame, key: str = "doc_id", folds: int = 4, held_out: int = 2, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """key, held_out, lang_pred and score; learned from the rows outside the held-out fold."""
    fold = bucket(F.col(key), folds)
    model = fit(docs, key, "lang", fold != held_out, train_docs)
    rows = predict(docs.select(F.col(key), "text"), model)
    return rows.select(key, F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")

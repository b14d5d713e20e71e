"""Benchmark decontamination by winnowed fingerprints.

Of every window of `window` words the least hash among its grams is kept, so that any
shared window shares a fingerprint at the same place. Fingerprints of documents are
joined with those of the benchmark and each hit is extended to the windows around it,
which are compared by the hash of all their words. Items shorter than a window are one
window of their own length, found by the hash of that length alone. Hashes are of 64
bits, from the same word hashes; words themselves are not compared.

The benchmark's side is sent to all executors while it is small (BROADCAST distinct
windows, counted first). For a larger benchmark the documents' fingerprints, those left
out that a table of fixed size (SEEDS bits) doesn't have, are exchanged for a semi-join
with the benchmark's; only what is left is extended to windows and joined. Both exchanges
are salted, equal texts are extended once, and results are the same either way.

A null or wordless text has no words and no hits; an item without words occurs nowhere.
Very long texts are searched like others, chunk by chunk of whole texts. Repeated documents are each returned; repeated items count once per item_id. A null
item_id is not listed. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliowright.llm.common import apart, in_chunks, lean, text_bytes
from foliowright.llm.wordscan import anchors, covered, scan

WINDOW, GRAM, KIND = 10, 4, "alnum_lower"
BROADCAST = 500_000
#: salts of the exchanges by window, so that one window in a third of all texts is dealt to as many tasks
SALT = 16
#: places of the fixed table of the benchmark's seeds that documents are asked for before any exchange
SEEDS = 1 << 23
#: rows of a batch that are read at once, and about how many of their bytes are scanned at once
ROWS, CHUNK = 512, 1 << 18
_FIELDS = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("n_items", T.LongType()), ("items_sha256", T.StringType()), ("contaminated", T.BooleanType())]


def item_windows(items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(length, seed, hash, item_id): the distinct windows of the items, each with its winnowed seed."""

    def run(batches):

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), text_bytes(batch.column(1))
            rows = {"length": [], "seed": [], "hash": [], "item": []}
            for a, b in in_chunks(texts, CHUNK):
                words = scan(texts[a:b], KIND)
                at, lo, hi, seed = anchors(words, window, gram)
                n = hi - lo + 1
                s = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                found = [(s, np.full(len(s), window), np.repeat(seed, n))]
                size = np.diff(words.first)
                short = np.flatnonzero((size > 0) & (size < window))
                if short.size:
                    s = words.first[short]
                    found.append((s, size[short], words.window(s, size[short])))
                for s, length, seed in found:
                    if len(s):
                        rows["length"] += length.tolist()
                        rows["seed"] += seed.view(np.int64).tolist()
                        rows["hash"] += words.window(s, length).view(np.int64).tolist()
                        rows["item"] += [ids[a + d] for d in words.doc[s].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows["length"], pa.int32()), pa.array(rows["seed"], pa.int64()), pa.array(rows["hash"], pa.int64()), pa.array(rows["item"], batch.column(0).type)], ["length", "seed", "hash", "item_id"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(lean(run), f"length int, seed long, hash long, item_id {kind}").distinct()


class Index:
    """The benchmark's windows for lookups: sorted hashes of each length and their items."""

    def __init__(self, rows):
        """rows: item_windows() as an Arrow table."""
        self.of: dict[int, tuple] = {}
        ids = rows["item_id"].to_pylist()
        self.items = sorted({x for x in ids if x is not None})
        number = {x: i for i, x in enumerate(self.items)}
        item = np.array([number.get(x, -1) for x in ids], np.int64)
        lengths, hashes, seeds = (rows[c].to_numpy() for c in ("length", "hash", "seed"))
        for length in np.unique(lengths).tolist():
            own = lengths == length
            h, seed = hashes[own].view(np.uint64), seeds[own].view(np.uint64)
            order = np.lexsort((item[own], seed, h))
            self.of[length] = (h[order], seed[order], item[own][order], np.unique(seed))

    def match(self, length: int, hashes: np.ndarray, seeds: np.ndarray):
        """(row, item) pairs of the windows found."""
        h, s, item, _ = self.of[length]
        left, right = np.searchsorted(h, hashes, "left"), np.searchsorted(h, hashes, "right")
        n = right - left
        row = np.repeat(np.arange(len(hashes)), n)
        at = np.repeat(left, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        same = s[at] == seeds[row]
        return row[same], item[at[same]]


def _expand(lo: np.ndarray, hi: np.ndarray, *more: np.ndarray):
    n = hi - lo + 1
    s = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return s, *(np.repeat(x, n) for x in more)


def _among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def _digest(ids: list) -> str:
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", window: int = WINDOW, gram: int = GRAM, broadcast: int = BROADCAST) -> DataFrame:
    """key, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    found = with_hits(docs.select(F.col(key).alias("k"), "text"), items, window, gram, broadcast)
    return found.select(F.col("k").alias(key), *[f"_hits.{c}" for c, _ in _FIELDS])


def with_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, broadcast: int = BROADCAST) -> DataFrame:
    """docs with _hits, a struct of what contamination() tells."""
    windows = item_windows(items, window, gram)
    small = windows.limit(broadcast + 1).toArrow()
    if small.num_rows <= broadcast:
        return docs.withColumn("_hits", _search(Index(small), docs, window, gram)(F.col("text")))
    return _by_join(docs, windows, window, gram)


def _search(index: Index, docs: DataFrame, window: int, gram: int):
    """A function of texts that looks up their windows in the benchmark's; only texts go to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf(T.StructType([T.StructField(*f) for f in _FIELDS]))
    @lean
    def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = shared.value
        for column in batches:
            yield _told(index, column, window, gram)

    return hits


def _told(index: Index, column: pa.Array, window: int, gram: int) -> pa.StructArray:
    """What contamination() tells of each text; few of them are bytes and arrays at a time."""
    out = []
    for i in range(0, len(column), ROWS):
        texts = text_bytes(column.slice(i, ROWS))
        for a, b in in_chunks(texts, CHUNK):
            out += _found(index, texts[a:b], window, gram)
    cols = list(zip(*out)) or [[]] * len(_FIELDS)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], [f for f, _ in _FIELDS])


def _found(index: Index, texts: list[bytes], window: int, gram: int) -> list[tuple]:
    words = scan(texts, KIND)
    los, his, docs, found = [], [], [], []
    for length in index.of:
        if length == window:
            at, lo, hi, seed = anchors(words, window, gram)
            hit = _among(seed, index.of[length][3])
            s, seeds = _expand(lo[hit], hi[hit], seed[hit])
        else:
            s = words.whole(length)
            seeds = words.windows(length)[s]
            hit = _among(seeds, index.of[length][3])
            s, seeds = s[hit], seeds[hit]
        if not len(s):
            continue
        row, item = index.match(length, words.window(s, np.int64(length)), seeds)
        los.append(s[row])
        his.append(s[row] + length)
        docs.append(words.doc[s[row]])
        found.append(item)
    hits = np.zeros(len(texts), np.int64)
    of: dict[int, set] = {}
    if los:
        inside = covered(len(words.hashes), np.concatenate(los), np.concatenate(his))
        hits = np.bincount(words.doc[inside], minlength=len(texts))
        for d, i in set(zip(np.concatenate(docs).tolist(), np.concatenate(found).tolist())):
            if i >= 0:
                of.setdefault(d, set()).add(i)
    out = []
    for d, size in enumerate(np.diff(words.first).tolist()):
        own = [index.items[i] for i in of.get(d, ())]
        out.append((size, int(hits[d]), len(own), _digest(own), bool(hits[d])))
    return out


def _anchor_rows(words, length: int, window: int, gram: int):
    """(first window, last window, seed) of the anchors for windows of that length."""
    if length == window:
        _, lo, hi, seed = anchors(words, window, gram)
        return lo, hi, seed
    s = words.whole(length)
    return s, s, words.windows(length)[s]


def _by_join(docs: DataFrame, windows: DataFrame, window: int, gram: int) -> DataFrame:
    """Seeds first: a document's winnowed anchors are exchanged, those that the benchmark has are extended to windows, and these are joined."""
    lengths = [r.length for r in windows.select("length").distinct().collect()]  # at most `window` of them
    place = lambda seed: F.pmod(seed, F.lit(SEEDS))
    marks = np.zeros(SEEDS, bool)
    marks[windows.select(place(F.col("seed")).cast("int").alias("p")).distinct().toPandas()["p"].to_numpy(np.int64)] = True
    marked = docs.sparkSession.sparkContext.broadcast(np.packbits(marks))

    def seeds(batches):
        bits = np.unpackbits(marked.value).astype(bool)
        for batch in batches:
            texts = text_bytes(batch.column(2))
            h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b in in_chunks(texts, 1 << 18):
                words = scan(texts[a:b], KIND)
                for length in lengths:
                    lo, hi, seed = _anchor_rows(words, length, window, gram)
                    some = bits[seed.view(np.int64) % SEEDS]
                    lo, hi, seed = lo[some], hi[some], seed[some]
                    if len(lo):
                        d = words.doc[lo]
                        cols = h1[a + d], h2[a + d], lo - words.first[d], hi - words.first[d], np.full(len(lo), length, np.int32), seed.view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["h1", "h2", "lo", "hi", "length", "seed"])

    def extended(batches):
        for batch in batches:
            h1, h2, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), text_bytes(batch.column(2))
            for i, listed in enumerate(batch.column(3).to_pylist()):
                words = scan(texts[i : i + 1], KIND)
                for length in {x["length"] for x in listed}:
                    own = [x for x in listed if x["length"] == length]
                    s, seed = _expand(np.array([x["lo"] for x in own]), np.array([x["hi"] for x in own]), np.array([x["seed"] for x in own], np.int64))
                    cols = np.full(len(s), h1[i]), np.full(len(s), h2[i]), s, np.full(len(s), length, np.int32), seed, words.window(s, np.int64(length)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["h1", "h2", "at", "length", "seed", "hash"])

    base = docs.withColumn("_h1", F.xxhash64("text")).withColumn("_h2", F.xxhash64(F.lit(1), "text"))
    texts = base.select(F.col("_h1").alias("h1"), F.col("_h2").alias("h2"), "text")
    salt = F.pmod(F.xxhash64("h1"), F.lit(SALT)).alias("salt")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))).alias("salt")
    asked = texts.mapInArrow(lean(seeds), "h1 long, h2 long, lo long, hi long, length int, seed long").select("*", salt)
    known = windows.select("length", "seed").distinct().select("*", salts)
    listed = asked.join(known, ["salt", "length", "seed"], "left_semi").groupBy("h1", "h2").agg(F.collect_set(F.struct("lo", "hi", "length", "seed")).alias("listed"))
    # equal texts are looked at once
    once = texts.join(listed.select("h1", "h2"), ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"]).join(listed, ["h1", "h2"])
    tried = once.select("h1", "h2", "text", "listed").mapInArrow(lean(extended), "h1 long, h2 long, at long, length int, seed long, hash long").select("*", salt)
    hits = tried.join(windows.select("*", salts), ["salt", "length", "seed", "hash"]).groupBy("h1", "h2").agg(
        F.collect_set(F.struct("at", "length")).alias("spans"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    # spans and items of one text; its words in any span, counted from the merged spans
    step = F.aggregate(
        F.array_sort(F.transform("spans", lambda s: F.struct(s["at"].alias("a"), (s["at"] + s["length"]).alias("b")))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), s["b"] - F.greatest(s["a"], acc["upto"]))).alias("n"), F.greatest(acc["upto"], s["b"]).alias("upto")),
        lambda acc: acc["n"],
    )
    hits = hits.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), step.alias("_n"), F.col("items").alias("_items"))
    n_words = F.size(F.filter(F.split(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != ""))
    rows = base.join(hits, ["_h1", "_h2"], "left")
    ids = F.coalesce("_items", F.array().cast("array<string>"))
    told = F.struct(
        n_words.cast("long").alias("n_words"), F.coalesce("_n", F.lit(0)).alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), F.coalesce(F.col("_n") > 0, F.lit(False)).alias("contaminated"),
    )
    return rows.withColumn("_hits", told).select(*docs.columns, "_hits")


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, broadcast: int = BROADCAST) -> DataFrame:
    """The documents in which no window of an item occurs; rows are kept as they are."""
    rows, names = apart(docs, "text")
    return with_hits(rows, items, window, gram, broadcast).where("NOT _hits.contaminated").select(*rows.columns).toDF(*names)


#: op9's result in DuckDB SQL.
SQL = r"""
WITH lowered AS (
  SELECT doc_id, row_number() OVER () AS r,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents
), item AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM item WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows
), grams AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS x
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM lowered, sizes WHERE len(w) >= n)
), found AS (SELECT r, i, n, item_id FROM grams JOIN windows USING (n, x)
), hit AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT r, i, unnest(range(0, n)) AS k FROM found) GROUP BY r
), ids AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""

"""Substring dedup: words covered by a window that occurs again anywhere.

Seed and extend. Winnowed anchors (a gram of words kept by its hash) are the seeds:
equal windows always share one at the same offset. Anchors are joined on their seed and
extended both ways as far as the windows that took them:

1. seeds that occur once are dropped;
2. anchors with the same seed and the same words over their whole reach (all windows
   that took the anchor) repeat in full: all their windows are repeats;
3. where reaches of one seed differ (the ends of a repeat), one anchor of each distinct
   reach is extended window by window and those found in another reach are repeats.

Repeats that touch join to maximal ones when the covered words are merged. All grouping
is by aggregation of counts; no two documents are ever paired, so a passage held by many
documents costs a row for each and not for each pair. Seed, reach and window hashes are
64 bits each and always used two together.

Rows: texts are told apart by 128 bits of hash, so repeated rows and ties need no order;
every row counts as an occurrence. Null and short texts have no windows; very long ones are
read whole. An empty table gives an empty one. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliowright.llm.common import hot_keys, in_chunks, is_hot, lean, materialised, release, remove_path, salted_join, text_bytes
from foliowright.llm.wordscan import anchors, covered, mix, scan

WINDOW, GRAM, KIND = 35, 10, "space"
_REACH = 6  # bits for the distance of an anchor to its first and last window


def _anchor_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(h1, h2, place, seed, reach), a row for each anchor; place packs the anchor's word and its windows."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = text_bytes(batch.column(2))
            h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b in in_chunks(texts):
                words = scan(texts[a:b], KIND)
                at, lo, hi, seed = anchors(words, window, gram)
                if not len(at):
                    continue
                d = words.doc[at]
                place = ((at - words.first[d]) << 2 * _REACH) | ((at - lo) << _REACH) | (at - hi)
                reach = mix(words.window(lo, hi + window - lo) ^ ((at - lo) << _REACH | (at - hi)).astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (h1[a + d], h2[a + d], place, seed.view(np.int64), reach.view(np.int64))], ["h1", "h2", "place", "seed", "reach"])

    return docs.select("h1", "h2", "text").mapInArrow(lean(run), "h1 long, h2 long, place long, seed long, reach long")


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """(seed, reach, hash, h1, h2, first, alone): the windows of the anchors listed beside each text."""

    def run(batches):
        import pyarrow as pa

        last = None
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            data, listed = batch.column(2), batch.column(3)
            for i, k in enumerate(keys):
                if k == last:  # equal texts mostly follow each other; one of them is enough
                    continue
                last = k
                words = scan(text_bytes(data.slice(i, 1)), KIND)
                rows = listed[i].as_py()
                at, back, ahead = _unpacked(np.array([r["place"] for r in rows], np.int64))
                n = back - ahead + 1
                s = np.repeat(at - back, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                of = np.repeat(np.arange(len(rows)), n)
                seed, reach = (np.array([r[c] for r in rows], np.int64)[of] for c in ("seed", "reach"))
                alone = np.array([r["alone"] for r in rows], bool)[of]
                same = [np.full(len(s), x, np.int64) for x in k]
                cols = (seed, reach, words.window(s, np.int64(window)).view(np.int64), *same, s, alone)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["seed", "reach", "hash", "h1", "h2", "first", "alone"])

    return texts.mapInArrow(lean(run), "seed long, reach long, hash long, h1 long, h2 long, first long, alone boolean")


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchor's word, and how far before it its first and its last window start."""
    return place >> 2 * _REACH, place >> _REACH & 63, place & 63


def repeated_spans(base: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_texts: list[tuple] = (), hot_rows: int = 1000) -> DataFrame:
    """(h1, h2, spans): for each text with repeats, the word ranges [a, b) of its repeated windows.

    Each step's rows go to the shared folder, so that the shuffle files of those before
    it can go; what the result doesn't read is removed.
    """
    if not 0 < gram <= window or window - gram >= 1 << _REACH:
        raise ValueError("window - gram must be less than 64")
    spark = base.sparkSession
    rows = _anchor_rows(base, window, gram)
    again, again_path = materialised(rows.groupBy("seed").agg(F.count("*").alias("c")).where("c > 1"), "seeds")
    release(spark)
    kept, first_path = materialised(salted_join(rows, again.select("seed"), ["seed"], hot_keys(again, ["seed"], "c", hot_rows), "left_semi"), "anchors")
    del rows, again
    remove_path(spark, again_path)
    release(spark)

    reaches, reach_path = materialised(kept.groupBy("seed", "reach").agg(F.count("*").alias("n"), F.min("h1").alias("one")), "reaches")
    hot_reaches = hot_keys(reaches, ["seed", "reach"], "n", hot_rows)
    several = reaches.groupBy("seed").agg(F.count("*").alias("c"), F.min("n").alias("least")).where("c > 1 AND least = 1").select("seed", F.lit(True).alias("differ"))
    hot_seeds = hot_keys(reaches.groupBy("seed").agg(F.count("*").alias("c")), ["seed"], "c", hot_rows)
    marked = salted_join(reaches, several, ["seed"], hot_seeds, "left")
    # an anchor that isn't alone with its reach repeats in full; one anchor of each reach is tried where reaches differ
    seen = salted_join(kept, marked.where("n > 1 OR differ"), ["seed", "reach"], hot_reaches)
    tried = F.when(F.col("differ") & (F.col("h1") == F.col("one")), F.struct("seed", "reach"))
    seen = seen.select("h1", "h2", F.struct("place", (F.col("n") > 1).alias("full"), tried.alias("tried")).alias("x"))
    listed, _ = materialised(seen.groupBy("h1", "h2").agg(F.collect_set("x").alias("xs")), "anchors-of-texts")
    del kept, reaches, several, marked, seen
    remove_path(spark, first_path)
    remove_path(spark, reach_path)
    release(spark)

    trial = F.transform(F.filter("xs", lambda x: x["tried"].isNotNull()), lambda x: F.struct(x["place"].alias("place"), x["tried"]["seed"].alias("seed"), x["tried"]["reach"].alias("reach"), (~x["full"]).alias("alone")))
    ends = listed.select("h1", "h2", trial.alias("ends")).where(F.size("ends") > 0)
    texts = base.select("h1", "h2", "text")
    copied = is_hot(["h1", "h2"], hot_texts)
    if hot_texts:
        texts = texts.where(~copied).unionByName(texts.where(copied).dropDuplicates(["h1", "h2"]))
    tried, _ = materialised(_windows(texts.join(ends, ["h1", "h2"]), window), "windows")
    del ends
    release(spark)

    # a window occurs again if it lies in two reaches; texts tried more than once have the same reaches
    twice = tried.groupBy("seed", "hash").agg(F.min("reach").alias("a"), F.max("reach").alias("z"), F.count("*").alias("c")).where("a < z")
    twice, twice_path = materialised(twice.select("seed", "hash", "c"), "twice")
    partly = salted_join(tried.where("alone"), twice.select("seed", "hash"), ["seed", "hash"], hot_keys(twice, ["seed", "hash"], "c", hot_rows), "left_semi")
    partly = partly.select("h1", "h2", F.struct(F.col("first").alias("a"), (F.col("first") + window).alias("b")).alias("s"))
    partly = partly.groupBy("h1", "h2").agg(F.collect_set("s").alias("partly"))

    def span(x: Column) -> Column:
        at = F.shiftright(x["place"], 2 * _REACH)
        back = F.shiftright(x["place"], _REACH).bitwiseAND(F.lit(63))
        return F.struct((at - back).alias("a"), (at - x["place"].bitwiseAND(F.lit(63)) + window).alias("b"))

    whole = listed.select("h1", "h2", F.transform(F.filter("xs", lambda x: x["full"]), span).alias("whole"))
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    return whole.join(partly, ["h1", "h2"], "left").select("h1", "h2", F.concat("whole", F.coalesce("partly", none)).alias("spans"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, gram: int = GRAM, hot_rows: int = 1000) -> DataFrame:
    """key, n_words, n_removed, kept (the words left, joined by one space) and spans of every document."""
    base = docs.select(F.col(key).alias("k"), "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    hot_texts = hot_keys(base.groupBy("h1", "h2").agg(F.count("*").alias("c")), ["h1", "h2"], "c", hot_rows)
    spans = repeated_spans(base, window, gram, hot_texts, hot_rows)
    rows = salted_join(base, spans, ["h1", "h2"], hot_texts, "left").select("k", "text", "spans")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for t, spans in zip(text_bytes(batch.column(1)), batch.column(2).to_pylist()):
                words = t.split()
                merged = []
                if spans:
                    gone = covered(len(words), np.array([s["a"] for s in spans]), np.array([s["b"] for s in spans]))
                    edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0])).tolist()
                    merged = [{"a": a, "b": b} for a, b in zip(edges[0::2], edges[1::2])]
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    kept = words
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode(), merged))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))], ["k", "n_words", "n_removed", "kept", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"k {kind}, n_words long, n_removed long, kept string, spans array<struct<a:long,b:long>>").withColumnRenamed("k", key)


#: op1's result in DuckDB SQL.
SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), windows AS (
  SELECT r, i, md5(array_to_string(w[i : i + 34], ' ')) AS x
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), twice AS (SELECT x FROM windows GROUP BY x HAVING count(*) > 1
), gone AS (
  SELECT r, list(DISTINCT i + k) AS g FROM (SELECT r, i, unnest(range(0, 35)) AS k FROM windows SEMI JOIN twice USING (x)) GROUP BY r
), numbered AS (SELECT r, w, i FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM words)
), kept AS (
  SELECT n.r, string_agg(n.w[n.i], ' ' ORDER BY n.i) AS t, count(*) AS c
  FROM numbered n ANTI JOIN (SELECT r, unnest(g) AS i FROM gone) d ON n.r = d.r AND n.i = d.i GROUP BY n.r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(c, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (r)
"""
